"""Text archive to tested model on a small made-up network."""

import math
import random
from datetime import datetime, timedelta

import pytest
from compare import rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from gaugeworks.operators import features, models
from gaugeworks.plans import workflow
from gaugeworks.sources import readers, sinks
from gaugeworks.spec import SplitCuts

HEADER = "station_id,station_name,timestamp,reading_value,location_latitude,location_longitude\n"


def write_csv(path, items):
    path.write_text(HEADER + "".join(",".join(map(str, i)) + "\n" for i in items))
    return str(path)


def record(sid, name, time, value):
    return sid, name, time.strftime("%Y-%m-%dT%H:%M:%S+08:00"), value, "1.3", "103.8"


def test_three_rows(spark, tmp_path):
    t = datetime(2017, 5, 1)
    one = [record("S1", "Road", t, ".2"), record("S1", "Road", t + timedelta(seconds=1), ".2"),
           record("S1", "S1", t + timedelta(minutes=10), ".4")]
    out = str(tmp_path / "clean")
    summary = workflow.clean_archive(spark, {2017: write_csv(tmp_path / "a.csv", one)}, out).first()
    assert (summary.input_rows, summary.output_rows, summary.collision_rows_removed, summary.shifted_timestamps,
            summary.station_name_rows_standardized) == (3, 2, 1, 1, 1)
    table = spark.read.parquet(out)
    assert rows(table.select("station_name").distinct()) == [("Road",)]
    assert workflow.validate_archive(table).isEmpty()
    assert {r.issue for r in workflow.validate_archive(table.unionByName(table)).collect()} == {"duplicate_extra_rows"}
    tables = workflow.explore(table)
    annual = tables["annual"].first()
    assert annual.observed_intervals == 2 and annual.recorded_rainfall_mm == pytest.approx(0.6)
    place = tables["station_year"].first()
    assert (place.station_name, place.latitude, place.calendar_expected_intervals) == ("Road", 1.3, 365 * 288)
    totals = {n: tables[n].agg(F.sum("observed_intervals")).first()[0] for n in
              ("annual", "monthly", "hourly", "station_year", "station_month")}
    assert set(totals.values()) == {2}


def test_conflict_stops_the_archive(spark, tmp_path):
    t = datetime(2017, 5, 1)
    bad = [record("S1", "Road", t, ".2"), record("S1", "Road", t + timedelta(seconds=1), ".4")]
    with pytest.raises(ValueError, match="Conflicting"):
        workflow.clean_archive(spark, {2017: write_csv(tmp_path / "b.csv", bad)}, str(tmp_path / "out"))


def test_missing_column(spark, tmp_path):
    (tmp_path / "c.csv").write_text("station_id\nS1\n")
    with pytest.raises(ValueError, match="Missing columns"):
        readers.read_raw_csv(spark, str(tmp_path / "c.csv"))


def test_model_from_archive(spark, tmp_path):
    rnd = random.Random(11)
    files = {}
    for year in (2022, 2023, 2024):
        items = []
        for sid in ("S1", "S2"):
            for i in range(700):
                wave = 1.2 * max(0.0, math.sin(i / 9.0) + rnd.random() - 0.6)
                items.append(record(sid, f"Name {sid}", datetime(year, 3, 1) + timedelta(minutes=5 * i), round(wave, 1)))
        files[year] = write_csv(tmp_path / f"{year}.csv", items)
    out, prepared = str(tmp_path / "clean"), str(tmp_path / "prepared")
    workflow.clean_archive(spark, files, out)
    counts = workflow.prepare(spark.read.parquet(out), prepared, cuts=SplitCuts())
    assert {(r.split, r.year): r.rows for r in counts.collect()} == {
        (s, y): 2 * (700 - 18) for s, y in (("train", 2022), ("validation", 2023), ("test", 2024))}
    with pytest.raises(AnalysisException):
        workflow.prepare(spark.read.parquet(out), prepared)
    base = spark.read.parquet(prepared)
    levels = (0.0, 1.0, 3.0, 5.0)
    model, report = workflow.train_lr(base, (0.01, 0.1), levels)
    assert report.where("selected").count() == 1 and report.agg(F.min("macro_brier")).first()[0] > 0
    result = workflow.evaluate_model(base, model, str(tmp_path / "scored"), levels)
    assert result["metrics"].count() == 4 and result["monotonicity"].first().violating_pairs == 0
    assert result["metrics"].where("roc_auc <= 0.5").isEmpty()
    assert result["reliability"].agg(F.sum("n")).first()[0] == 4 * 2 * 682
    sample = base.where("split = 'validation'").withColumn("threshold_mm", F.lit(1.0)).withColumn("label", F.lit(0.0))
    assert models.load_model(spark, workflow.store_model(model, str(tmp_path / "model"), sample)).stages
    forest, depths = workflow.train_forest(base, 4, (2, 3), thresholds=levels, path=str(tmp_path / "forest"))
    boosted, _ = workflow.train_boosted(base, 1, max_iter=2, depth=2, thresholds=levels)
    assert models.score(models.load_model(spark, str(tmp_path / "forest")), sample).count() == 2 * 682
    parts = [base.where(F.col("split") == p) for p in ("train", "validation")]
    ready = [features.expand_thresholds(p, levels) for p in parts]
    for train, valid in (parts, ready):
        on_examples, chosen = workflow.train_on_examples(train, valid, max_iter=2, depth=2, thresholds=levels)
        assert chosen.where("selected").count() == 1 and models.score(on_examples, sample).count() == 2 * 682
    with pytest.raises(ValueError, match="label_or_threshold"):
        workflow.train_on_examples(ready[0].withColumn("label", F.lit(2.0)), ready[1], thresholds=levels)
    assert depths.count() == 2
    for other in (forest, boosted):
        assert models.score(other, sample).where("p BETWEEN 0 AND 1").count() == 2 * 682
    unseen = sample.limit(5).withColumn("station_id", F.lit("S-unseen"))
    assert models.score(model, unseen).where("p BETWEEN 0 AND 1").count() == 5


def test_single_class_and_bad_bounds_are_refused(spark):
    def caps(*variances):
        rows = [(i, v, v == 0.0) for i, v in enumerate(variances)]
        return models.coefficient_caps(spark.createDataFrame(rows, "feature int, variance double, constant boolean"))

    assert caps(1.0, 0.0, 2.0) == [models.COEFFICIENT_BOUND, 0.0, 0.0]
    with pytest.raises(ValueError, match="threshold_does_not_vary"):
        caps(1.0, 0.0)
    with pytest.raises(ValueError, match="infinite_or_negative"):
        caps(float("nan"), 1.0)
    with pytest.raises(ValueError):
        models.boosted(step=0.0)


def test_sorted_extract_is_ordered_over_its_files(spark, tmp_path):
    df = spark.range(100).repartition(8)
    for files in (1, 4):
        path = tmp_path / f"in{files}"
        sinks.write_sorted(df, str(path), ["id"], files)
        parts = sorted(path.glob("part-*"))
        assert len(parts) == files
        assert [r.id for p in parts for r in spark.read.parquet(str(p)).collect()] == list(range(100))


def test_analysis_from_summaries_to_a_surface(spark, tmp_path):
    """Twelve stations over four years, two of them badly covered, one summary with a broken rule."""
    rnd = random.Random(4)
    slots = {y: (366 if y % 4 == 0 else 365) * 288 for y in (2021, 2022, 2023, 2024)}
    yearly, monthly = [], []
    for i in range(12):
        for y, n in slots.items():
            seen = int(n * (0.5 if i < 2 else 0.95))
            yearly.append((y, f"S{i}", seen, seen // 10, seen / 20.0, n, 100.0 * seen / n, 1.25 + i * 0.01, 103.7 + (i % 4) * 0.05))
            monthly.append((y, 1, f"S{i}", 8000, rnd.randrange(8000), 40.0, 31 * 288, 100.0 * 8000 / (31 * 288)))
    head = "observed_intervals long, rainy_intervals long, recorded_rainfall_mm double, calendar_expected_intervals long, calendar_coverage_pct double"
    station_year = spark.createDataFrame(yearly, f"year int, station_id string, {head}, latitude double, longitude double")
    station_month = spark.createDataFrame(monthly, f"year int, month int, station_id string, {head}")
    years = tuple(slots)
    out = workflow.analyse(station_year, station_month, years=years, spatial_years=years)
    assert out["map_points"].count() == 10 and out["map_rows"].count() == 40
    assert out["annual_sensitivity"].where("cohort = 'balanced_all_years'").agg(F.max("stations")).first()[0] == 10
    assert out["monthly_sensitivity"].where("month = 2 and stations > 0").isEmpty() and out["cohort_audit"].where("selected").count() > 0
    with pytest.raises(ValueError, match="annual summary"):
        workflow.analyse(station_year.withColumn("rainy_intervals", F.col("observed_intervals") + 1), station_month, years=years, spatial_years=years)
    square = [(103.68, 1.24), (103.9, 1.24), (103.9, 1.4), (103.68, 1.4), (103.68, 1.24)]
    edges = spark.createDataFrame([(0, 0, 0, i, *a, *b) for i, (a, b) in enumerate(zip(square, square[1:]))],
                                  "feature int, polygon int, ring int, edge int, x1 double, y1 double, x2 double, y2 double")
    cells = workflow.surface(out["map_points"], "rainy_pct", edges, nx=20, distance=4_000.0)
    every = workflow.surface(out["map_points"], "rainy_pct", edges, nx=20)
    assert 0 < cells.count() < every.count() < 20 * 90
    assert cells.where("neighbours <> 8 or abs(estimate - 10) > 0.01").isEmpty()


def test_level_with_one_class_is_fitted_over_all_levels(spark):
    items = [(sid, datetime(2022 + i // 40, 3, 1 + i % 7, i % 24), i % 24, 3, *[float((i * 7 + j) % 5) for j in range(3)],
              ("train", "validation")[i // 40], float((i * 5) % 10)) for sid in ("S1", "S2") for i in range(80)]
    names = ", ".join(f"{c} double" for c in readers.RAINFALL_FEATURES)
    base = spark.createDataFrame(items, f"station_id string, prediction_time timestamp_ntz, hour int, month int, {names}, split string, future_rainfall_30m double")

    def fit(levels, pooled):
        return models.train_and_select(base, lambda _: {"forest": models.forest(2, 2)}, levels, pooled=pooled)

    _, report = fit((-1.0, 5.0), True)
    assert report.where("selected and macro_brier < 0.25").count() == 1
    for levels, pooled in (((-1.0, 5.0), False), ((-1.0, -2.0), True)):
        with pytest.raises(ValueError, match="Both training classes"):
            fit(levels, pooled)
