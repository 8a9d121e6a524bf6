"""End-to-end jobs: text archive to clean table, summaries, prepared samples and a tested model."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from gaugeworks.functions.values import non_finite
from gaugeworks.operators import clean, cohorts, evaluate, features, models, spatial, summaries, validate
from gaugeworks.operators.checks import require_empty, require_none
from gaugeworks.sources import readers, sinks
from gaugeworks.sources.scratch import materialise
from gaugeworks.spec import LABEL_THRESHOLDS, SPATIAL_YEARS, STUDY_YEARS, SeriesSpec, SplitCuts


def clean_archive(spark: SparkSession, files: Mapping[int, str], path: str,
                  s: SeriesSpec = SeriesSpec(), tolerance: int = 1) -> DataFrame:
    """Annual text files to one clean table partitioned by year; returns the cleaning summary.

    The text is parsed twice: once for the station names and once into an aligned working
    table, from which the checks, the result and the summary are made.
    """
    raw = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True),
                 [readers.read_raw_csv(spark, p).withColumn("year", F.lit(y)) for y, p in files.items()])
    mapping = clean.canonical_names(clean.name_variants(raw, s), s)
    names = materialise(clean.name_dimension(mapping, s), "names")
    aligned = clean.align_to_grid(clean.type_records(raw, s), s)
    work = materialise(clean.apply_lookup(aligned, names, s), "aligned")
    require_none(work, {**clean.record_rules(s), "unexpected_offset": clean.offset_rule(tolerance),
                        "outside_year": F.year(s.time) != F.col("year"), "unmapped": F.col("unmapped")},
                 "Invalid records")
    stats = clean.collision_stats(work, s, [s.entity, "aligned_epoch"])
    require_none(stats, {"conflicting_slots": F.col("conflicts") > 0}, "Conflicting readings")
    ties = clean.keep_best_order(s, [c for c in raw.columns if c != "year"])
    best = clean.dedupe_best(work, s, ties).drop("unmapped", "name_changed")
    sinks.write_periods(best, path)
    summary = clean.cleaning_summary(work, s)
    stored = spark.read.schema(best.schema).parquet(path).groupBy("year").agg(F.count("*").alias("rows"))
    checked = validate.row_count_check(stored, summary)
    require_empty(checked.where("row_count_matches_summary <> 'true'"), "Stored rows differ from the summary")
    return summary


def validate_archive(clean_table: DataFrame, s: SeriesSpec = SeriesSpec()) -> DataFrame:
    """Issues of a clean table; empty when it may be analysed."""
    counts = validate.structural_counts(clean_table, s).join(
        validate.duplicate_extras(clean_table, s.key, ["year"]), "year")
    return validate.validation_issues(counts)


def explore(clean_table: DataFrame, s: SeriesSpec = SeriesSpec()) -> dict[str, DataFrame]:
    """The summary tables of a table without issues. The five grains share one written table."""
    require_empty(validate_archive(clean_table, s), "The table is not fit to be summarised")
    rows = summaries.calendar_cols(clean_table, s.time)
    grains = materialise(summaries.metric_grains(rows, s), "grains")

    def grain(name: str) -> DataFrame:
        kept = {s.entity if c == "entity" else c for c in summaries.GRAINS[name]}
        return grains.where(F.col("grain") == name).drop("grain", *({"year", "month", "hour", s.entity} - kept))

    station_year = summaries.annual_calendar_coverage(grain("station_year"), s)
    places = summaries.median_location(rows, ["year", s.entity], s)
    return {
        "annual": grain("annual"), "monthly": grain("monthly"), "hourly": grain("hourly"),
        "station_year": summaries.attach_location(station_year, places, s),
        "station_month": summaries.monthly_calendar_coverage(grain("station_month"), s),
        "positive_percentiles": summaries.tail_percentiles(rows, ["year"], s),
        "positive_histogram": summaries.histogram(rows, ["year"], s)}


def analyse(station_year: DataFrame, station_month: DataFrame, s: SeriesSpec = SeriesSpec(), thresholds: Sequence[float] = (80.0, 90.0),
            years: Sequence[int] = STUDY_YEARS, spatial_years: Sequence[int] = SPATIAL_YEARS, min_coverage: float = 80.0) -> dict[str, DataFrame]:
    """Coverage sensitivity, cohorts and map points of summaries that break no rule.

    Both tables are as of :func:`explore`; write them first. Values or coordinates that are no finite numbers end the job.
    """
    require_empty(cohorts.validate_summary(station_year, ["year", s.entity], s, years), "The annual summary breaks its rules")
    require_empty(cohorts.validate_summary(station_month, ["year", "month", s.entity], s, years), "The monthly summary breaks its rules")
    points = cohorts.spatial_summary(station_year, s, spatial_years, min_coverage)
    shown = ("rainy_pct", "mean_mm_per_interval", "latitude", "longitude")
    require_none(points, {f"unusable_{c}": F.col(c).isNull() | non_finite(c) for c in shown}, "Map points")
    return {
        "annual_sensitivity": cohorts.annual_sensitivity(station_year, s, thresholds, years),
        "monthly_sensitivity": cohorts.monthly_sensitivity(station_month, s, (0.0, *thresholds)),
        "cohort_audit": cohorts.cohort_audit(station_year, s, thresholds, years),
        "map_points": points, "map_rows": cohorts.spatial_rows(station_year, s, spatial_years, min_coverage)}


def surface(points: DataFrame, value: str, boundary: DataFrame, nx: int = 120, pad: float = 3_000.0, distance: float = 0.0,
            neighbours: int = 8, band: float = 500.0, entity: str = "station_id") -> DataFrame:
    """Interpolated ``value`` on a raster over the map points, cells inside ``boundary`` only.

    ``boundary`` has the edges of :func:`spatial.boundary_edges` in degrees. Cells farther than ``distance`` metres
    from every point are left out; zero keeps all. One index of the points serves both searches; the result is
    written, and the index released.
    """
    placed = spatial.project_tm(points).select(F.col(entity).alias("point_id"), "x", "y", value)
    index = spatial.point_index(placed, neighbours).persist()
    try:
        cells = spatial.raster(spatial.bounds_of(placed), nx, pad).withColumn("target_id", F.struct("ix", "iy"))
        edges = boundary
        for end in ("1", "2"):
            own = edges.withColumnsRenamed({f"x{end}": "longitude", f"y{end}": "latitude"})
            edges = spatial.project_tm(own).drop("longitude", "latitude").withColumnsRenamed({"x": f"x{end}", "y": f"y{end}"})
        inside = spatial.inside(cells, edges, band, "target_id")
        near = spatial.distance_mask(inside, placed, distance, index=index)
        found = spatial.idw(near, placed, value, neighbours, index=index)
        return materialise(found.select("target_id.ix", "target_id.iy", "x", "y", "neighbours", "estimate"), "surface")
    finally:
        index.unpersist()


def prepare(clean_table: DataFrame, path: str, s: SeriesSpec = SeriesSpec(), cuts: SplitCuts = SplitCuts()) -> DataFrame:
    """Prepared samples in a new partitioned table; returns the retained counts."""
    series = clean.normalize(clean_table, s).withColumnRenamed("prediction_time", s.time)
    first, last = clean_table.agg(F.min(F.year(s.time)), F.max(F.year(s.time))).first()
    require_empty(clean.validate_series(series, s, (first, last), nonempty=True), "Invalid series")
    samples = features.split_by_time(features.slot_features(series, s), cuts)
    return sinks.write_new_partitioned(samples, path)


def _kept(trained: tuple[PipelineModel, DataFrame], base: DataFrame, path: str | None, thresholds: Sequence[float]) -> tuple[PipelineModel, DataFrame]:
    """Store the chosen model if there is a path, and check it on rows of the validation split."""
    if path is not None:
        store_model(trained[0], path, features.expand_thresholds(base.where(F.col("split") == "validation"), thresholds))
    return trained


def train_lr(base: DataFrame, regs: Sequence[float] = (0.0, 0.01, 0.1),
             thresholds: Sequence[float] = LABEL_THRESHOLDS, path: str | None = None) -> tuple[PipelineModel, DataFrame]:
    """Monotone logistic regression, strength chosen on the validation split, stored at ``path`` if given."""
    def candidates(train: DataFrame) -> dict[str, object]:
        caps = models.coefficient_caps(models.feature_variances(train))
        return {f"reg={r}": models.monotone_lr(caps, r) for r in regs}

    return _kept(models.train_and_select(base, candidates, thresholds, check=models.check_monotone_lr), base, path, thresholds)


def train_forest(base: DataFrame, trees: int = 50, depths: Sequence[int] = (5, 8), seed: int = 5208,
                 thresholds: Sequence[float] = LABEL_THRESHOLDS, path: str | None = None) -> tuple[PipelineModel, DataFrame]:
    """Random forest, depth chosen on the validation split, stored at ``path`` if given."""
    return _kept(models.train_and_select(
        base, lambda _: {f"depth={d}": models.forest(trees, d, seed) for d in depths}, thresholds), base, path, thresholds)


def train_boosted(base: DataFrame, train_fraction: float = 0.01, max_iter: int = 20, depth: int = 4, step: float = 0.1, seed: int = 42,
                  thresholds: Sequence[float] = LABEL_THRESHOLDS, path: str | None = None) -> tuple[PipelineModel, DataFrame]:
    """Boosted trees fitted on a hash sample of stations and times, drawn before rows are expanded.

    Only the rows that fit the trees are sampled: categories come from all training rows, and all
    validation rows are scored. The model is stored at ``path`` if given.
    """
    train = base.where(F.col("split") == "train")
    encoder, bins = models.ordinal_encoder(train)
    keys = ["station_id", "prediction_time"]
    sampled = features.hash_sample(train, keys, train_fraction, seed).unionByName(
        base.where(F.col("split") == "validation"))
    return _kept(models.train_and_select(
        sampled, lambda _: {"boosted": models.boosted(max_iter, depth, step, bins, seed)}, thresholds, encoder), base, path, thresholds)


def train_on_examples(train: DataFrame, valid: DataFrame, max_iter: int = 20, depth: int = 4, step: float = 0.1, seed: int = 42,
                      thresholds: Sequence[float] = LABEL_THRESHOLDS) -> tuple[PipelineModel, DataFrame]:
    """Boosted trees on tables of ready examples, or of prepared rows, in either known layout.

    Rows with an unusable input are left out. A label other than 0 and 1, or a threshold that is not one of
    ``thresholds``, ends the job.
    """
    def ready(rows: DataFrame, what: str) -> DataFrame:
        out = readers.adapt_examples(rows, thresholds)
        if "invalid_example" not in out.columns:
            return out
        require_none(out, {"label_or_threshold": F.col("invalid_example")}, f"{what} examples")
        return out.drop("invalid_example")

    fit, check = ready(train, "Training"), ready(valid, "Validation")
    encoder, bins = models.ordinal_encoder(fit)
    fit, check = (encoder.transform(d).select("features", "label", "threshold_mm").persist() for d in (fit, check))
    try:
        evaluate.require_both_classes(evaluate.class_rates(fit), len(thresholds))
        _, model, report = models.select_candidate({"boosted": models.boosted(max_iter, depth, step, bins, seed)}, fit, check, len(thresholds))
    finally:
        fit.unpersist()
        check.unpersist()
    return PipelineModel([*encoder.stages, model]), report


def store_model(model: PipelineModel, path: str, sample: DataFrame) -> str:
    """Save a model and refuse it if, read back, it scores ``sample`` in another way."""
    require_empty(models.roundtrip_diff(model, path, sample).where(~F.coalesce("identical", F.lit(False))), "The stored model differs")
    return path


def evaluate_model(base: DataFrame, model: PipelineModel, path: str,
               thresholds: Sequence[float] = LABEL_THRESHOLDS) -> dict[str, DataFrame]:
    """Score the test split once, store it, and evaluate what was stored."""
    test = features.expand_thresholds(base.where(F.col("split") == "test"), thresholds)
    scored = models.score(model, test)
    sinks.scored_output(scored, path)
    pred = base.sparkSession.read.schema(scored.schema).parquet(path)
    train = features.expand_thresholds(base.where(F.col("split") == "train"), thresholds)
    metrics = evaluate.brier_skill(evaluate.evaluate(pred), evaluate.class_rates(train))
    return {"metrics": metrics, "reliability": evaluate.reliability(pred), "confusion": evaluate.confusion(pred),
            "monotonicity": evaluate.monotonicity(pred), "preview": sinks.preview(pred)}
