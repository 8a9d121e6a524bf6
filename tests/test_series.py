"""Gaps, coverage, windows and lookups, against plain recomputation and with hot keys."""

import random
from datetime import datetime, timedelta

import pytest
from compare import rows
from pyspark.sql import functions as F

from gaugeworks.operators import cohorts, features, gaps, lookup, profile, spatial, summaries, validate
from gaugeworks.spec import SeriesSpec, SplitCuts

S = SeriesSpec()
T0 = datetime(2020, 1, 1)
SCHEMA = "station_id string, timestamp timestamp_ntz, rainfall double"


def series(spark, items):
    return spark.createDataFrame(items, SCHEMA)


def slots(entity, values, start=T0):
    return [(entity, start + timedelta(minutes=5 * i), float(v)) for i, v in values]


def test_intervals_match_plain_lag_with_hot_copies_and_blocks(spark):
    rnd = random.Random(5)
    times = {e: sorted({T0 + timedelta(seconds=rnd.randrange(40 * 86_400)) for _ in range(n)})
             for e, n in (("hot", 3000), ("b", 40), ("c", 1))}
    items = [(e, t, 1.0) for e, ts in times.items() for t in ts]
    items += [("hot", times["hot"][7], 1.0)] * 2000
    want = sorted((e, a, b) for e, ts in times.items() for a, b in zip(ts, ts[1:]))
    for block in (12, 288, 100_000):
        got = gaps.intervals(series(spark, items), S, block_slots=block)
        assert sorted((r.station_id, r.prev_ts, r.ts) for r in got.collect()) == want


def test_intervals_of_any_resolution_and_their_ends(spark):
    """A crowded second, fractions next to whole seconds, and block borders, against a plain lag."""
    rnd = random.Random(6)
    times = {"fine": {T0 + timedelta(microseconds=rnd.randrange(2_000_000)) for _ in range(3000)},
             "mixed": {T0 + timedelta(seconds=rnd.randrange(200_000), microseconds=rnd.choice([0, 0, 1, 500_000, 999_999])) for _ in range(3000)},
             "edge": {T0 + timedelta(days=d, microseconds=m) for d in range(4) for m in (-1, 0, 1)}, "one": {T0}}
    items = [(e, t, 1.0) for e, ts in times.items() for t in [*ts, *list(ts)[:50]]]
    want = sorted((e, a, b) for e, ts in times.items() for a, b in zip(sorted(ts), sorted(ts)[1:]))
    for block in (12, 288, 100_000):
        pairs, ends = gaps.intervals_and_ends(series(spark, items), S, block_slots=block)
        assert sorted((r.station_id, r.prev_ts, r.ts) for r in pairs.collect()) == want
        cover = {r.station_id: r for r in gaps.span_coverage_raw(ends, gaps.missing_slots(pairs, S), S).collect()}
        assert {e: (r.observed_unique, r.first_ts, r.last_ts) for e, r in cover.items()} == {e: (len(ts), min(ts), max(ts)) for e, ts in times.items()}
    unique = series(spark, [(e, t, 1.0) for e, ts in times.items() for t in ts])
    assert sorted((r.station_id, r.prev_ts, r.ts) for r in gaps.intervals(unique, S, unique=True).collect()) == want


def test_intervals_stay_inside_their_period(spark):
    df = series(spark, [("a", datetime(2019, 12, 31, 23, 50), 1.0), ("a", datetime(2020, 1, 1, 0, 10), 1.0),
                        ("a", datetime(2020, 1, 1, 0, 20), 1.0)]).withColumn("year", F.year("timestamp"))
    assert gaps.intervals(df, S, within=["year"]).count() == 1
    assert gaps.intervals(df, S).count() == 2


@pytest.mark.parametrize("gap, missing, name", [(299, 0, "under_5min"), (300, 0, "exact_5min"), (301, 1, "5_to_10min"),
                                                (600, 1, "5_to_10min"), (900, 2, "10_to_30min"), (3600, 11, "30_to_60min"),
                                                (86_400, 287, "1_to_24h"), (604_800, 2015, "1_to_7d"), (604_801, 2016, "over_7d")])
def test_gap_classes(spark, gap, missing, name):
    df = gaps.gap_class(gaps.missing_slots(spark.sql(f"SELECT {gap}L AS gap_seconds"), S), S)
    assert rows(df) == [(gap, missing, name)]


def test_span_and_gap_sizes(spark):
    df = series(spark, slots("a", [(0, 1), (2, 1), (3, 1), (9, 1), (40, 1)])).withColumn("station_name", F.lit("A"))
    cover = gaps.span_coverage(df, S).first()
    assert (cover.observed_intervals, cover.expected_between_first_last, cover.missing_intervals, cover.coverage_pct) == (
        5, 41, 36, 12.1951)
    size = gaps.gap_size_distribution(df, S).first()
    assert (size.gap_events, size.missing_intervals, size.one_missing, size.two_to_five_missing, size.six_plus_missing) == (
        3, 36, 1, 1, 1)
    assert cover.missing_intervals == size.missing_intervals


def test_leap_year_denominator(spark):
    df = spark.createDataFrame([(2020, "a", 10, 5.0), (2019, "a", 10, 5.0)],
                               "year int, station_id string, observed_intervals long, recorded_rainfall_mm double")
    got = {r.year: r for r in summaries.annual_calendar_coverage(df, S).collect()}
    assert got[2020].calendar_expected_intervals == 366 * 288 and got[2019].calendar_expected_intervals == 365 * 288
    assert got[2020].recorded_rainfall_mm == 5.0


def test_metadata_null_pair_counts(spark):
    df = spark.createDataFrame([("a", "n", None, None), ("a", "n", 1.0, 2.0), ("b", "n", 1.0, 2.0)],
                               "station_id string, station_name string, location_latitude double, location_longitude double")
    assert rows(validate.metadata_exceptions(df, S)) == [("a", 1, 2)]


# --- windows ---


def test_window_sums_and_strict_label(spark):
    df = series(spark, slots("a", [(i, i + 20) for i in range(-12, 7)]))
    got = features.slot_features(df, S).first()
    assert (got.rainfall_previous_5m, got.rainfall_previous_30m, got.rainfall_previous_60m, got.future_rainfall_30m) == (
        19, sum(range(14, 20)), sum(range(8, 20)), 141)
    assert got.target_end_time == T0 + timedelta(minutes=30)
    one = features.slot_features(df, S)
    assert [features.threshold_label(one, t).first().label for t in (141.0, 140.0)] == [0.0, 1.0]
    with pytest.raises(ValueError):
        features.threshold_label(one, float("nan"))


@pytest.mark.parametrize("gone", [i for i in range(-12, 7) if i])
def test_every_slot_is_needed(spark, gone):
    values = [(i, 1) for i in range(-13, 8) if i != gone]
    times = [r.prediction_time for r in features.slot_features(series(spark, slots("a", values)), S).collect()]
    assert T0 not in times


def brute(items, past=12, future=6):
    have = {(e, t): v for e, t, v in items}
    out = []
    for (e, t) in have:
        before = [have.get((e, t - timedelta(minutes=5 * i))) for i in range(1, past + 1)]
        after = [have.get((e, t + timedelta(minutes=5 * i))) for i in range(1, future + 1)]
        if None not in before and None not in after:
            out.append((e, t, before[0], sum(before[:6]), sum(before), sum(after)))
    return sorted(out)


def test_blocks_change_nothing_for_a_hot_series(spark):
    rnd = random.Random(3)
    items = [x for e, n in (("hot", 5000), ("b", 60)) for x in
             slots(e, [(i, rnd.randrange(100) / 8) for i in range(n) if rnd.random() > 0.01])]
    df = series(spark, items)
    for block in (12, 50, 100_000):
        got = features.slot_features(df, S, block_slots=block).select(
            "station_id", "prediction_time", "rainfall_previous_5m", "rainfall_previous_30m", "rainfall_previous_60m",
            "future_rainfall_30m")
        assert sorted(rows(got)) == brute(items)


def test_split_purge(spark):
    cuts = SplitCuts("2023-01-01", "2024-01-01", "2025-01-01")
    data = [(datetime(y, 12, 31, 23, 45), datetime(y + 1, 1, 1, 0, 15)) for y in (2021, 2022, 2023)]
    df = spark.createDataFrame(data, "prediction_time timestamp_ntz, target_end_time timestamp_ntz")
    assert [r.prediction_time.year for r in features.split_by_time(df, cuts).collect()] == [2021]


def test_expansion_keeps_split_and_equality_is_negative(spark):
    df = spark.createDataFrame([(float(i % 12), "train") for i in range(32)], "future_rainfall_30m double, split string")
    got = features.expand_thresholds(df)
    assert got.count() == 128 and got.where("future_rainfall_30m = threshold_mm AND label = 1").isEmpty()


def prepared(spark):
    df = series(spark, slots("a", [(i, 1) for i in range(40)]) + slots("b", [(i, 2) for i in range(40)]))
    return features.split_by_time(features.slot_features(df, S))


SPOIL = {
    "wrong_split": ("split", "'test'"), "unusable_value": ("future_rainfall_30m", "double('NaN')"),
    "wrong_calendar": ("hour", "hour + 1"), "sums_not_nested": ("rainfall_previous_5m", "rainfall_previous_60m + 1"),
    "wrong_horizon": ("target_end_time", "target_end_time + interval 5 minutes"), "blank_id": ("station_id", "' '"),
    "null_column": ("future_rainfall_30m", "null"), "off_grid": ("prediction_time", "prediction_time + interval 1 second"),
}


@pytest.mark.parametrize("issue", sorted(SPOIL))
def test_contract_failures(spark, issue):
    base = prepared(spark)
    assert features.validate_prepared(base, S).isEmpty()
    column, sql = SPOIL[issue]
    found = {r.issue for r in features.validate_prepared(base.withColumn(column, F.expr(sql)), S).collect()}
    assert issue in found


def test_contract_keys_counts_and_columns(spark):
    base = prepared(spark)
    n = base.count()
    assert features.validate_prepared(base, S, expected_counts={2020: n}).isEmpty()
    assert {r.issue for r in features.validate_prepared(base.unionByName(base), S, expected_counts={2020: n}).collect()} == {
        "duplicate_key", "count_differs_2020"}
    with pytest.raises(ValueError, match="hour"):
        features.validate_prepared(base.drop("hour"), S)


def test_sampling_is_deterministic_and_keeps_keys_together(spark):
    df = features.expand_thresholds(prepared(spark))
    keys = ["station_id", "prediction_time"]
    kept = features.hash_sample(df, keys, 0.5, 42)
    assert sorted(rows(kept)) == sorted(rows(features.hash_sample(df.repartition(5), keys, 0.5, 42)))
    assert {r["count"] for r in kept.groupBy(*keys).count().collect()} == {4}
    assert 0 < kept.count() < df.count() and features.hash_sample(df, keys, 1, 1).count() == df.count()
    with pytest.raises(ValueError, match="share"):
        features.hash_sample(df, keys, 1e-12, 1)


# --- lookup ---


def ask(spark, *items):
    df = spark.createDataFrame([(i, *x) for i, x in enumerate(items)],
                               "request_id int, station_id string, prediction_time timestamp_ntz, threshold_mm double")
    return lookup.normalize_requests(df, S)


def history(entity="a"):
    return [(entity, T0 - timedelta(minutes=5 * i), float(i)) for i in range(0, 13)]


def test_lookup_uses_earlier_readings_only(spark):
    obs = series(spark, history() + [("a", T0 + timedelta(minutes=5), 999.0)])
    got = lookup.lookup_features(ask(spark, ("a", T0, 1.0)), obs, S, with_history=True).first()
    assert (got.status, got.rainfall_previous_5m, got.rainfall_previous_30m, got.rainfall_previous_60m) == ("ok", 1, 21, 78)
    assert [h.minutes for h in got.history] == list(range(-60, 0, 5)) and got.history[0].value == 12.0


def test_lookup_equals_training_features(spark):
    rnd = random.Random(9)
    items = slots("a", [(i, rnd.random()) for i in range(300) if rnd.random() > 0.02])
    obs = series(spark, items)
    base = features.slot_features(obs, S)
    requests = lookup.normalize_requests(base.select(
        F.monotonically_increasing_id().alias("request_id"), "station_id", "prediction_time", F.lit(0.0).alias("threshold_mm")), S)
    cols = ["prediction_time", "rainfall_previous_5m", "rainfall_previous_30m", "rainfall_previous_60m", "hour", "month"]
    assert sorted(rows(lookup.lookup_features(requests, obs, S).select(*cols))) == sorted(rows(base.select(*cols)))


def test_lookup_reasons(spark):
    short = [x for x in history("b") if x[2] != 5]
    late = [x for x in history("c") if x[2] != 0]
    twice = history("d") + [("d", T0 - timedelta(minutes=5), 3.0)]
    negative = [(e, t, -1.0 if v == 4 else v) for e, t, v in history("e")]
    shifted = history("f") + [("f", T0 - timedelta(minutes=7), 1.0)]
    after = history("g") + [("g", T0 + timedelta(minutes=1), 1.0)]
    obs = series(spark, history() + short + late + twice + negative + shifted + after)
    asked = ask(spark, ("a", T0, 0.0), ("b", T0, 0.0), ("c", T0, 0.0), ("d", T0, 0.0), ("e", T0, 0.0), ("f", T0, 0.0),
                ("g", T0, 0.0), ("a", T0, 3.0), ("a", T0 + timedelta(seconds=1), 0.0), ("a", datetime(2016, 1, 1), 0.0),
                ("none", T0, 0.0))
    got = [r.status for r in lookup.lookup_features(asked, obs, S).orderBy("request_id").collect()]
    assert got == ["ok", "insufficient_history", "no_observation", "unusable_window", "unusable_window", "unusable_window",
                   "ok", "unsupported_threshold", "off_grid", "outside_years", "no_observation"]
    quality = {r.station_id: (r.duplicate_readings, r.misaligned_readings, r.unusable_readings)
               for r in lookup.window_quality(asked, obs, S).where("request_id BETWEEN 3 AND 5").collect()}
    assert quality == {"d": (1, 0, 0), "e": (0, 0, 1), "f": (0, 1, 0)}


def test_verify(spark):
    after = [("a", T0 + timedelta(minutes=5 * i), float(i)) for i in range(1, 7)]
    short = [("b", t, v) for _, t, v in after[:5]]
    got = lookup.verify(ask(spark, ("a", T0, 10.0), ("b", T0, 10.0)), series(spark, after + short), S).orderBy("request_id")
    assert [(r.total_mm, r.exceeded) for r in got.collect()] == [(21.0, True), (None, None)]


# --- cohorts ---


def station_year(spark):
    def row(y, e, n, wet, total, cov):
        expected = (366 if y % 4 == 0 else 365) * 288
        return (y, e, n or int(expected * cov / 100), wet, total, expected, 1.3, 103.8)

    data = [row(y, "A", None, 5, 50.0, 95) for y in range(2017, 2025)]
    data += [row(y, "B", None, 5, 50.0, 85) for y in range(2017, 2025)]
    data += [row(y, "C", None, 5, 50.0, 99) for y in range(2018, 2025)]
    df = spark.createDataFrame(data, "year int, station_id string, observed_intervals long, rainy_intervals long, "
                                     "recorded_rainfall_mm double, calendar_expected_intervals long, latitude double, longitude double")
    return df.withColumn("calendar_coverage_pct", F.col("observed_intervals") * 100 / F.col("calendar_expected_intervals"))


def ids(df):
    return sorted(r.station_id for r in df.collect())


def test_balanced_cohorts(spark):
    sy = station_year(spark)
    assert ids(cohorts.balanced_ids(sy, S, min_coverage=80)) == ["A", "B"]
    assert ids(cohorts.balanced_ids(sy, S, min_coverage=90)) == ["A"]
    assert ids(cohorts.balanced_ids(sy, S, (2021, 2022, 2023, 2024), 90)) == ["A", "C"]
    with pytest.raises(ValueError):
        cohorts.balanced_ids(sy, S, (2021, 2021))


def test_pooled_and_equal(spark):
    df = spark.createDataFrame([(2020, "A", 10_000, 500, 100.0), (2020, "B", 1_000, 10, 100.0)],
                               "year int, station_id string, observed_intervals long, rainy_intervals long, recorded_rainfall_mm double")
    pooled = cohorts.summarize(df, "year", [2020], "pooled", S).first()
    equal = cohorts.summarize(df, "year", [2020], "equal_station_period", S).first()
    assert pooled.rainy_pct == pytest.approx(100 * 510 / 11_000) and equal.rainy_pct == pytest.approx(3.0)
    assert equal.mean_mm_per_interval == pytest.approx(0.055)


def test_empty_cohort_and_audit(spark):
    got = cohorts.annual_sensitivity(station_year(spark), S, (100.0,)).where("min_coverage_pct = 100 AND cohort LIKE 'b%'")
    found = got.collect()
    assert len(found) == 16 and all(r.stations == 0 and r.rainy_pct is None for r in found)
    audit = cohorts.cohort_audit(station_year(spark), S).where("station_id = 'C' AND year = 2017").collect()
    assert len(audit) == 6 and all(r.calendar_coverage_pct is None and not r.selected for r in audit)


def test_summary_contract(spark):
    good = station_year(spark)
    keys = ["year", "station_id"]
    assert cohorts.validate_summary(good, keys, S).isEmpty()
    for change, issue in ((("rainy_intervals", "observed_intervals + 1"), "rainy_exceeds_observed"),
                          (("calendar_expected_intervals", "365L * 288"), "wrong_calendar_denominator"),
                          (("calendar_coverage_pct", "calendar_coverage_pct + 1"), "coverage_disagrees"),
                          (("recorded_rainfall_mm", "double('NaN')"), "not_finite_or_negative"),
                          (("station_id", "null"), "null_key"), (("year", "if(year = 2017, 2018, year)"), "duplicate_key")):
        bad = good.withColumn(change[0], F.expr(change[1]))
        assert issue in {r.issue for r in cohorts.validate_summary(bad, keys, S).collect()}
    assert "missing_year" in {r.issue for r in cohorts.validate_summary(good.where("year > 2017"), keys, S).collect()}


def test_spatial_summary_median(spark):
    lat = F.when(F.col("year") < 2021, 2.0).otherwise(1.3 + (F.col("year") - 2021) * F.lit(0.01) / 3 + F.lit(0.0005))
    points = cohorts.spatial_summary(station_year(spark).withColumn("latitude", lat), S, min_coverage=90.0)
    got = {r.station_id: r for r in points.collect()}
    assert set(got) == {"A", "C"} and got["A"].latitude == pytest.approx(1.3055) and got["A"].eligible_years == 4


def test_latest_valid_coordinate_and_natural_order(spark):
    data = [("S10", T0, 1.31, 103.81), ("S10", T0 + timedelta(days=1), 1.32, 103.82), ("S10", T0 + timedelta(days=2), 999.0, 103.9),
            ("S2", T0, None, None), ("X", T0, 1.0, 103.0)]
    df = spark.createDataFrame(data, "station_id string, timestamp timestamp_ntz, location_latitude double, location_longitude double")
    got = spatial.entity_catalog(df, S).collect()
    assert [r.station_id for r in got] == ["S2", "S10", "X"]
    assert (got[1].latitude, got[1].longitude) == (1.32, 103.82) and got[0].latitude is None


def test_profile_rolls_up_what_a_plain_pass_finds(spark):
    rnd = random.Random(11)
    raw = [(str(2020 + rnd.randrange(2)), rnd.choice(["hot", "hot", "hot", "b", None, " "]),
            rnd.choice([str(T0 + timedelta(seconds=30 * rnd.randrange(20_000))), "soon", None, str(T0 + timedelta(days=3, microseconds=rnd.randrange(3)))]),
            rnd.choice(["1.5", "-2", "x", "", None, "7"])) for _ in range(2500)]
    raw += [("2020", "hot", None, "1")] * 400 + [("2020", "hot", str(T0), "1")] * 400 + [("2030", None, None, None)]
    df = spark.createDataFrame(raw, "year string, station_id string, timestamp string, reading_value string").repartition(5)
    got = {r.year: r for r in profile.profile(df, S, "year", ["station_id", "reading_value"]).collect()}
    for year in ("2020", "2021", "2030"):
        own = [r[1:] for r in raw if r[0] == year]
        at = {t: datetime.fromisoformat(t) for _, t, _ in own if t and t != "soon"}
        v = [float(x) for *_, x in own if x not in ("x", "", None)]
        seen = {}
        for e, t, _ in own:
            if e is not None and t in at:
                seen.setdefault(e, set()).add(at[t])
        floor = [[int((x - T0.replace(year=1970)) // timedelta(seconds=1)) for x in sorted(ts)] for ts in seen.values()]
        steps = [y - x for f in floor for x, y in zip(f, f[1:])]
        r, keys = got[year], {}
        for e, t, _ in own:
            keys[e, t] = keys.get((e, t), 0) + 1
        assert (r.total_rows, r.stations, r.mean_value and round(r.mean_value, 9), r.min_value, r.max_value) == (
            len(own), len({e for e, *_ in own} - {None}), round(sum(v) / len(v), 9) if v else None, min(v, default=None), max(v, default=None))
        assert (r.duplicate_groups, r.duplicate_extra_rows) == (sum(n > 1 for n in keys.values()), sum(keys.values()) - len(keys))
        assert (r.gaps_over_slot, r.gaps_under_slot, r.max_gap_seconds) == (
            sum(g > 300 for g in steps), sum(0 < g < 300 for g in steps), max(steps, default=None))
        assert (r.negative_values, r.invalid_values, r.invalid_timestamps) == (
            sum(x < 0 for x in v), sum(x in ("x", "") for *_, x in own), sum(t == "soon" for _, t, _ in own))
        assert (r.missing_station_id, r.missing_reading_value) == (sum(not (e or "").strip() for e, *_ in own), sum(not x for *_, x in own))


def test_consistency_lists_are_bounded_and_counts_are_not(spark):
    many = [(f"2020", "a", f"name {i:04d}", None, "1") for i in range(300)] + [("2021", "a", "name 0000", "2", "1"), ("2020", "b", None, None, None)]
    df = spark.createDataFrame(many, "year string, station_id string, station_name string, location_latitude string, location_longitude string")
    got = {r.station_id: r for r in profile.metadata_consistency(profile.metadata_variants(df, S, ["year"]), S, most=3).collect()}
    assert got["a"].distinct_names == 300 and got["a"].names == "name 0000 | name 0001 | name 0002"
    assert got["a"].years_present == "2020,2021" and got["a"].distinct_coordinate_pairs == 2
    assert got["b"].names == "None" and got["b"].coordinates == "(None, None)"
