"""Registered queries: sources, sinks, cleaning, profiles, gaps and validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from gaugeworks.operators import clean, gaps, profile, validate
from gaugeworks.plans import bindings as b
from gaugeworks.plans.registry import query
from gaugeworks.sources import readers, sinks
from gaugeworks.sources.scratch import materialise, scratch_dir

DAY, HOUR = b.DAY, b.HOUR
TEXT = ("station_id", "station_name", "timestamp", "reading_value", "location_latitude", "location_longitude")

# --- sources and sinks ---


@query("S1_read_raw_csv", f"""SELECT {', '.join(f'"{c}"' for c in TEXT)}, count(*) AS rows
FROM (SELECT * REPLACE (nullif(reading_value, '') AS reading_value) FROM dirty) GROUP BY ALL""", "dirty")
def _(spark, sf):
    path = f"{scratch_dir(spark)}/raw"
    b.dirty(spark, sf).select(*TEXT).write.option("header", True).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False).csv(path)
    return readers.read_raw_csv(spark, path, columns=TEXT).groupBy(*TEXT).agg(F.count("*").alias("rows"))


@query("S2_read_series", """SELECT year, count(*) AS rows, sum(rainfall) AS total FROM cleaned GROUP BY year""", "cleaned")
def _(spark, sf):
    root = scratch_dir(spark)
    rows = b.cleaned(spark, sf)
    sinks.write_periods(rows, root)
    # The periods are the table's own, as many as there are years.
    years = [r.year for r in rows.select("year").distinct().collect()]
    found = readers.read_series(spark, root, years, "year=")
    return found.groupBy("year").agg(F.count("*").alias("rows"), F.sum("rainfall").alias("total"))


@query("S3_read_split", """SELECT year, count(*) AS rows, round(sum(future_rainfall_30m), 6) AS total
FROM prepared WHERE split = 'validation' GROUP BY year""", "prepared")
def _(spark, sf):
    path = f"{scratch_dir(spark)}/prepared"
    rows = b.prepared(spark, sf)
    rows.write.partitionBy("split", "year").parquet(path)
    return readers.read_split(spark, path, "validation", rows.schema).groupBy("year").agg(
        F.count("*").alias("rows"), F.sum("future_rainfall_30m").alias("total"))


EXAMPLE = """station_id, prediction_time, hour, month, round(rainfall_previous_5m, 6) AS rainfall_previous_5m,
round(rainfall_previous_30m, 6) AS rainfall_previous_30m, round(rainfall_previous_60m, 6) AS rainfall_previous_60m,
threshold_mm, label"""


@query("S4_adapt_prepared", f"SELECT {EXAMPLE} FROM examples WHERE hour % 5 <> 0", "examples")
def _(spark, sf):
    holes = F.when(F.col("hour") % 5 != 0, F.col("rainfall_previous_5m"))
    return readers.adapt_examples(b.prepared(spark, sf).withColumn("rainfall_previous_5m", holes), b.LABELS)


@query("S4_adapt_examples", f"""SELECT {EXAMPLE}, threshold_mm = 330 AS invalid_example FROM examples
WHERE hour % 5 <> 0""", "examples")
def _(spark, sf):
    old = {v: k for k, v in readers.EXAMPLE_ALIASES.items()}
    value = F.when(F.col("hour") % 5 != 0, F.col("rainfall_previous_60m")).otherwise(F.lit(float("nan")))
    rows = b.examples(spark, sf).withColumn("rainfall_previous_60m", value).withColumnsRenamed(old)
    return readers.adapt_examples(rows, b.LABELS[:3])


@query("S5_write_period", "SELECT year, count(*) AS rows FROM cleaned GROUP BY year", "cleaned")
def _(spark, sf):
    root = scratch_dir(spark)
    rows = b.cleaned(spark, sf)
    sinks.write_periods(rows, root)
    first = rows.agg(F.min("year")).first()[0]
    sinks.write_period(rows.where(F.col("year") == first).drop("year"), root, first, "year=")
    return spark.read.parquet(root).groupBy("year").agg(F.count("*").alias("rows"))


@query("S6_write_new_partitioned", "SELECT split, year, count(*) AS rows FROM prepared GROUP BY split, year", "prepared")
def _(spark, sf):
    return sinks.write_new_partitioned(b.prepared(spark, sf), f"{scratch_dir(spark)}/prepared")


@query("S7_write_sorted", """SELECT station_id, "timestamp", round(rainfall, 6) AS rainfall FROM dense
WHERE station_id IN ('view', 'click') AND "timestamp" >= TIMESTAMP '2024-01-05' AND "timestamp" < TIMESTAMP '2024-01-07'
""", "dense")
def _(spark, sf):
    path = f"{scratch_dir(spark)}/extract"
    subset = clean.extract_subset(b.dense(spark, sf), HOUR, ("view", "click"), "2024-01-05", "2024-01-07")
    return spark.read.parquet(sinks.write_sorted(subset, path, ["station_id", "timestamp"]))


@query("S8_write_summary_csv", """SELECT station_id, year, observed_intervals, recorded_rainfall_mm
FROM station_year""", "station_year")
def _(spark, sf):
    table = b.station_year(spark, sf).select("station_id", "year", "observed_intervals", "recorded_rainfall_mm")
    path = sinks.write_summary_csv(table, f"{scratch_dir(spark)}/summary", ["year", "station_id"])
    return spark.read.schema(table.schema).option("header", True).csv(path)


@query("S13_scored_output_preview", """SELECT station_id, prediction_time, threshold_mm, label, round(p, 6) AS p FROM scores ORDER BY prediction_time, station_id, threshold_mm LIMIT 200""", "scores")
def _(spark, sf):
    rows = b.scores(spark, sf).select("station_id", "prediction_time", "threshold_mm", "label", "p")
    path = sinks.scored_output(rows, f"{scratch_dir(spark)}/scored")
    return sinks.preview(spark.read.parquet(path), 200)


# --- cleaning ---


@query("C1_type_records", """SELECT station_id, station_name, reading_value, "timestamp", year, source_key,
original_timestamp, observation_time, isnan(rainfall) AS value_is_nan,
CASE WHEN NOT isnan(rainfall) AND NOT isinf(rainfall) THEN rainfall END AS rainfall, location_latitude, location_longitude
FROM typed""", "typed")
def _(spark, sf):
    nan = F.isnan("rainfall")
    flag = F.when(F.col("rainfall").isNotNull(), nan)
    finite = F.when(~nan & (F.abs("rainfall") != float("inf")), F.col("rainfall"))
    return b.typed(spark, sf).withColumn("value_is_nan", flag).withColumn("rainfall", finite)


@query("C2_flag_invalid", """SELECT broken_rules, broken_rules <> '' AS invalid, count(*) AS rows FROM (
SELECT concat_ws(',', CASE WHEN station_id IS NULL OR station_id = '' THEN 'invalid_id' END,
  CASE WHEN observation_time IS NULL THEN 'invalid_time' END,
  CASE WHEN rainfall IS NULL OR isnan(rainfall) OR isinf(rainfall) OR rainfall < 0 THEN 'invalid_value' END,
  CASE WHEN location_latitude IS NULL OR NOT location_latitude BETWEEN -90 AND 90 THEN 'invalid_latitude' END,
  CASE WHEN location_longitude IS NULL OR NOT location_longitude BETWEEN -180 AND 180 THEN 'invalid_longitude' END)
  AS broken_rules FROM typed) GROUP BY ALL""", "typed")
def _(spark, sf):
    flagged = clean.flag_invalid(b.typed(spark, sf), clean.record_rules(DAY))
    return flagged.groupBy("broken_rules", "invalid").agg(F.count("*").alias("rows"))


@query("C3_align_to_grid", """SELECT station_id, original_timestamp, observation_time, "timestamp", aligned_epoch,
shift_seconds FROM aligned""", "aligned")
def _(spark, sf):
    return b.aligned(spark, sf).select("station_id", "original_timestamp", "observation_time", "timestamp",
                                       "aligned_epoch", "shift_seconds")


@query("C4_check_offsets", """SELECT event_id, station_id, observation_time, shift_seconds FROM event_slots
WHERE abs(shift_seconds) > 900 OR epoch_us(observation_time) % 1000000 <> 0""", "event_slots")
def _(spark, sf):
    return clean.check_offsets(b.event_slots(spark, sf), 900).select("event_id", "station_id", "observation_time",
                                                                     "shift_seconds")


@query("C5_check_period", """SELECT station_id, "timestamp", year FROM aligned
WHERE year("timestamp") <> CASE WHEN source_key % 1000 = 3 THEN year - 1 ELSE year END""", "aligned")
def _(spark, sf):
    claimed = F.when(F.col("source_key") % 1000 == 3, F.col("year") - 1).otherwise(F.col("year"))
    return clean.check_period(b.aligned(spark, sf), DAY, claimed).select("station_id", "timestamp", "year")


@query("C6_collision_stats", """SELECT count(*) FILTER (n > 1) AS "groups",
CAST(coalesce(sum(n - 1) FILTER (n > 1), 0) AS BIGINT) AS extras, count(*) FILTER (n > 1 AND d > 1) AS conflicts
FROM (SELECT count(*) AS n, count(DISTINCT rainfall) AS d FROM event_slots GROUP BY station_id, "timestamp")""",
       "event_slots")
def _(spark, sf):
    return clean.collision_stats(b.event_slots(spark, sf), HOUR)


@query("C7_dedupe_best", "SELECT * FROM cleaned", "cleaned")
def _(spark, sf):
    return b.cleaned(spark, sf)


@query("C7_dedupe_events", """SELECT event_id, station_id, observation_time, rainfall, "timestamp" FROM (
SELECT *, row_number() OVER (PARTITION BY station_id, aligned_epoch ORDER BY abs(shift_seconds), observation_time,
event_id) AS rn FROM event_slots) WHERE rn = 1""", "event_slots")
def _(spark, sf):
    return clean.dedupe_best(b.event_slots(spark, sf), HOUR, ["event_id"]).drop("original_timestamp")


VARIANTS = """SELECT trim(station_id) AS station_id, regexp_replace(trim(station_name), '\\s+', ' ', 'g') AS original_name,
count(*) AS observations FROM dirty WHERE trim(station_id) <> '' AND trim(station_name) <> '' GROUP BY ALL"""
CANON = f"""SELECT v.station_id, original_name, standard_name, observations,
CAST(original_name <> standard_name AS INTEGER) AS name_changed FROM ({VARIANTS}) v JOIN (
SELECT station_id, original_name AS standard_name FROM (SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY
  lower(original_name) = lower(station_id), observations DESC, lower(original_name), original_name) AS rn
  FROM ({VARIANTS})) WHERE rn = 1) c USING (station_id)"""


@query("C8_name_variants", VARIANTS, "dirty")
def _(spark, sf):
    return clean.name_variants(b.dirty(spark, sf), DAY)


def _mapping(spark, sf):
    return clean.canonical_names(clean.name_variants(b.dirty(spark, sf), DAY), DAY)


@query("C9_canonical_names", CANON, "dirty")
def _(spark, sf):
    return _mapping(spark, sf)


NAMED = f"""SELECT a.* EXCLUDE (station_name), standard_name AS station_name, standard_name IS NULL AS unmapped,
coalesce(a.station_name <> standard_name, false) AS name_changed
FROM aligned a LEFT JOIN (SELECT DISTINCT station_id, standard_name FROM ({CANON})) USING (station_id)"""


def _named(spark, sf):
    # Written first, so that its size is known when the readings are joined.
    names = materialise(clean.name_dimension(_mapping(spark, sf), DAY), "names")
    return clean.apply_lookup(b.aligned(spark, sf), names, DAY)


@query("C10_apply_lookup", f"""SELECT station_id, station_name, name_changed, unmapped, count(*) AS rows FROM ({NAMED})
GROUP BY ALL""", "aligned", "dirty")
def _(spark, sf):
    return _named(spark, sf).groupBy("station_id", "station_name", "name_changed", "unmapped").agg(
        F.count("*").alias("rows"))


@query("C11_cleaning_summary", f"""SELECT year, CAST(sum(n) AS BIGINT) AS input_rows,
CAST(sum(moved) AS BIGINT) AS shifted_timestamps, count(*) FILTER (n > 1) AS alignment_collision_groups,
CAST(sum(n - 1) AS BIGINT) AS collision_rows_removed, CAST(sum(renamed) AS BIGINT) AS station_name_rows_standardized,
count(*) AS output_rows FROM (SELECT year, count(*) AS n, count(*) FILTER (shift_seconds <> 0) AS moved,
count(*) FILTER (name_changed) AS renamed FROM ({NAMED}) GROUP BY year, station_id, aligned_epoch) GROUP BY year""",
       "aligned", "dirty")
def _(spark, sf):
    return clean.cleaning_summary(_named(spark, sf), DAY)


@query("C12_normalize", 'SELECT station_id, "timestamp" AS prediction_time, rainfall FROM cleaned', "cleaned")
def _(spark, sf):
    return clean.normalize(b.cleaned(spark, sf), DAY)


ROWS_BAD = """SELECT station_id, observation_time AS t, count(*) AS n,
count(*) FILTER (station_id IS NULL OR trim(station_id) = '') AS invalid_id,
count(*) FILTER (observation_time IS NULL) AS null_time,
count(*) FILTER (rainfall IS NULL OR isnan(rainfall) OR isinf(rainfall) OR rainfall < 0) AS invalid_value,
count(*) FILTER (epoch_us(observation_time) % 86400000000 <> 0) AS off_grid,
count(*) FILTER (NOT year(observation_time) BETWEEN {low} AND {high}) AS outside_years
FROM typed GROUP BY station_id, observation_time"""


def _series_sql(low: int, high: int) -> str:
    rules = ["invalid_id", "null_time", "invalid_value", "off_grid", "outside_years"]
    parts = [f"SELECT '{r}' AS issue, CAST(sum({r}) AS BIGINT) AS failures FROM k" for r in rules]
    parts.append("SELECT 'duplicate_rows', CAST(sum(n - 1) AS BIGINT) FROM k")
    return (f"SELECT * FROM (WITH k AS ({ROWS_BAD.format(low=low, high=high)}) "
            + " UNION ALL ".join(parts) + ") WHERE failures > 0")


def _observed(spark, sf):
    return b.typed(spark, sf).drop("timestamp").withColumnRenamed("observation_time", "timestamp")


@query("C13_validate_series", _series_sql(1996, 2000), "typed")
def _(spark, sf):
    return clean.validate_series(_observed(spark, sf), DAY, (1996, 2000))


@query("C14_validate_year", _series_sql(1997, 1997), "typed")
def _(spark, sf):
    return clean.validate_series(_observed(spark, sf), DAY, year=1997, nonempty=True)


@query("C15_subset_coverage", """SELECT station_id, count(*) AS rows, min("timestamp") AS first_time,
max("timestamp") AS last_time, count(*) FILTER (rainfall > 0) AS wet_readings, count(*) = 48 AS complete FROM dense
WHERE station_id IN ('view', 'error') AND "timestamp" >= TIMESTAMP '2024-01-10' AND "timestamp" < TIMESTAMP '2024-01-12'
GROUP BY station_id""", "dense")
def _(spark, sf):
    subset = clean.extract_subset(b.dense(spark, sf), HOUR, ("view", "error"), "2024-01-10", "2024-01-12")
    return clean.subset_coverage(subset, HOUR, 48)


# --- profiles and diagnostics ---

PARSED = """SELECT *, TRY_CAST(reading_value AS DOUBLE) AS v, TRY_CAST("timestamp" AS TIMESTAMP) AS t FROM dirty"""
BASIC = """count(*) AS total_rows, count(DISTINCT station_id) AS stations, min(t) AS first_timestamp,
max(t) AS last_timestamp, min(CASE WHEN v IS NOT NULL AND NOT isnan(v) THEN v END) AS min_value,
count(*) FILTER (v < 0 AND NOT isnan(v)) AS negative_values, count(*) FILTER (isnan(v) OR isinf(v)) AS nonfinite_values,
count(*) FILTER (reading_value IS NOT NULL AND v IS NULL) AS invalid_values,
count(*) FILTER ("timestamp" IS NOT NULL AND t IS NULL) AS invalid_timestamps"""
MISSING = ", ".join(f"""count(*) FILTER ("{c}" IS NULL OR trim("{c}") = '') AS missing_{c}""" for c in TEXT)
DUPLICATE = """SELECT year, count(*) FILTER (n > 1) AS duplicate_groups, CAST(sum(n - 1) AS BIGINT) AS duplicate_extra_rows
FROM (SELECT year, station_id, "timestamp", count(*) AS n FROM dirty GROUP BY ALL) GROUP BY year"""
GAPS = f"""SELECT year, count(*) FILTER (g > 86400) AS gaps_over_slot, count(*) FILTER (g > 0 AND g < 86400)
AS gaps_under_slot, max(g) AS max_gap_seconds FROM (SELECT year, epoch_us(t) // 1000000 - epoch_us(lag(t) OVER
(PARTITION BY year, station_id ORDER BY t)) // 1000000 AS g FROM (SELECT DISTINCT year, station_id, t FROM ({PARSED})
WHERE t IS NOT NULL AND station_id IS NOT NULL)) GROUP BY year"""


def _profiled(df):
    """The mean and maximum of a column holding NaN are NaN in both engines and carry nothing."""
    return b.zone_free(df).drop("mean_value", "max_value")


@query("P1_profile_basic", f"SELECT {BASIC} FROM ({PARSED})", "dirty")
def _(spark, sf):
    return _profiled(profile.profile_basic(b.dirty(spark, sf), DAY))


@query("P1_profile_clean_values", """SELECT year, count(*) AS total_rows, count(DISTINCT station_id) AS stations,
min(observation_time) AS first_timestamp, max(observation_time) AS last_timestamp, min(rainfall) AS min_value,
max(rainfall) AS max_value, round(avg(rainfall), 6) AS mean_value, 0::BIGINT AS negative_values,
0::BIGINT AS nonfinite_values, 0::BIGINT AS invalid_values, 0::BIGINT AS invalid_timestamps FROM aligned
GROUP BY year""", "aligned")
def _(spark, sf):
    return b.zone_free(profile.profile_basic(b.records(spark, sf), DAY, ["year"]))


@query("P2_profile_missing", f"SELECT {MISSING} FROM dirty", "dirty")
def _(spark, sf):
    return profile.profile_missing(b.dirty(spark, sf), TEXT)


@query("P3_duplicate_keys", DUPLICATE, "dirty")
def _(spark, sf):
    return profile.duplicate_keys(b.dirty(spark, sf), DAY.key, ["year"])


@query("P4_gap_totals", GAPS, "dirty")
def _(spark, sf):
    return profile.gap_totals(b.dirty(spark, sf), DAY, ["year"])


@query("P5_profile_by_period", f"""SELECT * FROM (SELECT year, {BASIC}, {MISSING} FROM ({PARSED}) GROUP BY year)
LEFT JOIN ({DUPLICATE}) USING (year) LEFT JOIN ({GAPS}) USING (year)""", "dirty")
def _(spark, sf):
    return _profiled(profile.profile(b.dirty(spark, sf), DAY, "year", TEXT))


CLEAN = """SELECT year, count(*) AS total_rows, count(DISTINCT station_id) AS stations, min(t) AS first_timestamp, max(t) AS last_timestamp,
min(v) AS min_value, max(v) AS max_value, round(avg(v), 6) AS mean_value, count(*) FILTER (v < 0) AS negative_values, 0::BIGINT AS nonfinite_values,
count(*) FILTER (reading_value IS NOT NULL AND v IS NULL) AS invalid_values,
count(*) FILTER ("timestamp" IS NOT NULL AND t IS NULL) AS invalid_timestamps"""
FINITE = f"SELECT * FROM ({PARSED}) WHERE v IS NULL OR isfinite(v)"


@query("P5_profile_finite_values", f"""SELECT * FROM ({CLEAN}, {MISSING} FROM ({FINITE}) GROUP BY year)
LEFT JOIN ({DUPLICATE.replace("FROM dirty GROUP", f"FROM ({FINITE}) GROUP")}) USING (year)
LEFT JOIN ({GAPS.replace(f"FROM ({PARSED})", f"FROM ({FINITE})")}) USING (year)""", "dirty")
def _(spark, sf):
    """Mean and maximum too: rows with values that are no finite numbers are left out."""
    v = F.col("reading_value").try_cast("double")
    rows = b.dirty(spark, sf).where(v.isNull() | ~(F.isnan(v) | (F.abs(v) == float("inf"))))
    return b.zone_free(profile.profile(rows, DAY, "year", TEXT))


OFFSETS = """SELECT *, es % 86400 AS offset_seconds, (es * 2 + 86400) // 172800 * 86400 AS aligned_epoch FROM (
SELECT *, epoch_us(t) // 1000000 AS es FROM (SELECT *, TRY_CAST("timestamp" AS TIMESTAMP) AS t,
  TRY_CAST(reading_value AS DOUBLE) AS v FROM records) WHERE t IS NOT NULL AND station_id IS NOT NULL)"""
GROUPS = f"""SELECT year, station_id, aligned_epoch, count(*) AS records, count(DISTINCT v) AS distinct_values,
min(v) AS min_value, max(v) AS max_value, min(t) AS first_original_ts, max(t) AS last_original_ts
FROM ({OFFSETS}) GROUP BY year, station_id, aligned_epoch HAVING count(*) > 1"""


def _offsets(spark, sf):
    return b.zone_free(profile.with_offsets(b.records(spark, sf), DAY))


@query("D1_alignment_summary", f"""SELECT year, count(*) AS valid_rows, count(*) FILTER (offset_seconds <> 0) AS off_grid_rows,
count(*) FILTER (aligned_epoch <> es) AS shifted_rows, max(abs(aligned_epoch - es)) AS max_abs_shift_seconds
FROM ({OFFSETS}) GROUP BY year""", "records")
def _(spark, sf):
    return profile.alignment_summary(_offsets(spark, sf), ["year"])


@query("D2_offset_histogram", f"SELECT year, offset_seconds, count(*) AS rows FROM ({OFFSETS}) GROUP BY ALL", "records")
def _(spark, sf):
    return profile.offset_histogram(_offsets(spark, sf), ["year"])


@query("D3_collision_groups", GROUPS, "records")
def _(spark, sf):
    return profile.collision_groups(_offsets(spark, sf), DAY, ["year"])


@query("D3_collision_totals", f"""SELECT year, count(*) AS collision_groups, CAST(sum(records - 1) AS BIGINT)
AS extra_rows_if_aligned, count(*) FILTER (distinct_values > 1) AS conflicting_groups FROM ({GROUPS}) GROUP BY year""",
       "records")
def _(spark, sf):
    return profile.collision_totals(profile.collision_groups(_offsets(spark, sf), DAY, ["year"]), ["year"])


@query("D4_collision_examples", f"""SELECT * FROM ({GROUPS}) QUALIFY row_number() OVER (PARTITION BY year
ORDER BY records DESC, station_id, aligned_epoch) <= 100""", "records")
def _(spark, sf):
    groups = profile.collision_groups(_offsets(spark, sf), DAY, ["year"])
    return profile.collision_examples(groups, DAY, 100, ["year"])


META = """SELECT year, station_id, station_name, location_latitude, location_longitude, count(*) AS observations
FROM records GROUP BY ALL"""


@query("D5_metadata_variants", META, "records")
def _(spark, sf):
    return profile.metadata_variants(b.records(spark, sf), DAY, ["year"])


@query("D6_metadata_consistency", f"""SELECT station_id,
array_to_string(list_sort(list(DISTINCT CAST(year AS VARCHAR))), ',') AS years_present,
CAST(count(DISTINCT station_name) AS INTEGER) AS distinct_names,
CAST(count(DISTINCT (location_latitude, location_longitude)) AS INTEGER) AS distinct_coordinate_pairs,
array_to_string(list_sort(list(DISTINCT station_name)), ' | ') AS names,
array_to_string(list_sort(list(DISTINCT '(' || location_latitude || ', ' || location_longitude || ')')), ' | ') AS coordinates
FROM ({META}) GROUP BY station_id""", "records")
def _(spark, sf):
    return profile.metadata_consistency(profile.metadata_variants(b.records(spark, sf), DAY, ["year"]), DAY)


# --- gaps ---


@query("G1_intervals", "SELECT year, station_id, prev_ts, ts, gap_seconds FROM record_pairs", "record_pairs")
def _(spark, sf):
    return gaps.intervals(b.aligned(spark, sf), DAY, time="observation_time", within=["year"])


@query("G2_missing_slots", """SELECT station_id, prev_ts, ts, gap_seconds, estimated_missing_slots
FROM event_pairs""", "event_pairs")
def _(spark, sf):
    return gaps.missing_slots(gaps.intervals(b.events_(spark, sf), b.FIVE_MINUTES), b.FIVE_MINUTES)


@query("G3_gap_class", """SELECT station_id, gap_class, count(*) AS rows, min(gap_seconds) AS low,
max(gap_seconds) AS high FROM event_pairs GROUP BY ALL""", "event_pairs")
def _(spark, sf):
    return b.event_pairs(spark, sf).groupBy("station_id", "gap_class").agg(
        F.count("*").alias("rows"), F.min("gap_seconds").alias("low"), F.max("gap_seconds").alias("high"))


def _distribution_sql(source: str, key: str) -> str:
    names = ", ".join(f"'{c}'" for c in gaps.GAP_CLASSES)
    return f"""SELECT {key}, c.gap_class, count(p.gap_class) AS intervals,
CAST(coalesce(sum(estimated_missing_slots), 0) AS BIGINT) AS estimated_missing_slots
FROM (SELECT {key}, gap_class FROM (SELECT DISTINCT {key} FROM {source}), (SELECT unnest([{names}]) AS gap_class)) c
LEFT JOIN {source} p USING ({key}, gap_class) GROUP BY ALL"""


@query("G4_gap_distribution", _distribution_sql("event_pairs", "station_id"), "event_pairs")
def _(spark, sf):
    return gaps.gap_distribution(b.event_pairs(spark, sf), ["station_id"])


@query("G4_gap_distribution_annual", _distribution_sql("record_pairs", "year"), "record_pairs")
def _(spark, sf):
    return gaps.gap_distribution(b.record_pairs(spark, sf), ["year"])


SPAN_RAW = """SELECT p.*, gaps_over_slot, estimated_missing_slots, max_gap_seconds,
(epoch_us(last_ts) // 1000000 - epoch_us(first_ts) // 1000000) // 86400 + 1 AS expected_slots_span,
round(observed_unique / ((epoch_us(last_ts) // 1000000 - epoch_us(first_ts) // 1000000) // 86400 + 1), 6) AS coverage_span_approx
FROM (SELECT year, station_id, count(*) AS observed_unique, min(ts) AS first_ts, max(ts) AS last_ts
  FROM (SELECT DISTINCT year, station_id, observation_time AS ts FROM aligned) GROUP BY ALL) p
LEFT JOIN (SELECT year, station_id, count(*) FILTER (gap_seconds > 86400) AS gaps_over_slot,
  CAST(sum(estimated_missing_slots) AS BIGINT) AS estimated_missing_slots, max(gap_seconds) AS max_gap_seconds
  FROM record_pairs GROUP BY ALL) g USING (year, station_id)"""


@query("G5_span_coverage_raw", SPAN_RAW, "aligned", "record_pairs")
def _(spark, sf):
    pairs, ends = gaps.intervals_and_ends(b.aligned(spark, sf), DAY, time="observation_time", within=["year"])
    return gaps.span_coverage_raw(ends, gaps.missing_slots(pairs, DAY), DAY, ["year"])


MONTHLY_GAPS = """SELECT year, CAST(month(ts) AS INTEGER) AS month, count(*) AS gaps_over_slot,
CAST(sum(estimated_missing_slots) AS BIGINT) AS estimated_missing_slots FROM record_pairs WHERE gap_seconds > 86400 GROUP BY ALL"""


@query("G6_monthly_gaps", MONTHLY_GAPS, "record_pairs")
def _(spark, sf):
    return gaps.monthly_gaps(b.record_pairs(spark, sf), DAY, ["year"])


@query("G7_longest_gaps", """SELECT year, station_id, prev_ts, ts, gap_seconds, estimated_missing_slots FROM record_pairs
WHERE gap_seconds > 86400 QUALIFY row_number() OVER (PARTITION BY year ORDER BY gap_seconds DESC, station_id, ts) <= 20""",
       "record_pairs")
def _(spark, sf):
    return gaps.longest_gaps(b.record_pairs(spark, sf), DAY, 20, ["year"])


@query("G8_shortest_intervals", """SELECT station_id, prev_ts, ts, gap_seconds FROM event_pairs WHERE gap_seconds < 300
ORDER BY gap_seconds, station_id, ts LIMIT 150""", "event_pairs")
def _(spark, sf):
    return gaps.shortest_intervals(b.event_pairs(spark, sf), b.FIVE_MINUTES, 150)


# --- validation ---

RULES = ("invalid_station_ids", "invalid_station_names", "null_timestamps", "wrong_year", "off_grid",
         "invalid_rainfall", "invalid_coordinates")
STRUCTURE = """SELECT year, count(*) AS rows, count(DISTINCT station_id) AS stations,
min(observation_time) AS first_timestamp, max(observation_time) AS last_timestamp,
count(*) FILTER (station_id IS NULL OR trim(station_id) = '') AS invalid_station_ids,
count(*) FILTER (station_name IS NULL OR trim(station_name) = '') AS invalid_station_names,
count(*) FILTER (observation_time IS NULL) AS null_timestamps,
count(*) FILTER (year(observation_time) <> year) AS wrong_year,
count(*) FILTER (epoch_us(observation_time) % 86400000000 <> 0) AS off_grid,
count(*) FILTER (rainfall IS NULL OR isnan(rainfall) OR isinf(rainfall) OR rainfall < 0) AS invalid_rainfall,
count(*) FILTER (location_latitude IS NULL OR NOT location_latitude BETWEEN -90 AND 90
  OR location_longitude IS NULL OR NOT location_longitude BETWEEN -180 AND 180) AS invalid_coordinates
FROM typed GROUP BY year"""
EXTRAS = """SELECT year, CAST(sum(n - 1) AS BIGINT) AS duplicate_extra_rows
FROM (SELECT year, station_id, observation_time, count(*) AS n FROM typed GROUP BY ALL) GROUP BY year"""


@query("V1_structural_counts", STRUCTURE, "typed")
def _(spark, sf):
    return validate.structural_counts(_observed(spark, sf), DAY)


@query("V2_duplicate_extras", EXTRAS, "typed")
def _(spark, sf):
    return validate.duplicate_extras(_observed(spark, sf), DAY.key, ["year"])


ACTUAL = "SELECT year, count(*) AS rows FROM cleaned GROUP BY year"
EXPECTED = """SELECT year, count(*) + CASE WHEN year = 1996 THEN 1 ELSE 0 END AS expected_output_rows FROM (
SELECT DISTINCT year, station_id, aligned_epoch FROM aligned) WHERE year <> 1999 GROUP BY year"""
COMPARED = f"""SELECT year, rows, expected_output_rows, CASE WHEN expected_output_rows IS NULL THEN 'not_checked'
ELSE CAST(rows = expected_output_rows AS VARCHAR) END AS row_count_matches_summary
FROM ({ACTUAL}) LEFT JOIN ({EXPECTED}) USING (year)"""


def _row_check(spark, sf):
    """Against a summary that misses one year and is wrong by one in another."""
    actual = b.cleaned(spark, sf).groupBy("year").agg(F.count("*").alias("rows"))
    slots = b.aligned(spark, sf).select("year", "station_id", "aligned_epoch").distinct()
    expected = slots.where(F.col("year") != 1999).groupBy("year").agg(
        (F.count("*") + F.when(F.col("year") == 1996, 1).otherwise(0)).alias("output_rows"))
    return validate.row_count_check(actual, expected)


@query("V3_row_count_check", COMPARED, "cleaned", "aligned")
def _(spark, sf):
    return _row_check(spark, sf)


@query("V4_issues", "SELECT * FROM (WITH s AS (" + STRUCTURE + "), d AS (" + EXTRAS + ") "
       + " UNION ALL ".join(f"SELECT year, '{r}' AS issue, {r} AS failures FROM s" for r in RULES)
       + " UNION ALL SELECT year, 'duplicate_extra_rows', duplicate_extra_rows FROM d) WHERE failures > 0", "typed")
def _(spark, sf):
    rows = _observed(spark, sf)
    counts = validate.structural_counts(rows, DAY).join(validate.duplicate_extras(rows, DAY.key, ["year"]), "year")
    return validate.validation_issues(counts)


@query("V5_span_coverage", """SELECT *, (epoch_us(last_time) - epoch_us(first_time)) // 86400000000 + 1 AS expected_between_first_last,
greatest(0, (epoch_us(last_time) - epoch_us(first_time)) // 86400000000 + 1 - observed_intervals) AS missing_intervals,
round(100.0::DOUBLE * observed_intervals / ((epoch_us(last_time) - epoch_us(first_time)) // 86400000000 + 1), 4) AS coverage_pct
FROM (SELECT year, station_id, min(station_name) AS station_name, count(*) AS observed_intervals,
min("timestamp") AS first_time, max("timestamp") AS last_time FROM cleaned GROUP BY year, station_id)""", "cleaned")
def _(spark, sf):
    return gaps.span_coverage(b.cleaned(spark, sf), DAY, ["year"])


@query("V6_gap_size_distribution", """SELECT year, station_id, count(*) AS gap_events, CAST(sum(m) AS BIGINT) AS missing_intervals,
max(g) AS longest_gap_seconds, count(*) FILTER (m = 1) AS one_missing, count(*) FILTER (m BETWEEN 2 AND 5)
AS two_to_five_missing, count(*) FILTER (m >= 6) AS six_plus_missing FROM (SELECT *, g // 86400 - 1 AS m FROM (
SELECT year, station_id, (epoch_us("timestamp") - epoch_us(lag("timestamp") OVER (PARTITION BY year, station_id
ORDER BY "timestamp"))) // 1000000 AS g FROM cleaned) WHERE g > 86400) GROUP BY year, station_id""", "cleaned")
def _(spark, sf):
    return gaps.gap_size_distribution(b.cleaned(spark, sf), DAY, ["year"])


@query("V7_metadata_exceptions", """SELECT * FROM (SELECT year, station_id, count(DISTINCT station_name) AS distinct_names,
count(DISTINCT row(location_latitude, location_longitude)) AS coordinate_pairs FROM aligned GROUP BY year, station_id)
WHERE distinct_names > 1 OR coordinate_pairs > 1""", "aligned")
def _(spark, sf):
    return validate.metadata_exceptions(b.aligned(spark, sf), DAY, ["year"])

