"""The given tables read as observation series, each with its SQL twin.

``records``  text records of line items: supplier as station, ship date off by a second.
``dirty``    the same with unusable ids, times, values and coordinates.
``clean``    records aligned to days with one row per station and day.
``daily``    nation by day, whole-number amounts, seven years.
``events_``  event readings with microsecond times; ``dense`` their hourly means.
``scores``   pseudo-probabilities for evaluation without a model.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gaugeworks.operators import clean, features, gaps, summaries
from gaugeworks.plans.registry import fragment
from gaugeworks.spec import SeriesSpec, SplitCuts

DAY = SeriesSpec(slot_seconds=86_400)
HOUR = SeriesSpec(slot_seconds=3_600)
FIVE_MINUTES = SeriesSpec()
CUTS = SplitCuts("2024-01-19 00:00:00", "2024-01-25 00:00:00", "2024-01-31 00:00:00")
LABELS = (250.0, 280.0, 300.0, 330.0)
EXCEED = (0.0, 10.0, 20.0, 40.0, 60.0)
EDGES = (0.0, 2.0, 5.0, 10.0, 15.0, 20.0, 30.0, 40.0, 60.0, 100.0)
TAILS = (0.5, 0.9, 0.95, 0.99, 0.999)
YEARS = tuple(range(1995, 2002))
MAP_YEARS = (1997, 1998, 1999, 2000)
COVERAGE = (40.0, 60.0)
SCORE_LABELS = (5.0, 35.0, 70.0, 115.0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _case(c: Column, options: dict[int, Column], otherwise: Column) -> Column:
    out = None
    for k, v in options.items():
        out = F.when(c == k, v) if out is None else out.when(c == k, v)
    return out.otherwise(otherwise)


def _place(key: str) -> tuple[Column, Column]:
    k = F.col(key)
    lat = F.concat(F.lit("1."), F.lpad((F.pmod(k, F.lit(97)) * 20 + 2000).cast("string"), 4, "0"))
    lon = F.concat(F.lit("103."), F.lpad((F.pmod(k, F.lit(89)) * 40 + 6000).cast("string"), 4, "0"))
    return lat, lon


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = table(spark, sf_dir, "lineitem")
    key, order = F.col("l_suppkey").cast("string"), F.col("l_orderkey")
    plain = F.concat(F.lit("Station "), key)
    name = _case(F.pmod(order, F.lit(7)), {0: F.upper(plain), 1: F.concat(F.lit("Station  "), key),
                                           2: F.concat(F.lit("S"), key)}, plain)
    time = F.timestamp_add("SECOND", F.pmod(order, F.lit(3)) - 1, F.col("l_shipdate"))
    lat, lon = _place("l_suppkey")
    moved = F.concat(F.lit("1."), F.lpad((F.pmod(F.col("l_suppkey"), F.lit(97)) * 20 + 2010).cast("string"), 4, "0"))
    value = F.greatest(F.col("l_quantity") - 25, F.lit(0.0)).cast("decimal(9,1)").cast("string")
    return line.select(
        F.concat(F.lit("S"), key).alias("station_id"), name.alias("station_name"),
        F.date_format(time, "yyyy-MM-dd HH:mm:ss").alias("timestamp"), value.alias("reading_value"),
        F.when(F.pmod(order, F.lit(4999)) == 7, moved).otherwise(lat).alias("location_latitude"),
        lon.alias("location_longitude"), F.year("l_shipdate").alias("year"), order.alias("source_key"))


fragment("records", """
SELECT 'S' || CAST(l_suppkey AS VARCHAR) AS station_id,
  CASE l_orderkey % 7 WHEN 0 THEN upper('Station ' || CAST(l_suppkey AS VARCHAR))
    WHEN 1 THEN 'Station  ' || CAST(l_suppkey AS VARCHAR) WHEN 2 THEN 'S' || CAST(l_suppkey AS VARCHAR)
    ELSE 'Station ' || CAST(l_suppkey AS VARCHAR) END AS station_name,
  strftime(l_shipdate + to_seconds((l_orderkey % 3) - 1), '%Y-%m-%d %H:%M:%S') AS "timestamp",
  CAST(CAST(greatest(l_quantity - 25, 0) AS DECIMAL(9,1)) AS VARCHAR) AS reading_value,
  '1.' || lpad(CAST((l_suppkey % 97) * 20 + CASE WHEN l_orderkey % 4999 = 7 THEN 2010 ELSE 2000 END AS VARCHAR), 4, '0')
    AS location_latitude,
  '103.' || lpad(CAST((l_suppkey % 89) * 40 + 6000 AS VARCHAR), 4, '0') AS location_longitude,
  CAST(year(l_shipdate) AS INTEGER) AS year, l_orderkey AS source_key
FROM lineitem""")


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("source_key")
    none = F.lit(None).cast("string")
    return records(spark, sf_dir).withColumns({
        "station_id": _case(F.pmod(k, F.lit(83)), {0: F.lit("  "), 1: F.concat(F.lit(" "), "station_id", F.lit(" ")),
                                                   2: none}, F.col("station_id")),
        "timestamp": _case(F.pmod(k, F.lit(89)), {0: F.lit("not a time"), 1: none}, F.col("timestamp")),
        "reading_value": _case(F.pmod(k, F.lit(97)), {0: F.lit("bad"), 1: F.lit("NaN"), 2: F.lit(""), 3: F.lit("-1.5"),
                                                      4: none, 5: F.lit("Infinity")}, F.col("reading_value")),
        "location_latitude": _case(F.pmod(k, F.lit(79)), {0: F.lit("123.4"), 1: F.lit("?")},
                                   F.col("location_latitude"))})


fragment("dirty", """
SELECT CASE source_key % 83 WHEN 0 THEN '  ' WHEN 1 THEN ' ' || station_id || ' ' WHEN 2 THEN NULL
    ELSE station_id END AS station_id, station_name,
  CASE source_key % 89 WHEN 0 THEN 'not a time' WHEN 1 THEN NULL ELSE "timestamp" END AS "timestamp",
  CASE source_key % 97 WHEN 0 THEN 'bad' WHEN 1 THEN 'NaN' WHEN 2 THEN '' WHEN 3 THEN '-1.5' WHEN 4 THEN NULL
    WHEN 5 THEN 'Infinity' ELSE reading_value END AS reading_value,
  CASE source_key % 79 WHEN 0 THEN '123.4' WHEN 1 THEN '?' ELSE location_latitude END AS location_latitude,
  location_longitude, year, source_key
FROM records""", "records")
fragment("typed", """
SELECT trim(station_id) AS station_id, station_name, "timestamp", reading_value, year, source_key,
  "timestamp" AS original_timestamp, TRY_CAST("timestamp" AS TIMESTAMP) AS observation_time,
  TRY_CAST(reading_value AS DOUBLE) AS rainfall, TRY_CAST(location_latitude AS DOUBLE) AS location_latitude,
  TRY_CAST(location_longitude AS DOUBLE) AS location_longitude
FROM dirty""", "dirty")


def zone_free(df: DataFrame) -> DataFrame:
    """Session-zone timestamps to their wall clock, as the given tables have them."""
    return df.select(*[F.col(c).cast("timestamp_ntz").alias(c) if t == "timestamp" else F.col(c) for c, t in df.dtypes])


def typed(spark: SparkSession, sf_dir: str, source=dirty) -> DataFrame:
    return zone_free(clean.type_records(source(spark, sf_dir), DAY))


def aligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.align_to_grid(typed(spark, sf_dir, records), DAY)


fragment("aligned", """
SELECT station_id, station_name, reading_value, year, source_key, original_timestamp, observation_time, rainfall,
  location_latitude, location_longitude, aligned_epoch, aligned_epoch - es AS shift_seconds,
  make_timestamp(aligned_epoch * 1000000) AS "timestamp"
FROM (SELECT *, ((es * 2 + 86400) // 172800) * 86400 AS aligned_epoch FROM (
  SELECT station_id, station_name, reading_value, year, source_key, "timestamp" AS original_timestamp,
    CAST("timestamp" AS TIMESTAMP) AS observation_time, CAST(reading_value AS DOUBLE) AS rainfall,
    CAST(location_latitude AS DOUBLE) AS location_latitude, CAST(location_longitude AS DOUBLE) AS location_longitude,
    epoch_us(CAST("timestamp" AS TIMESTAMP)) // 1000000 AS es FROM records))""", "records")

SOURCE_COLUMNS = ("station_id", "station_name", "timestamp", "reading_value", "location_latitude",
                  "location_longitude", "year", "source_key")


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = aligned(spark, sf_dir)
    return clean.dedupe_best(rows, DAY, clean.keep_best_order(DAY, SOURCE_COLUMNS))


fragment("cleaned", """
SELECT * EXCLUDE (rn, aligned_epoch, shift_seconds) FROM (
  SELECT *, row_number() OVER (PARTITION BY station_id, aligned_epoch ORDER BY abs(shift_seconds),
    original_timestamp, reading_value NULLS LAST, source_key NULLS LAST, year NULLS LAST,
    location_latitude NULLS LAST, location_longitude NULLS LAST, station_name) AS rn
  FROM aligned) WHERE rn = 1""", "aligned")


def nation_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line readings of the nations, with the coordinates of the supplier."""
    line = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_shipdate", "l_quantity")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    lat, lon = _place("l_suppkey")
    joined = (line.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
              .join(nation, F.col("s_nationkey") == F.col("n_nationkey")))
    return joined.select(F.col("n_name").alias("station_id"), F.concat(F.lit("Net "), "n_name").alias("station_name"),
                         F.col("l_shipdate").alias("timestamp"),
                         F.greatest(F.col("l_quantity") - 25, F.lit(0.0)).alias("rainfall"),
                         lat.cast("double").alias("location_latitude"), lon.cast("double").alias("location_longitude"))


fragment("nation_lines", """
SELECT n_name AS station_id, 'Net ' || n_name AS station_name, l_shipdate AS "timestamp",
  greatest(l_quantity - 25, 0) AS rainfall,
  CAST('1.' || lpad(CAST((l_suppkey % 97) * 20 + 2000 AS VARCHAR), 4, '0') AS DOUBLE) AS location_latitude,
  CAST('103.' || lpad(CAST((l_suppkey % 89) * 40 + 6000 AS VARCHAR), 4, '0') AS DOUBLE) AS location_longitude
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey""")


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = nation_lines(spark, sf_dir).groupBy("station_id", "timestamp").agg(F.sum("rainfall").alias("rainfall"))
    return summaries.calendar_cols(rows, "timestamp")


fragment("daily", """
SELECT station_id, "timestamp", sum(rainfall) AS rainfall, CAST(year("timestamp") AS INTEGER) AS year,
  CAST(month("timestamp") AS INTEGER) AS month, CAST(hour("timestamp") AS INTEGER) AS hour
FROM nation_lines GROUP BY station_id, "timestamp" """, "nation_lines")


def metrics_sql(by: str, source: str, thresholds=EXCEED) -> str:
    keys = f"{by}," if by else ""
    names = [summaries.label_of(t) for t in thresholds]
    counts = ",".join(f"count(*) FILTER (rainfall > {t}) AS exceed_{n}_mm_intervals" for t, n in zip(thresholds, names))
    parts = ",".join(f"round(exceed_{n}_mm_intervals / observed_intervals, 6) AS exceed_{n}_mm_fraction" for n in names)
    group = f"GROUP BY {by}" if by else ""
    return f"""SELECT *, round(rainy_intervals / observed_intervals, 6) AS rainy_fraction, {parts} FROM (
SELECT {keys} count(*) AS observed_intervals, sum(rainfall) AS recorded_rainfall_mm,
  round(sum(rainfall) / count(*), 6) AS mean_mm_per_observed_interval,
  count(*) FILTER (rainfall > 0) AS rainy_intervals,
  round(avg(CASE WHEN rainfall > 0 THEN rainfall END), 6) AS mean_positive_rainfall_mm,
  max(rainfall) AS max_five_min_rainfall_mm, {counts}
FROM {source} {group})"""


fragment("station_year_plain", metrics_sql("year, station_id", "daily"), "daily")
fragment("station_year", """
SELECT *, CAST(date_diff('day', make_date(year, 1, 1), make_date(year + 1, 1, 1)) AS BIGINT) AS calendar_expected_intervals,
  100.0::DOUBLE * observed_intervals / date_diff('day', make_date(year, 1, 1), make_date(year + 1, 1, 1))
    AS calendar_coverage_pct
FROM station_year_plain""", "station_year_plain")
fragment("station_month_plain", metrics_sql("year, month, station_id", "daily"), "daily")
fragment("station_month", """
SELECT *, CAST(day(last_day(make_date(year, month, 1))) AS BIGINT) AS calendar_expected_intervals,
  100.0::DOUBLE * observed_intervals / day(last_day(make_date(year, month, 1))) AS calendar_coverage_pct
FROM station_month_plain""", "station_month_plain")


def station_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    grain = summaries.metrics(daily(spark, sf_dir), ["year", "station_id"], DAY, EXCEED)
    return summaries.annual_calendar_coverage(grain, DAY)


def station_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    grain = summaries.metrics(daily(spark, sf_dir), ["year", "month", "station_id"], DAY, EXCEED)
    return summaries.monthly_calendar_coverage(grain, DAY)


def locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = nation_lines(spark, sf_dir).withColumn("year", F.year("timestamp"))
    return summaries.median_location(rows, ["year", "station_id"], DAY, exact=True)


fragment("locations", """
SELECT CAST(year("timestamp") AS INTEGER) AS year, station_id, min(station_name) AS station_name,
  quantile_cont(location_latitude, 0.5) AS latitude, quantile_cont(location_longitude, 0.5) AS longitude
FROM nation_lines GROUP BY ALL""", "nation_lines")


def placed_station_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.attach_location(station_year(spark, sf_dir), locations(spark, sf_dir), DAY)


fragment("placed", """
SELECT y.*, l.station_name, l.latitude, l.longitude FROM station_year y LEFT JOIN locations l USING (year, station_id)
""", "station_year", "locations")


def record_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = aligned(spark, sf_dir)
    pairs = gaps.intervals(rows, DAY, time="observation_time", within=["year"])
    return gaps.gap_class(gaps.missing_slots(pairs, DAY), DAY)


def _pairs_sql(source: str, keys: str, time: str, slot: int) -> str:
    return f"""
SELECT *, CASE WHEN gap_seconds > {slot} THEN greatest(0, (gap_seconds + {slot} - 1) // {slot} - 1) ELSE 0 END
    AS estimated_missing_slots,
  CASE WHEN gap_seconds < {slot} THEN 'under_5min' WHEN gap_seconds = {slot} THEN 'exact_5min'
    WHEN gap_seconds <= 600 THEN '5_to_10min' WHEN gap_seconds <= 1800 THEN '10_to_30min'
    WHEN gap_seconds <= 3600 THEN '30_to_60min' WHEN gap_seconds <= 86400 THEN '1_to_24h'
    WHEN gap_seconds <= 604800 THEN '1_to_7d' ELSE 'over_7d' END AS gap_class
FROM (SELECT *, epoch_us(ts) // 1000000 - epoch_us(prev_ts) // 1000000 AS gap_seconds FROM (
  SELECT {keys}, ts, lag(ts) OVER (PARTITION BY {keys} ORDER BY ts) AS prev_ts
  FROM (SELECT DISTINCT {keys}, {time} AS ts FROM {source} WHERE {time} IS NOT NULL AND station_id IS NOT NULL))
  WHERE prev_ts IS NOT NULL)"""


fragment("record_pairs", _pairs_sql("aligned", "year, station_id", "observation_time", 86_400), "aligned")


def events_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("station_id"),
                                                 F.col("ts").alias("timestamp"), F.col("value").alias("rainfall"))


fragment("events_", """
SELECT event_id, event_type AS station_id, ts AS "timestamp", value AS rainfall FROM events""")


def event_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = gaps.intervals(events_(spark, sf_dir), FIVE_MINUTES)
    return gaps.gap_class(gaps.missing_slots(pairs, FIVE_MINUTES), FIVE_MINUTES)


fragment("event_pairs", _pairs_sql("events_", "station_id", '"timestamp"', 300), "events_")


def event_slots(spark: SparkSession, sf_dir: str, s: SeriesSpec = HOUR) -> DataFrame:
    rows = events_(spark, sf_dir).withColumn("observation_time", F.col("timestamp")).withColumn(
        "original_timestamp", F.col("timestamp").cast("string"))
    return clean.align_to_grid(rows, s)


fragment("event_slots", """
SELECT event_id, station_id, observation_time, rainfall, aligned_epoch, aligned_epoch - es AS shift_seconds,
  make_timestamp(aligned_epoch * 1000000) AS "timestamp"
FROM (SELECT *, ((es * 2 + 3600) // 7200) * 3600 AS aligned_epoch FROM (
  SELECT event_id, station_id, "timestamp" AS observation_time, rainfall, epoch_us("timestamp") // 1000000 AS es
  FROM events_))""", "events_")


def dense(spark: SparkSession, sf_dir: str, s: SeriesSpec = HOUR) -> DataFrame:
    """One mean reading per event type and slot, cut to hundredths in whole numbers."""
    hundredths = (F.sum(F.col("rainfall").cast("decimal(18,2)")) * 100).cast("bigint")
    return event_slots(spark, sf_dir, s).groupBy("station_id", "timestamp").agg(
        (F.call_function("div", hundredths, F.count("*")) / F.lit(100.0)).alias("rainfall"))


fragment("dense", """
SELECT station_id, "timestamp", 
  (CAST(sum(CAST(rainfall AS DECIMAL(18,2))) * 100 AS BIGINT) // count(*)) / 100.0::DOUBLE AS rainfall
FROM event_slots GROUP BY station_id, "timestamp" """, "event_slots")


def window_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.slot_features(dense(spark, sf_dir), HOUR)


def _lags(fn: str, n: int) -> str:
    return " + ".join(f"{fn}(rainfall, {i}) OVER w" for i in range(1, n + 1))


fragment("window_features", f"""
SELECT station_id, prediction_time, rainfall_previous_5m, rainfall_previous_30m, rainfall_previous_60m,
  CAST(hour(prediction_time) AS INTEGER) AS hour, CAST(month(prediction_time) AS INTEGER) AS month,
  future_rainfall_30m, target_end_time, CAST(year(prediction_time) AS INTEGER) AS year
FROM (SELECT station_id, "timestamp" AS prediction_time, lag(rainfall, 1) OVER w AS rainfall_previous_5m,
    {_lags('lag', 6)} AS rainfall_previous_30m, {_lags('lag', 12)} AS rainfall_previous_60m,
    {_lags('lead', 6)} AS future_rainfall_30m, lag("timestamp", 12) OVER w AS first_time,
    lead("timestamp", 6) OVER w AS target_end_time
  FROM dense WINDOW w AS (PARTITION BY station_id ORDER BY "timestamp"))
WHERE first_time = prediction_time - INTERVAL 12 HOUR AND target_end_time = prediction_time + INTERVAL 6 HOUR
""", "dense")


def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.split_by_time(window_features(spark, sf_dir), CUTS)


fragment("prepared", """
SELECT * FROM (SELECT *, CASE WHEN prediction_time < TIMESTAMP '2024-01-19' THEN 'train'
    WHEN prediction_time < TIMESTAMP '2024-01-25' THEN 'validation' ELSE 'test' END AS split FROM window_features)
WHERE target_end_time < CASE split WHEN 'train' THEN TIMESTAMP '2024-01-19'
  WHEN 'validation' THEN TIMESTAMP '2024-01-25' ELSE TIMESTAMP '2024-01-31' END""", "window_features")


def examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.expand_thresholds(prepared(spark, sf_dir), LABELS)


fragment("examples", f"""
SELECT p.*, threshold_mm, CAST(future_rainfall_30m > threshold_mm AS INTEGER)::DOUBLE AS label
FROM prepared p, (SELECT unnest([{', '.join(f'{t}::DOUBLE' for t in LABELS)}]) AS threshold_mm)""", "prepared")


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every reading scored at every threshold by a fixed formula, with a chronological split.

    The prime divisor keeps means off exact decimal halves, where rounding would be undecided.
    """
    spread = F.explode(F.array(*[F.lit(t) for t in SCORE_LABELS]))
    rows = events_(spark, sf_dir).withColumn("threshold_mm", spread)
    base = F.pmod(F.col("event_id") * 7919 + F.col("threshold_mm").cast("bigint") * 131, F.lit(997))
    return rows.select(
        "station_id", F.col("timestamp").alias("prediction_time"), "threshold_mm",
        (F.col("rainfall") > F.col("threshold_mm")).cast("double").alias("label"), (base / F.lit(997.0)).alias("p"),
        base.alias("base"),
        F.when(F.col("timestamp") < F.lit(CUTS.validation).cast("timestamp_ntz"), "train")
        .when(F.col("timestamp") < F.lit(CUTS.test).cast("timestamp_ntz"), "validation").otherwise("test").alias("split"))


fragment("scores", f"""
SELECT station_id, prediction_time, threshold_mm, label, base / 997.0::DOUBLE AS p, base,
  CASE WHEN prediction_time < TIMESTAMP '2024-01-19' THEN 'train'
    WHEN prediction_time < TIMESTAMP '2024-01-25' THEN 'validation' ELSE 'test' END AS split
FROM (SELECT station_id, "timestamp" AS prediction_time, threshold_mm,
    CAST(rainfall > threshold_mm AS INTEGER)::DOUBLE AS label,
    (event_id * 7919 + CAST(threshold_mm AS BIGINT) * 131) % 997 AS base
  FROM events_, (SELECT unnest([{', '.join(f'{t}::DOUBLE' for t in SCORE_LABELS)}]) AS threshold_mm))""", "events_")


def model_scores(spark: SparkSession, sf_dir: str, name: str = "model") -> DataFrame:
    """Three sets of scores that lean towards the label by different amounts."""
    y = F.col("label")
    variants = F.array(*[F.struct(F.lit(m).alias(name), ((F.col("base") + y * (w * 997)) / F.lit(997.0 * (1 + w))).alias("p"))
                         for m, w in (("LR", 0), ("RF", 1), ("GBT", 3))])
    return scores(spark, sf_dir).drop("p").select("station_id", "prediction_time", "threshold_mm", "label", "split",
                                                  F.inline(variants))


fragment("model_scores", """
SELECT station_id, prediction_time, threshold_mm, label, split, model,
  (base + label * (w * 997)) / (997.0::DOUBLE * (1 + w)) AS p
FROM scores, (VALUES ('LR', 0), ('RF', 1), ('GBT', 3)) v(model, w)""", "scores")


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as map points with a value."""
    lat, lon = _place("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("point_id"), lat.cast("double").alias("latitude"), lon.cast("double").alias("longitude"),
        F.col("s_acctbal").alias("value"))


fragment("stations", """
SELECT s_suppkey AS point_id,
  CAST('1.' || lpad(CAST((s_suppkey % 97) * 20 + 2000 AS VARCHAR), 4, '0') AS DOUBLE) AS latitude,
  CAST('103.' || lpad(CAST((s_suppkey % 89) * 40 + 6000 AS VARCHAR), 4, '0') AS DOUBLE) AS longitude,
  s_acctbal AS value FROM supplier""")


def targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as places to interpolate."""
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        key.alias("target_id"), ((F.pmod(key * 7919, F.lit(2003)) + 11900) / F.lit(10000.0)).alias("latitude"),
        ((F.pmod(key * 104729, F.lit(3989)) + 1035900) / F.lit(10000.0)).alias("longitude"))


fragment("targets", """
SELECT c_custkey AS target_id, ((c_custkey * 7919) % 2003 + 11900) / 10000.0::DOUBLE AS latitude,
  ((c_custkey * 104729) % 3989 + 1035900) / 10000.0::DOUBLE AS longitude FROM customer""")
