"""Registered queries: summaries, cohorts, report tables and maps."""

from __future__ import annotations

from pyspark.sql import functions as F

from gaugeworks.functions.projection import SVY21
from gaugeworks.operators import cohorts, spatial, summaries
from gaugeworks.operators.gaps import GAP_CLASSES, gap_distribution, monthly_gaps
from gaugeworks.plans import bindings as b
from gaugeworks.plans.registry import DIGITS, query
from gaugeworks.sources.scratch import scratch_dir

DAY = b.DAY
IN_YEARS = f"({', '.join(map(str, b.YEARS))})"
MAP_YEARS = f"({', '.join(map(str, b.MAP_YEARS))})"
TOTALS = cohorts.TOTALS


def _metrics(spark, sf, *by):
    return summaries.metrics(b.daily(spark, sf), by, DAY, b.EXCEED)


# --- exploratory aggregation ---


@query("E1_metrics", b.metrics_sql("", "daily"), "daily")
def _(spark, sf):
    return _metrics(spark, sf)


@query("E2_metrics_annual", b.metrics_sql("year", "daily"), "daily")
def _(spark, sf):
    return _metrics(spark, sf, "year")


@query("E3_metrics_monthly", b.metrics_sql("year, month", "daily"), "daily")
def _(spark, sf):
    return _metrics(spark, sf, "year", "month")


@query("E4_metrics_hourly", b.metrics_sql("year, hour", "(SELECT CAST(year(ts) AS INTEGER) AS year, "
       "CAST(hour(ts) AS INTEGER) AS hour, CAST(value AS DECIMAL(18,2))::DOUBLE AS rainfall FROM events)").replace(
           "sum(rainfall) AS recorded_rainfall_mm", "round(sum(rainfall), 6) AS recorded_rainfall_mm"))
def _(spark, sf):
    rows = summaries.calendar_cols(b.events_(spark, sf), "timestamp")
    return summaries.metrics(rows, ["year", "hour"], b.HOUR, b.EXCEED)


@query("E5_metrics_station_year", b.metrics_sql("year, station_id", "daily"), "daily")
def _(spark, sf):
    return _metrics(spark, sf, "year", "station_id")


@query("E6_metrics_station_month", b.metrics_sql("year, month, station_id", "daily"), "daily")
def _(spark, sf):
    return _metrics(spark, sf, "year", "month", "station_id")


def _grains_sql() -> str:
    parts = []
    for grain, cols in summaries.GRAINS.items():
        names = ["station_id" if c == "entity" else c for c in cols]
        gone = ", ".join(f"NULL AS {c}" for c in ("year", "month", "hour", "station_id") if c not in names)
        parts.append(f"SELECT '{grain}' AS grain, *{', ' + gone if gone else ''} FROM ({b.metrics_sql(', '.join(names), 'daily')})")
    return " UNION ALL BY NAME ".join(parts)


@query("E2_E6_metric_grains", _grains_sql(), "daily")
def _(spark, sf):
    return summaries.metric_grains(b.daily(spark, sf), DAY, b.EXCEED)


@query("E7_calendar_cols", """SELECT event_id, CAST(year("timestamp") AS INTEGER) AS year,
CAST(month("timestamp") AS INTEGER) AS month, CAST(hour("timestamp") AS INTEGER) AS hour FROM events_""", "events_")
def _(spark, sf):
    return summaries.calendar_cols(b.events_(spark, sf), "timestamp").select("event_id", "year", "month", "hour")


@query("E8_median_location", """SELECT * REPLACE (round(latitude, 6) AS latitude, round(longitude, 6) AS longitude)
FROM locations""", "locations")
def _(spark, sf):
    return b.locations(spark, sf)


@query("E8_median_location_sketch")
def _(spark, sf):
    rows = b.nation_lines(spark, sf).withColumn("year", F.year("timestamp"))
    return summaries.median_location(rows, ["year", "station_id"], DAY)


def _tails_sql(by: str, source: str) -> str:
    names = summaries.percentile_names(b.TAILS)
    cols = ", ".join(f"round(quantile_cont(rainfall, {p}) FILTER (rainfall > 0), 6) AS {n}" for n, p in names.items())
    return f"SELECT {by}, count(*) FILTER (rainfall > 0) AS positive_intervals, {cols} FROM {source} GROUP BY {by}"


@query("E9_tail_percentiles", _tails_sql("station_id", "events_"), "events_")
def _(spark, sf):
    return summaries.tail_percentiles(b.events_(spark, sf), ["station_id"], b.HOUR, b.TAILS, exact=True)


@query("E9_tail_percentiles_annual", _tails_sql("year", "daily"), "daily")
def _(spark, sf):
    return summaries.tail_percentiles(b.daily(spark, sf), ["year"], DAY, b.TAILS, exact=True)


# Readings scaled to nine orders of magnitude, some of them null or below zero.
WIDE = """SELECT station_id, CASE WHEN event_id % 101 = 0 THEN NULL WHEN event_id % 7 = 0 THEN -rainfall ELSE rainfall * pow(10.0, event_id % 10) / 10000.0 END AS rainfall FROM events_"""


def _wide(spark, sf):
    n, v = F.col("event_id"), F.col("rainfall")
    scaled = (F.when(n % 101 == 0, None).when(n % 7 == 0, -v)
              .otherwise(v * F.pow(F.lit(10.0), n % 10) / 10000.0))
    return b.events_(spark, sf).select("station_id", scaled.cast("double").alias("rainfall"))


@query("E9_tail_percentiles_wide", _tails_sql("station_id", f"({WIDE})"), "events_")
def _(spark, sf):
    return summaries.tail_percentiles(_wide(spark, sf), ["station_id"], b.HOUR, b.TAILS, exact=True)


@query("E9_tail_percentiles_sketch")
def _(spark, sf):
    return summaries.tail_percentiles(b.daily(spark, sf), ["year"], DAY, b.TAILS)


def _histogram_sql(by: str, source: str) -> str:
    rows = []
    for i, low in enumerate(b.EDGES):
        high = f"{b.EDGES[i + 1]}::DOUBLE" if i + 1 < len(b.EDGES) else "NULL::DOUBLE"
        rows.append(f"({i}, {low}::DOUBLE, {high})")
    return f"""SELECT g.{by}, bin_id, lower_mm, upper_mm, count(rainfall) AS count FROM (
SELECT * FROM (SELECT DISTINCT {by} FROM {source}), (VALUES {', '.join(rows)}) v(bin_id, lower_mm, upper_mm)) g
LEFT JOIN {source} s ON s.{by} = g.{by} AND rainfall > 0 AND rainfall >= lower_mm AND (upper_mm IS NULL OR rainfall < upper_mm)
GROUP BY ALL"""


@query("E10_histogram", _histogram_sql("station_id", "events_"), "events_")
def _(spark, sf):
    return summaries.histogram(b.events_(spark, sf), ["station_id"], b.HOUR, b.EDGES)


@query("E10_histogram_annual", _histogram_sql("year", "daily"), "daily")
def _(spark, sf):
    return summaries.histogram(b.daily(spark, sf), ["year"], DAY, b.EDGES)


@query("E11_annual_calendar_coverage", """SELECT year, station_id, observed_intervals, recorded_rainfall_mm,
calendar_expected_intervals, round(calendar_coverage_pct, 6) AS calendar_coverage_pct,
round(recorded_rainfall_mm * calendar_expected_intervals / observed_intervals, 6) AS calendar_extrapolated_rainfall_mm
FROM station_year""", "station_year")
def _(spark, sf):
    return b.station_year(spark, sf).select(
        "year", "station_id", "observed_intervals", "recorded_rainfall_mm", "calendar_expected_intervals",
        "calendar_coverage_pct", "calendar_extrapolated_rainfall_mm")


@query("E12_monthly_calendar_coverage", """SELECT year, month, station_id, observed_intervals,
calendar_expected_intervals, round(calendar_coverage_pct, 6) AS calendar_coverage_pct FROM station_month""",
       "station_month")
def _(spark, sf):
    return b.station_month(spark, sf).select("year", "month", "station_id", "observed_intervals",
                                             "calendar_expected_intervals", "calendar_coverage_pct")


@query("E13_attach_location", """SELECT year, station_id, station_name, observed_intervals,
round(latitude, 6) AS latitude, round(longitude, 6) AS longitude FROM placed""", "placed")
def _(spark, sf):
    return b.placed_station_year(spark, sf).select("year", "station_id", "station_name", "observed_intervals",
                                                   "latitude", "longitude")


# --- coverage, cohorts and sensitivity ---


def _violations_sql(rules: dict[str, str], keys: str, years: tuple[int, ...]) -> str:
    parts = [f"SELECT '{n}' AS issue, count(*) FILTER ({c}) AS failures FROM f" for n, c in rules.items()]
    parts.append(f"SELECT 'duplicate_key', CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM f GROUP BY {keys})")
    listed = ", ".join(map(str, years))
    parts.append(f"SELECT 'missing_year', {len(years)} - count(DISTINCT year) FILTER (year IN ({listed})) FROM f")
    return " UNION ALL ".join(parts)


SPOILED_SQL = """SELECT year, station_id, CASE WHEN year % 2 = 0 AND station_id = 'NATION_1' THEN 0 ELSE observed_intervals END
AS observed_intervals, CASE WHEN year = 1998 THEN observed_intervals + 1 ELSE rainy_intervals END AS rainy_intervals,
CASE WHEN station_id = 'NATION_2' THEN -1.0::DOUBLE ELSE recorded_rainfall_mm END AS recorded_rainfall_mm,
calendar_expected_intervals + CASE WHEN year = 2000 THEN -1 ELSE 0 END AS calendar_expected_intervals,
calendar_coverage_pct + CASE WHEN station_id = 'NATION_3' THEN 0.5::DOUBLE ELSE 0 END AS calendar_coverage_pct
FROM station_year UNION ALL SELECT year, station_id, observed_intervals, rainy_intervals, recorded_rainfall_mm,
calendar_expected_intervals, calendar_coverage_pct FROM station_year WHERE station_id = 'NATION_4'"""
TRUE_DAYS = "date_diff('day', make_date(year, 1, 1), make_date(year + 1, 1, 1))"
A1_RULES = {
    "not_finite_or_negative": "recorded_rainfall_mm < 0",
    "no_observations": "observed_intervals <= 0",
    "rainy_exceeds_observed": "rainy_intervals > observed_intervals",
    "wrong_calendar_denominator": f"calendar_expected_intervals <> {TRUE_DAYS}",
    "coverage_over_100": f"observed_intervals > {TRUE_DAYS}",
    "coverage_disagrees": f"abs(calendar_coverage_pct - 100.0::DOUBLE * observed_intervals / {TRUE_DAYS}) > 1e-7",
    "unexpected_year": "year NOT IN (1994, 1995, 1996, 1997, 1998, 1999, 2000)",
}


@query("A1_validate_summary", "SELECT * FROM (WITH f AS (" + SPOILED_SQL + ") "
       + _violations_sql(A1_RULES, "year, station_id", tuple(range(1994, 2001))) + ") WHERE failures > 0", "station_year")
def _(spark, sf):
    """The annual summary with known faults put in, against years that do not quite fit."""
    cols = ["year", "station_id", *TOTALS, "calendar_expected_intervals", "calendar_coverage_pct"]
    good = b.station_year(spark, sf).select(*cols)
    who, year, n = F.col("station_id"), F.col("year"), F.col("observed_intervals")
    spoiled = good.select(
        year, who, F.when((year % 2 == 0) & (who == "NATION_1"), 0).otherwise(n).alias("observed_intervals"),
        F.when(year == 1998, n + 1).otherwise(F.col("rainy_intervals")).alias("rainy_intervals"),
        F.when(who == "NATION_2", -1.0).otherwise(F.col("recorded_rainfall_mm")).alias("recorded_rainfall_mm"),
        (F.col("calendar_expected_intervals") + F.when(year == 2000, -1).otherwise(0)).alias("calendar_expected_intervals"),
        (F.col("calendar_coverage_pct") + F.when(who == "NATION_3", 0.5).otherwise(0.0)).alias("calendar_coverage_pct"))
    both = spoiled.unionByName(good.where(who == "NATION_4"))
    return cohorts.validate_summary(both, ["year", "station_id"], DAY, tuple(range(1994, 2001)))


@query("A1_validate_monthly_summary", """SELECT * FROM (SELECT 'missing_year' AS issue,
8 - count(DISTINCT year) AS failures FROM station_month) WHERE failures > 0""", "station_month")
def _(spark, sf):
    return cohorts.validate_summary(b.station_month(spark, sf), ["year", "month", "station_id"], DAY, (*b.YEARS, 2002))


def _balanced_sql(t: float) -> str:
    return f"""SELECT station_id, count(DISTINCT year) AS eligible_years FROM station_year WHERE year IN {IN_YEARS}
AND calendar_coverage_pct >= {t} GROUP BY station_id HAVING count(DISTINCT year) = {len(b.YEARS)}"""


@query("A2_balanced_ids", _balanced_sql(b.COVERAGE[0]), "station_year")
def _(spark, sf):
    return cohorts.balanced_ids(b.station_year(spark, sf), DAY, b.YEARS, b.COVERAGE[0])


BLOCK = """count(DISTINCT station_id) AS stations, count(station_id) AS station_periods,
CAST(coalesce(sum(observed_intervals), 0) AS BIGINT) AS observed_intervals,
CAST(coalesce(sum(rainy_intervals), 0) AS BIGINT) AS rainy_intervals,
coalesce(sum(recorded_rainfall_mm), 0)::DOUBLE AS recorded_rainfall_mm"""
RATES = {
    "pooled": """round(100.0::DOUBLE * sum(rainy_intervals) / nullif(sum(observed_intervals), 0), 6) AS rainy_pct,
round(sum(recorded_rainfall_mm) / nullif(sum(observed_intervals), 0), 6) AS mean_mm_per_interval""",
    "equal_station_period": """round(avg(100.0::DOUBLE * rainy_intervals / observed_intervals), 6) AS rainy_pct,
round(avg(recorded_rainfall_mm / observed_intervals), 6) AS mean_mm_per_interval""",
}


def _summarize_sql(weighting: str) -> str:
    return f"""SELECT y.year, '{weighting}' AS weighting, {BLOCK}, {RATES[weighting]}
FROM (SELECT unnest([1994, 1996, 1998, 2000]) AS year) y LEFT JOIN station_year s ON s.year = y.year GROUP BY y.year"""


@query("A3_summarize_pooled", _summarize_sql("pooled"), "station_year")
def _(spark, sf):
    return cohorts.summarize(b.station_year(spark, sf), "year", (1994, 1996, 1998, 2000), "pooled", DAY)


@query("A4_summarize_equal", _summarize_sql("equal_station_period"), "station_year")
def _(spark, sf):
    return cohorts.summarize(b.station_year(spark, sf), "year", (1994, 1996, 1998, 2000), "equal_station_period", DAY)


COHORTS = (40.0, 60.0, 80.0)


def _cohort_list() -> list[tuple[str, float, str]]:
    def balanced(t: float) -> str:
        return f"station_id IN (SELECT station_id FROM ({_balanced_sql(t)}))"

    out = [("all_reporting", 0.0, "true"), ("common_all_years", 0.0, balanced(0.0))]
    for t in COHORTS:
        out += [("eligible_each_year", t, f"calendar_coverage_pct >= {t}"), ("balanced_all_years", t, balanced(t))]
    return out


def _annual_sql() -> str:
    parts = []
    for cohort, t, rule in _cohort_list():
        for w in cohorts.WEIGHTINGS:
            parts.append(f"""SELECT y.year, '{cohort}' AS cohort, {t}::DOUBLE AS min_coverage_pct, '{w}' AS weighting,
{BLOCK}, {RATES[w]} FROM (SELECT unnest({list(b.YEARS)}) AS year) y
LEFT JOIN (SELECT * FROM station_year WHERE {rule}) s ON s.year = y.year GROUP BY y.year""")
    return " UNION ALL ".join(parts)


@query("A5_annual_sensitivity", _annual_sql(), "station_year")
def _(spark, sf):
    return cohorts.annual_sensitivity(b.station_year(spark, sf), DAY, COHORTS, b.YEARS)


def _audit_sql() -> str:
    return " UNION ALL ".join(
        f"""SELECT g.station_id, g.year, round(calendar_coverage_pct, 6) AS calendar_coverage_pct, '{c}' AS cohort,
{t}::DOUBLE AS min_coverage_pct, coalesce(calendar_coverage_pct IS NOT NULL AND {rule.replace('station_id IN', 'g.station_id IN')}, false) AS selected
FROM (SELECT * FROM (SELECT DISTINCT station_id FROM station_year), (SELECT unnest({[*b.YEARS]}) AS year)) g
LEFT JOIN station_year s ON s.station_id = g.station_id AND s.year = g.year""" for c, t, rule in _cohort_list())


@query("A6_cohort_audit", _audit_sql(), "station_year")
def _(spark, sf):
    return cohorts.cohort_audit(b.station_year(spark, sf), DAY, COHORTS, b.YEARS)


def _monthly_sql() -> str:
    parts = []
    for t in (0.0, *COHORTS):
        for w in cohorts.WEIGHTINGS:
            parts.append(f"""SELECT m.month, 'eligible_station_months' AS cohort, {t}::DOUBLE AS min_coverage_pct,
'{w}' AS weighting, {BLOCK}, {RATES[w]} FROM (SELECT CAST(unnest(range(1, 13)) AS INTEGER) AS month) m
LEFT JOIN (SELECT * FROM station_month WHERE calendar_coverage_pct >= {t}) s ON s.month = m.month GROUP BY m.month""")
    return " UNION ALL ".join(parts)


@query("A7_monthly_sensitivity", _monthly_sql(), "station_month")
def _(spark, sf):
    return cohorts.monthly_sensitivity(b.station_month(spark, sf), DAY, COHORTS)


SPATIAL = f"""SELECT * FROM (SELECT station_id, avg(100.0::DOUBLE * rainy_intervals / observed_intervals) AS rainy_pct,
avg(recorded_rainfall_mm / observed_intervals) AS mean_mm_per_interval, count(DISTINCT year) AS eligible_years,
min(calendar_coverage_pct) AS min_calendar_coverage_pct, quantile_cont(latitude, 0.5) AS latitude,
quantile_cont(longitude, 0.5) AS longitude, '{','.join(map(str, b.MAP_YEARS))}' AS analysis_years
FROM placed WHERE year IN {MAP_YEARS} GROUP BY station_id)
WHERE eligible_years = {len(b.MAP_YEARS)} AND min_calendar_coverage_pct >= {b.COVERAGE[0]}"""
ROUND_POINTS = ", ".join(f"round({c}, {DIGITS}) AS {c}" for c in
                         ("rainy_pct", "mean_mm_per_interval", "min_calendar_coverage_pct", "latitude", "longitude"))


def _points(spark, sf, coverage=b.COVERAGE[0]):
    return cohorts.spatial_summary(b.placed_station_year(spark, sf), DAY, b.MAP_YEARS, coverage)


@query("A8_spatial_summary", f"SELECT * REPLACE ({ROUND_POINTS}) FROM ({SPATIAL})", "placed")
def _(spark, sf):
    return _points(spark, sf)


@query("A8_spatial_rows", f"""SELECT station_id, year, observed_intervals, rainy_intervals, round(calendar_coverage_pct, 6) AS calendar_coverage_pct
FROM placed WHERE year IN {MAP_YEARS} AND station_id IN (SELECT station_id FROM ({SPATIAL}))""", "placed")
def _(spark, sf):
    rows = cohorts.spatial_rows(b.placed_station_year(spark, sf), DAY, b.MAP_YEARS, b.COVERAGE[0])
    return rows.select("station_id", "year", "observed_intervals", "rainy_intervals", "calendar_coverage_pct")


@query("A9_reconcile", """SELECT year, left_observed_intervals, left_recorded_rainfall_mm, right_observed_intervals,
right_recorded_rainfall_mm FROM (SELECT year, sum(observed_intervals)::DOUBLE AS left_observed_intervals,
sum(recorded_rainfall_mm) AS left_recorded_rainfall_mm FROM station_month GROUP BY year) a FULL JOIN (
SELECT year, sum(observed_intervals + CASE WHEN year = 1997 AND station_id = 'NATION_1' THEN 1 ELSE 0 END)::DOUBLE
AS right_observed_intervals, sum(recorded_rainfall_mm) AS right_recorded_rainfall_mm FROM station_year
WHERE year < 2001 GROUP BY year) c USING (year)
WHERE left_observed_intervals IS NULL OR right_observed_intervals IS NULL
OR abs(left_observed_intervals - right_observed_intervals) > 1e-5""", "station_year", "station_month")
def _(spark, sf):
    """Monthly rows against annual rows with one count changed and the last year left out."""
    extra = F.when((F.col("year") == 1997) & (F.col("station_id") == "NATION_1"), 1).otherwise(0)
    other = b.station_year(spark, sf).where("year < 2001").withColumn("observed_intervals", F.col("observed_intervals") + extra)
    return cohorts.reconcile(b.station_month(spark, sf), other, ["year"], ["observed_intervals", "recorded_rainfall_mm"])


@query("A9_reconcile_grains", """SELECT year, month, sum(observed_intervals)::DOUBLE AS left_observed_intervals,
sum(rainy_intervals)::DOUBLE AS left_rainy_intervals, sum(observed_intervals)::DOUBLE + 2 AS right_observed_intervals,
sum(rainy_intervals)::DOUBLE AS right_rainy_intervals FROM station_month WHERE year = 1996 AND month = 3 GROUP BY ALL""", "station_month")
def _(spark, sf):
    """Station months against months with one count changed: that month, and no other, comes back."""
    extra = F.when((F.col("year") == 1996) & (F.col("month") == 3), 2).otherwise(0)
    other = _metrics(spark, sf, "year", "month").withColumn("observed_intervals", F.col("observed_intervals") + extra)
    return cohorts.reconcile(b.station_month(spark, sf), other, ["year", "month"], ["observed_intervals", "rainy_intervals"])


def _rate_sql(by: str, source: str) -> str:
    return f"""SELECT {by}, CAST(sum(rainy_intervals) AS BIGINT) AS rainy_intervals,
CAST(sum(observed_intervals) AS BIGINT) AS observed_intervals, sum(recorded_rainfall_mm) AS recorded_rainfall_mm,
round(100.0::DOUBLE * sum(rainy_intervals) / sum(observed_intervals), 6) AS rate_pct,
round(sum(recorded_rainfall_mm) / sum(observed_intervals), 6) AS mean_mm FROM {source} GROUP BY {by}"""


@query("A10_weighted_rate_monthly", _rate_sql("month", "station_month"), "station_month")
def _(spark, sf):
    return cohorts.weighted_rate(_metrics(spark, sf, "year", "month"), ["month"])


@query("A10_weighted_rate_hourly", """SELECT CAST(hour(ts) AS INTEGER) AS hour, count(*) FILTER (value > 0) AS rainy_intervals,
count(*) AS observed_intervals, round(sum(value), 6) AS recorded_rainfall_mm,
round(100.0::DOUBLE * count(*) FILTER (value > 0) / count(*), 6) AS rate_pct, round(sum(value) / count(*), 6) AS mean_mm
FROM events GROUP BY 1""")
def _(spark, sf):
    rows = summaries.calendar_cols(b.events_(spark, sf), "timestamp")
    return cohorts.weighted_rate(summaries.metrics(rows, ["year", "hour"], b.HOUR, b.EXCEED), ["hour"])


@query("A11_common_entity_summary", f"""SELECT year, count(*) FILTER (c) AS stations,
CAST(sum(observed_intervals) FILTER (c) AS BIGINT) AS observed_intervals,
CAST(sum(rainy_intervals) FILTER (c) AS BIGINT) AS rainy_intervals,
sum(recorded_rainfall_mm) FILTER (c) AS recorded_rainfall_mm,
round(100.0::DOUBLE * sum(rainy_intervals) FILTER (c) / sum(observed_intervals) FILTER (c), 6) AS rainy_pct,
round(sum(recorded_rainfall_mm) FILTER (c) / sum(observed_intervals) FILTER (c), 6) AS mean_mm,
round(100.0::DOUBLE * sum(rainy_intervals) / sum(observed_intervals), 6) AS all_rainy_pct,
round(sum(recorded_rainfall_mm) / sum(observed_intervals), 6) AS all_mean_mm
FROM (SELECT *, station_id IN (SELECT station_id FROM ({_balanced_sql(0.0)})) AS c FROM station_year) GROUP BY year""",
       "station_year")
def _(spark, sf):
    return cohorts.common_entity_summary(b.station_year(spark, sf), DAY, b.YEARS)


@query("A12_monthly_accumulation", """SELECT m.month, count(station_id) AS n, round(quantile_cont(recorded_rainfall_mm, 0.5), 6) AS median_mm,
round(quantile_cont(recorded_rainfall_mm, 0.25), 6) AS q25_mm, round(quantile_cont(recorded_rainfall_mm, 0.75), 6) AS q75_mm
FROM (SELECT CAST(unnest(range(1, 13)) AS INTEGER) AS month) m LEFT JOIN (SELECT * FROM station_month
WHERE calendar_coverage_pct >= 50) s ON s.month = m.month GROUP BY m.month""", "station_month")
def _(spark, sf):
    found = cohorts.monthly_accumulation(b.station_month(spark, sf), 50.0)
    return found.withColumn("n", F.coalesce("n_station_months", F.lit(0).cast("long"))).drop("n_station_months")


HISTOGRAM = _histogram_sql("year", "daily")


@query("A13_histogram_share", f"""SELECT bin_id, lower_mm, upper_mm, CAST(sum(count) AS BIGINT) AS count,
round(100.0::DOUBLE * sum(count) / (SELECT sum(count) FROM ({HISTOGRAM})), 6) AS share_pct FROM ({HISTOGRAM})
GROUP BY ALL HAVING sum(count) > 0""", "daily")
def _(spark, sf):
    return cohorts.histogram_share(summaries.histogram(b.daily(spark, sf), ["year"], DAY, b.EDGES))


@query("A14_exceedance_rates", " UNION ALL ".join(
    f"SELECT {t}::DOUBLE AS threshold_mm, round(100.0::DOUBLE * count(*) FILTER (rainfall > {t}) / count(*), 6) AS rate_pct FROM daily"
    for t in b.EXCEED), "daily")
def _(spark, sf):
    return cohorts.exceedance_rates(_metrics(spark, sf, "year"), b.EXCEED)


@query("A15_rate_matrix", "SELECT year, " + ", ".join(
    f"round(100.0::DOUBLE * count(*) FILTER (month = {m} AND rainfall > 0) / nullif(count(*) FILTER (month = {m}), 0), 6) AS m{m:02d}"
    for m in range(1, 13)) + " FROM daily GROUP BY year", "daily")
def _(spark, sf):
    return cohorts.rate_matrix(_metrics(spark, sf, "year", "month"))


@query("A16_annual_rates", """SELECT year, round(100.0::DOUBLE * count(*) FILTER (rainfall > 0) / count(*), 6) AS rainy_pct,
round(sum(rainfall) / count(*), 6) AS mean_mm_per_interval FROM daily GROUP BY year""", "daily")
def _(spark, sf):
    return cohorts.annual_rates(_metrics(spark, sf, "year"))


@query("A17_eligible_counts", """SELECT year, count(DISTINCT station_id) AS stations,
count(*) FILTER (calendar_coverage_pct >= 60) AS eligible_station_years FROM station_year GROUP BY year""", "station_year")
def _(spark, sf):
    return cohorts.eligible_counts(b.station_year(spark, sf), DAY, 60.0)


def _box_sql(source: str, value: str, by: str = "year") -> str:
    return f"""SELECT {by}, count(*) AS n, round(any_value(q1), 6) AS q1, round(any_value(median), 6) AS median,
round(any_value(q3), 6) AS q3, round(min({value}) FILTER (ok), 6) AS whisker_low,
round(max({value}) FILTER (ok), 6) AS whisker_high, count(*) FILTER (NOT ok) AS outliers
FROM (SELECT *, {value} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS ok FROM {source} JOIN (
SELECT {by}, quantile_cont({value}, 0.25) AS q1, quantile_cont({value}, 0.5) AS median, quantile_cont({value}, 0.75) AS q3
FROM {source} GROUP BY {by}) USING ({by})) GROUP BY {by}"""


@query("A18_box_stats", _box_sql("station_year", "calendar_coverage_pct"), "station_year")
def _(spark, sf):
    return cohorts.box_stats(b.station_year(spark, sf), "year", "calendar_coverage_pct")


@query("A18_box_stats_readings", _box_sql("daily", "rainfall"), "daily")
def _(spark, sf):
    return cohorts.box_stats(b.daily(spark, sf), "year", "rainfall")


@query("A18_box_stats_wide", _box_sql(f"(SELECT * FROM ({WIDE}) WHERE rainfall IS NOT NULL)", "rainfall", "station_id"), "events_")
def _(spark, sf):
    return cohorts.box_stats(_wide(spark, sf), "station_id", "rainfall")


LONG = ", ".join(f"'{c}'" for c in GAP_CLASSES[2:])


def _distribution(spark, sf):
    return gap_distribution(b.record_pairs(spark, sf), ["year"])


@query("A19_gap_composition", "SELECT year, " + ", ".join(
    f"round(100.0::DOUBLE * count(*) FILTER (gap_class = '{c}') / nullif(count(*) FILTER (gap_class IN ({LONG})), 0), 6) AS pct_{c}"
    for c in GAP_CLASSES[2:]) + " FROM record_pairs GROUP BY year", "record_pairs")
def _(spark, sf):
    return cohorts.gap_composition(_distribution(spark, sf))


@query("A20_gap_matrix", "SELECT year, " + ", ".join(
    f"count(*) FILTER (month(ts) = {m}) AS m{m:02d}" for m in range(1, 13))
    + " FROM record_pairs WHERE gap_seconds > 86400 GROUP BY year", "record_pairs")
def _(spark, sf):
    return cohorts.gap_matrix(monthly_gaps(b.record_pairs(spark, sf), DAY, ["year"]))


@query("A21_gap_vs_missing", f"""SELECT year, count(*) FILTER (gap_class IN ({LONG})) AS gaps_over_slot,
CAST(sum(estimated_missing_slots) AS BIGINT) AS estimated_missing_slots FROM record_pairs GROUP BY year""", "record_pairs")
def _(spark, sf):
    return cohorts.gap_vs_missing(_distribution(spark, sf))


# --- maps ---


@query("X1_entity_catalog", """SELECT station_id, min(observation_time) AS first_time, max(observation_time) AS last_time,
arg_max(location_latitude, (observation_time, location_latitude, location_longitude)) FILTER (ok) AS latitude,
arg_max(location_longitude, (observation_time, location_latitude, location_longitude)) FILTER (ok) AS longitude
FROM (SELECT *, location_latitude BETWEEN -90 AND 90 AND location_longitude BETWEEN -180 AND 180 AS ok FROM typed)
WHERE year(observation_time) BETWEEN 1995 AND 2001 AND station_id <> '' GROUP BY station_id""", "typed")
def _(spark, sf):
    rows = b.typed(spark, sf).drop("timestamp").withColumnRenamed("observation_time", "timestamp")
    return spatial.entity_catalog(rows, DAY, (1995, 2001))


def _tm_sql(source: str, columns: str) -> str:
    tm = SVY21
    e, (a1, a2, a3) = tm.eccentricity, tm.coefficients
    radius = tm.scale * tm.rectifying_radius
    return f"""SELECT {columns}, {tm.false_easting} + {radius!r}::DOUBLE * (eta + {a1!r}::DOUBLE * cos(2 * xi) * sinh(2 * eta)
  + {a2!r}::DOUBLE * cos(4 * xi) * sinh(4 * eta) + {a3!r}::DOUBLE * cos(6 * xi) * sinh(6 * eta)) AS x,
 {tm.false_northing - tm.origin_northing!r}::DOUBLE + {radius!r}::DOUBLE * (xi + {a1!r}::DOUBLE * sin(2 * xi) * cosh(2 * eta)
  + {a2!r}::DOUBLE * sin(4 * xi) * cosh(4 * eta) + {a3!r}::DOUBLE * sin(6 * xi) * cosh(6 * eta)) AS y
FROM (SELECT *, atan2(t, cos(away)) AS xi, atanh(sin(away) / sqrt(1 + t * t)) AS eta FROM (
SELECT *, sinh(atanh(sn) - {e!r}::DOUBLE * atanh({e!r}::DOUBLE * sn)) AS t FROM (
SELECT *, sin(radians(latitude)) AS sn, radians(longitude - {tm.longitude_origin!r}::DOUBLE) AS away FROM {source})))"""


POINTS = _tm_sql("stations", "point_id, value")
PLACES = _tm_sql("targets", "target_id")


def _stations(spark, sf):
    return spatial.project_tm(b.stations(spark, sf)).select("point_id", "value", "x", "y")


def _targets(spark, sf):
    return spatial.project_tm(b.targets(spark, sf)).select("target_id", "x", "y")


@query("X2_project_tm", f"SELECT point_id, round(x, 4) AS x, round(y, 4) AS y FROM ({POINTS})", "stations")
def _(spark, sf):
    return _stations(spark, sf).select("point_id", F.round("x", 4).alias("x"), F.round("y", 4).alias("y"))


@query("X3_raster", f"""SELECT ix, iy, round(minx + (maxx - minx) * ix / 119, 4) AS x, round(miny + (maxy - miny) * iy / (ny - 1), 4) AS y
FROM (SELECT *, CAST(unnest(range(120)) AS INTEGER) AS ix FROM (SELECT *, greatest(90, CAST(floor(120 * (maxy - miny) / (maxx - minx)) AS BIGINT)) AS ny
FROM (SELECT min(x) - 3000 AS minx, max(x) + 3000 AS maxx, min(y) - 3000 AS miny, max(y) + 3000 AS maxy FROM ({POINTS})))) r,
LATERAL (SELECT unnest(range(ny)) AS iy)""", "stations")
def _(spark, sf):
    cells = spatial.raster(spatial.bounds_of(_stations(spark, sf)), 120)
    return cells.select("ix", "iy", F.round("x", 4).alias("x"), F.round("y", 4).alias("y"))


# A concave ring, a square with a square hole, and a square over parts of both, in the metres of the projected points.
RINGS = ((((9000.0, 21000.0), (26000.0, 23000.0), (30000.0, 31000.0), (21000.0, 28000.0), (12000.0, 33000.0), (9000.0, 21000.0)),),
         (((31000.0, 24000.0), (43000.0, 24000.0), (43000.0, 36000.0), (31000.0, 36000.0), (31000.0, 24000.0)),
          ((35000.0, 28000.0), (39000.0, 28000.0), (39000.0, 32000.0), (35000.0, 32000.0), (35000.0, 28000.0))),
         (((20000.0, 22000.0), (37000.0, 22000.0), (37000.0, 30000.0), (20000.0, 30000.0), (20000.0, 22000.0)),))
# Points on a vertex, on level and upright outlines, in the hole, and covered twice.
MARKS = ((-1, 43000.0, 36000.0), (-2, 40000.0, 36000.0), (-3, 43000.0, 30000.0), (-4, 38000.0, 31000.0), (-5, 32000.0, 25000.0),
         (-6, 36000.0, 29000.0), (-7, 35000.0, 31000.0), (-8, 44000.0, 36000.0), (-9, 24000.0, 25000.0))


def _ring_edges():
    for number, polygon in enumerate(RINGS):
        for ring in polygon:
            for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
                yield number, 0, x1, y1, x2, y2


@query("X4_inside", f"""SELECT DISTINCT target_id FROM (SELECT target_id, feature FROM (SELECT target_id, x, y FROM ({PLACES})
  UNION ALL SELECT * FROM (VALUES {', '.join(map(str, MARKS))}) m(target_id, x, y)) p,
  (VALUES {', '.join(str(e) for e in _ring_edges())}) e(feature, polygon, x1, y1, x2, y2)
GROUP BY target_id, feature HAVING count(*) FILTER ((y1 > y) <> (y2 > y) AND x < (x2 - x1) * (y - y1) / nullif(y2 - y1, 0) + x1) % 2 = 1
  OR bool_or((x - x1) * (y2 - y1) = (y - y1) * (x2 - x1) AND x BETWEEN least(x1, x2) AND greatest(x1, x2)
    AND y BETWEEN least(y1, y2) AND greatest(y1, y2)))""", "targets")
def _(spark, sf):
    edges = spark.createDataFrame(list(_ring_edges()), "feature int, polygon int, x1 double, y1 double, x2 double, y2 double")
    marks = spark.createDataFrame(list(MARKS), "target_id long, x double, y double")
    targets = _targets(spark, sf).select("target_id", "x", "y")
    return spatial.inside(targets.unionByName(marks), edges, 500.0, "target_id").select("target_id")


DISTANCES = f"""SELECT target_id, point_id, p.x, p.y, value, sqrt((p.x - s.x) * (p.x - s.x) + (p.y - s.y) * (p.y - s.y)) AS d
FROM ({PLACES}) p, ({POINTS}) s"""


@query("X5_distance_mask", f"SELECT target_id FROM ({DISTANCES}) GROUP BY target_id HAVING min(d) <= 2000", "targets", "stations")
def _(spark, sf):
    stations = _stations(spark, sf)
    index = spatial.point_index(stations, 1).persist()
    return spatial.distance_mask(_targets(spark, sf), stations, 2000.0, index=index).select("target_id")


@query("X6_idw", f"""SELECT target_id, round(x, 4) AS x, round(y, 4) AS y, count(*) AS neighbours,
round(CASE WHEN min(d) < 1e-8 THEN arg_min(value, (d, point_id)) ELSE sum(value * pow(greatest(d, 1e-8), -2))
/ sum(pow(greatest(d, 1e-8), -2)) END, 6) AS estimate FROM (SELECT *, row_number() OVER (PARTITION BY target_id
ORDER BY d, point_id) AS rn FROM ({DISTANCES})) WHERE rn <= 8 GROUP BY target_id, x, y""", "targets", "stations")
def _(spark, sf):
    stations = _stations(spark, sf)
    index = spatial.point_index(stations, 8).persist()
    found = spatial.idw(_targets(spark, sf), stations, "value", 8, 2.0, index=index)
    return found.withColumn("x", F.round("x", 4)).withColumn("y", F.round("y", 4))


@query("X7_reconcile_points", f"""SELECT station_id, CASE WHEN station_id = 'NATION_5' THEN 'value_differs'
ELSE 'unknown_point' END AS issue FROM ({SPATIAL.replace('>= 40.0', '>= 0.0')})
WHERE station_id = 'NATION_5' OR station_id NOT IN (SELECT station_id FROM ({SPATIAL}))""", "placed")
def _(spark, sf):
    """Stored points of a looser rule with one value changed, against a fresh summary."""
    shift = F.when(F.col("station_id") == "NATION_5", 0.001).otherwise(0.0)
    stored = _points(spark, sf, 0.0).withColumn("latitude", F.col("latitude") + shift)
    return spatial.reconcile_points(stored, _points(spark, sf), "station_id")


HULL = """SELECT s_nationkey AS feature, min(latitude) AS lo_y, max(latitude) AS hi_y, min(longitude) AS lo_x,
max(longitude) AS hi_x FROM (SELECT s.*, s_nationkey FROM stations s JOIN supplier ON s_suppkey = point_id) GROUP BY s_nationkey"""


@query("S12_boundary_edges", f"""SELECT CAST(feature AS BIGINT) AS feature, 0 AS polygon, 0 AS ring, CAST(edge AS INTEGER) AS edge,
CASE WHEN edge IN (1, 4) THEN lo_x ELSE hi_x END AS x1, CASE WHEN edge <= 2 THEN lo_y ELSE hi_y END AS y1,
CASE WHEN edge <= 2 THEN hi_x ELSE lo_x END AS x2, CASE WHEN edge IN (2, 3) THEN hi_y ELSE lo_y END AS y2
FROM ({HULL}), (SELECT unnest([1, 2, 3, 4]) AS edge)""", "stations")
def _(spark, sf):
    """Bounding boxes of the nations, written as one GeoJSON feature per line and read back."""
    path = f"{scratch_dir(spark)}/boundary"
    _boxes(spark, sf).select(F.to_json(F.struct(F.col("s_nationkey").alias("id"), "geometry"))).write.text(path)
    return spatial.boundary_edges(spark, path, one_document=False)


def _boxes(spark, sf):
    nation = b.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("point_id"), "s_nationkey")
    box = b.stations(spark, sf).join(nation, "point_id").groupBy("s_nationkey").agg(
        F.min("longitude").alias("x0"), F.max("longitude").alias("x1"), F.min("latitude").alias("y0"),
        F.max("latitude").alias("y1"))
    corner = [F.array(x, y) for x, y in (("x0", "y0"), ("x1", "y0"), ("x1", "y1"), ("x0", "y1"), ("x0", "y0"))]
    geometry = F.struct(F.lit("Polygon").alias("type"), F.array(F.array(*corner)).alias("coordinates"))
    return box.select("s_nationkey", geometry.alias("geometry"))


@query("S12_feature_collection", f"""SELECT dense_rank() OVER (ORDER BY feature) - 1 AS feature, 0 AS polygon, 0 AS ring, CAST(edge AS INTEGER) AS edge,
CASE WHEN edge IN (1, 4) THEN lo_x ELSE hi_x END AS x1, CASE WHEN edge <= 2 THEN lo_y ELSE hi_y END AS y1,
CASE WHEN edge <= 2 THEN hi_x ELSE lo_x END AS x2, CASE WHEN edge IN (2, 3) THEN hi_y ELSE lo_y END AS y2
FROM ({HULL}), (SELECT unnest([1, 2, 3, 4]) AS edge)""", "stations")
def _(spark, sf):
    """The same boxes as one document, which many tasks read."""
    feature = F.struct(F.lit("Feature").alias("type"), F.struct(F.col("s_nationkey").cast("string").alias("name")).alias("properties"), "geometry")
    listed = F.array_sort(F.collect_list(F.struct("s_nationkey", F.to_json(feature).alias("text"))))
    texts = F.array_join(F.transform(listed, lambda f: f["text"]), ", ")
    document = F.concat(F.lit('{"type": "FeatureCollection", "features": ['), texts, F.lit("]}"))
    path = f"{scratch_dir(spark)}/boundary"
    _boxes(spark, sf).agg(document.alias("value")).write.text(path)
    return spatial.boundary_edges(spark, path)
