"""Coverage sensitivity, cohorts and report tables on summary rows."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from gaugeworks.functions.grid import slots_in_month, slots_in_year
from gaugeworks.functions.values import non_finite, ratio
from gaugeworks.operators.checks import issues
from gaugeworks.operators.gaps import GAP_CLASSES
from gaugeworks.operators.ranking import exact_percentiles
from gaugeworks.operators.summaries import label_of
from gaugeworks.spec import EXCEEDANCE_THRESHOLDS, SPATIAL_YEARS, STUDY_YEARS, SeriesSpec

TOTALS = ("observed_intervals", "rainy_intervals", "recorded_rainfall_mm")
WEIGHTINGS = ("pooled", "equal_station_period")
LONG_GAPS = GAP_CLASSES[2:]


def _values(df: DataFrame, name: str, values: Sequence) -> DataFrame:
    """A literal list as a table of one column."""
    return df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(v) for v in values])).alias(name))


def validate_summary(frame: DataFrame, keys: Sequence[str], s: SeriesSpec,
                     years: Sequence[int] = STUDY_YEARS) -> DataFrame:
    """Broken rules of a summary table; an empty result means it can be used."""
    numbers = [*TOTALS, "calendar_expected_intervals", "calendar_coverage_pct"]
    observed = F.col("observed_intervals")
    if "month" in keys:
        expected = slots_in_month(F.col("year"), F.col("month"), s.slot_seconds)
        rules = {"month_out_of_range": ~F.col("month").between(1, 12)}
        expected = F.when(F.col("month").between(1, 12), expected)
    else:
        expected = slots_in_year(F.col("year"), s.slot_seconds)
        rules = {}
    null_key = F.lit(False)
    unusable = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    for c in numbers:
        as_double = F.col(c).cast("double")
        unusable = unusable | as_double.isNull() | non_finite(as_double) | (as_double < 0)
    rules |= {
        "null_key": null_key,
        "not_finite_or_negative": unusable,
        "no_observations": observed <= 0,
        "rainy_exceeds_observed": F.col("rainy_intervals") > observed,
        "count_not_integer": (observed != F.floor(observed)) | (F.col("rainy_intervals") != F.floor("rainy_intervals")),
        "wrong_calendar_denominator": F.col("calendar_expected_intervals") != expected,
        "coverage_over_100": observed > expected,
        "coverage_disagrees": F.abs(F.col("calendar_coverage_pct") - ratio(observed * 100, expected)) > 1e-7,
        "unexpected_year": ~F.col("year").isin(*years),
    }
    zero = F.lit(0).cast("long")
    per_key = frame.groupBy(*keys).agg(F.count("*").alias("n"), *[F.count_if(r).alias(n) for n, r in rules.items()])
    present = F.count_distinct(F.when(F.col("year").isin(*years), F.col("year")))
    counts = per_key.agg(
        *[F.coalesce(F.sum(n), zero).alias(n) for n in rules],
        F.coalesce(F.sum(F.col("n") - 1), zero).alias("duplicate_key"),
        (F.lit(len(years)) - present).alias("missing_year"),
        (F.count("*") == 0).cast("long").alias("empty_summary"))
    return issues(counts, [*rules, "duplicate_key", "missing_year", "empty_summary"])


def _check_years(years: Sequence[int], min_coverage: float = 0.0) -> None:
    repeated = sorted(y for y, n in Counter(years).items() if n > 1)
    if repeated or not years:
        raise ValueError(f"Years asked for more than once: {repeated}" if repeated else "No year asked for")
    if min_coverage < 0 or min_coverage > 100:
        raise ValueError(f"Coverage is a percentage, not {min_coverage}")


def balanced_ids(station_year: DataFrame, s: SeriesSpec, years: Sequence[int] = STUDY_YEARS,
                 min_coverage: float = 0.0) -> DataFrame:
    """Ids that reach the coverage in every requested year."""
    _check_years(years, min_coverage)
    fit = F.col("year").isin(*years) & (F.col("calendar_coverage_pct") >= min_coverage)
    return (station_year.where(fit).groupBy(s.entity).agg(F.count_distinct("year").alias("eligible_years"))
            .where(F.col("eligible_years") == len(years)))


def _block(s: SeriesSpec) -> list[Column]:
    """Both weightings of one period, from the same aggregate."""
    n, wet, total = (F.col(c) for c in TOTALS)
    return [
        F.count_distinct(s.entity).alias("stations"), F.count("*").alias("station_periods"),
        F.sum(n).alias("observed_intervals"), F.sum(wet).alias("rainy_intervals"),
        F.sum(total).alias("recorded_rainfall_mm"),
        F.avg(ratio(wet * 100, n)).alias("_equal_pct"), F.avg(ratio(total, n)).alias("_equal_mean")]


def _finish(blocks: DataFrame, spine: DataFrame, keys: Sequence[str], group: str,
            weightings: Sequence[str]) -> DataFrame:
    """Every spine row, zero counts and null rates where it is empty, one row per weighting."""
    zero = F.lit(0).cast("long")
    rows = spine.join(blocks, list(keys), "left")
    n = F.col("observed_intervals")
    pooled = {"pooled": (ratio(F.col("rainy_intervals") * 100, n), ratio(F.col("recorded_rainfall_mm"), n)),
              "equal_station_period": (F.col("_equal_pct"), F.col("_equal_mean"))}
    both = F.array(*[F.struct(F.lit(w).alias("weighting"), pooled[w][0].alias("rainy_pct"),
                              pooled[w][1].alias("mean_mm_per_interval")) for w in weightings])
    out = rows.withColumn("_both", both)
    rest = [k for k in keys if k != group]
    return out.select(
        group, *rest, *[F.coalesce(c, zero).alias(c) for c in
                        ("stations", "station_periods", "observed_intervals", "rainy_intervals")],
        F.coalesce("recorded_rainfall_mm", F.lit(0.0)).alias("recorded_rainfall_mm"), F.inline("_both"))


def summarize(frame: DataFrame, group: str, periods: Sequence[int], weighting: str, s: SeriesSpec) -> DataFrame:
    """Rates per period: pooled over readings, or equal weight for each summary row."""
    if weighting not in WEIGHTINGS:
        raise ValueError(f"Unknown weighting: {weighting}")
    blocks = frame.groupBy(group).agg(*_block(s))
    return _finish(blocks, _values(frame, group, list(periods)), [group], group, [weighting])


def _cohort_flags(thresholds: Sequence[float], n_years: int, present: Column, least: Column,
                  coverage: Column) -> list[Column]:
    """(cohort, threshold, member) structs for one entity-year."""
    complete = present == n_years

    def entry(cohort: str, t: float, member: Column) -> Column:
        return F.struct(F.lit(cohort).alias("cohort"), F.lit(float(t)).alias("min_coverage_pct"),
                        F.coalesce(member, F.lit(False)).alias("selected"))

    flags = [entry("all_reporting", 0.0, coverage.isNotNull()),
             entry("common_all_years", 0.0, coverage.isNotNull() & complete)]
    for t in thresholds:
        flags.append(entry("eligible_each_year", t, coverage >= t))
        flags.append(entry("balanced_all_years", t, coverage.isNotNull() & complete & (least >= t)))
    return flags


def _cohort_names(thresholds: Sequence[float]) -> list[tuple[str, float]]:
    pairs = [("all_reporting", 0.0), ("common_all_years", 0.0)]
    for t in thresholds:
        pairs += [("eligible_each_year", float(t)), ("balanced_all_years", float(t))]
    return pairs


def _in_years(years: Sequence[int]) -> Column:
    return F.col("year").isin(*years)


def annual_sensitivity(station_year: DataFrame, s: SeriesSpec, thresholds: Sequence[float] = (80.0, 90.0),
                       years: Sequence[int] = STUDY_YEARS) -> DataFrame:
    """Annual rates of every cohort under both weightings, empty cohorts included.

    Membership comes from a window over the few years of one id, so cohorts need no joins.
    """
    _check_years(years)
    per_id = Window.partitionBy(s.entity)
    inside = _in_years(years)
    flagged = station_year.withColumn("_present", F.count_if(inside).over(per_id)).withColumn(
        "_least", F.min(F.when(inside, F.col("calendar_coverage_pct"))).over(per_id))
    flags = _cohort_flags(thresholds, len(years), F.col("_present"), F.col("_least"), F.col("calendar_coverage_pct"))
    members = flagged.select("year", s.entity, *TOTALS, F.inline(F.array(*flags))).where("selected")
    keys = ["year", "cohort", "min_coverage_pct"]
    blocks = members.groupBy(*keys).agg(*_block(s))
    cohorts = F.array(*[F.struct(F.lit(c).alias("cohort"), F.lit(t).alias("min_coverage_pct"))
                        for c, t in _cohort_names(thresholds)])
    spine = _values(station_year, "year", list(years)).select("year", F.inline(cohorts))
    return _finish(blocks, spine, keys, "year", WEIGHTINGS)


def cohort_audit(station_year: DataFrame, s: SeriesSpec, thresholds: Sequence[float] = (80.0, 90.0),
                 years: Sequence[int] = STUDY_YEARS) -> DataFrame:
    """Membership of every id in every year and cohort; absent years stay visible."""
    _check_years(years)
    inside = _in_years(years)
    per_id = station_year.groupBy(s.entity).agg(
        F.count_if(inside).alias("_present"),
        F.min(F.when(inside, F.col("calendar_coverage_pct"))).alias("_least"),
        *[F.max(F.when(F.col("year") == y, F.col("calendar_coverage_pct"))).alias(f"_y{y}") for y in years])
    grid = F.array(*[F.struct(F.lit(y).alias("year"), F.col(f"_y{y}").alias("calendar_coverage_pct")) for y in years])
    rows = per_id.select(s.entity, "_present", "_least", F.inline(grid))
    flags = _cohort_flags(thresholds, len(years), F.col("_present"), F.col("_least"), F.col("calendar_coverage_pct"))
    return rows.select(s.entity, "year", "calendar_coverage_pct", F.inline(F.array(*flags)))


def monthly_sensitivity(station_month: DataFrame, s: SeriesSpec,
                        thresholds: Sequence[float] = (80.0, 90.0)) -> DataFrame:
    """Seasonal rates; the threshold applies to the coverage of the entity's month."""
    levels = [0.0, *map(float, thresholds)]
    hit = F.filter(F.array(*[F.lit(t) for t in levels]), lambda t: F.col("calendar_coverage_pct") >= t)
    members = station_month.select("month", s.entity, *TOTALS, F.explode(hit).alias("min_coverage_pct"))
    keys = ["month", "min_coverage_pct"]
    blocks = members.groupBy(*keys).agg(*_block(s))
    spine = _values(station_month, "month", list(range(1, 13))).select(
        "month", F.explode(F.array(*[F.lit(t) for t in levels])).alias("min_coverage_pct"))
    return _finish(blocks, spine, keys, "month", WEIGHTINGS).withColumn("cohort", F.lit("eligible_station_months"))


def spatial_summary(station_year: DataFrame, s: SeriesSpec, years: Sequence[int] = SPATIAL_YEARS,
                    min_coverage: float = 80.0) -> DataFrame:
    """Balanced ids over fixed years: equal mean of annual rates and median coordinates.

    A group holds the few requested years of one id, so the exact median is cheap.
    """
    _check_years(years, min_coverage)
    n = F.col("observed_intervals")
    cov = F.col("calendar_coverage_pct")
    per_id = station_year.where(_in_years(years)).groupBy(s.entity).agg(
        F.avg(ratio(F.col("rainy_intervals") * 100, n)).alias("rainy_pct"),
        F.avg(ratio(F.col("recorded_rainfall_mm"), n)).alias("mean_mm_per_interval"),
        F.count_distinct("year").alias("eligible_years"), F.min(cov).alias("min_calendar_coverage_pct"),
        F.percentile("latitude", 0.5).alias("latitude"), F.percentile("longitude", 0.5).alias("longitude"))
    return per_id.where((F.col("eligible_years") == len(years)) & (F.col("min_calendar_coverage_pct") >= min_coverage)
                        ).withColumn("analysis_years", F.lit(",".join(map(str, years))))


def spatial_rows(station_year: DataFrame, s: SeriesSpec, years: Sequence[int] = SPATIAL_YEARS,
                 min_coverage: float = 80.0) -> DataFrame:
    """The station-years behind the points of ``spatial_summary``."""
    points = spatial_summary(station_year, s, years, min_coverage).select(s.entity)
    return station_year.where(_in_years(years)).join(points, s.entity, "left_semi")


def reconcile(a: DataFrame, b: DataFrame, keys: Sequence[str], cols: Sequence[str],
              tol: float = 1e-5, rel: float = 1e-10) -> DataFrame:
    """Keys whose totals differ between two tables, or that one of them lacks."""
    def rolled(df: DataFrame, side: str) -> DataFrame:
        return df.groupBy(*keys).agg(*[F.sum(c).cast("double").alias(f"{side}_{c}") for c in cols],
                                     F.lit(True).alias(f"in_{side}"))

    joined = rolled(a, "left").join(rolled(b, "right"), list(keys), "full")
    differs = F.col("in_left").isNull() | F.col("in_right").isNull()
    for c in cols:
        x, y = F.col(f"left_{c}"), F.col(f"right_{c}")
        differs = differs | ~F.coalesce(F.abs(x - y) <= tol + rel * F.abs(y), F.lit(False))
    return joined.where(differs).drop("in_left", "in_right")


def weighted_rate(df: DataFrame, by: Sequence[str], numerator: str = "rainy_intervals") -> DataFrame:
    """Summed numerator over summed readings, with the mean amount per reading."""
    out = df.groupBy(*by).agg(*[F.sum(c).alias(c) for c in dict.fromkeys((numerator, *TOTALS))])
    n = F.col("observed_intervals")
    return out.withColumn("rate_pct", ratio(F.col(numerator) * 100, n)).withColumn(
        "mean_mm", ratio(F.col("recorded_rainfall_mm"), n))


def common_entity_summary(station_year: DataFrame, s: SeriesSpec, years: Sequence[int] = STUDY_YEARS) -> DataFrame:
    """Annual rates of the ids present in every year, beside those of all reporting ids."""
    common = F.count_if(_in_years(years)).over(Window.partitionBy(s.entity)) == len(years)
    flagged = station_year.withColumn("_common", common)

    def total(c: str, only: bool) -> Column:
        return F.sum(F.when(F.col("_common"), F.col(c)) if only else F.col(c))

    sums = flagged.groupBy("year").agg(
        F.count_if("_common").alias("stations"),
        *[total(c, True).alias(c) for c in TOTALS], *[total(c, False).alias(f"all_{c}") for c in TOTALS])

    def rates(prefix: str) -> dict[str, Column]:
        n = F.col(f"{prefix}observed_intervals")
        return {f"{prefix}rainy_pct": ratio(F.col(f"{prefix}rainy_intervals") * 100, n),
                f"{prefix}mean_mm": ratio(F.col(f"{prefix}recorded_rainfall_mm"), n)}

    return sums.withColumns({**rates(""), **rates("all_")}).drop(*[f"all_{c}" for c in TOTALS])


def monthly_accumulation(station_month: DataFrame, min_coverage: float = 90.0) -> DataFrame:
    """Median and quartiles of well-covered monthly totals; months without any stay as null rows."""
    good = station_month.where(F.col("calendar_coverage_pct") >= min_coverage)
    found = exact_percentiles(good, ["month"], "recorded_rainfall_mm",
                              {"median_mm": 0.5, "q25_mm": 0.25, "q75_mm": 0.75},
                              count="n_station_months")
    return _values(station_month, "month", list(range(1, 13))).join(found, "month", "left")


def histogram_share(hist: DataFrame) -> DataFrame:
    """Bin counts over all periods as shares of their total; empty bins are dropped."""
    pooled = hist.groupBy("bin_id", "lower_mm", "upper_mm").agg(F.sum("count").alias("count"))
    total = F.sum("count").over(Window.partitionBy(F.lit(0)))
    return pooled.withColumn("share_pct", ratio(F.col("count") * 100, total)).where(F.col("count") > 0)


def exceedance_rates(annual: DataFrame, thresholds: Sequence[float] = EXCEEDANCE_THRESHOLDS) -> DataFrame:
    """Overall exceedance rate of every threshold."""
    n = F.sum("observed_intervals")
    rates = [F.struct(F.lit(float(t)).alias("threshold_mm"),
                      ratio(F.sum(f"exceed_{label_of(t)}_mm_intervals") * 100, n).alias("rate_pct"))
             for t in thresholds]
    return annual.agg(F.array(*rates).alias("_r")).select(F.inline("_r"))


def rate_matrix(monthly: DataFrame) -> DataFrame:
    """Years by months, occurrence in percent."""
    pct = ratio(F.sum("rainy_intervals") * 100, F.sum("observed_intervals"))
    out = monthly.groupBy("year").pivot("month", list(range(1, 13))).agg(pct)
    return out.withColumnsRenamed({str(m): f"m{m:02d}" for m in range(1, 13)})


def annual_rates(annual: DataFrame) -> DataFrame:
    n = F.col("observed_intervals")
    return annual.select("year", ratio(F.col("rainy_intervals") * 100, n).alias("rainy_pct"),
                         ratio(F.col("recorded_rainfall_mm"), n).alias("mean_mm_per_interval"))


def eligible_counts(station_year: DataFrame, s: SeriesSpec, min_coverage: float = 80.0) -> DataFrame:
    return station_year.groupBy("year").agg(
        F.count_distinct(s.entity).alias("stations"),
        F.count_if(F.col("calendar_coverage_pct") >= min_coverage).alias("eligible_station_years"))


def box_stats(df: DataFrame, by: str, value: str) -> DataFrame:
    """Quartiles, 1.5 IQR whiskers and the number of outliers of each group."""
    quart = exact_percentiles(df, [by], value, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    fence = (F.col("q3") - F.col("q1")) * 1.5
    inside = F.col(value).between(F.col("q1") - fence, F.col("q3") + fence)
    counted = df.where(F.col(value).isNotNull()).groupBy(by, value).agg(F.count("*").alias("_n"))
    marked = counted.join(quart, by).withColumn("_inside", inside)
    return marked.groupBy(by).agg(
        F.sum("_n").alias("n"), *[F.min(c).alias(c) for c in ("q1", "median", "q3")],
        F.min(F.when(F.col("_inside"), F.col(value))).alias("whisker_low"),
        F.max(F.when(F.col("_inside"), F.col(value))).alias("whisker_high"),
        F.sum(F.when(F.col("_inside"), 0).otherwise(F.col("_n"))).alias("outliers"))


def gap_composition(gaps: DataFrame) -> DataFrame:
    """Share of each class among the gaps over one slot, classes as columns."""
    long = gaps.where(F.col("gap_class").isin(*LONG_GAPS))
    wide = long.groupBy("year").pivot("gap_class", list(LONG_GAPS)).agg(F.sum("intervals"))
    total = sum((F.coalesce(F.col(c), F.lit(0)) for c in LONG_GAPS[1:]), F.coalesce(F.col(LONG_GAPS[0]), F.lit(0)))
    return wide.select("year", *[ratio(F.coalesce(F.col(c), F.lit(0)) * 100, total).alias(f"pct_{c}")
                                 for c in LONG_GAPS])


def gap_matrix(monthly_gaps: DataFrame) -> DataFrame:
    """Years by months, long gaps, zero where there are none."""
    out = monthly_gaps.groupBy("year").pivot("month", list(range(1, 13))).agg(F.sum("gaps_over_slot"))
    return out.na.fill(0).withColumnsRenamed({str(m): f"m{m:02d}" for m in range(1, 13)})


def gap_vs_missing(gaps: DataFrame) -> DataFrame:
    """Long gaps and the missing readings they imply."""
    return gaps.groupBy("year").agg(
        F.sum(F.when(F.col("gap_class").isin(*LONG_GAPS), F.col("intervals")).otherwise(0)).alias("gaps_over_slot"),
        F.sum("estimated_missing_slots").alias("estimated_missing_slots"))
