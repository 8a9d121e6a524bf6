"""Coverage-aware summaries of clean series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from gaugeworks.functions.grid import slots_in_month, slots_in_year
from gaugeworks.functions.values import ratio
from gaugeworks.operators.ranking import exact_percentiles, join_same
from gaugeworks.spec import EXCEEDANCE_THRESHOLDS, HISTOGRAM_EDGES, TAIL_PERCENTILES, SeriesSpec


def label_of(number: float) -> str:
    return str(float(number)).replace(".", "p")


def calendar_cols(df: DataFrame, time: str) -> DataFrame:
    return df.withColumns({"year": F.year(time), "month": F.month(time), "hour": F.hour(time)})


def _exceeds(threshold: float) -> str:
    return f"exceed_{label_of(threshold)}_mm_intervals"


def _with_rates(df: DataFrame, thresholds: Sequence[float]) -> DataFrame:
    n = F.col("observed_intervals")
    rates = {"rainy_fraction": ratio(F.col("rainy_intervals"), n)}
    for t in thresholds:
        rates[f"exceed_{label_of(t)}_mm_fraction"] = ratio(F.col(_exceeds(t)), n)
    return df.withColumns(rates)


def metrics(df: DataFrame, by: Sequence[str], s: SeriesSpec,
            thresholds: Sequence[float] = EXCEEDANCE_THRESHOLDS) -> DataFrame:
    """Observed count, sum, means, wet count, maximum and strict exceedances of each group."""
    v = F.col(s.value)
    out = df.groupBy(*by).agg(
        F.count("*").alias("observed_intervals"), F.sum(v).alias("recorded_rainfall_mm"),
        F.avg(v).alias("mean_mm_per_observed_interval"), F.count_if(v > 0).alias("rainy_intervals"),
        F.avg(F.when(v > 0, v)).alias("mean_positive_rainfall_mm"), F.max(v).alias("max_five_min_rainfall_mm"),
        *[F.count_if(v > F.lit(float(t))).alias(_exceeds(t)) for t in thresholds])
    return _with_rates(out, thresholds)


# The grains of the summary tables.
GRAINS = {
    "annual": ("year",),
    "monthly": ("year", "month"),
    "hourly": ("year", "hour"),
    "station_year": ("year", "entity"),
    "station_month": ("year", "month", "entity"),
}


def metric_grains(df: DataFrame, s: SeriesSpec,
                  thresholds: Sequence[float] = EXCEEDANCE_THRESHOLDS) -> DataFrame:
    """All five grains from one scan, told apart by ``grain``.

    Readings are first reduced to (year, month, hour, id) cells. Every measure adds up or
    maximises, so the grouping sets expand those cells only, never the readings.
    """
    v = F.col(s.value)
    counts = ["observed_intervals", "rainy_intervals", *[_exceeds(t) for t in thresholds]]
    cells = df.groupBy("year", "month", "hour", F.col(s.entity)).agg(
        F.count("*").alias("observed_intervals"), F.sum(v).alias("recorded_rainfall_mm"),
        F.count_if(v > 0).alias("rainy_intervals"), F.sum(F.when(v > 0, v)).alias("wet_sum"),
        F.max(v).alias("max_five_min_rainfall_mm"),
        *[F.count_if(v > F.lit(float(t))).alias(_exceeds(t)) for t in thresholds])
    columns = ["year", "month", "hour", s.entity]
    sets = {g: [s.entity if c == "entity" else c for c in cols] for g, cols in GRAINS.items()}
    rolled = cells.groupingSets([[F.col(c) for c in cols] for cols in sets.values()],
                                *[F.col(c) for c in columns]).agg(
        F.grouping_id().alias("_gid"), *[F.sum(c).alias(c) for c in counts],
        F.sum("recorded_rainfall_mm").alias("recorded_rainfall_mm"), F.sum("wet_sum").alias("wet_sum"),
        F.max("max_five_min_rainfall_mm").alias("max_five_min_rainfall_mm"))
    grain = F.lit(None).cast("string")
    for g, cols in sets.items():
        bits = sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in cols)
        grain = F.when(F.col("_gid") == bits, F.lit(g)).otherwise(grain)
    out = rolled.withColumns({
        "grain": grain,
        "mean_mm_per_observed_interval": ratio(F.col("recorded_rainfall_mm"), F.col("observed_intervals")),
        "mean_positive_rainfall_mm": ratio(F.col("wet_sum"), F.col("rainy_intervals")),
    }).drop("_gid", "wet_sum")
    return _with_rates(out, thresholds)


def median_location(df: DataFrame, by: Sequence[str], s: SeriesSpec, exact: bool = False) -> DataFrame:
    """Smallest name and median coordinates per group: bounded sketch, or exact on request."""
    name = F.min(s.name).alias(s.name)
    if not exact:
        return df.groupBy(*by).agg(name, F.percentile_approx(s.latitude, 0.5).alias("latitude"),
                                   F.percentile_approx(s.longitude, 0.5).alias("longitude"))
    # Places are few; the axes are told apart and the names taken after counting them.
    places = df.groupBy(*by, s.latitude, s.longitude).agg(name, F.count("*").alias("_rows"))
    both = F.array(F.struct(F.lit("latitude").alias("axis"), F.col(s.latitude).cast("double").alias("at")),
                   F.struct(F.lit("longitude").alias("axis"), F.col(s.longitude).cast("double").alias("at")))
    medians = exact_percentiles(places.select(*by, "_rows", F.inline(both)), [*by, "axis"], "at", {"median": 0.5},
                                weight=F.col("_rows"))
    wide = medians.groupBy(*by).agg(*[F.max(F.when(F.col("axis") == a, F.col("median"))).alias(a)
                                      for a in ("latitude", "longitude")])
    return join_same(places.groupBy(*by).agg(F.min(s.name).alias(s.name)), wide, list(by))


def percentile_names(probs: Sequence[float]) -> dict[str, float]:
    return {f"p{label_of(p)}_mm": p for p in probs}


def tail_percentiles(df: DataFrame, by: Sequence[str], s: SeriesSpec,
                     probs: Sequence[float] = TAIL_PERCENTILES, exact: bool = False) -> DataFrame:
    """Percentiles of the positive values and their number; null percentiles where there are none."""
    wet = F.when(F.col(s.value) > 0, F.col(s.value))
    names = percentile_names(probs)
    if not exact:
        count = F.count(wet).alias("positive_intervals")
        sketch = F.percentile_approx(wet, [float(p) for p in probs], 10_000).alias("_p")
        out = df.groupBy(*by).agg(count, sketch)
        return out.select(*by, "positive_intervals",
                          *[F.get("_p", F.lit(i)).alias(n) for i, n in enumerate(names)])
    return exact_percentiles(df, by, wet, names, count="positive_intervals")


def histogram(df: DataFrame, by: Sequence[str], s: SeriesSpec,
              edges: Sequence[float] = HISTOGRAM_EDGES) -> DataFrame:
    """Counts of positive values in right-open bins, the last one unbounded; empty bins count zero."""
    v, bins = F.col(s.value), []
    for i, low in enumerate(edges):
        high = edges[i + 1] if i + 1 < len(edges) else None
        inside = (v > 0) & (v >= F.lit(float(low)))
        if high is not None:
            inside = inside & (v < F.lit(float(high)))
        bins.append(F.struct(
            F.lit(i).alias("bin_id"), F.lit(float(low)).alias("lower_mm"),
            F.lit(None if high is None else float(high)).cast("double").alias("upper_mm"),
            F.count_if(inside).alias("count")))
    return df.groupBy(*by).agg(F.array(*bins).alias("_bins")).select(*by, F.inline("_bins"))


def _coverage(df: DataFrame, expected: Column) -> DataFrame:
    return df.withColumn("calendar_expected_intervals", expected).withColumn(
        "calendar_coverage_pct",
        ratio(F.col("observed_intervals") * 100, F.col("calendar_expected_intervals")))


def annual_calendar_coverage(station_year: DataFrame, s: SeriesSpec) -> DataFrame:
    """Leap-aware coverage of the whole year, with the extrapolated diagnostic total."""
    out = _coverage(station_year, slots_in_year(F.col("year"), s.slot_seconds))
    return out.withColumn("calendar_extrapolated_rainfall_mm", ratio(
        F.col("recorded_rainfall_mm") * F.col("calendar_expected_intervals"), F.col("observed_intervals")))


def monthly_calendar_coverage(station_month: DataFrame, s: SeriesSpec) -> DataFrame:
    return _coverage(station_month, slots_in_month(F.col("year"), F.col("month"), s.slot_seconds))


def attach_location(station_year: DataFrame, location: DataFrame, s: SeriesSpec) -> DataFrame:
    """Add name and coordinates to entity-year rows."""
    return station_year.join(location.select("year", s.entity, s.name, "latitude", "longitude"),
                             ["year", s.entity], "left")
