"""Intervals between consecutive readings, gap classes and span coverage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from gaugeworks.functions.grid import MICROS, epoch_micros, epoch_seconds, floor_div
from gaugeworks.functions.values import ratio
from gaugeworks.operators.ranking import join_same, top_rows
from gaugeworks.spec import SeriesSpec

# Class names with their inclusive upper bounds, in seconds.
GAP_CLASSES = ("under_5min", "exact_5min", "5_to_10min", "10_to_30min", "30_to_60min",
               "1_to_24h", "1_to_7d", "over_7d")
GAP_EDGES = (600, 1_800, 3_600, 86_400, 604_800)
BLOCK_SLOTS = 288
DAY_SECONDS = 86_400


def intervals_and_ends(df: DataFrame, s: SeriesSpec, time: str | None = None, within: Sequence[str] = (),
                       block_slots: int = BLOCK_SLOTS, unique: bool = False) -> tuple[DataFrame, DataFrame]:
    """Pairs of consecutive distinct times of an id inside its period, and what each time block holds.

    A window over the whole history of an id would put the largest id into one task. The last time
    seen is carried over four levels instead: times inside a second, seconds inside a block of at most a day, blocks of
    an id. A window holds a second's fractions, or two rows per second of a block, or an id's blocks,
    whatever the resolution. Series of whole seconds have nothing on the finest level.

    The wall clock is worked out once per reading and goes along as whole seconds. A level's window and its
    ends read one shuffle, and sort by the id first: its leading bytes settle most comparisons, those of the period few.

    The second result has, per id and block, ``ts`` and ``last``, its first and last time, and ``n``, the number of
    distinct ones. Copies of a time are merged on the map side first; pass ``unique`` when the key already is.
    """
    key, by = [*within, s.entity], [s.entity, *within]
    seen = df.select(*key, F.col(time or s.time).alias("ts"), epoch_micros(time or s.time).alias("micros"))
    # The count is part of both conditions below. Conditions on the time or the id alone would go below the merge:
    # each branch would scan the source for itself, and parse every time once for the condition and once for the row.
    seen = (seen.withColumn("n", F.lit(1).cast("long")) if unique
            else seen.groupBy(*key, "ts", "micros").agg(F.count("*").alias("n")))
    fine = F.when((F.col("n") > 0) & F.col(s.entity).isNotNull(), F.pmod("micros", F.lit(MICROS)) != 0)
    seen = seen.withColumn("second", floor_div(F.col("micros"), MICROS))
    fraction = seen.where(fine).select(*key, "second", "ts").repartition(*by, "second")
    seconds = fraction.groupBy(*key, "second").agg(F.min("ts").alias("ts"), F.max("ts").alias("last"), F.count("*").alias("n"))
    whole = seen.where(~fine).select(*key, "second", "ts", F.col("ts").alias("last"), F.lit(1).cast("long").alias("n"))
    width = min(block_slots * s.slot_seconds, DAY_SECONDS)
    steps = (whole.unionByName(seconds).withColumn("block", floor_div(F.col("second"), width))
             .repartition(*by, "block"))
    ends = steps.groupBy(*key, "block").agg(
        F.min("ts").alias("ts"), F.max("last").alias("last"), F.sum("n").alias("n"),
        F.min_by("second", "ts").alias("second"), F.max_by("second", "last").alias("last_second"))

    def carried(rows: DataFrame, inside: Sequence[str], last: str, last_second: str) -> DataFrame:
        w = Window.partitionBy(*by, *inside).orderBy("ts")
        before = {"prev_ts": F.lag(last).over(w), "prev_second": F.lag(last_second).over(w)}
        gap = (F.col("second") - F.col("prev_second")).alias("gap_seconds")
        return rows.withColumns(before).where("prev_ts is not null").select(*key, "prev_ts", "ts", gap)

    # Inside a second the gap is zero whole seconds: said outright, longer gaps are not looked for there.
    inner = carried(fraction, ["second"], "ts", "second").withColumn("gap_seconds", F.lit(0).cast("long"))
    pairs = (carried(steps, ["block"], "last", "second").unionByName(carried(ends, [], "last", "last_second"))
             .unionByName(inner))
    return pairs, ends.drop("second", "last_second")


def intervals(df: DataFrame, s: SeriesSpec, time: str | None = None, within: Sequence[str] = (),
              block_slots: int = BLOCK_SLOTS, unique: bool = False) -> DataFrame:
    """One row per pair of consecutive distinct times of an id, see :func:`intervals_and_ends`."""
    return intervals_and_ends(df, s, time, within, block_slots, unique)[0]


def missing_slots(pairs: DataFrame, s: SeriesSpec) -> DataFrame:
    """Estimated missing slots: whole slots strictly between the endpoints of a long gap."""
    gap, slot = F.col("gap_seconds"), s.slot_seconds
    whole = floor_div(gap + (slot - 1), slot) - 1
    return pairs.withColumn("estimated_missing_slots",
                            F.when(gap > slot, F.greatest(F.lit(0).cast("long"), whole)).otherwise(F.lit(0).cast("long")))


def _class_of(gap: Column, slot: int, edges: Sequence[int]) -> Column:
    out = F.when(gap < slot, F.lit(GAP_CLASSES[0])).when(gap == slot, F.lit(GAP_CLASSES[1]))
    for name, edge in zip(GAP_CLASSES[2:], edges):
        out = out.when(gap <= edge, F.lit(name))
    return out.otherwise(F.lit(GAP_CLASSES[-1]))


def gap_class(pairs: DataFrame, s: SeriesSpec, edges: Sequence[int] = GAP_EDGES) -> DataFrame:
    return pairs.withColumn("gap_class", _class_of(F.col("gap_seconds"), s.slot_seconds, edges))


def gap_distribution(classed: DataFrame, by: Sequence[str]) -> DataFrame:
    """Intervals and missing slots per group and class; absent classes count zero.

    Takes the result of :func:`missing_slots` and :func:`gap_class`. Every class is counted
    conditionally in one aggregate, then unpivoted, so no class table has to be joined.
    """
    zero = F.lit(0).cast("long")
    counted = []
    for c in GAP_CLASSES:
        here = F.col("gap_class") == c
        counted.append(F.struct(
            F.lit(c).alias("gap_class"), F.count_if(here).alias("intervals"),
            F.coalesce(F.sum(F.when(here, F.col("estimated_missing_slots"))), zero)
            .alias("estimated_missing_slots")))
    return (classed.groupBy(*by).agg(F.array(*counted).alias("classes"))
            .select(*by, F.inline("classes")))


def span_coverage_raw(ends: DataFrame, pairs: DataFrame, s: SeriesSpec, by: Sequence[str] = ()) -> DataFrame:
    """Distinct readings against the slots of the observed span; off-grid input may exceed 1.

    Takes both results of :func:`intervals_and_ends`, the pairs with their missing slots: the readings are not
    looked at again.
    """
    key = [*by, s.entity]
    per_id = ends.groupBy(*key).agg(F.sum("n").alias("observed_unique"), F.min("ts").alias("first_ts"),
                                    F.max("last").alias("last_ts"))
    gaps = pairs.groupBy(*key).agg(
        F.count_if(F.col("gap_seconds") > s.slot_seconds).alias("gaps_over_slot"),
        F.sum("estimated_missing_slots").alias("estimated_missing_slots"),
        F.max("gap_seconds").alias("max_gap_seconds"))
    span = epoch_seconds("last_ts") - epoch_seconds("first_ts")
    return (join_same(per_id, gaps, key, "left")
            .withColumn("expected_slots_span", floor_div(span, s.slot_seconds) + 1)
            .withColumn("coverage_span_approx", ratio(F.col("observed_unique"), F.col("expected_slots_span"))))


def monthly_gaps(pairs: DataFrame, s: SeriesSpec, by: Sequence[str] = ()) -> DataFrame:
    """Long gaps by the month of the later reading."""
    return (pairs.where(F.col("gap_seconds") > s.slot_seconds)
            .groupBy(*by, F.month("ts").alias("month"))
            .agg(F.count("*").alias("gaps_over_slot"),
                 F.sum("estimated_missing_slots").alias("estimated_missing_slots")))


def longest_gaps(pairs: DataFrame, s: SeriesSpec, k: int = 20, by: Sequence[str] = ()) -> DataFrame:
    """The ``k`` longest gaps, of each period when ``by`` names one; the key settles ties."""
    long = pairs.where(F.col("gap_seconds") > s.slot_seconds)
    return (top_rows(long, k, [F.desc("gap_seconds"), F.col(s.entity), F.col("ts")], by)
            .select(*by, s.entity, "prev_ts", "ts", "gap_seconds", "estimated_missing_slots"))


def shortest_intervals(pairs: DataFrame, s: SeriesSpec, k: int = 150, by: Sequence[str] = ()) -> DataFrame:
    short = pairs.where(F.col("gap_seconds") < s.slot_seconds)
    return (top_rows(short, k, [F.col("gap_seconds"), F.col(s.entity), F.col("ts")], by)
            .select(*by, s.entity, "prev_ts", "ts", "gap_seconds"))


def span_coverage(df: DataFrame, s: SeriesSpec, by: Sequence[str] = ()) -> DataFrame:
    """Coverage of clean series between the first and last reading of each id."""
    span = epoch_seconds("last_time") - epoch_seconds("first_time")
    stats = df.where(F.col(s.time).isNotNull()).groupBy(*by, s.entity).agg(
        F.min(s.name).alias(s.name), F.count("*").alias("observed_intervals"),
        F.min(s.time).alias("first_time"), F.max(s.time).alias("last_time"))
    expected = F.col("expected_between_first_last")
    return stats.withColumn("expected_between_first_last", floor_div(span, s.slot_seconds) + 1).withColumns({
        "missing_intervals": F.greatest(F.lit(0).cast("long"), expected - F.col("observed_intervals")),
        "coverage_pct": F.round(ratio(F.col("observed_intervals") * 100, expected), 4)})


def gap_size_distribution(df: DataFrame, s: SeriesSpec, by: Sequence[str] = ()) -> DataFrame:
    """Gaps of a clean series per id: events, missing slots, longest, one / two to five / six up."""
    missing = F.col("missing")
    long_gaps = (intervals(df, s, within=by, unique=True).where(F.col("gap_seconds") > s.slot_seconds)
                 .withColumn("missing", floor_div(F.col("gap_seconds"), s.slot_seconds) - 1))
    return long_gaps.groupBy(*by, s.entity).agg(
        F.count("*").alias("gap_events"), F.sum(missing).alias("missing_intervals"),
        F.max("gap_seconds").alias("longest_gap_seconds"), F.count_if(missing == 1).alias("one_missing"),
        F.count_if(missing.between(2, 5)).alias("two_to_five_missing"),
        F.count_if(missing >= 6).alias("six_plus_missing"))
