"""Top rows and exact percentiles without large groups in one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from gaugeworks.functions.order import order_image


def top_rows(df: DataFrame, k: int, order: Sequence[Column], by: Sequence[str] = ()) -> DataFrame:
    """First ``k`` rows in ``order``, overall or of each group.

    Both forms cut every task's rows to ``k`` per group before anything is shuffled.
    """
    if not by:
        return df.orderBy(*order).limit(k)
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= k).drop("_rank")


def join_same(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal keys where null equals null.

    Groups with a null key stay. No not-null filter is pushed below the inputs either, so
    inputs derived from one aggregate keep sharing its shuffle.
    """
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return left.join(renamed, same, how).drop(*[f"_r_{k}" for k in keys])


# Bits of the order image that are settled before the values of a bucket are put in order, and per level.
LEVEL_BITS, LEVELS = 16, 3
RANK_BITS = 21


def exact_percentiles(df: DataFrame, by: Sequence[str], value: str | Column, probs: Mapping[str, float],
                      count: str | None = None, weight: Column | None = None) -> DataFrame:
    """Exact percentiles with linear interpolation, one row per group.

    Values are counted before the first shuffle. A double's order image is then descended 16 bits a level:
    totals per bucket locate the wanted ranks, and only buckets that hold one go on to the next level, so
    that a window orders at most 2**16 buckets or doubles, whatever the range or the number of values. Totals of
    all levels are added up from the finest one, so the values are read and shuffled once. Null values do
    not count; a group of them has null percentiles. A row stands for ``weight`` rows if that is given.
    """
    value = F.col(value) if isinstance(value, str) else value
    number = F.count("*") if weight is None else F.sum(weight)
    counts = (df.groupBy(*by, value.alias("_v")).agg(number.alias("_n"))
              .select(*by, "_v", F.when(F.col("_v").isNotNull(), F.col("_n")).otherwise(0).alias("_n"),
                      F.shiftright(order_image(F.col("_v")), LEVEL_BITS).alias("_b")))
    totals = [counts.groupBy(*by, "_b").agg(F.sum("_n").alias("_n"))]
    for _ in range(LEVELS - 1):
        up = F.shiftright("_b", LEVEL_BITS).alias("_b")
        totals.append(totals[-1].groupBy(*by, up).agg(F.sum("_n").alias("_n")))

    group = Window.partitionBy(*by)
    wanted = []
    for name, p in probs.items():
        rank = F.lit(float(p)) * (F.col("_all") - 1)
        wanted.append(F.struct(F.lit(name).alias("p"), F.floor(rank).alias("lo"), F.ceil(rank).alias("hi"),
                               (rank - F.floor(rank)).alias("part")))

    def holding(buckets: DataFrame) -> DataFrame:
        """Buckets with a wanted rank, from running ends and the ranks of the bucket above."""
        first = F.col("_end") - F.col("_n")

        def touches(x: Column) -> Column:
            return ((x["lo"] >= first) & (x["lo"] < F.col("_end"))) | ((x["hi"] >= first) & (x["hi"] < F.col("_end")))

        return (buckets.withColumn("_ranks", F.filter("_ranks", touches))
                .where((F.size("_ranks") > 0) | (F.col("_all") == 0))
                .select(*by, F.col("_b").alias("_up"), first.alias("_start"), "_all", "_ranks"))

    def running(rows: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return rows.withColumn("_end", F.col("_start") + F.sum("_n").over(w))

    top = totals.pop().withColumns({"_start": F.lit(0), "_all": F.sum("_n").over(group)})
    found = holding(running(top.withColumn("_ranks", F.array(*wanted)), by, "_b"))
    while totals:
        finer = totals.pop().withColumn("_up", F.shiftright("_b", LEVEL_BITS))
        found = holding(running(join_same(finer, found, [*by, "_up"]), [*by, "_up"], "_b"))
    last = join_same(counts.withColumnRenamed("_b", "_up"), found, [*by, "_up"])
    ranked = (running(last, [*by, "_up"], "_v").withColumn("_from", F.col("_end") - F.col("_n"))
              .select(*by, "_v", "_all", "_from", "_end", F.inline_outer("_ranks")))

    def at(name: str, rank: str, out: Column) -> Column:
        hit = (F.col("p") == name) & (F.col(rank) >= F.col("_from")) & (F.col(rank) < F.col("_end"))
        return F.max(F.when(hit, out))

    picked = ranked.groupBy(*by).agg(
        F.max("_all").alias("_all"),
        *[at(n, "lo", F.col("_v")).alias(f"_lo_{n}") for n in probs],
        *[at(n, "hi", F.col("_v")).alias(f"_hi_{n}") for n in probs],
        *[at(n, "lo", F.col("part")).alias(f"_part_{n}") for n in probs])
    lo, hi = ({n: F.col(f"_{side}_{n}") for n in probs} for side in ("lo", "hi"))
    between = [F.when(lo[n] == hi[n], lo[n]).otherwise(lo[n] + (hi[n] - lo[n]) * F.col(f"_part_{n}")).alias(n) for n in probs]
    extra = [F.col("_all").alias(count)] if count else []
    return picked.select(*by, *extra, *between)


def distributed_rank(df: DataFrame, code: str, ties: Sequence[Column], bits: int, rank: str = "rank") -> DataFrame:
    """Add each row's place, from 0, in the order of ``code`` (a whole number of ``bits`` bits, not negative), then ``ties``.

    Rows are counted per code, and codes per prefix, 21 bits a level. Offsets then come down from the shortest
    prefix; a window holds at most the 2**21 extensions of one prefix, or the rows of one code.
    """
    levels = [df.groupBy(F.col(code).alias("_p")).agg(F.count("*").alias("_n"))]
    for _ in range((bits - 1) // RANK_BITS):
        levels.append(levels[-1].groupBy(F.shiftright("_p", RANK_BITS).alias("_p")).agg(F.sum("_n").alias("_n")))

    def before(rows: DataFrame) -> DataFrame:
        w = Window.partitionBy("_up").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
        return rows.select("_p", "_n", (F.col("_base") + F.coalesce(F.sum("_n").over(w), F.lit(0))).alias("_base"))

    found = before(levels.pop().withColumns({"_up": F.lit(0), "_base": F.lit(0).cast("long")}))
    while levels:
        above = found.select(F.col("_p").alias("_up"), "_base")
        found = before(levels.pop().withColumn("_up", F.shiftright("_p", RANK_BITS)).join(above, "_up"))
    own = F.row_number().over(Window.partitionBy(code).orderBy(*ties)) - 1
    base = found.select(F.col("_p").alias(code), "_base")
    return df.join(base, code).withColumn(rank, F.col("_base") + own).drop("_base")
