"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

1. Targets: sources share all words by weight, none above ``most`` times its own size; the excess is
   reshared. In closed form each target is min(cap, level * weight) with one common level.
2. A source's documents fall into blocks by hash, so block order is a random order. Its target is whole
   passes over all blocks and a last pass over a prefix of them; the block at the cut is cut by document.
3. A binary tree deals the block quotas to output shards: a node's left child gets a multivariate
   hypergeometric draw of its quotas, the right child the rest. Quotas stay exact at every node.
4. Every shard takes the next disjoint run of each source's block sequence; hashes shuffle within it.

All of it is DataFrame expressions. The driver sees one number, the words of the mix, from which the tree's depth follows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from gaugeworks.llm.common import fresh
from gaugeworks.sources.scratch import materialise

WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...], most: float) -> DataFrame:
    """Source totals (source, source_size) with their target; one row per source.

    The windows run over sources, not over documents.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(w) for w in weights])
    ranked = sizes.withColumn("weight", F.element_at(cycle, F.pmod(F.row_number().over(order) - 1, len(weights)).cast("int") + 1))
    cap = F.col("source_size") * F.lit(most)
    by_ratio = Window.orderBy(cap / F.col("weight"), F.col("source").asc_nulls_last())
    everything, before = Window.partitionBy(), by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum(cap).over(before), F.lit(0.0))
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    # The level is the first one that the source itself does not exceed, in order of cap per weight.
    levels = ranked.withColumn("level", left / open_weight).withColumn("fits", F.col("level") * F.col("weight") <= cap)
    level = F.min(F.when(F.col("fits"), F.struct((cap / F.col("weight")).alias("r"), F.col("level").alias("v")))).over(everything)["v"]
    return levels.select("source", "source_size", "weight", F.least(cap, F.coalesce(level * F.col("weight"), cap)).cast("double").alias("target"))


def _uniform(seed: int, *keys: Column) -> Column:
    return (F.shiftrightunsigned(F.xxhash64(F.lit(seed), *keys), 11) + F.lit(0.5)) / F.lit(float(1 << 53))


def _hypergeometric(good: Column, total: Column, draws: Column, u: Column) -> Column:
    """A draw from the hypergeometric law by inverting its distribution function.

    Weights run over the support within twelve deviations of the mode, relative to the mode's.
    """
    low0, high0 = F.greatest(F.lit(0).cast("long"), draws - (total - good)), F.least(good, draws)
    mode = F.least(high0, F.greatest(low0, F.floor((draws + 1) * (good + 1) / (total + 2)).cast("long")))
    share = good / F.greatest(total, F.lit(1))
    reach = F.ceil(F.sqrt(draws * share * (1 - share)) * 12 + 24).cast("long")
    low, high = F.greatest(low0, mode - reach), F.least(high0, mode + reach)

    def step(x: Column) -> Column:  # p(x + 1) / p(x)
        return ((good - x).cast("double") * (draws - x)) / ((x + 1).cast("double") * (total - good - draws + x + 1))

    def walk(points: Column, ratio) -> Column:
        return F.aggregate(points, F.struct(F.lit(1.0).alias("w"), F.array().cast("array<double>").alias("all")), lambda s, x: F.struct(
            (s["w"] * ratio(x)).alias("w"), F.concat(s["all"], F.array(s["w"] * ratio(x))).alias("all")))["all"]

    up = F.when(high > mode, walk(F.sequence(mode, high - 1), step)).otherwise(F.array().cast("array<double>"))
    down = F.when(low < mode, walk(F.sequence(mode - 1, low, F.lit(-1).cast("long")), lambda x: 1.0 / step(x))).otherwise(F.array().cast("array<double>"))
    masses = F.concat(F.reverse(down), F.array(F.lit(1.0)), up)
    mass = F.aggregate(masses, F.lit(0.0), lambda s, x: s + x)
    passed = F.aggregate(masses, F.struct(F.lit(0.0).alias("sum"), F.lit(0).cast("long").alias("n")), lambda s, x: F.struct(
        (s["sum"] + x).alias("sum"), (s["n"] + F.when(s["sum"] + x < u * mass, 1).otherwise(0)).alias("n")))["n"]
    return F.least(high, low + passed)


def split(quotas: DataFrame, depth: int, seed: int) -> DataFrame:
    """Deal block quotas (source_id, quota) to 2^depth shards: (shard, source_id, count), zero counts left out.

    A level is one wide step: a node's row holds the counts of its sources, and its children's rows come
    from a fold over the sources with one univariate draw each.
    """
    nodes = quotas.where("quota > 0").groupBy().agg(F.sort_array(F.collect_list(F.struct("source_id", F.col("quota").alias("n")))).alias("counts"))
    nodes = nodes.select(F.lit(0).cast("long").alias("node"), "counts")
    for level in range(depth):
        total = F.aggregate("counts", F.lit(0).cast("long"), lambda s, x: s + x["n"])
        sized = nodes.withColumn("total", total).withColumn("half", F.floor((F.col("total") + F.pmod("node", F.lit(2))) / 2).cast("long"))
        kind = "array<struct<source_id:long,n:long>>"
        empty = F.struct(F.col("total").alias("rest"), F.col("half").alias("draws"), F.array().cast(kind).alias("left"), F.array().cast(kind).alias("right"))

        step = F.lit(level)

        def deal(s: Column, x: Column) -> Column:
            drawn = _hypergeometric(x["n"], s["rest"], s["draws"], _uniform(seed, step, F.col("node"), x["source_id"]))
            # An array of one binds the draw, so that it is computed once.
            return F.element_at(F.transform(F.array(drawn), lambda k: F.struct(
                (s["rest"] - x["n"]).alias("rest"), (s["draws"] - k).alias("draws"),
                F.concat(s["left"], F.array(F.struct(x["source_id"].alias("source_id"), k.alias("n")))).alias("left"),
                F.concat(s["right"], F.array(F.struct(x["source_id"].alias("source_id"), (x["n"] - k).alias("n")))).alias("right"))), 1)

        dealt = sized.select("node", F.aggregate("counts", empty, deal).alias("d"))
        nodes = dealt.select(F.explode(F.array(F.struct((F.col("node") * 2).alias("node"), F.col("d.left").alias("counts")),
                                               F.struct((F.col("node") * 2 + 1).alias("node"), F.col("d.right").alias("counts")))).alias("c"))
        nodes = nodes.select("c.node", F.filter("c.counts", lambda x: x["n"] > 0).alias("counts"))
        if level % 4 == 3:
            nodes = materialise(nodes, "nodes")
    return nodes.select(F.col("node").alias("shard"), F.explode("counts").alias("c")).select("shard", "c.source_id", F.col("c.n").alias("count"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: float = 3.0, block_words: int = 1 << 14,
        shard_words: int = 1 << 22, seed: int = 20) -> DataFrame:
    """Every row of ``docs`` with where the mix puts its copies.

    Needs doc_id, text and source; all columns are kept, and ``size``, ``source_size``, ``target`` and
    ``places`` are added (with an underscore appended where the name is taken). places is an array of
    (shard, position); positions are hashes, and a shard's rows in their order are shuffled. A document is
    taken whole, ``size(places)`` times, at most ceil(``most``) times. Null text has size 0; a null source is a source. A source
    without words has target 0. Identical rows are dealt like others. An empty table gives an empty result.
    Reruns agree: every draw is a hash of the seed and keys.

    A source of any size is many blocks of about ``block_words`` words, and only block and source rows
    are aggregated. Source totals are written first, so Spark knows their size when it plans the join.
    """
    names = {n: fresh(docs, n) for n in ("size", "source_size", "target", "places")}
    own = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(F.struct(*own).alias("row"), "doc_id", "source", words(F.col("text")).alias("size"),
                       F.xxhash64(F.lit(seed), "doc_id", "text").alias("ticket"))
    lean = docs.select("doc_id", "source", words(F.col("text")).alias("size"), F.xxhash64(F.lit(seed), "doc_id", "text").alias("ticket"))
    sizes = lean.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = targets(sizes, weights, most)
    passes = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(math.ceil(most)))).otherwise(F.lit(1)).cast("long")
    plan = plan.withColumn("source_id", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())).cast("long") - 1)
    plan = materialise(plan.withColumn("passes", passes).withColumn("rest", F.greatest(F.lit(0.0), F.col("target") - F.col("passes") * F.col("source_size")))
                       .withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("source_size") / block_words)).cast("long")), "sources")

    def placed(df: DataFrame) -> DataFrame:
        known = plan.withColumnRenamed("source", "known")
        return df.join(known, df["source"].eqNullSafe(known["known"])).drop("known").withColumn("block", F.pmod("ticket", "blocks"))

    key = ["source_id", "block"]
    blocks = placed(lean).groupBy(*key).agg(F.sum("size").alias("block_size"), F.first("passes").alias("passes"),
                                            F.first("rest").alias("rest"), F.first("blocks").alias("blocks"))
    run = Window.partitionBy("source_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("before", F.coalesce(F.sum("block_size").over(run), F.lit(0)))
    blocks = blocks.withColumn("cut", F.least(F.col("block_size"), F.greatest(F.lit(0.0), F.col("rest") - F.col("before"))))
    blocks = materialise(blocks.withColumn("draws", F.col("passes") + (F.col("cut") > 0).cast("long")), "blocks")

    total = blocks.agg(F.sum(F.col("passes") * F.col("block_size") + F.col("cut"))).first()[0]
    depth = math.ceil(math.log2(max(1.0, (total or 0) / shard_words)))
    # A source's draws in order: pass by pass, block by block. Shards take disjoint runs of that sequence.
    quotas = blocks.groupBy("source_id").agg(F.sum("draws").alias("quota"))
    dealt = materialise(split(quotas, depth, seed), "shards")
    ahead = Window.partitionBy("source_id").orderBy("shard")
    runs = dealt.withColumn("last", F.sum("count").over(ahead)).select("source_id", "shard", (F.col("last") - F.col("count")).alias("first"), "last")
    sequence = Window.partitionBy("source_id").orderBy("copy", "block")
    drawn = (blocks.where("draws > 0").select(*key, F.explode(F.sequence(F.lit(1).cast("long"), F.col("draws"))).alias("copy"))
             .withColumn("at", F.row_number().over(sequence).cast("long") - 1))
    bounds = runs.select("source_id", F.col("first").alias("at"), "shard", F.lit(0).alias("draw")).unionByName(
        drawn.select("source_id", "at", F.lit(None).cast("long").alias("shard"), F.lit(1).alias("draw"), *["block", "copy"]), allowMissingColumns=True)
    lookup = Window.partitionBy("source_id").orderBy("at", "draw").rowsBetween(Window.unboundedPreceding, 0)
    shards = (bounds.withColumn("shard", F.last("shard", ignorenulls=True).over(lookup)).where("draw = 1")
              .groupBy(*key).agg(F.transform(F.sort_array(F.collect_list(F.struct("copy", "shard"))), lambda x: x["shard"]).alias("shards")))
    facts = blocks.select(*key, "cut", "block_size").join(shards, key, "left")

    # In the block at the cut: whole documents from the largest down while they fit, then from the smallest up.
    inside = Window.partitionBy(*key)
    falling = inside.orderBy(F.desc("size"), "ticket", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    rising = inside.orderBy("size", F.desc("ticket"), F.desc("doc_id")).rowsBetween(Window.unboundedPreceding, 0)
    out = placed(rows).join(facts, key).withColumn("down", F.sum("size").over(falling)).withColumn("up", F.sum("size").over(rising))
    out = out.withColumn("big", F.col("down") <= F.col("cut")).withColumn(
        "gap", F.col("cut") - F.coalesce(F.max(F.when(F.col("big"), F.col("down"))).over(inside), F.lit(0)))
    small = F.col("up") - F.col("size") / 2 <= F.col("gap")
    taken = F.col("passes") + F.when((F.col("cut") > 0) & (F.col("big") | small), 1).otherwise(0)
    places = F.transform(F.slice(F.coalesce(F.col("shards"), F.array().cast("array<long>")), F.lit(1), taken.cast("int")), lambda x, i: F.struct(
        x.alias("shard"), F.xxhash64(F.lit(seed + 1), x, i, F.col("ticket"), F.col("doc_id")).alias("position")))
    return out.withColumn("places", places).select(
        *[F.col("row")[c].alias(c) for c in docs.columns], F.col("size").alias(names["size"]), F.col("source_size").alias(names["source_size"]),
        F.round("target", 6).alias(names["target"]), F.col("places").alias(names["places"]))


def shuffled(mixed: DataFrame, places: str = "places") -> DataFrame:
    """The mix itself: a row per copy, each shard's rows together in shuffled order."""
    spot = fresh(mixed, "spot")
    return (mixed.withColumn(spot, F.explode(places)).drop(places).repartition(F.col(f"{spot}.shard"))
            .sortWithinPartitions(f"{spot}.shard", f"{spot}.position").drop(spot))
