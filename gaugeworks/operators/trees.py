"""Fitted models as tables: tree nodes and weights as rows, scores by joins, and what a fit must satisfy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from gaugeworks.functions.values import ratio
from gaugeworks.operators.models import weights
from gaugeworks.operators.ranking import distributed_rank

COUNT_BITS = 56


def node_table(spark: SparkSession, path: str, boosted: bool = False) -> DataFrame:
    """Nodes of a stored tree model: tree, weight, node, feature, cut, groups, left, right, rows, value.

    A row goes left if its feature is at most ``cut``, or one of ``groups`` where that is a category. Leaves
    have a negative ``left``. The value is the share of the positive class, or a boosted tree's term.
    """
    node, stats = F.col("nodeData"), F.col("nodeData.impurityStats")
    split = node["split"]
    share = ratio(F.get(stats, F.lit(1)), F.aggregate(stats, F.lit(0.0), lambda a, b: a + b))
    trees = spark.read.parquet(f"{path}/treesMetadata").toDF("tree", "_about", "weight").select("tree", "weight")
    nodes = spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), node["id"].alias("node"), split["featureIndex"].alias("feature"),
        F.when(split["numCategories"] < 0, F.get(split["leftCategoriesOrThreshold"], F.lit(0))).alias("cut"),
        F.when(split["numCategories"] >= 0, split["leftCategoriesOrThreshold"]).alias("groups"),
        node["leftChild"].alias("left"), node["rightChild"].alias("right"), node["rawCount"].alias("rows"),
        (node["prediction"] if boosted else share).alias("value"))
    return nodes.join(trees, "tree")


def routed(encoded: DataFrame, nodes: DataFrame, keys: Sequence[str], trees: int, depth: int) -> DataFrame:
    """The leaf of every row of ``encoded`` in every tree: keys, tree, weight, node, rows, value.

    Rows walk down level by level; a level is one equi-join with the nodes, at most trees * 2**(depth + 1) rows.
    """
    walk = encoded.select(*keys, vector_to_array("features").alias("_x"), F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree")).withColumn("node", F.lit(0))
    steps = nodes.select("tree", "node", "feature", "cut", "groups", "left", "right")
    for _ in range(depth):
        at = F.get("_x", F.col("feature"))
        goes_left = F.coalesce(at <= F.col("cut"), F.array_contains("groups", at))
        below = F.when(F.col("left") < 0, F.col("node")).when(goes_left, F.col("left")).otherwise(F.col("right"))
        walk = walk.join(steps, ["tree", "node"]).select(*keys, "_x", "tree", below.alias("node"))
    return walk.drop("_x").join(nodes.select("tree", "node", "weight", "rows", "value"), ["tree", "node"])


def tree_scores(leaves: DataFrame, keys: Sequence[str], boosted: bool = False) -> DataFrame:
    """Probability ``p`` of every row from its leaves: their mean share, or the logistic of twice their weighted sum."""
    total = F.sum(F.col("weight") * F.col("value"))
    p = 1 / (1 + F.exp(-2 * total)) if boosted else total / F.sum("weight")
    return leaves.groupBy(*keys).agg(p.alias("p"))


def leaf_counts(leaves: DataFrame) -> DataFrame:
    """Per tree: rows routed through it, leaves reached, and leaves whose stored number of rows is another one."""
    per = leaves.groupBy("tree", "node").agg(F.count("*").alias("n"), F.max("rows").alias("rows"))
    return per.groupBy("tree").agg(F.sum("n").alias("rows"), F.count_if(F.col("n") != F.col("rows")).alias("differing_leaves"))


def long_form(encoded: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Feature vectors as rows (keys, feature, x); zeros have none."""
    return encoded.select(*keys, F.posexplode(vector_to_array("features")).alias("feature", "x")).where("x != 0")


def category_positions(train: DataFrame, categories: Sequence[str]) -> DataFrame:
    """(category, value, position) of every value of the training rows; the most frequent comes first, then by value.

    Positions of all categories follow each other; each category ends with one for unseen values, a row whose value
    is null. Values are counted before they are ranked, and ranked by count in levels, so no list reaches the driver.
    """
    parts = [F.struct(F.lit(i).alias("part"), F.lit(c).alias("category"), F.col(c).cast("string").alias("value")) for i, c in enumerate(categories)]
    counted = train.select(F.inline(F.array(*parts))).where("value is not null").groupBy("part", "category", "value").agg(F.count("*").alias("n"))
    # Order: part, then falling counts; the code has room for 64 categories and 2**56 rows.
    code = F.col("part").cast("long") * (1 << COUNT_BITS) + ((1 << COUNT_BITS) - 1 - F.col("n"))
    known = distributed_rank(counted.withColumn("_code", code), "_code", [F.col("value")], COUNT_BITS + 6, "rank").drop("_code")
    # Each category before a value's own adds one place for its unseen values.
    known = known.select("category", "value", (F.col("rank") + F.col("part")).cast("int").alias("position"))
    ends = counted.groupBy("part", "category").agg(F.count("*").alias("n"))
    unseen = ends.select("category", F.lit(None).cast("string").alias("value"), (
        F.sum(F.col("n") + 1).over(Window.orderBy("part")) - 1).cast("int").alias("position"))
    return known.unionByName(unseen)


def encoded_long(rows: DataFrame, positions: DataFrame, categories: Sequence[str], numerics: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """One-hot features as rows (keys, feature, x), without vectors: a one per category, then the non-zero numbers.

    Numbers come after all categories, in the order given. Values that ``positions`` lacks take their category's last place.
    """
    cells = [F.struct(F.lit(c).alias("category"), F.col(c).cast("string").alias("value")) for c in categories]
    long = rows.select(*keys, F.inline(F.array(*cells)))
    seen = positions.where("value is not null")
    last = positions.where("value is null").select("category", F.col("position").alias("_unseen"))
    ones = long.join(seen, ["category", "value"], "left").join(last, "category").select(
        *keys, F.coalesce("position", "_unseen").alias("feature"), F.lit(1.0).alias("x"))
    width = positions.agg((F.max("position") + 1).alias("width")).scalar()
    numbers = [F.struct((width + i).cast("int").alias("feature"), F.col(c).cast("double").alias("x")) for i, c in enumerate(numerics)]
    return ones.unionByName(rows.select(*keys, F.inline(F.array(*numbers))).where("x != 0"))


def long_variances(long: DataFrame, rows: DataFrame) -> DataFrame:
    """Sample variance of every feature of ``long`` over the rows of ``rows``; features that a row lacks are zero there.

    Sums are taken about each feature's mean: once for the mean, once for the squares, both merging on the map side.
    """
    n = rows.agg(F.count("*").cast("double").alias("n")).scalar()
    sums = long.groupBy("feature").agg(F.sum("x").alias("s"), F.count("*").alias("k")).withColumn("mean", F.col("s") / n)
    apart = long.join(sums.select("feature", "mean"), "feature").groupBy("feature").agg(
        F.sum((F.col("x") - F.col("mean")) * (F.col("x") - F.col("mean"))).alias("inner"))
    zeros = (n - F.col("k")) * F.col("mean") * F.col("mean")
    out = sums.join(apart, "feature").select("feature", ((F.col("inner") + zeros) / (n - 1)).alias("variance"))
    return out.withColumn("constant", F.col("variance") == 0.0)


def linear_scores(encoded: DataFrame, model: Model, keys: Sequence[str]) -> DataFrame:
    """Probability ``p`` of every row by joining its features with the weights."""
    total = long_form(encoded, keys).join(weights(model), "feature").groupBy(*keys).agg(F.sum(F.col("x") * F.col("weight")).alias("_s"))
    return total.select(*keys, (1 / (1 + F.exp(-(F.col("_s") + F.lit(float(model.intercept)))))).alias("p"))


def optimality(model: Model, scored: DataFrame, caps: Sequence[float], reg: float, tol: float = 1e-4) -> DataFrame:
    """Whether a bounded logistic fit is a least point of its loss, per feature: feature, weight, gradient, rule, holds.

    ``scored`` has features, label and p of the training rows. The gradient is the mean of (p - label) * x plus the
    penalty on the weight times the feature's spread; it is measured in units of that spread. Inside its bounds
    a weight needs a gradient of zero; at its upper bound the loss must not fall towards smaller weights. The
    last row, feature -1, is the intercept.
    """
    rest = F.col("p") - F.col("label")
    totals = scored.agg(F.count("*").alias("n"), F.avg(rest).alias("mean"))
    parts = scored.select(rest.alias("_r"), F.posexplode(vector_to_array("features")).alias("feature", "x")).where("x != 0").groupBy("feature").agg(
        F.sum(F.col("_r") * F.col("x")).alias("_g"), F.sum("x").alias("_x"), F.sum(F.col("x") * F.col("x")).alias("_xx"))
    spark = scored.sparkSession
    bounds = weights(model).join(spark.createDataFrame(list(enumerate(map(float, caps))), "feature int, cap double"), "feature")
    rows = totals.select(F.col("n").cast("double")).scalar()
    table = bounds.join(parts, "feature", "left").na.fill(0.0, ["_g", "_x", "_xx"]).withColumn("n", rows)
    n = F.col("n")
    spread = F.sqrt(F.greatest((F.col("_xx") - F.col("_x") * F.col("_x") / n) / (n - 1), F.lit(0.0)))
    gradient = ratio(F.col("_g") / n, spread) + F.lit(float(reg)) * F.col("weight") * spread
    bound = F.col("weight") >= F.col("cap") - 1e-9
    graded = table.withColumn("gradient", F.when(spread > 0, gradient).otherwise(0.0)).select(
        "feature", "weight", "gradient", F.when(bound, "at_bound").otherwise("inside").alias("rule"),
        F.when(bound, F.col("gradient") <= tol).otherwise(F.abs("gradient") <= tol).alias("holds"))
    start = totals.select(F.lit(-1).alias("feature"), F.lit(float(model.intercept)).alias("weight"), F.col("mean").alias("gradient"),
                          F.lit("intercept").alias("rule"), (F.abs("mean") <= tol).alias("holds"))
    return graded.unionByName(start)


def disagreement(left: DataFrame, right: DataFrame, keys: Sequence[str], by: Sequence[str], tol: float = 1e-9) -> DataFrame:
    """Rows per group, and those whose ``p`` is absent on one side or differs."""
    same: Column = F.abs(F.col("p") - F.col("_p")) <= tol
    both = left.join(right.withColumnRenamed("p", "_p"), list(keys), "full")
    return both.groupBy(*by).agg(F.count("*").alias("rows"), F.count_if(~F.coalesce(same, F.lit(False))).alias("differing_rows"))
