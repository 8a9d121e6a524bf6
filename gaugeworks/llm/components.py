"""Connected components by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gaugeworks.sources.scratch import materialise


def _stars(edges: DataFrame) -> bool:
    """Whether each node of ``edges`` (u, v) either hangs on one node or is one that others hang on."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(edges.select("v", F.lit(0), F.lit(1)))
    once = ends.groupBy("node").agg((F.sum("up") + F.max("down") < 2).alias("once"))
    return once.agg(F.count_if(~F.col("once"))).first()[0] == 0


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); root is the smallest node of its component.

    Each round hangs every node's larger neighbours, then its smaller ones, on its smallest neighbour, as
    aggregates and equi-joins, until the edges are stars. Every round's edges are written to the shared
    folder; the driver sees one number a round. Links from a node to itself give the node alone.
    """
    nodes = links.select(F.col("a").alias("node")).union(links.select(F.col("b").alias("node"))).distinct()
    edges = materialise(links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    while not _stars(edges):
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialise(small.union(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
    roots = edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
    return nodes.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"))
