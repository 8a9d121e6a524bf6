"""Prefix trie of conversations by ROLLUP over positional turn columns.

A conversation is cut into blocks of ``WIDTH`` turns. A row holds one block: its number, the node where the block before
it ends, and the ids of its turns as columns t1, t2, ... One GROUP BY block, node, ROLLUP(t1, t2, ...) then
aggregates the prefixes of all depths together; grouping_id tells how many columns a result row keeps, so which
depth it has. A node is known by its depth and a 128-bit hash of the turns and their positions up to it, so all blocks
of long conversations are rolled up at once.

Sums over subtrees need no descent. The nodes whose smallest member is conversation c form a chain down to
c's end. A subtree is the rest of its top's chain and the whole chains that hang below. So chains are
summed up first, and a second ROLLUP adds each chain to all nodes above its top.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from gaugeworks.sources.scratch import materialise

WIDTH, SPAN = 4, 1024
WORD = r"[^\x20\x09-\x0D]+"
NODE = ["depth", "key1", "key2"]


def numbered(conversations: DataFrame) -> DataFrame:
    """(conv_id, depth, turn_id, words) of every row of ``conversations`` (conv_id, turn, role, text).

    Turns count from 1 in the order of turn, null first; equal ones go by turn_id, a hash of role and text.
    Rows without a conv_id belong to no conversation. Numbers are counted within ranges of the sorted rows
    first and then over the ranges, so that one long conversation may span many tasks.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    ids = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))
    turns = materialise(conversations.where("conv_id is not null").select(
        "conv_id", "turn", ids.alias("turn_id"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words")), "turns")
    order = [F.col("turn").asc_nulls_first(), F.col("turn_id")]
    ranged = turns.repartitionByRange("conv_id", *order).withColumn("part", F.spark_partition_id())
    place = F.row_number().over(Window.partitionBy("conv_id", "part").orderBy(*order)).cast("long")
    placed = materialise(ranged.withColumn("place", place), "placed")
    sizes = placed.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return placed.join(sizes.select("conv_id", "part", before.alias("before")), ["conv_id", "part"]).select(
        "conv_id", (F.col("before") + F.col("place")).alias("depth"), "turn_id", "words")


def rebuilt(turns: DataFrame, group: int, heads: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Turns whose first ones come from the first conversation of their group, and all conversations (conv_id).

    Conversation c starts with the first h turns of conversation c - c % group (all if fewer, none if absent)
    and goes on with its own after its first h; ``heads`` gives h for conv_id, at most ``most``. % is that of SQL, towards zero.
    """
    sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).withColumn("h", heads.cast("long"))
    base = turns.where((F.col("conv_id") % group == 0) & (F.col("depth") <= most)).groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("depth", "turn_id", "words"))).alias("head"))
    sizes = sizes.withColumn("base", F.col("conv_id") - F.col("conv_id") % group).join(base.withColumnRenamed("conv_id", "base"), "base", "left")
    head = F.when(F.col("h") > 0, F.slice("head", F.lit(1), F.greatest(F.col("h"), F.lit(1)).cast("int")))
    convs = materialise(sizes.select("conv_id", "h", F.coalesce(head, F.array().cast("array<struct<depth: bigint, turn_id: binary, words: bigint>>")).alias("head")), "heads")
    own = turns.join(convs.select("conv_id", "h", F.size("head").alias("k")), "conv_id").where("depth > h").select(
        "conv_id", (F.col("depth") - F.col("h") + F.col("k")).alias("depth"), "turn_id", "words")
    return own.unionByName(convs.select("conv_id", F.inline("head"))), convs.select("conv_id")


def _hash(which: int, depth: Column, turn: Column) -> Column:
    return F.xxhash64(F.lit(which), depth.cast("long"), turn)


def _before(by: list[str], order: str, names: list[str]) -> list[Column]:
    """What the rows before hold together: keys by exclusive or, words as a sum."""
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    kind = {"words": F.sum}
    return [F.coalesce(kind.get(c, F.bit_xor)(c).over(w), F.lit(0).cast("long")).alias(f"{c}_before") for c in names]


def blocks(turns: DataFrame, members: DataFrame, width: int) -> tuple[DataFrame, DataFrame]:
    """A row per block of each conversation, and a row per conversation (conv_id, depth, key1, key2, words).

    What precedes a block is added up within spans of blocks first and then over the spans.
    """
    number = F.floor((F.col("depth") - 1) / width)
    cells = turns.select("conv_id", number.alias("block"), "depth", "turn_id", "words", _hash(1, F.col("depth"), F.col("turn_id")).alias("key1"),
                         _hash(2, F.col("depth"), F.col("turn_id")).alias("key2"))
    sums = [F.bit_xor("key1").alias("key1"), F.bit_xor("key2").alias("key2"), F.sum("words").alias("words")]
    rows = materialise(cells.groupBy("conv_id", "block").agg(
        F.sort_array(F.collect_list(F.struct("depth", "turn_id", "words"))).alias("cells"), *sums).withColumn("span", F.floor(F.col("block") / SPAN)), "cells")
    names = ["key1", "key2", "words"]
    spans = rows.groupBy("conv_id", "span").agg(*sums, F.sum(F.size("cells")).alias("n"))
    ends = materialise(members.select("conv_id").distinct().join(spans.groupBy("conv_id").agg(*sums, F.sum("n").alias("depth")), "conv_id", "left")
                       .na.fill(0, [*names, "depth"]), "ends")
    spans = spans.select("conv_id", "span", *_before(["conv_id"], "span", names)).join(ends.select("conv_id", F.col("words").alias("all_words")), "conv_id")
    inside = rows.select("conv_id", "span", "block", "cells", *[c.alias(f"{n}_in") for n, c in zip(names, _before(["conv_id", "span"], "block", names), strict=True)])
    cell = [F.get("cells", F.lit(i)) for i in range(width)]
    turn = [c["turn_id"].alias(f"t{i + 1}") for i, c in enumerate(cell)]
    words = [F.coalesce(c["words"], F.lit(0)).alias(f"w{i + 1}") for i, c in enumerate(cell)]
    full = inside.join(spans, ["conv_id", "span"]).select(
        "conv_id", "block", F.col("key1_in").bitwiseXOR(F.col("key1_before")).alias("p1"), F.col("key2_in").bitwiseXOR(F.col("key2_before")).alias("p2"),
        (F.col("words_in") + F.col("words_before")).alias("above"), "all_words", *turn, *words)
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("binary")
    bare = ends.where("depth = 0").select("conv_id", zero.alias("block"), zero.alias("p1"), zero.alias("p2"), zero.alias("above"), zero.alias("all_words"),
                                          *[none.alias(f"t{i + 1}") for i in range(width)], *[zero.alias(f"w{i + 1}") for i in range(width)])
    return materialise(full.unionByName(bare), "blocks"), ends


def rolled(rows: DataFrame, width: int, sums: str) -> DataFrame:
    """``sums`` over all prefixes of ``rows`` (block, p1, p2, t1, ...), with depth, key1, key2 and kept, the columns of a prefix."""
    columns = [f"t{i + 1}" for i in range(width)]
    kept = f"{width} - bit_count(grouping_id())"
    last = " ".join(f"WHEN {i + 1} THEN {c} IS NOT NULL" for i, c in enumerate(columns))
    out = rows.sparkSession.sql(
        f"SELECT block, p1, p2, {', '.join(columns)}, {kept} AS kept, {sums} FROM {{rows}} "
        f"GROUP BY block, p1, p2, ROLLUP({', '.join(columns)}) HAVING CASE {kept} WHEN 0 THEN block = 0 {last} END", rows=rows)

    def key(which: int, less: int = 0) -> Column:
        whole = F.col(f"p{which}")
        for i, c in enumerate(columns):
            own = _hash(which, F.col("block") * width + i + 1, F.col(c))
            whole = whole.bitwiseXOR(F.when(F.col("kept") - less > i, own).otherwise(F.lit(0).cast("long")))
        return whole

    rest = [c for c in out.columns if c not in {"block", "p1", "p2", *columns}]
    return out.select((F.col("block") * width + F.col("kept")).alias("depth"), key(1).alias("key1"), key(2).alias("key2"),
                      key(1, 1).alias("up1"), key(2, 1).alias("up2"), *rest)


def _digests(batches):
    """Rows sorted by node and conv_id to one digest per node, in a stream."""
    node, digest = None, None
    schema = pa.schema([("depth", pa.int64()), ("key1", pa.int64()), ("key2", pa.int64()), ("ends_sha256", pa.string())])
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy() for c in NODE])
        ids = batch.column("conv_id").to_pylist()
        start = np.flatnonzero(np.concatenate([[True], (keys[:, 1:] != keys[:, :-1]).any(axis=0)]))
        out = []
        for a, b in zip(start.tolist(), [*start[1:].tolist(), len(ids)], strict=True):
            text, own = ",".join(map(str, ids[a:b])).encode(), tuple(keys[:, a].tolist())
            if own == node:
                digest.update(b"," + text)
                continue
            if node is not None:
                out.append((*node, digest.hexdigest()))
            node, digest = own, hashlib.sha256(text)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
    if node is not None:
        yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((*node, digest.hexdigest()), schema, strict=True)], schema=schema)


def trie(turns: DataFrame, members: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row per node of the trie of ``turns`` (conv_id, depth, turn_id, words), depths from 1 without gaps.

    ``members`` (conv_id) are the conversations; those without turns are members of the root alone. A node is a
    distinct sequence of first turns; its members are the conversations that start with it. Result: depth,
    key1, key2 (the node's hash), conv_id (smallest member), parent_conv_id (the parent's, null for the root), n_convs,
    n_children, n_leaves (childless nodes of its subtree, itself included), saved_tokens (over its subtree, members
    but one times the words of the node's last turn), ends_sha256 (of the comma-joined ids, ascending, of the members
    that end there). Without members there is no node. Extra columns are ignored.

    Every intermediate table is written to the shared folder. Counts, sums and smallest members combine before they are
    shuffled, also for a node that all conversations share. The digest of a node's ids is read in one
    stream, in constant memory; a digest cannot be split.
    """
    rows, ends = blocks(turns, members, width)
    at = " ".join(f"WHEN {i + 1} THEN w{i + 1}" for i in range(width))
    nodes = rolled(rows, width, "count(*) AS n_convs, min(conv_id) AS conv_id, sum(all_words) AS member_words, max(above) AS above, "
                   + ", ".join(f"max(w{i + 1}) AS w{i + 1}" for i in range(width)))
    before = F.col("above")
    for i in range(width):
        before = before + F.when(F.col("kept") > i + 1, F.col(f"w{i + 1}")).otherwise(0)
    nodes = materialise(nodes.select(*NODE, "up1", "up2", "conv_id", "n_convs", "member_words", before.alias("before"),
                                     F.expr(f"CASE kept {at} ELSE 0L END").alias("words")), "nodes")

    chains = materialise(nodes.groupBy("conv_id").agg(
        F.min("depth").alias("top"), F.max("depth").alias("last"), F.sum("words").alias("own_words"), F.min("before").alias("top_before"),
        F.min_by("up1", "depth").alias("up1"), F.min_by("up2", "depth").alias("up2"), F.max_by("key1", "depth").alias("end1"), F.max_by("key2", "depth").alias("end2")), "chains")
    hung = chains.where("top > 0").groupBy((F.col("top") - 1).alias("depth"), F.col("up1").alias("key1"), F.col("up2").alias("key2")).agg(F.count(F.lit(1)).alias("tops"))
    hung = materialise(hung.join(nodes.select(*NODE, F.col("conv_id").alias("holder")), NODE), "hung")
    above = hung.select((F.col("depth") + 1).alias("top"), F.col("key1").alias("up1"), F.col("key2").alias("up2"), "holder")
    below = hung.select(F.col("depth").alias("last"), F.col("key1").alias("end1"), F.col("key2").alias("end2"), F.lit(0).alias("inner"))
    chains = chains.join(above, ["top", "up1", "up2"], "left").join(below, ["last", "end1", "end2"], "left")
    chains = materialise(chains.select("conv_id", "top", "last", "own_words", "top_before", "holder", F.coalesce("inner", F.lit(1)).cast("long").alias("leaf")), "chains")

    hanging = rows.join(chains.where("top > 0").select("conv_id", "top", "own_words", "leaf"), "conv_id")
    hanging = hanging.where((F.col("block") == 0) | (F.col("block") * width < F.col("top") - 1))
    shown = [F.when(F.col("block") * width + i + 1 < F.col("top"), F.col(f"t{i + 1}")).alias(f"t{i + 1}") for i in range(width)]
    added = rolled(hanging.select("block", "p1", "p2", *shown, "own_words", "leaf"), width, "sum(own_words) AS words_below, sum(leaf) AS leaves_below")

    digests = ends.select(*NODE, "conv_id").repartition(*NODE).sortWithinPartitions(*NODE, "conv_id").mapInArrow(
        _digests, "depth long, key1 long, key2 long, ends_sha256 string")
    zero = F.lit(0).cast("long")
    whole = (nodes.drop("up1", "up2").join(hung.select(*NODE, "tops"), NODE, "left").join(added.select(*NODE, "words_below", "leaves_below"), NODE, "left")
             .join(digests, NODE, "left").join(chains, "conv_id"))
    distinct = F.col("own_words") - (F.col("before") - F.col("top_before")) + F.coalesce("words_below", zero)
    return whole.select(
        *NODE, "conv_id", F.when(F.col("depth") == F.col("top"), F.col("holder")).otherwise(F.col("conv_id")).alias("parent_conv_id"), "n_convs",
        ((F.col("depth") < F.col("last")).cast("long") + F.coalesce("tops", zero)).alias("n_children"), (F.col("leaf") + F.coalesce("leaves_below", zero)).alias("n_leaves"),
        (F.col("member_words") - F.col("n_convs") * F.col("before") - distinct).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
