"""Exact top-k inner products by aggregation without random access.

Candidates lie in blocks. A block's lists are its components, each sorted; a query reads a list from the
end where its own component makes products large. After t entries of every list, a candidate's score has a
lower and an upper bound: read components count as they are, others as the list's far end and as the last
value read. Reading goes on in doubling steps until no more than a few candidates can still be among
the k best; their components are then read to the end. Bounds of all candidates and queries of a
block are matrix products.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from gaugeworks.sources.scratch import materialise

RESULT = "query_id long, query_key long, vec_id long, score long"


def whole(vector: Column) -> Column:
    """Components as floor(256 * x), x as double."""
    return F.transform(vector, lambda x: F.floor(F.lit(256.0) * x.cast("double")).cast("long"))


def usable(vector: Column) -> Column:
    """Neither null nor with a component that is null or not finite."""
    big = F.lit(float("inf"))
    return F.coalesce(vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < big)), F.lit(False))


def _matrix(column: pa.ChunkedArray, kind) -> np.ndarray:
    flat = column.combine_chunks()
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1).astype(kind)


def best_in_block(ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, q: np.ndarray, k: int, few: int = 64):
    """Per query the rows (query, candidate, score) of a block's k best, ties to the smaller id.

    Products are exact: in doubles below 2^53, else in 64-bit integers.
    """
    n, d = x.shape
    safe = d * float(np.abs(x).max(initial=0)) * float(np.abs(q).max(initial=0)) < 2.0 ** 53
    kind = np.float64 if safe else np.int64
    ordered = np.sort(x, axis=0)
    up, down = np.maximum(q, 0).astype(kind), np.minimum(q, 0).astype(kind)
    own = query_ids[:, None] == ids[None]
    open_, step = np.arange(len(q)), max(few, n // 8)
    while len(open_):
        t = min(n, step)
        last_high, last_low = ordered[n - t], ordered[t - 1]
        high, low = x >= last_high, x <= last_low  # what has been read from either end
        upper = up[open_] @ np.where(high, x, last_high).T.astype(kind) + down[open_] @ np.where(low, x, last_low).T.astype(kind)
        lower = upper if t == n else (up[open_] @ np.where(high, x, ordered[0]).T.astype(kind) + down[open_] @ np.where(low, x, ordered[-1]).T.astype(kind))
        barred = own[open_]
        floor = np.iinfo(np.int64).min if kind is np.int64 else -np.inf
        bounds = np.where(barred, floor, lower)
        kth = np.partition(bounds, n - k, axis=1)[:, n - k] if n > k else np.full(len(open_), floor, kind)
        within = (upper >= kth[:, None]) & ~barred
        # Outsiders cannot qualify any more; what is left is read to its end.
        done = (within.sum(axis=1) <= few) | (t == n)
        for i in np.flatnonzero(done):
            c = np.flatnonzero(within[i])
            score = x[c] @ q[open_[i]]
            top = np.lexsort((ids[c], -score))[:k]
            yield open_[i], c[top], score[top]
        open_, step = open_[~done], step * 2


def _search(k: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows and right.num_rows:
            ids, x = left["vec_id"].to_numpy(), _matrix(left["v"], np.int64)
            q_ids, q_keys, q = right["vec_id"].to_numpy(), right["key"].to_numpy(), _matrix(right["v"], np.int64)
            for a in range(0, len(q), 256):
                for i, c, score in best_in_block(ids, x, q_ids[a:a + 256], q[a:a + 256], k):
                    out += [(int(q_ids[a + i]), int(q_keys[a + i]), int(ids[j]), int(s)) for j, s in zip(c, score, strict=True)]
        columns = list(zip(*out, strict=True)) if out else [[]] * 4
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["query_id", "query_key", "vec_id", "score"])

    return run


def nearest(vectors: DataFrame, queries: Column, k: int = 5, block_rows: int = 8192, query_rows: int = 2048) -> DataFrame:
    """The k rows of ``vectors`` (vec_id, embedding) with the highest score for each row where ``queries`` holds.

    Returns query_id, rank (from 1), vec_id, score: integer inner products of floor(256 * x), ties to
    the smaller vec_id; all candidates if there are fewer than k. A query's own vec_id is no candidate.
    Vectors that are null, hold null or non-finite components, or have a null id take no part.
    Vectors meet only those of their length; empty ones score 0. Every row is a candidate and, where
    ``queries`` holds, a query of its own, also rows of one vec_id and identical ones. Other columns are ignored.

    The number of blocks and of query chunks follows the row counts, which are all the driver sees; every
    (block, chunk) is one task's worth of bounded size.
    """
    rows = vectors.where(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).select(
        F.col("vec_id").cast("long").alias("vec_id"), whole(F.col("embedding")).alias("v"))
    counted = rows.groupBy("vec_id", "v").agg(F.count(F.lit(1)).alias("copies"))
    numbered = counted.select("vec_id", "v", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    rows = materialise(numbered.select("vec_id", "v", F.size("v").alias("d"), F.xxhash64("vec_id", "v", "copy").alias("key")), "vectors")
    n, m = rows.agg(F.count(F.lit(1)), F.count_if(queries)).first()
    blocks, chunks = max(1, -(-n // block_rows)), max(1, -(-m // query_rows))
    spread = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    part = lambda count: F.pmod("key", F.lit(count)).cast("int")
    left = rows.withColumn("block", part(blocks)).withColumn("chunk", spread(chunks))
    right = rows.where(queries).withColumn("chunk", part(chunks)).withColumn("block", spread(blocks))
    keys = ["d", "block", "chunk"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_search(k), RESULT)
    order = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
