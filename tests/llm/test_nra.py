import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeworks.llm import nra


def brute(rows, k=5):
    good = {(i, tuple(math.floor(256 * x) for x in v)) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for q, x in good:
        if q % 50 == 0:
            own = sorted((-sum(a * b for a, b in zip(x, y, strict=True)), i) for i, y in good if i != q and len(x) == len(y))[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(own)]
    return sorted(out)


@pytest.mark.parametrize("blocks", [(8, 2), (10_000, 2048)])
def test_against_brute_force(spark, blocks):
    rnd = random.Random(2)
    f = lambda: float(np.float32(rnd.gauss(0, 0.3)))
    rows = [(i, [f() for _ in range(6)]) for i in range(230)]
    rows += [(1000 + i, rows[0][1]) for i in range(9)]  # ties
    rows += [(3, rows[3][1]), (50, [0.5] * 6), (None, [0.1] * 6), (2000, None), (2050, [None, 0.1, 0.1, 0.1, 0.1, 0.1]), (2100, [float("nan")] + [0.1] * 5), (2150, [float("inf")] + [0.1] * 5),
             (2200, [0.25, -0.5]), (2201, [1.0, 1.0]), (2250, []), (2251, []), (-50, [f() for _ in range(6)]), (2300, [0.0] * 6)]
    table = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, key string")
    found = nra.nearest(table, F.pmod("vec_id", F.lit(50)) == 0, block_rows=blocks[0], query_rows=blocks[1])
    assert sorted(tuple(r) for r in found.collect()) == brute(rows)


def test_reading_stops_early_and_is_exact():
    rng = np.random.default_rng(6)
    x = np.floor(rng.normal(0, 40, (3000, 8))).astype(np.int64)
    q = x[:20] * 3
    ids = np.arange(3000)
    for i, c, s in nra.best_in_block(ids, x, ids[:20], q, 5):
        scores = x @ q[i]
        scores[i] = -(1 << 60)
        best = np.lexsort((ids, -scores))[:5]
        assert c.tolist() == best.tolist() and s.tolist() == scores[best].tolist()


def test_large_components_use_whole_numbers():
    x = np.array([[1 << 40, 1], [1 << 40, 2], [0, 5]])
    found = {int(i): (c.tolist(), s.tolist()) for i, c, s in nra.best_in_block(np.array([1, 2, 3]), x, np.array([0]), np.array([[1 << 20, 1]]), 2)}
    assert found == {0: ([1, 0], [(1 << 60) + 2, (1 << 60) + 1])}


def test_empty(spark):
    assert nra.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.lit(True)).count() == 0


@pytest.mark.parametrize("block_rows", [2, 8192])
def test_repeated_rows_keep_their_places(spark, block_rows):
    """Copies, also those that are equal only after rounding down, against all pairs of rows; a repeated query asks twice."""
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [0.5, 0.0]), (1, [0.5, 0.0]), (1, [0.501, 0.001]), (2, [0.75, 1.0]), (3, [0.25, 0.0])]
    found = nra.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") == 0, block_rows=block_rows)
    assert sorted(tuple(r) for r in found.collect()) == sorted(
        [(0, rank + 1, i, s * 256) for rank, (i, s) in enumerate([(2, 192), (1, 128), (1, 128), (1, 128), (3, 64)])] * 2)
