import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from gaugeworks.llm import mixing


def water(sizes, weights, most):
    """Targets by resharing the excess again and again."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        if not free:
            return fixed
        rest = total - sum(fixed.values())
        share = {s: rest * w[s] / sum(w[f] for f in free) for s in free}
        over = {s: most * sizes[s] for s in free if share[s] > most * sizes[s]}
        if not over:
            return fixed | share
        fixed |= over


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 3, None: 50}, {"a": 5}, {"a": 0, "b": 7}, {"a": 1, "B": 1, "é": 900, "z": 2, "y": 400}, {"a": 0}])
def test_targets(spark, sizes):
    given = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    found = {r.source: r.target for r in mixing.targets(given, (1, 2, 3), 3.0).collect()}
    assert found == pytest.approx(water(sizes, (1, 2, 3), 3.0))


def test_split_is_exact_and_even(spark):
    quotas = {0: 1000, 1: 500, 2: 20, 3: 3, 4: 0, 5: 777}
    rows = mixing.split(spark.createDataFrame(list(quotas.items()), "source_id long, quota long"), 3, 7).collect()
    by_source, by_shard = Counter(), Counter()
    for r in rows:
        by_source[r.source_id] += r["count"]
        by_shard[r.shard] += r["count"]
    assert by_source == {k: v for k, v in quotas.items() if v}
    assert len(by_shard) == 8 and max(by_shard.values()) - min(by_shard.values()) <= 1
    assert all(90 < r["count"] < 160 for r in rows if r.source_id == 0)


def test_hypergeometric_law(spark):
    """Means and variances of many draws against the law's."""
    draws = spark.range(4000).select(mixing._hypergeometric(F.lit(30).cast("long"), F.lit(100).cast("long"), F.lit(40).cast("long"), mixing._uniform(1, F.col("id"))).alias("x"))
    mean, var, low, high = draws.agg(F.avg("x"), F.var_samp("x"), F.min("x"), F.max("x")).first()
    assert abs(mean - 12) < 0.15 and abs(var - 40 * 0.3 * 0.7 * 60 / 99) < 0.5 and 0 <= low and high <= 30


def test_mix(spark, documents):
    rows = mixing.mix(documents, block_words=2000, shard_words=20_000).collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in documents.select("doc_id").collect())
    sizes, taken, targets, largest = Counter(), Counter(), {}, Counter()
    for r in rows:
        assert r.size == size(r.text) and len(r.places) <= 3
        sizes[r.source] += r.size
        largest[r.source] = max(largest[r.source], r.size)
        taken[r.source] += r.size * len(r.places)
        targets[r.source] = r.target
    expected = water(sizes, (1, 2, 3), 3.0)
    for s in sizes:
        assert targets[s] == pytest.approx(expected[s], abs=1e-5) and abs(taken[s] - expected[s]) <= largest[s] / 2
    assert {r.source: r.source_size for r in rows} == sizes
    again = mixing.mix(documents.repartition(5), block_words=2000, shard_words=20_000).collect()
    assert {r.doc_id: r.places for r in rows} == {r.doc_id: r.places for r in again}
    assert len({p.shard for r in rows for p in r.places}) > 3


def test_odd_rows(odd, none):
    mixed = mixing.mix(odd, block_words=50, shard_words=100)
    assert mixed.columns[:len(odd.columns)] == odd.columns and {"size_", "source_size", "target", "places"} <= set(mixed.columns)
    rows = mixed.collect()
    assert Counter((r.doc_id, r.text) for r in rows) == Counter((r.doc_id, r.text) for r in odd.collect())
    assert all(r["size_"] == size(r.text) for r in rows)
    assert mixing.mix(none).count() == 0
