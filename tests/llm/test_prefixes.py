import hashlib
import math
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from gaugeworks.llm import prefixes

SCHEMA = "conv_id long, turn long, role string, text string, Depth string, key1 string, block long"


def heads(c):
    return zlib.crc32(str(c).encode()) % 4


def plain(rows):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            turns[c].append((turn is not None, turn or 0, hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest(), role, text))
    turns = {c: [x[3:] for x in sorted(t)] for c, t in turns.items()}
    built = {}
    for c, own in turns.items():
        h = heads(c)
        built[c] = turns.get(c - int(math.fmod(c, 20)), [])[:h] + own[h:]
    members = defaultdict(list)
    for c, t in built.items():
        for d in range(len(t) + 1):
            members[tuple(t[:d])].append(c)
    children = defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode().split()) if p else 0
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(built[c]) == len(p))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out)


def fast(df, width=prefixes.WIDTH):
    turns, members = prefixes.rebuilt(prefixes.numbered(df), 20, F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4, 3)
    cols = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(tuple(r) for r in prefixes.trie(turns, members, width).select(*cols).collect())


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 7) for r in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("width", [1, 3, 4])
def test_against_brute_force(spark, width):
    rng = random.Random(width)
    rows = []
    for c in rng.sample(range(-50, 200), 120):
        n = rng.choice([1, 2, 3, 4, 5, 8, 9, 13])
        rows += [(c, t, rng.choice(["user", "bot", None]), rng.choice(["a b", "a", "", None, "c d e"])) for t in range(n)]
    rows += [(1000 + i, t, "user", f"all the same {t}") for i in range(300) for t in range(6)]
    rng.shuffle(rows)
    assert fast(frame(spark, rows), width) == plain(rows)


def test_odd_rows(spark):
    rows = [(None, 0, "user", "no id"), (0, None, "user", "null comes first"), (0, 1, None, None), (0, 1, None, None), (0, 1, "b", "tie"), (0, 1, "a", "tie"),
            (3, 0, "user", "héé 東京 x"), (20, 0, "user", ""), (21, 5, "user", "w " * 40_000), (41, 0, "1", "2:3"), (61, 0, "12", ":3")]
    rows += [(c, 0, "user", "only turn") for c in range(60, 80)]
    assert fast(frame(spark, rows)) == plain(rows)
    assert fast(frame(spark, rows[:0])) == []
    assert fast(frame(spark, rows[:1])) == []


def test_a_very_long_conversation_spans_tasks(spark, monkeypatch):
    monkeypatch.setattr(prefixes, "SPAN", 3)
    rows = [(c, t, "user", f"turn {t % 7}" if c != 41 or t < 150 else f"other {t}") for c in (40, 41, 42) for t in range(210)]
    assert fast(frame(spark, rows)) == plain(rows)


def test_one_aggregation_holds_all_depths(spark):
    turns = prefixes.numbered(frame(spark, [(c, t, "user", str(c % 3)) for c in range(30) for t in range(6)]))
    rows, _ = prefixes.blocks(turns, turns.select("conv_id"), 4)
    plan = prefixes.rolled(rows, 4, "count(*) AS n")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Expand") >= 1 and "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
