import random
import re
import string
from collections import Counter, defaultdict

import numpy as np
from hypothesis import given, settings, strategies as st

from gaugeworks.llm import components, jaccard
from gaugeworks.llm.common import utf8

import pyarrow as pa

LOW = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def shingles(text, width=4):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    if not w:
        return set()
    return {tuple(w)} if len(w) < width else {tuple(w[i:i + width]) for i in range(len(w) - width + 1)}


def brute(rows, percent=85, width=4):
    """component_id per row by all pairs."""
    sets = [shingles(t, width) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        least[find(i)].append(d)
    return Counter((d, len(sets[i]), min((x for x in least[find(i)] if x is not None), default=None)) for i, (d, _) in enumerate(rows))


def check(docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    found = Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.linked(docs).collect())
    assert found == brute(rows)


def test_against_all_pairs(documents):
    check(documents)


def test_odd_rows(odd, none):
    check(odd)
    assert jaccard.linked(none).count() == 0


def test_near_copies_in_chains_and_stars(spark):
    """A group of near copies of which many pairs stay just below the limit, and one very common passage."""
    rnd = random.Random(5)
    base = [f"w{i}" for i in range(60)]
    texts = []
    for _ in range(60):
        own = list(base)
        for _ in range(rnd.randint(0, 4)):
            own[rnd.randrange(len(own))] = f"x{rnd.randrange(50)}"
        texts.append(" ".join(own))
    common = " ".join(f"c{i}" for i in range(12))
    texts += [common + " " + " ".join(f"z{rnd.randrange(400)}" for _ in range(rnd.randint(1, 20))) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    check(docs)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(st.sampled_from(list("aAbé \t\n\x0b\x1f東")), max_size=14), max_size=6))
def test_set_sizes(texts):
    found = list(jaccard.Grams(4).sets(*utf8(pa.array(texts, pa.string()))))
    assert [len(s) for s in found] == [len(shingles(t)) for t in texts]
    same = [[bool(a) and shingles(a) == shingles(b) for a in texts] for b in texts]
    assert same == [[bool(a) and np.array_equal(x, y) for a, x in zip(texts, found, strict=True)] for y in found] or any(not shingles(t) for t in texts)


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(0, 60), max_size=40), st.sets(st.integers(0, 60), max_size=40))
def test_similar(a, b):
    if a and b:
        x, y = (np.array(sorted(s), np.uint64) for s in (a, b))
        assert jaccard.similar(x, y, 85) == (100 * len(a & b) >= 85 * len(a | b))


def test_components(spark):
    rnd = random.Random(3)
    links = [(i, i + 1) for i in range(100, 140)] + [(rnd.randrange(40), rnd.randrange(40)) for _ in range(25)] + [(200, 200 + i) for i in range(30)] + [(7, 7)]
    found = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    root = {n: n for e in links for n in e}
    for _ in range(200):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    assert found == root


def test_all_links(spark):
    """Links of each row against all pairs, in a group of near copies with different and equal texts."""
    base = [f"w{i}" for i in range(90)]
    texts = [" ".join(base + [f"x{k}_{i}" for i in range(k)]) for k in (0, 1, 2, 5, 9, 12)]
    rows = list(enumerate([*texts, texts[1], texts[1].upper(), "a b", "", None]))
    sets = [shingles(t) for _, t in rows]
    near = lambda i, j: i != j and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])
    found = jaccard.linked(spark.createDataFrame(rows, "doc_id long, text string"), all_links=True).collect()
    assert {r.doc_id: r.links for r in found} == {i: sum(bool(near(i, j)) for j in range(len(rows))) for i in range(len(rows))}
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == brute(rows)


def written(monkeypatch, module):
    """The tables that ``module`` writes from now on, as (name, rows)."""
    tables, real = [], module.materialise

    def seen(df, name):
        out = real(df, name)
        tables.append((name, out.count()))
        return out

    monkeypatch.setattr(module, "materialise", seen)
    return tables


def test_rows_without_partner_fall_away(spark, monkeypatch):
    """Texts that share a passage but are too unlike in size travel no further; texts travel to the rounds only where a partner is left."""
    tables = written(monkeypatch, jaccard)
    shared = " ".join(f"s{i}" for i in range(5))
    unlike = [shared + " " + " ".join(f"u{n}x{i}" for i in range(n)) for n in (5, 20, 60, 180, 540)]
    check(spark.createDataFrame(list(enumerate(unlike)), "doc_id long, text string"))
    assert {n for name, n in tables if name in ("posts", "wanted", "texts")} == {0}
    tables.clear()
    base = [f"w{i}" for i in range(60)]
    near = [" ".join([f"a{k}", *base, f"z{k}"]) for k in range(12)]
    check(spark.createDataFrame(list(enumerate(unlike + near)), "doc_id long, text string"))
    assert [n for name, n in tables if name == "texts"] == [12]  # the stars join all, no round needs texts


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 6), st.integers(1, 40), st.integers(0, 12)), max_size=40), st.integers(1, 5), st.integers(1, 12), st.integers(1, 9))
def test_partners(rows, pairwise, held, size):
    """What stays holds all rows with a partner, each set once a gram, and exactly those in grams compared pair by pair."""
    sets = {}
    rows = sorted((g, s, *sets.setdefault((g, s), (n, min(p, n - 1)))) for g, s, n, p in rows)
    good = lambda a, b: a[:2] != b[:2] and 185 * min(a[2] - a[3], b[2] - b[3]) >= 85 * (a[2] + b[2]) and 100 * min(a[2], b[2]) >= 85 * max(a[2], b[2])
    want = {a for a in rows if any(a[0] == b[0] and good(a, b) for b in rows)}
    ids = lambda s: np.array([s, 7], np.uint64).tobytes()
    batches = [pa.RecordBatch.from_arrays([pa.array([r[0] for r in part], pa.int64()), pa.array([ids(r[1]) for r in part], pa.binary()),
                                           pa.array([r[2] for r in part], pa.int32()), pa.array([r[3] for r in part], pa.int32())], ["gram", "sid", "n", "pos"])
               for part in (rows[k:k + size] for k in range(0, len(rows), size))]
    back = lambda b: [(r["gram"], int(np.frombuffer(r["sid"], np.uint64)[0]), r["n"], r["pos"]) for r in b.to_pylist()]
    before = jaccard.ALL_PAIRS, jaccard.HELD
    try:
        jaccard.ALL_PAIRS, jaccard.HELD = 16, 1000
        exact = [r for b in jaccard._partnered(iter(batches), 85) for r in back(b)]
        jaccard.ALL_PAIRS, jaccard.HELD = pairwise, held
        kept = [r for b in jaccard._partnered(iter(batches), 85) for r in back(b)]
    finally:
        jaccard.ALL_PAIRS, jaccard.HELD = before
    assert len(exact) == len(set(exact)) and want <= set(exact)
    assert set(exact) == want or max(Counter(r[0] for r in set(rows)).values()) > 16
    assert want <= set(kept) <= set(rows) and kept == sorted(kept)


def test_stars_are_written_once(spark, monkeypatch):
    tables = written(monkeypatch, components)
    found = {r.node: r.root for r in components.components(spark.createDataFrame([(9, 1), (1, 8), (7, 2), (3, 3)], "a long, b long")).collect()}
    assert found == {1: 1, 8: 1, 9: 1, 2: 2, 7: 2, 3: 3}
    assert tables == [("edges", 3)]
