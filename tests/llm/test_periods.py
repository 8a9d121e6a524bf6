import random
from fractions import Fraction

import numpy as np
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from gaugeworks.llm import periods


def plain(words):
    """All runs, from their definition: every lag, every stretch."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q - i), q)  # the smallest lag comes first
            i = j
    return sorted((s, length, q) for (s, length), q in found.items())


def fast(*texts):
    number = {}
    flat = [number.setdefault(w, len(number)) for t in texts for w in t]
    at = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    out = [[] for _ in texts]
    for s, length, q in zip(*(x.tolist() for x in periods.runs(np.array(flat, np.int64), at)), strict=True):
        k = int(np.searchsorted(at, s, side="right")) - 1
        out[k].append((s - int(at[k]), length, q))
    return out


def check(*texts):
    assert fast(*texts) == [plain(t) for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from("ab"), max_size=60) | st.lists(st.sampled_from("abc"), max_size=60), min_size=1, max_size=4))
def test_every_run_of_small_alphabets(texts):
    check(*texts)


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 40), st.integers(0, 60), st.integers(4, 7), st.integers(0, 10_000))
def test_planted_periods_between_other_words(period, lead, times, seed):
    rng = random.Random(seed)
    unit = [rng.choice("abcde") for _ in range(period)]
    check([rng.choice("abcde") for _ in range(lead)] + unit * times + unit[:rng.randrange(period)] + [rng.choice("abcde") for _ in range(lead)])


def test_runs_never_cross_texts():
    check(["a"] * 5, ["a"] * 5, ["a"] * 6, [], ["a", "b"] * 3 + ["a"], ["a", "b"] * 4)


def test_one_word_over_and_over_stays_cheap():
    n = 200_000
    assert fast(["x"] * n) == [[(0, n, 1)]]
    unit = [str(i) for i in range(n // 5)]
    assert fast(unit * 5) == [[(0, n // 5 * 5, n // 5)]]


def test_collapsed_and_best(spark, odd):
    docs = spark.createDataFrame([(1, "a a a a a a b c b c b c b c b c d"), (1, "x"), (2, None), (2, None), (None, "q " * 8)], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_words, [tuple(x) for x in r.runs], r.collapsed, r.best and tuple(r.best)) for r in periods.strongest(periods.periodic(docs)).collect())
    assert got == [(0, 8, [(0, 8, 1)], "q", (0, 8, 1)), (1, 1, [], "x", None), (1, 17, [(0, 6, 1), (6, 10, 2)], "a b c d", (0, 6, 1)),
                   (2, 0, [], "", None), (2, 0, [], "", None)]
    assert periods.periodic(odd).count() == odd.count()


def test_rows_against_the_definition(spark, documents, odd, none):
    docs = documents.select("doc_id", F.expr("concat_ws(' ', text, repeat(concat(substr(text, 1, 30), ' '), 5))").alias("text")).limit(40)
    for given_ in (docs, odd.where("length(text) < 5000 or text is null")):
        want = []
        for r in given_.collect():
            words = (r.text or "").encode().split()
            found, gone = plain(words), set()
            for s, length, q in found:
                gone |= set(range(s + q, s + length))
            best = max(found, key=lambda x: (Fraction(x[1], x[2]), -x[0], -x[2]), default=None)
            want.append((str(r.doc_id), len(words), found, b" ".join(w for i, w in enumerate(words) if i not in gone).decode(), best))
        rows = periods.strongest(periods.periodic(given_)).collect()
        assert sorted(want, key=str) == sorted([(str(r.doc_id), r.n_words, [tuple(x) for x in r.runs], r.collapsed, r.best and tuple(r.best)) for r in rows], key=str)
    assert periods.strongest(periods.periodic(none)).collect() == []
