import hashlib
import string
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from gaugeworks.llm import fingerprints

LOW = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
POWERS = [fingerprints._powers(b, m) for b, m in zip(fingerprints.BASES, fingerprints.MODULI, strict=True)]


def plain(raw, which):
    b, m = fingerprints.BASES[which], fingerprints.MODULI[which]
    return sum((x + 1) * pow(b, i, m) for i, x in enumerate(raw)) % m


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=40), max_size=6))
def test_fingerprints_follow_the_formula(texts):
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    assert fingerprints.fingerprints(data, offsets, POWERS).tolist() == [plain(t, 0) << 31 | plain(t, 1) for t in texts]


def test_chunks_of_a_long_text_combine():
    raw = np.random.default_rng(2).integers(0, 256, 150_000).astype(np.uint8).tobytes()
    whole = fingerprints.fingerprints(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), POWERS)[0]
    left, right = raw[:70_001], raw[70_001:]
    parts = [fingerprints.combine(plain(left, k), len(left), plain(right, k), k) for k in (0, 1)]
    assert int(whole) == parts[0] << 31 | parts[1]


def check(rows, docs):
    texts = [(r.doc_id, (r.text or "").translate(LOW)) for r in docs.select("doc_id", "text").collect()]
    groups = defaultdict(list)
    for i, t in texts:
        groups[t].append(i)
    sha = {hashlib.sha256(t.encode()).hexdigest(): t for _, t in texts}
    assert Counter((r.doc_id, sha[r.text_sha256]) for r in rows) == Counter(texts)
    kept = Counter()
    for r in rows:
        g = groups[sha[r.text_sha256]]
        assert r.group_size == len(g) and r.keep_id == max((i for i in g if i is not None), default=None)
        kept[r.text_sha256] += r.kept
        assert not r.kept or r.doc_id == r.keep_id
    assert set(kept.values()) <= {1}


def test_against_brute_force(documents):
    check(fingerprints.duplicates(documents).collect(), documents)


def test_odd_rows(odd, none):
    check(fingerprints.duplicates(odd, chunk_chars=100, copies_per_salt=1).collect(), odd)
    assert fingerprints.duplicates(none).count() == 0


@pytest.mark.parametrize("chunk", [7, 1 << 14])
def test_equal_fingerprints_of_different_texts(spark, monkeypatch, chunk):
    """With a useless fingerprint everything rests on the comparison."""
    monkeypatch.setattr(fingerprints, "MODULI", (1, 1))
    docs = spark.createDataFrame([(i, f"text number {i % 4:03d}") for i in range(40)], "doc_id long, text string")
    check(fingerprints.duplicates(docs, chunk_chars=chunk, copies_per_salt=3).collect(), docs)
