import hashlib
import random
from collections import Counter

import numpy as np

from gaugeworks.llm import suffixes


def brute(rows):
    first = {}
    raw = [(d, (t or "").encode()) for d, t in rows]
    for d, b in raw:
        if d is not None:
            for s in range(len(b) - 49):
                k = b[s:s + 50]
                first[k] = min(first.get(k, d), d)
    out = Counter()
    for d, b in raw:
        gone = bytearray(len(b))
        for s in range(len(b) - 49):
            if d is not None and first[b[s:s + 50]] < d:
                gone[s:s + 50] = b"\1" * 50
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out[d, len(b), sum(gone), sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1])), hashlib.sha256(kept).hexdigest()] += 1
    return out


def check(docs, **options):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    found = suffixes.removed(docs, **options).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found) == brute(rows)


def test_against_brute_force(documents):
    check(documents, part_bytes=40_000)


def test_odd_rows(odd, none):
    check(odd)
    assert suffixes.removed(none).count() == 0


def test_passages_runs_and_edges(spark):
    """One common passage between different neighbours, runs of one character, and copies cut by a byte."""
    rnd = random.Random(8)
    word = lambda: "".join(rnd.choice("abcdefghij ") for _ in range(rnd.randint(20, 90)))
    passage = word() + word()
    texts = [word() + passage[rnd.randint(0, 3):] + word() for _ in range(30)]
    texts += [passage[:n] for n in (49, 50, 51)] + ["-" * n for n in (49, 50, 60, 200)] + [word() + "=" * n + word() for n in (48, 50, 70)]
    texts += [texts[0], texts[0][1:], texts[0][:-1], texts[1] + texts[2], "é" * 40, "é" * 25, "xé" * 30]
    ids = list(range(len(texts)))
    rnd.shuffle(ids)
    docs = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string").repartition(4)
    check(docs, part_bytes=300)


def test_picks_depend_on_the_string_alone():
    rng = np.random.default_rng(4)
    piece = rng.integers(97, 101, 300).astype(np.uint8)
    at = suffixes.picks(piece) - np.arange(251)
    for shift in (1, 7, 20, 21, 33):
        moved = np.concatenate([rng.integers(97, 101, shift).astype(np.uint8), piece])
        assert (suffixes.picks(moved)[shift:] - np.arange(shift, shift + 251) == at).all()
    assert at.min() >= 0 and at.max() <= 20
