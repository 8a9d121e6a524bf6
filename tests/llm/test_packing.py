import itertools
import zlib
from collections import Counter, defaultdict

import numpy as np
from hypothesis import given, settings, strategies as st

from gaugeworks.llm import packing
from gaugeworks.llm.common import tokenizer_path

ENCODER = packing.Encoder(tokenizer_path())


def ids_of(text):
    return [*ENCODER.tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(list(" \n\t  \x1c\x85abcÉ東1!'.<|>_") + ["<|endoftext|>", "'s", "  "]), max_size=60).map("".join))
def test_quick_ids_are_the_tokenizers(text):
    assert ENCODER.encode(text).tolist() == ids_of(text)[:-1]


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=80))
def test_quick_ids_on_any_text(text):
    assert ENCODER.encode(text).tolist() == ids_of(text)[:-1]


def cost(at, penalty, cuts, window, opening):
    total, last = 0, 0
    for j in cuts:
        length = at[j] - at[last]
        if length > window:
            return None
        total += penalty[j] + opening + (0 if length & (length - 1) == 0 else window - length)
        last = j
    return total


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 8), min_size=1, max_size=9), st.randoms(use_true_random=False))
def test_cuts_cost_least(gaps, random):
    at = np.concatenate([[0], np.cumsum(gaps)])
    penalty = np.array([0.0] + [random.choice([0.0, 1.5, 4.0]) for _ in gaps])
    found = cost(at, penalty, packing.best_cuts(at, penalty, 8, 0.5), 8, 0.5)
    n = len(gaps)
    every = [cost(at, penalty, [*c, n], 8, 0.5) for k in range(n) for c in itertools.combinations(range(1, n), k)]
    assert found == min(c for c in every if c is not None)


def check(rows, docs, window=packing.WINDOW):
    texts = defaultdict(list)
    for r in docs.select("doc_id", "text").collect():
        texts[r.doc_id].append(ids_of(r.text))
    places, given_ids = defaultdict(list), Counter()
    for r in rows:
        places[r.sequence_id].append(r)
        pieces = [i[r.start:r.start + r.length] for i in texts[r.doc_id] if len(i) == r.doc_tokens]
        assert any(zlib.crc32(np.array(p, "<u4").tobytes()) == r.ids_crc32 for p in pieces)
        given_ids[r.doc_id] += r.length
    assert given_ids == Counter({d: sum(map(len, i)) for d, i in texts.items()})
    fill = []
    for pieces in places.values():
        pieces.sort(key=lambda r: r.offset)
        assert [p.offset for p in pieces] == [0, *itertools.accumulate(p.length for p in pieces)][:-1]
        fill.append(sum(p.length for p in pieces))
    assert max(fill) <= window
    return sum(0 if f & (f - 1) == 0 else window - f for f in fill) / sum(fill)


def test_round_trip(documents):
    assert check(packing.pack(documents, tokenizer_path()).collect(), documents) < 0.02


def test_odd_rows(odd, none):
    check(packing.pack(odd, tokenizer_path()).collect(), odd)
    assert packing.pack(none, tokenizer_path()).count() == 0


def test_small_blocks_keep_order_and_ids():
    rng = np.random.default_rng(1)
    docs = [rng.integers(0, 50_000, n).astype("<u2") for n in (0, 1, 900, 40, 7000, 3, 2048, 500)]
    packer, out = packing.Packer(ENCODER.ends, 256, 5, block=1000), []
    for i, ids in enumerate(docs):
        out += packer.add(i, np.append(ids, np.uint16(1)))
    out += packer.solve(last=True)
    joined = [docs_ids for i, start, n, *_ in out for docs_ids in np.append(docs[i], np.uint16(1))[start:start + n].tolist()]
    assert joined == [x for d in docs for x in [*d.tolist(), 1]]
    assert [r[5] for r in out] == sorted(r[5] for r in out)
