import random
import string
from collections import defaultdict

import numpy as np
import xxhash

from gaugeworks.llm import simhash

LOW = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def plain(text, width=4):
    words = (text or "").translate(LOW).encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints):
    prints = sorted(set(prints))
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for i, p in enumerate(prints):
        for q in prints[:i]:
            if (p ^ q).bit_count() <= 4:
                root[find(p)] = find(q)
    return {p: find(p) for p in prints}


def check(docs):
    rows = [(r.doc_id, plain(r.text)) for r in docs.select("doc_id", "text").collect()]
    root = components([p for _, p in rows])
    first = defaultdict(list)
    for i, p in rows:
        first[root[p]] += [i] if i is not None else []
    want = sorted((str(i), f"{p:016x}", min(first[root[p]], default=None)) for i, p in rows)
    got = simhash.linked(docs).collect()
    assert sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in got) == want
    return want


def test_codewords_within_four_bits():
    golay = simhash.Golay()
    words = np.random.default_rng(1).integers(0, 1 << 23, 300)
    codes = np.array([m << 11 | simhash._remainder(m << 11) for m in range(1 << 12)])
    assert min((int(c)).bit_count() for c in codes[1:]) == 7
    for word, found in zip(words.tolist(), golay.indices(words).tolist(), strict=True):
        near = {m for m in range(1 << 12) if (int(codes[m]) ^ word).bit_count() <= 4}
        assert near == {m for m in found if m >= 0}
        assert (int(codes[found[0]]) ^ word).bit_count() <= 3


def test_prints_up_to_four_bits_apart_share_a_key():
    golay, rng = simhash.Golay(), random.Random(3)
    base = [rng.getrandbits(64) for _ in range(400)]
    for flips in range(5):
        other = [p ^ sum(1 << b for b in rng.sample(range(64), flips)) for p in base]
        found = []
        for prints in (base, other):
            sets = [set() for _ in base]
            for k, i in zip(*(x.tolist() for x in simhash.keys(np.array(prints, np.uint64), golay)), strict=True):
                sets[i].add(k)
            found.append(sets)
        assert all(a & b for a, b in zip(*found, strict=True))


def test_links_of_a_group_span_its_components():
    rng = random.Random(5)
    for _ in range(30):
        prints = [rng.getrandbits(64)]
        while len(prints) < 80:
            prints.append(rng.choice(prints) ^ sum(1 << b for b in rng.sample(range(64), rng.choice([1, 4, 9]))))
        prints = sorted(set(prints))
        pairs = list(simhash.links(np.array(prints, np.uint64), np.arange(len(prints))))
        root = components(prints)
        assert len(pairs) == len(prints) - len(set(root.values()))
        assert all(root[prints[a]] == root[prints[b]] for a, b in pairs)


def test_whole_table_by_brute_force(documents):
    assert len({c for _, _, c in check(documents)}) < documents.count()


def test_large_groups_of_near_copies(spark):
    rng = random.Random(7)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(400):
        own = rng.choice(([*words], [f"v{i}" for i in range(200)]))
        for _ in range(rng.randrange(4)):
            own[rng.randrange(len(own))] = f"x{rng.randrange(50)}"
        rows.append((i, " ".join(own)))
    want = check(spark.createDataFrame(rows + [(1000 + i, f"text number {i} of others " * 2) for i in range(100)], "doc_id long, text string").repartition(5))
    assert len({p for _, p, _ in want}) > 100


def test_groups_go_on_over_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        test_large_groups_of_near_copies(spark)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_odd_rows(odd, none):
    check(odd)
    assert simhash.linked(none).collect() == []
