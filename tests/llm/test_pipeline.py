from collections import Counter

import corpus_pipeline
from gaugeworks.llm import registered
from gaugeworks.sources.scratch import materialise
from test_fingerprints import LOW
from test_jaccard import brute, shingles
from test_packing import check

SMALL = "/root/testdata/sf0.001"


def test_every_query_is_registered():
    assert sorted(n.split("_")[0] for n in registered.QUERIES) == sorted(["pipeline", *(f"op{i}" for i in range(1, 14))])


def test_stages(spark, documents):
    """Each stage against brute force on its own input."""
    docs, names = documents, ["doc_id", "text", "lang", "source", "n_chars"]
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        out = materialise(stage(spark, docs, SMALL))
        before = [tuple(r) for r in docs.select("doc_id", "text", "source").collect()]
        after = [tuple(r) for r in out.select(*(["doc_id", "text", "source"] if name != "packing" else ["doc_id"])).collect()]
        if name != "packing":
            assert out.columns == names and set(after) <= set(before)
        if name == "quality classifier":
            assert 0.5 * len(before) < len(after) < len(before)
        elif name == "exact dedup":
            last = {}
            for i, t, _ in before:
                k = (t or "").translate(LOW)
                last[k] = max(last.get(k, -1), i)
            assert sorted(i for i, *_ in after) == sorted(last.values())
        elif name == "n-gram jaccard join":
            assert sorted(i for i, *_ in after) == sorted(d for d, n, c in brute([(i, t) for i, t, _ in before], 80, 5) if d == c or not n)
        elif name == "mixing":
            assert max(Counter(after).values()) <= 3 and 0.9 < sum(len((t or "").split()) for _, t, _ in after) / sum(len((t or "").split()) for _, t, _ in before) < 1.1
        else:
            check_repeats = Counter(i for i, *_ in before)
            assert set(i for i, in after) == set(check_repeats)
            check(out.collect(), docs)
        seen.append(name)
        docs = out
    assert len(seen) == 5


def test_stages_on_odd_rows(spark, odd, none):
    for docs in (odd, none):
        for name, stage in corpus_pipeline.STAGES:
            out = materialise(stage(spark, docs, SMALL))
            assert out.count() >= 0 and (name == "packing" or out.columns == docs.columns)
            docs = out


def test_run(spark):
    assert corpus_pipeline.run(spark, SMALL).count() > 0


def test_near_takes_five_words_and_eighty_percent(spark):
    """Appended parts and scattered edits between the two limits, against all pairs."""
    base = [f"w{i}" for i in range(104)]
    texts = [base, base + [f"t{i}" for i in range(22)], base + [f"u{i}" for i in range(30)], [w if i not in (20, 60) else f"e{i}" for i, w in enumerate(base)]]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)] + [(10 + i, " ".join(f"v{i}" for i in range(100 + 22 * i))) for i in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sets = [shingles(t, 5) for _, t in rows]
    linked = {(i, j) for i in range(len(rows)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])}
    assert linked == {(1, 0), (3, 0), (5, 4)}
    assert sorted(r.doc_id for r in corpus_pipeline.near(spark, docs, SMALL).collect()) == [0, 2, 10]


def test_near_keeps_one_row_of_null_and_shared_ids(spark):
    """Components whose rows all lack an id, share the smallest one, or have both kinds."""
    words = lambda c: " ".join(f"{c}{i}" for i in range(80))
    rows = [(None, words("a")), (None, words("a") + " x"), (None, words("a") + " y"), (3, words("b")), (3, words("b") + " x"), (4, words("b") + " y"),
            (None, words("c")), (9, words("c") + " x"), (None, words("d")), (None, ""), (5, None), (5, " ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [(r.doc_id, (r.text or "")[:1]) for r in corpus_pipeline.near(spark, docs, SMALL).collect()]
    assert Counter(kept) == Counter({(None, "a"): 1, (3, "b"): 1, (9, "c"): 1, (None, "d"): 1, (None, ""): 1, (5, ""): 1, (5, " "): 1})
