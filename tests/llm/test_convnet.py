import zlib

import numpy as np
from pyspark.sql import functions as F

from gaugeworks.llm import convnet

SMALL = "/root/testdata/sf0.001"

TINY = convnet.Shape(embed=2, width=3, filters=4, stride=1, chunk=16, overlap=4)


def test_chunks_cover_every_window():
    for n in (0, 1, 11, 12, 13, 16, 17, 40, 200):
        starts = convnet.chunk_starts(n, TINY)
        covered = {(s + k) for s in starts for k in range(TINY.chunk - TINY.width + 1)}
        assert covered >= set(range(max(0, n - TINY.width + 1)))


def model(seed=0):
    rng = np.random.default_rng(seed)
    wide = TINY.width * TINY.embed
    p = {"embed": rng.normal(size=(257, TINY.embed)), "filters": rng.normal(size=(wide, TINY.filters)), "bias": rng.normal(size=TINY.filters),
         "weights": rng.normal(size=2 * TINY.filters), "offset": np.array(0.1)}
    return convnet.Model(TINY, 0.5, p)


def slow(raw, m):
    p, tops = m.params, []
    for s in convnet.chunk_starts(len(raw), TINY):
        cells = [raw[i] if i < len(raw) else convnet.PAD for i in range(s, s + TINY.chunk)]
        e = p["embed"][cells]
        tops.append(np.maximum(np.max([e[i:i + 3].ravel() @ p["filters"] + p["bias"] for i in range(TINY.chunk - 2)], axis=0), 0))
    f = np.concatenate([np.mean(tops, axis=0), np.max(tops, axis=0)])
    return 1 / (1 + np.exp(-np.clip(f @ p["weights"] + p["offset"], -30, 30)))


def test_score_is_the_network_for_short_and_long_texts():
    rng, m = np.random.default_rng(3), model()
    texts = [rng.integers(0, 256, n).astype(np.uint8).tobytes() for n in (0, 5, 16, 900, 40, 3000)]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    for most in (2, 1000):
        found = convnet.score(np.frombuffer(b"".join(texts), np.uint8), offsets, m, most_chunks=most)
        assert np.allclose(found, [slow(t, m) for t in texts], atol=1e-6)


def test_training_learns_and_holds_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = {r.doc_id: r for r in convnet.scored(docs.select("doc_id", "text"), convnet.train(docs, labels)).select("doc_id", "score", convnet.held_out(F.col("doc_id")).alias("h")).collect()}
    assert all(r.h == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in rows.items())
    held = [(rows[r.doc_id].score, r.quality) for r in labels.collect() if r.doc_id in rows and rows[r.doc_id].h]
    good, bad = [s for s, q in held if q == 1], [s for s, q in held if q == 0]
    assert np.mean([[g > b for b in bad] for g in good]) > 0.95


def test_held_out_labels_change_nothing(spark, documents):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    turned = labels.withColumn("quality", F.when(convnet.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = convnet.train(documents, labels), convnet.train(documents, turned)
    assert all((a.params[k] == b.params[k]).all() for k in a.params)


def test_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (None, 0), (7, None)], "doc_id long, quality int")
    out = convnet.scored(odd, convnet.train(odd, labels))
    assert out.columns == [*odd.columns, "score_", "predicted"]
    assert out.count() == odd.count() and all(0 <= r["score_"] <= 1 for r in out.collect())
    fitted = convnet.fit([[b"good text here"], [b"%%$$ bad"]] * 8, np.array([1, 0] * 8), convnet.Shape(), steps=30)
    assert all(0 <= r["score_"] <= 1 for r in convnet.scored(odd, fitted).collect())
    assert convnet.scored(none, fitted).count() == 0
