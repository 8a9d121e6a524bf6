"""Quality classifier: a byte-level convolutional network in numpy.

Bytes are embedded, learned filters run over overlapping chunks that cover the whole text, each filter is
max-pooled within a chunk, and the chunks' maxima (their mean and their maximum) go through one logistic unit.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructType

from gaugeworks.llm.common import fresh, slices, utf8

PAD = 256


@dataclass
class Shape:
    embed: int = 6
    width: int = 8
    filters: int = 32
    stride: int = 2
    chunk: int = 512
    overlap: int = 64


@dataclass
class Model:
    shape: Shape
    prior: float
    params: dict[str, np.ndarray] | None = None


def chunk_starts(length: int, shape: Shape) -> np.ndarray:
    """Starts of chunks that cover ``length`` bytes; the last one may be padded, an empty text has one."""
    return np.arange(0, max(1, length - shape.overlap), shape.chunk - shape.overlap)


def chunks_of(data: np.ndarray, offsets: np.ndarray, shape: Shape) -> tuple[np.ndarray, np.ndarray]:
    """All chunks of some texts as rows of byte codes, and each row's text."""
    starts = [chunk_starts(n, shape) for n in np.diff(offsets)]
    owner = np.repeat(np.arange(len(starts)), [len(s) for s in starts])
    at = (np.concatenate(starts) + offsets[:-1][owner])[:, None] + np.arange(shape.chunk)
    inside = at < offsets[1:][owner][:, None]
    if not len(data):
        return np.full(at.shape, PAD, np.int16), owner
    return np.where(inside, data[np.minimum(at, len(data) - 1)], np.int16(PAD)), owner


def _windows(rows: np.ndarray, params: dict, shape: Shape) -> np.ndarray:
    embedded = params["embed"][rows].reshape(len(rows), -1)
    count, wide = (shape.chunk - shape.width) // shape.stride + 1, shape.width * shape.embed
    a, b = embedded.strides
    return np.lib.stride_tricks.as_strided(embedded, (len(rows), count, wide), (a, b * shape.stride * shape.embed, b))


def pooled(rows: np.ndarray, params: dict, shape: Shape, places: bool = False):
    """The largest response of each filter within each chunk, after the rectifier; with its place on request."""
    windows = _windows(rows, params, shape)
    response = np.ascontiguousarray(windows).reshape(-1, windows.shape[2]) @ params["filters"] + params["bias"]
    response = response.reshape(len(rows), -1, shape.filters)
    if not places:
        return np.maximum(response.max(axis=1), 0)
    where = response.argmax(axis=1)
    return np.maximum(np.take_along_axis(response, where[:, None], axis=1)[:, 0], 0), where, windows


def combined(maxima: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
    """Per text: the mean and the maximum of its chunks' maxima."""
    first = np.searchsorted(owner, np.arange(texts))
    mean = np.add.reduceat(maxima, first) / np.diff(np.append(first, len(owner)))[:, None]
    return np.hstack([mean, np.maximum.reduceat(maxima, first)])


def probabilities(features: np.ndarray, params: dict) -> np.ndarray:
    z = features @ params["weights"] + params["offset"]
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def score(data: np.ndarray, offsets: np.ndarray, model: Model, most_chunks: int = 256) -> np.ndarray:
    """Probability of label 1 of each text; memory is bounded by ``most_chunks`` chunks at a time."""
    if model.params is None:
        return np.full(len(offsets) - 1, model.prior)
    shape, out = model.shape, []
    for a, b in slices(offsets, most_chunks * shape.chunk // 2):
        at = offsets[a:b + 1] - offsets[a]
        part = data[offsets[a]:offsets[b]]
        if b - a == 1 and len(part) > most_chunks * shape.chunk:  # a very long text: fold its chunks
            total, top, count = 0.0, -np.inf, 0
            starts = chunk_starts(len(part), shape)
            for k in range(0, len(starts), most_chunks):
                own = starts[k:k + most_chunks]
                cells = own[:, None] + np.arange(shape.chunk)
                rows = np.where(cells < len(part), part[np.minimum(cells, len(part) - 1)], np.int16(PAD))
                maxima = pooled(rows, model.params, shape)
                total, top, count = total + maxima.sum(axis=0), np.maximum(top, maxima.max(axis=0)), count + len(own)
            features = np.hstack([total / count, top])[None]
        else:
            rows, owner = chunks_of(part, at, shape)
            maxima = np.concatenate([pooled(rows[k:k + most_chunks], model.params, shape) for k in range(0, len(rows), most_chunks)])
            features = combined(maxima, owner, b - a)
        out.append(probabilities(features, model.params))
    return np.concatenate(out) if out else np.zeros(0)


def fit(texts: list[list[bytes]], labels: np.ndarray, shape: Shape, steps: int = 1200, batch: int = 32, rate: float = 3e-3, seed: int = 4) -> Model:
    """Train on texts given as lists of chunks, by Adam on the logistic loss."""
    prior = (labels.sum() + 1) / (len(labels) + 2) if len(labels) else 0.5
    if len(set(labels.tolist())) < 2:
        return Model(shape, float(prior))
    rng = np.random.default_rng(seed)
    wide = shape.width * shape.embed
    p = {"embed": rng.normal(0, 0.5, (PAD + 1, shape.embed)), "filters": rng.normal(0, (2 / wide) ** 0.5, (wide, shape.filters)),
         "bias": np.zeros(shape.filters), "weights": rng.normal(0, 0.1, 2 * shape.filters), "offset": np.array(np.log(prior / (1 - prior)))}
    p = {k: v.astype(np.float32) for k, v in p.items()}
    p["embed"][PAD] = 0
    first, second, step = {k: np.zeros_like(v) for k, v in p.items()}, {k: np.zeros_like(v) for k, v in p.items()}, 0
    rows = np.full((sum(map(len, texts)), shape.chunk), PAD, np.int16)
    for r, c in enumerate(c for t in texts for c in t):
        rows[r, :len(c)] = np.frombuffer(c, np.uint8)
    begin = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    while step < steps:
        order = rng.permutation(len(texts))
        for k in range(0, len(order), batch):
            own = order[k:k + batch]
            pick = np.concatenate([np.arange(begin[i], begin[i + 1]) for i in own])
            owner = np.repeat(np.arange(len(own)), begin[own + 1] - begin[own])
            part = rows[pick]
            maxima, where, windows = pooled(part, p, shape, places=True)
            features = combined(maxima, owner, len(own))
            error = (probabilities(features, p) - labels[own]) / len(own)
            g = {"weights": features.T @ error, "offset": error.sum()}
            back = error[:, None] * p["weights"][None]
            sizes = np.bincount(owner)[owner][:, None]
            top = features[:, shape.filters:][owner] == maxima
            d = (back[:, :shape.filters][owner] / sizes + back[:, shape.filters:][owner] * top) * (maxima > 0)
            taken = windows[np.arange(len(part))[:, None], where]  # chunk, filter, window
            g["filters"] = np.einsum("cf,cfw->wf", d, taken)
            g["bias"] = d.sum(axis=0)
            inner = (d[:, :, None] * p["filters"].T[None]).reshape(len(part), shape.filters, shape.width, shape.embed)
            cells = part[np.arange(len(part))[:, None, None], where[:, :, None] * shape.stride + np.arange(shape.width)]
            g["embed"] = np.stack([np.bincount(cells.ravel(), inner[..., e].ravel(), PAD + 1) for e in range(shape.embed)], axis=1)
            g["embed"][PAD] = 0
            step += 1
            for name, gradient in g.items():
                first[name] = (0.9 * first[name] + 0.1 * gradient).astype(np.float32)
                second[name] = (0.999 * second[name] + 0.001 * np.square(gradient)).astype(np.float32)
                p[name] = (p[name] - rate * (first[name] / (1 - 0.9 ** step)) / (np.sqrt(second[name] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return Model(shape, float(prior), p)


def held_out(doc_id: Column) -> Column:
    """True for the fifth of the ids that no training may see; a null id is not trained on and not held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", most_rows: int = 3000, most_chunks: int = 6, shape: Shape | None = None) -> Model:
    """Fit on at most ``most_rows`` labelled rows outside the held-out fifth, chosen by a hash of their id.

    The sample is the only thing that reaches the driver: up to ``most_chunks`` evenly spread chunks of each
    of those texts. Without rows of both labels the model is their smoothed share.
    """
    shape = shape or Shape()
    key = F.xxhash64(F.lit("sample"), "doc_id")
    usable = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    ids = usable.groupBy("doc_id").agg(F.max(label).cast("int").alias("y")).orderBy(key, "doc_id").limit(most_rows)
    sample = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")  # bounded by most_rows

    def spread(batches):
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            cut = []
            for a, b in zip(offsets[:-1], offsets[1:], strict=True):
                starts = chunk_starts(b - a, shape)
                starts = starts[np.unique(np.linspace(0, len(starts) - 1, most_chunks).round().astype(int))]
                cut.append([data[a + s:min(b, a + s + shape.chunk)].tobytes() for s in starts])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("y"), pa.array(cut, pa.list_(pa.binary()))], ["doc_id", "y", "chunks"])

    rows = sample.mapInArrow(spread, "doc_id long, y int, chunks array<binary>").orderBy(key, "doc_id", "chunks").limit(most_rows).collect()
    return fit([[bytes(c) for c in r.chunks] for r in rows], np.array([r.y for r in rows]), shape)


def scored(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 if score >= threshold).

    All columns are kept; where a name is taken an underscore is appended. Only the text is an input;
    null and empty texts get the score of an empty chunk. Rows are scored where they lie, without a shuffle.
    """
    names = fresh(docs, "score"), fresh(docs, "predicted")

    def run(batches):
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            p = score(data, offsets, model)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p, pa.float64()), pa.array((p >= threshold).astype(np.int32))],
                                             [*batch.schema.names, *names])

    schema = StructType([*docs.schema.fields]).add(names[0], DoubleType()).add(names[1], IntegerType())
    return docs.mapInArrow(run, schema)
