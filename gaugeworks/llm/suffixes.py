"""Repeated byte strings across documents by bucket-pointer refinement.

The question is only which 50-byte strings are equal, and which document with one has the smallest id, so
suffixes are told apart to that depth and no further.

* Bucket identifiers. The identifier of the 30 bytes at an offset comes from those of shorter strings at
  it and at later offsets (doubling), that of 50 bytes from the ones of 30 at it and 20 later.
* Pointers. Each 50-byte string picks one of its 30-byte strings by content alone (the position of its
  least 9-byte hash, modulo 21), so equal strings pick equal ones. Neighbouring strings mostly pick the same, and
  such a run of starts is one pointer. The initial bucket is the 30-byte string's.
* First refinement. Pointers of a bucket are sorted on the identifiers at the run's first and last start, which
  cover its whole context. Where contexts are equal, all documents but the smallest lose the run. If a
  bucket has one context, it is done.
* Second refinement. Only the smallest document of each context of a bucket with several goes on: its strings
  are sorted one by one on their 50-byte identifiers, with the same code.

Each task first resolves what it holds, so a hot string leaves it once. What travels is packed in columns.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from gaugeworks.llm.common import byte_codes, mix, slices, utf8, window_hashes
from gaugeworks.sources.scratch import materialise

DEPTH, GRAM, SMALL = 50, 30, 9
CHOICES = DEPTH - GRAM + 1
#: Bytes of text that a task resolves by itself at a time, and that a part of the buckets or documents stands for.
BLOCK, PART = 1 << 24, 3 << 23
_ODD = np.uint64(0x9E3779B97F4A7C15)

SENT = "part int, kind int, keys binary, ctx binary, ids binary, rows binary, counts binary, lo binary, n binary"
MARKS = "home int, kind int, rows binary, lo binary, n binary"
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
#: Marks, open questions, and strings that only serve to answer those of others.
MARK, ASK, TELL = 0, 1, 2
#: Bytes of a bucket's and of a context's identifier that travel: 96 bits tell contexts apart.
BUCKET_BYTES, CONTEXT_BYTES = 7, 5


def identifiers(data: np.ndarray, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Bucket identifiers of the 30 and of the 50 bytes from each offset."""
    gram = window_hashes(data, GRAM, byte_codes(seed))
    later = DEPTH - GRAM
    return gram, mix(gram[:-later] * _ODD + gram[later:]) if len(gram) > later else gram[:0]


def picks(data: np.ndarray) -> np.ndarray:
    """For each start of a 50-byte string, the offset of the 30-byte string that it picks."""
    v = (window_hashes(data, SMALL, byte_codes(7)) >> np.uint64(32)).astype(np.uint32)
    width, at, size = DEPTH - SMALL + 1, np.arange(len(v), dtype=np.int32), 1

    def lesser(step: int):  # the leftmost minimum of two windows
        right = v[step:] < v[:-step]
        return np.where(right, v[step:], v[:-step]), np.where(right, at[step:], at[:-step])

    while size * 2 <= width:
        v, at = lesser(size)
        size *= 2
    if size < width:
        v, at = lesser(width - size)
    start = np.arange(len(at), dtype=np.int32)
    return start + (at - start) % CHOICES


def pointers(data: np.ndarray, offsets: np.ndarray):
    """Runs of starts with one pick: text, first start in the text, number of starts, bucket and context."""
    empty = np.zeros(0, np.int64)
    if len(data) < DEPTH:
        return empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    gram, deep = identifiers(data)
    pick = picks(data)
    lengths = np.diff(offsets)
    owner = np.repeat(np.arange(len(lengths)), lengths)[:len(pick)]
    valid = np.arange(len(pick)) <= offsets[1:][owner] - DEPTH
    change = np.concatenate([[True], (pick[1:] != pick[:-1]) | (owner[1:] != owner[:-1]) | (valid[1:] != valid[:-1])])
    first = np.flatnonzero(change)
    last = np.append(first[1:], len(pick)) - 1
    first, last = first[valid[first]], last[valid[first]]
    bucket = gram[pick[first]]
    context = mix(deep[first] * _ODD + deep[last] + mix((pick[first] - first).astype(np.uint64) * np.uint64(64) + (last - first).astype(np.uint64)))
    return owner[first], first - offsets[owner[first]], last - first + 1, bucket, context


def _groups(*keys: np.ndarray) -> np.ndarray:
    """Number of each row's group, for rows sorted by the keys."""
    change = np.zeros(len(keys[0]), bool)
    for k in keys:
        change[1:] |= k[1:] != k[:-1]
    return np.cumsum(change)


def _least(group: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The least value of each row's group; groups are runs."""
    if not len(group):
        return values
    first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    return np.minimum.reduceat(values, first)[group]


def _narrow(values: np.ndarray, width: int) -> bytes:
    """The low bytes of 64-bit numbers."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _wide(packed: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(packed) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(packed, np.uint8).reshape(-1, width)
    return out.view("<u8").ravel()


def _by_part(part: np.ndarray):
    if not len(part):
        return []
    order = np.argsort(part, kind="stable")
    cut = np.flatnonzero(np.concatenate([[True], part[order][1:] != part[order][:-1]]))
    return [(int(part[order[a]]), order[a:b]) for a, b in zip(cut, np.append(cut[1:], len(part)), strict=True)]


def _merged(rows: np.ndarray, lo: np.ndarray, n: np.ndarray):
    """Runs of starts of one row that follow each other, as one."""
    if not len(rows):
        return rows, lo, n
    order = np.lexsort((lo, rows))
    rows, lo, n = rows[order], lo[order], n[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (lo[1:] > lo[:-1] + n[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(rows)) - 1
    return rows[first], lo[first], lo[last] + n[last] - lo[first]


def resolved(doc, row, lo, n, bucket, context, parts: int):
    """What a task can say by itself, packed per part: strings to remove (kind 1), and what has to travel (kind 0)."""
    bucket = bucket & np.uint64((1 << 8 * BUCKET_BYTES) - 1)
    order = np.lexsort((context, bucket))
    doc, row, lo, n, bucket, context = (v[order] for v in (doc, row, lo, n, bucket, context))
    lost = doc > _least(_groups(bucket, context), doc)
    out = []
    if lost.any():
        rows, at, count = _merged(row[lost], lo[lost], n[lost])
        for p, i in _by_part(np.mod(rows, parts)):
            out.append((p, 1, b"", b"", b"", rows[i].tobytes(), b"", at[i].astype("<i4").tobytes(), count[i].astype("<i4").tobytes()))
    stay = np.flatnonzero(~lost)
    part = (bucket[stay] % np.uint64(parts)).astype(np.int64)
    for p, i in _by_part(part):
        i = stay[i]
        i = i[np.lexsort((lo[i], row[i]))]
        cut = np.flatnonzero(np.concatenate([[True], row[i][1:] != row[i][:-1]]))
        low, high = (lo[i] & 0xFFFF).astype("<u2"), (lo[i] >> 16).astype("<u2")
        out.append((p, 0, _narrow(bucket[i], BUCKET_BYTES), _narrow(context[i], CONTEXT_BYTES), doc[i[cut]].tobytes(), row[i[cut]].tobytes(),
                    np.diff(np.append(cut, len(i))).astype("<u4").tobytes(), low.tobytes() + high.tobytes(), n[i].astype("u1").tobytes()))
    columns = list(zip(*out, strict=True)) if out else [[]] * 9
    kinds = [pa.int32()] * 2 + [pa.binary()] * 7
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [f.split()[0] for f in SENT.split(", ")])


def _scan(parts: int):
    def run(batches):
        held, size, seen = [], 0, set()
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            docs, rows = batch.column("doc_id").to_numpy(), batch.column("row").to_numpy()
            for a, b in slices(offsets, 1 << 20):
                owner, lo, n, bucket, context = pointers(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                own_rows = rows[a:b]
                new = np.array([r not in seen and not seen.add(r) for r in own_rows.tolist()], bool)  # identical rows count once
                keep = new[owner]
                held.append((docs[a:b][owner][keep], own_rows[owner][keep], lo[keep].astype(np.int32), n[keep].astype(np.int32), bucket[keep], context[keep]))
                size += offsets[b] - offsets[a]
                if size >= BLOCK:
                    yield resolved(*map(np.concatenate, zip(*held, strict=True)), parts)
                    held, size, seen = [], 0, set()
        if held:
            yield resolved(*map(np.concatenate, zip(*held, strict=True)), parts)

    return run


def _refine(parts: int, ask: bool):
    """A part's pointers: which strings go, and which have to be looked at one by one (only if ``ask``)."""
    def run(table: pa.Table) -> pa.Table:
        out = []
        columns = {f: [] for f in ("bucket", "context", "doc", "row", "lo", "n")}
        for r in table.to_pylist():
            if r["kind"] == 1:
                out.append((r["part"], MARK, r["rows"], r["lo"], r["n"]))
                continue
            counts = np.frombuffer(r["counts"], "<u4")
            low, high = np.frombuffer(r["lo"], "<u2").reshape(2, -1).astype(np.int32)
            for f, v in (("bucket", _wide(r["keys"], BUCKET_BYTES)), ("context", _wide(r["ctx"], CONTEXT_BYTES)),
                         ("doc", np.repeat(np.frombuffer(r["ids"], np.int64), counts)), ("row", np.repeat(np.frombuffer(r["rows"], np.int64), counts)),
                         ("lo", low + (high << 16)), ("n", np.frombuffer(r["n"], "u1").astype(np.int32))):
                columns[f].append(v)
        if columns["bucket"]:
            bucket, context, doc, row, lo, n = (np.concatenate(v) for v in columns.values())
            order = np.lexsort((context, bucket))
            bucket, context, doc, row, lo, n = (v[order] for v in (bucket, context, doc, row, lo, n))
            whole, fine = _groups(bucket), _groups(bucket, context)
            lost = doc > _least(fine, doc)
            kinds = [(MARK, lost)]
            if ask:
                several = -_least(whole, -fine) != _least(whole, fine)
                first = _least(whole, doc)
                open_ = ~lost & several & (-_least(whole, -doc) != first)
                kinds += [(ASK, open_ & (doc > first)), (TELL, open_ & (doc == first))]
            for kind, pick in kinds:
                rows, at, count = _merged(row[pick], lo[pick], n[pick])
                for p, i in _by_part(np.mod(rows, parts)):
                    out.append((p, kind, rows[i].tobytes(), at[i].astype("<i4").tobytes(), count[i].astype("<i4").tobytes()))
        columns = list(zip(*out, strict=True)) if out else [[]] * 5
        return pa.table([pa.array(c, k) for c, k in zip(columns, [pa.int32()] * 2 + [pa.binary()] * 3, strict=True)], names=["home", "kind", "rows", "lo", "n"])

    return run


def _runs(table: pa.Table) -> tuple[np.ndarray, ...]:
    """All runs of a table of marks, sorted by row: row, kind, first start, number of starts."""
    rows, lo, n = (np.frombuffer(b"".join(table[c].to_pylist()), k).astype(np.int64) for c, k in (("rows", "<i8"), ("lo", "<i4"), ("n", "<i4")))
    kind = np.repeat(table["kind"].to_numpy(), [len(v) // 8 for v in table["rows"].to_pylist()])
    order = np.argsort(rows, kind="stable")
    return rows[order], kind[order], lo[order], n[order]


def _packed(batches):
    """Texts by their home, compressed for the shuffle."""
    pack = zstandard.ZstdCompressor()
    for batch in batches:
        texts = pa.array([pack.compress(t.as_buffer()) for t in batch.column("text")], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row"), texts, batch.column("home")], ["doc_id", "row", "packed", "home"])


def _apply(left: pa.Table, right: pa.Table) -> pa.Table:
    """Documents with their marks. A row is final, or has open questions, and then its text and marks; ``pieces``
    are the strings that questions are about, its own or those of others."""
    rows, kind, lo, n = _runs(right)
    begin, end = (np.searchsorted(rows, left["row"].to_numpy(), side=s) for s in ("left", "right"))
    before = left["marks"].to_pylist() if "marks" in left.schema.names else [None] * left.num_rows
    unpack, out = zstandard.ZstdDecompressor(), []
    for packed, a, b, known in zip(left["packed"], begin.tolist(), end.tolist(), before, strict=True):
        raw = unpack.decompress(packed.as_buffer())
        runs = np.stack([lo[a:b], n[a:b]], axis=1)
        gone, shown = runs[kind[a:b] == MARK], runs[kind[a:b] != MARK]
        if known:
            gone = np.concatenate([np.frombuffer(known, "<i8").reshape(-1, 2), gone])
        final, rest = (len(raw), None, None, None), (None, None)
        if (kind[a:b] == ASK).any():
            rest = packed.as_py(), gone.astype("<i8").tobytes()
        else:
            keep, count, spans = raw, 0, 0
            if len(gone):
                edge = np.zeros(len(raw) + 1, np.int64)
                np.add.at(edge, gone[:, 0], 1)
                np.add.at(edge, gone[:, 0] + gone[:, 1] - 1 + DEPTH, -1)
                lost = np.cumsum(edge[:-1]) > 0
                keep, count = np.frombuffer(raw, np.uint8)[~lost].tobytes(), int(lost.sum())
                spans = int(lost[0]) + int((lost[1:] & ~lost[:-1]).sum())
            final = len(raw), count, spans, hashlib.sha256(keep).hexdigest()
        pieces = b"".join(raw[x:x + m - 1 + DEPTH] for x, m in shown.tolist()) if len(shown) else None
        out.append((*final, *rest, shown.astype("<i8").tobytes() if len(shown) else None, pieces))
    columns = list(zip(*out, strict=True)) if out else [[]] * 8
    kinds = [pa.int64()] * 3 + [pa.string()] + [pa.binary()] * 4
    return pa.table([left["doc_id"], left["row"], *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]],
                    names=["doc_id", "row", "n_bytes", "n_removed", "n_spans", "kept_sha256", "packed", "marks", "shown", "pieces"])


def _one_by_one(parts: int):
    """The strings of open questions, each a pointer of its own, by two independent 50-byte identifiers."""
    def pointers_of(docs, rows, shown, pieces):
        runs = [np.frombuffer(v, "<i8").reshape(-1, 2) for v in shown]
        lo, n = np.concatenate(runs).T
        owner = np.repeat(np.arange(len(runs)), [len(r) for r in runs])
        size = n - 1 + DEPTH
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        at = np.repeat(np.cumsum(size) - size, n) + within  # starts in the joined pieces; no string crosses two of them
        data = np.frombuffer(b"".join(pieces), np.uint8)
        owner = np.repeat(owner, n)
        return (np.array(docs)[owner], np.array(rows)[owner], (np.repeat(lo, n) + within).astype(np.int32), np.ones(len(at), np.int32),
                identifiers(data, 11)[1][at], identifiers(data, 13)[1][at])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            columns = [batch.column(c) for c in ("doc_id", "row", "shown", "pieces")]
            _, offsets = utf8(columns[3])
            for a, b in slices(offsets, 1 << 20):
                held.append(pointers_of(*(c.slice(a, b - a).to_pylist() for c in columns)))
                size += len(held[-1][0])
                if size >= 1 << 20:
                    yield resolved(*map(np.concatenate, zip(*held, strict=True)), parts)
                    held, size = [], 0
        if held:
            yield resolved(*map(np.concatenate, zip(*held, strict=True)), parts)

    return run


def removed(docs: DataFrame, part_bytes: int = PART) -> DataFrame:
    """Remove each byte covered by a 50-byte string that also starts in a document with a smaller doc_id.

    One row per row of ``docs`` (doc_id, text): doc_id, n_bytes, n_removed, n_spans, kept_sha256. Texts are
    UTF-8 bytes, null is empty; strings are judged on the input and never cross documents. Rows that share a
    doc_id do not remove from each other; rows with a null doc_id neither lose nor remove anything. Identical rows
    get identical results. Other columns are ignored; an empty table gives an empty result.

    Strings are told apart by 96 bits of hashes. Full texts are shuffled once, compressed, and those with open
    questions once more. The driver sees the number of bytes, from which the number of parts follows.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("text")).withColumn("row", F.xxhash64("doc_id", "text"))
    parts = max(1, -(-(rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // part_bytes))
    home = F.pmod("row", F.lit(parts)).cast("int")
    sent = rows.where("doc_id is not null").mapInArrow(_scan(parts), SENT)
    marks = sent.groupBy("part").applyInArrow(_refine(parts, True), MARKS)
    kind = RESULT.replace("doc_id long,", "doc_id long, row long,") + ", packed binary, marks binary, shown binary, pieces binary"
    texts = rows.withColumn("home", home).mapInArrow(_packed, "doc_id long, row long, packed binary, home int")
    first = materialise(texts.groupBy("home").cogroup(marks.groupBy("home")).applyInArrow(_apply, kind), "first")
    shown = first.where("shown is not null").select("doc_id", "row", "shown", "pieces")
    again = shown.mapInArrow(_one_by_one(parts), SENT).groupBy("part").applyInArrow(_refine(parts, False), MARKS)
    open_ = first.where("packed is not null").select("doc_id", "row", "packed", "marks").withColumn("home", home)
    rest = open_.groupBy("home").cogroup(again.groupBy("home")).applyInArrow(_apply, kind)
    names = [f.split()[0] for f in RESULT.split(", ")]
    return first.where("packed is null").select(*names).union(rest.select(*names))
