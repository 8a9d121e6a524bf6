"""SimHash near-duplicates met through Golay codes.

The binary Golay code [23, 12] is perfect: every 23-bit word lies within 3 bits of exactly one codeword. Words at
most 2 bits apart have a word between them, at most one bit from each, whose codeword is within 4 bits of
both. So the codewords within 4 bits of a word, one or six of them, are fuzzy keys: words at most 2 bits apart share one.

A 64-bit fingerprint is cut into three segments, each padded to 23 bits. Up to ``ERRORS`` = 4 differing bits spread so that
either no segment has more than 2, and the three codeword indices agree for some choice of keys (36 bits), or
one segment has 3 or 4, and of the other two one has none and one at most 1 (a whole segment and a codeword
index, 33 bits or more). That makes about 180 keys per distinct fingerprint, and no key holds more than one of a fingerprint's rows.

1. A pass over the texts gives fingerprints; equal ones are one node.
2. Nodes first meet by one key, the nearest codewords of the three segments, which joins most of a large group.
3. Then all nodes meet by all keys. Only nodes of different components are compared in a group of one key: a
   component's nodes are taken together, what they reach joins them, and each is compared with the rest once.
4. Links of both passes form components.
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from gaugeworks.llm.common import LOWER_BYTES, text_key, utf8
from gaugeworks.llm.components import components
from gaugeworks.sources.scratch import materialise

SEED, ERRORS = 42, 4
#: Bits of the three segments, from the highest.
SEGMENTS = (22, 21, 21)
LENGTH, CHECK = 23, 11
#: Fixed value: generator polynomial of the binary Golay code.
GENERATOR = 0xC75


def _remainder(value: int) -> int:
    for i in range(LENGTH - 1, CHECK - 1, -1):
        if value >> i & 1:
            value ^= GENERATOR << (i - CHECK)
    return value


class Golay:
    """Codewords within 4 bits of 23-bit words; a codeword's index is its upper 12 bits."""

    def __init__(self):
        unit = np.array([_remainder(1 << i) for i in range(LENGTH)])
        self.low, self.high = (self._sums(unit[part]) for part in (slice(0, 12), slice(12, LENGTH)))
        self.errors = np.full((1 << CHECK, 6), -1, np.int64)
        known = np.zeros(1 << CHECK, np.int64)
        for weight in range(5):
            for bits in combinations(range(LENGTH), weight):
                s = int(np.bitwise_xor.reduce(unit[list(bits)])) if bits else 0
                self.errors[s, known[s]] = sum(1 << b for b in bits)
                known[s] += 1

    @staticmethod
    def _sums(unit: np.ndarray) -> np.ndarray:
        out = np.zeros(1, np.int64)
        for u in unit:
            out = np.concatenate([out, out ^ u])
        return out

    def indices(self, words: np.ndarray) -> np.ndarray:
        """Indices of the codewords within 4 bits, nearest first; -1 fills rows of one."""
        errors = self.errors[self.low[words & 0xFFF] ^ self.high[words >> 12]]
        return np.where(errors >= 0, (words[:, None] ^ errors) >> CHECK, -1)


def segments(prints: np.ndarray) -> list[np.ndarray]:
    """The three segments of each fingerprint."""
    out, at = [], 64
    for bits in SEGMENTS:
        at -= bits
        out.append((prints >> np.uint64(at) & np.uint64((1 << bits) - 1)).astype(np.int64))
    return out


def keys(prints: np.ndarray, golay: Golay) -> tuple[np.ndarray, np.ndarray]:
    """All keys, and for each the position of its fingerprint."""
    parts = segments(prints)
    codes = [golay.indices(p) for p in parts]
    a, b, c = codes
    triple = (a[:, :, None, None] << 24) | (b[:, None, :, None] << 12) | c[:, None, None, :]
    valid = (a >= 0)[:, :, None, None] & (b >= 0)[:, None, :, None] & (c >= 0)[:, None, None, :]
    at, *_ = np.nonzero(valid)
    found, owner, kind = [triple[valid]], [at], 0
    for i in range(3):
        for j in range(3):
            if i != j:
                kind += 1
                at, k = np.nonzero(codes[j] >= 0)
                found.append((kind << 40) | (parts[i][at] << 12) | codes[j][at, k])
                owner.append(at)
    return np.concatenate(found), np.concatenate(owner)


def nearest_key(prints: np.ndarray, golay: Golay) -> np.ndarray:
    """The nearest codewords of the three segments as one key."""
    a, b, c = (golay.indices(p)[:, 0] for p in segments(prints))
    return a << 24 | b << 12 | c


def fingerprint(text: bytes, width: int) -> int:
    """SimHash of a text's word shingles, repeats counted; a bit is set if it is in over half of their hashes."""
    words = text.split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:-1]]).tolist()
    n = max(1, len(words) - width + 1)
    stops = (ends[-n:] - 1).tolist()
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, [joined[x:y] for x, y in zip(starts, stops, strict=False)], repeat(SEED)), np.uint64, n)
    count = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        bits = np.unpackbits(hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        count += bits.sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * count > n, bitorder="little").tobytes(), "little")


def _prints(width: int):
    lower = LOWER_BYTES.tobytes()

    def run(batches):
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            own = [fingerprint(data[x:y].tobytes().translate(lower), width) for x, y in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row_key"), pa.array(np.array(own, np.uint64).view(np.int64))],
                                             ["doc_id", "row_key", "print"])

    return run


def _keyed(all_keys: bool):
    def run(batches):
        golay = Golay()
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                prints = part.column("print").to_numpy().view(np.uint64)
                key, owner = keys(prints, golay) if all_keys else (nearest_key(prints, golay), np.arange(len(prints)))
                rows = part.take(pa.array(owner))
                yield pa.RecordBatch.from_arrays([pa.array(key), rows.column("print"), rows.column("label")], ["key", "print", "label"])

    return run


def links(prints: np.ndarray, labels: np.ndarray, most: int = ERRORS):
    """Pairs of labels of one group that links of at most ``most`` bits join, as a spanning forest.

    A label's nodes are compared with those of all other labels. What they reach joins them with the rest of its label and
    leaves the others, so a group of similar nodes takes about as many comparisons as it has nodes.
    """
    while len(labels):
        root, own = labels[0], labels == labels[0]
        front, prints, labels = prints[own], prints[~own], labels[~own]
        while len(front) and len(prints):
            size = max(1, (1 << 20) // len(prints))
            some, front = front[:size], front[size:]
            close = (np.bitwise_count(some[:, None] ^ prints[None, :]) <= most).any(axis=0)
            if close.any():
                new = np.unique(labels[close])
                joins = np.isin(labels, new)
                front = np.concatenate([front, prints[joins]])
                prints, labels = prints[~joins], labels[~joins]
                yield from ((int(root), x) for x in new.tolist())


def _groups(batches):
    """Prints and labels of every key with several labels, from rows sorted by key."""
    held, held_key = [], None  # the last key's rows so far; it may go on in the next batch
    for batch in batches:
        if not batch.num_rows:
            continue
        key, labels = batch.column("key").to_numpy(), batch.column("label").to_numpy()
        prints = batch.column("print").to_numpy().view(np.uint64)
        start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        end = np.append(start[1:], len(key))
        changes = np.concatenate([[0], np.cumsum(labels[1:] != labels[:-1])])
        wanted = np.flatnonzero(changes[end - 1] != changes[start])
        if held and held_key == key[0]:
            held.append((prints[:end[0]], labels[:end[0]]))
            if len(start) == 1:
                continue
            wanted = wanted[wanted > 0]
        if held:
            yield tuple(np.concatenate(x) for x in zip(*held, strict=True))
        last = len(start) - 1
        for i in wanted[wanted < last].tolist():
            yield prints[start[i]:end[i]], labels[start[i]:end[i]]
        held, held_key = [(prints[start[last]:], labels[start[last]:])], key[-1]
    if held:
        yield tuple(np.concatenate(x) for x in zip(*held, strict=True))


def _joined(batches):
    """Rows sorted by key to the pairs of labels that links join; a task emits a pair once."""
    done: set[tuple[int, int]] = set()
    new: list[tuple[int, int]] = []
    for prints, labels in _groups(batches):
        for pair in links(prints, labels):
            if pair not in done:
                done.add(pair)
                new.append(pair)
        if len(new) >= 10_000:
            yield _pairs(new)
            new = []
    yield _pairs(new)


def _pairs(rows: list[tuple[int, int]]) -> pa.RecordBatch:
    both = np.array(rows, np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])


def _meet(nodes: DataFrame, all_keys: bool) -> DataFrame:
    """Links (a, b) between labels of ``nodes`` (print, label) that share a key. Nodes are dealt out first: each makes many rows."""
    tasks = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    posts = nodes.repartition(tasks, "print").mapInArrow(_keyed(all_keys), "key long, print long, label long")
    return materialise(posts.repartition("key").sortWithinPartitions("key", "label").mapInArrow(_joined, "a long, b long"), "links")


def linked(docs: DataFrame, width: int = 4) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, row_key, fingerprint, component_id.

    The fingerprint takes the shingles of ``width`` words (A-Z lower-cased, repeats counted, joined by a space), hashed by
    XXH64; a text of fewer words is one shingle, and null, empty and blank texts have fingerprint zero and link
    like any other. Fingerprints at most 4 bits apart link. component_id is the smallest doc_id that links
    reach, the row's own included; a null doc_id never is the smallest, and is the result only where no row has
    another. Repeated rows and rows that share a doc_id each give a row; row_key tells them apart by their text.
    Other columns are ignored; an empty table gives an empty result.

    Intermediate tables are written to the shared folder. Rows are grouped by key: a key holds a distinct
    fingerprint once, of its about 180 rows, so that no key can hold a large share of them.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("row_key", text_key(F.col("text")))
    rows = materialise(rows.mapInArrow(_prints(width), "doc_id long, row_key long, print long"), "prints")
    nodes = rows.groupBy("print").agg(F.min("doc_id").alias("first"))
    label = components(_meet(nodes.select("print", F.col("print").alias("label")), False)).withColumnsRenamed({"node": "print", "root": "label"})
    nodes = materialise(nodes.join(label, "print", "left").withColumn("label", F.coalesce("label", "print")), "nodes")
    root = components(_meet(nodes.select("print", "label"), True)).withColumnRenamed("node", "label")
    nodes = nodes.join(root, "label", "left").withColumn("root", F.coalesce("root", "label"))
    firsts = nodes.groupBy("root").agg(F.min("first").alias("component_id"))
    member = nodes.select("print", "root").join(firsts, "root").select("print", "component_id")
    return rows.join(member, "print").select("doc_id", "row_key", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id")
