"""Jaccard join on word n-grams: rare-first prefixes with length, positional and suffix filters.

1. One pass hashes every document's n-grams. It yields the set's size and a 128-bit id of the set, and a
   sketch of document counts of fixed size, over all documents, which orders n-grams from rare to frequent,
   and a parity bitmap of the set. Equal sets are one node from here on.
2. A node's prefix is its rarest n - ceil(t * n) + 1 n-grams. Similar sets share one of them. Rows of
   (n-gram, node) meet by n-gram; rows that no other node of their n-gram passes the length and positional filters
   with fall away.
3. The first round tries each node against one centre per n-gram, the node with the smallest id. That makes
   large groups of near copies stars, with as many pairs as members. Each further round tries a node of an
   n-gram against nodes of other components that no filter keeps apart from it, and joins components: one such
   partner first, then four times as many a round. A node whose partners are all tried leaves its n-gram. The rounds
   end when no n-gram has nodes left, so no link between components is lost.
4. A pair passes the length and positional filters and a bound from the bitmaps: sets differ in at least as many
   n-grams as their bitmaps differ in bits. It is then verified once, on its full sets, after a suffix filter.
   Links form components.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from gaugeworks.llm.common import LOWER_BYTES, byte_codes, mix, slices, text_key, utf8
from gaugeworks.llm.components import components
from gaugeworks.sources.scratch import materialise

CELLS, RANGE = 1 << 22, 1 << 12
ALL_PAIRS, HELD = 16, 20_000  # rows of an n-gram that are compared pair by pair, and that are held at once
MARKS, PART = 1 << 24, 1 << 15  # bits that mark rows whose texts travel, in parts
BITS = 10  # a bitmap has 2 ** BITS bits
_ODD = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


class Grams:
    """Hashes of the distinct word n-grams of texts."""

    def __init__(self, width: int):
        self.width, self.codes = width, byte_codes(9)
        self.powers = np.ones(1, np.uint64)

    def words(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A hash of each word (A-Z lower-cased), and the bounds of each text's words."""
        space = _SPACE[data]
        if space.all():
            return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
        first = ~space
        first[1:] &= space[:-1]
        first[offsets[:-1][np.diff(offsets) > 0]] = True  # a word ends where the next text begins
        cut = np.flatnonzero(first)
        word = ~space[cut]
        place = np.arange(len(data)) - np.repeat(cut, np.diff(np.append(cut, len(data))))  # the first text begins at 0
        need = int(place.max()) + 1
        if need > len(self.powers):
            self.powers = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(2 * need, _ODD)]))
        values = self.codes[LOWER_BYTES[data]] * self.powers[place]
        values[space] = 0
        return mix(np.add.reduceat(values, cut)[word]), np.searchsorted(cut[word], offsets)

    def sets(self, data: np.ndarray, offsets: np.ndarray):
        """The sorted distinct n-gram hashes of each text; a shorter text's whole sequence is its only one."""
        for a, b in slices(offsets, 1 << 21):
            words, bounds = self.words(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
            grams = words
            for k in range(1, self.width):
                grams = mix(grams[:-1] * _ODD + words[k:]) if len(grams) > 1 else grams[:0]
            for x, y in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                if y - x >= self.width:
                    own = np.sort(grams[x:y - self.width + 1])
                    yield own[np.concatenate([[True], own[1:] != own[:-1]])]
                elif y > x:
                    short = np.uint64(y - x)
                    for w in words[x:y]:
                        short = mix(np.array([short]) * _ODD + w)[0]
                    yield np.array([short])
                else:
                    yield np.zeros(0, np.uint64)


def set_id(grams: np.ndarray) -> bytes:
    both = np.array([mix(grams).sum(dtype=np.uint64), mix(grams ^ _ODD).sum(dtype=np.uint64)])
    return mix(both + np.uint64(len(grams))).tobytes()


def _cells(grams: np.ndarray) -> np.ndarray:
    return (grams & np.uint64(CELLS - 1)).astype(np.int64)


def bitmap(grams: np.ndarray) -> bytes:
    """A bit per cell: whether the cell holds an odd number of the set's n-grams. The first bits of a hash are its cell."""
    cells = (grams >> np.uint64(64 - BITS)).astype(np.int64)
    return np.packbits(np.bincount(cells, minlength=1 << BITS).astype(np.uint8) & 1).tobytes()


def _bits(column: pa.Array) -> np.ndarray:
    """Bitmaps as rows of 64-bit numbers."""
    return utf8(column)[0].view(np.uint64).reshape(-1, (1 << BITS) // 64)


def _close(x: np.ndarray, y: np.ndarray, n_x, n_y, percent: int) -> np.ndarray:
    """Whether sets of n_x and n_y n-grams with these bitmaps can reach the similarity."""
    return (100 + percent) * np.bitwise_count(x ^ y).sum(axis=-1, dtype=np.int64) <= (100 - percent) * (n_x + n_y)


def _scan(width: int):
    def run(batches):
        grams, counts = Grams(width), np.zeros(CELLS, np.int64)
        for batch in batches:
            sizes, ids, maps = [], [], []
            for s in grams.sets(*utf8(batch.column("text"))):
                sizes.append(len(s))
                ids.append(set_id(s))
                maps.append(bitmap(s))
                np.add.at(counts, _cells(s), 1)
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row_key"), pa.array(sizes, pa.int64()), pa.array(ids, pa.binary()),
                                              pa.array(maps, pa.binary()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())],
                                             ["doc_id", "row_key", "n", "sid", "bits", "range", "counts"])
        part = np.flatnonzero(counts.reshape(-1, RANGE).any(axis=1))
        packed = [zlib.compress(counts[k * RANGE:(k + 1) * RANGE].astype("<i8").tobytes(), 1) for k in part]
        m = len(part)
        yield pa.RecordBatch.from_arrays([pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.binary()), pa.nulls(m, pa.binary()),
                                          pa.array(part.astype(np.int32)), pa.array(packed, pa.binary())], ["doc_id", "row_key", "n", "sid", "bits", "range", "counts"])

    return run


def _add_up(batches):
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, c in zip(batch.column("range").to_pylist(), batch.column("counts").to_pylist(), strict=True):
            own = np.frombuffer(zlib.decompress(c), "<i8")
            sums[k] = sums[k] + own if k in sums else own
    yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([zlib.compress(v.tobytes(), 1) for v in sums.values()], pa.binary())], ["range", "counts"])


def _prefixes(width: int, percent: int, shared):
    def run(batches):
        grams, done, counts = Grams(width), set(), shared.value
        for batch in batches:
            parts = []
            for s in grams.sets(*utf8(batch.column("text"))):
                sid = set_id(s)
                if not len(s) or sid in done:
                    continue
                done.add(sid)
                length = len(s) - (percent * len(s) + 99) // 100 + 1
                order = np.lexsort((s, counts[_cells(s)]))[:length]
                parts.append((s[order], sid, len(s)))
            if parts:
                sizes = [len(p[0]) for p in parts]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([p[0] for p in parts]).view(np.int64)),
                     pa.array([p[1] for p in parts], pa.binary()).take(pa.array(np.repeat(np.arange(len(parts)), sizes))),
                     pa.array(np.repeat([p[2] for p in parts], sizes).astype(np.int32)),
                     pa.array(np.concatenate([np.arange(n) for n in sizes]).astype(np.int32))], ["gram", "sid", "n", "pos"])

    return run


def _ids(column: pa.Array) -> np.ndarray:
    """Binary ids of 16 bytes as rows of two numbers."""
    return utf8(column)[0].view(np.uint64).reshape(-1, 2)


def _with_partner(gram: np.ndarray, sid: np.ndarray, n: np.ndarray, pos: np.ndarray, percent: int) -> np.ndarray:
    """Rows of whole grams, sorted by (gram, sid): places of those, each once, that pass the length and positional filters with another set."""
    new_gram = np.concatenate([[True], gram[1:] != gram[:-1]])
    once = np.flatnonzero(new_gram | np.concatenate([[True], (sid[1:] != sid[:-1]).any(axis=1)]))
    n, pos = n[once], pos[once]
    cut = np.append(np.flatnonzero(new_gram[once]), len(once))
    sizes, keep = np.diff(cut), np.zeros(len(once), bool)
    for k in np.unique(sizes[(sizes > 1) & (sizes <= ALL_PAIRS)]):
        at = cut[:-1][sizes == k][:, None] + np.arange(k)
        a, b, left = n[at][:, :, None], n[at][:, None, :], (n - pos)[at]
        good = (100 + percent) * np.minimum(left[:, :, None], left[:, None, :]) >= percent * (a + b)
        good &= 100 * np.minimum(a, b) >= percent * np.maximum(a, b)
        good[:, np.arange(k), np.arange(k)] = False
        keep[at] = good.any(axis=2)
    for i in np.flatnonzero(sizes > ALL_PAIRS):  # only by the sizes that the row itself lets pass
        own, left = n[cut[i]:cut[i + 1]], (n - pos)[cut[i]:cut[i + 1]]
        low, high, ordered = -(-percent * own // 100), np.minimum(100 * own, (100 + percent) * left - percent * own) // percent, np.sort(own)
        others = np.searchsorted(ordered, high, side="right") - np.searchsorted(ordered, low) - (own <= high)
        keep[cut[i]:cut[i + 1]] = others > 0
    return once[keep]


def _partnered(batches, percent: int):
    """Rows sorted by (gram, sid) without those that have no partner in their gram. Grams of more than HELD rows pass as they are, in a stream."""
    rest, wide = None, None
    for batch in _with_end(batches):
        parts = [x for x in (rest, batch) if x is not None and x.num_rows]
        if not parts:
            continue
        rows, rest = pa.concat_batches(parts), None
        gram = rows.column("gram").to_numpy()
        if wide is not None:
            more = int(np.searchsorted(gram, wide, side="right"))
            if more:
                yield rows.slice(0, more)
            rows, gram = rows.slice(more), gram[more:]
            if not len(gram):
                continue
            wide = None
        if batch is not None:
            last = int(np.searchsorted(gram, gram[-1]))
            rest, rows, gram = rows.slice(last), rows.slice(0, last), gram[:last]
        if len(gram):
            n, pos = (rows.column(c).to_numpy().astype(np.int64) for c in ("n", "pos"))
            yield rows.take(pa.array(_with_partner(gram, _ids(rows.column("sid")), n, pos, percent)))
        if rest is not None and rest.num_rows > HELD:
            wide = rest.column("gram")[0].as_py()
            yield rest
            rest = None


def _centres(percent: int):
    def run(batches):
        return _to_centres(_partnered(batches, percent))

    return run


def _to_centres(batches):
    """Rows sorted by (gram, sid) to (row, first row of its gram), in a stream; equal rows count once."""
    gram, sid, centre = None, None, None  # of the last row; centre: its sid, n and pos
    for batch in batches:
        if not batch.num_rows:
            continue
        g, s = batch.column("gram").to_numpy(), _ids(batch.column("sid"))
        new_gram = np.concatenate([[gram is None or g[0] != gram], g[1:] != g[:-1]])
        new = new_gram | np.concatenate([[sid is None or (s[0] != sid).any()], (s[1:] != s[:-1]).any(axis=1)])
        first = np.maximum.accumulate(np.where(new_gram, np.arange(len(g)), -1))
        keep = np.flatnonzero(new & ~new_gram)
        heads = pa.RecordBatch.from_arrays([batch.column(c) for c in ("sid", "n", "pos")], ["c_sid", "c_n", "c_pos"])
        if centre is not None:
            heads = pa.concat_batches([centre, heads])
            first = first + 1
        else:
            first = np.maximum(first, 0)
        own, of = batch.take(pa.array(keep)), heads.take(pa.array(first[keep]))
        centre = heads.slice(int(first[-1]), 1)
        centre = pa.RecordBatch.from_pylist(centre.to_pylist(), schema=centre.schema)
        gram, sid = g[-1], s[-1].copy()
        yield pa.RecordBatch.from_arrays([*own.columns, *of.columns], [*own.schema.names, *of.schema.names])


def _groups(batches):
    """Rows sorted by gram to batches of whole grams, with the bounds of the grams in each."""
    rest = None
    for batch in _with_end(batches):
        if batch is not None:
            table = pa.Table.from_batches([*([rest] if rest is not None else []), batch]).combine_chunks()
            if not table.num_rows:
                continue
            rows = table.to_batches()[0]
        elif rest is not None:
            rows = rest
        else:
            return
        g = rows.column("gram").to_numpy()
        cut = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1], [True]]))
        if batch is not None:
            rest = rows.slice(int(cut[-2]))
            cut = cut[:-1]
        if len(cut) > 1:
            yield rows.slice(0, int(cut[-1])), cut


def _several(rows: pa.RecordBatch, cut: np.ndarray) -> np.ndarray:
    """Whether a gram's rows, sorted by label, have several labels."""
    label = _ids(rows.column("label"))
    return (label[cut[:-1]] != label[cut[1:] - 1]).any(axis=1)


def _open(batches):
    """Rows sorted by (gram, label) to those of grams with several labels."""
    for rows, cut in _groups(batches):
        yield rows.filter(pa.array(np.repeat(_several(rows, cut), np.diff(cut)))).select(["gram", "sid", "n", "pos"])


def _pairs_apart(percent: int, most: int | None):
    """Rows sorted by (gram, label), with bitmaps: pairs of different labels that pass the filters.

    Each row comes with its ``most`` partners of the smallest ids; with None every pair comes once. ``more`` marks one
    pair of a row that has further partners. The filters are symmetric and labels only merge, so other rows are of no
    use to later rounds: all their pairs are out.
    """
    def group(sid, label, n, pos, bits):
        order = np.argsort(n, kind="stable")
        sid, label, n, pos, bits = sid[order], label[order], n[order], pos[order], bits[order]
        by_id = np.lexsort((sid[:, 1], sid[:, 0]))
        rank = np.empty(len(n), np.int64)
        rank[by_id] = np.arange(len(n))
        begin = np.searchsorted(n, -(-percent * n // 100)) if most else np.arange(1, len(n) + 1)
        end = np.searchsorted(n, 100 * n // percent, side="right")
        for i in range(len(n)):
            j = np.arange(begin[i], max(begin[i], end[i]))
            overlap = np.minimum(n[i] - pos[i], n[j] - pos[j])
            j = j[((label[j] != label[i]).any(axis=1)) & ((100 + percent) * overlap >= percent * (n[i] + n[j]))]
            j = j[_close(bits[i], bits[j], n[i], n[j], percent)]
            if len(j):
                more = np.zeros(len(j), bool)
                if most and len(j) > most:
                    j, more = j[np.argpartition(rank[j], most)[:most]], more[:most]
                    more[0] = True
                yield np.full(len(j), order[i]), order[j], more

    def result(rows, left, right, more):
        own, partner = rows.take(pa.array(np.concatenate(left))), rows.column("sid").take(pa.array(np.concatenate(right)))
        return pa.RecordBatch.from_arrays([*(own.column(c) for c in ("gram", "sid", "n", "pos")), partner, pa.array(np.concatenate(more))],
                                          ["gram", "sid", "n", "pos", "partner", "more"])

    def run(batches):
        for rows, cut in _groups(batches):
            several = _several(rows, cut)
            sid, label, bits = _ids(rows.column("sid")), _ids(rows.column("label")), _bits(rows.column("bits"))
            n, pos = rows.column("n").to_numpy().astype(np.int64), rows.column("pos").to_numpy().astype(np.int64)
            found, size = [], 0
            for a, b in zip(cut[:-1][several].tolist(), cut[1:][several].tolist(), strict=True):
                for x, y, more in group(sid[a:b], label[a:b], n[a:b], pos[a:b], bits[a:b]):
                    found.append((a + x, a + y, more))
                    size += len(x)
                    if size >= 100_000:
                        yield result(rows, *zip(*found, strict=True))
                        found, size = [], 0
            if size:
                yield result(rows, *zip(*found, strict=True))

    return run


def _possible(percent: int):
    """Pairs (a, b) with sizes and bitmaps to those that the bitmaps do not keep apart."""
    def run(batches):
        for batch in batches:
            n_x, n_y = batch.column("n_x").to_numpy(), batch.column("n_y").to_numpy()
            good = _close(_bits(batch.column("x")), _bits(batch.column("y")), n_x, n_y, percent)
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return run


def _with_end(batches):
    yield from batches
    yield None


def _compressed(shared):
    """The marked rows with their texts compressed."""
    def run(batches):
        pack, marks = zstandard.ZstdCompressor(), shared.value
        for batch in batches:
            mark = batch.column("mark").to_numpy()
            batch = batch.filter(pa.array((marks[mark >> 3] >> (mark & 7).astype(np.uint8)) & 1 == 1))
            texts = pa.array([pack.compress(t.as_buffer()) for t in batch.column("text")], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("row_key"), texts], ["id", "row_key", "packed"])

    return run


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets reach the similarity. The suffix filter cuts both at the same values and bounds the overlap part by part."""
    need = percent * (len(x) + len(y))
    pivots = x[len(x) * np.arange(1, 8) // 8]
    parts_x = np.diff(np.concatenate([[0], np.searchsorted(x, pivots), [len(x)]]))
    parts_y = np.diff(np.concatenate([[0], np.searchsorted(y, pivots), [len(y)]]))
    if (100 + percent) * np.minimum(parts_x, parts_y).sum() < need:
        return False
    return (100 + percent) * len(np.intersect1d(x, y, assume_unique=True)) >= need


def _verify(width: int, percent: int):
    def run(batches):
        grams, unpack = Grams(width), zstandard.ZstdDecompressor()
        for batch in batches:
            good = []
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                raw = [unpack.decompress(t.as_buffer()) for c in ("x", "y") for t in part.column(c)]
                sets = list(grams.sets(np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])])))
                good += [similar(x, y, percent) for x, y in zip(sets[:part.num_rows], sets[part.num_rows:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(good, pa.bool_()))

    return run


def linked(docs: DataFrame, width: int = 4, percent: int = 85, all_links: bool = False) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, row_key, and first.

    Two documents link when 100 * intersection >= percent * union of their sets of word n-grams (A-Z
    lower-cased). component_id is the smallest doc_id that links reach, the row's own included. A text of
    fewer words is one n-gram; null, empty and blank texts have none and link with nothing. Repeated
    rows and rows that share a doc_id are told apart by their text; a null doc_id never is the smallest.
    first holds for the row of a component with the smallest (doc_id, row_key), nulls last, for its identical
    copies, and for every row without words.

    Links inside a component are not all verified, only enough to find it. With ``all_links`` every pair that
    passes the filters is verified, which grows with the square of a group of similar sets, and the
    result has links: the number of other rows that the row links with, those of its own set included.
    Other columns are ignored; an empty table gives an empty result.

    N-grams and sets are told apart by 64- and 128-bit hashes. Every intermediate table is written to
    the shared folder. The driver sees the sketch (CELLS numbers, whatever the input), MARKS bits twice and a few counts.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("row_key", text_key(F.col("text")))
    scan = materialise(rows.mapInArrow(_scan(width), "doc_id long, row_key long, n long, sid binary, bits binary, range int, counts binary"), "scan")
    top = np.iinfo(np.int32).max
    counts = np.zeros(CELLS, np.int32)  # in all, and broadcast
    sketch = scan.where("range is not null").select("range", "counts").repartition("range").mapInArrow(_add_up, "range int, counts binary")
    for r in sketch.collect():
        counts[r["range"] * RANGE:(r["range"] + 1) * RANGE] = np.minimum(np.frombuffer(zlib.decompress(r["counts"]), "<i8"), top)
    shared = docs.sparkSession.sparkContext.broadcast(counts)
    lines = scan.where("range is null").select("doc_id", "row_key", "n", "sid")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_key")
    nodes = lines.where("n > 0").groupBy("sid").agg(F.min(place).alias("at"))

    prefixes = rows.select("text").mapInArrow(_prefixes(width, percent, shared), "gram long, sid binary, n int, pos int")
    posts = materialise(prefixes.repartition("gram").sortWithinPartitions("gram", "sid").mapInArrow(
        _centres(percent), "gram long, sid binary, n int, pos int, c_sid binary, c_n int, c_pos int"), "posts")
    shared.destroy()
    del counts
    # Rows by id, where null counts as 0, and text: rows that this mixes up have one set. A compressed
    # text is a third of the hashes of its set, so texts travel to the verification.
    id_, key = F.coalesce("doc_id", F.lit(0)).alias("id"), ["id", "row_key"]
    wanted = materialise(posts.select("sid").union(posts.select("c_sid")).distinct().join(nodes, "sid").select("sid", "at.doc_id", "at.row_key"), "wanted")
    maps = materialise(scan.where("n > 0").select("sid", "n", "bits").dropDuplicates(["sid"]).join(wanted.select("sid"), "sid", "left_semi"), "maps")

    def fetched(sids: DataFrame) -> DataFrame:
        """The compressed texts of some sets. A bit per hash of a row marks the rows that are wanted, so that few others are shuffled."""
        own = materialise(wanted.join(sids, "sid", "left_semi").select("sid", id_, "row_key"), "own")
        mark = F.pmod(F.xxhash64(*key), F.lit(MARKS)).cast("int").alias("mark")
        marks = np.zeros(MARKS // 8, np.uint8)  # in all, and broadcast
        parts = own.select(mark).groupBy(F.floor(F.col("mark") / PART).alias("part")).agg(F.bitmap_construct_agg(F.col("mark") % PART).alias("bits"))
        for r in parts.collect():
            marks[r["part"] * PART // 8:(r["part"] + 1) * PART // 8] = np.frombuffer(r["bits"], np.uint8)
        marked = own.sparkSession.sparkContext.broadcast(marks)
        packed = rows.select(id_, "row_key", "text").select(*key, mark, "text").mapInArrow(_compressed(marked), "id long, row_key long, packed binary")
        texts = materialise(packed.join(own, key).dropDuplicates(key).select("sid", "packed"), "texts")
        marked.destroy()
        return texts

    def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
        both = pairs.join(texts.select(F.col("sid").alias("b"), F.col("packed").alias("y")), "b").join(
            texts.select(F.col("sid").alias("a"), F.col("packed").alias("x")), "a")
        return materialise(both.select("a", "b", "x", "y").mapInArrow(_verify(width, percent), "a binary, b binary"), "links")

    most = F.least(F.col("n") - F.col("pos"), F.col("c_n") - F.col("c_pos"))
    near = posts.where((F.lit(100 + percent) * most >= F.lit(percent) * (F.col("n") + F.col("c_n")))
                       & (F.lit(100) * F.least("n", "c_n") >= F.lit(percent) * F.greatest("n", "c_n")))
    starred = near.select(F.col("sid").alias("a"), F.col("c_sid").alias("b")).distinct()
    both = (starred.join(maps.select(F.col("sid").alias("a"), F.col("n").alias("n_x"), F.col("bits").alias("x")), "a")
            .join(maps.select(F.col("sid").alias("b"), F.col("n").alias("n_y"), F.col("bits").alias("y")), "b"))
    # Without stars every set is a component of its own, and one round takes all pairs.
    tried = materialise((both.limit(0) if all_links else both).mapInArrow(_possible(percent), "a binary, b binary"), "pairs")
    links = stars = verified(tried, fetched(tried.select(F.col("a").alias("sid")).union(tried.select("b"))))

    def labelled(rows: DataFrame, label: DataFrame) -> DataFrame:
        return rows.join(label, "sid", "left").withColumn("label", F.coalesce("label", "sid"))

    def by_gram(rows: DataFrame) -> DataFrame:
        return rows.repartition("gram").sortWithinPartitions("gram", "label")

    label = components(stars).select(F.col("node").alias("sid"), F.col("root").alias("label"))
    members = posts.select("gram", "sid", "n", "pos").union(posts.select("gram", "c_sid", "c_n", "c_pos").distinct())
    apart = materialise(by_gram(labelled(members, label)).mapInArrow(_open, "gram long, sid binary, n int, pos int"), "apart")
    label = labelled(maps.select("sid", "bits").join(apart.select("sid").distinct(), "sid", "left_semi"), label)

    def found(rows: DataFrame, label: DataFrame, most: int | None) -> DataFrame:
        mapped = by_gram(rows.join(label, "sid"))
        return materialise(mapped.mapInArrow(_pairs_apart(percent, most), "gram long, sid binary, n int, pos int, partner binary, more boolean"), "apart")

    def untried(pairs: DataFrame, tried: DataFrame) -> DataFrame:
        ends = [F.col("sid"), F.col("partner")]
        both = pairs.select(F.least(*ends).alias("a"), F.greatest(*ends).alias("b")).distinct()
        return materialise(both.join(tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti"), "pairs")

    partners = None if all_links else 1
    pairs = found(apart, label, partners)
    # Sets without a partner now never get one, so what the rounds carry along is cut to the others once.
    left = pairs.select("sid").union(pairs.select("partner")).distinct()
    label, texts = materialise(label.join(left, "sid", "left_semi"), "labels"), None
    while True:
        new = untried(pairs, tried)
        apart = pairs.where("more").select("gram", "sid", "n", "pos")
        last = all_links or apart.isEmpty()
        if not new.isEmpty():
            texts = fetched(left) if texts is None else texts
            good = verified(new, texts)
            links, tried = links.union(good), tried.union(new)
            if not last:
                at = label.select("sid", "label")
                ends = good.join(at.withColumnsRenamed({"sid": "a", "label": "at_a"}), "a").join(at.withColumnsRenamed({"sid": "b", "label": "at_b"}), "b")
                merged = components(ends.select(F.col("at_a").alias("a"), F.col("at_b").alias("b"))).select(F.col("node").alias("label"), "root")
                label = materialise(label.join(merged, "label", "left").select("sid", "bits", F.coalesce("root", "label").alias("label")), "labels")
        if last:
            break
        partners *= 4
        pairs = found(apart, label, partners)
    roots = components(links)
    member = nodes.select("sid", "at").join(roots.withColumnRenamed("node", "sid"), "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    firsts = materialise(member.join(member.groupBy("root").agg(F.min("at").alias("first")), "root").select("sid", "first"), "firsts")
    result = lines.join(firsts, "sid", "left")
    more = []
    if all_links:
        weight = lines.where("n > 0").groupBy("sid").agg(F.count(F.lit(1)).alias("rows"))
        both = links.union(links.select("b", "a")).select(F.col("a").alias("of"), F.col("b").alias("sid"))
        others = both.join(weight, "sid").groupBy(F.col("of").alias("sid")).agg(F.sum("rows").alias("others"))
        result = result.join(weight, "sid", "left").join(others, "sid", "left")
        more = [F.when(F.col("n") > 0, F.col("rows") - 1 + F.coalesce("others", F.lit(0))).otherwise(0).alias("links")]
    return result.select("doc_id", F.col("n").alias("n_shingles"),
                                                    F.when(F.col("n") > 0, F.col("first.doc_id")).otherwise(F.col("doc_id")).alias("component_id"), "row_key",
                                                    ((F.col("n") == 0) | place.eqNullSafe(F.col("first"))).alias("first"), *more)
