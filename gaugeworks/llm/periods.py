"""Periodic runs of words by an online sparse diagonal DP.

Entry (i, lag) of the table counts how many words up to word i equal the word ``lag`` before them: it is the
entry at i - 1 plus one where an earlier occurrence of word i stands ``lag`` words back, and is dropped otherwise.
A diagonal that ends after long enough a match is a run.

Only lags that can still become a run are entered. A run of smallest period q has at least 4q words, so that for
k the next power of two from q on, the k words from i on stand earlier at i - q, and nowhere nearer: a nearer
place would make the period smaller. So word i enters one earlier occurrence per octave of lags, the nearest
one of its next k words, and only if that lies more than k / 2 and at most k back. This finds all runs, in
O(n log n) steps even where one word fills a text. Words whose next k words stand nowhere else leave the table
before the next octave; ordinary text is through after the first few.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gaugeworks.llm.common import slices, text_key, utf8

LEAST, TIMES = 6, 4
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"

Prepare = Callable[[int | None, list[bytes]], list[bytes]]


class _Numbers(dict):
    """Numbers words in the order of their first use."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def diagonals(entry: np.ndarray, lag: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of the runs that diagonals of one octave emit.

    ``entry`` are the table's words in order, ``lag`` the lag each one enters. A diagonal goes on while the
    next word enters the same lag; it ends with the k words of its last entry.
    """
    if not len(entry):
        return entry, entry, entry
    first = np.flatnonzero(np.concatenate([[True], (np.diff(entry) != 1) | (np.diff(lag) != 0)]))
    last = np.append(first[1:], len(entry)) - 1
    period = lag[first]
    start = entry[first] - period
    length = entry[last] + k - start
    long = length >= np.maximum(LEAST, TIMES * period)
    return start[long], length[long], period[long]


def runs(words: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All runs of several texts as (start, length, period), ordered by start and period.

    ``words`` holds the texts' word numbers one text after the other, ``offsets`` where they begin and end.
    """
    n = len(words)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    end = offsets[1:][text]
    at = np.arange(n)
    key = text * (int(words.max(initial=0)) + 1) + words
    found, k = [], 1
    while len(at):
        order = np.argsort(key, kind="stable")
        same = key[order[1:]] == key[order[:-1]]
        here, before = order[1:][same], order[:-1][same]
        lag = np.zeros(len(at), np.int64)  # 0: no earlier occurrence
        lag[here] = at[here] - at[before]
        active = np.flatnonzero((2 * lag > k) & (lag <= k))
        found.append(diagonals(at[active], lag[active], k))
        again = np.zeros(len(at), bool)
        again[here] = again[before] = True
        rank = np.full(n, -1)
        rank[at[order]] = np.concatenate([[0], np.cumsum(~same)])
        rank[at[~again]] = -1
        at = at[again]
        at = at[at + 2 * k <= end[at]]
        at = at[rank[at + k] >= 0]
        key = rank[at] * (int(rank.max(initial=0)) + 1) + rank[at + k]
        k *= 2
    start, length, period = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def _search(prepare: Prepare | None):
    def run(batches):
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            ids = batch.column("doc_id").to_pylist() if prepare else None
            for a, b in slices(offsets, 1 << 22):
                texts = [data[offsets[i]:offsets[i + 1]].tobytes().split() for i in range(a, b)]
                if prepare:
                    texts = [prepare(i, w) for i, w in zip(ids[a:b], texts, strict=True)]
                number = _Numbers()
                at = np.concatenate([[0], np.cumsum([len(w) for w in texts])]).astype(np.int64)
                words = np.fromiter((number[w] for t in texts for w in t), np.int64, int(at[-1]))
                start, length, period = runs(words, at)
                drop = np.zeros(int(at[-1]) + 1, np.int64)
                np.add.at(drop, start + period, 1)
                np.add.at(drop, start + length, -1)
                keep = np.cumsum(drop[:-1]) == 0
                owner = np.searchsorted(at, start, side="right") - 1
                bounds = np.searchsorted(owner, np.arange(b - a + 1))
                touched = set(owner.tolist())
                kept = [b" ".join(t if i not in touched else [w for w, k in zip(t, keep[at[i]:at[i + 1]], strict=True) if k])
                        for i, t in enumerate(texts)]
                struct = pa.StructArray.from_arrays([pa.array(x) for x in (start - at[owner], length, period)], ["start", "length", "period"])
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("row_key"), pa.array(np.diff(at)), pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), struct),
                     pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "row_key", "n_words", "runs", "collapsed"])

    return run


def periodic(docs: DataFrame, prepare: Prepare | None = None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, row_key, n_words, runs, collapsed.

    Words are what ASCII white space separates, numbered from 0. A run is a stretch of words with smallest
    period q, at least max(6, 4q) words long, that no neighbouring word extends. runs lists (start, length,
    period) by start, then period. collapsed joins by one space the words that no run holds after its first
    q words. ``prepare`` may change a document's words (doc_id, words) beforehand.

    Null, empty and blank texts have no words, no runs and an empty collapsed text. Repeated rows are searched
    one by one; row_key tells rows of one doc_id apart by their text. Other columns are ignored; an empty
    table gives an empty result. Nothing is shuffled; a task holds one batch, searched in slices of whole texts.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("row_key", text_key(F.col("text")))
    return rows.mapInArrow(_search(prepare), f"doc_id long, row_key long, n_words long, runs {RUNS}, collapsed string")


def strongest(found: DataFrame) -> DataFrame:
    """``found`` of :func:`periodic` with best: its run of greatest length / period, the first of equal ones."""
    better = lambda best, r: F.when(best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best)
    return found.withColumn("best", F.aggregate("runs", F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>"), better))
