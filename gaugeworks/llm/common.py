"""Helpers the operators share: columns, Arrow buffers and vectorised hashing."""

from __future__ import annotations

import string

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

UPPER, LOWER = string.ascii_uppercase, string.ascii_lowercase

#: Bytes with A-Z in lower case.
LOWER_BYTES = np.arange(256, dtype=np.uint8)
LOWER_BYTES[65:91] += 32

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` has not yet, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on equal keys where null equals null; the right side's keys are dropped."""
    renamed = right.select(*[F.col(c).alias(f"{c}__r") if c in keys else F.col(c) for c in right.columns])
    on = [left[c].eqNullSafe(renamed[f"{c}__r"]) for c in keys]
    joined = left.join(renamed, on, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"{c}__r" for c in keys])


def text_key(text: Column) -> Column:
    """Tells rows of one doc_id apart."""
    return F.xxhash64(text)


def ascii_lower(text: Column) -> Column:
    """A-Z to lower case and nothing else; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in one array, and the n + 1 offsets of the texts; null counts as empty."""
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    wide = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=wide)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[at[0]:at[-1]], at - at[0]


def slices(offsets: np.ndarray, most: int):
    """Runs of texts (first, last) with about ``most`` bytes together, at least one text each."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1)
        yield first, last
        first = last


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of unsigned 64-bit numbers (the finaliser of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def byte_codes(seed: int) -> np.ndarray:
    """A scrambled 64-bit code for each byte value."""
    return mix(np.arange(1, 257, dtype=np.uint64) * _MULTIPLIER + np.uint64(seed))


def window_hashes(data: np.ndarray, width: int, codes: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the ``width`` bytes from each position; shorter by width - 1 than the data.

    Doubling: the hash of 2k bytes comes from those of k bytes at two positions, so that any width
    takes about 2 log2(width) passes. It depends on the bytes alone, not on where they stand.
    """
    n = len(data) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    power, size, out, done = codes[data], 1, None, 0
    while True:
        if width & size:
            out = power[done:] if out is None else mix(out[:len(data) - done - size + 1] * _MULTIPLIER
                                                       + power[done:done + len(data) - done - size + 1])
            done += size
        if size * 2 > width:
            return out[:n]
        power = mix(power[:len(power) - size] * _MULTIPLIER + power[size:])
        size *= 2


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """The place of a vocabulary file, which is the same on all machines."""
    import public_tokenizers

    return public_tokenizers.path(name)
