"""Exact de-duplication by composable polynomial fingerprints.

The fingerprint of bytes b_0 .. b_{n-1} is the sum of (b_i + 1) * B^i modulo a prime, for two primes.
Fingerprints of neighbouring chunks combine: H(xy) = H(x) + B^|x| * H(y), so the chunks of a huge text
are hashed independently, in bounded memory. Texts of equal length and fingerprint are then compared chunk by chunk.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gaugeworks.llm.common import LOWER_BYTES, ascii_lower, null_safe, slices, text_key, utf8
from gaugeworks.sources.scratch import materialise

CHUNK = 1 << 16
MODULI = (2_147_483_647, 2_147_483_629)
BASES = (1_315_423_911, 1_087_388_483)


def _powers(base: int, modulus: int) -> np.ndarray:
    out = [1]
    for _ in range(CHUNK - 1):
        out.append(out[-1] * base % modulus)
    return np.array(out, dtype=np.uint64)


def combine(left: int, left_length: int, right: int, which: int) -> int:
    """Fingerprint of two texts in a row from theirs, for modulus ``which``."""
    return (left + pow(BASES[which], left_length, MODULI[which]) * right) % MODULI[which]


def fingerprints(data: np.ndarray, offsets: np.ndarray, powers: list[np.ndarray]) -> np.ndarray:
    """Both fingerprints of each text in one 62-bit number. data: bytes of all texts, at ``offsets``."""
    lengths = np.diff(offsets)
    chunks = np.maximum(1, -(-lengths // CHUNK))
    owner = np.repeat(np.arange(len(lengths)), chunks)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(chunks) - chunks, chunks)
    start = offsets[:-1][owner] + number * CHUNK
    size = np.minimum(CHUNK, offsets[1:][owner] - start)
    parts = [np.zeros(len(owner), np.uint64) for _ in MODULI]
    full = np.flatnonzero(size > 0)
    bounds = np.append(start[full], offsets[-1])
    for a, b in slices(bounds, 1 << 20):
        pick = full[a:b]
        at = bounds[a:b] - bounds[a]
        values = data[bounds[a]:bounds[b]].astype(np.uint64) + np.uint64(1)
        within = np.arange(len(values)) - np.repeat(at, size[pick])
        for k, p in enumerate(powers):
            parts[k][pick] = np.add.reduceat(values * p[within], at) % np.uint64(MODULI[k])
    first = np.cumsum(chunks) - chunks
    whole = [x[first] for x in parts]
    for i in np.flatnonzero(chunks > 1):
        for k in range(len(MODULI)):
            total, length = 0, 0
            for c in range(first[i], first[i] + chunks[i]):
                total, length = combine(total, length, int(parts[k][c]), k), length + int(size[c])
            whole[k][i] = total
    return (whole[0] << np.uint64(31)) | whole[1]


def _fingerprint_batches(batches):
    powers = [_powers(b, m) for b, m in zip(BASES, MODULI, strict=True)]
    for batch in batches:
        data, offsets = utf8(batch.column("text"))
        codes, digests = [], []
        for a, b in slices(offsets, 1 << 22):
            low = LOWER_BYTES[data[offsets[a]:offsets[b]]]
            at = offsets[a:b + 1] - offsets[a]
            codes.append(fingerprints(low, at, powers))
            digests += [hashlib.sha256(low[x:y]).hexdigest() for x, y in zip(at[:-1], at[1:], strict=True)]
        if codes:
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row_key"), pa.array(np.diff(offsets)),
                 pa.array(np.concatenate(codes).view(np.int64)), pa.array(digests, pa.string())],
                ["doc_id", "row_key", "n_bytes", "print", "text_sha256"])


def duplicates(docs: DataFrame, chunk_chars: int = 1 << 14, copies_per_salt: int = 1000) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; null counts as empty. Of equal texts the
    row with the largest doc_id stays (null is the smallest); of rows that share it as well, exactly
    one. keep_id is null only if every doc_id of the group is. Other columns of ``docs`` are ignored;
    an empty table gives an empty result.

    Only lines of about 100 bytes are grouped. Full texts travel once, to find those with a partner.
    A group's texts are dealt over salts by its size, and a copy of the one that stays goes to each.
    Texts that differ in spite of equal fingerprints are told apart by their SHA-256.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("row_key", text_key(F.col("text")))
    prints = rows.mapInArrow(_fingerprint_batches, "doc_id long, row_key long, n_bytes long, print long, text_sha256 string")
    lines = materialise(prints.groupBy("doc_id", "row_key", "n_bytes", "print", "text_sha256")
                        .agg(F.count(F.lit(1)).alias("copies")), "lines")

    key = ["n_bytes", "print"]
    groups = (lines.groupBy(*key).agg(F.count(F.lit(1)).alias("members"), F.max(F.struct("doc_id", "row_key")).alias("top"))
              .where("members > 1 and n_bytes > 0"))
    salts = F.ceil(F.col("members") / copies_per_salt).cast("int")
    suspects = lines.join(groups, key).select(*key, "doc_id", "row_key", "top", salts.alias("salts"))
    pieces = F.posexplode(F.regexp_extract_all("text", F.lit(f"(?s).{{1,{chunk_chars}}}"), F.lit(0)))
    chunks = null_safe(rows, suspects, ["doc_id", "row_key"]).select(
        *key, "doc_id", "row_key", "salts", (F.struct("doc_id", "row_key") == F.col("top")).alias("is_top"), pieces.alias("part", "chunk")
    ).withColumn("chunk", ascii_lower(F.col("chunk")))
    tops = (chunks.where("is_top").groupBy(*key, "part").agg(F.first("chunk").alias("top_chunk"), F.first("salts").alias("n"))
            .select(*key, "part", "top_chunk", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("salt")))
    compared = (chunks.withColumn("salt", F.pmod(F.xxhash64("doc_id", "row_key"), "salts").cast("int"))
                .join(tops, [*key, "part", "salt"], "left")
                .groupBy("doc_id", "row_key", *key).agg(F.bool_and(F.col("chunk").eqNullSafe(F.col("top_chunk"))).alias("same")))
    other = compared.where("not same").select("doc_id", "row_key", "n_bytes", F.lit(True).alias("differs"))
    classed = null_safe(lines, other, ["doc_id", "row_key", "n_bytes"], "left").withColumn(
        "differs", F.when(F.col("differs"), F.col("text_sha256")).otherwise(""))
    classes = classed.groupBy(*key, "differs").agg(F.max("doc_id").alias("keep_id"), F.max(F.struct("doc_id", "row_key")).alias("top"),
                                                   F.sum("copies").alias("group_size"))
    return (classed.join(classes, [*key, "differs"])
            .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
            .select("doc_id", "keep_id", "group_size",
                    (F.struct("doc_id", "row_key").eqNullSafe(F.col("top")) & (F.col("copy") == 1)).alias("kept"), "text_sha256", "row_key"))
