"""Order-preserving packing of token streams into fixed windows.

Documents are one stream, in the order of the table. Candidate cuts are document ends, sentence ends
and, inside long stretches without one, every few tokens. Dynamic programming picks the cuts with the
least sum of padding, truncation penalties (per cut inside a document) and a small cost per window:

    best[j] = penalty[j] + opening + min over i within a window before j of best[i] + window - (at[j] - at[i])

The minimum of best[i] + at[i] over a sliding range comes from a monotone queue, so a block is linear
in its candidates. Lengths of a power of two need no padding and are further transitions.
"""

from __future__ import annotations

import json
import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

WINDOW = 2048
END_OF_DOCUMENT = 1
#: Tokens between forced candidates where no sentence ends; penalties in tokens of padding.
STRIDE, AT_SENTENCE, AT_STRIDE, OPENING = 32, 2.0, 6.0, 8.0
#: Tokens that are solved together.
BLOCK = 1 << 18

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


#: Fixed value: how byte-level vocabularies of this kind split a text before they merge.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Encoder:
    """The ids of texts under a byte-level vocabulary file of ``tokenizers``.

    If the file's merges are in the order of their ids, tiktoken gives the same ids in a third of the
    time; texts that contain a special token's string, and other vocabularies, go through tokenizers.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size()
        self.kind = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.special = [t["content"] for t in model.get("added_tokens", [])]
        vocabulary = {t: i for t, i in model["model"]["vocab"].items() if t not in self.special}
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte = {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in printable)}
        tokens = {i: bytes(byte[c] for c in t) for t, i in vocabulary.items()}
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["model"]["merges"]]
        self.quick = None
        if [vocabulary.get("".join(m)) for m in merges] == list(range(256, 256 + len(merges))):
            import tiktoken

            self.quick = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks={t: i for i, t in tokens.items()}, special_tokens={})
        self.ends = np.array([(b"\n" in t or t.rstrip(b"\"')]").endswith((b".", b"!", b"?"))) for t in (tokens.get(i, b"") for i in range(size))])

    def encode(self, text: str) -> np.ndarray:
        if self.quick is None or any(t in text for t in self.special):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind)
        return np.array(self.quick.encode_ordinary(text), self.kind)


def best_cuts(at: np.ndarray, penalty: np.ndarray, window: int = WINDOW, opening: float = OPENING) -> list[int]:
    """Indexes into ``at`` (rising positions, the first one 0) of the cuts with the least cost, the end included.

    penalty[j] is the price of a cut at at[j]. Neighbouring candidates are at most a window apart.
    """
    n = len(at)
    free: dict[int, list[int]] = {}
    for power in (1 << k for k in range(window.bit_length() - 1)):
        wanted = at - power
        found = np.searchsorted(at, wanted)
        for j in np.flatnonzero((wanted >= 0) & (at[np.minimum(found, n - 1)] == wanted)).tolist():
            free.setdefault(j, []).append(int(found[j]))
    place, price = at.tolist(), (penalty + (opening + window)).tolist()
    best, level, came = [0.0] * n, [0.0] * n, [0] * n  # level: best + place
    queue, head, tail = [0] * (n + 1), 0, 0
    for j in range(1, n):
        i, b = j - 1, place[j]
        value = level[i]
        while tail > head and level[queue[tail - 1]] >= value:
            tail -= 1
        queue[tail] = i
        tail += 1
        while place[queue[head]] < b - window:
            head += 1
        source = queue[head]
        least = level[source] - b
        if j in free:
            for i in free[j]:
                if best[i] - window < least:
                    least, source = best[i] - window, i
        least += price[j]
        best[j], level[j], came[j] = least, least + b, source
    cuts, j = [], n - 1
    while j > 0:
        cuts.append(j)
        j = came[j]
    return cuts[::-1]


class Packer:
    """Feeds on documents in order and yields finished pieces; holds about one block of ids."""

    def __init__(self, ends: np.ndarray, window: int, first_sequence: int, block: int = BLOCK):
        self.ends, self.window, self.sequence, self.block = ends, window, first_sequence, block
        self.parts: list[tuple] = []  # doc_id, ids, start in the document, tokens of the document
        self.held = 0

    def add(self, doc_id, ids: np.ndarray):
        for a in range(0, len(ids), self.block):
            part = ids[a:a + self.block]
            self.parts.append((doc_id, part, a, len(ids)))
            self.held += len(part)
            if self.held >= self.block:
                yield from self.solve(last=False)

    def candidates(self) -> tuple[np.ndarray, np.ndarray]:
        ids = np.concatenate([p[1] for p in self.parts])
        price = np.full(len(ids) + 1, np.inf)
        price[1:][self.ends[ids]] = AT_SENTENCE
        tails = np.cumsum([len(p[1]) for p in self.parts])
        whole = np.array([p[2] + len(p[1]) == p[3] for p in self.parts])
        price[tails[whole]], price[0] = 0, 0
        price[-1] = min(price[-1], AT_STRIDE)
        known = np.flatnonzero(np.isfinite(price))
        since = np.arange(len(price)) - np.repeat(known, np.diff(np.append(known, len(price))))
        price[(since > 0) & (since % STRIDE == 0)] = AT_STRIDE
        at = np.flatnonzero(np.isfinite(price))
        return at, price[at]

    def solve(self, last: bool):
        """Cut what is held. All but the last window is final, unless the stream ends here."""
        if not self.held:
            return
        at, price = self.candidates()
        cuts = at[best_cuts(at, price, self.window)].tolist()
        if not last and len(cuts) > 1:
            cuts.pop()
        elif not last:
            return
        k, used = 0, 0  # part, ids of it already placed
        done = 0
        for cut in cuts:
            offset = 0
            while done < cut:
                doc_id, ids, start, total = self.parts[k]
                take = min(len(ids) - used, cut - done)
                piece = ids[used:used + take]
                yield doc_id, start + used, take, zlib.crc32(piece.astype("<u4").tobytes()), total, self.sequence, offset
                offset, done, used = offset + take, done + take, used + take
                if used == len(ids):
                    k, used = k + 1, 0
            self.sequence += 1
        rest = self.parts[k:]
        if used:
            doc_id, ids, start, total = rest[0]
            rest[0] = (doc_id, ids[used:], start + used, total)
        self.parts, self.held = rest, self.held - done


def pack(docs: DataFrame, tokenizer_path: str, window: int = WINDOW) -> DataFrame:
    """Pack the texts of ``docs`` (doc_id, text) into sequences of at most ``window`` tokens.

    One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id and offset. A document's
    ids are its text's, then END_OF_DOCUMENT; null and empty texts have that one id. Every id lies in one
    piece. Repeated rows are packed as often as they occur, a null doc_id stays null, other columns are
    ignored, and an empty table gives an empty result.

    Every task packs its part of the stream by itself: nothing is shuffled, a hot source or a very long
    text changes nothing, and a task that runs again finds the same cuts. Each task's last sequence may
    end early, at a power of two if that is cheaper.
    """
    def run(batches):
        encoder = Encoder(tokenizer_path)
        packer = Packer(encoder.ends, window, TaskContext.get().partitionId() << 32)
        rows: list[tuple] = []

        def out(all_rows: bool):
            while len(rows) >= 50_000 or all_rows and rows:
                part = rows[:50_000]
                del rows[:50_000]
                columns = list(zip(*part, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                                 ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                ids = encoder.encode(text.as_py() or "")
                rows.extend(packer.add(doc_id.as_py(), np.append(ids, encoder.kind.type(END_OF_DOCUMENT))))
            yield from out(False)
        rows.extend(packer.solve(last=True))
        yield from out(True)

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)
