"""Cost-balanced packing of documents into token sequences.

A task streams its documents through the tokenizer and packs them window by window; no row is shuffled. A window holds
about WINDOW tokens. Its sequences are fixed before anything is placed: as many full ones as its tokens fill, and
shorter ones at the powers of two that make up the rest, so nothing is padded. Documents, cut at the capacity, then go
in descending length to the sequence of lowest estimated cost (tokens, plus their attention, which is quadratic in each
piece) that has room for them. What fits nowhere is cut over the roomiest sequences.

NULL text counts as empty: its document is the closing id alone. Repeated rows are packed each; NULL ids stay NULL.
Empty tables give no rows.
Sequence ids carry the task's partition, so the result repeats as long as the input is cut into the same partitions.
"""

from __future__ import annotations

import json
import re
import zlib

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import per_process, pieces

CAPACITY = 2048
WINDOW = CAPACITY << 10
#: Cost of a piece of n tokens: LINEAR * n + QUADRATIC * n * n.
LINEAR, QUADRATIC = 1.0, 1.0 / 1024
END_ID = 1
#: Words whose ids a worker remembers.
WORDS = 400_000
# fixed value: the pattern that cuts text before byte-level merges
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in the vocabulary file: printable bytes for themselves, the
    others, in order, for the letters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Encoder:
    """Ids of texts as little-endian 32-bit numbers, by the vocabulary of a byte-level BPE file.

    A single space between two other characters always opens a new piece, so words are encoded apart and remembered;
    a text with other white space around its spaces is encoded whole. The added tokens of the file stand for their ids
    wherever a text holds them; the texts between them are encoded apart."""

    def __init__(self, path: str, words: int = WORDS):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        vocabulary = content["model"]["vocab"]
        self.added = {t["content"]: t["id"] for t in content.get("added_tokens", [])}
        self.mark = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        letters = byte_letters()
        ranks = {bytes(letters[c] for c in t): i for t, i in vocabulary.items() if all(c in letters for c in t) and t not in self.added}
        self.base = tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.sizes = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for token, i in ranks.items():
            self.sizes[i] = len(token)
        self.words, self.most = {}, words

    def whole(self, text: str) -> bytes:
        ids, at = [], 0
        for found in self.mark.finditer(text) if self.mark else ():
            ids += [*self.base.encode_ordinary(text[at : found.start()]), self.added[found[0]]]
            at = found.end()
        return np.array([*ids, *self.base.encode_ordinary(text[at:])] if ids else self.base.encode_ordinary(text), dtype="<u4").tobytes()

    def learn(self, words: list[str]) -> None:
        """Remember the ids of words, each opened by a space: one run over all of them, cut where their bytes end.
        Words with white space at an end cannot be encoded apart; they are remembered as None."""
        joined = " ".join(["", *words, ""])
        ids = np.array(self.base.encode_ordinary(joined[:-1]), dtype="<u4")
        stops = np.flatnonzero(np.frombuffer(joined.encode(), dtype=np.uint8) == 32)[1:]
        cuts = ((np.searchsorted(np.cumsum(self.sizes[ids]), stops) + 1) * 4).tolist()
        data = ids.tobytes()
        self.words.update(zip(words, [data[i:j] for i, j in zip([0, *cuts], cuts)]))

    def encode(self, texts: list[str]) -> list[bytes]:
        cut = [t.split(" ") for t in texts]
        fresh = set()
        for c in cut:
            fresh.update(c)
        missing = fresh.difference(self.words)
        if len(self.words) + len(missing) > self.most:
            self.words.clear()
            missing = fresh
        odd = [w for w in missing if not w or w[0].isspace() or w[-1].isspace()]
        self.words.update(dict.fromkeys(odd))
        if len(odd) < len(missing):
            self.learn(list(missing.difference(odd)))
        get, out = self.words.__getitem__, []
        for text, words in zip(texts, cut):
            known = [get(w) for w in words]
            if None in known or self.mark and self.mark.search(text):
                out.append(self.whole(text))
            else:
                known[0] = self.whole(words[0])
                out.append(b"".join(known))
        return out


def encoder(path: str) -> Encoder:
    return per_process(("packing", path), lambda: Encoder(path))


def sequence_sizes(tokens: int, capacity: int) -> np.ndarray:
    """Full sequences and, for the rest, those at its powers of two: together exactly `tokens`."""
    full, rest = divmod(tokens, capacity)
    powers = [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
    return np.array([capacity] * full + powers, dtype=np.int64)


def place(lengths: np.ndarray, capacity: int = CAPACITY, linear: float = LINEAR, quadratic: float = QUADRATIC):
    """Pieces (document index, start, length, sequence, offset) that hold every token of the documents once."""
    room = sequence_sizes(int(lengths.sum()), capacity)
    used = np.zeros(len(room), dtype=np.int64)
    cost = np.zeros(len(room))
    out = []

    def put(doc: int, start: int, length: int, seq: int) -> None:
        out.append((doc, start, length, seq, int(used[seq])))
        room[seq] -= length
        used[seq] += length
        cost[seq] += linear * length + quadratic * length * length

    waiting = []
    for doc, length in enumerate(lengths.tolist()):
        start = 0
        while start < length:
            size = min(capacity, length - start)
            waiting.append((size, doc, start))
            start += size
    for size, doc, start in sorted(waiting, key=lambda p: (-p[0], p[1], p[2])):
        fits = room >= size
        if fits.any():
            put(doc, start, size, int(np.where(fits, cost, np.inf).argmin()))
            continue
        while size:
            widest = room == room.max()
            seq = int(np.where(widest, cost, np.inf).argmin())
            part = min(size, int(room[seq]))
            put(doc, start, part, seq)
            start, size = start + part, size - part
    return out


def pack(
    docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, window: int = WINDOW,
    linear: float = LINEAR, quadratic: float = QUADRATIC,
) -> DataFrame:
    """One row per piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset. `capacity`: a power of two."""

    def run(batches):
        codes, part = encoder(tokenizer), TaskContext.get().partitionId()
        keys, ids, held, windows = [], [], 0, 0

        def packed():
            lengths = np.array([len(x) // 4 for x in ids], dtype=np.int64)
            rows = place(lengths, capacity, linear, quadratic)
            doc, start, length, seq, offset = (list(c) for c in zip(*rows))
            crc = [zlib.crc32(memoryview(ids[d])[4 * s : 4 * (s + n)]) for d, s, n in zip(doc, start, length)]
            base = (part << 40) + (windows << 20)
            columns = [
                pa.array([keys[d] for d in doc], pa.int64()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                pa.array(lengths[doc], pa.int64()), pa.array([base + s for s in seq], pa.int64()), pa.array(offset, pa.int64()),
            ]
            return pa.RecordBatch.from_arrays(columns, names=[key, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

        close = np.array([END_ID], dtype="<u4").tobytes()
        for batch in batches:
            some, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            for a, b in pieces(texts):
                for k, found in zip(some[a:b], codes.encode(texts[a:b])):
                    keys.append(k)
                    ids.append(found + close)
                    held += len(found) // 4 + 1
                    if held >= window:
                        yield packed()
                        keys, ids, held, windows = [], [], 0, windows + 1
        if keys:
            yield packed()

    rows = docs.select(F.col(key).cast("long").alias(key), F.col(text).cast("string").alias(text))
    schema = f"{key} long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return rows.mapInArrow(run, schema)
