"""SentencePiece encoding with seeded merge-dropout, and decoding.

Merge-type models join, again and again, the pair of neighbours whose joined piece has the best score. Here every
candidate merge is first put to a keyed hash of (seed, row id, the word's place in the row, its three bounds): below the
dropout rate it is skipped. So every occurrence of a word gets a segmentation of its own, and a repeated run the same ones.
A worker remembers the undropped segmentation of a word and the merges that were candidates on the way; an occurrence that
skips none of those takes it, the others are merged anew.

No piece holds a space behind another character, so text falls into independent words, each with the spaces before it.
The words of a batch are merged side by side in rounds, one merge per word and round; words of over LONG characters go
through a priority queue on their own. Both give the same pieces. Characters without a piece become their UTF-8 bytes;
the space mark itself, met in a text, too, so that every text decodes to itself.

NULL and empty texts have no ids and decode to the empty text, empty tables give no rows. Of merges of equal rank the
leftmost comes first. Rows of equal id and text get equal ids. Columns beside key and text are not read and not returned,
whatever they are called. Written for models with byte fallback, a leading space
mark and no normalisation.
"""

from __future__ import annotations

import heapq
import itertools
import re

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import per_process, pieces

DROPOUT, SEED = 0.1, 1
LONG = 96
#: Words that a worker remembers at most, but for those of one batch.
MEMORY = 600_000
SPACE = "▁"
WORDS = re.compile(" +[^ ]*")
NONE = np.int32(1 << 30)
#: Words are merged side by side with others that are up to as long.
WIDTHS = np.array([2, 4, 6, 8, 12, 16, 24, 48, LONG])
#: Characters of words that are merged side by side at once, and candidate merges that are hashed at once.
TOGETHER = 1 << 18


def mixed(x: np.ndarray) -> np.ndarray:
    """A well-mixed hash of unsigned 64-bit numbers."""
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def bounds_key(start: np.ndarray, middle: np.ndarray, end: np.ndarray) -> np.ndarray:
    return start.astype(np.uint64) << np.uint64(42) | middle.astype(np.uint64) << np.uint64(21) | end.astype(np.uint64)


class Model:
    """Pieces, ranks and joins of a merge-type model."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        plain = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        symbol = {model.id_to_piece(i): i for i in plain}
        score = {i: model.get_score(i) for i in plain}
        order = sorted(plain, key=lambda i: (-score[i], i))
        self.byte_id = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], dtype=np.int64)
        # letters that only occur inside pieces get numbers behind the pieces
        letters = sorted({c for p in symbol for c in p} - symbol.keys())
        number = symbol | {c: size + k for k, c in enumerate(letters)}
        self.size, self.base = size, size + len(letters) + 1
        self.other = self.base - 1
        self.of_char = np.full(0x110000, self.other, dtype=np.int32)
        for text, i in number.items():
            if len(text) == 1:
                self.of_char[ord(text)] = i
        self.of_char[ord(SPACE)] = self.other
        self.of_char[ord(" ")] = number[SPACE]
        self.rank = np.full(size, NONE, dtype=np.int32)
        self.rank[order] = np.arange(len(order))
        self.of_rank = np.array(order, dtype=np.int64)
        joins = {}
        for text, i in symbol.items():
            for cut in range(1, len(text)):
                a, b = number.get(text[:cut]), number.get(text[cut:])
                if a is not None and b is not None:
                    joins[a * self.base + b] = i
        self.bits = max(4, (4 * len(joins)).bit_length())
        keys, found = np.full(1 << self.bits, -1, dtype=np.int64), np.zeros(1 << self.bits, dtype=np.int32)
        last = (1 << self.bits) - 1
        for key, i in joins.items():
            at = int(self.slot(np.array([key], dtype=np.int64))[0])
            while keys[at] >= 0:
                at = at + 1 & last
            keys[at], found[at] = key, i
        self.keys, self.found = keys, found
        self.text = [bytes([int(m[3:5], 16)]) if model.is_byte(i) else m.replace(SPACE, " ").encode() for i in range(size) for m in [model.id_to_piece(i)]]

    def slot(self, key: np.ndarray) -> np.ndarray:
        return (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def join(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Piece of each pair, -1 where there is none."""
        key = left.astype(np.int64) * self.base + right
        at = self.slot(key)
        out = np.where(self.keys[at] == key, self.found[at], -1)
        open_ = np.flatnonzero((self.keys[at] != key) & (self.keys[at] >= 0))
        while len(open_):
            at[open_] = at[open_] + 1 & (1 << self.bits) - 1
            met = self.keys[at[open_]]
            hit = met == key[open_]
            out[open_[hit]] = self.found[at[open_[hit]]]
            open_ = open_[~hit & (met >= 0)]
        return out

    def candidates(self, left, right, start, middle, end, key, limit) -> np.ndarray:
        """Rank of the merge of each pair; NONE where it does not exist or is skipped."""
        piece = self.join(left, right)
        rank = np.where(piece >= 0, self.rank[piece], NONE)
        if limit:
            rank[mixed(key ^ mixed(bounds_key(start, middle, end))) < limit] = NONE
        return rank


def model(path: str) -> Model:
    return per_process(("merges", path), lambda: Model(path))


def queued(m: Model, symbols: np.ndarray, key: int, limit: int) -> tuple[list[int], list[int]]:
    """Merges of one word by a priority queue: symbols and their starts."""
    n = len(symbols)
    sym, start, end = symbols.tolist(), list(range(n)), list(range(1, n + 1))
    before, after, queue = list(range(-1, n - 1)), [*range(1, n), -1], []
    keys = np.array([key], dtype=np.uint64)

    def offer(lefts: list[int]) -> None:
        rights = [after[i] for i in lefts]
        a, b = np.array([sym[i] for i in lefts]), np.array([sym[i] for i in rights])
        s, mid, e = (np.array(x) for x in ([start[i] for i in lefts], [start[j] for j in rights], [end[j] for j in rights]))
        for i, j, rank in zip(lefts, rights, m.candidates(a, b, s, mid, e, keys, np.uint64(limit)).tolist()):
            if rank < NONE:
                heapq.heappush(queue, (rank, start[i], i, sym[i], sym[j], end[j]))

    if n > 1:
        offer(list(range(n - 1)))
    while queue:
        _, _, i, left, right, stop = heapq.heappop(queue)
        j = after[i]
        if sym[i] != left or j < 0 or sym[j] != right or end[j] != stop:
            continue
        sym[i], end[i], sym[j] = int(m.join(np.array([left]), np.array([right]))[0]), stop, -2
        after[i] = after[j]
        if after[j] >= 0:
            before[after[j]] = i
        offer([k for k in (before[i], i) if k >= 0 and after[k] >= 0])
    alive = [k for k in range(n) if sym[k] != -2]
    return [sym[k] for k in alive], [start[k] for k in alive]


def side_by_side(m: Model, symbols: np.ndarray, counts: np.ndarray, key: np.ndarray, limit: int, seen: list | None = None):
    """Merges of many words in rounds. Returns word, start and symbol of all that is left, ordered by word and start.
    `seen` gets word and bounds of every candidate merge that was not skipped."""
    first, kind = np.cumsum(counts) - counts, np.searchsorted(WIDTHS, counts)
    groups, amount = [], np.zeros(len(counts), dtype=np.int64)
    for width in np.unique(kind).tolist():
        which, met = np.flatnonzero(kind == width), None if seen is None else []
        chars = symbols[spread(first[which], counts[which])]
        row, start, sym = rounds(m, chars, counts[which], int(WIDTHS[width]), key[which], np.uint64(limit), met)
        groups.append((which, start, sym))
        amount[which] = np.bincount(row, minlength=len(which))
        if seen is not None:
            seen += [(which[w], bounds) for w, bounds in met]
    starts, syms = np.empty((2, amount.sum()), dtype=np.int64)
    first = np.cumsum(amount) - amount
    for which, start, sym in groups:
        at = spread(first[which], amount[which])
        starts[at], syms[at] = start, sym
    return np.repeat(np.arange(len(counts)), amount), starts, syms


def rounds(m: Model, symbols: np.ndarray, counts: np.ndarray, width: int, key: np.ndarray, limit: np.uint64, seen: list | None):
    """Merges of words of up to `width` characters, one row of a table each; in every round each word merges its best pair.
    What is left, as word, start and symbol. Symbols know their neighbours by place, so nothing moves when two are joined."""
    n = len(counts)
    column = np.arange(width)
    place = np.arange(n * width)
    inside = (column < counts[:, None]).ravel()
    sym = np.full(n * width, -1, dtype=np.int64)
    sym[inside] = symbols
    end = np.tile(column + 1, n)
    after = np.where((column + 1 < counts[:, None]).ravel(), place + 1, -1)
    before = np.where(np.tile(column > 0, n), place - 1, -1)
    rank = np.full(n * width, NONE, dtype=np.int32)
    table = rank.reshape(n, width)

    def offer(at):
        nxt, word = after[at], at // width
        head = word * width
        start, middle = at - head, nxt - head
        rank[at] = found = m.candidates(sym[at], sym[nxt], start, middle, end[nxt], key[word], limit)
        if seen is not None:
            real = found < NONE
            seen.append((word[real], bounds_key(start[real], middle[real], end[nxt[real]])))

    offer(np.flatnonzero(after >= 0))
    active = np.arange(n)
    while len(active):
        part = table if len(active) == n else table[active]
        # the least rank, of equal ones the leftmost
        at = part.argmin(axis=1) + active * width
        live = rank[at] < NONE
        active, at = active[live], at[live]
        nxt = after[at]
        sym[at], sym[nxt] = m.of_rank[rank[at]], -1
        rank[nxt], end[at] = NONE, end[nxt]
        after[at] = beyond = after[nxt]
        more = beyond >= 0
        before[beyond[more]] = at[more]
        rank[at[~more]] = NONE
        left = before[at]
        offer(np.concatenate((at[more], left[left >= 0])))
    kept = np.flatnonzero(sym >= 0)
    return kept // width, kept % width, sym[kept]


def characters(words: list[str]) -> np.ndarray:
    """Code points of all words, joined."""
    return np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4")


def segment(m: Model, words: list[str], key: np.ndarray, limit: int, seen: list | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words, joined, and how many each has."""
    return segmented(m, characters(words), np.array([len(w) for w in words], dtype=np.int64), key, limit, seen)


def segmented(m: Model, chars: np.ndarray, counts: np.ndarray, key: np.ndarray, limit: int, seen: list | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words (their code points, joined, and lengths), joined, and how many each has. `seen` gets the candidate
    merges of words of up to LONG characters."""
    first = np.cumsum(counts) - counts
    long = counts > LONG
    symbols = m.of_char[chars].astype(np.int64)
    short = ~np.repeat(long, counts)
    word, start, sym = side_by_side(m, symbols[short], counts[~long], key[~long], limit, seen)
    word = np.flatnonzero(~long)[word]
    if seen is not None:
        seen[:] = [(np.flatnonzero(~long)[w], bounds) for w, bounds in seen]
    if long.any():
        parts = [(word, start, sym)]
        for w in np.flatnonzero(long).tolist():
            s, at = queued(m, symbols[first[w] : first[w] + counts[w]], int(key[w]), limit)
            parts.append((np.full(len(s), w), np.array(at, dtype=np.int64), np.array(s, dtype=np.int64)))
        word, start, sym = (np.concatenate(p) for p in zip(*parts))
        order = np.lexsort((start, word))
        word, start, sym = word[order], start[order], sym[order]
    # letters without a piece: one id per byte of their UTF-8 form
    plain = sym < m.size
    if plain.all():
        return sym, np.bincount(word, minlength=len(counts))
    char = chars[first[word] + start]
    width = np.where(plain, 1, 1 + (char >= 0x80) + (char >= 0x800) + (char >= 0x10000))
    ids = np.repeat(sym, width)
    lies = np.cumsum(width) - width
    for k in np.flatnonzero(~plain).tolist():
        raw = chr(char[k]).encode()
        ids[lies[k] : lies[k] + len(raw)] = m.byte_id[list(raw)]
    return ids, np.bincount(word, weights=width, minlength=len(counts)).astype(np.int64)


class Numbers(dict):
    """Words numbered in the order in which they are first asked for."""

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number


def spread(place: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers place, place + 1, ... of every entry, joined."""
    total = np.cumsum(count)
    return np.arange(int(total[-1]) if len(total) else 0) + np.repeat(place - total + count, count)


def slices(amount: np.ndarray, most: int):
    """Ranges of entries of about `most` in all."""
    total = np.cumsum(amount)
    start = 0
    while start < len(amount):
        end = max(start + 1, int(np.searchsorted(total, (total[start - 1] if start else 0) + most, "right")))
        yield start, end
        start = end


class Pool:
    """Growing array of which entries are named by place and count."""

    def __init__(self, kind):
        self.rows, self.filled = np.empty(1 << 16, dtype=kind), 0
        self.place, self.count = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)

    def add(self, values: np.ndarray, counts: np.ndarray) -> None:
        self.put(values)
        self.place = np.concatenate((self.place, self.filled + np.cumsum(counts) - counts))
        self.count = np.concatenate((self.count, counts))
        self.filled += len(values)

    def put(self, values: np.ndarray) -> None:
        """Values behind the filled part, where the next ones overwrite them."""
        if self.filled + len(values) > len(self.rows):
            self.rows = np.concatenate((self.rows[: self.filled], np.empty(self.filled + 2 * len(values), dtype=self.rows.dtype)))
        self.rows[self.filled : self.filled + len(values)] = values


class Segmenter:
    """Segments texts; remembers the undropped ids and candidate merges of words until MEMORY words are known."""

    def __init__(self, m: Model, dropout: float = DROPOUT, seed: int = SEED):
        self.model = m
        self.limit = min(int(dropout * 2.0**64), (1 << 64) - 1)
        self.salt = mixed(np.array([seed & (1 << 64) - 1], dtype=np.uint64))
        self.forget()

    def forget(self) -> None:
        self.numbers, self.chars = Numbers(), Pool(np.uint32)
        self.ids, self.merges = Pool(np.int32), Pool(np.uint64)

    def learn(self, words: list[str]) -> None:
        """Undropped segmentations of new words, and the hashed bounds of their candidate merges."""
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        for a, b in slices(lengths, TOGETHER):
            seen: list = []
            chars = characters(words[a:b])
            self.chars.add(chars, lengths[a:b])
            ids, counts = segmented(self.model, chars, lengths[a:b], np.zeros(b - a, dtype=np.uint64), 0, seen)
            self.ids.add(ids, counts)
            if self.limit:
                word, bounds = (np.concatenate(c) for c in zip(*seen)) if seen else (np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64))
                order = np.argsort(word, kind="stable")
                self.merges.add(mixed(bounds[order]), np.bincount(word, minlength=b - a))

    def dropped(self, every: np.ndarray, key: np.ndarray) -> np.ndarray:
        """Whether an occurrence (word number, key) skips a merge; words of over LONG characters count as if they did."""
        out = np.zeros(len(every), dtype=bool)
        count = self.merges.count[every]
        for a, b in slices(count, TOGETHER):
            own = count[a:b]
            drop = mixed(np.repeat(key[a:b], own) ^ self.merges.rows[spread(self.merges.place[every[a:b]], own)]) < np.uint64(self.limit)
            out[a:b][np.repeat(np.arange(b - a), own)[drop]] = True
        return out

    def encode(self, texts: list[str], row_ids: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, joined, and how many each has."""
        if len(self.numbers) > MEMORY:
            self.forget()
        number, found, known = self.numbers.__getitem__, [], len(self.numbers)
        cut = [WORDS.findall(" " + text) if text else [] for text in texts]
        for words in cut:
            found += map(number, words)
        self.learn(list(itertools.islice(self.numbers, known, None)))
        sizes = np.array([len(c) for c in cut], dtype=np.int64)
        every = np.array(found, dtype=np.int64)
        place, amount = self.ids.place[every], self.ids.count[every]
        if self.limit:
            rows = mixed(self.salt ^ np.array([r & (1 << 64) - 1 for r in row_ids], dtype=np.uint64))
            at = np.arange(len(every)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            key = mixed(np.repeat(rows, sizes) + at.astype(np.uint64))
            lengths = self.chars.count[every]
            anew = np.flatnonzero(self.dropped(every, key) | (lengths > LONG))
            parts = [np.empty(0, dtype=np.int64)]
            for a, b in slices(lengths[anew], TOGETHER):
                which = anew[a:b]
                chars = self.chars.rows[spread(self.chars.place[every[which]], lengths[which])]
                ids, amount[which] = segmented(self.model, chars, lengths[which], key[which], self.limit)
                parts.append(ids)
            self.ids.put(np.concatenate(parts))
            place[anew] = self.ids.filled + np.cumsum(amount[anew]) - amount[anew]
        ends = np.concatenate(([0], np.cumsum(amount)))[np.cumsum(sizes)] if len(texts) else np.empty(0, dtype=np.int64)
        return self.ids.rows[spread(place, amount)], np.diff(np.concatenate(([0], ends)))


def encode(m: Model, texts: list[str], row_ids: list[int], dropout: float = DROPOUT, seed: int = SEED):
    """Ids of all texts, joined, and how many each has."""
    return Segmenter(m, dropout, seed).encode(texts, row_ids)


def decode(m: Model, ids: list[int]) -> str:
    """Text of ids; the leading space of the encoding goes."""
    raw = b"".join(map(m.text.__getitem__, ids))
    return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "replace")


def encoded(
    docs: DataFrame, model_path: str, key: str = "doc_id", text: str = "text", dropout: float = DROPOUT, seed: int = SEED,
) -> DataFrame:
    """Columns key, ids, n_ids, lossless (the ids decode to the very text). A NULL key is encoded like id 0."""

    def run(batches):
        m = model(model_path)
        worker = per_process(("segmenter", model_path, dropout, seed), lambda: Segmenter(m, dropout, seed))
        for batch in batches:
            keys, texts = batch.column(0), [t or "" for t in batch.column(1).to_pylist()]
            rows = [k or 0 for k in keys.to_pylist()]
            for a, b in pieces(texts):
                ids, counts = worker.encode(texts[a:b], rows[a:b])
                ends = np.cumsum(counts)
                whole = ids.tolist()
                right = [decode(m, whole[e - c : e]) == t for t, c, e in zip(texts[a:b], counts.tolist(), ends.tolist())]
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([keys[a:b], lists, pa.array(counts, pa.int64()), pa.array(right)], names=[key, "ids", "n_ids", "lossless"])

    rows = docs.select(F.col(key).cast("long").alias(key), F.col(text).cast("string").alias(text))
    return rows.mapInArrow(run, f"{key} long, ids array<int>, n_ids long, lossless boolean")


def decoded(rows: DataFrame, model_path: str, ids: str = "ids", into: str = "text") -> DataFrame:
    """All columns with the text of the ids; NULL ids give NULL."""

    @F.pandas_udf("string")
    def run(lists):
        m = model(model_path)
        return lists.map(lambda x: None if x is None else decode(m, list(x)))

    return rows.withColumn(into, run(F.col(ids)))
