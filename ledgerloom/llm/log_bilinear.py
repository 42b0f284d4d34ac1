"""Log-bilinear language model, trained with noise-contrastive estimation.

Units. Every word has a unit: the VOCABULARY most frequent words each have their own, all further words share the unit of
their ending (a hash of the last two bytes, CLASSES units). The probability of a word is that of its unit, given the units of
the two words before it, times the word's smoothed share of its unit: (c + 1) / (n + v + 1) with c the word's count, n and v
the counted and the distinct words of the unit, so one place is left for a word never counted. Own units have the share 1.

Model. A unit u after the units a, b has the score (first[a] + second[b]) . next[u] + bias[u]: bilinear in the logarithm.
Training never sums over all units: each batch of words is told from NOISE units drawn by their counts, whose scores come
from one matrix product with all contexts of the batch. Afterwards a Spark job takes the sums over all units after every pair
of context units, again as matrix products, block by block: with them every score is a normalised log-probability.

Corpus. Counts come from all training rows. One task takes the first steps on about SAMPLE rows, so that all tasks start from
the same directions. Then every task goes on from there over all training rows of its own share of the table, and the tasks'
models are averaged row by row, weighted by the words that each row was trained on: what is gathered grows with the table, the
model does not.

Words of a share of at least 1 in DICTIONARY of all tokens (so at most DICTIONARY words, of at most WORD_BYTES bytes) are sent
to the tasks with their counts; the counts of all others meet the texts in a join.

NULL texts count as empty: one end token. Rows of NULL id belong to the training fold and have their row in the result, as has
every repeated row. Without training rows every count is zero and all units are alike. Empty tables give no rows; further
columns of the documents are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import crc_fold, pieces, written
from ledgerloom.operators.spread import spread_nulls

#: Units of frequent words, units of word endings, numbers of a unit's vector.
VOCABULARY, CLASSES, WIDTH = 2000, 256, 23
#: A word of at least this share of all tokens (1 in so many) and at most so many bytes is sent to the tasks.
DICTIONARY, WORD_BYTES = 1 << 20, 32
#: Training: noise units and words of a batch, step.
NOISE, BATCH, STEP = 48, 1024, 0.05
#: Rows that the first task learns from, about; all rows follow.
SAMPLE = 4000
#: Words that a task counts before it hands them on.
HELD_WORDS = 200_000
#: First units whose contexts' sums one task works out.
CONTEXT_BLOCK = 256
#: The end of a text; no word holds white space.
END = b"\n"


def words_of(text: str | None) -> list[bytes]:
    """Words of a text, A-Z lower-cased, and the end."""
    words = (text or "").encode().lower().split()
    words.append(END)
    return words


def ending(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % CLASSES


def word_counts(texts: DataFrame) -> DataFrame:
    """Columns word, times over the column text. Tasks hand on sums of bounded numbers of words."""

    def run(batches: Iterator[pa.RecordBatch]):
        held: Counter = Counter()
        for batch in batches:
            for value in batch.column(0):
                held.update(words_of(value.as_py()))
                if len(held) > HELD_WORDS:
                    yield pack(held)
                    held.clear()
        yield pack(held)

    def pack(held: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "times"])

    return texts.mapInArrow(run, "word string, times long").groupBy("word").agg(F.sum("times").alias("times"))


@dataclass
class Vocabulary:
    """What the tasks know of the words: counts of the frequent ones, sums of the units."""

    words: list[bytes]
    times: np.ndarray
    unit: np.ndarray
    own: int
    unit_times: np.ndarray  # counted words of each unit
    unit_words: np.ndarray  # distinct words of each unit
    tokens: int
    distinct: int

    @property
    def units(self) -> int:
        return self.own + CLASSES

    def base_divisor(self) -> float:
        return np.log10(float(self.tokens + self.distinct + 1))

    def share_divisor(self) -> np.ndarray:
        """Logarithm of the divisor of a word's share of its unit."""
        return np.log10(np.where(np.arange(self.units) < self.own, 1.0, self.unit_times + self.unit_words + 1.0))

    def shares(self) -> np.ndarray:
        """log10 of each dictionary word's share of its unit."""
        return np.where(self.unit < self.own, 0.0, np.log10(self.times + 1.0) - self.share_divisor()[self.unit])


def _often(tokens: int) -> Column:
    """At most DICTIONARY words can have such a share of all tokens, each of at most WORD_BYTES bytes."""
    return (F.col("times") >= F.lit(tokens / DICTIONARY)) & (F.octet_length("word") <= WORD_BYTES)


def vocabulary(counts: DataFrame, size: int = VOCABULARY) -> Vocabulary:
    tokens, distinct = counts.agg(F.coalesce(F.sum("times"), F.lit(0)), F.count("*")).first()
    table = counts.where(_often(tokens)).toPandas()
    known = sorted(zip((-table["times"]).tolist(), (w.encode() for w in table["word"])))
    words, times = [w for _, w in known], np.array([-n for n, _ in known], dtype=np.int64)
    own = min(size, len(words))
    unit = np.array([k if k < own else own + ending(w) for k, w in enumerate(words)], dtype=np.int64)
    # sums of the endings over all words, less the words that have their own unit
    tail = F.substring(F.col("word").cast("binary"), -2, 2)
    sums = counts.groupBy((F.crc32(tail) % F.lit(CLASSES)).alias("ending")).agg(F.sum("times").alias("times"), F.count("*").alias("words")).collect()
    unit_times, unit_words = np.zeros(own + CLASSES, dtype=np.int64), np.zeros(own + CLASSES, dtype=np.int64)
    for row in sums:
        unit_times[own + row["ending"]], unit_words[own + row["ending"]] = row["times"], row["words"]
    for k in range(own):
        unit_times[own + ending(words[k])] -= times[k]
        unit_words[own + ending(words[k])] -= 1
    unit_times[:own], unit_words[:own] = times[:own], 1
    return Vocabulary(words, times, unit, own, unit_times, unit_words, int(tokens), int(distinct))


@dataclass
class Weights:
    """One row of numbers per unit and role: as last word but one, as last word, as the word that follows. In the first two
    roles a further row stands for the place before a text. The last number of a following unit is its bias; it meets the
    fixed last number of the context, 0 + 1. `seen` holds the sums of squares that shorten the training steps."""

    table: np.ndarray
    seen: np.ndarray

    @property
    def units(self) -> int:
        return (len(self.table) - 2) // 3

    def context(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return self.table[a] + self.table[self.units + 1 + b]

    def following(self, unit: np.ndarray) -> np.ndarray:
        return self.table[2 * self.units + 2 + unit]


def initial(vocab: Vocabulary, seed: int = 11) -> Weights:
    """Vectors near zero and the logarithm of the units' smoothed shares as bias: a unigram model."""
    n = vocab.units
    table = np.random.default_rng(seed).normal(0, 0.1, (3 * n + 2, WIDTH + 1)).astype(np.float32)
    table[: n + 1, -1], table[n + 1 : 2 * n + 2, -1], table[2 * n + 2 :, -1] = 0, 1, np.log(noise_shares(vocab))
    return Weights(table, np.full(table.shape, 1e-4, dtype=np.float32))


def noise_shares(vocab: Vocabulary) -> np.ndarray:
    return (vocab.unit_times + 1.0) / (vocab.unit_times.sum() + vocab.units)


class Trainer:
    """Noise-contrastive steps on batches of (context, unit); adaptive step size per number."""

    def __init__(self, weights: Weights, shares: np.ndarray, seed: int):
        self.weights = Weights(weights.table.copy(), weights.seen.copy())
        self.log_noise = np.log(NOISE * shares).astype(np.float32)
        self.edges = np.cumsum(shares)
        self.draw = np.random.default_rng(seed)

    def step(self, a: np.ndarray, b: np.ndarray, unit: np.ndarray) -> None:
        w, n = self.weights, self.weights.units
        noise = np.minimum(np.searchsorted(self.edges, self.draw.random(NOISE)), n - 1)
        context, right, wrong = w.context(a, b), w.following(unit), w.following(noise)
        # how far each word, and each noise unit after each context, is still from its side
        up = 1 / (1 + np.exp(np.clip((context * right).sum(axis=1) - self.log_noise[unit], -30, 30)))
        down = -1 / (1 + np.exp(np.clip(self.log_noise[noise] - context @ wrong.T, -30, 30)))
        to_context = up[:, None] * right + down @ wrong
        to_context[:, -1] = 0
        rows = np.concatenate((a, n + 1 + b, 2 * n + 2 + unit, 2 * n + 2 + noise))
        slopes = np.concatenate((to_context, to_context, up[:, None] * context, down.T @ context))
        # sums by row; the order of short numbers takes linear time
        order = np.argsort(rows.astype(np.uint16) if len(w.table) < 1 << 16 else rows, kind="stable")
        rows = rows[order]
        first = np.flatnonzero(np.concatenate(([True], rows[1:] != rows[:-1])))
        rows, slope = rows[first], np.add.reduceat(slopes[order], first, axis=0)
        w.seen[rows] += slope * slope
        w.table[rows] += STEP * slope / np.sqrt(w.seen[rows])

    def learn(self, a: np.ndarray, b: np.ndarray, unit: np.ndarray) -> None:
        order = self.draw.permutation(len(unit))
        for k in range(0, len(unit), BATCH):
            some = order[k : k + BATCH]
            self.step(a[some], b[some], unit[some])


def contexts(unit: np.ndarray, lengths: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """Units two places and one place before every word of the texts laid end to end; `start` before a text."""
    first = np.cumsum(lengths) - lengths
    one = np.concatenate(([start], unit[:-1]))
    two = np.concatenate(([start, start], unit[:-2]))[: len(unit)]
    one[first] = start
    two[first] = start
    late = first[lengths > 1] + 1
    two[late] = start
    return two, one


def trained(texts: DataFrame, vocab: Vocabulary, weights: Weights, seed: int) -> Weights:
    """Average of the models that the tasks reach on their shares of the texts, row by row."""
    n = vocab.units
    shared = texts.sparkSession.sparkContext.broadcast((vocab.words, vocab.unit, vocab.own, noise_shares(vocab), weights.table, weights.seen))
    names = [f"{kind}{k}" for kind in ("v", "s") for k in range(WIDTH + 1)]
    out = pa.schema([("row", pa.int64()), ("share", pa.float64()), *[(c, pa.float64()) for c in names]])

    def run(batches: Iterator[pa.RecordBatch]):
        words, units, own, shares, *start = shared.value
        number = dict(zip(words, units.tolist())).get
        trainer, met = Trainer(Weights(*start), shares, seed), np.zeros(3 * n + 2)
        for batch in batches:
            column = batch.column(0).to_pylist()
            for x, y in pieces([t or "" for t in column]):
                unit, lengths = [], []
                for text in column[x:y]:
                    found = words_of(text)
                    unit += [own + ending(w) if u is None else u for w, u in zip(found, map(number, found))]
                    lengths.append(len(found))
                unit = np.array(unit, dtype=np.int64)
                a, b = contexts(unit, np.array(lengths, dtype=np.int64), n)
                trainer.learn(a, b, unit)
                for offset, rows in ((0, a), (n + 1, b), (2 * n + 2, unit)):
                    met += np.bincount(offset + rows, minlength=len(met))
        # a row counts by the words that it was trained on; rows never met hardly count
        share = met + 1e-3
        values = np.hstack([trainer.weights.table, trainer.weights.seen]) * share[:, None]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(share))), pa.array(share), *map(pa.array, values.T)], schema=out)

    found = texts.mapInArrow(run, "row long, " + ", ".join(f"{c} double" for c in out.names[1:]))
    # as many rows as the model has, whatever the corpus
    sums = found.groupBy("row").agg(F.sum("share").alias("share"), *[F.sum(c).alias(c) for c in names]).toPandas()
    mean = (sums[names].to_numpy() / sums[["share"]].to_numpy()).astype(np.float32)
    table, seen, rows = weights.table.copy(), weights.seen.copy(), sums["row"].to_numpy()
    table[rows], seen[rows] = mean[:, : WIDTH + 1], mean[:, WIDTH + 1 :]
    return Weights(table, seen)


def log_sums(weights: Weights, first: np.ndarray) -> np.ndarray:
    """Logarithm of the sum over all units after the contexts (first[k], b), for every second unit b.

    The exponential of a sum of two scores is a product, so the sums of all contexts are one matrix product."""
    n = weights.units
    target = weights.table[2 * n + 2 :].astype(np.float64).T
    parts = [weights.table[rows].astype(np.float64) @ target for rows in (first, slice(n + 1, 2 * n + 2))]
    tops = [p.max(axis=1, keepdims=True) for p in parts]
    left, right = (np.exp(p - t) for p, t in zip(parts, tops))
    return np.log(left @ right.T) + tops[0] + tops[1].T


def normalisers(spark: SparkSession, weights: Weights) -> np.ndarray:
    """log_sums of every pair of context units, one row per first unit. Fixed size: the square of the units."""
    n = weights.units
    shared = spark.sparkContext.broadcast((weights.table, weights.seen))

    def run(batches: Iterator[pa.RecordBatch]):
        held = Weights(*shared.value)
        for batch in batches:
            rows = batch.column(0).to_numpy()
            sums = [r.tobytes() for r in log_sums(held, rows).astype("<f4")]
            yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(sums, pa.binary())], ["id", "sums"])

    rows = spark.range(0, n + 1, 1, -(-(n + 1) // CONTEXT_BLOCK))
    found = np.empty((n + 1, n + 1), dtype=np.float32)
    for row, sums in rows.mapInArrow(run, "id long, sums binary").collect():
        found[row] = np.frombuffer(sums, dtype="<f4")
    return found


@dataclass
class Model:
    counts: DataFrame  # word, times: all training words
    vocab: Vocabulary
    weights: Weights
    sums: np.ndarray


def fitted(docs: DataFrame, fold: Column, key: str = "doc_id", text: str = "text", size: int = VOCABULARY, sample: int = SAMPLE) -> Model:
    """Model of all rows outside the held-out fold (`fold` is true there)."""
    training = docs.where(~fold).select(F.col(text).cast("string").alias("text"), F.pmod(F.xxhash64(key), F.lit(1 << 30)).alias("place"))
    counts = written(word_counts(training.select("text")))
    vocab = vocabulary(counts, size)
    # one task gives the vectors their directions, on about `sample` rows
    rows = max(1, int(counts.where(F.col("word") == END.decode()).agg(F.sum("times")).first()[0] or 0))
    few = training.where(F.col("place") < F.lit(int(min(1.0, sample / rows) * (1 << 30)))).select("text")
    weights = trained(few.repartition(1), vocab, initial(vocab), seed=100)
    weights = trained(training.select("text"), vocab, weights, seed=101)
    return Model(counts, vocab, weights, normalisers(docs.sparkSession, weights))


def scored(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Columns _row, key, n_tokens, n_known, base_score, score of every row (log10 of the probabilities of the text)."""
    vocab, spark = model.vocab, docs.sparkSession
    known = (vocab.words, vocab.unit, vocab.own, np.log10(vocab.times + 1.0) - vocab.base_divisor(), vocab.shares(), vocab.share_divisor(), vocab.base_divisor())
    shared = spark.sparkContext.broadcast((known, (model.weights.table, model.weights.seen), model.sums))
    out = pa.schema([("row", pa.int64()), ("key", pa.int64()), ("word", pa.string()), ("times", pa.int64()), ("tokens", pa.int64()), ("known", pa.int64()), ("base", pa.float64()), ("own", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]):
        (words, units, own, base, share, divisor, base_divisor), tables, sums = shared.value
        weights = Weights(*tables)
        number, n = dict(zip(words, range(len(words)))).get, len(divisor)
        # one entry more for the words outside the dictionary
        units, base, share = np.append(units, -1), np.append(base, -base_divisor), np.append(share, 0.0)
        for batch in batches:
            rows, keys, column = (c.to_pylist() for c in batch.columns)
            for x, y in pieces([t or "" for t in column]):
                places, lengths, rare, rare_units = [], [], [], []
                for k, text_ in enumerate(column[x:y]):
                    found = words_of(text_)
                    mine = list(map(number, found, repeat(len(words))))
                    unknown = [w for w, p in zip(found, mine) if p == len(words)]
                    rare_units += [own + ending(w) for w in unknown]
                    rare += [(rows[x + k], w, c) for w, c in Counter(unknown).items()]
                    places += mine
                    lengths.append(len(mine))
                place, length = np.array(places, dtype=np.int64), np.array(lengths, dtype=np.int64)
                unit, part = units[place], share[place]
                outside = place == len(words)
                unit[outside] = rare_units
                part[outside] = -divisor[unit[outside]]
                a, b = contexts(unit, length, n)
                score = (weights.context(a, b) * weights.following(unit)).sum(axis=1) - sums[a, b]
                first = np.cumsum(length) - length
                heads = [
                    pa.array(rows[x:y], pa.int64()), pa.array(keys[x:y], pa.int64()), pa.nulls(y - x, pa.string()), pa.nulls(y - x, pa.int64()), pa.array(length),
                    pa.array(np.add.reduceat((~outside).astype(np.int64), first)), pa.array(np.add.reduceat(base[place], first)),
                    pa.array(np.add.reduceat(score.astype(np.float64) / np.log(10) + part, first)),
                ]
                yield pa.RecordBatch.from_arrays(heads, schema=out)
                if rare:
                    r, w, c = zip(*rare)
                    none = [pa.nulls(len(rare), f.type) for f in list(out)[4:]]
                    yield pa.RecordBatch.from_arrays([pa.array(r, pa.int64()), pa.nulls(len(rare), pa.int64()), pa.array(w, pa.string()), pa.array(c, pa.int64()), *none], schema=out)

    source = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    parts = source.mapInArrow(run, "row long, key long, word string, times long, tokens long, known long, base double, own double")
    # a row of sums per text and one per rare word of it: words that were counted get their count, the others have none
    rare = model.counts.where(~_often(vocab.tokens)).select(F.col("word").alias("_word"), F.col("times").alias("_count"))
    met = spread_nulls(parts, "word", "_word").drop("word").join(rare, "_word", "left")
    more = F.col("times") * F.log10(F.coalesce("_count", F.lit(0)) + F.lit(1.0))
    sums = met.groupBy("row").agg(
        F.max("key").alias(key),
        F.sum("tokens").alias("n_tokens"),
        (F.sum("known") + F.coalesce(F.sum(F.when(F.col("_count").isNotNull(), F.col("times"))), F.lit(0))).alias("n_known"),
        (F.sum("base") + F.coalesce(F.sum(more), F.lit(0.0))).alias("base_score"),
        (F.sum("own") + F.coalesce(F.sum(more), F.lit(0.0))).alias("score"),
    )
    return sums.withColumnRenamed("row", "_row")


def held_out(key: str = "doc_id", folds: int = 7, fold: int = 2) -> Column:
    return F.coalesce(crc_fold(key, folds) == fold, F.lit(False))
