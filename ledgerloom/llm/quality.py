"""Quality classifier: a factorisation machine.

Inputs of a text are hashed words (weighted by the logarithm of their count, scaled to length one), structure
statistics cut into steps, and metadata (length in characters and words). The score is a logistic function of a bias,
a weight per input and the low-rank products of all pairs of inputs; the sum over pairs is half of (square of the sum
less sum of the squares) of the inputs' factors, so it takes linear time.

It learns from labelled rows outside the held-out fold: the SAMPLE rows of smallest hash, a documented bound on the
training work. One task trains on their features, which are a few numbers per word; the model (a few megabytes, whatever
the corpus) is sent to all executors. NULL text counts as empty and gets a score like any other.
"""

from __future__ import annotations

import math
import pickle
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import crc_fold, written

#: Labelled rows that the model learns from at most.
SAMPLE = 6000
#: Buckets of hashed words, rank of the factors.
WORD_BUCKETS, RANK = 1 << 14, 6
EPOCHS, RATE, DECAY = 6, 0.08, 1e-5
#: A row is accepted from this score on.
ACCEPT = 0.3
STEPS = 12
#: Structure statistics, each with the value at which its steps end (fixed values).
STATISTICS = {
    "letters": 1.0, "capitals": 1.0, "digits": 0.5, "spaces": 0.5, "marks": 0.5, "symbols": 0.3, "bars": 0.3, "lines": 0.1,
    "repeats": 1.0, "distinct": 1.0, "common": 1.0, "word_length": 16.0, "sentence": 0.5, "line_repeats": 1.0, "marked_words": 1.0,
    "characters": 20.0, "words": 16.0,
}
BYTES = np.arange(256)
LOWER, UPPER, DIGIT = (BYTES >= 97) & (BYTES <= 122), (BYTES >= 65) & (BYTES <= 90), (BYTES >= 48) & (BYTES <= 57)
WHITE = np.isin(BYTES, [9, 10, 11, 12, 13, 32])
MARKS = np.isin(BYTES, list(b".,;:!?'\"()-"))
BAR, NEWLINE = 124, 10


def statistics(data: bytes, words: list[bytes], counts: Counter) -> dict[str, float]:
    """Structure of a text; shares of its bytes, words or lines."""
    hits = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    size, n = max(1, len(data)), max(1, len(words))
    letters, capitals = int(hits[LOWER].sum() + hits[UPPER].sum() + hits[128:].sum()), int(hits[UPPER].sum())
    marks, digits, white = int(hits[MARKS].sum()), int(hits[DIGIT].sum()), int(hits[WHITE].sum())
    symbols = len(data) - letters - marks - digits - white
    lines = [x for x in data.split(b"\n") if x.strip()]
    return {
        "letters": letters / size, "capitals": capitals / max(1, letters), "digits": digits / size, "spaces": white / size,
        "marks": marks / size, "symbols": symbols / size, "bars": int(hits[BAR]) / n, "lines": int(hits[NEWLINE]) / n,
        "repeats": sum(map(bytes.__eq__, words, words[1:])) / n, "distinct": len(counts) / n,
        "common": max(counts.values(), default=0) / n, "word_length": letters / n, "sentence": int(hits[46]) / n,
        "line_repeats": 1 - len(set(lines)) / max(1, len(lines)),
        "marked_words": sum(1 for w in words if not 97 <= w[-1] | 32 <= 122 and w[-1] < 128) / n,
        "characters": math.log2(size), "words": math.log2(n),
    }


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Input numbers and values of a text. Words come first, then one step of each statistic."""
    data = (text or "").encode()
    words = data.split()
    counts = Counter(words)
    found = statistics(data, words, counts)
    index = np.empty(len(counts) + len(found), dtype=np.int64)
    value = np.empty(len(index), dtype=np.float64)
    if counts:
        index[: len(counts)] = [zlib.crc32(w) for w in counts]
        index[: len(counts)] %= WORD_BUCKETS
        value[: len(counts)] = np.log1p(np.fromiter(counts.values(), dtype=np.float64, count=len(counts)))
        value[: len(counts)] /= math.sqrt(float((value[: len(counts)] ** 2).sum()))
    for k, (name, most) in enumerate(STATISTICS.items()):
        # steps are finer near nothing, where most texts lie
        step = min(STEPS - 1, int(math.sqrt(max(0.0, found[name] / most)) * STEPS))
        index[len(counts) + k] = WORD_BUCKETS + k * STEPS + step
    value[len(counts) :] = 1.0
    return index, value


@dataclass
class Machine:
    bias: float
    weight: np.ndarray
    factor: np.ndarray

    def raw(self, index: np.ndarray, value: np.ndarray) -> float:
        """Bias, weights, and all pairs by half of (square of sum - sum of squares)."""
        part = self.factor[index] * value[:, None]
        total = part.sum(axis=0)
        return self.bias + float(self.weight[index] @ value) + 0.5 * float(total @ total - (part * part).sum())

    def score(self, text: str | None) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.raw(*features(text))))))


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], seed: int = 5) -> Machine:
    """Adaptive gradient descent over single rows; rows of the rarer label weigh as much in all as the others."""
    draw = np.random.default_rng(seed)
    size = WORD_BUCKETS + len(STATISTICS) * STEPS
    machine = Machine(0.0, np.zeros(size), draw.normal(0, 0.02, (size, RANK)))
    ones = sum(y for _, _, y in rows)
    if not 0 < ones < len(rows):
        machine.bias = 3.0 if ones else -3.0 if rows else 0.0
        machine.factor[:] = 0
        return machine
    share = {1: 0.5 * len(rows) / ones, 0: 0.5 * len(rows) / (len(rows) - ones)}
    seen_w, seen_v, seen_b = np.full(size, 1e-2), np.full((size, RANK), 1e-2), 1e-2
    for epoch in range(EPOCHS):
        for k in draw.permutation(len(rows)):
            index, value, y = rows[k]
            part = machine.factor[index] * value[:, None]
            total = part.sum(axis=0)
            raw = machine.bias + float(machine.weight[index] @ value) + 0.5 * float(total @ total - (part * part).sum())
            slope = share[y] * (1 / (1 + math.exp(-max(-30.0, min(30.0, raw)))) - y)
            grow_w = slope * value + DECAY * machine.weight[index]
            grow_v = slope * value[:, None] * (total - part) + DECAY * machine.factor[index]
            seen_w[index] += grow_w**2
            seen_v[index] += grow_v**2
            seen_b += slope * slope
            machine.weight[index] -= RATE * grow_w / np.sqrt(seen_w[index])
            machine.factor[index] -= RATE * grow_v / np.sqrt(seen_v[index])
            machine.bias -= RATE * slope / math.sqrt(seen_b)
    return machine


def fitted(docs: DataFrame, labels: DataFrame, fold: Column, key: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE) -> Machine:
    """Machine trained on at most `sample` labelled rows outside the held-out fold (`fold` is true there).

    A row that is labelled more than once counts once, with the larger label; labels other than 0 and 1 are left out."""
    marked = labels.select(F.col(key).cast("long").alias(key), F.col(label).cast("int").alias("_y")).where(F.col("_y").isin(0, 1) & ~fold)
    chosen = written(marked.groupBy(key).agg(F.max("_y").alias("_y")).orderBy(F.xxhash64(key), key).limit(sample))

    def prepare(batches):
        for frame in batches:
            rows = [pickle.dumps((*features(t), int(y))) for t, y in zip(frame["_text"], frame["_y"])]
            yield pd.DataFrame({"key": frame[key], "row": rows})

    def learn(batches):
        rows = [(k, r) for frame in batches for k, r in zip(frame["key"], frame["row"])]
        machine = train([pickle.loads(r) for _, r in sorted(rows)])
        yield pd.DataFrame({"model": [pickle.dumps((machine.bias, machine.weight.astype(np.float32), machine.factor.astype(np.float32)))]})

    # at most `sample` keys, so this side has a fixed bound
    found = docs.select(F.col(key).cast("long").alias(key), F.col(text).alias("_text")).join(F.broadcast(chosen), key)
    rows = found.groupBy(key).agg(F.min("_text").alias("_text"), F.max("_y").alias("_y"))
    model = rows.mapInPandas(prepare, "key long, row binary").repartition(1).mapInPandas(learn, "model binary").first()[0]
    return Machine(*pickle.loads(bytes(model)))


def scored(docs: DataFrame, machine: Machine, text: str = "text", accept: float = ACCEPT) -> DataFrame:
    """All columns of the rows with score (0 to 1) and predicted (1 from `accept` on); columns of these names are replaced."""
    shared = docs.sparkSession.sparkContext.broadcast((machine.bias, machine.weight, machine.factor))

    @F.pandas_udf("double")
    def run(column):
        model = Machine(*shared.value)
        return column.map(model.score, na_action=None).astype("float64")

    return docs.withColumn("score", run(F.col(text).cast("string"))).withColumn("predicted", (F.col("score") >= accept).cast("int"))


def held_out(key: str = "doc_id", folds: int = 5) -> Column:
    return F.coalesce(crc_fold(key, folds) == 0, F.lit(False))
