"""Importance resampling towards a target corpus by bit-sliced aggregation.

Features are runs of consecutive words, hashed into buckets. A bucket's gain is the scaled logarithm of its smoothed share
in the target over its share in the source, as an integer. A document's weight is the floored mean of its features' gains.

The sum of a document is never taken feature by feature. Its bucket counts become bit planes: plane j holds one bit per
bucket, set where bit j of the count is set. The gains become planes as well, for either sign: plane k holds bit k of the
gain's magnitude. The sum is then the popcount of (count plane j AND gain plane k) times 2 ** (j + k), added over all j and
k and subtracted for the negative gains, which is exact in integers.

Documents are drawn by the largest weight plus a Gumbel number that follows from the document's id; the places come from
range slices of the order, so no task sees the whole ranking.

NULL and empty texts have no features and the weight zero. A NULL id has no Gumbel number: such rows have a weight, but no
score, and are not drawn. Repeated rows each count and each get a row. Further columns of the inputs are not read, and empty
tables give no rows (an empty target gives gains that only smooth the source).
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import written
from ledgerloom.operators.spread import number_rows

#: Buckets, longest run of words that is a feature, scale of the integer gains.
BUCKETS, LONGEST, SCALE = 10_000, 1, 1000
#: Least words of a document that may be drawn, percent drawn, seed of the Gumbel numbers.
LEAST_WORDS, PERCENT, SEED = 20, 10, 2024
#: Documents whose planes are built side by side.
SIDE_BY_SIDE = 64
#: Bytes that belong to words, after A-Z became a-z; all others separate (fixed values).
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(WORD_BYTES).split()


def bucket_counts(words: list[bytes], longest: int = LONGEST, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """(buckets that occur, ascending; their counts) of all runs of 1 to `longest` words."""
    found = [np.fromiter(map(zlib.crc32, words), dtype=np.int64, count=len(words))]
    for size in range(2, longest + 1):
        runs = [zlib.crc32(b" ".join(words[k : k + size])) for k in range(len(words) - size + 1)]
        found.append(np.array(runs, dtype=np.int64))
    times = np.bincount(np.concatenate(found) % buckets, minlength=1)
    places = np.flatnonzero(times)
    return places, times[places]


def counted(docs: DataFrame, key: str | None = "doc_id", text: str = "text", longest: int = LONGEST, buckets: int = BUCKETS) -> DataFrame:
    """Columns key, n_words, n_features, places, times: the bucket counts of every row as arrays of 32-bit numbers."""
    out = pa.schema([("key", pa.int64()), ("n_words", pa.int64()), ("n_features", pa.int64()), ("places", pa.binary()), ("times", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            columns = [[], [], [], []]
            for value in batch.column(1):
                words = words_of(value.as_py())
                places, times = bucket_counts(words, longest, buckets)
                row = (len(words), int(times.sum()), places.astype("<u4").tobytes(), times.astype("<u4").tobytes())
                for column, item in zip(columns, row):
                    column.append(item)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), *[pa.array(c, f.type) for c, f in zip(columns, list(out)[1:])]], schema=out)

    named = F.col(key).cast("long") if key else F.lit(None).cast("long")
    source = docs.select(named.alias("key"), F.col(text).cast("string").alias("text"))
    return source.mapInArrow(run, "key long, n_words long, n_features long, places binary, times binary")


def totals(counts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all rows in each bucket. A task adds up its rows first; the driver gets one number a bucket."""

    def run(batches: Iterator[pa.RecordBatch]):
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for places, times in zip(batch.column(0), batch.column(1)):
                total[np.frombuffer(places.as_py(), dtype="<u4")] += np.frombuffer(times.as_py(), dtype="<u4")
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["bucket", "times"])

    partial = counts.select("places", "times").mapInArrow(run, "bucket long, times long")
    found = np.zeros(buckets, dtype=np.int64)
    for bucket, times in partial.groupBy("bucket").agg(F.sum("times")).collect():
        found[bucket] = times
    return found


def gains(source: np.ndarray, target: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """Scaled logarithm of the smoothed shares' ratio of every bucket, rounded down."""
    size, s_all, t_all = len(source), float(source.sum() + len(source)), float(target.sum() + len(source))
    return np.array([math.floor(scale * math.log((float(target[b]) + 1) * s_all / ((float(source[b]) + 1) * t_all))) for b in range(size)], dtype=np.int64)


def _packed(bits: np.ndarray) -> np.ndarray:
    """Rows of 64-bit words from rows of bits."""
    spare = -bits.shape[1] % 64
    return np.packbits(np.pad(bits, ((0, 0), (0, spare))), axis=1).view(np.uint64)


def gain_planes(gain: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(signed power of two, plane) of every bit of the positive and of the negative gains."""
    planes = []
    for sign in (1, -1):
        size = np.maximum(sign * gain, 0)
        for k in range(int(size.max(initial=0)).bit_length()):
            planes.append((sign << k, _packed((size >> k & 1).astype(np.uint8)[None, :])[0]))
    return planes


def plane_sums(rows: list[tuple[np.ndarray, np.ndarray]], planes: list[tuple[int, np.ndarray]], buckets: int = BUCKETS) -> np.ndarray:
    """Sum of gains over the features of each row, from (places, times) of the rows."""
    sums = np.zeros(len(rows), dtype=np.int64)
    row = np.repeat(np.arange(len(rows)), [len(p) for p, _ in rows])
    place, times = (np.concatenate([r[k] for r in rows]).astype(np.int64) if rows else np.zeros(0, dtype=np.int64) for k in (0, 1))
    for j in range(int(times.max(initial=0)).bit_length()):
        here = np.flatnonzero(times >> j & 1)
        # only the rows that have a bit in this plane
        some, slot = np.unique(row[here], return_inverse=True)
        bits = np.zeros((len(some), buckets), dtype=np.uint8)
        bits[slot, place[here]] = 1
        plane = _packed(bits)
        for power, gain in planes:
            sums[some] += (power << j) * np.bitwise_count(plane & gain).sum(axis=1, dtype=np.int64)
    return sums


def weighed(counts: DataFrame, gain: np.ndarray) -> DataFrame:
    """Columns key, n_words, n_features, weight of counted rows."""
    buckets = len(gain)
    # two planes of `buckets` bits for every bit of a gain, whatever the corpus
    shared = counts.sparkSession.sparkContext.broadcast(gain_planes(gain))

    def run(batches: Iterator[pa.RecordBatch]):
        planes = shared.value
        for batch in batches:
            sums = []
            for k in range(0, batch.num_rows, SIDE_BY_SIDE):
                part = batch.slice(k, SIDE_BY_SIDE)
                rows = [tuple(np.frombuffer(c.as_py(), dtype="<u4") for c in pair) for pair in zip(part.column("places"), part.column("times"))]
                sums.append(plane_sums(rows, planes, buckets))
            size = batch.column("n_features").to_numpy()
            total = np.concatenate(sums) if sums else np.zeros(0, dtype=np.int64)
            weight = np.where(size > 0, total // np.maximum(size, 1), 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("n_words"), batch.column("n_features"), pa.array(weight)], ["key", "n_words", "n_features", "weight"]
            )

    return counts.mapInArrow(run, "key long, n_words long, n_features long, weight long")


def gumbel(key: str, seed: int = SEED, scale: int = SCALE) -> Column:
    """Scaled Gumbel number of an id, rounded down; NULL for a NULL id."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")).cast("binary"), 256), 1, 8)
    share = (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(1 << 32))
    return F.floor(-F.lit(float(scale)) * F.log(-F.log(share))).cast("long")


def resampled(
    docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", longest: int = LONGEST, buckets: int = BUCKETS,
    least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED, scale: int = SCALE,
) -> DataFrame:
    """Columns key, n_features, weight, score, rank of every row; rank is 1, 2, ... by descending score, equal scores by
    ascending id, for the drawn rows and NULL for all others. Drawn are `percent` of the rows of at least `least_words`
    words, rounded down."""
    counts = written(counted(docs, key, text, longest, buckets))
    gain = gains(totals(counts, buckets), totals(counted(target, None, text, longest, buckets), buckets), scale)
    rows = written(weighed(counts, gain).withColumn("score", F.col("weight") + gumbel("key", seed, scale)))
    may = (F.col("n_words") >= least_words) & F.col("key").isNotNull()
    draw = percent * rows.where(may).count() // 100
    placed = number_rows(rows.where(may).withColumn("_down", -F.col("score")), ["_down", "key"], "_place")
    drawn = placed.withColumn("rank", F.when(F.col("_place") <= draw, F.col("_place")).cast("long")).drop("_down", "_place")
    rest = rows.where(~may).withColumn("rank", F.lit(None).cast("long"))
    return drawn.unionByName(rest).select(F.col("key").alias(key), "n_features", "weight", "score", "rank")
