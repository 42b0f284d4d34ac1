"""Document fingerprints: a quartile digest of hashed byte triplets.

Every window of five bytes gives six triplets (the first byte with two of the other four), each hashed to one of 128
buckets by its own salt. The counts' quartiles decide two bits per bucket; a byte for the logarithm of the length and
one for the ratios of the quartiles precede them. Two digests differ by a bounded number of points: steps between
bucket codes (a step over all four levels counts double), steps of the length code, steps of the two ratio codes.

NULL text counts as empty. A text of under five bytes has no windows; its digest is made of its single bytes, so that
short texts tell apart, and the empty text has the digest of all zeros. Equal texts have equal digests. Empty tables give
no rows.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

BUCKETS = 128
#: Points of a digest pair that differs everywhere: buckets at 6, length code at 128, ratio codes at 8 each.
MOST = BUCKETS * 6 + 128 + 16
#: Places of the second and third byte after the first, by triplet.
TRIPLETS = ((1, 2), (1, 3), (2, 3), (1, 4), (2, 4), (3, 4))
#: Bytes of text hashed at once.
SLICE = 1 << 20


def bucket_counts(data: np.ndarray) -> np.ndarray:
    """How often each bucket is hit by the triplets of the bytes."""
    counts = np.zeros(BUCKETS, dtype=np.int64)
    if len(data) < 5:
        np.add.at(counts, (data.astype(np.uint32) * np.uint32(2654435761)) >> np.uint32(25), 1)
        return counts
    for start in range(0, len(data) - 4, SLICE):
        part = data[start : start + SLICE + 4].astype(np.uint32)
        n = len(part) - 4
        first = part[:n] * np.uint32(0x9E3779B1)
        for k, (i, j) in enumerate(TRIPLETS):
            mixed = first + part[i : n + i] * np.uint32(0x85EBCA77) + part[j : n + j] * np.uint32(0xC2B2AE3D)
            mixed += np.uint32(0x27D4EB2F * (k + 1) & 0xFFFFFFFF)
            mixed ^= mixed >> np.uint32(15)
            mixed *= np.uint32(0x2C1B3C6D)
            counts += np.bincount(mixed >> np.uint32(25), minlength=BUCKETS)
    return counts


def digest(data: bytes) -> str:
    """68 hexadecimal digits: length code, ratio code, two bits per bucket."""
    counts = bucket_counts(np.frombuffer(data, dtype=np.uint8))
    ordered = np.sort(counts)
    q1, q2, q3 = (int(ordered[BUCKETS * k // 4 - 1]) for k in (1, 2, 3))
    codes = (counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)
    packed = np.packbits(np.unpackbits(codes[:, None], axis=1)[:, 6:].ravel())
    length = min(255, round(8 * math.log2(len(data) + 1)))
    ratios = 0 if q3 == 0 else (q1 * 15 // q3) << 4 | (q2 * 15 // q3)
    return bytes([length, ratios]).hex() + packed.tobytes().hex()


def parts(fingerprint: str) -> tuple[int, int, np.ndarray]:
    raw = np.frombuffer(bytes.fromhex(fingerprint), dtype=np.uint8)
    bits = np.unpackbits(raw[2:]).reshape(-1, 2)
    return int(raw[0]), int(raw[1]), bits[:, 0] * 2 + bits[:, 1]


def difference(a: str, b: str) -> int:
    """Points by which two digests differ, 0 to MOST."""
    if a == b:
        return 0
    (length_a, ratio_a, codes_a), (length_b, ratio_b, codes_b) = parts(a), parts(b)
    steps = np.abs(codes_a.astype(np.int16) - codes_b)
    ratios = sum(min(8, abs(x - y)) for x, y in ((ratio_a >> 4, ratio_b >> 4), (ratio_a & 15, ratio_b & 15)))
    return int(steps.sum() + 3 * (steps == 3).sum()) + min(128, abs(length_a - length_b)) + ratios


def likeness(a: str, b: str) -> float:
    """1 for equal digests, falling to 0 with the difference; unrelated texts of one language lie near a half."""
    return max(0.0, 1 - 2 * difference(a, b) / MOST)


def fingerprints(docs: DataFrame, text: str = "text", into: str = "fingerprint") -> DataFrame:
    """All columns of the rows with the digest of their text."""

    def run(batches):
        for frame in batches:
            data = [(x or "").encode() for x in frame[text]]
            yield frame.assign(**{into: [digest(x) for x in data]})

    kept = docs.drop(into)
    return kept.mapInPandas(run, StructType([*kept.schema, StructField(into, StringType())]))


def followed(docs: DataFrame, order: str = "doc_id", text: str = "text", slices: int | None = None) -> DataFrame:
    """Rows cut into slices of the order; each slice ends with copies of the row that comes after it.

    The bounds are quantiles of the order column, one number per slice. Every text moves once, and one per slice
    twice; no slice is gathered in memory. The row after the last is the first. NULLs come first, ties follow the text.
    Columns: _slice, _foreign (the row belongs to another slice), order, text; sorted by them in each partition.
    """
    spark = docs.sparkSession
    slices = slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(order).cast("long").alias(order), F.col(text).alias(text))
    shares = [k / slices for k in range(1, slices)]
    found = rows.select(F.percentile_approx(order, shares, 10_000)).first()[0] if shares else None
    bounds = F.lit(sorted(set(found or [0]))).cast("array<long>")
    placed = rows.withColumn("_slice", F.coalesce(F.size(F.filter(bounds, lambda b: b < F.col(order))), F.lit(0)))
    placed = placed.withColumn("_slice", F.when(F.col(order).isNull(), 0).otherwise(F.col("_slice")))
    # the least of an order with NULLs first, by slice: as many rows as slices
    least = F.min(F.struct(F.col(order).isNotNull().alias("known"), F.col(order).alias("value")))
    firsts = sorted((r[0], r[1]["value"]) for r in placed.drop(text).groupBy("_slice").agg(least).collect())
    before = [(value, firsts[k - 1][0]) for k, (_, value) in enumerate(firsts)]
    other = F.lit(None).cast("int")
    if before:
        known = [(v, s) for v, s in before if v is not None]
        lead = F.broadcast(spark.createDataFrame(known, f"{order} long, _before int"))
        placed = placed.join(lead, order, "left")
        missing = [s for v, s in before if v is None]
        other = F.when(F.col(order).isNull(), F.lit(missing[0] if missing else None).cast("int")).otherwise(F.col("_before"))
    copies = F.array_compact(F.array(F.struct("_slice", F.lit(False).alias("_foreign")), F.when(other.isNotNull(), F.struct(other.alias("_slice"), F.lit(True).alias("_foreign")))))
    spread = placed.select(F.explode(copies).alias("_to"), order, text).select("_to.*", order, text)
    keys = ["_slice", "_foreign", F.col(order).asc_nulls_first(), F.col(text).asc_nulls_first()]
    return spread.repartition(slices, "_slice").sortWithinPartitions(*keys)


def edited_fingerprints(docs: DataFrame, order: str = "doc_id", text: str = "text") -> DataFrame:
    """Digest of every text and of its edited form, whose last half is the beginning of the next row's text.

    Columns: order, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.
    Repeated rows keep their own results; a sole row is followed by itself.
    """

    def answer(key, own, after):
        half = len(own) // 2
        edited = (own[: len(own) - half] + after[:half]).encode()
        mine, theirs, changed = digest(own.encode()), digest(after.encode()), digest(edited)
        return key, len(own), hashlib.sha256(edited).hexdigest(), mine, changed, likeness(mine, changed), likeness(mine, theirs)

    names = [order, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(batches):
        waiting = None
        for frame in batches:
            done = []
            known = frame[order].notna()
            keys = frame[order].astype("Int64")
            for at, foreign, key, is_known, own in zip(frame["_slice"], frame["_foreign"], keys, known, frame[text]):
                key, own = (int(key) if is_known else None), own or ""
                if waiting is not None and waiting[0] == at:
                    done.append(answer(waiting[1], waiting[2], own))
                waiting = None if foreign else (at, key, own)
            if done:
                out = pd.DataFrame(done, columns=names)
                out[order] = out[order].astype("Int64")
                yield out

    schema = f"{order} long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return followed(docs, order, text).mapInPandas(run, schema)
