"""Ranked lexical search without random access: impact-sorted lists, score intervals, exact top documents.

The documents are read once for their length and the occurrences of the items' terms, which gives the collection's
statistics and a table of one row per document. A task takes slices of that table, turns each into one list per term in
descending order of impact, and answers every item from the lists of its terms alone: it reads them from the front in
growing blocks, adds what it meets to the lower bound of a document, and knows from the impacts at the reading places what a
document may still gain. It stops reading when no unread document can reach the last place any more and every document that
may still take or share a place has been met in each list that could add to it, so membership, ties and scores are final.
Documents of a slice that cannot pass the task's own earlier slices are out from the start. The best of all tasks merge.

Items are taken in blocks of a bounded number of terms (one pass over the documents each), so what the tasks are sent does
not grow with the items. All of a score is 64-bit integer arithmetic but a term's weight, a logarithm in doubles.

NULL and empty texts have no term: such documents are not counted, such items have no result. Rows of equal item id are one
item of all their terms. Repeated documents each count and each may take a place; a NULL document id comes last among equal
scores. Further columns are not read; empty tables give no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import written
from ledgerloom.llm.importance import WORD_BYTES

#: Places of an item; share of a document's length in its score, in percent; factor of the saturation.
PLACES, LENGTH_SHARE = 10, 90
#: Fixed numbers of the score.
WEIGHT_SCALE, IMPACT_SCALE, TERM_SCALE, LENGTH_SCALE = 1000, 1_000_000_000, 1000, 8
#: Distinct terms of the items that are taken in one pass.
TERM_BLOCK = 200_000
#: Occurrences (document and term) in one slice.
SLICE = 1 << 20
#: Entries of every list that are read first; later blocks are twice as long each.
FIRST_BLOCK = 128


def terms_of(text: str | None) -> list[bytes]:
    """Terms of a text with repeats: runs of ASCII letters and digits and of all further characters, A-Z lower-cased."""
    return (text or "").encode().translate(WORD_BYTES).split()


def occurrences(docs: DataFrame, numbers: dict[bytes, int], key: str = "doc_id", text: str = "text") -> DataFrame:
    """Columns key, length, terms, times of every document with at least one term; terms and times are arrays of 32-bit
    numbers of the terms in `numbers` that it holds."""
    shared = docs.sparkSession.sparkContext.broadcast(numbers)
    out = pa.schema([("key", pa.int64()), ("length", pa.int64()), ("terms", pa.binary()), ("times", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]):
        number = shared.value.get
        for batch in batches:
            keys, lengths, held, times = [], [], [], []
            for key_, value in zip(batch.column(0), batch.column(1)):
                words = terms_of(value.as_py())
                if not words:
                    continue
                found = Counter(map(number, words))
                found.pop(None, None)
                keys.append(key_.as_py())
                lengths.append(len(words))
                held.append(np.fromiter(found.keys(), dtype="<u4", count=len(found)).tobytes())
                times.append(np.fromiter(found.values(), dtype="<u4", count=len(found)).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip((keys, lengths, held, times), out)], schema=out)

    source = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text")).where(F.length("text") > 0)
    return source.mapInArrow(run, "key long, length long, terms binary, times binary")


def document_counts(found: DataFrame, size: int) -> np.ndarray:
    """Documents that hold each term; a task adds up its rows first."""

    def run(batches: Iterator[pa.RecordBatch]):
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            for terms in batch.column(0):
                total[np.frombuffer(terms.as_py(), dtype="<u4")] += 1
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["term", "documents"])

    counts = np.zeros(size, dtype=np.int64)
    for term, documents in found.select("terms").mapInArrow(run, "term long, documents long").groupBy("term").agg(F.sum("documents")).collect():
        counts[term] = documents
    return counts


def resolved_top(lists: list[tuple[np.ndarray, np.ndarray]], size: int, least: int, places: int = PLACES, first: int = FIRST_BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """(documents, scores) that may take a place: all documents of a score of at least the places-th best and of `least`.

    `lists` holds (documents, impacts) of each term, impacts descending and positive; documents are numbers below `size`.
    """
    lower = np.zeros(size, dtype=np.int64)
    met = np.zeros((len(lists), size), dtype=bool)
    at = [0] * len(lists)
    # what an unread entry of each list may add at most
    front = np.array([impacts[0] if len(impacts) else 0 for _, impacts in lists], dtype=np.int64)
    reading, block = [j for j in range(len(lists)) if front[j]], first
    while reading:
        for j in reading:
            documents, impacts = lists[j]
            a, b = at[j], min(at[j] + block, len(impacts))
            lower[documents[a:b]] += impacts[a:b]
            met[j, documents[a:b]] = True
            at[j], front[j] = b, impacts[b] if b < len(impacts) else 0
        block *= 2
        last = int(np.partition(lower, size - places)[size - places]) if size >= places else 0
        bar = max(last, least, 1)
        if int(front.sum()) >= bar:
            # a document that was not met at all may still come in
            reading = [j for j in range(len(lists)) if front[j]]
            continue
        near = np.flatnonzero(lower + int(front.sum()) >= bar)
        lacking = ~met[:, near]
        near_upper = lower[near] + (front[:, None] * lacking).sum(axis=0)
        open_ = near_upper >= bar
        # lists that could still change the score of a document in question
        reading = np.flatnonzero((lacking[:, open_] & (front > 0)[:, None]).any(axis=1)).tolist()
    if not len(lists) or not size:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    last = int(np.partition(lower, size - places)[size - places]) if size >= places else 0
    chosen = np.flatnonzero(lower >= max(last, least, 1))
    return chosen, lower[chosen]


class Slice:
    """Impact-sorted lists of some documents, and the search in them."""

    def __init__(self, lengths: np.ndarray, owner: np.ndarray, terms: np.ndarray, times: np.ndarray, statistics: tuple[int, int], weights: np.ndarray, share: int = LENGTH_SHARE):
        documents, all_terms = statistics
        self.size = len(lengths)
        scaled = 100 - share + (share * lengths * documents) // all_terms
        impact = weights[terms] * ((IMPACT_SCALE * times) // (TERM_SCALE * times + LENGTH_SCALE * scaled[owner]))
        held = impact > 0
        terms, owner, impact = terms[held], owner[held], impact[held]
        order = np.lexsort((owner, -impact, terms))
        self.owner, self.impact = owner[order], impact[order]
        self.start = np.searchsorted(terms[order], np.arange(len(weights) + 1))

    def top(self, terms: list[int], least: int, places: int = PLACES) -> tuple[np.ndarray, np.ndarray]:
        spans = [(self.start[t], self.start[t + 1]) for t in terms]
        lists = [(self.owner[a:b], self.impact[a:b]) for a, b in spans if b > a]
        return resolved_top(lists, self.size, least, places)


def ranked(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", places: int = PLACES,
    share: int = LENGTH_SHARE, term_block: int = TERM_BLOCK, slice_: int = SLICE,
) -> DataFrame:
    """Columns item, rank, key, score: the `places` best documents of every item, equal scores by ascending key."""
    spark = docs.sparkSession

    def distinct_terms(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            pairs = [(i, t) for i, text_ in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for t in set(terms_of(text_))]
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in pairs], pa.int64()), pa.array([t for _, t in pairs], pa.binary())], ["item", "term"])

    asked = items.select(F.col(item).cast("long").alias("item"), F.col(text).cast("string").alias("text")).where(F.col("text").isNotNull())
    asked = written(asked.mapInArrow(distinct_terms, "item long, term binary").distinct())
    blocks = max(1, math.ceil(asked.count() / term_block))
    schema = "item long, key long, score long"
    best = spark.createDataFrame([], schema)
    for block in range(blocks):
        # about term_block terms, whatever the number of items
        pairs = asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).collect()
        names = sorted({bytes(t) for _, t in pairs})
        numbers = {t: k for k, t in enumerate(names)}
        wanted: dict[int | None, list[int]] = {}
        for i, t in pairs:
            wanted.setdefault(i, []).append(numbers[bytes(t)])
        if not names:
            continue
        found = written(occurrences(docs, numbers, key, text))
        documents, all_terms = found.agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first()
        if not documents:
            continue
        holding = document_counts(found, len(names))
        weights = np.array([math.floor(WEIGHT_SCALE * math.log((2 * documents + 2) / (2 * int(h) + 1))) for h in holding], dtype=np.int64)
        shared = spark.sparkContext.broadcast((wanted, weights, (documents, all_terms), share, places, slice_))
        best = best.unionByName(found.mapInArrow(_search_with(shared), schema))
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("key").asc_nulls_last())
    best = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= places)
    return best.select(F.col("item").alias(item), "rank", F.col("key").alias(key), "score")


def _search_with(shared):
    return lambda batches: _searched(batches, *shared.value)


def _searched(batches, wanted, weights, statistics, share, places, slice_):
    """Best documents of every item among the rows of one task, slice by slice."""
    kept: dict[int | None, list[tuple[int, float, int | None]]] = {i: [] for i in wanted}

    def search(rows):
        keys = [r[0] for r in rows]
        lengths = np.array([r[1] for r in rows], dtype=np.int64)
        terms, times = (np.concatenate([np.frombuffer(r[k], dtype="<u4") for r in rows]).astype(np.int64) for k in (2, 3))
        owner = np.repeat(np.arange(len(rows)), [len(r[2]) // 4 for r in rows])
        lists = Slice(lengths, owner, terms, times, statistics, weights, share)
        for i, numbers in wanted.items():
            mine = kept[i]
            least = -mine[places - 1][0] if len(mine) >= places else 1
            found, scores = lists.top(numbers, least, places)
            if len(found):
                mine += [(-s, math.inf if keys[d] is None else keys[d], keys[d]) for d, s in zip(found.tolist(), scores.tolist())]
                mine.sort(key=lambda entry: entry[:2])
                del mine[places:]

    rows, size = [], 0
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns]):
            rows.append(row)
            size += 1 + len(row[2]) // 4
            if size >= slice_:
                search(rows)
                rows, size = [], 0
    if rows:
        search(rows)
    out = [(i, key, -score) for i, mine in kept.items() for score, _, key in mine]
    columns = list(zip(*out)) if out else [(), (), ()]
    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["item", "key", "score"])
