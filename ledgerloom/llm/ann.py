"""Approximate nearest neighbours over shifted space-filling curves.

Vectors are projected to a few random directions, several times over; each projection, shifted by its own offset, is
put in order by the Hilbert curve through its grid. An order is cut into blocks at quantiles of its keys, and Spark
deals the blocks to tasks. A query looks through the blocks around its own place in every order; the nearest of each
block are merged over all orders and ranked by their exact score.

How far a query looks, and through how many of the orders, is measured, not assumed: for a bounded sample of probe queries
the true neighbours are found against all rows. For every number of orders the reach is the least number of blocks that
finds the wanted share of them, and the number of least cost (pairs compared, vectors moved) is taken. Vectors with close
neighbours need one or two blocks; vectors spread evenly in many dimensions (no order can help there) need many, and then
few orders with a long reach find as much as many orders with a short one, for fewer copies of the vectors.

Null vectors, zero vectors and vectors with null or non-finite components take no part, as row or as query. Inner products
need one length: the most frequent one takes part (of equally frequent ones the smallest). Rows without an id take no part.
Repeated rows and ids: each row counts, as a candidate and as a query of its own, so an id can stand at several ranks and
repeated queries return their neighbours once each; no query finds rows of its own id. Equal scores go by id. Empty tables,
of rows or of queries, give no rows. Columns beside key and vector are not read, whatever they are called.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from ledgerloom.llm.common import written

#: Orders at most and at least, directions of each, bits of a grid coordinate.
CURVES, LEAST_CURVES, DIRECTIONS, BITS = 6, 2, 5, 8
#: Pairs that can be compared in the time it takes to move one vector to a task.
MOVE = 500
#: Rows in one block of an order.
BLOCK_ROWS = 4096
#: Steps from a query's own block that one group covers: a group holds at most that many blocks' queries, at any reach.
STEPS_TOGETHER = 64
#: Probe queries, and the share of their neighbours that the reach has to find.
PROBES, WANTED = 256, 0.96
SEED = 11


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each grid cell (rows of small unsigned numbers) on the Hilbert curve, as unsigned 64-bit numbers."""
    x = cells.astype(np.uint64).T.copy()
    n = len(x)
    top = np.uint64(1 << (bits - 1))
    q = top
    while q > 1:
        low = q - np.uint64(1)
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            x[i] ^= swap
        q >>= np.uint64(1)
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = top
    while q > 1:
        turn ^= np.where((x[n - 1] & q) != 0, q - np.uint64(1), np.uint64(0))
        q >>= np.uint64(1)
    x ^= turn
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << np.uint64(1) | (x[i] >> np.uint64(b)) & np.uint64(1)
    return key


def projections(length: int, curves: int, directions: int) -> tuple[np.ndarray, np.ndarray]:
    """Orthonormal directions of every order and the shift of its grid, in cells' widths of the unit range."""
    draw = np.random.default_rng(SEED)
    axes = [np.linalg.qr(draw.standard_normal((length, max(directions, 1))))[0] for _ in range(curves)]
    return np.stack(axes), draw.uniform(-0.25, 0.25, (curves, min(directions, length)))


def curve_keys(vectors: np.ndarray, length: int, curves: int, directions: int, bits: int) -> np.ndarray:
    """Keys of unit-scaled vectors in every order, one column each; signed, in the same order."""
    axes, shifts = projections(length, curves, directions)
    unit = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    spread = 2.5 / math.sqrt(length)
    found = []
    for axis, shift in zip(axes, shifts):
        place = np.clip((unit @ axis / spread + shift + 1.25) / 2.5, 0, 1 - 1e-9)
        found.append(hilbert_keys((place * (1 << bits)).astype(np.uint64), bits).astype(np.int64))
    return np.stack(found, axis=1)


def element(rows: DataFrame, vector: str) -> str:
    """Type in which the numbers of a vector move: single precision as it is, all else as doubles."""
    return "float" if isinstance(getattr(rows.schema[vector].dataType, "elementType", None), FloatType) else "double"


def usable(rows: DataFrame, key: str, vector: str, kind: str) -> DataFrame:
    """Columns row (a number of the row's own), id, vec (numbers of the type `kind`) of the rows that can take part."""
    own = F.monotonically_increasing_id().alias("row")
    typed = rows.select(own, F.col(key).cast("long").alias("id"), F.col(vector).cast(f"array<{kind}>").alias("vec")).where(
        F.col("id").isNotNull() & F.col("vec").isNotNull() & (F.size("vec") > 0)
    )
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return typed.where(finite & F.exists("vec", lambda x: x != 0))


def doubles(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def matrix(column: pa.Array | pa.ChunkedArray, size: int) -> np.ndarray:
    """Lists of `size` numbers each as rows of a matrix."""
    return np.asarray(pc.list_flatten(column)).reshape(-1, size)


def lists(values: np.ndarray | pa.Array, counts: np.ndarray) -> pa.ListArray:
    """Consecutive values as lists of the given lengths."""
    ends = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), values if isinstance(values, pa.Array) else pa.array(values))


def best(query: np.ndarray, query_ids: np.ndarray, data: np.ndarray, ids: np.ndarray, k: int):
    """The k nearest rows of each query among `data` (sorted by id): lists of places in `data` and scores.

    A matrix product finds those that can be among the k nearest; they are scored again pair by pair, so that a pair
    has the same score wherever it is met, and ties go to the smaller id."""
    found = []
    for start in range(0, len(query), 256):
        part = query[start : start + 256]
        score = part @ data.T
        score[query_ids[start : start + 256, None] == ids[None, :]] = -np.inf
        if data.shape[0] > k:
            floor = -np.partition(-score, k - 1, axis=1)[:, k - 1]
        else:
            floor = np.full(len(part), -np.inf)
        slack = 1e-9 * (1 + np.abs(np.where(np.isfinite(floor), floor, 0)))
        for row, low, vec in zip(score, floor - slack, part):
            at = np.flatnonzero((row >= low) & (row > -np.inf))
            exact = (data[at] * vec).sum(axis=1)
            order = np.argsort(-exact, kind="stable")[:k]
            found.append((at[order], exact[order]))
    return found


def search(
    rows: DataFrame, queries: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 20,
    curves: int = CURVES, directions: int = DIRECTIONS, block_rows: int = BLOCK_ROWS, wanted: float = WANTED,
    steps_together: int = STEPS_TOGETHER,
) -> DataFrame:
    """Columns query_id, rank, vec_id, score: the k rows of largest inner product found for every query."""
    spark = rows.sparkSession
    kind = "float" if element(rows, vector) == element(queries, vector) == "float" else "double"

    def keyed(batches):
        for batch in batches:
            sizes = pc.list_value_length(batch.column("vec"))
            for size in pc.unique(sizes).to_pylist():
                part = batch.filter(pc.equal(sizes, size))
                keys = curve_keys(matrix(part.column("vec"), size).astype(np.float64), size, curves, min(directions, size), BITS)
                columns = [*part.columns, lists(keys.ravel(), np.full(len(keys), curves)), pa.array(np.full(len(keys), size, dtype=np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=["row", "id", "vec", "keys", "size"])

    # written, so that the numbers of the rows stay theirs if a task is run again
    schema = f"row long, id long, vec array<{kind}>, keys array<long>, size long"
    placed = written(usable(rows, key, vector, kind).mapInArrow(keyed, schema))
    common = placed.groupBy("size").count().orderBy(F.desc("count"), "size").first()
    if common is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    length, count = common
    placed = placed.where(F.col("size") == length).drop("size")
    asked = written(usable(queries, key, vector, kind)).where(F.size("vec") == length)
    directions = min(directions, length)
    blocks = max(1, math.ceil(count / block_rows))
    shares = [j / blocks for j in range(1, blocks)]
    if shares:
        cuts = placed.select(*[F.percentile_approx(F.col("keys")[c], shares, max(100_000, 4 * blocks)) for c in range(curves)]).first()
        cuts = [np.array(x, dtype=np.int64) for x in cuts]
    else:
        cuts = [np.array([], dtype=np.int64)] * curves

    def block_of(keys: np.ndarray, rows: np.ndarray, c: int) -> np.ndarray:
        """Block of each key; keys equal to several cuts are dealt over the blocks between them by the row's number."""
        low, high = np.searchsorted(cuts[c], keys, "left"), np.searchsorted(cuts[c], keys, "right")
        return low + (rows * 2654435761 % 1048573) % (high - low + 1)

    orders, reach = measured_orders(placed, asked, count, length, k, curves, directions, blocks, block_of, wanted, block_rows)

    def deal(query: bool):
        def run(batches):
            for batch in batches:
                vectors = matrix(batch.column("vec"), length)
                ids, own = batch.column("id").to_numpy(), batch.column("row").to_numpy()
                keys = curve_keys(vectors.astype(np.float64), length, curves, directions, BITS) if query else matrix(batch.column("keys"), curves)
                for c in range(orders):
                    home = block_of(keys[:, c], own, c)
                    # a query lists its steps; a row of a block is met by every bundle of steps
                    steps = [(n - reach, n // steps_together) for n in range(2 * reach + 1)] if query else [(0, b) for b in range(bundles)]
                    for step, bundle in steps:
                        inside = np.flatnonzero((home + step >= 0) & (home + step < blocks))
                        if not len(inside):
                            continue
                        spot = (c * blocks + home + step)[inside] * bundles + bundle
                        columns = [pa.array(spot), pa.array(own[inside]), pa.array(ids[inside]), lists(vectors[inside].ravel(), np.full(len(inside), length))]
                        yield pa.RecordBatch.from_arrays(columns, names=["spot", "row", "id", "vec"])

        return run

    bundles = math.ceil((2 * reach + 1) / steps_together)
    spots = f"spot long, row long, id long, vec array<{kind}>"
    filed = placed.mapInArrow(deal(False), spots)
    visits = asked.mapInArrow(deal(True), spots)

    def meet(spot: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        # a block that no query visits and the steps past the outermost block have no hits
        asker, query = left.column("row").to_numpy(), left.column("id").to_numpy()
        ids, own = right.column("id").to_numpy(), right.column("row").to_numpy()
        order = np.lexsort((own, ids))
        ids, own = ids[order], own[order]
        pairs = len(asker) and len(ids)
        met = best(matrix(left.column("vec"), length).astype(np.float64), query, matrix(right.column("vec"), length).astype(np.float64)[order], ids, k) if pairs else []
        at = np.concatenate([a for a, _ in met]) if met else np.empty(0, dtype=np.int64)
        score = np.concatenate([s for _, s in met]) if met else np.empty(0)
        hits = pa.StructArray.from_arrays([pa.array(-score), pa.array(ids[at]), pa.array(own[at])], names=["less", "vec_id", "row"])
        place = spot[0].as_py()
        part = np.full(len(met), place // bundles // blocks * bundles + place % bundles, dtype=np.int64)
        columns = [pa.array(asker[: len(met)]), pa.array(query[: len(met)]), pa.array(part), lists(hits, np.array([len(a) for a, _ in met], dtype=np.int64))]
        return pa.Table.from_arrays(columns, names=["asker", "query_id", "part", "hits"])

    found = "asker long, query_id long, part long, hits array<struct<less: double, vec_id: long, row: long>>"
    hits = visits.groupBy("spot").cogroup(filed.groupBy("spot")).applyInArrow(meet, found)

    def nearest(hits: DataFrame, *by: str) -> DataFrame:
        # a row is met once in every order, so the k nearest different ones stand among the first k * orders
        first = F.slice(F.array_sort(F.flatten(F.collect_list("hits"))), 1, k * orders)
        return hits.groupBy(*by).agg(F.slice(F.array_distinct(first), 1, k).alias("hits"))

    if bundles > 1:
        # a bundle's steps first: the lists that meet in one row stay few, however far a query looks
        hits = nearest(hits, "asker", "query_id", "part")
    merged = nearest(hits, "asker", "query_id")
    return merged.select("query_id", F.posexplode("hits").alias("pos", "hit")).select(
        "query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), (-F.col("hit.less")).alias("score")
    )


def measured_orders(
    placed, asked, count, length, k, curves, directions, blocks, block_of, wanted, block_rows
) -> tuple[int, int]:
    """How many of the orders are searched, and the blocks to each side of a query's own that find the wanted share of the
    probes' true neighbours in them.

    Probes: the PROBES queries of smallest hash. Their true neighbours come from one pass over all rows; each task
    returns its k best per probe, and the best of all come with their keys."""
    if blocks == 1:
        # one block holds all rows, in every order
        return 1, 0
    probes = asked.orderBy(F.xxhash64("id"), "id").limit(PROBES).toPandas()
    if not len(probes):
        return 1, 0
    vectors, probe_ids, probe_rows = doubles(probes["vec"]), probes["id"].to_numpy(), probes["row"].to_numpy()

    def scan(batches):
        waiting, held = [], 0
        for batch in batches:
            waiting.append(batch)
            held += len(batch)
            # what is left of them is at most half as many
            if held >= 2 * PROBES * k:
                waiting = shrink(waiting)[0].to_batches()
                held = sum(map(len, waiting))
        if held:
            rows, near = shrink(waiting)
            for probe, (at, score) in enumerate(near):
                mine = rows.take(pa.array(at))
                columns = [pa.array(np.full(len(at), probe, dtype=np.int32)), mine["id"], mine["row"], pa.array(-score), mine["keys"]]
                yield from pa.Table.from_arrays(columns, names=["probe", "id", "row", "less", "keys"]).to_batches()

    def shrink(batches):
        """The rows that are near to a probe, ordered by id, and each probe's places and scores among them."""
        rows = pa.Table.from_batches(batches)
        rows = rows.take(pa.array(np.lexsort((rows["row"].to_numpy(), rows["id"].to_numpy()))))
        near = best(vectors, probe_ids, matrix(rows["vec"], length).astype(np.float64), rows["id"].to_numpy(), k)
        kept = np.unique(np.concatenate([at for at, _ in near]))
        return rows.take(pa.array(kept)), [(np.searchsorted(kept, at), score) for at, score in near]

    found = placed.mapInArrow(scan, "probe int, id long, row long, less double, keys array<long>")
    nearest = F.slice(F.array_sort(F.collect_list(F.struct("less", "id", "row", "keys"))), 1, k)
    truth = found.groupBy("probe").agg(nearest.alias("near")).collect()
    keys = curve_keys(vectors, length, curves, directions, BITS)
    steps = []
    for probe, near in truth:
        rows, theirs = np.array([n["row"] for n in near]), np.array([n["keys"] for n in near])
        own = probe_rows[probe : probe + 1]
        steps.append(np.stack([abs(block_of(theirs[:, c], rows, c) - block_of(keys[probe : probe + 1, c], own, c)) for c in range(curves)]))
    if not steps:
        return 1, 0
    steps = np.concatenate(steps, axis=1)
    queries, plans = asked.count(), []
    for orders in range(min(LEAST_CURVES, curves), curves + 1):
        away = np.sort(steps[:orders].min(axis=0))
        reach = int(away[max(0, math.ceil(wanted * len(away)) - 1)])
        visited = ((2 * reach + 1) * blocks - reach * (reach + 1)) / blocks
        # how steps are bundled is left out, so that it does not change what is found
        plans.append((orders * (queries * visited * block_rows + MOVE * (count + queries * visited)), orders, reach))
    return min(plans)[1:]
