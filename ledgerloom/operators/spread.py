"""Row numbering and bounded per-group selection that never put a whole group into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.session import cut_buckets, cut_lineage

SALTS = 64


def number_rows(
    df: DataFrame, order_by: Sequence[str], into: str, within: Sequence[str] = (), start: int = 1
) -> DataFrame:
    """Consecutive numbers in the given total order, over the whole frame or within groups.

    Rows are range-partitioned by the order itself, so a large group is cut over many tasks; each slice numbers
    its own rows and gets the count of the rows before it from a table of a few rows per slice. The order has
    to tell rows apart (equal rows stay in one slice). Runs a job to fix the slices.
    """
    keys = list(within)
    sort_columns = keys + [c for c in order_by if c not in keys]
    # the checkpoint fixes which row lies in which slice before the two branches below read it
    placed = cut_lineage(
        df.repartitionByRange(*sort_columns)
        .sortWithinPartitions(*sort_columns)
        .withColumn("_at", F.monotonically_increasing_id())
        .withColumn("_slice", F.shiftright("_at", 33))
    )
    local = (
        F.row_number().over(Window.partitionBy("_slice", *keys).orderBy("_at"))
        if keys
        else F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + F.lit(1)
    )
    placed = placed.withColumn("_local", local)

    counts = placed.groupBy("_slice", *keys).agg(F.count("*").alias("_rows"))
    if keys:
        # only a key that continues into a later slice carries anything: at most one such key per slice
        counts = counts.withColumn("_slices", F.count("*").over(Window.partitionBy(*keys))).where("_slices > 1")
    order = Window.partitionBy(*keys).orderBy("_slice") if keys else Window.orderBy("_slice")
    before = F.sum("_rows").over(order.rowsBetween(Window.unboundedPreceding, -1))
    carried = counts.select(
        F.col("_slice").alias("_of_slice"),
        *[F.col(k).alias(f"_of_{k}") for k in keys],
        F.coalesce(before, F.lit(0)).alias("_before"),
    )
    on = F.col("_slice") == F.col("_of_slice")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_of_{k}"))
    number = F.col("_local") + F.coalesce(F.col("_before"), F.lit(0)) + F.lit(start - 1)
    return placed.join(F.broadcast(carried), on, "left").select(*df.columns, number.cast("long").alias(into))


def number_placed(df: DataFrame, key: str, into: str, start: int = 1) -> DataFrame:
    """Consecutive numbers in the order of `key`, by which the rows lie: the keys alone are numbered, the rows stay where they
    are. Rows of one key are numbered in the order of all their columns; those without a key come first."""
    numbers = number_rows(df.select(key), [key], "_first", start=start).groupBy(key).agg(F.min("_first").alias("_first"))
    numbers = cut_buckets(numbers.where(F.col(key).isNotNull()).repartition(key), key)
    place = F.row_number().over(Window.partitionBy(key).orderBy(*[c for c in df.columns if c != key]))
    number = F.coalesce("_first", F.lit(start)) + place - F.lit(1)
    return df.join(numbers, key, "left").select(*df.columns, number.cast("long").alias(into))


def join_placed(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal `keys`, of which the first alone places the rows, so a side that already lies by it does not move. The
    other keys are compared as a range of one value: an equality would become a further key of the exchange."""
    first, *rest = keys
    if not rest:
        return left.join(right, first, how)
    on = F.col(first) == F.col(f"_of_{first}")
    for k in rest:
        on = on & F.col(k).between(F.col(f"_of_{k}"), F.col(f"_of_{k}"))
    joined = left.join(right.withColumnsRenamed({k: f"_of_{k}" for k in keys}), on, how)
    return joined.drop(*[f"_of_{k}" for k in keys])


def join_where_placed(df: DataFrame, side: DataFrame, keys: Sequence[str], placed: str, written: DataFrame | None = None) -> DataFrame:
    """Inner join on `keys` of rows that lie by the column `placed`, which none lacks: its values move with the keys to the other
    side and come back with what they found there; the rows themselves stay where they are. `written`: a written table that has
    these values and keys, if the rows themselves come out of further joins."""
    ids = (df if written is None else written).select(placed, *keys).distinct()
    return df.join(ids.join(side, list(keys)).repartition(placed), [placed, *keys])


def spread_nulls(df: DataFrame, column: str, into: str, slots: int = SALTS) -> DataFrame:
    """String join key whose NULLs are replaced by `slots` values that match nothing, so that a left join
    does not send all rows without a key to one task."""
    filler = F.concat(F.lit("\u0000"), F.pmod(F.spark_partition_id(), F.lit(slots)).cast("string"))
    return df.withColumn(into, F.coalesce(F.col(column), filler))


def first_rows(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str], k: int, salts: int | None = None
) -> DataFrame:
    """The first k rows of each group in the given order, selected in two levels.

    Level one keeps k rows of each (group, salt), so a dominant group is worked on by `salts` tasks (as many as
    there are shuffle partitions, unless given);
    level two sees at most salts * k rows of a group. Exact: a row outside the first k of its own salt
    cannot be among the first k of the group.
    """
    salts = salts or max(SALTS, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # content and partition together: copies of one row are spread as well, and a retried task salts alike
    content = F.pmod(F.xxhash64(*df.columns), F.lit(salts))
    salted = df.withColumn("_salt", F.pmod(content + F.spark_partition_id(), F.lit(salts)))
    inner = F.row_number().over(Window.partitionBy(*keys, "_salt").orderBy(*order_by))
    outer = F.row_number().over(Window.partitionBy(*keys).orderBy(*order_by))
    return (
        salted.withColumn("_rank", inner)
        .where(F.col("_rank") <= k)
        .withColumn("_rank", outer)
        .where(F.col("_rank") <= k)
        .drop("_salt", "_rank")
    )
