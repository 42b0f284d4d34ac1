"""Orphan receipt headers and their audited removal."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.moments import at
from ledgerloom.operators.staging import with_audit
from ledgerloom.session import RunContext


def find_orphans(
    headers: DataFrame,
    lines: DataFrame,
    transactions: DataFrame,
    interface: DataFrame,
    days: int,
    run_ts: datetime,
    key: str = "header_id",
    created: str = "creation_date",
) -> DataFrame:
    """Headers without lines and transactions that are stuck (failed and nothing open in the interface) or
    old (nothing in the interface at all). The interface is reduced to flags once; a branch per EXISTS
    would cost one join each."""
    flags = interface.groupBy(key).agg(
        F.bool_or(F.col("processing_status").isin("RUNNING", "PENDING")).alias("_open"),
        F.bool_or((F.col("processing_status") == "ERROR") | (F.col("transaction_status") == "ERROR")).alias("_failed"),
        F.lit(True).alias("_any"),
    )
    bare = headers.join(lines, key, "left_anti").join(transactions, key, "left_anti")
    stuck = F.col("_any") & ~F.coalesce("_open", F.lit(False)) & F.coalesce("_failed", F.lit(False))
    old = F.col("_any").isNull() & (F.col(created) < at(run_ts - timedelta(days=days)))
    return (
        bare.join(flags, key, "left")
        .where(F.coalesce(stuck, F.lit(False)) | old)
        .select(*headers.columns)
    )


def purge_with_audit(
    df: DataFrame, victims: DataFrame, keys: Sequence[str], run: RunContext
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(kept rows, log rows with audit columns, one-row check that logged + kept = input)."""
    keys = list(keys)
    doomed = victims.select(*keys).distinct()
    log = with_audit(df.join(doomed, keys, "left_semi"), run)
    kept = df.join(doomed, keys, "left_anti")
    return kept, log, purge_check(df, kept, log)


def purge_check(df: DataFrame, kept: DataFrame, log: DataFrame) -> DataFrame:
    sides = {"input_rows": df, "kept_rows": kept, "logged_rows": log}
    counted = None
    for name, side in sides.items():
        one = side.agg(F.count("*").alias("_n")).select(
            *[(F.col("_n") if n == name else F.lit(0).cast("long")).alias(n) for n in sides]
        )
        counted = one if counted is None else counted.unionByName(one)
    return counted.agg(*[F.sum(n).alias(n) for n in sides]).withColumn(
        "agrees", F.col("input_rows") - F.col("kept_rows") == F.col("logged_rows")
    )
