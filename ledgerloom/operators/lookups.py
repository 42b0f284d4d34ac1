"""Code lists, keyed attributes and effective-dated flags.

Code lists are grouped to one row per key before joining, so a join can never multiply rows. Whether a
dimension is broadcast is left to Spark, which knows its size (plan statistics and AQE).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.moments import effective_at


def lookup_rows(
    lookup: DataFrame, lookup_type: str, description: str | None = None, enabled_only: bool = True
) -> DataFrame:
    rows = lookup.where(F.col("lookup_type") == lookup_type)
    if description is not None:
        rows = rows.where(F.col("description") == description)
    return rows.where(F.col("enabled_flag") == "Y") if enabled_only else rows


def translate(
    df: DataFrame,
    column: str,
    lookup: DataFrame,
    lookup_type: str,
    into: str,
    description: str | None = None,
    match_on: str = "lookup_code",
    give: str = "meaning",
    ignore_case: bool = False,
    missing: str = "null",
    enabled_only: bool = True,
) -> DataFrame:
    """Code translation; a code without an enabled entry becomes NULL (or is kept, `missing='keep'`)."""
    fold = F.upper if ignore_case else (lambda c: c)
    codes = (
        lookup_rows(lookup, lookup_type, description, enabled_only)
        .groupBy(fold(F.col(match_on)).alias("_lookup_key"))
        .agg(F.min(give).alias("_lookup_value"))
    )
    joined = df.join(codes, fold(F.col(column)) == F.col("_lookup_key"), "left")
    value = F.col("_lookup_value") if missing == "null" else F.coalesce(F.col("_lookup_value"), F.col(column))
    return joined.withColumn(into, value).drop("_lookup_key", "_lookup_value")


def membership(
    df: DataFrame,
    column: str,
    lookup: DataFrame,
    lookup_type: str,
    flags: Mapping[str, Column],
    key: Column,
) -> DataFrame:
    """Flags telling in which parts of a code list a column's value occurs; one join for all flags.

    `flags` maps flag name -> condition over the code list. A value in no part gets false; the flags of a
    NULL value are NULL, as `NULL in (...)` is unknown.
    """
    codes = (
        lookup.where((F.col("lookup_type") == lookup_type) & key.isNotNull())
        .groupBy(key.alias("_code"))
        .agg(*[F.coalesce(F.bool_or(cond), F.lit(False)).alias(name) for name, cond in flags.items()])
    )
    joined = df.join(codes, F.col(column) == F.col("_code"), "left").drop("_code")
    return joined.withColumns(
        {n: F.when(F.col(column).isNotNull(), F.coalesce(F.col(n), F.lit(False))) for n in flags}
    )


def attach_attributes(
    df: DataFrame, dim: DataFrame, key: str, columns: Mapping[str, str], dim_key: str, placed: str | None = None,
    written: DataFrame | None = None,
) -> DataFrame:
    """Attributes of an entity by id; `columns` maps dimension column -> result column. `placed`: a column that the rows lie
    by, and that none lacks; then only its values and the ids move, and the rows themselves stay where they are. `written`: a
    written table that has these values and ids, if the rows themselves come out of further joins."""
    side = dim.select(F.col(dim_key).alias("_id"), *[F.col(c).alias(n) for c, n in columns.items()])
    if placed is not None:
        ids = (df if written is None else written).select(placed, F.col(key).alias("_id")).where(F.col("_id").isNotNull()).distinct()
        found = ids.join(side, "_id").withColumnRenamed("_id", key).repartition(placed)
        return df.join(found, [placed, key], "left").select(*df.columns, *columns.values())
    return df.join(side, F.col(key) == F.col("_id"), "left").drop("_id")


def effective_flags(
    df: DataFrame,
    dim: DataFrame,
    key: str,
    dim_key: str,
    flags: Mapping[str, tuple[str, Sequence[str]]],
    run_ts: datetime,
    start: str = "effective_start",
    end: str = "effective_end",
) -> DataFrame:
    """Does a row in force at `run_ts` carry one of the given values? One flag column per entry of `flags`
    (name -> (dimension column, values)); rows without any are false. The range test is against a literal,
    so it filters the dimension before an equi join."""
    current = (
        dim.where(effective_at(F.col(start), F.col(end), run_ts))
        .groupBy(F.col(dim_key).alias("_key"))
        .agg(*[F.bool_or(F.col(c).isin(*values)).alias(n) for n, (c, values) in flags.items()])
    )
    joined = df.join(current, F.col(key) == F.col("_key"), "left").drop("_key")
    return joined.withColumns({n: F.coalesce(F.col(n), F.lit(False)) for n in flags})


def check_code(
    df: DataFrame, column: str, lookup: DataFrame, lookup_type: str, description: str | None = None
) -> DataFrame:
    """Rows whose parameter is an enabled code of the list."""
    codes = lookup_rows(lookup, lookup_type, description).select(F.col("lookup_code").alias("_code"))
    return df.join(codes, F.col(column) == F.col("_code"), "left_semi")
