"""Table scans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession


def scan(
    spark: SparkSession, base: str, name: str, where: Column | None = None, columns: list[str] | None = None
) -> DataFrame:
    """Parquet scan; plain predicates and the column list reach the reader."""
    path = base.rstrip("/")
    df = spark.read.parquet(f"{path}/{name}.parquet")
    if where is not None:
        df = df.where(where)
    return df.select(*columns) if columns else df


def scan_database(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str],
    split_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    splits: int = 64,
) -> DataFrame:
    """The same scan against a JDBC source, read in parallel ranges of `split_column`."""
    if split_column is None:
        return spark.read.jdbc(url, table, properties=properties)
    low, high = bounds
    return spark.read.jdbc(
        url, table, column=split_column, lowerBound=low, upperBound=high, numPartitions=splits, properties=properties
    )
