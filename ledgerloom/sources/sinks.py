"""Result writers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DELIMITER = "~"


def report_line(columns: list[str], sep: str = DELIMITER) -> Column:
    """One delimited line; a NULL column leaves its place empty."""
    return F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])


def write_delimited(df: DataFrame, columns: Mapping[str, str], path: str, sep: str = DELIMITER) -> None:
    """Report file with fixed titles, `columns` maps column -> title. Parts are written in parallel, each with
    the header row; columns are cast to string so that titles may repeat."""
    positions = [f"c{i}" for i in range(len(columns))]
    body = df.select(*[F.col(c).cast("string").alias(p) for c, p in zip(columns, positions)]).select(
        report_line(positions, sep).alias(sep.join(columns.values()))
    )
    # one column holding the finished line: quoting is off, the header row is the column name
    body.write.mode("overwrite").option("header", True).option("quote", "").option("sep", "\u0001").option(
        "emptyValue", ""
    ).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def write_run(df: DataFrame, path: str, partition: str = "request_id") -> None:
    """Replace exactly the partitions present in `df` (a rerun of a request changes nothing else)."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)


def append_run(df: DataFrame, path: str, partition: str = "request_id") -> None:
    df.write.mode("append").partitionBy(partition).parquet(path)
