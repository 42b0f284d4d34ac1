"""Tables kept as one folder per partition value, changed by rewriting only the partitions that hold changed rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


@dataclass(frozen=True)
class StoredTable:
    """A parquet table partitioned by one column. Its rows are read with a fixed schema, so values of the partition column
    keep their type, and a filter on that column prunes folders."""

    spark: SparkSession
    path: str
    schema: StructType
    partition: str

    @classmethod
    def create(cls, df: DataFrame, path: str, partition: str) -> StoredTable:
        table = cls(df.sparkSession, path, df.schema, partition)
        table._write(df, "error")
        return table

    def _write(self, df: DataFrame, mode: str) -> None:
        # a large partition is cut into several files, small ones of a task end in one
        spread = df.select(*self.schema.names).hint("rebalance", F.col(self.partition))
        spread.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(self.partition).parquet(self.path)

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path).select(*self.schema.names)

    def append(self, df: DataFrame) -> None:
        self._write(df, "append")

    def replace(self, df: DataFrame) -> None:
        """Put the rows in place of exactly the partitions that they belong to."""
        self._write(df, "overwrite")

    def rewrite(self, hits: DataFrame, update: Callable[[DataFrame], DataFrame]) -> list[object]:
        """Apply `update` to the partitions that `hits` names (a frame with the partition column; its other columns are not
        read) and put the result in their place; all other folders stay as they are. `update` must not move rows to another
        partition. Returns the values of the rewritten partitions: at most one per folder of the table.

        The new files are complete before the old ones go, so a run that fails before has changed nothing, and one that is
        repeated rewrites the same partitions with the same rows."""
        values = sorted((r[0] for r in hits.select(self.partition).distinct().collect()), key=lambda v: (v is not None, v))
        if not values:
            return []
        given = [v for v in values if v is not None]
        inside = F.col(self.partition).isin(given) if given else F.lit(False)
        if len(given) < len(values):
            inside = inside | F.col(self.partition).isNull()
        self._write(update(self.read().where(inside)), "overwrite")
        return values
