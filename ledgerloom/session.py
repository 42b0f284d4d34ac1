"""Run context, session settings and lineage cutting."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the operators count on. Skewed join partitions are split by AQE even when the split
# costs one more exchange; broadcasts are chosen by Spark from measured sizes only.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}

# whether the sides of a join have to lie by all its columns, or may lie by some of them
PLACED_BY_ALL = "spark.sql.requireAllClusterKeysForCoPartition"


@dataclass(frozen=True)
class RunContext:
    """One run: every operator that needs "now", the request or the user takes it from here."""

    run_ts: datetime
    request_id: int
    user: str = "batch"
    session_id: int = 0


def tune(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder the session names in spark.checkpoint.dir; a private one only in local mode."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="run-")
            atexit.register(shutil.rmtree, folder, ignore_errors=True)
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


_OWNED: ContextVar[str | None] = ContextVar("scratch folder of the run", default=None)


@contextmanager
def scratch(spark: SparkSession, folder: str | None = None) -> Iterator[str]:
    """All intermediate tables written inside go to one new folder, below `folder` or the shared one, and go with it at the
    end, also after a failure. Results have to be written elsewhere before the end; scratches may be nested."""
    path = f"{(folder or shared_folder(spark)).rstrip('/')}/{uuid.uuid4().hex}"
    token = _OWNED.set(path)
    try:
        yield path
    finally:
        _OWNED.reset(token)
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def fresh_path(spark: SparkSession) -> str:
    """A path in the scratch folder of the run, else in the shared folder, that nothing uses yet."""
    return f"{_OWNED.get() or shared_folder(spark)}/{uuid.uuid4().hex}"


@contextmanager
def placed_by_some(spark: SparkSession) -> Iterator[None]:
    """Inside, rows that lie by some of the columns of a join stay where they are."""
    before = spark.conf.get(PLACED_BY_ALL, "true")
    spark.conf.set(PLACED_BY_ALL, "false")
    try:
        yield
    finally:
        spark.conf.set(PLACED_BY_ALL, before)


def cut_buckets(df: DataFrame, *keys: str) -> DataFrame:
    """As `cut_lineage`, but the rows stay together by the hash of `keys`: groupings by these and further columns, and joins
    on them, read the table without a shuffle. Rows that come out of a join on the keys are written where they lie. While they
    are written, rows that lie by some of the columns of a join stay where they are."""
    spark = df.sparkSession
    path, name = fresh_path(spark), f"kept_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with placed_by_some(spark):
        df.write.bucketBy(buckets, *keys).option("path", path).option("compression", "zstd").saveAsTable(name)
    return spark.table(name)


def cut_placed(df: DataFrame) -> DataFrame:
    """As `cut_lineage`, but while the rows are written, those that lie by some of the columns of a join stay where they are."""
    with placed_by_some(df.sparkSession):
        return cut_lineage(df)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the rows once as a columnar table in the shared folder and go on from there.

    Survives lost executors, stops recomputation by several consumers, and gives the optimizer real sizes and
    column pruning, which an RDD checkpoint does not. Runs a job.
    """
    path = fresh_path(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
