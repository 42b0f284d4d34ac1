"""Small helpers of the operators in this package."""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.session import cut_lineage, shared_folder, tune

#: Rows in one Arrow batch handed to Python. Texts may be long, so batches are short.
BATCH_ROWS = 256
#: Bytes of text that Python code works on at once; a longer single text is a piece of its own.
PIECE_BYTES = 4 << 20


def prepared(spark: SparkSession) -> SparkSession:
    """The session with the settings that the operators count on."""
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of the data folder, with the session set up for the operators."""
    return prepared(spark).read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def written(df: DataFrame) -> DataFrame:
    """Rows written once to the shared folder and read back from there."""
    return cut_lineage(df)


def fresh_folder(spark: SparkSession) -> str:
    """A path in the shared folder that nothing uses yet."""
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"


def per_process(key: object, build: Callable[[], object]) -> object:
    """A value built once per Python process. Workers outlive their tasks; modules shipped with a task do not."""
    store = sys.modules.setdefault("_llm_worker_values", types.ModuleType("_llm_worker_values")).__dict__
    if key not in store:
        store[key] = build()
    return store[key]


def pieces(texts: Sequence[str], most: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about `most` characters in all."""
    start, size = 0, 0
    for k, text in enumerate(texts):
        if size and size + len(text) > most:
            yield start, k
            start, size = k, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def crc_fold(column: str, folds: int):
    """crc32 of the number written as text, modulo `folds`; NULL stays NULL."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % folds
