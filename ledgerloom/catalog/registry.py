"""Registration of queries with their checks."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.plans.inputs import Inputs, check_sql
from ledgerloom.session import RunContext, tune

# stands in for the current time in every registered query
RUN_TS = datetime(2001, 8, 1)
RUN = RunContext(RUN_TS, request_id=2, user="batch", session_id=7)
NOW = "timestamp '2001-08-01 00:00:00'"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(name: str, views: Sequence[str] = (), sql: str | None = None):
    def register(build: Callable[[Inputs], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(Inputs(tune(spark), folder))

        QUERIES[name] = run
        if sql is not None:
            CHECKS[name] = check_sql(list(views), sql)
        return build

    return register


def doubles(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def day_text(column: str):
    return F.date_format(F.col(column), "yyyy-MM-dd HH:mm:ss").alias(column)
