"""Date helpers. Times carry no zone: every literal and column is TIMESTAMP_NTZ."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def at(moment: datetime) -> Column:
    return F.lit(moment.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def midnight(moment: datetime) -> datetime:
    return moment.replace(hour=0, minute=0, second=0, microsecond=0)


def day_range(start: datetime | None, end: datetime | None, run_ts: datetime) -> tuple[datetime, datetime]:
    """Whole days, half open: yesterday 00:00 up to and including today unless given."""
    first = midnight(start if start is not None else run_ts - timedelta(days=1))
    last = midnight(end if end is not None else run_ts) + timedelta(days=1)
    return first, last


def within_days(column: Column, start: datetime, end: datetime) -> Column:
    return (column >= at(start)) & (column < at(end))


def effective_at(start: Column, end: Column, moment: datetime) -> Column:
    """A row is in force at `moment`; an open end never expires."""
    return (start <= at(moment)) & (end.isNull() | (end >= at(moment)))


def stamp(column: Column) -> Column:
    """31-DEC-2020 23:59:59"""
    return F.upper(F.date_format(column, "dd-MMM-yyyy HH:mm:ss"))


def iso_day(column: Column) -> Column:
    return F.date_format(column, "yyyy-MM-dd")


def two_digit_year_date(text: Column, run_year: int) -> Column:
    """Parse 07-MAR-85 with the century pivot at 50 relative to the century of the run."""
    century = run_year - run_year % 100
    low, high = (century, century - 100) if run_year % 100 < 50 else (century + 100, century)
    parts = F.split(F.trim(text), "-")
    year = F.get(parts, F.lit(2)).try_cast("int")
    full = F.when(year < 50, year + low).otherwise(year + high)
    return F.try_to_timestamp(
        F.concat_ws("-", F.lpad(F.get(parts, F.lit(0)), 2, "0"), F.initcap(F.get(parts, F.lit(1))), full.cast("string")),
        F.lit("dd-MMM-yyyy"),
    ).cast("date")
