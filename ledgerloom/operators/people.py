"""New-hire staging: candidates, matches to existing people, number collisions, code standardisation."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.moments import at, midnight, two_digit_year_date
from ledgerloom.functions.text import cat
from ledgerloom.operators.lookups import lookup_rows, translate


def _validated(stage: DataFrame, flow: int | str) -> Column:
    return (F.col("flow_id") == flow) & (F.col("process_flag") == "V") & (F.col("worker_type") == "Employee")


def new_hires(stage: DataFrame, people: DataFrame, flow: int | str) -> DataFrame:
    """Validated active employees of a flow whose number is not in the people table."""
    return stage.where(_validated(stage, flow) & F.col("emp_status").startswith("Active")).join(
        people.select("employee_number"), "employee_number", "left_anti"
    )


def match_existing(stage: DataFrame, people: DataFrame, assign: DataFrame, flow: int | str, run_ts: datetime) -> DataFrame:
    """Person and assignment id of validated employees that exist already.

    Of several assignments in force today the lowest (person, assignment) is taken, by an aggregate that
    combines before the shuffle. Only the assignment's dates are checked.
    """
    today = at(midnight(run_ts))
    current = assign.where(
        (F.date_trunc("day", "effective_start").cast("timestamp_ntz") <= today)
        & (F.date_trunc("day", "effective_end").cast("timestamp_ntz") >= today)
    ).groupBy("person_id").agg(F.min("assignment_id").alias("assignment_id"))
    numbered = (
        people.where(F.col("employee_number").isNotNull())
        .select("employee_number", "person_id")
        .distinct()
        .join(current, "person_id", "left")
        .groupBy("employee_number")
        .agg(
            F.min(F.when(F.col("assignment_id").isNotNull(), F.struct("person_id", "assignment_id"))).alias("_found")
        )
    )
    joined = stage.join(numbered, "employee_number", "left")
    hit = _validated(stage, flow) & F.col("_found").isNotNull()
    return joined.withColumns(
        {
            "person_id": F.when(hit, F.col("_found.person_id")),
            "assignment_id": F.when(hit, F.col("_found.assignment_id")),
        }
    ).drop("_found")


def resolve_number(stage: DataFrame, people: DataFrame, suffix: str = "-1") -> DataFrame:
    """A number held by a contingent worker gets a suffix; the staging number stays as the key."""
    held = people.where(F.col("npw_number").isNotNull()).select(F.col("npw_number").alias("_held")).distinct()
    joined = stage.join(held, F.col("employee_number") == F.col("_held"), "left")
    return joined.withColumn(
        "new_number",
        F.when(F.col("_held").isNotNull(), cat(F.col("employee_number"), suffix)).otherwise(F.col("employee_number")),
    ).drop("_held")


RESIDENT = "Resident and ordinarily resident"


def _code_of(lookup: DataFrame, lookup_type: str, meaning: str) -> Column:
    rows = lookup_rows(lookup, lookup_type, enabled_only=False).where(F.col("meaning") == meaning)
    return rows.agg(F.min("lookup_code")).scalar()


def standardise(stage: DataFrame, lookup: DataFrame, run_year: int, resident_meaning: str = RESIDENT) -> DataFrame:
    """Gender and title by case-insensitive lookup, mail type and residency with defaults, birth date parsed.

    Both mail answers lead to the office entry of the list, as in the source job.
    """
    df = translate(stage, "gender", lookup, "SEX", "gender_code", match_on="meaning", give="lookup_code", ignore_case=True, enabled_only=False)
    df = translate(df, "title", lookup, "TITLE", "title_code", match_on="lookup_code", give="lookup_code", ignore_case=True, enabled_only=False)
    # one answer for all rows: scalar subqueries, no join
    office = _code_of(lookup, "HOME_OFFICE", "Office")
    resident = _code_of(lookup, "RESIDENTIAL_STATUS", resident_meaning)
    return df.withColumns(
        {
            "mail_code": F.coalesce(office, F.lit("O")),
            "residency_code": F.coalesce(resident, F.lit("RO")),
            "birth_date": two_digit_year_date(F.col("dob"), run_year),
        }
    )
