"""Tax registrations of vendors: reporting codes, missing registrations, type-2 history."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.moments import at, midnight
from ledgerloom.operators.lookups import lookup_rows
from ledgerloom.operators.spread import number_rows

# Fixed values
NO_NUMBER = "PANNOTAVBL"
DEFAULT_PAN_TYPE = "P"
FIRST_DAY = datetime(2017, 7, 1)
REGISTRATION_KEYS = ("party_id", "party_site_id", "org_id")


def reporting_code(
    df: DataFrame, pan: str, lookup: DataFrame, codes: DataFrame, reporting_type_id: int | None, run_ts: datetime
) -> DataFrame:
    """Reporting code of the fourth PAN character through the type list; one without an entry uses that of
    the default type. Entries and codes that have ended by the run, and codes of other reporting types, do not count."""
    in_force = F.coalesce("effective_end", at(run_ts)) >= at(run_ts)
    codes = codes.where(in_force & (F.col("reporting_type_id") == reporting_type_id))
    types = (
        lookup_rows(lookup, "PAN_VENDOR_TYPE")
        .where(in_force)
        .select(F.col("lookup_code").alias("_type"), F.upper("meaning").alias("_name"))
        .join(
            codes.select(F.upper("reporting_code").alias("_name"), F.struct("reporting_code_id", "reporting_code").alias("_c")),
            "_name",
        )
        .groupBy("_type")
        .agg(F.min("_c").alias("_c"))
    )
    default = types.where(F.col("_type") == DEFAULT_PAN_TYPE).agg(F.min("_c")).scalar()
    letter = F.coalesce(F.nullif(F.substring(pan, 4, 1), F.lit("")), F.lit(DEFAULT_PAN_TYPE))
    joined = df.withColumn("_letter", letter).join(types, F.col("_letter") == F.col("_type"), "left")
    return (
        joined.withColumn("_found", F.coalesce(F.col("_c"), default))
        .withColumns(
            {
                "reporting_code_id": F.col("_found.reporting_code_id"),
                "reporting_code": F.col("_found.reporting_code"),
            }
        )
        .drop("_letter", "_type", "_c", "_found")
    )


def missing_registrations(
    requests: DataFrame, registrations: DataFrame, level: str, start_id: int, reporting_type_id: int | None
) -> Mapping[str, DataFrame]:
    """Registrations to create for vendors (`level='party'`) or vendor sites (`level='site'`) without one:
    header, line and, where both reporting ids are known, association. All three come from one keyed frame;
    ids continue at `start_id` in key order."""
    if level == "party":
        keys, kind, site_flag = ["party_id"], "THIRD_PARTY", "N"
        present = registrations.where(F.col("party_site_id").isNull() & (F.col("supplier_flag") == "Y"))
    else:
        keys, kind, site_flag = ["party_id", "party_site_id", "org_id"], "THIRD_PARTY_SITE", "Y"
        present = registrations
    wanted = requests.groupBy(*keys).agg(
        F.min("pan").alias("pan"), F.min(F.struct("reporting_code_id", "reporting_code")).alias("_code")
    )
    missing = wanted.join(present.select(*keys), keys, "left_anti")
    keyed = number_rows(missing, keys, "party_reg_id", start=start_id)
    if level == "party":
        keyed = keyed.withColumns({"party_site_id": F.lit(None).cast("long"), "org_id": F.lit(None).cast("int")})
    header = keyed.select(
        "party_reg_id", F.lit(kind).alias("party_type_code"), F.lit("Y").alias("supplier_flag"),
        F.lit("N").alias("customer_flag"), F.lit(site_flag).alias("site_flag"), "party_id", "party_site_id", "org_id",
    )
    line = keyed.select(
        "party_reg_id", F.lit("REGISTRATIONS").alias("line_context"), F.lit("PAN").alias("registration_type_code"),
        F.coalesce("pan", F.lit(NO_NUMBER)).alias("registration_number"), at(FIRST_DAY).alias("effective_from"),
    )
    association = keyed.where(
        F.col("_code.reporting_code_id").isNotNull() & F.lit(reporting_type_id is not None)
    ).select(
        "party_reg_id", F.lit(reporting_type_id).cast("int").alias("reporting_type_id"),
        F.col("_code.reporting_code_id").alias("reporting_code_id"), F.col("_code.reporting_code").alias("reporting_code"),
        F.lit("THIRD_PARTY").alias("entity_code"),
    )
    return {"header": header, "line": line, "association": association}


def scd2_change(
    registrations: DataFrame, incoming: DataFrame, run_ts: datetime, keys: Sequence[str] = REGISTRATION_KEYS,
    type_code: str = "PAN",
) -> DataFrame:
    """Type-2 history after new numbers came in, registration by registration.

    A registration is told apart by `keys`, of which those that both tables have are used (party, site,
    organisation; NULL at party level). Where its one open number of the type differs from the incoming one,
    that line is closed the day before and a line opens today with the old one's other columns. Registrations
    with no or several open numbers of the type, and lines of other types or registration ids, stay as they are.
    """
    today, yesterday = at(midnight(run_ts)), at(midnight(run_ts) - timedelta(days=1))
    keys = [k for k in keys if k in registrations.columns and k in incoming.columns]
    columns, number = registrations.columns, F.col("registration_number")
    typed = "registration_type_code" in columns
    of_type = F.col("registration_type_code").startswith(type_code) if typed else F.lit(True)
    exact_type = F.coalesce(F.col("registration_type_code") == type_code, F.lit(False)) if typed else F.lit(True)
    current = (
        registrations.where(F.col("effective_to").isNull() & number.isNotNull() & of_type)
        .groupBy(*keys)
        .agg(F.count("*").alias("_open_rows"), F.min(F.struct(*columns)).alias("_old"))
        .where(F.col("_open_rows") == 1)
    )
    arriving = incoming.groupBy(*[F.col(k).alias(f"_of_{k}") for k in keys]).agg(F.min("registration_number").alias("_in"))
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys])
    changed = (
        current.join(arriving, on)
        .withColumn("_new", F.coalesce("_in", F.lit(NO_NUMBER)))
        .where(F.col("_new") != F.col("_old.registration_number"))
        .select("_old", "_new")
    )
    # the lines to close: same registration id and number
    closing = changed.select(
        F.col("_old.reg_id").alias("_reg_id"), F.upper(F.trim("_old.registration_number")).alias("_number")
    ).distinct()
    same = (F.col("reg_id") == F.col("_reg_id")) & (F.upper(F.trim(number)) == F.col("_number"))
    open_line = F.col("effective_to").isNull() & exact_type & F.col("_reg_id").isNotNull()
    closed = registrations.join(closing, same, "left").withColumn(
        "effective_to", F.when(open_line, yesterday).otherwise(F.col("effective_to"))
    )
    news = {
        "registration_number": F.col("_new"), "effective_from": today, "effective_to": F.lit(None).cast("timestamp_ntz"),
        "registration_type_code": F.lit(type_code),
    }
    opened = changed.select(*[news.get(c, F.col(f"_old.{c}")).alias(c) for c in columns])
    return closed.select(*columns).unionByName(opened)
