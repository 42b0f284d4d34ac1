"""Employees as vendors: requests, request plan, site addresses, account strings."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.moments import at, midnight
from ledgerloom.functions.text import cat, decode
from ledgerloom.operators.lookups import attach_attributes

# Vendor sites, and the account columns of each
SITES = ("OFFICE", "HOME", "PROVISIONAL")
SITE_COLUMNS = {"OFFICE": "office", "HOME": "home", "PROVISIONAL": "prov"}


def in_force_today(df: DataFrame, run_ts: datetime) -> DataFrame:
    today = at(midnight(run_ts))
    return df.where((F.col("effective_start") <= today) & (F.coalesce(F.col("effective_end"), at(run_ts)) >= today))


def vendor_requests(
    people: DataFrame,
    assign: DataFrame,
    account_map: DataFrame,
    vendors: DataFrame,
    queue: DataFrame,
    default_unit: tuple[str, int],
    run_ts: datetime,
    request_id: int,
    name_style: str = "number-name",
    employees_only: bool = False,
) -> DataFrame:
    """One request per employee, operating unit and site that has an account for the employee's legal entity.

    Units are the mapped one and the default one; sites are exploded from the mapping row, so the six
    branches of the source statement are one join and one distinct. `name_style='as_is'` gives employees the
    bare number as name, as the source does; `employees_only` is the older form of the job.
    """
    default_name, default_org = default_unit
    mapped = account_map.where(
        (F.col("enabled_flag") == "Y") & (F.coalesce(F.col("effective_end"), at(run_ts)) >= at(run_ts))
    )
    sites = F.array(
        *[F.struct(F.lit(s).alias("site"), F.col(f"{SITE_COLUMNS[s]}_prepay").alias("account")) for s in SITES]
    )
    units = F.array(
        F.struct(F.col("operating_unit").alias("unit"), F.col("org_id").cast("int").alias("org_id"), F.lit(False).alias("is_default")),
        F.struct(F.lit(default_name).alias("unit"), F.lit(default_org).alias("org_id"), F.lit(True).alias("is_default")),
    )
    targets = (
        mapped.select("legal_entity", units.alias("_units"), sites.alias("_sites"))
        .select("legal_entity", F.explode("_units").alias("_u"), "_sites")
        .where(F.col("_u.is_default") | (F.col("_u.unit") != default_name))
        .select("legal_entity", F.col("_u.unit").alias("operating_unit"), F.col("_u.org_id").alias("org_id"), F.explode("_sites").alias("_s"))
        .where(F.col("_s.account").isNotNull())
        .select("legal_entity", "operating_unit", "org_id", F.col("_s.site").alias("vendor_site_code"))
        .distinct()
    )
    flag = F.col("current_employee_flag") if employees_only else F.coalesce("current_employee_flag", "current_npw_flag")
    candidates = (
        in_force_today(people, run_ts)
        .where(flag == "Y")
        .join(vendors.select(F.col("employee_id").alias("person_id")), "person_id", "left_anti")
        .join(queue.select(F.col("employee_id").alias("person_id")), "person_id", "left_anti")
    )
    employed = in_force_today(assign, run_ts).where(F.col("legal_entity").isNotNull()).select("person_id", "legal_entity").distinct()
    number = F.col("employee_number") if employees_only else F.coalesce("employee_number", "npw_number")
    long_name = cat(number, "-", F.col("full_name"))
    if name_style == "as_is" and not employees_only:
        long_name = F.coalesce(F.col("employee_number"), cat(F.col("npw_number"), "-", F.col("full_name")))
    return (
        candidates.join(employed, "person_id")
        .join(targets, "legal_entity")
        .select(
            F.lit(request_id).alias("request_id"),
            F.col("person_id").alias("employee_id"),
            number.alias("employee_number"),
            F.col("full_name").alias("employee_name"),
            "legal_entity",
            F.coalesce("current_employee_flag", F.lit("C")).alias("current_employee_flag"),
            "operating_unit",
            "org_id",
            long_name.alias("vendor_name"),
            F.col("full_name").alias("vendor_name_alt"),
            cat("E", number).alias("vendor_code"),
            "vendor_site_code",
            "email_address",
            "pan",
            F.lit("N").alias("process_flag"),
        )
        .distinct()
    )


def plan_vendors(queue: DataFrame, vendors: DataFrame, request_id: int) -> DataFrame:
    """What each waiting request asks of the vendor service: reuse a vendor of the same code and name, create
    one (the first request of that code and name), or only add a site to the one just created. The first
    request comes from an aggregate, so no group of requests is sorted in one task."""
    waiting = queue.where((F.col("process_flag") == "N") & (F.col("request_id") == request_id))
    known = vendors.groupBy("vendor_code", "vendor_name").agg(F.min("vendor_id").alias("_vendor_id"))
    order = F.struct("employee_id", "org_id", "vendor_site_code")
    first = waiting.groupBy("vendor_code", "vendor_name").agg(F.min(order).alias("_first"))
    joined = waiting.join(known, ["vendor_code", "vendor_name"], "left").join(first, ["vendor_code", "vendor_name"])
    action = (
        F.when(F.col("vendor_id").isNotNull() | F.col("vendor_site_id").isNotNull(), "REGISTER")
        .when(F.col("_vendor_id").isNotNull(), "REUSE")
        .when(order == F.col("_first"), "CREATE")
        .otherwise("ADD_SITE")
    )
    return joined.withColumns(
        {"action": action, "known_vendor_id": F.coalesce("vendor_id", "_vendor_id")}
    ).drop("_vendor_id", "_first")


def site_address(queue: DataFrame, organisations: DataFrame, locations: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Address of the organisation's location; none leaves NULLs."""
    located = attach_attributes(queue, organisations, "org_id", {"location_id": "_at"}, "organization_id")
    return attach_attributes(located, locations, "_at", columns, "location_id").drop("_at")


SEGMENTS_BEFORE = ("segment1", "segment2")
SEGMENTS_AFTER = tuple(f"segment{i}" for i in range(4, 10))


def account_string(
    queue: DataFrame, segments: DataFrame, account_map: DataFrame, default_unit: str, kind: str
) -> DataFrame:
    """Account segments of the unit joined by dots, the third replaced by the site's code.

    The code is mapped by (unit, legal entity); the default unit falls back to its first mapping row (lowest
    legal entity). A NULL segment is empty; no mapping gives NULL. `kind` is `liab` or `prepay`.
    """
    codes = {s: f"{SITE_COLUMNS[s]}_{kind}" for s in SITES}
    exact = account_map.groupBy("org_id", "legal_entity").agg(
        F.lit(True).alias("_mapped"), *[F.min(c).alias(f"_e_{c}") for c in codes.values()]
    )
    fallback = (
        account_map.where(F.col("operating_unit") == default_unit)
        .groupBy("org_id")
        .agg(F.min_by(F.struct(*codes.values()), "legal_entity").alias("_f"))
    )
    joined = (
        queue.join(segments, "org_id", "left")
        .join(exact, ["org_id", "legal_entity"], "left")
        .join(fallback, "org_id", "left")
    )
    site = F.col("vendor_site_code")
    code = F.when(F.col("_mapped"), decode(site, [(s, F.col(f"_e_{c}")) for s, c in codes.items()])).otherwise(
        decode(site, [(s, F.col("_f")[c]) for s, c in codes.items()])
    )
    parts = [F.col(s) for s in SEGMENTS_BEFORE] + [code] + [F.col(s) for s in SEGMENTS_AFTER]
    dotted = [parts[0]]
    for p in parts[1:]:
        dotted += [F.lit("."), p]
    usable = F.col("segment_set").isNotNull() & (F.col("_mapped") | F.col("_f").isNotNull())
    return joined.withColumn(f"{kind}_account", F.when(usable, F.concat_ws("", *dotted))).select(
        *queue.columns, f"{kind}_account"
    )
