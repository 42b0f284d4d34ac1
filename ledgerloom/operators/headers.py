"""Document headers: build, surrogate keys, supersede, addresses, place of supply, movement type."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.moments import iso_day
from ledgerloom.functions.text import decode
from ledgerloom.operators.lookups import translate
from ledgerloom.operators.spread import number_placed, number_rows

HEADER_COLUMNS = (
    "supplier_gstin supplier_legal_name supplier_location_id sez_unit recipient_gstin recipient_location_id "
    "recipient_phone_num recipient_email recipient_poc_name recipient_pan ship_to_legal_name ship_to_location_id "
    "dispatch_location_id document_num document_type_code document_id customer_type_code cust_id "
    "preceding_doc_num shipment_id shipment_num batch_id org_id owning_organization_id transfer_organization_id "
    "line_of_business"
).split()

LOCATION_ATTRIBUTES = (
    "address1 address2 place state_number state_code state_name pincode country_code description"
).split()

# document kinds and their eligibility (fixed values)
CHALLAN, INTER_STATE, TRANSIT = "DTP Intra-state", "DTP Inter-state", "Intransit"


def build_headers(stage: DataFrame, request_id: int | None, columns: Sequence[str] | None = None) -> DataFrame:
    """Distinct document-grain projection of the staging rows; the distinct undoes the line and tax fan-out
    (map-side first). Challans are not eligible, every other kind is."""
    columns = [c for c in (columns or HEADER_COLUMNS) if c in stage.columns]
    dates = {"document_date": iso_day(F.col("document_date"))}
    if "preceding_doc_date" in stage.columns:
        dates["preceding_doc_date"] = iso_day(F.col("preceding_doc_date"))
    headers = stage.select(
        *columns, *[c.alias(n) for n, c in dates.items()], F.col("query_type").alias("invoice_process")
    ).distinct()
    added = {
        "eligible_flag": F.when(F.col("invoice_process") == CHALLAN, "N").otherwise("Y"),
        "mail_sent": F.lit("N"),
        "status_code": F.lit("PENDING"),
        "status_message": F.lit(None).cast("string"),
        "supply_type_code": F.lit(None).cast("string"),
    }
    if request_id is not None:
        added["request_id"] = F.lit(request_id)
    return headers.withColumns(added)


def assign_ids(
    df: DataFrame, start: int, order_by: Sequence[str], into: str = "transaction_id", placed: bool = False
) -> DataFrame:
    """Surrogate key continuing after a high-water mark (`start` is the first id given). `placed`: the rows lie by the one
    column of the order, and stay there."""
    if placed:
        (key,) = order_by
        return number_placed(df, key, into, start)
    return number_rows(df, order_by, into, start=start)


def supersede(history: DataFrame, current: DataFrame, keys: Mapping[str, object]) -> DataFrame:
    """Failed rows of earlier runs that the current run has extracted again become RE-EXTRACTED.

    `keys` maps key column -> stand-in for NULL; a NULL key equals NULL and equals the stand-in. The result is the full
    new state; `superseded_rows` gives the changed rows alone.
    """
    again, on = _extracted_again(current, keys)
    marked = history.join(again.withColumn("_again", F.lit(True)), on, "left")
    return marked.withColumn(
        "status_code",
        F.when((F.col("status_code") == "ERROR") & F.col("_again"), "RE-EXTRACTED").otherwise(F.col("status_code")),
    ).select(*history.columns)


def superseded_rows(history: DataFrame, current: DataFrame, keys: Mapping[str, object]) -> DataFrame:
    """New state of the failed rows that the current run has extracted again, and of no others. The status is tested
    before the join and reaches the scan, so of the history only failed rows move."""
    again, on = _extracted_again(current, keys)
    failed = history.where(F.col("status_code") == "ERROR").join(again, on, "left_semi")
    return failed.withColumn("status_code", F.lit("RE-EXTRACTED"))


def _extracted_again(current: DataFrame, keys: Mapping[str, object]):
    """Distinct keys of the current rows, and the condition of the join to them."""
    def key(name, default):
        column = F.col(name)
        return column if default is None else F.coalesce(column, F.lit(default))

    again = current.select(*[key(n, d).alias(f"_{n}") for n, d in keys.items()]).distinct()
    return again, [key(n, d) == F.col(f"_{n}") for n, d in keys.items()]


def enrich_roles(
    df: DataFrame, locations: DataFrame, roles: Mapping[str, str], attributes: Sequence[str] = LOCATION_ATTRIBUTES
) -> DataFrame:
    """One location dimension joined once per role; attribute `a` of role `r` becomes `r_a`."""
    for role, key in roles.items():
        side = locations.select(
            F.col("location_id").alias("_location"), *[F.col(a).alias(f"{role}_{a}") for a in attributes]
        )
        df = df.join(side, F.col(key) == F.col("_location"), "left").drop("_location")
    return df


ROLES = {
    "supplier": "supplier_location_id",
    "recipient": "recipient_location_id",
    "ship_to": "ship_to_location_id",
    "dispatch_from": "dispatch_location_id",
}


def party_addresses(df: DataFrame, mode: str) -> DataFrame:
    """Names and addresses of the four parties from the role attributes, per document kind. The attributes
    used up here are dropped: beyond 100 columns Spark gives up whole-stage code generation."""
    kind = F.col("invoice_process")
    first = lambda role: F.col(f"{role}_address1")
    second = lambda role: F.col(f"{role}_address2")
    if mode == "receivable":
        recipient_name = F.col("recipient_poc_name")
        recipient_address = F.coalesce(second("recipient"), first("recipient"))
        ship_name = F.col("ship_to_legal_name") if "ship_to_legal_name" in df.columns else F.lit(None).cast("string")
        ship_address = F.coalesce(second("ship_to"), first("ship_to"))
    else:
        is_challan = kind == CHALLAN
        recipient_name = F.when(is_challan, F.col("supplier_legal_name")).otherwise(first("recipient"))
        recipient_address = F.when(is_challan, first("recipient")).otherwise(second("recipient"))
        named = F.coalesce(F.col("ship_to_description"), first("ship_to"))
        ordered = F.coalesce(first("ship_to"), second("ship_to"))
        ship_name = decode(kind, [(TRANSIT, first("ship_to")), (INTER_STATE, named), (CHALLAN, named)])
        ship_address = decode(kind, [(TRANSIT, second("ship_to")), (INTER_STATE, ordered), (CHALLAN, ordered)])
    return df.withColumns(
        {
            "supplier_address": second("supplier"),
            "recipient_legal_name": recipient_name,
            "recipient_address": recipient_address,
            "ship_to_legal_name": ship_name,
            "ship_to_address": ship_address,
            "dispatch_from_address": second("dispatch_from"),
        }
    ).drop(*[f"{role}_{a}" for role in ROLES for a in ("address1", "address2", "description")])


def place_of_supply(df: DataFrame, mode: str) -> DataFrame:
    """State code and number of the place of supply: ship-to for receivables, by document kind for transfers."""
    def choose(attribute: str):
        ship, recipient = F.col(f"ship_to_{attribute}"), F.col(f"recipient_{attribute}")
        if mode == "receivable":
            return ship
        return decode(
            F.col("invoice_process"),
            [(TRANSIT, recipient), (INTER_STATE, F.coalesce(ship, recipient)), (CHALLAN, recipient)],
        )

    return df.withColumns({"pos_state_number": choose("state_number"), "pos_state_code": choose("state_code")})


def movement_type(df: DataFrame, mode: str) -> DataFrame:
    """INTRA or INTER by comparing states; for receivables a SEZ or export customer is always INTER.
    A missing state leaves the type NULL."""
    same = F.col("supplier_state_code") == F.col("pos_state_code")
    chain = F.when(same, "INTRA")
    if mode == "receivable":
        special = F.col("customer_type_code").contains("SEZ") | F.col("customer_type_code").contains("EXP")
        chain = F.when(same & special, "INTER").when(same, "INTRA")
    return df.withColumn(
        "shipment_type", chain.when(F.col("supplier_state_code") != F.col("pos_state_code"), "INTER")
    )


def enrich_headers(headers: DataFrame, locations: DataFrame, lookup: DataFrame, mode: str, missing_type: str = "null") -> DataFrame:
    """Roles, addresses, place of supply, movement type and (receivables) the document type translation."""
    df = party_addresses(enrich_roles(headers, locations, ROLES), mode)
    if mode == "receivable":
        df = translate(
            df, "document_type_code", lookup, "DOCUMENT_TYPES", "document_type_code",
            description="Document Type Code", missing=missing_type,
        )
    return movement_type(place_of_supply(df, mode), mode)
