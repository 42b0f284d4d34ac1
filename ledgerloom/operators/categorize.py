"""Supply type and eligibility of each document, decided by ordered rules.

The rules read flags that are joined once beforehand: where the customer type occurs in the code list, what
the legal entity is enabled for, and whether the document has a zero tax row.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.text import cat
from ledgerloom.operators.lookups import effective_flags, membership
from ledgerloom.operators.rules import Rule, State, apply_rules

# Stand-ins used for a recipient outside the tax territory, and message texts
UNREGISTERED_RECIPIENT = {
    "recipient_gstin": "URP",
    "recipient_state_number_upd": "96",
    "recipient_state_code_upd": "96",
    "pos_state_number_upd": "96",
    "pos_state_code_upd": "96",
    "recipient_pincode_upd": "999999",
}
HOME_COUNTRY = "IN"
CHALLAN_TEXT = "Extracted as not eligible - delivery challan records"
UNEXPECTED_TYPE_TEXT = "Unexpected customer registration code "
NULL_TYPE_TEXT = "Null customer registration code "
SMALL_ENTITY_TEXT = "LE have revenue less than 500/100 crore INR"
SMALL_ENTITY_B2C_TEXT = "LE have revenue less than 500/100 crore INR(B2C)"
PARTIAL_TEXT = "Though enabled at source but B2B E-Invoicing not enabled in target"
PARTIAL_B2C_TEXT = "Though enabled at source but B2C E-Invoicing not enabled in target"

PENDING = ("PENDING",)

# customer type flags: flag -> description in the code list
TYPE_FLAGS = {
    "is_unregistered": "Unregistered",
    "is_export": "Export Type",
    "is_sez": "SEZ Type",
    "is_regular": "Regular",
}

ENTITY_FLAGS = {
    "le_b2b_any": ("irn_flag", ("Y", "P")),
    "le_b2b_partial": ("irn_flag", ("P",)),
    "le_b2c_any": ("b2c_flag", ("Y", "P")),
    "le_b2c_partial": ("b2c_flag", ("P",)),
}


def customer_type_flags(df: DataFrame, lookup: DataFrame) -> DataFrame:
    enabled = F.col("enabled_flag") == "Y"
    flags = {n: enabled & (F.col("description") == d) for n, d in TYPE_FLAGS.items()}
    return membership(
        df, "customer_type_code", lookup, "CUSTOMER_TYPES", flags | {"is_known_type": enabled}, F.upper("meaning")
    )


def entity_flags(df: DataFrame, eligible: DataFrame, run_ts: datetime) -> DataFrame:
    return effective_flags(df, eligible, "supplier_legal_name", "legal_entity", ENTITY_FLAGS, run_ts)


def working_columns(df: DataFrame) -> DataFrame:
    """Updatable twins of the recipient and place-of-supply columns; the originals keep what was derived."""
    return df.withColumns(
        {
            "recipient_state_number_upd": F.col("recipient_state_number"),
            "recipient_state_code_upd": F.col("recipient_state_code"),
            "recipient_pincode_upd": F.col("recipient_pincode"),
            "pos_state_number_upd": F.col("pos_state_number"),
            "pos_state_code_upd": F.col("pos_state_code"),
        }
    )


def entity_rules() -> list[Rule]:
    """Not guarded by status: they may turn an ERROR into SUCCESS-INELIGIBLE, in this order."""
    closed = {"status_code": "SUCCESS-INELIGIBLE", "eligible_flag": "N"}

    def consumer(state: State) -> Column:
        return state("supply_type_code") == "B2C"

    def other(state: State) -> Column:
        return state("supply_type_code") != "B2C"

    return [
        Rule("entity not eligible", lambda s: other(s) & ~F.col("le_b2b_any"), closed, SMALL_ENTITY_TEXT),
        Rule("entity partly enabled", lambda s: other(s) & F.col("le_b2b_partial"), closed, PARTIAL_TEXT),
        Rule("entity not eligible, consumer", lambda s: consumer(s) & ~F.col("le_b2c_any"), closed, SMALL_ENTITY_B2C_TEXT),
        Rule("entity partly enabled, consumer", lambda s: consumer(s) & F.col("le_b2c_partial"), closed, PARTIAL_B2C_TEXT),
    ]


def category_rules() -> list[Rule]:
    no_tax, taxed = F.col("total_tax_amount") == 0, F.col("total_tax_amount") != 0
    abroad = (F.col("recipient_country_code") != HOME_COUNTRY) & F.col("is_export")
    rejected = {"status_code": "ERROR", "supply_type_code": "NA", "eligible_flag": "N"}
    sez = UNREGISTERED_RECIPIENT | {"sez_unit": "true"}

    def eligible(state: State) -> Column:
        return state("eligible_flag") == "Y"

    return [
        Rule(
            "challan", lambda s: s("eligible_flag") == "N",
            {"status_code": "SUCCESS-INELIGIBLE", "supply_type_code": "NA"}, CHALLAN_TEXT, True, PENDING,
        ),
        Rule(
            "unregistered", lambda s: eligible(s) & F.col("is_unregistered"),
            {"supply_type_code": "B2C", "eligible_flag": "N"}, statuses=PENDING,
        ),
        Rule(
            "export without tax", lambda s: eligible(s) & abroad & no_tax,
            {"supply_type_code": "EXPWOP"} | UNREGISTERED_RECIPIENT, statuses=PENDING,
        ),
        Rule(
            "zone without tax", lambda s: eligible(s) & F.col("is_sez") & no_tax, {"supply_type_code": "SEZWOP"} | sez, statuses=PENDING
        ),
        Rule("zone with tax", lambda s: eligible(s) & F.col("is_sez") & taxed, {"supply_type_code": "SEZWP"} | sez, statuses=PENDING),
        Rule("regular", lambda s: eligible(s) & F.col("is_regular"), {"supply_type_code": "B2B"}, statuses=PENDING),
        Rule(
            "same registration on both sides",
            lambda s: (s("supply_type_code") == "B2B")
            & (s("recipient_gstin") == F.col("supplier_gstin"))
            & F.coalesce(F.col("any_zero_tax"), F.lit(False)),
            {"supply_type_code": "B2C", "eligible_flag": "N"},
        ),
        Rule(
            "unexpected type", ~F.col("is_known_type"), rejected,
            cat(UNEXPECTED_TYPE_TEXT, F.col("customer_type_code"), ";"), statuses=PENDING,
        ),
        Rule(
            "no type", F.col("customer_type_code").isNull(), rejected, NULL_TYPE_TEXT + ";",
            statuses=("PENDING", "ERROR"),
        ),
        *entity_rules(),
    ]


def categorize(headers: DataFrame, lookup: DataFrame, eligible: DataFrame, run_ts: datetime) -> DataFrame:
    """`headers` carries the tax total and `any_zero_tax` (see `validate.document_facts`)."""
    df = working_columns(headers)
    return apply_rules(entity_flags(customer_type_flags(df, lookup), eligible, run_ts), category_rules())
