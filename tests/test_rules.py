"""Rules one by one: a row that fires, one that does not, NULLs, order and guards."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import categorize, validate
from ledgerloom.operators.rules import Rule, accumulate, apply_rules

RUN_TS = datetime(2001, 8, 1)

COLUMNS = {
    "transaction_id": "long", "status_code": "string", "status_message": "string", "supply_type_code": "string",
    "eligible_flag": "string", "customer_type_code": "string", "recipient_country_code": "string",
    "total_tax_amount": "decimal(20,4)", "recipient_gstin": "string", "supplier_gstin": "string", "sez_unit": "string",
    "recipient_state_number_upd": "string", "recipient_state_code_upd": "string", "recipient_pincode_upd": "string",
    "pos_state_number_upd": "string", "pos_state_code_upd": "string", "any_zero_tax": "boolean",
    "is_unregistered": "boolean", "is_export": "boolean", "is_sez": "boolean", "is_regular": "boolean",
    "is_known_type": "boolean", "le_b2b_any": "boolean", "le_b2b_partial": "boolean", "le_b2c_any": "boolean",
    "le_b2c_partial": "boolean", "recipient_legal_name": "string", "recipient_address": "string",
    "recipient_phone_num": "string", "recipient_place": "string", "recipient_email": "string",
    "supplier_legal_name": "string", "supplier_address": "string", "supplier_state_code": "string",
    "supplier_country_code": "string", "supplier_place": "string", "supplier_state_number": "string",
    "shipment_type": "string", "document_date": "string", "document_num": "string", "recipient_pan": "string",
    "any_bad_code": "boolean", "any_unclassed": "boolean", "line_count": "long", "any_tax_amount": "boolean",
    "has_CGST": "boolean", "has_SGST": "boolean", "has_IGST": "boolean", "line_of_business": "string",
    "is_note": "boolean", "original_found": "boolean", "is_enabled_type": "boolean",
}
GOOD = dict(
    transaction_id=1, status_code="PENDING", eligible_flag="Y", customer_type_code="REGULAR", recipient_country_code="IN",
    total_tax_amount=Decimal(5), recipient_gstin="01ABCDE1234F1Z5", supplier_gstin="02XXXXX1234F1Z5", sez_unit="false",
    recipient_state_number_upd="01", recipient_state_code_upd="S1", recipient_pincode_upd="1", pos_state_number_upd="01",
    pos_state_code_upd="S1", any_zero_tax=False, is_unregistered=False, is_export=False, is_sez=False, is_regular=True,
    is_known_type=True, le_b2b_any=True, le_b2b_partial=False, le_b2c_any=True, le_b2c_partial=False,
    recipient_legal_name="R", recipient_address="A", recipient_phone_num="P", recipient_place="L", recipient_email="M",
    supplier_legal_name="S", supplier_address="A", supplier_state_code="S2", supplier_country_code="IN", supplier_place="L",
    supplier_state_number="02", shipment_type="INTER", document_date="2001-01-01", document_num="INV1",
    recipient_pan="ABCDE1234F", any_bad_code=False, any_unclassed=False, line_count=3, any_tax_amount=True,
    has_CGST=False, has_SGST=False, has_IGST=True, line_of_business="LOB", is_note=False, original_found=False,
    is_enabled_type=True,
)


def frame(spark, *rows):
    schema = ", ".join(f"{c} {t}" for c, t in COLUMNS.items())
    full = [tuple((GOOD | r).get(c) for c in COLUMNS) for r in rows]
    return spark.createDataFrame(full, schema)


def category(spark, **changes):
    return apply_rules(frame(spark, changes), categorize.category_rules()).first()


UNKNOWN = dict(is_regular=False, is_known_type=False)
TYPE = lambda flag: dict(is_regular=False) | {flag: True}


@pytest.mark.parametrize(
    "changes, status, supply, eligible, message",
    [
        (dict(), "PENDING", "B2B", "Y", None),
        (dict(eligible_flag="N"), "SUCCESS-INELIGIBLE", "NA", "N", categorize.CHALLAN_TEXT + "####"),
        (TYPE("is_unregistered"), "PENDING", "B2C", "N", None),
        (TYPE("is_export") | dict(recipient_country_code="US", total_tax_amount=Decimal(0)), "PENDING", "EXPWOP", "Y", None),
        # an export with tax, at home, or to an unknown country has no type
        (TYPE("is_export") | dict(recipient_country_code="US"), "PENDING", None, "Y", None),
        (TYPE("is_export") | dict(total_tax_amount=Decimal(0)), "PENDING", None, "Y", None),
        (TYPE("is_export") | dict(recipient_country_code=None, total_tax_amount=Decimal(0)), "PENDING", None, "Y", None),
        (TYPE("is_sez") | dict(total_tax_amount=Decimal(0)), "PENDING", "SEZWOP", "Y", None),
        (TYPE("is_sez"), "PENDING", "SEZWP", "Y", None),
        (TYPE("is_sez") | dict(total_tax_amount=None), "PENDING", None, "Y", None),
        (dict(recipient_gstin="Q", supplier_gstin="Q", any_zero_tax=True), "PENDING", "B2C", "N", None),
        (dict(recipient_gstin="Q", supplier_gstin="Q"), "PENDING", "B2B", "Y", None),
        (dict(recipient_gstin=None, supplier_gstin=None, any_zero_tax=True), "PENDING", "B2B", "Y", None),
        (UNKNOWN | dict(customer_type_code="ODD"), "ERROR", "NA", "N", "Unexpected customer registration code ODD;####"),
        (dict(customer_type_code=None, is_regular=None, is_known_type=None), "ERROR", "NA", "N", "Null customer registration code ;####"),
        (dict(le_b2b_any=False), "SUCCESS-INELIGIBLE", "B2B", "N", categorize.SMALL_ENTITY_TEXT + "####"),
        (dict(le_b2b_partial=True), "SUCCESS-INELIGIBLE", "B2B", "N", categorize.PARTIAL_TEXT + "####"),
        (TYPE("is_unregistered") | dict(le_b2c_any=False), "SUCCESS-INELIGIBLE", "B2C", "N", categorize.SMALL_ENTITY_B2C_TEXT + "####"),
        (TYPE("is_unregistered") | dict(le_b2c_partial=True), "SUCCESS-INELIGIBLE", "B2C", "N", categorize.PARTIAL_B2C_TEXT + "####"),
        # entity rules are not guarded: an ERROR becomes SUCCESS-INELIGIBLE and both messages stay
        (UNKNOWN | dict(customer_type_code="ODD", le_b2b_any=False), "SUCCESS-INELIGIBLE", "NA", "N",
         "Unexpected customer registration code ODD;####" + categorize.SMALL_ENTITY_TEXT + "####"),
        # without a type the entity rules do not apply (NULL <> 'B2C' is unknown)
        (TYPE("is_export") | dict(le_b2b_any=False), "PENDING", None, "Y", None),
    ],
)
def test_category(spark, changes, status, supply, eligible, message):
    r = category(spark, **changes)
    assert (r.status_code, r.supply_type_code, r.eligible_flag, r.status_message) == (status, supply, eligible, message)


def test_zone_and_export_get_stand_ins(spark):
    r = category(spark, **TYPE("is_sez"))
    assert (r.recipient_gstin, r.recipient_state_code_upd, r.pos_state_code_upd, r.recipient_pincode_upd, r.sez_unit) == (
        "URP", "96", "96", "999999", "true")
    r = category(spark, **TYPE("is_export"), total_tax_amount=Decimal(0), recipient_country_code="US")
    assert (r.recipient_gstin, r.sez_unit) == ("URP", "false")


T = validate.TEXT
B2B = dict(supply_type_code="B2B")
RECEIVABLE = [
    (dict(), []),
    (dict(recipient_gstin=None), ["recipient registration"]),
    (dict(recipient_gstin="GSTNOTAVAILABLE"), ["recipient registration", "state prefix", "pan"]),
    (dict(recipient_gstin="01ABCDE1234F1Z"), ["recipient registration"]),
    (dict(recipient_gstin="02XXXXX1234F1Z5", recipient_state_number_upd="02", recipient_pan="XXXXX1234F"), ["equal registrations"]),
    (dict(recipient_phone_num=None), ["recipient data"]),
    (dict(recipient_email=None), []),
    (dict(supplier_place=None), ["supplier data"]),
    (dict(shipment_type=None), ["document data"]),
    (dict(supplier_gstin=None), ["supplier registration"]),
    (dict(supplier_gstin="GSTNOTAVAILABLE"), ["supplier registration", "state prefix"]),
    (dict(document_num="/1"), ["document number"]),
    (dict(document_num=None), []),
    (dict(supplier_state_number="07"), ["state prefix"]),
    (dict(supplier_state_number=None), []),
    (dict(recipient_pan="OTHER1234F"), ["pan"]),
    (dict(recipient_pan=None), ["pan"]),
    (dict(any_bad_code=True), ["tariff code"]),
    (dict(any_unclassed=True), ["tariff code"]),
    (dict(any_bad_code=None, any_unclassed=None, line_count=None), []),
    (dict(line_count=1001), ["line count"]),
    (dict(line_count=1000), []),
    (dict(has_IGST=False, has_CGST=True), ["taxes"]),
    (dict(shipment_type="INTRA", has_IGST=False, has_CGST=True, has_SGST=True), []),
    (dict(shipment_type="INTRA", has_IGST=False, has_CGST=True), ["taxes"]),
    (dict(any_tax_amount=None, has_CGST=None, has_SGST=None, has_IGST=None), []),
    (dict(supply_type_code="SEZWOP"), ["taxes"]),
    (dict(line_of_business=None), ["line of business"]),
    (dict(is_note=True), ["original document"]),
    (dict(is_note=True, original_found=True), []),
    (dict(supply_type_code=None, recipient_gstin=None), ["document data"]),
]


@pytest.mark.parametrize("changes, hits", RECEIVABLE)
def test_receivable_rule(spark, changes, hits):
    r = accumulate(frame(spark, B2B | changes), validate.receivable_rules()).first()
    assert r.status_message == ("".join(T[h] + "####" for h in hits) or None)
    assert r.status_code == ("ERROR" if hits else "PENDING")


def test_transfer_rules_differ(spark):
    rows = [
        B2B | dict(transaction_id=1, recipient_email=None),
        B2B | dict(transaction_id=2, supplier_gstin="GSTNOTAVAILABLE", supplier_state_number="GS"),
        B2B | dict(transaction_id=3, any_unclassed=True, recipient_pan=None),
        B2B | dict(transaction_id=4, status_code="ERROR", status_message="x####", recipient_gstin=None, document_num="0"),
        B2B | dict(transaction_id=5, status_code="SUCCESS-INELIGIBLE", document_num="0"),
    ]
    got = {r.transaction_id: (r.status_code, r.status_message) for r in accumulate(frame(spark, *rows), validate.transfer_rules()).collect()}
    assert got == {
        1: ("ERROR", T["recipient data with mail"] + "####"),
        2: ("PENDING", None),
        3: ("PENDING", None),
        4: ("ERROR", "x####" + T["document number transfer"] + "####"),  # the first rule is for PENDING only
        5: ("SUCCESS-INELIGIBLE", None),
    }


def test_entry_rules_guard_their_status(spark):
    rows = [
        dict(transaction_id=1, is_enabled_type=False),
        dict(transaction_id=2, is_enabled_type=None),
        dict(transaction_id=3, is_enabled_type=False, status_code="SUCCESS-INELIGIBLE", status_message="a####"),
        dict(transaction_id=4, is_enabled_type=False, status_code="ERROR"),
        dict(transaction_id=5, is_export=True),
        dict(transaction_id=6, is_export=True, is_enabled_type=False),
        dict(transaction_id=7, is_export=True, recipient_country_code=None),
    ]
    got = {r.transaction_id: (r.status_code, r.status_message) for r in apply_rules(frame(spark, *rows), validate.receivable_entry_rules()).collect()}
    text = T["document type"] + "####"
    assert got == {
        1: ("SUCCESS-INELIGIBLE", text), 2: ("PENDING", None), 3: ("SUCCESS-INELIGIBLE", "a####" + text), 4: ("ERROR", None),
        5: ("ERROR", T["export at home"] + "####"), 6: ("SUCCESS-INELIGIBLE", text), 7: ("PENDING", None),
    }


def test_both_forms_agree(spark, inputs):
    """The one-projection form equals the fold when rules only add messages."""
    df = inputs["fx_closure"].select(
        F.col("document_id"), F.coalesce("status_code", F.lit("ERROR")).alias("status_code"), F.lit(None).cast("string").alias("status_message"),
        "eligible_flag", "amount",
    )
    open_ = ("PENDING", "ERROR")
    conditions = [F.col("eligible_flag") == "N", F.col("amount") > 200000, F.col("document_id") % 3 == 0]
    rules = [Rule(str(n), c, {"status_code": "ERROR"}, f"m{n}", statuses=open_) for n, c in enumerate(conditions)]
    assert sorted(apply_rules(df, rules).collect()) == sorted(accumulate(df, rules).collect())
