"""Validation rule sets for receivable and transfer documents.

Facts about lines and taxes are grouped to one row per document and joined once; the rules themselves are
row conditions over the header.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.text import any_null, length_is_one_of
from ledgerloom.operators.categorize import HOME_COUNTRY
from ledgerloom.operators.lines import Key, amount_sums, class_range, key_columns, set_service_flag
from ledgerloom.operators.lookups import lookup_rows
from ledgerloom.operators.rules import Rule, accumulate, apply_rules
from ledgerloom.operators.spread import join_placed, spread_nulls

# Placeholders, code lengths, size limit and message texts
NO_GSTIN = "GSTNOTAVAILABLE"
GSTIN_LENGTH = 15
NO_PAN = "XXXXXX"
GOODS_LENGTHS, SERVICE_LENGTHS = (4, 6, 8), (4, 5, 6)
MAX_LINES = 1000
BAD_FIRST_CHARACTERS = ("0", "/", "-")
TEXT = {
    "document type": "Ineligible Document Type Code",
    "export at home": "Country value India is not eligible for EXPORT customers",
    "recipient registration": "Invalid or null recipient GSTIN ;",
    "equal registrations": "Recipient GSTIN is equal to Supplier GSTIN ;",
    "recipient data": "Invalid recipient data, check billing address,place,phone number,country and state code",
    "recipient data with mail": "Invalid recipient data, check billing address,place,phone number,email,country and state code",
    "supplier data": "Invalid supplier data, check legal name and address details",
    "document data": "Invoice Type or POS State or SEZ unit or document_date or Supply Type is null",
    "supplier registration": "Invalid or null Supplier GSTIN",
    "supplier registration null": "Supplier GSTIN is null",
    "document number": "Document num can not start with 0, / and -",
    "document number transfer": "Document num to start with 0, / and -",
    "state prefix": "Invalid Recipient or Supplier GSTN",
    "pan": "Invalid PAN number in GSTIN",
    "tariff code": "Invalid or null HSN or SAC Code",
    "line count": "Line count less than 1 or greater than 1000",
    "taxes": "Incorrect taxes extracted",
    "line of business": "Line of Business is null",
    "original document": "Original invoice Number and Date is not correct",
}

# Which taxes a movement must and must not carry
TAX_PATTERN = {
    "INTRA": {"must": ("CGST", "SGST"), "must_not": ("IGST",)},
    "INTER": {"must": ("IGST",), "must_not": ("CGST", "SGST")},
}
UNTAXED_SUFFIX = "WOP"


def bad_code(strict: bool = False) -> Column:
    """Length of a line's tariff code does not fit its class; NULL codes are unknown, hence not bad."""
    code, kind = F.col("hsn_code"), F.col("item_class")
    return F.coalesce(
        ((kind == "GOODS") & ~length_is_one_of(code, GOODS_LENGTHS, strict))
        | ((kind == "SERVICE") & ~length_is_one_of(code, SERVICE_LENGTHS, strict)),
        F.lit(False),
    )


def line_facts(strict: bool = False) -> list[Column]:
    return [
        F.count("*").alias("line_count"),
        F.bool_or(bad_code(strict)).alias("any_bad_code"),
        F.bool_or(F.col("item_class").isNull()).alias("any_unclassed"),
    ]


def document_facts(
    headers: DataFrame, lines: DataFrame, taxes: DataFrame, strict: bool = False, key: Key = "transaction_id"
) -> DataFrame:
    """Everything the rules and totals need to know about lines and taxes, joined to the header: one grouping
    of the lines (amounts, classes, code checks, count) and one of the taxes. Both combine before the shuffle,
    so the size of a document does not matter."""
    keys = key_columns(key)
    summary = lines.groupBy(*keys).agg(*amount_sums(), *class_range(), *line_facts(strict))
    joined = join_placed(join_placed(headers, summary, keys, "left"), tax_facts(taxes, key=key), keys, "left")
    return set_service_flag(joined)


def tax_facts(
    taxes: DataFrame, pattern: Mapping[str, Mapping[str, Sequence[str]]] = TAX_PATTERN, key: Key = "transaction_id"
) -> DataFrame:
    names = sorted({n for p in pattern.values() for part in p.values() for n in part})
    return taxes.groupBy(*key_columns(key)).agg(
        F.bool_or(F.col("taxable_amount") != 0).alias("any_tax_amount"),
        F.bool_or(F.col("taxable_amount") == 0).alias("any_zero_tax"),
        *[F.coalesce(F.bool_or(F.col("tax_name") == n), F.lit(False)).alias(f"has_{n}") for n in names],
    )


def wrong_taxes(pattern: Mapping[str, Mapping[str, Sequence[str]]] = TAX_PATTERN) -> Column:
    """True for a document with taxes that do not fit its movement, or with tax where none is due."""
    wrong = F.coalesce(F.col("supply_type_code").endswith(UNTAXED_SUFFIX) & F.col("any_tax_amount"), F.lit(False))
    for movement, parts in pattern.items():
        misfit = F.lit(False)
        for n in parts["must"]:
            misfit = misfit | ~F.col(f"has_{n}")
        for n in parts["must_not"]:
            misfit = misfit | F.col(f"has_{n}")
        wrong = wrong | F.coalesce((F.col("shipment_type") == movement) & misfit, F.lit(False))
    return F.col("any_tax_amount").isNotNull() & wrong


def count_out_of_range(max_lines: int = MAX_LINES, include_empty: bool = False) -> Column:
    """Too many lines; a document without lines is only reported when asked for."""
    empty = F.col("line_count").isNull() if include_empty else F.lit(False)
    return F.coalesce(~F.col("line_count").between(1, max_lines), F.lit(False)) | empty


def original_document_flag(
    df: DataFrame, source: DataFrame, number: str, date: str, placed: str | None = None
) -> DataFrame:
    """Does a source document with the preceding number and date exist? `date` is an ISO day string. `placed`: a column that
    the rows lie by, and that none lacks; then only references move to the source documents and back, not whole rows."""
    # only the few referenced documents are looked up, so the history is reduced before it is made distinct
    wanted = df.where(F.col("preceding_doc_num").isNotNull() & F.col("preceding_doc_date").isNotNull()).select(
        F.col("preceding_doc_num").alias("_num"), F.col("preceding_doc_date").alias("_day")
    ).distinct()
    known = (
        source.select(F.col(number).alias("_num"), F.col(date).alias("_day"))
        .join(wanted, ["_num", "_day"], "left_semi")
        .distinct()
        .withColumn("original_found", F.lit(True))
    )
    if placed is not None:
        named = [placed, "preceding_doc_num", "preceding_doc_date"]
        pair = (F.col("preceding_doc_num") == F.col("_num")) & (F.col("preceding_doc_date") == F.col("_day"))
        found = df.where(F.col("preceding_doc_num").isNotNull()).select(*named).distinct().join(known, pair).drop("_num", "_day")
        return join_placed(df, found, named, "left").withColumn("original_found", F.coalesce("original_found", F.lit(False)))
    on = (F.col("_preceding") == F.col("_num")) & (F.col("preceding_doc_date") == F.col("_day"))
    keyed = spread_nulls(df, "preceding_doc_num", "_preceding")  # most documents refer to none
    return keyed.join(known, on, "left").drop("_num", "_day", "_preceding").withColumn(
        "original_found", F.coalesce("original_found", F.lit(False))
    )


def note_type_flags(df: DataFrame, lookup: DataFrame, note_codes: Sequence[str]) -> DataFrame:
    """Flags on the document type: among the enabled types, and among the note types."""
    enabled = lookup_rows(lookup, "DOCUMENT_TYPES", "Document Type Code")
    types = enabled.groupBy(F.col("meaning").alias("_type")).agg(
        F.bool_or(F.col("lookup_code").isin(*note_codes)).alias("_note")
    )
    joined = df.join(types, F.col("document_type_code") == F.col("_type"), "left")
    return joined.withColumns(
        {
            "is_enabled_type": F.when(F.col("document_type_code").isNotNull(), F.col("_type").isNotNull()),
            "is_note": F.coalesce(F.col("_note"), F.lit(False)),
        }
    ).drop("_type", "_note")


def _b2b() -> Column:
    return F.col("supply_type_code") == "B2B"


def _recipient_registration() -> Column:
    g = F.col("recipient_gstin")
    return _b2b() & (g.isNull() | (g == NO_GSTIN) | (F.length(g) != GSTIN_LENGTH))


def _equal_registrations() -> Column:
    return _b2b() & (F.col("recipient_gstin") == F.col("supplier_gstin"))


def _state_prefix() -> Column:
    return _b2b() & (
        (F.substring("supplier_gstin", 1, 2) != F.col("supplier_state_number"))
        | (F.substring("recipient_gstin", 1, 2) != F.col("recipient_state_number_upd"))
    )


RECIPIENT_COLUMNS = (
    "recipient_legal_name recipient_address recipient_state_code_upd recipient_phone_num recipient_country_code "
    "recipient_place recipient_state_number_upd"
).split()
SUPPLIER_COLUMNS = (
    "supplier_legal_name supplier_address supplier_state_code supplier_country_code supplier_place"
).split()
DOCUMENT_COLUMNS = "shipment_type pos_state_code_upd sez_unit document_date supply_type_code".split()


def receivable_entry_rules() -> list[Rule]:
    """Rules with a status guard of their own; they run before the accumulating set."""
    return [
        Rule(
            "document type", ~F.col("is_enabled_type"),
            {"status_code": "SUCCESS-INELIGIBLE", "eligible_flag": "N"}, TEXT["document type"],
            statuses=("PENDING", "SUCCESS-INELIGIBLE"),
        ),
        Rule(
            "export at home", (F.col("recipient_country_code") == HOME_COUNTRY) & F.col("is_export"),
            {"status_code": "ERROR"}, TEXT["export at home"], statuses=("PENDING",),
        ),
    ]


def receivable_rules(max_lines: int = MAX_LINES) -> list[Rule]:
    gstin = F.col("supplier_gstin")
    return [
        Rule("recipient registration", _recipient_registration(), message=TEXT["recipient registration"]),
        Rule("equal registrations", _equal_registrations(), message=TEXT["equal registrations"]),
        Rule("recipient data", any_null(*RECIPIENT_COLUMNS), message=TEXT["recipient data"]),
        Rule("supplier data", any_null(*SUPPLIER_COLUMNS), message=TEXT["supplier data"]),
        Rule("document data", any_null(*DOCUMENT_COLUMNS), message=TEXT["document data"]),
        Rule("supplier registration", gstin.isNull() | (gstin == NO_GSTIN), message=TEXT["supplier registration"]),
        Rule("document number", F.substring("document_num", 1, 1).isin(*BAD_FIRST_CHARACTERS), message=TEXT["document number"]),
        Rule("state prefix", _state_prefix(), message=TEXT["state prefix"]),
        Rule(
            "pan",
            _b2b() & (F.substring("recipient_gstin", 3, 10) != F.coalesce(F.col("recipient_pan"), F.lit(NO_PAN))),
            message=TEXT["pan"],
        ),
        Rule("tariff code", F.col("any_bad_code") | F.col("any_unclassed"), message=TEXT["tariff code"]),
        Rule("line count", count_out_of_range(max_lines), message=TEXT["line count"]),
        Rule("taxes", wrong_taxes(), message=TEXT["taxes"]),
        Rule("line of business", F.col("line_of_business").isNull(), message=TEXT["line of business"]),
        Rule("original document", F.col("is_note") & ~F.col("original_found"), message=TEXT["original document"]),
    ]


def transfer_rules(max_lines: int = MAX_LINES) -> list[Rule]:
    return [
        Rule(
            "recipient registration", _recipient_registration(), message=TEXT["recipient registration"],
            statuses=("PENDING",),
        ),
        Rule("equal registrations", _equal_registrations(), message=TEXT["equal registrations"]),
        Rule(
            "recipient data", any_null(*RECIPIENT_COLUMNS, "recipient_email"), message=TEXT["recipient data with mail"]
        ),
        Rule("supplier data", any_null(*SUPPLIER_COLUMNS), message=TEXT["supplier data"]),
        Rule("document data", any_null(*DOCUMENT_COLUMNS), message=TEXT["document data"]),
        Rule("supplier registration", F.col("supplier_gstin").isNull(), message=TEXT["supplier registration null"]),
        Rule(
            "document number", F.substring("document_num", 1, 1).isin(*BAD_FIRST_CHARACTERS),
            message=TEXT["document number transfer"],
        ),
        Rule("state prefix", _state_prefix(), message=TEXT["state prefix"]),
        Rule("tariff code", F.col("any_bad_code"), message=TEXT["tariff code"]),
        Rule("line count", count_out_of_range(max_lines), message=TEXT["line count"]),
        Rule("taxes", wrong_taxes(), message=TEXT["taxes"]),
        Rule("line of business", F.col("line_of_business").isNull(), message=TEXT["line of business"]),
    ]


def _flag_errors(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "status_message",
        F.when(F.col("status_code") == "ERROR", F.concat_ws("", F.lit("ERROR:"), F.col("status_message")))
        .otherwise(F.col("status_message")),
    )


def validate_receivable(
    df: DataFrame,
    lookup: DataFrame,
    source: DataFrame,
    note_codes: Sequence[str] = ("CM", "DM"),
    max_lines: int = MAX_LINES,
    number: str = "document_num",
    date: str = "document_date",
    placed: str | None = None,
) -> DataFrame:
    """Rules for receivable documents; `df` carries `document_facts` and the category flags, `source` the
    documents that notes may refer to (`placed` as for `original_document_flag`)."""
    df = original_document_flag(note_type_flags(df, lookup, note_codes), source, number, date, placed)
    df = apply_rules(df, receivable_entry_rules())
    return _flag_errors(accumulate(df, receivable_rules(max_lines)))


def validate_transfer(df: DataFrame, max_lines: int = MAX_LINES) -> DataFrame:
    """Rules for stock transfers; `df` carries `document_facts`."""
    return _flag_errors(accumulate(df, transfer_rules(max_lines)))


def error_breakdown(df: DataFrame) -> DataFrame:
    """Accumulated messages split into single ones and counted."""
    text = F.regexp_replace("status_message", "^ERROR:", "")
    return (
        df.select("status_code", F.explode(F.split(text, "####")).alias("message"))
        .where(F.col("message") != "")
        .groupBy("status_code", "message")
        .agg(F.count("*").alias("documents"))
    )
