"""Status report, print detail and closure reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.moments import day_range, stamp, within_days
from ledgerloom.functions.text import cat, decode, given_or_column, strip_breaks
from ledgerloom.operators.lookups import attach_attributes, lookup_rows
from ledgerloom.operators.spread import first_rows, join_placed
from ledgerloom.session import cut_buckets

# Report separators, caps, texts and titles
TEXT_CAP = 4000
BETWEEN_ERRORS = "####"
PHASE_MARK = " - "
HIDDEN_ERROR = "Unexpected Error - Contact tech support"
MESSAGE_CAP = 100
STAMP_LENGTH = 20
DOCUMENT_TYPES = [("PO", "Purchase Order"), ("REQUISITION", "Purchase Requisition")]
STATUS_TITLES = {
    "batch_id": "Batch ID",
    "invoice_process": "Source",
    "supplier_legal_name": "Legal Entity",
    "ou_name": "Operating Unit Name",
    "owning_organization_name": "Inventory Organization",
    "supplier_gstin": "Supplier GST Number",
    "supplier_state_name": "Supplier GST State",
    "recipient_legal_name": "Recipient Name ",
    "transfer_organization_name": "Inventory Organization",
    "recipient_address": "Recipient Address",
    "recipient_state_name": "Recipient State",
    "recipient_gstin": "Recipient GST Number",
    "document_num": "Transaction Number",
    "document_date": "Transaction Date",
    "gross_amount": "Transaction Amount",
    "creation_date": "Transaction Creation Date",
    "created_by_name": "Transaction Created By",
    "status_code": "Internal status code",
    "status_message": "Internal Validation Failure Reason",
    "error_dates": "IRP Validation Failure Date",
    "error_texts": "IRP Validation Failure Reason",
    "irn": "IRN",
    "irn_created_at": "IRN Date",
    "supply_type_code": "Customer Type",
    "ack_number": "Ack Number",
    "ack_date": "Ack Date",
    "request_id": "Request ID",
}
CLOSURE_TITLES = {
    "operating_unit_name": "Operating_unit",
    "document_type": "Document_type_code",
    "document_id": "Document_id",
    "document_num": "Document_num",
    "creation_date": "Creation_date",
    "requestor_id": "Requestor_id",
    "requestor_name": "Requestor_name",
    "document_subtype": "Document_subtype",
    "status_code": "Status_code",
    "authorization_status": "Authorization_status",
    "amount": "Amount",
    "supplier_name": "Vendor_name",
    "closure_status": "Closure_status",
    "closure_status_date": "Closure_status_date",
}


def report_filter(
    headers: DataFrame,
    mode: str,
    run_ts: datetime,
    lookup: DataFrame | None = None,
    process: str | None = None,
    status: str | None = None,
    request_id: int | None = None,
    start: datetime | None = None,
    end: datetime | None = None,
    changed_at: str = "updated_at",
) -> DataFrame:
    """Headers of one report: ALERT (not yet sent), DATE (changed in whole days) or REQUEST_ID."""
    rows = headers.where(F.col("status_code") != "RE-EXTRACTED")
    if mode == "REQUEST_ID":
        return rows.where(F.col("request_id") == request_id)
    if mode == "DATE":
        rows = rows.where(within_days(F.col(changed_at), *day_range(start, end, run_ts)))
    elif mode == "ALERT":
        rows = rows.where(F.col("mail_sent") == "N")
    else:
        raise ValueError(f"unknown report mode {mode}")
    rows = rows.where(given_or_column(F.col("status_code"), status))
    kinds = lookup_rows(lookup, "INVOICE_PROCESSES", process).select(F.col("lookup_code").alias("_kind"))
    return rows.join(kinds, F.upper("invoice_process") == F.col("_kind"), "left_semi")


def error_texts(errors: DataFrame, key: str = "transaction_id", cap: int = TEXT_CAP) -> DataFrame:
    """Error log of each document as one text, capped, the number of its distinct entries, and of those that the text
    shows at least in part. `error_rows` has all of them in full.

    An entry adds at least its mark and the separator, so no more than `k` entries can touch the capped text;
    only those are gathered, whatever the size of a document's log.
    """
    entries = errors.select(key, "phase", "error_message", "error_type").distinct()
    shown = F.when(F.col("error_type").like("Unexpected Error%"), HIDDEN_ERROR).otherwise(
        F.substring("error_message", 1, MESSAGE_CAP)
    )
    order = ["phase", "error_message", "error_type"]
    k = ceil(cap / (len(PHASE_MARK) + len(BETWEEN_ERRORS))) + 1
    leading = first_rows(entries, [key], order, k).withColumn(
        "_text", strip_breaks(F.concat_ws("", F.col("phase"), F.lit(PHASE_MARK), shown))
    )
    texts = leading.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*order, "_text"))).alias("_list"))
    joined = F.array_join(F.transform("_list", lambda e: e["_text"]), BETWEEN_ERRORS)
    start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("n"))
    begun = F.aggregate(
        "_list", start,
        lambda s, e: F.struct(
            (s["at"] + F.length(e["_text"]) + len(BETWEEN_ERRORS)).alias("at"), (s["n"] + (s["at"] < cap).cast("int")).alias("n")
        ),
    )
    texts = texts.select(key, F.substring(joined, 1, cap).alias("_texts"), begun["n"].cast("long").alias("_shown"))
    counts = entries.groupBy(key).agg(F.count("*").alias("_entries"))
    return texts.join(counts, key)


def error_rows(headers: DataFrame, errors: DataFrame, key: str = "transaction_id") -> DataFrame:
    """All distinct entries of the documents whose errors a report shows, one row each, messages in full."""
    shown = headers.where(F.col("status_code").isin("RUNNING", "ERROR")).select(key, "document_num").distinct()
    entries = errors.select(key, "phase", "error_message", "error_type").distinct()
    return shown.join(entries, key)


def status_report(
    headers: DataFrame,
    errors: DataFrame,
    names: Mapping[str, tuple[DataFrame, str, str, str]],
    changed_at: str = "updated_at",
    created_at: str = "created_at",
) -> DataFrame:
    """One row per header with names and error texts.

    `names` maps result column -> (dimension, header key, dimension key, name column). The error log is
    reduced to the documents whose text is shown, aggregated per document, then joined.
    """
    for result, (dim, key, dim_key, column) in names.items():
        headers = attach_attributes(headers, dim, key, {column: result}, dim_key)
    shown = headers.where(F.col("status_code").isin("RUNNING", "ERROR")).select("transaction_id")
    texts = error_texts(errors.join(shown, "transaction_id", "left_semi"))
    rows = headers.join(texts, "transaction_id", "left")
    quiet = F.col("status_code").startswith("SUCCESS") | (F.col("status_code") == "PENDING")
    loud = F.col("status_code").isin("RUNNING", "ERROR")
    times = F.least(
        F.coalesce("_entries", F.lit(1)), F.lit(ceil(TEXT_CAP / (STAMP_LENGTH + len(BETWEEN_ERRORS))) + 1)
    ).cast("int")
    dates = F.substring(
        F.array_join(F.array_repeat(stamp(F.col(changed_at)), times), BETWEEN_ERRORS), 1, TEXT_CAP
    )
    return rows.withColumns(
        {
            "creation_date": stamp(F.col(created_at)),
            "error_dates": F.when(quiet, "-").when(loud, dates),
            "error_texts": F.when(quiet, "-").when(loud, F.coalesce(F.col("_texts"), F.lit(PHASE_MARK))),
            "entries_total": F.when(loud, F.coalesce("_entries", F.lit(0).cast("long"))),
            "entries_shown": F.when(loud, F.coalesce("_shown", F.lit(0).cast("long"))),
        }
    ).drop("_texts", "_entries", "_shown")


LIST_PATTERN = "(?i)[^0-9a-z, ]"
BATCH_PATTERN = "[^0-9, ]"


def split_params(df: DataFrame, column: str, into: str, pattern: str = LIST_PATTERN) -> DataFrame:
    """Comma lists as rows. A list with a character that is not allowed is refused as a whole; blanks and
    empty items are dropped."""
    cleaned = F.regexp_replace(F.replace(F.trim(F.col(column)), F.lit(" ")), ",+$", "")
    return (
        df.where(~F.col(column).rlike(pattern))
        .withColumn(into, F.explode(F.split(cleaned, ",")))
        .withColumn(into, F.trim(F.col(into)))
        .where(F.col(into) != "")
    )


def select_documents(headers: DataFrame, values: DataFrame, mode: str, lookup: DataFrame, process: str) -> DataFrame:
    """Printable headers named by a document or batch list (`values`: one column)."""
    wanted = values.select(F.col(values.columns[0]).alias("_value"))
    key = F.col("batch_id").cast("string") if "Batch" in mode else F.col("document_num")
    kinds = lookup_rows(lookup, "INVOICE_PROCESSES", process, enabled_only=False).select(F.col("meaning").alias("_kind"))
    return (
        headers.where((F.col("status_code") == "SUCCESS") & (F.col("eligible_flag") == "Y"))
        .join(kinds, F.col("invoice_process") == F.col("_kind"), "left_semi")
        .join(wanted, key == F.col("_value"), "left_semi")
    )


# Header columns printed as they are, and those the tax portal answers later (absent until then)
PRINTED = (
    "supplier_state_code recipient_state_code_upd dispatch_from_state_code ship_to_state_code recipient_poc_name recipient_phone_num "
    "recipient_email"
).split()
ANSWERED = "irn ack_number ack_date eway_bill_number shipment_id shipment_num".split()


def print_detail(
    headers: DataFrame, lines: DataFrame, taxes: DataFrame, selected: DataFrame, footer: str | None = None,
    code_prefix: str = "data:image/png;base64,", placed: str | None = None,
) -> DataFrame:
    """Print rows of the selected documents, one per line and tax. Headers with their long codes move once and are never
    sorted: the ids and the details of a partition are hashed, the headers stream past them. `placed`: a column of headers, lines
    and taxes that none lacks and the latter two lie by; then lines and taxes stay where they are, and the details are written
    to lie by the id, as headers may do that do not move, either."""
    comma = F.lit(",")

    def joined(*columns: str):
        parts = [F.col(columns[0])]
        for c in columns[1:]:
            parts += [comma, F.col(c)]
        return F.concat_ws("", *parts)

    rounded = lambda c: F.round(F.col(c), 2)
    code = F.replace(F.col("signed_code"), F.lit(code_prefix), F.lit(""))
    on = ["transaction_id"] if placed is None else [placed, "transaction_id"]
    header = (
        headers.where((F.col("status_code") == "SUCCESS") & (F.col("eligible_flag") == "Y"))
        .join(selected.select("transaction_id").distinct().hint("shuffle_hash"), "transaction_id", "left_semi")
        .select(
            *on,
            F.substring(code, 1, TEXT_CAP).alias("code_1"),
            F.nullif(F.expr(f"substring(replace(signed_code, '{code_prefix}', ''), {TEXT_CAP + 1})"), F.lit("")).alias("code_2"),
            "document_num",
            "document_date",
            F.col("document_type_code").alias("invoice_type"),
            F.concat_ws("", "pos_state_code_upd", F.lit("("), "pos_state_number_upd", F.lit(")")).alias("place_of_supply"),
            F.col("supply_type_code").alias("supply_type"),
            joined("supplier_legal_name", "supplier_address", "supplier_place", "supplier_state_name", "supplier_pincode").alias("bill_from"),
            "supplier_gstin",
            joined("recipient_legal_name", "recipient_address", "recipient_place", "recipient_pincode_upd").alias("bill_to"),
            "recipient_gstin",
            joined("supplier_legal_name", "dispatch_from_address", "dispatch_from_place", "dispatch_from_pincode").alias("ship_from"),
            joined("ship_to_legal_name", "ship_to_address", "ship_to_place", "ship_to_pincode").alias("ship_to"),
            rounded("total_base_amount").alias("document_base_amount"),
            rounded("total_tax_amount").alias("document_tax_amount"),
            rounded("gross_amount").alias("document_total_amount"),
            *PRINTED,
            *[F.col(c) if c in headers.columns else F.lit(None).cast("string").alias(c) for c in ANSWERED],
            "batch_id",
            F.lit(footer).cast("string").alias("footer"),
        )
    )
    ids = header.select(*on)
    detail = join_placed(lines, ids, on, "left_semi").select(
        *on, "line_number", "item_code", "item_name", F.col("hsn_code").alias("hsn"), "quantity",
        rounded("base_amount").alias("line_base_amount"), rounded("tax_amount").alias("line_tax_amount"),
        rounded("gross_amount").alias("line_total_amount"),
    ).join(
        join_placed(taxes, ids, on, "left_semi").select(*on, "line_number", cat(F.col("tax_name"), "-", F.col("tax_rate").cast("string")).alias("tax_code")),
        [*on, "line_number"],
    )
    if placed is not None:
        header, detail = header.drop(placed), cut_buckets(detail.drop(placed), "transaction_id")
    return header.join(detail.hint("shuffle_hash"), "transaction_id")


def closure_report(
    df: DataFrame,
    mode: str,
    run_ts: datetime,
    start: datetime | None = None,
    end: datetime | None = None,
    status: str | None = None,
    document_type: str | None = None,
    request_id: int | None = None,
) -> DataFrame:
    """Closure log by creation days or by request, optionally by status and by decoded document type."""
    decoded = decode(F.col("document_type_code"), DOCUMENT_TYPES)
    rows = df.where(F.col("status_code") != "RE-EXTRACTED")
    if mode == "DATE":
        rows = rows.where(within_days(F.col("creation_date"), *day_range(start, end, run_ts)))
    elif mode == "REQUEST_ID":
        rows = rows.where(F.col("request_id") == request_id)
    else:
        raise ValueError(f"unknown report mode {mode}")
    rows = rows.where(given_or_column(F.col("status_code"), status) & given_or_column(decoded, document_type))
    return rows.withColumns({"document_type": decoded, "creation_date": stamp(F.col("creation_date"))})


def closure_list(df: DataFrame, request_id: int, status: str, types: Sequence[str] = ("PO", "REQUISITION")) -> DataFrame:
    """Eligible documents of one request and status, all types in one pass (write it partitioned by type)."""
    rows = df.where(
        (F.col("request_id") == request_id)
        & (F.col("status_code") == status)
        & (F.col("eligible_flag") == "Y")
        & F.col("document_type_code").isin(*types)
    )
    return rows.withColumns(
        {
            "document_type": decode(F.col("document_type_code"), DOCUMENT_TYPES),
            "creation_date": stamp(F.col("creation_date")),
        }
    )
