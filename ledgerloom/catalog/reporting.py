"""Status report, print detail, closure reports, recipient packing."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ledgerloom.catalog.documents import CATEGORY_SQL, DOCUMENT, PLACED, STAGE_VIEWS, categorized, run_headers, stage
from ledgerloom.catalog.registry import RUN_TS, doubles, query
from ledgerloom.operators import lines, recipients, reports

# ---------------------------------------------------------------- status report

_STATUS = """CASE WHEN h.document_id % 19 = 2 THEN 'RE-EXTRACTED' WHEN h.document_id % 19 = 5 THEN NULL WHEN h.document_type = 'F' THEN 'ERROR'
   WHEN h.document_type = 'O' THEN 'RUNNING' WHEN h.document_id % 2 = 0 THEN 'SUCCESS' ELSE 'PENDING' END"""
REPORT_HEAD_SQL = f"""
rh AS (SELECT h.document_id AS transaction_id, h.document_num, h.query_type AS invoice_process, h.batch_id, h.cust_id, h.le_id, h.request_id,
   {_STATUS} AS status_code, CASE WHEN h.document_id % 7 = 3 THEN 'Y' ELSE 'N' END AS mail_sent, h.source_total AS gross_amount,
   h.document_date AS created_at, h.document_date + INTERVAL 1 DAY AS updated_at FROM fx_hdr h),
ee AS (SELECT DISTINCT document_id AS transaction_id, phase, error_message, error_type FROM fx_err),
et AS (SELECT transaction_id, count(*) AS n, substr(string_agg(replace(replace(coalesce(phase, '') || ' - ' || coalesce(CASE WHEN error_type LIKE 'Unexpected Error%'
     THEN 'Unexpected Error - Contact tech support' ELSE substr(error_message, 1, 100) END, ''), chr(10), ''), chr(13), ''), '####'
     ORDER BY phase NULLS FIRST, error_message NULLS FIRST, error_type NULLS FIRST), 1, 4000) AS t FROM ee GROUP BY transaction_id)"""
REPORT_BODY_SQL = """
SELECT r.transaction_id, r.document_num, r.invoice_process, r.batch_id, e.legal_name AS owning_organization_name, c.cust_name AS created_by_name,
  r.status_code, upper(strftime(r.created_at, '%d-%b-%Y %H:%M:%S')) AS creation_date, cast(r.gross_amount AS double) AS gross_amount, r.request_id,
  CASE WHEN r.status_code LIKE 'SUCCESS%' OR r.status_code = 'PENDING' THEN '-' WHEN r.status_code IN ('RUNNING', 'ERROR') THEN
     upper(strftime(r.updated_at, '%d-%b-%Y %H:%M:%S')) || repeat('####' || upper(strftime(r.updated_at, '%d-%b-%Y %H:%M:%S')), cast(coalesce(et.n, 1) - 1 AS integer)) END AS error_dates,
  CASE WHEN r.status_code LIKE 'SUCCESS%' OR r.status_code = 'PENDING' THEN '-' WHEN r.status_code IN ('RUNNING', 'ERROR') THEN coalesce(et.t, ' - ') END AS error_texts
FROM rh r LEFT JOIN et ON et.transaction_id = r.transaction_id LEFT JOIN fx_le e ON e.le_id = r.le_id LEFT JOIN fx_cust c ON c.cust_id = r.cust_id
WHERE r.status_code <> 'RE-EXTRACTED' AND {where}"""
_KIND = "upper(r.invoice_process) IN (SELECT lookup_code FROM fx_lookup WHERE lookup_type = 'INVOICE_PROCESSES' AND description = '{p}' AND enabled_flag = 'Y')"
REPORT_OUT = (
    "transaction_id document_num invoice_process batch_id owning_organization_name created_by_name status_code "
    "creation_date gross_amount request_id error_dates error_texts"
).split()
REPORT_VIEWS = ["fx_hdr", "fx_err", "fx_le", "fx_cust", "fx_lookup"]


def report_headers(i):
    h = i["fx_hdr"]
    key = F.col("document_id")
    status = (
        F.when(key % 19 == 2, "RE-EXTRACTED")
        .when(key % 19 == 5, F.lit(None))
        .when(F.col("document_type") == "F", "ERROR")
        .when(F.col("document_type") == "O", "RUNNING")
        .when(key % 2 == 0, "SUCCESS")
        .otherwise("PENDING")
    )
    return h.select(
        key.alias("transaction_id"), "document_num", F.col("query_type").alias("invoice_process"), "batch_id", "cust_id",
        "le_id", "request_id", status.alias("status_code"), F.when(key % 7 == 3, "Y").otherwise("N").alias("mail_sent"),
        F.col("source_total").alias("gross_amount"), F.col("document_date").alias("created_at"),
        (F.col("document_date") + F.expr("INTERVAL 1 DAY")).alias("updated_at"),
    )


def _status_report(i, filtered):
    names = {
        "owning_organization_name": (i["fx_le"], "le_id", "le_id", "legal_name"),
        "created_by_name": (i["fx_cust"], "cust_id", "cust_id", "cust_name"),
    }
    out = reports.status_report(filtered, i["fx_err"].withColumnRenamed("document_id", "transaction_id"), names)
    return doubles(out, "gross_amount").select(*REPORT_OUT)


@query("q_status_report", REPORT_VIEWS, f"WITH {REPORT_HEAD_SQL} {REPORT_BODY_SQL.format(where='r.request_id = 2')}")
def q_status_report(i):
    return _status_report(i, reports.report_filter(report_headers(i), "REQUEST_ID", RUN_TS, request_id=2))


@query(
    "q_status_report_date",
    REPORT_VIEWS,
    f"""WITH {REPORT_HEAD_SQL} {REPORT_BODY_SQL.format(where="r.status_code IS NOT NULL AND " + _KIND.format(p='TRANSFER')
    + " AND r.updated_at BETWEEN timestamp '1998-01-01 00:00:00' AND timestamp '1999-12-31 23:59:59'")}""",
)
def q_status_report_date(i):
    rows = reports.report_filter(
        report_headers(i), "DATE", RUN_TS, i["fx_lookup"], "TRANSFER", start=datetime(1998, 1, 1, 9), end=datetime(1999, 12, 31, 9)
    )
    return _status_report(i, rows)


@query(
    "q_status_report_alert",
    REPORT_VIEWS,
    f"""WITH {REPORT_HEAD_SQL} {REPORT_BODY_SQL.format(where="r.status_code = 'ERROR' AND r.mail_sent = 'N' AND " + _KIND.format(p='RECEIVABLE'))}""",
)
def q_status_report_alert(i):
    rows = reports.report_filter(report_headers(i), "ALERT", RUN_TS, i["fx_lookup"], "RECEIVABLE", status="ERROR")
    return _status_report(i, rows)


@query(
    "q_error_texts_hot",
    ["fx_err"],
    """
WITH ee AS (SELECT DISTINCT CASE WHEN document_id % 3 = 0 THEN 0 ELSE document_id % 50 END AS transaction_id, phase, error_message, error_type FROM fx_err)
SELECT transaction_id, count(*) AS entries, substr(string_agg(coalesce(phase, '') || ' - ' || coalesce(CASE WHEN error_type LIKE 'Unexpected Error%'
     THEN 'Unexpected Error - Contact tech support' ELSE substr(error_message, 1, 100) END, ''), '####'
     ORDER BY phase NULLS FIRST, error_message NULLS FIRST, error_type NULLS FIRST), 1, 4000) AS error_texts,
  count(*) FILTER (WHERE before_it < 4000) AS entries_shown
FROM (SELECT *, coalesce(sum(length(coalesce(phase, '') || ' - ' || coalesce(CASE WHEN error_type LIKE 'Unexpected Error%'
     THEN 'Unexpected Error - Contact tech support' ELSE substr(error_message, 1, 100) END, '')) + 4) OVER (PARTITION BY transaction_id
     ORDER BY phase NULLS FIRST, error_message NULLS FIRST, error_type NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before_it FROM ee)
GROUP BY transaction_id
""",
)
def q_error_texts_hot(i):
    """Few documents share the whole log, one holds a third of it: long texts that meet the cap."""
    key = F.when(F.col("document_id") % 3 == 0, 0).otherwise(F.col("document_id") % 50)
    texts = reports.error_texts(i["fx_err"].withColumn("transaction_id", key))
    return texts.select(
        "transaction_id", F.col("_entries").alias("entries"), F.col("_texts").alias("error_texts"), F.col("_shown").alias("entries_shown")
    )


@query(
    "q_error_rows",
    REPORT_VIEWS,
    f"""WITH {REPORT_HEAD_SQL}
SELECT DISTINCT r.transaction_id, r.document_num, e.phase, e.error_message, e.error_type FROM rh r JOIN fx_err e ON e.document_id = r.transaction_id
WHERE r.status_code IN ('RUNNING', 'ERROR')""",
)
def q_error_rows(i):
    return reports.error_rows(report_headers(i), i["fx_err"].withColumnRenamed("document_id", "transaction_id"))


# ---------------------------------------------------------------- print


_PRINTABLE = """
ph AS (SELECT k.* REPLACE (CASE WHEN k.eligible_flag = 'Y' AND k.status_code = 'PENDING' THEN 'SUCCESS' ELSE k.status_code END AS status_code),
   'data:image/png;base64,' || repeat('QR' || cast(k.transaction_id AS varchar), 700) AS signed_code, 'IRN' || cast(k.transaction_id AS varchar) AS irn,
   'ACK' || cast(k.transaction_id % 1000 AS varchar) AS ack_number, k.document_date AS ack_date, 'S' || k.document_num AS shipment_id,
   CASE WHEN k.transaction_id % 3 <> 0 THEN 'EW' || cast(k.transaction_id AS varchar) END AS eway_bill_number FROM cat k),
sel AS (SELECT * FROM ph WHERE status_code = 'SUCCESS' AND eligible_flag = 'Y' AND invoice_process IN
   (SELECT meaning FROM fx_lookup WHERE lookup_type = 'INVOICE_PROCESSES' AND description = '{p}') AND {match})"""
_LIST_NUM = "document_num IN (SELECT 'INV' || cast(document_id AS varchar) FROM fx_hdr WHERE priority = '1-URGENT' OR priority = '2-HIGH')"
_LIST_BATCH = "cast(batch_id AS varchar) IN (SELECT cast(batch_id AS varchar) FROM fx_hdr WHERE priority = '1-URGENT' AND batch_id < 20)"


def printable(i):
    done = F.when((F.col("eligible_flag") == "Y") & (F.col("status_code") == "PENDING"), "SUCCESS").otherwise(F.col("status_code"))
    coded = (F.col("eligible_flag") == "Y") & (F.col("status_code") == "PENDING")
    text = F.concat(F.lit("data:image/png;base64,"), F.repeat(F.concat(F.lit("QR"), F.col("transaction_id")), 700))
    key = F.col("transaction_id")
    answer = {
        "irn": F.concat(F.lit("IRN"), key), "ack_number": F.concat(F.lit("ACK"), key % 1000), "ack_date": F.col("document_date"),
        "shipment_id": F.concat(F.lit("S"), "document_num"), "eway_bill_number": F.when(key % 3 != 0, F.concat(F.lit("EW"), key)),
    }
    # the header table of a finished run is a written table, kept by id; its long codes are made where they are read
    written = i.once("printable", lambda: categorized(i, "receivable").withColumns({"status_code": done, "_coded": coded} | answer), "transaction_id")
    return written.withColumn("signed_code", F.when(F.col("_coded"), text)).drop("_coded")


def number_list(i):
    wanted = i["fx_hdr"].where(F.col("priority").isin("1-URGENT", "2-HIGH"))
    return wanted.select(F.concat(F.lit("INV"), F.col("document_id")).alias("value"))


@query(
    "q_select_documents",
    [*STAGE_VIEWS, "fx_hdr"],
    f"""WITH {CATEGORY_SQL}, {_PRINTABLE.format(p='TRANSFER', match=_LIST_NUM)},
sb AS (SELECT * FROM ph WHERE status_code = 'SUCCESS' AND eligible_flag = 'Y' AND invoice_process IN
   (SELECT meaning FROM fx_lookup WHERE lookup_type = 'INVOICE_PROCESSES' AND description = 'RECEIVABLE') AND {_LIST_BATCH})
SELECT 'invoice' AS mode, transaction_id, document_num, batch_id FROM sel UNION ALL SELECT 'batch', transaction_id, document_num, batch_id FROM sb""",
)
def q_select_documents(i):
    hdr = printable(i)
    batches = i["fx_hdr"].where("priority = '1-URGENT' AND batch_id < 20").select(F.col("batch_id").cast("string").alias("value"))
    by_number = reports.select_documents(hdr, number_list(i), "Multiple Invoices", i["fx_lookup"], "TRANSFER")
    by_batch = reports.select_documents(hdr, batches, "Multiple Batches", i["fx_lookup"], "RECEIVABLE")
    columns = ["mode", "transaction_id", "document_num", "batch_id"]
    return by_number.withColumn("mode", F.lit("invoice")).select(*columns).unionByName(
        by_batch.withColumn("mode", F.lit("batch")).select(*columns)
    )


_AMOUNTS = ["document_base_amount", "document_tax_amount", "document_total_amount", "quantity", "line_base_amount", "line_tax_amount", "line_total_amount"]
PRINT_OUT = (
    "transaction_id line_number code_1 code_2 document_num document_date invoice_type place_of_supply supply_type "
    "bill_from supplier_gstin bill_to recipient_gstin ship_from ship_to batch_id footer item_code item_name hsn tax_code"
).split() + reports.PRINTED + reports.ANSWERED + _AMOUNTS


def _commas(*columns):
    return " || ',' || ".join(f"coalesce(h.{c}, '')" for c in columns)


@query(
    "q_print_detail",
    [*STAGE_VIEWS, "fx_hdr"],
    f"""WITH {CATEGORY_SQL}, {_PRINTABLE.format(p='TRANSFER', match=_LIST_NUM)}
SELECT h.transaction_id, l.line_number, substr(replace(h.signed_code, 'data:image/png;base64,', ''), 1, 4000) AS code_1,
  nullif(substr(replace(h.signed_code, 'data:image/png;base64,', ''), 4001), '') AS code_2, h.document_num, h.document_date,
  h.document_type_code AS invoice_type, coalesce(h.pos_state_code_upd, '') || '(' || coalesce(h.pos_state_number_upd, '') || ')' AS place_of_supply,
  h.supply_type_code AS supply_type, {_commas('supplier_legal_name', 'supplier_address', 'supplier_place', 'supplier_state_name', 'supplier_pincode')} AS bill_from,
  h.supplier_gstin, {_commas('recipient_legal_name', 'recipient_address', 'recipient_place', 'recipient_pincode_upd')} AS bill_to, h.recipient_gstin,
  {_commas('supplier_legal_name', 'dispatch_from_address', 'dispatch_from_place', 'dispatch_from_pincode')} AS ship_from,
  {_commas('ship_to_legal_name', 'ship_to_address', 'ship_to_place', 'ship_to_pincode')} AS ship_to, h.batch_id, 'No sale' AS footer,
  h.supplier_state_code, h.recipient_state_code_upd, h.dispatch_from_state_code, h.ship_to_state_code, h.recipient_poc_name, h.recipient_phone_num,
  h.recipient_email, h.irn, h.ack_number, h.ack_date, h.eway_bill_number, h.shipment_id, cast(NULL AS varchar) AS shipment_num,
  l.item_code, l.item_name, l.hsn_code AS hsn, t.tax_name || '-' || cast(t.tax_rate AS varchar) AS tax_code,
  cast(round(h.total_base_amount, 2) AS double) AS document_base_amount, cast(round(h.total_tax_amount, 2) AS double) AS document_tax_amount,
  cast(round(h.gross_amount, 2) AS double) AS document_total_amount, cast(l.quantity AS double) AS quantity,
  cast(round(l.base_amount, 2) AS double) AS line_base_amount, cast(round(l.tax_amount, 2) AS double) AS line_tax_amount,
  cast(round(l.gross_amount, 2) AS double) AS line_total_amount
FROM sel h JOIN ln l ON l.transaction_id = h.transaction_id JOIN tx t ON t.transaction_id = l.transaction_id AND t.line_number = l.line_number""",
)
def q_print_detail(i):
    hdr, base = printable(i), run_headers(i)
    built = i.once("lines", lambda: lines.build_lines(stage(i), base, DOCUMENT, keep_key=True), PLACED)
    taxes = lines.build_taxes(stage(i), base, built, DOCUMENT, keep_key=True)
    selected = reports.select_documents(hdr, number_list(i), "Multiple Invoices", i["fx_lookup"], "TRANSFER")
    out = reports.print_detail(hdr, built, taxes, selected, footer="No sale", placed=PLACED)
    return doubles(out, *_AMOUNTS).select(*PRINT_OUT)


# ---------------------------------------------------------------- closure

_CLOSURE = """SELECT document_id, document_num, upper(strftime(creation_date, '%d-%b-%Y %H:%M:%S')) AS creation_date, requestor_id, requestor_name,
  CASE document_type_code WHEN 'PO' THEN 'Purchase Order' WHEN 'REQUISITION' THEN 'Purchase Requisition' END AS document_type, status_code,
  operating_unit_name, cast(amount AS double) AS amount FROM fx_closure WHERE {where}"""
CLOSURE_OUT = (
    "document_id document_num creation_date requestor_id requestor_name document_type status_code operating_unit_name amount"
).split()


@query(
    "q_closure_report_date",
    ["fx_closure"],
    _CLOSURE.format(where="status_code <> 'RE-EXTRACTED' AND document_type_code IN ('PO', 'REQUISITION') AND creation_date BETWEEN timestamp '1997-03-05 00:00:00' AND timestamp '2000-03-04 23:59:59'"),
)
def q_closure_report_date(i):
    out = reports.closure_report(i["fx_closure"], "DATE", RUN_TS, datetime(1997, 3, 5, 4), datetime(2000, 3, 4, 4))
    return doubles(out.select(*CLOSURE_OUT), "amount")


@query(
    "q_closure_report_request",
    ["fx_closure"],
    _CLOSURE.format(where="status_code = 'SUCCESS' AND document_type_code = 'REQUISITION' AND request_id = 3"),
)
def q_closure_report_request(i):
    out = reports.closure_report(
        i["fx_closure"], "REQUEST_ID", RUN_TS, status="SUCCESS", document_type="Purchase Requisition", request_id=3
    )
    return doubles(out.select(*CLOSURE_OUT), "amount")


@query(
    "q_closure_list",
    ["fx_closure"],
    _CLOSURE.format(where="status_code = 'PENDING' AND eligible_flag = 'Y' AND document_type_code IN ('PO', 'REQUISITION') AND request_id = 2"),
)
def q_closure_list(i):
    return doubles(reports.closure_list(i["fx_closure"], 2, "PENDING").select(*CLOSURE_OUT), "amount")


def packing_sql(status: str, max_length: int, max_batches: int) -> str:
    """The sequential rule itself: one address after the other, state = length of every batch."""
    empty = "[" + ", ".join(["''"] * max_batches) + "]"
    target = "CASE " + " ".join(f"WHEN length(s.b[{n}]) < {max_length} THEN {n}" for n in range(1, max_batches + 1)) + " ELSE 0 END"
    put = ", ".join(
        f"CASE WHEN {target} = {n} THEN s.b[{n}] || ' ' || a.email ELSE s.b[{n}] END" for n in range(1, max_batches + 1)
    )
    return f"""WITH RECURSIVE adr AS (SELECT status_code, document_type_code, requestor_email AS email,
   row_number() OVER (PARTITION BY document_type_code ORDER BY requestor_email) AS n, count(*) OVER (PARTITION BY document_type_code) AS total
   FROM (SELECT DISTINCT status_code, document_type_code, requestor_email FROM fx_closure WHERE eligible_flag = 'Y' AND status_code = '{status}'
         AND document_type_code IN ('PO', 'REQUISITION'))),
st AS (SELECT a.document_type_code, 1::BIGINT AS n, list_value(' ' || a.email{", ''" * (max_batches - 1)}) AS b, 1 AS placed FROM adr a WHERE a.n = 1
  UNION ALL
  SELECT a.document_type_code, a.n, list_value({put}), s.placed + CASE WHEN {target} > 0 THEN 1 ELSE 0 END
  FROM st s JOIN adr a ON a.document_type_code = s.document_type_code AND a.n = s.n + 1),
fin AS (SELECT s.*, a.total FROM st s JOIN adr a ON a.document_type_code = s.document_type_code AND a.n = s.n WHERE s.n = a.total),
out AS (SELECT '{status}' AS status_code, document_type_code, cast(unnest(range(1, {max_batches + 1})) AS integer) AS batch_no, trim(unnest(b)) AS recipients,
  total AS address_count, total - placed AS dropped_count FROM fin)"""


PACK_SQL = packing_sql("PENDING", 2500, 5)


@query("q_pack_recipients", ["fx_closure"], f"{PACK_SQL}\nSELECT * FROM out WHERE recipients <> ''")
def q_pack_recipients(i):
    who = recipients.closure_recipients(i["fx_closure"], "PENDING")
    return recipients.pack_recipients(who, ["status_code", "document_type_code"], "requestor_email")


@query("q_pack_recipients_old", ["fx_closure"], f"{packing_sql('SUCCESS', 3900, 3)}\nSELECT * FROM out WHERE recipients <> ''")
def q_pack_recipients_old(i):
    who = recipients.closure_recipients(i["fx_closure"], "SUCCESS")
    return recipients.pack_recipients(who, ["status_code", "document_type_code"], "requestor_email", 3900, 3)


@query(
    "q_recipient_overflow",
    ["fx_closure"],
    packing_sql("SUCCESS", 300, 2) + """
SELECT a.status_code, a.document_type_code, a.email AS requestor_email FROM adr a JOIN fin f ON f.document_type_code = a.document_type_code
WHERE a.n > f.placed""",
)
def q_recipient_overflow(i):
    """Short batches, so that some addresses do not fit."""
    who = recipients.closure_recipients(i["fx_closure"], "SUCCESS")
    return recipients.overflow(who, ["status_code", "document_type_code"], "requestor_email", 300, 2)


@query(
    "q_notification_batches",
    ["fx_closure"],
    f"""{PACK_SQL}
SELECT CASE document_type_code WHEN 'PO' THEN 'PO_EXTRACTION' ELSE 'PR_EXTRACTION' END AS process_name, batch_no, recipients, dropped_count
FROM out WHERE recipients <> ''""",
)
def q_notification_batches(i):
    return recipients.notification_batches(q_pack_recipients(i))
