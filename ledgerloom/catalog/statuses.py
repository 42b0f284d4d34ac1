"""Write-back, status transitions, payment payloads, purge and reassignment."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.catalog.documents import (
    CATEGORY_SQL, RECEIVABLE_SQL, STAGE_VIEWS, VALID_VIEWS, _LE, categorized, validated, validated_sql,
)
from ledgerloom.catalog.registry import NOW, RUN, RUN_TS, day_text, query
from ledgerloom.operators import headers, purge, reassign, writeback
from ledgerloom.session import fresh_path
from ledgerloom.sources.stored import StoredTable

_MESSAGE = "(SELECT max(meaning) FROM fx_lookup WHERE lookup_type = 'MESSAGES' AND enabled_flag = 'Y' AND lookup_code = {code})"


def _message_code(partial: bool) -> str:
    extra = ""
    if partial:
        b2b, b2c = _LE.format(c="irn_flag", v="'P'"), _LE.format(c="b2c_flag", v="'P'")
        extra = f"""
  WHEN eligible_flag = 'N' AND supply_type_code NOT IN ('B2C', 'NA') AND status_code = 'SUCCESS-INELIGIBLE' AND {b2b} THEN 'PARTIAL'
  WHEN eligible_flag = 'N' AND supply_type_code = 'B2C' AND status_code = 'SUCCESS-INELIGIBLE' AND {b2c} THEN 'PARTIAL'"""
    return f"""CASE WHEN status_code = 'ERROR' THEN 'EXTRACTION_ERROR' WHEN eligible_flag = 'Y' THEN 'PENDING'
  WHEN eligible_flag = 'N' AND supply_type_code = 'B2C' AND status_code = 'PENDING' THEN 'B2C_PENDING'{extra} ELSE 'NOT_ELIGIBLE' END"""


@query(
    "q_write_back",
    VALID_VIEWS,
    f"""WITH {RECEIVABLE_SQL},
r AS (SELECT *, {_message_code(True)} AS code FROM val)
SELECT s.document_id, s.document_num, r.supply_type_code AS result_type, {_MESSAGE.format(code='r.code')} AS result_message,
  r.eligible_flag AS result_eligible, CASE WHEN r.transaction_id IS NOT NULL THEN 'N' ELSE s.reprocess_flag END AS reprocess_flag,
  CASE WHEN r.transaction_id IS NOT NULL THEN 2 END AS result_request, r.transaction_id AS result_id
FROM fx_hdr s LEFT JOIN r ON r.document_num = s.document_num AND r.document_id = s.document_id""",
)
def q_write_back(i):
    result = writeback.source_message(validated(i, "receivable"), i["fx_lookup"], partial=True)
    source = i["fx_hdr"].select(
        "document_id", "document_num", "reprocess_flag",
        *[F.lit(None).cast("string").alias(c) for c in ("result_type", "result_message", "result_eligible")],
        F.lit(None).cast("int").alias("result_request"), F.lit(None).cast("long").alias("result_id"),
    )
    return writeback.write_back(
        source, result,
        {"document_num": F.col("document_num"), "document_id": F.col("document_id")},
        {
            "result_type": F.col("supply_type_code"), "result_message": F.col("source_message"),
            "result_eligible": F.col("eligible_flag"), "reprocess_flag": F.lit("N"), "result_request": F.lit(2),
            "result_id": F.col("transaction_id"),
        },
    )


def stored_invoices(i):
    """Invoices by month of their creation, the results of a run, and how these are written back."""
    source = i["fx_hdr"].select(
        "document_id", "document_num", "reprocess_flag", F.date_format("document_date", "yyyy-MM").alias("month"),
        *[F.lit(None).cast("string").alias(c) for c in ("result_type", "result_eligible")], F.lit(None).cast("long").alias("result_id"),
    )
    result = i.once("results of validation", lambda: validated(i, "receivable").select(
        "document_num", "document_id", "supply_type_code", "eligible_flag", "transaction_id"))
    on = {"document_num": F.col("document_num"), "document_id": F.col("document_id")}
    sets = {
        "result_type": F.col("supply_type_code"), "result_eligible": F.col("eligible_flag"), "reprocess_flag": F.lit("N"),
        "result_id": F.col("transaction_id"),
    }
    return source, result, on, sets


_STORED_SQL = """
SELECT s.document_id, s.document_num, strftime(s.document_date, '%Y-%m') AS month, r.supply_type_code AS result_type, r.eligible_flag AS result_eligible,
  CASE WHEN r.transaction_id IS NOT NULL THEN 'N' ELSE s.reprocess_flag END AS reprocess_flag, r.transaction_id AS result_id
FROM fx_hdr s {join} JOIN val r ON r.document_num = s.document_num AND r.document_id = s.document_id"""


@query("q_write_back_stored", VALID_VIEWS, f"WITH {RECEIVABLE_SQL}" + _STORED_SQL.format(join="LEFT"))
def q_write_back_stored(i):
    """The stored table after a write-back that rewrote only the months with changed rows."""
    source, result, on, sets = stored_invoices(i)
    table = StoredTable.create(source, fresh_path(i.spark), "month")
    table.rewrite(writeback.changed_rows(table.read(), result, on, sets), lambda rows: writeback.write_back(rows, result, on, sets))
    return table.read()


@query("q_changed_rows", VALID_VIEWS, f"WITH {RECEIVABLE_SQL}" + _STORED_SQL.format(join=""))
def q_changed_rows(i):
    return writeback.changed_rows(*stored_invoices(i))


@query(
    "q_touched_partitions", VALID_VIEWS,
    f"WITH {RECEIVABLE_SQL}" + """
SELECT strftime(s.document_date, '%Y-%m') AS month, count(*) AS changed_rows
FROM fx_hdr s JOIN val r ON r.document_num = s.document_num AND r.document_id = s.document_id GROUP BY 1""",
)
def q_touched_partitions(i):
    return writeback.touched_partitions(writeback.changed_rows(*stored_invoices(i)), "month")


_STATE_SQL = """st AS (SELECT document_id, document_num, batch_id, document_id % 12 AS request_id, CASE WHEN document_type = 'F' THEN 'ERROR' ELSE 'SUCCESS' END AS status_code FROM fx_hdr),
cur AS (SELECT DISTINCT document_num, batch_id FROM st WHERE request_id IN (2, 5, 7))"""


def stored_headers(i):
    """Headers of twelve requests, and the keys that a later run extracted again."""
    status = F.when(F.col("document_type") == "F", "ERROR").otherwise("SUCCESS")
    state = i["fx_hdr"].select("document_id", "document_num", "batch_id", (F.col("document_id") % 12).cast("int").alias("request_id"), status.alias("status_code"))
    return state, state.where(F.col("request_id").isin(2, 5, 7)).select("document_num", "batch_id"), {"document_num": None, "batch_id": 1}


@query(
    "q_supersede_stored", ["fx_hdr"],
    f"""WITH {_STATE_SQL}
SELECT document_id, document_num, batch_id, request_id, CASE WHEN status_code = 'ERROR' AND EXISTS (SELECT 1 FROM cur WHERE cur.document_num = st.document_num
   AND coalesce(cur.batch_id, 1) = coalesce(st.batch_id, 1)) THEN 'RE-EXTRACTED' ELSE status_code END AS status_code FROM st""",
)
def q_supersede_stored(i):
    """The stored headers after a run that rewrote only the requests with superseded rows."""
    state, current, keys = stored_headers(i)
    table = StoredTable.create(state, fresh_path(i.spark), "request_id")
    table.rewrite(headers.superseded_rows(table.read(), current, keys), lambda rows: headers.supersede(rows, current, keys))
    return table.read()


@query(
    "q_superseded_rows", ["fx_hdr"],
    f"""WITH {_STATE_SQL}
SELECT document_id, document_num, batch_id, request_id, 'RE-EXTRACTED' AS status_code FROM st WHERE status_code = 'ERROR'
  AND EXISTS (SELECT 1 FROM cur WHERE cur.document_num = st.document_num AND coalesce(cur.batch_id, 1) = coalesce(st.batch_id, 1))""",
)
def q_superseded_rows(i):
    return headers.superseded_rows(*stored_headers(i))


@query(
    "q_write_back_transfer",
    [*VALID_VIEWS, "fx_transfer"],
    f"""WITH {validated_sql('transfer')},
r AS (SELECT *, {_message_code(False)} AS code FROM val)
SELECT s.document_id, s.item_id, s.batch_id, r.supply_type_code AS result_type, {_MESSAGE.format(code='r.code')} AS result_message,
  r.eligible_flag AS result_eligible, r.transaction_id AS result_id
FROM fx_transfer s LEFT JOIN r ON r.document_num = coalesce(s.tax_invoice_no, s.del_challan_num) AND r.batch_id = s.batch_id""",
)
def q_write_back_transfer(i):
    result = writeback.source_message(validated(i, "transfer"), i["fx_lookup"], partial=False)
    source = i["fx_transfer"].select(
        "document_id", "item_id", "batch_id", "tax_invoice_no", "del_challan_num",
        *[F.lit(None).cast("string").alias(c) for c in ("result_type", "result_message", "result_eligible")],
        F.lit(None).cast("long").alias("result_id"),
    )
    return writeback.write_back(
        source, result,
        {"document_num": F.coalesce("tax_invoice_no", "del_challan_num"), "batch_id": F.col("batch_id")},
        {
            "result_type": F.col("supply_type_code"), "result_message": F.col("source_message"),
            "result_eligible": F.col("eligible_flag"), "result_id": F.col("transaction_id"),
        },
    ).drop("tax_invoice_no", "del_challan_num")


_OUTCOME = """SELECT DISTINCT request_id, document_type_code, CASE WHEN request_id % 2 = 0 THEN 'PENDING' ELSE 'SUCCESS' END AS status_code,
  NOT (request_id = 3 AND document_type_code = 'PO') AS sent FROM fx_closure WHERE document_type_code <> 'OTHER' AND request_id <> 4"""


@query(
    "q_closure_transition",
    ["fx_closure"],
    f"""WITH o AS ({_OUTCOME})
SELECT document_id, request_id, document_type_code,
  CASE WHEN EXISTS (SELECT 1 FROM o WHERE o.request_id = c.request_id AND o.document_type_code = c.document_type_code AND o.sent AND o.status_code = 'PENDING')
       THEN 'RUNNING' ELSE status_code END AS status_code,
  CASE WHEN EXISTS (SELECT 1 FROM o WHERE o.request_id = c.request_id AND NOT o.sent AND o.status_code = 'SUCCESS') THEN 'N'
       WHEN status_code = 'SUCCESS' AND EXISTS (SELECT 1 FROM o WHERE o.request_id = c.request_id AND o.document_type_code = c.document_type_code AND o.sent AND o.status_code = 'SUCCESS') THEN 'Y' END AS mail_sent_flag,
  CASE WHEN EXISTS (SELECT 1 FROM o WHERE o.request_id = c.request_id AND o.document_type_code = c.document_type_code AND o.sent AND o.status_code = 'PENDING') THEN 'Updating the status'
       WHEN EXISTS (SELECT 1 FROM o WHERE o.request_id = c.request_id AND NOT o.sent AND o.status_code = 'SUCCESS') THEN 'Mail not sent'
       WHEN status_code = 'SUCCESS' AND EXISTS (SELECT 1 FROM o WHERE o.request_id = c.request_id AND o.document_type_code = c.document_type_code AND o.sent AND o.status_code = 'SUCCESS') THEN 'Mail successfully sent' END AS status_message
FROM fx_closure c""",
)
def q_closure_transition(i):
    log = i["fx_closure"]
    outcome = log.where((F.col("document_type_code") != "OTHER") & (F.col("request_id") != 4)).select(
        "request_id", "document_type_code",
        F.when(F.col("request_id") % 2 == 0, "PENDING").otherwise("SUCCESS").alias("status_code"),
        (~((F.col("request_id") == 3) & (F.col("document_type_code") == "PO"))).alias("sent"),
    ).distinct()
    state = log.select(
        "document_id", "request_id", "document_type_code", "status_code",
        F.lit(None).cast("string").alias("mail_sent_flag"), F.lit(None).cast("string").alias("status_message"),
    )
    return writeback.closure_transition(state, outcome)


@query(
    "q_mark_sent",
    ["fx_hdr", "fx_err"],
    "SELECT document_id, CASE WHEN document_id IN (SELECT document_id FROM fx_err) THEN 'Y' ELSE 'N' END AS mail_sent FROM fx_hdr",
)
def q_mark_sent(i):
    state = i["fx_hdr"].select("document_id", F.lit("N").alias("mail_sent"))
    return writeback.mark_sent(state, i["fx_err"], "document_id")


@query(
    "q_merge_outcome",
    ["fx_vendor_queue", "fx_vendor_outcome"],
    """
SELECT q.employee_id, q.org_id, q.vendor_site_code, q.request_id,
  CASE WHEN q.process_flag = 'N' AND o.vendor_code IS NOT NULL THEN CASE WHEN o.error_msg IS NULL THEN 'S' ELSE 'E' END ELSE q.process_flag END AS process_flag,
  CASE WHEN q.process_flag = 'N' AND o.vendor_code IS NOT NULL THEN o.error_msg ELSE q.error_msg END AS error_msg,
  CASE WHEN q.process_flag = 'N' AND o.error_msg IS NULL THEN o.vendor_id ELSE q.vendor_id END AS vendor_id,
  CASE WHEN q.process_flag = 'N' AND o.error_msg IS NULL THEN o.vendor_site_id ELSE q.vendor_site_id END AS vendor_site_id
FROM fx_vendor_queue q LEFT JOIN fx_vendor_outcome o ON o.employee_id = q.employee_id AND o.vendor_code = q.vendor_code
  AND o.vendor_site_code = q.vendor_site_code AND o.org_id = q.org_id
""",
)
def q_merge_outcome(i):
    keys = ["employee_id", "vendor_code", "vendor_site_code", "org_id"]
    out = writeback.merge_outcome(
        i["fx_vendor_queue"], i["fx_vendor_outcome"], keys, ["vendor_id", "vendor_site_id"], F.col("process_flag") == "N"
    )
    return out.select("employee_id", "org_id", "vendor_site_code", "request_id", "process_flag", "error_msg", "vendor_id", "vendor_site_id")


@query(
    "q_reset_failed",
    ["fx_vendor_queue"],
    """
SELECT employee_id, org_id, vendor_site_code, CASE process_flag WHEN 'E' THEN 'N' ELSE process_flag END AS process_flag,
  CASE process_flag WHEN 'E' THEN 9 ELSE request_id END AS request_id, CASE WHEN process_flag <> 'E' THEN error_msg END AS error_msg FROM fx_vendor_queue
""",
)
def q_reset_failed(i):
    return writeback.reset_failed(i["fx_vendor_queue"], 9).select(
        "employee_id", "org_id", "vendor_site_code", "process_flag", "request_id", "error_msg"
    )


@query(
    "q_payment_payload",
    [*STAGE_VIEWS, "fx_vpa"],
    f"""WITH {CATEGORY_SQL}
SELECT c.transaction_id, c.document_num, 'data:text/plain;base64,' || base64(encode(v.vpa_details || chr(13) || c.supplier_legal_name || chr(13)
  || regexp_replace(cast(cast(c.gross_amount AS decimal(28,4)) AS varchar), '\\.?0+$', '') || chr(13) || c.document_num || chr(13) || 'REF-' || cast(c.transaction_id AS varchar) || chr(13))) AS payment_code,
  'SUCCESS' AS status_code, {_MESSAGE.format(code="'B2C_SUCCESS'")} AS status_message
FROM cat c JOIN fx_vpa v ON v.legal_entity_name = c.supplier_legal_name AND v.org_id = c.org_id
WHERE c.eligible_flag = 'N' AND c.status_code = 'PENDING' AND c.supply_type_code = 'B2C' AND coalesce(v.effective_end, {NOW} + INTERVAL 1 DAY) > {NOW}""",
)
def q_payment_payload(i):
    # read once, so nothing is gained by writing all columns of the header table first
    return writeback.payment_payload(categorized(i, "receivable"), i["fx_vpa"], i["fx_lookup"], RUN_TS)


# ---------------------------------------------------------------- purge

_ORPHAN = f"""
h AS (SELECT o_orderkey AS header_id, o_orderdate AS creation_date FROM orders),
orphan AS (SELECT header_id FROM h WHERE
 (NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = h.header_id)
  AND NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = h.header_id AND l.l_returnflag = 'R')
  AND NOT EXISTS (SELECT 1 FROM fx_receipt_if r WHERE r.header_id = h.header_id AND r.processing_status IN ('RUNNING', 'PENDING'))
  AND EXISTS (SELECT 1 FROM fx_receipt_if r WHERE r.header_id = h.header_id AND (r.processing_status = 'ERROR' OR r.transaction_status = 'ERROR')))
 OR (NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = h.header_id)
  AND NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = h.header_id AND l.l_returnflag = 'R')
  AND NOT EXISTS (SELECT 1 FROM fx_receipt_if r WHERE r.header_id = h.header_id)
  AND creation_date < {NOW} - INTERVAL 365 DAY))"""


def receipts(i):
    head = i["orders"].select(F.col("o_orderkey").alias("header_id"), F.col("o_orderdate").cast("timestamp_ntz").alias("creation_date"))
    lines = i["lineitem"].select(F.col("l_orderkey").alias("header_id"), "l_returnflag")
    return head, lines.select("header_id"), lines.where("l_returnflag = 'R'").select("header_id"), i["fx_receipt_if"]


def orphans(i):
    return purge.find_orphans(*receipts(i), days=365, run_ts=RUN_TS)


@query("q_find_orphans", ["fx_receipt_if"], f"WITH {_ORPHAN}\nSELECT header_id FROM orphan")
def q_find_orphans(i):
    return orphans(i).select("header_id")


@query(
    "q_purge_kept",
    ["fx_receipt_if"],
    f"""WITH {_ORPHAN}
SELECT 'header' AS part, header_id, cast(NULL AS bigint) AS interface_id FROM h WHERE header_id NOT IN (SELECT header_id FROM orphan)
UNION ALL SELECT 'interface', header_id, interface_id FROM fx_receipt_if WHERE header_id NOT IN (SELECT header_id FROM orphan)""",
)
def q_purge_kept(i):
    head, *_ = receipts(i)
    kept, log, _ = purge.purge_with_audit(head, orphans(i), ["header_id"], RUN)
    kept_if, _, _ = purge.purge_with_audit(i["fx_receipt_if"], log, ["header_id"], RUN)
    a = kept.select(F.lit("header").alias("part"), "header_id", F.lit(None).cast("long").alias("interface_id"))
    return a.unionByName(kept_if.select(F.lit("interface").alias("part"), "header_id", "interface_id"))


@query(
    "q_purge_log",
    ["fx_receipt_if"],
    f"""WITH {_ORPHAN}
SELECT r.header_id, r.interface_id, r.processing_status, 'batch' AS created_by, '2001-08-01 00:00:00' AS created_at, 2 AS request_id
FROM fx_receipt_if r WHERE r.header_id IN (SELECT header_id FROM orphan)""",
)
def q_purge_log(i):
    _, log, _ = purge.purge_with_audit(i["fx_receipt_if"], orphans(i), ["header_id"], RUN)
    return log.select("header_id", "interface_id", "processing_status", "created_by", day_text("created_at"), "request_id")


@query(
    "q_purge_check",
    ["fx_receipt_if"],
    f"""WITH {_ORPHAN}
SELECT (SELECT count(*) FROM h) AS input_rows, (SELECT count(*) FROM h) - (SELECT count(*) FROM orphan) AS kept_rows,
  (SELECT count(*) FROM orphan) AS logged_rows, true AS agrees""",
)
def q_purge_check(i):
    head, *_ = receipts(i)
    return purge.purge_with_audit(head, orphans(i), ["header_id"], RUN)[2]


# ---------------------------------------------------------------- reassignment

_NOTIF = """SELECT DISTINCT notification_id, item_key, -priority AS priority,
  CASE WHEN more_info_role IS NULL THEN subject ELSE 'More Information Requested ' || subject END AS subject,
  strftime(coalesce(sent_date, begin_date), '%Y-%m-%d %H:%M:%S') AS begin_date, status, message_type, recipient_role, more_info_role,
  language, strftime(due_date, '%Y-%m-%d %H:%M:%S') AS due_date, strftime(end_date, '%Y-%m-%d %H:%M:%S') AS end_date, message_name, mail_status,
  from_user, from_role, CASE WHEN more_info_role IS NULL THEN to_user ELSE more_info_role END AS to_user, original_recipient
FROM fx_notif WHERE status = 'OPEN' AND message_type = '{kind}' AND recipient_role = 'USER3' AND {match}"""


def _notifications(i, kind, key):
    out = reassign.select_notifications(i["fx_notif"], kind, key, "USER3")
    return out.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("begin_date", "due_date", "end_date")})


@query("q_notifications_pr", ["fx_notif"], _NOTIF.format(kind="REQAPPRV", match="item_key LIKE '%13%'"))
def q_notifications_pr(i):
    return _notifications(i, "PR", "13-4-1")


@query("q_notifications_po", ["fx_notif"], _NOTIF.format(kind="POAPPRV", match="item_key LIKE '%%'"))
def q_notifications_po(i):
    return _notifications(i, "PO", None)


@query("q_notifications_ap", ["fx_notif"], _NOTIF.format(kind="APINVAPR", match="item_key LIKE '13-%'"))
def q_notifications_ap(i):
    return _notifications(i, "AP", "13-")


@query(
    "q_reassign_plan",
    ["fx_notif"],
    f"""SELECT notification_id, item_key, recipient_role AS from_role, 'USER8' AS to_role, cast(NULL AS varchar) AS forward_comment, 'RULE' AS action_source
FROM ({_NOTIF.format(kind='APINVAPR', match='true')})""",
)
def q_reassign_plan(i):
    return reassign.reassign_plan(reassign.select_notifications(i["fx_notif"], "AP", None, "USER3"), "USER8")
