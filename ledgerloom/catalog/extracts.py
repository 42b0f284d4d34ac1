"""Scans, extracts, staging, audit and overlays."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ledgerloom.catalog.registry import RUN, RUN_TS, day_text, doubles, query
from ledgerloom.operators import staging
from ledgerloom.operators.lookups import check_code
from ledgerloom.operators.reports import split_params
from ledgerloom.session import cut_placed
from ledgerloom.sources.sinks import report_line

FLOOR = datetime(1996, 1, 1)
MAIL = "stock@example.com"
# extracts look back far enough to cover most of the documents
DAYS = 1800


@query(
    "q_recent_window",
    ["fx_hdr"],
    """
SELECT document_id, document_num, reprocess_flag FROM fx_hdr
WHERE document_date > date_trunc('day', timestamp '2001-08-01 00:00:00') - INTERVAL 90 DAY
  AND document_date >= timestamp '1996-01-01 00:00:00' AND coalesce(reprocess_flag, 'Y') = 'Y'
""",
)
def recent_window(i):
    rows = staging.recent_window(i["fx_hdr"], "document_date", 90, FLOOR, "reprocess_flag", RUN_TS)
    return rows.select("document_id", "document_num", "reprocess_flag")


def transfer_tables(i, days=DAYS):
    return {
        "transfers": staging.recent_window(i["fx_transfer"], "creation_date", days, FLOOR, "reprocess_flag", RUN_TS),
        "stock_moves": i["fx_move"],
        "move_orders": i["fx_move_order"],
        "tax_lines": i["fx_tax_line"],
        "tax_factors": i["fx_tax_factor"],
        "tax_types": i["fx_tax_name"],
        "items": i["fx_item"],
        "organizations": i["fx_org"],
    }


def receivable_tables(i, days=DAYS):
    return {
        "invoices": i["fx_invoice"],
        "open_invoices": staging.recent_window(
            i["fx_invoice"], "creation_date", days, FLOOR, "reprocess_flag", RUN_TS, whole_days=False
        ),
        "invoice_lines": i["fx_invoice_line"],
        "orders": i["fx_order"],
        "order_lines": i["fx_order_line"],
        "trx_types": i["fx_trx_type"],
        "customers": i["fx_cust"],
        "tax_lines": i["fx_tax_line"],
        "tax_factors": i["fx_tax_factor"],
        "tax_types": i["fx_tax_name"],
        "items": i["fx_item"],
        "organizations": i["fx_org"],
        "legal_entities": i["fx_le"].withColumnRenamed("le_id", "legal_entity_id"),
        "lookup": i["fx_lookup"],
    }


# what the views of the extracts take of the tables that they join on the document
OF_HEADERS = "document_id document_num document_date document_type cust_id le_id batch_id query_type reprocess_flag priority".split()
OF_LINES = "document_id item_id line_key quantity hsn_code base_amount tax_rate".split()
DOCUMENT = ["document_id"]
# view -> (columns, columns to bucket by), as the transfer extracts write them; the other views are joined from these
PLACED_TRANSFERS = {
    "fx_hdr": (OF_HEADERS, DOCUMENT), "fx_line": ([*OF_LINES, "price"], DOCUMENT),
    "fx_invoice": (["document_id", "context", "org_id"], DOCUMENT),
}

TRANSFER_VIEWS = ["fx_transfer", "fx_move", "fx_move_order", "fx_tax_line", "fx_tax_factor", "fx_item", "fx_org"]
WINDOW = f"""creation_date > date_trunc('day', timestamp '2001-08-01 00:00:00') - INTERVAL {DAYS} DAY
  AND creation_date >= timestamp '1996-01-01 00:00:00' AND coalesce(reprocess_flag, 'Y') = 'Y'"""
MONEY = ("price", "quantity", "base_amount", "tax_amount", "gross_amount", "tax_rate", "taxable_amount")
TRANSFER_OUT = (
    "query_type document_num batch_id supplier_gstin supplier_legal_name supplier_location_id recipient_gstin "
    "recipient_location_id recipient_phone_num recipient_poc_name ship_to_location_id customer_type_code org_id "
    "shipment_id shipment_num item_code item_name price quantity hsn_code base_amount tax_amount gross_amount "
    "tax_trx_id tax_trx_line_id tax_name tax_rate taxable_amount"
).split()


def _out(df, columns):
    return doubles(df.select(*columns), *[c for c in columns if c in MONEY])


def _money_sql(columns):
    return ", ".join(f"cast({c} AS double) AS {c}" if c in MONEY else c for c in columns)


_FIXED = f"""'{MAIL}' AS recipient_email, cast(NULL AS varchar) AS recipient_pan, o.location_id AS dispatch_location_id,
       'Regular' AS document_type_code, cast(NULL AS bigint) AS document_id, cast(NULL AS bigint) AS cust_id, cast(NULL AS varchar) AS preceding_doc_num,
       cast(NULL AS timestamp) AS preceding_doc_date, 'false' AS sez_unit"""
_TAXED = """
SELECT {distinct} {kind} AS query_type, x.tax_invoice_num AS document_num, m.batch_id, o.gstin AS supplier_gstin,
       o.legal_name AS supplier_legal_name, o.location_id AS supplier_location_id, d.gstin AS recipient_gstin,
       d.location_id AS recipient_location_id, {contact}, upper(d.reporting_code) AS customer_type_code, o.org_id,
       {shipment} AS shipment_id, m.shipment_num, it.item_code, it.item_name, m.actual_cost AS price,
       abs(m.move_quantity) AS quantity, f.hsn_code,
       coalesce(m.actual_cost, 0) * abs(m.move_quantity) AS base_amount,
       (SELECT sum(y.tax_amount) FROM fx_tax_line y WHERE y.entity_code = 'MTL_TRANSACTION' AND y.trx_line_id = m.move_line_id
           AND y.organization_id = m.organization_id AND y.trx_id = coalesce(m.transaction_batch_id, m.transaction_set_id)) AS tax_amount,
       coalesce(m.actual_cost, 0) * abs(m.move_quantity) +
       (SELECT sum(y.tax_amount) FROM fx_tax_line y WHERE y.entity_code = 'MTL_TRANSACTION' AND y.trx_line_id = m.move_line_id
           AND y.organization_id = m.organization_id AND y.trx_id = coalesce(m.transaction_batch_id, m.transaction_set_id)) AS gross_amount,
       f.trx_id AS tax_trx_id, f.trx_line_id AS tax_trx_line_id, n.tax_name, x.tax_rate, x.tax_amount AS taxable_amount, s.creation_date AS document_date,
       m.owning_organization_id, o.line_of_business, m.item_id, x.tax_type_id, {fixed}
FROM (SELECT * FROM fx_transfer WHERE {window}) s
JOIN fx_tax_line x ON s.tax_invoice_no = x.tax_invoice_num AND x.entity_code = 'MTL_TRANSACTION'
JOIN fx_move m ON x.trx_line_id = m.move_line_id AND x.organization_id = m.organization_id
  AND x.trx_id = coalesce(m.transaction_batch_id, m.transaction_set_id) AND s.item_id = m.item_id
JOIN fx_tax_factor f ON f.trx_id = m.transaction_batch_id AND f.trx_line_id = m.move_line_id
  AND f.entity_code = 'MTL_TRANSACTION' AND f.det_factor_id = x.det_factor_id
JOIN fx_tax_name n ON n.tax_type_id = x.tax_type_id
JOIN fx_item it ON it.item_id = m.item_id AND it.organization_id = m.organization_id
LEFT JOIN fx_org o ON o.organization_id = m.owning_organization_id
LEFT JOIN fx_org d ON d.organization_id = m.transfer_organization_id
{more}
"""
TRANSIT_SQL = _TAXED.format(
    fixed=_FIXED, distinct="", kind="'Intransit'", window=WINDOW, shipment="m.shipment_id",
    contact="s.poc_no AS recipient_phone_num, m.poc_name AS recipient_poc_name, d.location_id AS ship_to_location_id",
    more="WHERE s.project IS NULL AND s.mo_header_id IS NULL",
)
INTER_SQL = _TAXED.format(
    fixed=_FIXED, distinct="DISTINCT", kind="'DTP Inter-state'", window=WINDOW, shipment="h.shipment_id",
    contact="h.phone AS recipient_phone_num, h.poc_name AS recipient_poc_name, h.location_id AS ship_to_location_id",
    more="JOIN fx_move_order h ON h.header_id = s.mo_header_id",
)
CHALLAN_SQL = f"""
SELECT DISTINCT 'DTP Intra-state' AS query_type, s.del_challan_num AS document_num, s.batch_id, o.gstin AS supplier_gstin,
       o.legal_name AS supplier_legal_name, o.location_id AS supplier_location_id, cast(NULL AS varchar) AS recipient_gstin,
       h.location_id AS recipient_location_id, h.phone AS recipient_phone_num, h.poc_name AS recipient_poc_name,
       h.location_id AS ship_to_location_id, cast(NULL AS varchar) AS customer_type_code, o.org_id, h.shipment_id,
       s.shipment_num, it.item_code, it.item_name, s.material_cost AS price, abs(s.quantity) AS quantity,
       cast(NULL AS varchar) AS hsn_code, coalesce(s.material_cost, 0) * abs(s.quantity) AS base_amount, 0 AS tax_amount,
       coalesce(s.material_cost, 0) * abs(s.quantity) AS gross_amount, cast(NULL AS bigint) AS tax_trx_id,
       cast(NULL AS bigint) AS tax_trx_line_id, cast(NULL AS varchar) AS tax_name, cast(NULL AS double) AS tax_rate,
       cast(NULL AS double) AS taxable_amount, s.creation_date AS document_date, h.organization_id AS owning_organization_id,
       o.line_of_business, s.item_id, cast(NULL AS integer) AS tax_type_id, {_FIXED}
FROM fx_transfer s
JOIN fx_move_order h ON h.header_id = s.mo_header_id
JOIN fx_item it ON it.item_id = s.item_id AND it.organization_id = s.from_warehouse_id
LEFT JOIN fx_org o ON o.organization_id = s.from_warehouse_id
WHERE s.tax_invoice_no IS NULL AND s.del_challan_num IS NOT NULL AND s.to_warehouse_id IS NULL AND {WINDOW}
"""


@query("q_extract_transit", TRANSFER_VIEWS, f"SELECT {_money_sql(TRANSFER_OUT)} FROM ({TRANSIT_SQL})")
def extract_transit(i):
    return cut_placed(_out(staging.extract_transit(transfer_tables(i.placed(PLACED_TRANSFERS)), MAIL), TRANSFER_OUT))


@query("q_extract_inter", TRANSFER_VIEWS, f"SELECT {_money_sql(TRANSFER_OUT)} FROM ({INTER_SQL})")
def extract_inter(i):
    return cut_placed(_out(staging.extract_inter(transfer_tables(i.placed(PLACED_TRANSFERS)), MAIL), TRANSFER_OUT))


CHALLAN_OUT = [c for c in TRANSFER_OUT if c not in (
    "recipient_gstin", "customer_type_code", "hsn_code", "tax_trx_id", "tax_trx_line_id", "tax_name", "tax_rate", "taxable_amount")]


@query("q_extract_challan", TRANSFER_VIEWS, f"SELECT {_money_sql(CHALLAN_OUT)} FROM ({CHALLAN_SQL})")
def extract_challan(i):
    return _out(staging.extract_challan(transfer_tables(i), MAIL), CHALLAN_OUT)


@query(
    "q_stage_union",
    TRANSFER_VIEWS,
    f"SELECT {_money_sql(TRANSFER_OUT)} FROM ({TRANSIT_SQL} UNION ALL {INTER_SQL} UNION ALL {CHALLAN_SQL})",
)
def stage_union(i):
    t = transfer_tables(i.placed(PLACED_TRANSFERS))
    # the taxed extracts share their rows, as in a run; here these stay with their transactions
    placed = "tax_trx_id"
    rows = i.once("transfer rows", lambda: staging.transfer_rows(t), placed)
    staged = staging.stage_union(
        staging.extract_transit(t, MAIL, rows, placed), staging.extract_inter(t, MAIL, rows, placed),
        staging.extract_challan(t, MAIL, placed=True),
    )
    return cut_placed(_out(staged, TRANSFER_OUT))


INVOICE_VIEWS = [
    "fx_invoice", "fx_invoice_line", "fx_order", "fx_order_line", "fx_trx_type", "fx_cust", "fx_tax_line",
    "fx_tax_factor", "fx_item", "fx_org", "fx_lookup",
]
INVOICE_OUT = (
    "query_type document_num document_id supplier_gstin supplier_legal_name supplier_location_id recipient_gstin "
    "recipient_location_id recipient_phone_num recipient_poc_name ship_to_legal_name ship_to_location_id "
    "customer_type_code document_type_code preceding_doc_num preceding_doc_id batch_id org_id item_code item_name "
    "price quantity hsn_code base_amount tax_amount gross_amount tax_trx_id tax_trx_line_id tax_name tax_rate "
    "taxable_amount"
).split()
_OPEN_INVOICE = f"""
(SELECT i.*, t.type, c.gstin, c.location_id, c.phone, c.email, c.pan, c.cust_name, upper(c.customer_type) AS ctype,
        sc.cust_name AS ship_name, sc.location_id AS ship_location
 FROM fx_invoice i JOIN fx_trx_type t ON t.trx_type_id = i.trx_type_id AND t.org_id = i.org_id
 JOIN fx_cust c ON c.cust_id = i.cust_id LEFT JOIN fx_cust sc ON sc.cust_id = i.ship_to_cust_id
 WHERE i.creation_date > timestamp '2001-08-01 00:00:00' - INTERVAL {DAYS} DAY
   AND i.creation_date >= timestamp '1996-01-01 00:00:00' AND coalesce(i.reprocess_flag, 'Y') = 'Y'
   AND i.complete_flag = 'Y' AND t.type IN (SELECT lookup_code FROM fx_lookup WHERE lookup_type = 'DOCUMENT_TYPES'
        AND description = 'Document Type Code' AND enabled_flag = 'Y'))"""
_INVOICE_HEAD = """i.document_num, i.document_id, o.gstin AS supplier_gstin,
   {entity} AS supplier_legal_name, o.location_id AS supplier_location_id, i.gstin AS recipient_gstin,
   i.location_id AS recipient_location_id, i.phone AS recipient_phone_num, i.cust_name AS recipient_poc_name,
   {ship} AS ship_to_legal_name, coalesce(i.ship_location, i.location_id) AS ship_to_location_id,
   i.ctype AS customer_type_code, i.type AS document_type_code, f.original_invoice_num AS preceding_doc_num,
   (SELECT min(p.document_id) FROM fx_invoice p WHERE p.document_num = f.original_invoice_num) AS preceding_doc_id,
   i.batch_id, i.org_id, i.email AS recipient_email, i.pan AS recipient_pan, o.location_id AS dispatch_location_id, i.document_date,
   i.cust_id, f.original_invoice_date AS preceding_doc_date, 'false' AS sez_unit, o.line_of_business, x.tax_type_id,
   o.organization_id AS owning_organization_id"""
_LINE_TAX = """(SELECT sum(y.tax_amount) FROM fx_tax_line y WHERE y.entity_code = '{entity}' AND y.trx_id = f.trx_id
   AND y.trx_line_id = f.trx_line_id)"""


def _order_sql(ship: str) -> str:
    tax = _LINE_TAX.format(entity="OE_ORDER_HEADERS")
    return f"""
SELECT i.context AS query_type, {_INVOICE_HEAD.format(entity="o.legal_name", ship=ship)}, ol.item_id, it.item_code, it.item_name,
       abs(ol.unit_price) AS price, ol.ordered_quantity AS quantity, coalesce(f.hsn_code, f.sac_code) AS hsn_code,
       abs(ol.unit_price * ol.ordered_quantity) AS base_amount, abs({tax}) AS tax_amount,
       abs({tax} + ol.unit_price * ol.ordered_quantity) AS gross_amount, f.trx_id AS tax_trx_id,
       f.trx_line_id AS tax_trx_line_id, n.tax_name, x.tax_rate, abs(x.tax_amount) AS taxable_amount
FROM {_OPEN_INVOICE} i
JOIN fx_invoice_line l ON l.document_id = i.document_id AND l.line_context = 'ORDER ENTRY'
JOIN fx_order h ON h.order_number = l.order_number
JOIN fx_order_line ol ON ol.order_id = h.order_id AND ol.order_line_id = l.order_line_id
JOIN fx_item it ON it.item_id = ol.item_id AND it.organization_id = ol.line_org_id
JOIN fx_tax_line x ON x.trx_id = h.order_id AND x.trx_line_id = ol.order_line_id AND x.entity_code = 'OE_ORDER_HEADERS'
JOIN fx_tax_name n ON n.tax_type_id = x.tax_type_id
JOIN fx_tax_factor f ON f.trx_id = h.order_id AND f.trx_line_id = ol.order_line_id AND f.entity_code = 'OE_ORDER_HEADERS'
LEFT JOIN fx_org o ON o.organization_id = h.ship_from_org_id
WHERE i.context = 'ORDER ENTRY'
"""


ORDER_SQL = _order_sql("i.ship_name")
_DIRECT_TAX = _LINE_TAX.format(entity="TRANSACTIONS")
DIRECT_SQL = f"""
SELECT 'AR INVOICE' AS query_type,
       {_INVOICE_HEAD.format(entity="(SELECT e.legal_name FROM fx_le e WHERE e.le_id = i.legal_entity_id)", ship="i.ship_name")},
       l.item_id, it.item_code, coalesce(it.item_name, l.description) AS item_name, abs(l.unit_price) AS price,
       coalesce(l.quantity_invoiced, l.quantity_credited) AS quantity, coalesce(f.hsn_code, f.sac_code) AS hsn_code,
       abs(coalesce(l.quantity_invoiced, l.quantity_credited) * l.unit_price) AS base_amount, abs({_DIRECT_TAX}) AS tax_amount,
       abs(coalesce(l.quantity_invoiced, l.quantity_credited) * l.unit_price + {_DIRECT_TAX}) AS gross_amount,
       f.trx_id AS tax_trx_id, f.trx_line_id AS tax_trx_line_id, n.tax_name, x.tax_rate, abs(x.tax_amount) AS taxable_amount
FROM {_OPEN_INVOICE} i
JOIN fx_invoice_line l ON l.document_id = i.document_id AND coalesce(l.line_context, 'XXXXXX') <> 'ORDER ENTRY'
  AND l.line_type = 'LINE'
LEFT JOIN fx_item it ON it.item_id = l.item_id AND it.organization_id = l.warehouse_id
JOIN fx_tax_line x ON x.trx_id = i.document_id AND x.trx_line_id = l.invoice_line_id AND x.entity_code = 'TRANSACTIONS'
JOIN fx_tax_name n ON n.tax_type_id = x.tax_type_id
JOIN fx_tax_factor f ON f.trx_id = i.document_id AND f.trx_line_id = l.invoice_line_id AND f.org_id = i.org_id
  AND f.entity_code = 'TRANSACTIONS'
LEFT JOIN fx_org o ON o.organization_id = f.organization_id
"""


def open_receivables(i):
    """Open invoices drive the extracts; preceding documents are looked up among all invoices."""
    t = receivable_tables(i)
    return t | {"invoices": t["open_invoices"], "all_invoices": t["invoices"]}


@query("q_extract_orders", INVOICE_VIEWS, f"SELECT {_money_sql(INVOICE_OUT)} FROM ({ORDER_SQL})")
def extract_orders(i):
    return _out(staging.extract_order_invoices(open_receivables(i)), INVOICE_OUT)


@query(
    "q_extract_orders_as_is",
    INVOICE_VIEWS,
    f"SELECT {_money_sql(INVOICE_OUT)} FROM ({_order_sql('CASE WHEN i.ship_name IS NOT NULL THEN i.cust_name END')})",
)
def extract_orders_as_is(i):
    return _out(staging.extract_order_invoices(open_receivables(i), ship_to_name="as_is"), INVOICE_OUT)


@query("q_extract_direct", [*INVOICE_VIEWS, "fx_le"], f"SELECT {_money_sql(INVOICE_OUT)} FROM ({DIRECT_SQL})")
def extract_direct(i):
    return _out(staging.extract_direct_invoices(open_receivables(i)), INVOICE_OUT)


@query(
    "q_line_tax_total",
    ["fx_tax_line"],
    """
SELECT trx_id, trx_line_id, entity_code, cast(sum(tax_amount) AS double) AS line_tax FROM fx_tax_line
GROUP BY trx_id, trx_line_id, entity_code
""",
)
def line_tax_total(i):
    return doubles(staging.line_tax_total(i["fx_tax_line"], ["trx_id", "trx_line_id", "entity_code"]), "line_tax")


@query(
    "q_audit_append",
    ["fx_closure"],
    """
SELECT document_id, document_num, status_code, '2001-08-01 00:00:00' AS created_at, 'batch' AS created_by,
       '2001-08-01 00:00:00' AS updated_at, 'batch' AS updated_by, 7 AS session_id, 2 AS request_id FROM fx_closure
""",
)
def audit_append(i):
    rows = staging.with_audit(i["fx_closure"].select("document_id", "document_num", "status_code"), RUN)
    return rows.select(
        "document_id", "document_num", "status_code", day_text("created_at"), "created_by", day_text("updated_at"),
        "updated_by", "session_id", "request_id",
    )


@query(
    "q_overlay_rows",
    ["fx_eligible", "fx_hdr", "fx_le"],
    """
SELECT legal_entity, irn_flag, b2c_flag FROM fx_eligible
WHERE legal_entity NOT IN (SELECT e.legal_name FROM fx_hdr h JOIN fx_le e ON e.le_id = h.le_id
                           WHERE h.reprocess_flag = 'N' AND h.priority = '1-URGENT')
UNION ALL
SELECT DISTINCT e.legal_name, 'P', 'N' FROM fx_hdr h JOIN fx_le e ON e.le_id = h.le_id
WHERE h.reprocess_flag = 'N' AND h.priority = '1-URGENT'
""",
)
def overlay_rows(i):
    urgent = i["fx_hdr"].where((F.col("reprocess_flag") == "N") & (F.col("priority") == "1-URGENT"))
    rows = (
        urgent.join(i["fx_le"].select("le_id", "legal_name"), "le_id")
        .select(F.col("legal_name").alias("legal_entity"), F.lit("P").alias("irn_flag"), F.lit("N").alias("b2c_flag"))
        .distinct()
    )
    return staging.overlay_rows(i["fx_eligible"].select("legal_entity", "irn_flag", "b2c_flag"), rows, ["legal_entity"])


@query(
    "q_update_where",
    ["fx_closure"],
    """
SELECT document_id, request_id, eligible_flag,
       CASE WHEN request_id = 3 AND creation_date > timestamp '1998-10-01 00:00:00' THEN 'Partly enabled' ELSE status_code END AS status_code
FROM fx_closure
""",
)
def update_where(i):
    from ledgerloom.functions.moments import at

    hit = (F.col("request_id") == 3) & (F.col("creation_date") > at(datetime(1998, 10, 1)))
    return staging.update_where(i["fx_closure"], hit, {"status_code": "Partly enabled"}).select(
        "document_id", "request_id", "eligible_flag", "status_code"
    )


@query(
    "q_check_code",
    ["fx_hdr", "fx_lookup"],
    """
SELECT document_id, document_type FROM fx_hdr WHERE document_type IN
 (SELECT lookup_code FROM fx_lookup WHERE lookup_type = 'REPORT_STATUS' AND description = 'STATUS_REPORT' AND enabled_flag = 'Y')
""",
)
def q_check_code(i):
    return check_code(i["fx_hdr"], "document_type", i["fx_lookup"], "REPORT_STATUS", "STATUS_REPORT").select(
        "document_id", "document_type"
    )


@query(
    "q_split_params",
    ["fx_hdr"],
    r"""
WITH lists AS (
  SELECT document_id, 'INV' || cast(document_id AS varchar) || ', ,inv ' || cast(document_id + 1 AS varchar) || ' , '
     || (CASE WHEN document_id % 4 = 1 THEN 'A-7' WHEN document_id % 4 = 2 THEN ',,' ELSE 'x9' END) || ',' AS params FROM fx_hdr)
SELECT document_id, item FROM (
  SELECT document_id, trim(unnest(string_split(rtrim(replace(trim(params), ' ', ''), ','), ','))) AS item
  FROM lists WHERE NOT regexp_matches(params, '[^0-9A-Za-z, ]'))
WHERE item <> ''
""",
)
def q_split_params(i):
    lists = i["fx_hdr"].select(
        "document_id",
        F.concat(
            F.lit("INV"), F.col("document_id"), F.lit(", ,inv "), F.col("document_id") + 1, F.lit(" , "),
            F.when(F.col("document_id") % 4 == 1, "A-7").when(F.col("document_id") % 4 == 2, ",,").otherwise("x9"),
            F.lit(","),
        ).alias("params"),
    )
    return split_params(lists, "params", "item").select("document_id", "item")


@query(
    "q_report_lines",
    ["fx_closure"],
    """
SELECT document_id, coalesce(operating_unit_name, '') || '~' || coalesce(document_type_code, '') || '~' || cast(document_id AS varchar)
   || '~' || document_num || '~' || coalesce(status_code, '') || '~' || requestor_name || '~' || cast(amount AS varchar) AS line
FROM fx_closure
""",
)
def report_lines(i):
    columns = ["operating_unit_name", "document_type_code", "document_id", "document_num", "status_code", "requestor_name", "amount"]
    return i["fx_closure"].select("document_id", report_line(columns).alias("line"))
