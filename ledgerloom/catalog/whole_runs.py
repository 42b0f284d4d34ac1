"""Complete extraction runs from the source-shaped tables to the validated documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.catalog.documents import validated_sql
from ledgerloom.catalog.extracts import (
    CHALLAN_SQL, DAYS, DIRECT_SQL, DOCUMENT, FLOOR, INTER_SQL, INVOICE_VIEWS, MAIL, OF_HEADERS, OF_LINES, ORDER_SQL, PLACED_TRANSFERS,
    TRANSFER_VIEWS, TRANSIT_SQL, receivable_tables, transfer_tables,
)
from ledgerloom.catalog.registry import RUN, doubles, query
from ledgerloom.catalog.statuses import _MESSAGE, _message_code
from ledgerloom.plans.runs import run_extract

SHARED_VIEWS = ["fx_loc", "fx_lookup", "fx_eligible", "fx_hdr"]
RUN_OUT = (
    "transaction_id document_num invoice_process status_code supply_type_code eligible_flag shipment_type status_message "
    "line_count is_service total_base_amount total_tax_amount gross_amount"
).split()
_AMOUNTS = ("total_base_amount", "total_tax_amount", "gross_amount")


def _steps_sql(mode: str, stage: str) -> str:
    """The steps of the document queries over a staging relation built by the extracts; ids are dense in
    the order of the document number. Documents waiting for a payment code get it at the end."""
    chain = validated_sql(mode)
    chain = chain.replace(",\n    document_id AS transaction_id FROM fx_stage", " FROM fx_stage")
    chain = chain.replace("hdr AS (SELECT * FROM hdr0", "hdr AS (SELECT *, 999 + row_number() OVER (ORDER BY document_num) AS transaction_id FROM hdr0")
    chain = chain.replace("transaction_id) > 7", "transaction_id) > 1000")
    chain = chain.replace("coalesce((SELECT max(k.meaning)", "((SELECT max(k.meaning)").replace(
        "AND k.enabled_flag = 'Y'), r.document_type_code)", "AND k.enabled_flag = 'Y'))"
    )
    chain = chain.replace("FROM fx_hdr s WHERE s.document_num = p.preceding_doc_num", "FROM fx_invoice s WHERE s.document_num = p.preceding_doc_num")
    return f"WITH fx_stage AS ({stage}),\n{chain}"


def _run_sql(mode: str, stage: str) -> str:
    return f"""{_steps_sql(mode, stage)},
cls AS (SELECT transaction_id, count(*) AS line_count, count(DISTINCT item_class) AS n, min(item_class) AS k FROM ln0 GROUP BY transaction_id),
pay AS (SELECT v.transaction_id FROM val v WHERE v.eligible_flag = 'N' AND v.status_code = 'PENDING' AND v.supply_type_code = 'B2C' AND EXISTS
  (SELECT 1 FROM fx_vpa a WHERE a.legal_entity_name = v.supplier_legal_name AND a.org_id = v.org_id
   AND coalesce(a.effective_end, timestamp '2005-01-01 00:00:00') > timestamp '2001-08-01 00:00:00'))
SELECT v.transaction_id, v.document_num, v.invoice_process, CASE WHEN p.transaction_id IS NOT NULL THEN 'SUCCESS' ELSE v.status_code END AS status_code,
  v.supply_type_code, v.eligible_flag, v.shipment_type, CASE WHEN p.transaction_id IS NOT NULL THEN 'Payment code created' ELSE v.status_message END AS status_message,
  c.line_count, CASE WHEN c.n > 1 THEN 'M' WHEN c.k = 'GOODS' THEN 'N' WHEN c.k = 'SERVICE' THEN 'Y' END AS is_service,
  cast(v.total_base_amount AS double) AS total_base_amount, cast(v.total_tax_amount AS double) AS total_tax_amount, cast(v.gross_amount AS double) AS gross_amount
FROM val v LEFT JOIN cls c ON c.transaction_id = v.transaction_id LEFT JOIN pay p ON p.transaction_id = v.transaction_id"""


def _source_sql(mode: str, stage: str, source: str, columns: str, keys: str) -> str:
    """Source documents after the run."""
    return f"""{_steps_sql(mode, stage)},
r AS (SELECT *, {_message_code(mode == 'receivable')} AS code FROM val)
SELECT {columns}, r.supply_type_code AS result_type, {_MESSAGE.format(code='r.code')} AS result_message, r.eligible_flag AS result_eligible,
  r.transaction_id AS result_id, CASE WHEN r.transaction_id IS NOT NULL THEN 2 END AS result_request,
  CASE WHEN r.transaction_id IS NOT NULL THEN 'N' ELSE s.reprocess_flag END AS reprocess_flag
FROM {source} s LEFT JOIN r ON {keys}"""


_STAGE_OUT = (
    "query_type, document_id, document_num, document_date, document_type_code, supplier_gstin, supplier_legal_name, supplier_location_id, org_id, "
    "owning_organization_id, line_of_business, sez_unit, recipient_gstin, recipient_location_id, recipient_phone_num, recipient_email, recipient_poc_name, "
    "recipient_pan, customer_type_code, cust_id, ship_to_location_id, dispatch_location_id, batch_id, preceding_doc_num, preceding_doc_date, item_code, "
    "item_name, item_id, quantity, price, hsn_code, base_amount, tax_amount, gross_amount, tax_trx_id, tax_trx_line_id, tax_name, tax_rate, taxable_amount, tax_type_id"
)


def _stage_sql(*parts: str) -> str:
    return " UNION ALL ".join(f"SELECT {_STAGE_OUT} FROM ({p})" for p in parts)


def _tables(i, tables):
    return tables | {
        "locations": i["fx_loc"], "lookup": i["fx_lookup"], "eligible": i["fx_eligible"], "payment_addresses": i["fx_vpa"]
    }


TRANSFER_STAGE, RECEIVABLE_STAGE = _stage_sql(TRANSIT_SQL, INTER_SQL, CHALLAN_SQL), _stage_sql(ORDER_SQL, DIRECT_SQL)
TRANSFER_RUN, RECEIVABLE_RUN = [*TRANSFER_VIEWS, *SHARED_VIEWS, "fx_vpa"], [*INVOICE_VIEWS, "fx_le", *SHARED_VIEWS, "fx_vpa"]
RESULT_OUT = ["result_type", "result_message", "result_eligible", "result_id", "result_request", "reprocess_flag"]


_OF_INVOICES = (
    "document_id document_num document_date creation_date complete_flag reprocess_flag context cust_id ship_to_cust_id trx_type_id "
    "org_id legal_entity_id batch_id shipment_id document_type"
).split()

_OF_FACTORS = (
    "document_id document_num trx_id trx_line_id entity_code det_factor_id hsn_code sac_code organization_id org_id original_invoice_num "
    "original_invoice_date base_amount tax_rate"
).split()
_ITEMS = (["item_id", "organization_id", "item_code", "item_name"], ["item_id", "organization_id"])


# view -> (columns, columns to bucket by), as the runs write them; the other views are joined from these
PLACED_VIEWS = {
    "transfer": PLACED_TRANSFERS,
    "receivable": {
        "fx_hdr": (OF_HEADERS[:-1], DOCUMENT), "fx_line": ([*OF_LINES, "item_name", "source_line"], DOCUMENT),
        "fx_invoice": (_OF_INVOICES, DOCUMENT), "fx_tax_factor": (_OF_FACTORS, DOCUMENT), "fx_item": _ITEMS,
    },
}


def _transfer_run(i):
    i = i.placed(PLACED_VIEWS["transfer"])
    tables = _tables(i, transfer_tables(i) | {"transfers": i["fx_transfer"]})
    return run_extract(tables, "transfer", RUN, 1000, DAYS, FLOOR, MAIL, on_violation="exclude")


def _receivable_run(i):
    i = i.placed(PLACED_VIEWS["receivable"])
    return run_extract(
        _tables(i, receivable_tables(i)), "receivable", RUN, 1000, DAYS, FLOOR, on_violation="exclude", note_codes=("O",)
    )


@query("q_extract_run_transfer", TRANSFER_RUN, _run_sql("transfer", TRANSFER_STAGE))
def q_extract_run_transfer(i):
    return doubles(_transfer_run(i).headers.select(*RUN_OUT), *_AMOUNTS)


@query("q_extract_run_receivable", RECEIVABLE_RUN, _run_sql("receivable", RECEIVABLE_STAGE))
def q_extract_run_receivable(i):
    return doubles(_receivable_run(i).headers.select(*RUN_OUT), *_AMOUNTS)


@query(
    "q_run_source_transfer",
    TRANSFER_RUN,
    _source_sql("transfer", TRANSFER_STAGE, "fx_transfer", "s.document_id, s.item_id, s.batch_id",
                "r.document_num = coalesce(s.tax_invoice_no, s.del_challan_num) AND r.batch_id = s.batch_id"),
)
def q_run_source_transfer(i):
    return _transfer_run(i).source.select("document_id", "item_id", "batch_id", *RESULT_OUT)


@query(
    "q_run_source_receivable",
    RECEIVABLE_RUN,
    _source_sql("receivable", RECEIVABLE_STAGE, "fx_invoice", "s.document_id, s.document_num",
                "r.document_num = s.document_num AND r.document_id = s.document_id"),
)
def q_run_source_receivable(i):
    return _receivable_run(i).source.select("document_id", "document_num", *RESULT_OUT)
