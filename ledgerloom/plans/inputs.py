"""Input views that stand in for the source system's tables, derived from the TPC-H-like test tables.

The SQL is the common subset of Spark SQL and DuckDB, so the same text feeds a query and its independent
check; only inputs are shared this way. `{name}` refers to a table or to another view, `{ts}` is the name of
the zone-less timestamp type. CASE expressions on key remainders inject NULLs, bad codes and duplicates at
every scale; where rows must be absent, they are chosen by an attribute (balance, priority, type).
"""

from __future__ import annotations

import string
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.session import cut_buckets, cut_lineage

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

VIEWS: dict[str, str] = {}

VIEWS["fx_loc"] = """
SELECT n_nationkey AS location_id,
       CASE WHEN n_regionkey = 4 THEN 'US' ELSE 'IN' END AS country_code,
       lpad(cast(n_nationkey + 1 AS string), 2, '0') AS state_number,
       'S' || cast(n_nationkey AS string) AS state_code,
       n_name AS state_name,
       'A1-' || n_name AS address1,
       CASE WHEN n_nationkey % 7 = 3 THEN NULL ELSE 'A2-' || n_name END AS address2,
       CASE WHEN n_nationkey % 11 = 5 THEN NULL ELSE 'CITY' || cast(n_nationkey AS string) END AS place,
       cast(110000 + n_nationkey AS string) AS pincode,
       CASE WHEN n_nationkey % 5 = 2 THEN NULL ELSE 'D-' || n_name END AS description
FROM {nation}
"""

VIEWS["fx_le"] = """
SELECT s_suppkey AS le_id, s_name AS legal_name, s_nationkey AS location_id, s_suppkey % 6 AS org_id,
       CASE WHEN s_suppkey % 33 = 2 THEN NULL ELSE 'LOB' || cast(s_suppkey % 3 AS string) END AS line_of_business,
       CASE WHEN s_suppkey % 17 = 0 THEN NULL
            WHEN s_suppkey % 19 = 0 THEN 'GSTNOTAVAILABLE'
            ELSE lpad(cast((s_nationkey + (CASE WHEN s_suppkey % 13 = 5 THEN 2 ELSE 1 END)) AS string), 2, '0')
                 || 'LEGCE' || lpad(cast(s_suppkey % 10000 AS string), 4, '0') || 'K1Z5' END AS gstin,
       CASE s_suppkey % 4 WHEN 0 THEN 'Unregistered' WHEN 3 THEN NULL ELSE 'Regular' END AS reporting_code
FROM {supplier}
"""

VIEWS["fx_cust"] = """
SELECT c_custkey AS cust_id, c_name AS cust_name, c_nationkey AS location_id,
       CASE WHEN c_custkey % 9 = 0 THEN NULL WHEN c_custkey % 31 = 1 THEN 'MYSTERY'
            WHEN c_mktsegment = 'BUILDING' THEN 'REGULAR' WHEN c_mktsegment = 'HOUSEHOLD' THEN 'REGULAR'
            WHEN c_mktsegment = 'AUTOMOBILE' THEN 'UNREGISTERED'
            WHEN c_mktsegment = 'MACHINERY' THEN 'SEZ' ELSE 'EXPORT' END AS customer_type,
       CASE WHEN c_custkey % 23 = 0 THEN NULL
            ELSE lpad(cast((c_nationkey + (CASE WHEN c_custkey % 27 = 4 THEN 2 ELSE 1 END)) AS string), 2, '0') || 'CUS'
                 || (CASE c_custkey % 4 WHEN 0 THEN 'P' WHEN 1 THEN 'C' WHEN 2 THEN 'H' ELSE 'Q' END)
                 || 'E' || lpad(cast(c_custkey % 10000 AS string), 4, '0') || 'K1Z'
                 || (CASE WHEN c_custkey % 29 = 0 THEN '' ELSE '5' END) END AS gstin,
       'CUS' || (CASE c_custkey % 4 WHEN 0 THEN 'P' WHEN 1 THEN 'C' WHEN 2 THEN 'H' ELSE 'Q' END)
             || 'E' || lpad(cast((c_custkey + (CASE WHEN c_custkey % 37 = 0 THEN 1 ELSE 0 END)) % 10000 AS string), 4, '0') || 'K' AS pan,
       CASE WHEN c_custkey % 41 = 0 THEN NULL ELSE 'PH' || cast(c_custkey AS string) END AS phone,
       CASE WHEN c_custkey % 43 = 0 THEN NULL ELSE 'c' || cast(c_custkey AS string) || '@example.com' END AS email
FROM {customer}
"""

VIEWS["fx_lookup"] = """
SELECT v.*, (CASE WHEN lookup_type = 'PAN_VENDOR_TYPE' AND lookup_code = 'H' THEN cast('1999-03-31 00:00:00' AS {ts})
                  WHEN lookup_type = 'PAN_VENDOR_TYPE' AND lookup_code = 'C' THEN cast('2030-12-31 00:00:00' AS {ts}) END) AS effective_end
FROM (VALUES
 ('CUSTOMER_TYPES','REG','Regular','Regular','Y'), ('CUSTOMER_TYPES','UNR','Unregistered','Unregistered','Y'),
 ('CUSTOMER_TYPES','SEZ','Sez','SEZ Type','Y'), ('CUSTOMER_TYPES','EXP','Export','Export Type','Y'),
 ('CUSTOMER_TYPES','OLD','Mystery','Regular','N'),
 ('DOCUMENT_TYPES','F','INV','Document Type Code','Y'), ('DOCUMENT_TYPES','O','CRN','Document Type Code','Y'),
 ('DOCUMENT_TYPES','P','DBN','Document Type Code','N'),
 ('INVOICE_PROCESSES','AR INVOICE','AR INVOICE','RECEIVABLE','Y'),
 ('INVOICE_PROCESSES','ORDER ENTRY','ORDER ENTRY','RECEIVABLE','Y'),
 ('INVOICE_PROCESSES','INTRANSIT','Intransit','TRANSFER','Y'),
 ('INVOICE_PROCESSES','DTP INTER-STATE','DTP Inter-state','TRANSFER','Y'),
 ('INVOICE_PROCESSES','DTP INTRA-STATE','DTP Intra-state','TRANSFER','Y'),
 ('REPORT_STATUS','ERROR','Error','STATUS_REPORT','Y'), ('REPORT_STATUS','PENDING','Pending','STATUS_REPORT','Y'),
 ('REPORT_STATUS','RUNNING','Running','STATUS_REPORT','N'), ('REPORT_STATUS','F','Final','STATUS_REPORT','Y'),
 ('REPORT_STATUS','O','Open','STATUS_REPORT','Y'), ('REPORT_STATUS','P','Partial','STATUS_REPORT','N'),
 ('PAN_VENDOR_TYPE','P','Individual','pan','Y'), ('PAN_VENDOR_TYPE','C','Company','pan','Y'),
 ('PAN_VENDOR_TYPE','H','Huf','pan','Y'),
 ('SEX','M','Male','sex','Y'), ('SEX','F','Female','sex','Y'),
 ('TITLE','MR.','Mister','title','Y'), ('TITLE','MS.','Miss','title','Y'),
 ('HOME_OFFICE','O','Office','mail','Y'),
 ('RESIDENTIAL_STATUS','RO','Resident and ordinarily resident','status','Y'),
 ('MESSAGES','PENDING','Marked for integration','msg','Y'), ('MESSAGES','NOT_ELIGIBLE','Not eligible','msg','Y'),
 ('MESSAGES','B2C_PENDING','Payment code pending','msg','Y'), ('MESSAGES','PARTIAL','Partially enabled','msg','Y'),
 ('MESSAGES','B2C_SUCCESS','Payment code created','msg','Y'), ('MESSAGES','B2C_ERROR','Payment code failed','msg','Y'),
 ('MESSAGES','EXTRACTION_ERROR','Extraction error','msg','Y')
) AS v(lookup_type, lookup_code, meaning, description, enabled_flag)
"""

VIEWS["fx_eligible"] = """
SELECT s_name AS legal_entity,
       CASE s_suppkey % 5 WHEN 0 THEN 'P' WHEN 1 THEN 'N' ELSE 'Y' END AS irn_flag,
       CASE s_suppkey % 4 WHEN 0 THEN 'P' WHEN 1 THEN 'N' ELSE 'Y' END AS b2c_flag,
       cast('2000-01-01 00:00:00' AS {ts}) AS effective_start,
       CASE WHEN s_suppkey % 3 = 0 THEN NULL WHEN s_suppkey % 8 = 1 THEN cast('2001-01-01 00:00:00' AS {ts})
            ELSE cast('2003-01-01 00:00:00' AS {ts}) END AS effective_end
FROM {supplier} WHERE s_acctbal > 0
"""

VIEWS["fx_hdr"] = """
SELECT o.o_orderkey AS document_id,
       (CASE WHEN o.o_orderkey % 211 = 0 THEN '0' WHEN o.o_orderkey % 223 = 0 THEN '/' ELSE '' END)
         || 'INV' || cast((o.o_orderkey - (CASE WHEN o.o_orderkey % 500 = 1 OR o.o_orderkey % 700 = 3 THEN 1 ELSE 0 END)) AS string) AS document_num,
       cast(o.o_orderdate AS {ts}) AS document_date, o.o_orderstatus AS document_type, o.o_custkey AS cust_id,
       l.le_id, (CASE WHEN o.o_orderkey % 3 = 0 THEN NULL ELSE o.o_orderkey % 40 END) AS batch_id,
       (CASE WHEN o.o_orderkey % 10 = 1 THEN 1 ELSE 2 END) AS request_id,
       (CASE WHEN o.o_orderkey % 4 = 0 THEN 'DTP Intra-state' WHEN o.o_orderkey % 4 = 1 THEN 'DTP Inter-state'
             WHEN o.o_orderkey % 4 = 2 THEN 'Intransit' ELSE 'AR INVOICE' END) AS query_type,
       (CASE WHEN o.o_orderkey % 5 = 0 THEN 'N' WHEN o.o_orderkey % 5 = 1 THEN 'Y' ELSE NULL END) AS reprocess_flag,
       (o.o_orderkey % 43 = 0) AS self_recipient,
       cast(o.o_totalprice AS decimal(14,2)) AS source_total, o.o_orderpriority AS priority
FROM {orders} o
LEFT JOIN (SELECT l_orderkey, min(l_suppkey) AS le_id FROM {lineitem} GROUP BY l_orderkey) l ON l.l_orderkey = o.o_orderkey
"""

VIEWS["fx_line"] = """
SELECT l.l_orderkey AS document_id, 'P' || cast(l.l_partkey AS string) AS item_code, p.p_name AS item_name,
       l.l_partkey AS item_id, l.l_suppkey AS warehouse_id, l.l_linenumber AS source_line,
       l.l_partkey * 100 + l.l_linenumber AS line_key, cast(l.l_shipdate AS {ts}) AS ship_date,
       cast(l.l_quantity AS decimal(12,2)) AS quantity,
       CASE WHEN l.l_partkey % 53 = 7 THEN NULL ELSE cast(p.p_retailprice AS decimal(12,2)) END AS price,
       (CASE p.p_size % 7 WHEN 0 THEN NULL WHEN 1 THEN '9983' WHEN 2 THEN '99831' WHEN 3 THEN '847130'
             WHEN 4 THEN '84713010' WHEN 5 THEN '847' ELSE '12345678901234' END) AS hsn_code,
       cast(l.l_extendedprice AS decimal(12,2)) AS base_amount,
       cast((CASE WHEN l.l_orderkey % 6 = 5 THEN 0 ELSE l.l_tax END) AS decimal(4,2)) AS tax_rate
FROM {lineitem} l JOIN {part} p ON p.p_partkey = l.l_partkey
"""

VIEWS["fx_tax_name"] = """
SELECT * FROM (VALUES (1, 'CGST', 'INTRA'), (2, 'SGST', 'INTRA'), (3, 'IGST', 'INTER'))
 AS v(tax_type_id, tax_name, movement)
"""

# one row per document x line x tax, as the extracts would leave it
VIEWS["fx_stage"] = """
SELECT h.query_type, h.document_id, h.document_num, h.document_date, h.document_type AS document_type_code,
       e.gstin AS supplier_gstin, e.legal_name AS supplier_legal_name, e.location_id AS supplier_location_id,
       e.org_id, h.le_id AS owning_organization_id, e.line_of_business, 'false' AS sez_unit,
       CASE WHEN h.query_type = 'DTP Intra-state' THEN NULL WHEN h.self_recipient THEN e.gstin ELSE c.gstin END AS recipient_gstin,
       c.location_id AS recipient_location_id, c.phone AS recipient_phone_num, c.email AS recipient_email,
       c.cust_name AS recipient_poc_name, c.pan AS recipient_pan, c.customer_type AS customer_type_code, h.cust_id,
       CASE WHEN h.document_id % 13 = 4 THEN NULL WHEN h.document_id % 13 = 7 THEN (c.location_id + 1) % 25
            ELSE c.location_id END AS ship_to_location_id,
       e.location_id AS dispatch_location_id, h.batch_id,
       CASE WHEN h.document_type = 'O' THEN 'INV' || cast(h.document_id - 1 AS string) END AS preceding_doc_num,
       CASE WHEN h.document_type <> 'O' THEN NULL
            WHEN h.document_id % 9 = 0 THEN cast('1999-09-09 00:00:00' AS {ts}) ELSE q.prior_date END AS preceding_doc_date,
       l.item_code, l.item_name, l.item_id, l.quantity, l.price, l.hsn_code, l.base_amount,
       CASE WHEN h.query_type = 'DTP Intra-state' THEN cast(0 AS decimal(20,4))
            ELSE cast(l.base_amount * l.tax_rate AS decimal(20,4)) END AS tax_amount,
       CASE WHEN h.query_type = 'DTP Intra-state' THEN cast(l.base_amount AS decimal(20,4))
            ELSE cast(l.base_amount + l.base_amount * l.tax_rate AS decimal(20,4)) END AS gross_amount,
       CASE WHEN h.query_type = 'DTP Intra-state' THEN NULL ELSE h.document_id END AS tax_trx_id,
       CASE WHEN h.query_type = 'DTP Intra-state' THEN NULL ELSE l.line_key END AS tax_trx_line_id,
       CASE WHEN h.query_type = 'DTP Intra-state' THEN NULL
            WHEN h.document_id % 70 = 11 THEN 'CESS' ELSE t.tax_name END AS tax_name,
       CASE WHEN h.query_type = 'DTP Intra-state' THEN NULL
            WHEN t.movement = 'INTRA' THEN cast(l.tax_rate * 0.5 AS decimal(6,3))
            ELSE cast(l.tax_rate AS decimal(6,3)) END AS tax_rate,
       CASE WHEN h.query_type = 'DTP Intra-state' THEN NULL
            WHEN t.movement = 'INTRA' THEN cast(l.base_amount * l.tax_rate * 0.5 AS decimal(20,5))
            ELSE cast(l.base_amount * l.tax_rate AS decimal(20,5)) END AS taxable_amount,
       CASE WHEN h.query_type = 'DTP Intra-state' THEN NULL ELSE t.tax_type_id END AS tax_type_id
FROM {fx_hdr} h
JOIN {fx_cust} c ON c.cust_id = h.cust_id
JOIN {fx_le} e ON e.le_id = h.le_id
JOIN {fx_line} l ON l.document_id = h.document_id
JOIN {fx_tax_name} t
  ON t.movement = (CASE WHEN e.location_id = c.location_id AND c.customer_type <> 'SEZ' AND c.customer_type <> 'EXPORT'
                        THEN 'INTRA' ELSE 'INTER' END)
LEFT JOIN (SELECT document_id + 1 AS next_id, document_date AS prior_date FROM {fx_hdr}) q ON q.next_id = h.document_id
"""


def select_list(view: str) -> str:
    """What a view selects, to be used over other joins of the same tables."""
    return VIEWS[view].strip().removeprefix("SELECT ").partition("\nFROM ")[0]


# What Spark runs for a view where the order of its joins matters at scale; the rows are those of the view, from its own
# select lists. Orders, customers, lines and parts move with the columns that were read; numbers, codes and names derived
# from them are computed where a document's rows have arrived. Customers come first, so a document moves to its key once.
ARRIVED = {
    "fx_stage": f"""
SELECT {select_list("fx_stage")}
FROM (SELECT o.*, k.*, s.le_id
      FROM {{orders}} o JOIN {{customer}} k ON k.c_custkey = o.o_custkey
      LEFT JOIN (SELECT l_orderkey, min(l_suppkey) AS le_id FROM {{lineitem}} GROUP BY l_orderkey) s ON s.l_orderkey = o.o_orderkey) o
JOIN LATERAL (SELECT {select_list("fx_hdr").replace("l.le_id", "o.le_id")}) h
JOIN LATERAL (SELECT {select_list("fx_cust")}) c
JOIN {{fx_le}} e ON e.le_id = h.le_id
JOIN ((SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate, l_tax,
              cast(l_quantity AS decimal(12,2)) AS l_quantity, cast(l_extendedprice AS decimal(12,2)) AS l_extendedprice
       FROM {{lineitem}}) l JOIN {{part}} p ON p.p_partkey = l.l_partkey) ON l.l_orderkey = h.document_id
JOIN LATERAL (SELECT {select_list("fx_line")}) l
JOIN {{fx_tax_name}}{VIEWS["fx_stage"].partition("JOIN {fx_tax_name}")[2]}"""
}

# As above, where the rows of a view are written to lie by one key: they move to it as read, and its columns are derived there.
PLACED_TEXT = {
    "fx_line": f"""
SELECT {select_list("fx_line").replace("p.p_", "l.p_")}
FROM (SELECT l.*, p.* FROM
      (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate, l_tax,
              cast(l_quantity AS decimal(12,2)) AS l_quantity, cast(l_extendedprice AS decimal(12,2)) AS l_extendedprice
       FROM {{lineitem}}) l JOIN {{part}} p ON p.p_partkey = l.l_partkey
      DISTRIBUTE BY l_orderkey) l
"""
}

VIEWS["fx_vpa"] = """
SELECT s_name AS legal_entity_name, s_suppkey % 6 AS org_id, 'upi://pay?pa=le' || cast(s_suppkey AS string) AS vpa_details,
       CASE WHEN s_suppkey % 4 = 1 THEN cast('2000-06-30 00:00:00' AS {ts})
            WHEN s_suppkey % 4 = 2 THEN cast('2005-06-30 00:00:00' AS {ts}) ELSE NULL END AS effective_end
FROM {supplier} WHERE s_acctbal > 1000
"""

VIEWS["fx_err"] = """
SELECT event_id AS document_id, (CASE WHEN event_type = 'error' THEN NULL ELSE event_type END) AS phase,
       props AS error_message, (CASE WHEN event_id % 6 = 0 THEN 'Unexpected Error X' ELSE 'Validation' END) AS error_type
FROM {events} WHERE event_type <> 'click'
UNION ALL
SELECT event_id, 'retry', 'again ' || props, 'Validation' FROM {events} WHERE event_type = 'view'
"""

VIEWS["fx_receipt_if"] = """
SELECT o_orderkey AS header_id, o_orderkey * 10 AS interface_id,
       (CASE o_orderkey % 4 WHEN 0 THEN 'ERROR' WHEN 1 THEN 'PENDING' WHEN 2 THEN 'COMPLETED' ELSE 'ERROR' END) AS processing_status,
       (CASE WHEN o_orderkey % 8 = 2 THEN 'ERROR' ELSE 'OK' END) AS transaction_status
FROM {orders} WHERE o_orderpriority <> '5-LOW'
UNION ALL
SELECT o_orderkey, o_orderkey * 10 + 1, 'ERROR', NULL FROM {orders} WHERE o_orderpriority = '1-URGENT'
"""

VIEWS["fx_notif"] = """
SELECT event_id AS notification_id, cast(user_id AS string) || '-' || cast(event_id % 7 AS string) AS item_key,
       (CASE WHEN event_id % 5 = 0 THEN 'CLOSED' ELSE 'OPEN' END) AS status,
       (CASE event_type WHEN 'view' THEN 'REQAPPRV' WHEN 'click' THEN 'POAPPRV' WHEN 'purchase' THEN 'APINVAPR' ELSE 'OTHER' END) AS message_type,
       'USER' || cast(user_id % 10 AS string) AS recipient_role,
       (CASE WHEN event_id % 4 = 0 THEN 'ROLE' || cast(user_id % 3 AS string) ELSE NULL END) AS more_info_role,
       'Subject ' || cast(event_id AS string) AS subject, cast(event_id % 100 AS int) AS priority,
       (CASE WHEN event_id % 6 = 0 THEN NULL ELSE cast(ts AS {ts}) END) AS sent_date, cast(ts AS {ts}) AS begin_date,
       (CASE WHEN event_id % 3 = 0 THEN cast(ts AS {ts}) END) AS due_date, cast(NULL AS {ts}) AS end_date,
       'FROM' || cast(event_id % 4 AS string) AS from_user, 'ROLE' || cast(event_id % 5 AS string) AS from_role,
       (CASE WHEN event_id % 7 = 0 THEN NULL ELSE 'User ' || cast(user_id % 10 AS string) END) AS to_user, 'APPROVE' AS message_name, 'EN' AS language,
       (CASE event_id % 3 WHEN 0 THEN 'SENT' WHEN 1 THEN 'MAIL' ELSE NULL END) AS mail_status,
       'USER' || cast(event_id % 10 AS string) AS original_recipient
FROM {events}
"""

VIEWS["fx_closure"] = """
SELECT o.o_orderkey AS document_id, 'D' || cast(o.o_orderkey AS string) AS document_num, cast(o.o_orderdate AS {ts}) AS creation_date,
       c.c_custkey AS requestor_id, c.c_name AS requestor_name, lower(replace(c.c_name, '#', '')) || '@example.com' AS requestor_email,
       (CASE WHEN o.o_orderkey % 10 < 5 THEN 'PO' WHEN o.o_orderkey % 10 < 9 THEN 'REQUISITION' ELSE 'OTHER' END) AS document_type_code,
       (CASE WHEN o.o_orderkey % 17 = 0 THEN NULL WHEN o.o_orderstatus = 'F' THEN 'SUCCESS'
             WHEN o.o_orderstatus = 'O' THEN 'PENDING' ELSE 'RE-EXTRACTED' END) AS status_code,
       (CASE WHEN o.o_orderkey % 6 = 0 THEN 'N' ELSE 'Y' END) AS eligible_flag,
       cast(o.o_orderkey % 5 AS int) AS request_id, cast(o.o_totalprice AS decimal(14,2)) AS amount,
       'OU' || cast(c.c_nationkey AS string) AS operating_unit_name
FROM {orders} o JOIN {customer} c ON c.c_custkey = o.o_custkey
"""

VIEWS["fx_person"] = """
SELECT c_custkey AS person_id, (CASE WHEN c_custkey % 8 = 0 THEN NULL ELSE 'E' || cast(c_custkey AS string) END) AS employee_number,
       (CASE WHEN c_custkey % 8 = 0 OR c_custkey % 50 = 3 THEN 'E' || cast(c_custkey + 1 AS string) ELSE NULL END) AS npw_number,
       c_name AS full_name, (CASE WHEN c_custkey % 8 = 0 THEN NULL ELSE 'Y' END) AS current_employee_flag,
       (CASE WHEN c_custkey % 8 = 0 THEN 'Y' ELSE NULL END) AS current_npw_flag,
       'CUS' || (CASE c_custkey % 5 WHEN 0 THEN 'P' WHEN 1 THEN 'C' WHEN 2 THEN 'H' ELSE 'Q' END) || 'E'
             || lpad(cast(c_custkey % 10000 AS string), 4, '0') || 'K' AS pan,
       (CASE WHEN c_custkey % 9 = 4 THEN NULL ELSE 'p' || cast(c_custkey AS string) || '@example.com' END) AS email_address
FROM {customer} WHERE c_acctbal > -500
"""

# two versions of each person
VIEWS["fx_people"] = """
SELECT p.*, cast('1995-01-01 00:00:00' AS {ts}) AS effective_start, cast('1999-12-31 00:00:00' AS {ts}) AS effective_end
FROM {fx_person} p
UNION ALL
SELECT p.*, cast('2000-01-01 00:00:00' AS {ts}),
       (CASE WHEN person_id % 15 = 2 THEN cast('2001-01-01 00:00:00' AS {ts}) ELSE NULL END)
FROM {fx_person} p
"""

# a second assignment for one market segment
VIEWS["fx_assign"] = """
SELECT c_custkey AS person_id, c_custkey * 10 + 1 AS assignment_id,
       (CASE WHEN c_custkey % 14 = 5 THEN NULL ELSE 'LE' || cast(c_nationkey % 6 AS string) END) AS legal_entity,
       cast('1996-01-01 00:00:00' AS {ts}) AS effective_start,
       (CASE WHEN c_custkey % 16 = 7 THEN cast('2000-06-30 00:00:00' AS {ts}) ELSE cast('4712-12-31 00:00:00' AS {ts}) END) AS effective_end
FROM {customer}
UNION ALL
SELECT c_custkey, c_custkey * 10 + 2, 'LE' || cast(c_nationkey % 4 AS string), cast('1999-01-01 00:00:00' AS {ts}),
       (CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE cast('4712-12-31 00:00:00' AS {ts}) END)
FROM {customer} WHERE c_mktsegment = 'BUILDING'
"""

# new-hire staging: two rows for some numbers never occur, people of low balance are not in fx_people yet
VIEWS["fx_hire"] = """
SELECT cast(c_nationkey % 2 AS int) AS flow_id, 'E' || cast(c_custkey AS string) AS employee_number,
       CASE WHEN c_custkey % 12 = 5 THEN 'E' ELSE 'V' END AS process_flag,
       CASE WHEN c_custkey % 18 = 1 THEN 'Contractor' ELSE 'Employee' END AS worker_type,
       CASE WHEN c_custkey % 10 = 4 THEN 'Terminated' WHEN c_custkey % 11 = 0 THEN NULL ELSE 'Active - Payroll Eligible' END AS emp_status,
       CASE c_custkey % 5 WHEN 0 THEN 'male' WHEN 1 THEN 'FEMALE' WHEN 2 THEN 'Male' WHEN 3 THEN NULL ELSE 'other' END AS gender,
       CASE c_custkey % 4 WHEN 0 THEN 'mr.' WHEN 1 THEN 'Ms.' WHEN 2 THEN NULL ELSE 'Dr' END AS title,
       CASE WHEN c_custkey % 3 = 0 THEN 'Work Email' ELSE 'Home' END AS mail_type,
       lpad(cast(c_custkey % 28 + 1 AS string), 2, '0') || '-' || (CASE c_custkey % 3 WHEN 0 THEN 'JAN' WHEN 1 THEN 'Jul' ELSE 'DEC' END)
         || '-' || lpad(cast(c_custkey % 100 AS string), 2, '0') AS dob
FROM {customer}
"""

VIEWS["fx_account_map"] = """
SELECT 'LE' || cast(r_regionkey AS string) AS legal_entity, 'OU' || cast(r_regionkey AS string) AS operating_unit,
       cast(100 + r_regionkey AS int) AS org_id,
       (CASE WHEN r_regionkey = 3 THEN 'N' ELSE 'Y' END) AS enabled_flag,
       'PRE-O' || cast(r_regionkey AS string) AS office_prepay, 'LIA-O' AS office_liab,
       (CASE WHEN r_regionkey = 1 THEN NULL ELSE 'PRE-H' END) AS home_prepay, 'LIA-H' AS home_liab,
       (CASE WHEN r_regionkey = 2 THEN NULL ELSE 'PRE-P' END) AS prov_prepay, 'LIA-P' AS prov_liab,
       cast(NULL AS {ts}) AS effective_end
FROM {region}
"""

VIEWS["fx_vendor"] = """
SELECT c_custkey AS employee_id, 50000 + c_custkey AS vendor_id, 'EE' || cast(c_custkey AS string) AS vendor_code,
       (CASE WHEN c_custkey % 2 = 0 THEN 'E' || cast(c_custkey AS string) || '-' || c_name ELSE c_name END) AS vendor_name
FROM {customer} WHERE c_acctbal > 8000
"""

VIEWS["fx_queue_site"] = """
SELECT c_custkey, 100 AS org_id, 'OFFICE' AS site FROM {customer} WHERE c_acctbal > 7000
UNION ALL SELECT c_custkey, 100, 'HOME' FROM {customer} WHERE c_acctbal > 7500
UNION ALL SELECT c_custkey, 101, 'OFFICE' FROM {customer} WHERE c_acctbal > 8000
UNION ALL SELECT c_custkey, 104, 'PROVISIONAL' FROM {customer} WHERE c_acctbal > 8500
"""

VIEWS["fx_vendor_queue"] = """
SELECT c.c_custkey AS employee_id, 'E' || cast(c.c_custkey AS string) || '-' || c.c_name AS vendor_name,
       'EE' || cast(c.c_custkey AS string) AS vendor_code, s.org_id, s.site AS vendor_site_code,
       'LE' || cast(c.c_nationkey % 6 AS string) AS legal_entity,
       (CASE WHEN c.c_custkey % 4 = 1 THEN 'E' WHEN c.c_custkey % 4 = 2 THEN 'S' ELSE 'N' END) AS process_flag,
       (CASE WHEN c.c_custkey % 4 = 1 THEN 'Error while creating Vendor, X' END) AS error_msg,
       cast(c.c_custkey % 3 AS int) AS request_id, cast(NULL AS bigint) AS vendor_id, cast(NULL AS bigint) AS vendor_site_id
FROM {customer} c JOIN {fx_queue_site} s ON s.c_custkey = c.c_custkey
"""

# what the external vendor service answered for queue rows
VIEWS["fx_vendor_outcome"] = """
SELECT q.employee_id, q.vendor_code, q.vendor_site_code, q.org_id,
       CASE WHEN q.employee_id % 5 = 0 THEN NULL ELSE 70000 + q.employee_id END AS vendor_id,
       CASE WHEN q.employee_id % 5 = 0 OR q.employee_id % 7 = 0 THEN NULL ELSE 80000 + q.employee_id * 10 + q.org_id % 10 END AS vendor_site_id,
       CASE WHEN q.employee_id % 5 = 0 THEN 'Error while creating Vendor, ' || q.vendor_code
            WHEN q.employee_id % 7 = 0 THEN 'Error while creating Vendor Site, ' || q.vendor_site_code END AS error_msg
FROM {fx_vendor_queue} q WHERE q.vendor_site_code <> 'PROVISIONAL'
"""

VIEWS["fx_reg"] = """
SELECT s_suppkey AS party_id, 1000 + s_suppkey AS reg_id,
       (CASE WHEN s_suppkey % 6 = 0 THEN 'PANNOTAVBL' WHEN s_suppkey % 7 = 2 THEN NULL
             WHEN s_suppkey % 7 = 3 THEN ' legce' || lpad(cast(s_suppkey % 10000 AS string), 4, '0') || 'k '
             ELSE 'LEGCE' || lpad(cast(s_suppkey % 10000 AS string), 4, '0') || 'K' END) AS registration_number,
       cast('1998-07-01 00:00:00' AS {ts}) AS effective_from,
       (CASE WHEN s_suppkey % 9 = 4 THEN cast('2000-01-01 00:00:00' AS {ts}) ELSE NULL END) AS effective_to
FROM {supplier} WHERE s_acctbal > -100
"""

VIEWS["fx_reg_in"] = """
SELECT s_suppkey AS party_id,
       (CASE WHEN s_suppkey % 10 = 3 THEN NULL WHEN s_suppkey % 4 = 1 THEN 'NEWCE' || lpad(cast(s_suppkey % 10000 AS string), 4, '0') || 'K'
             ELSE 'LEGCE' || lpad(cast(s_suppkey % 10000 AS string), 4, '0') || 'K' END) AS registration_number
FROM {supplier}
"""

# the registrations of a party and of its site, and lines of another type, which a change must leave alone
VIEWS["fx_reg_all"] = """
SELECT party_id, cast(NULL AS bigint) AS party_site_id, cast(NULL AS int) AS org_id, reg_id, 'PAN' AS registration_type_code,
       registration_number, effective_from, effective_to FROM {fx_reg}
UNION ALL
SELECT party_id, 10 * party_id AS party_site_id, cast(party_id % 3 AS int) AS org_id, 500000 + reg_id AS reg_id,
       (CASE WHEN party_id % 8 = 5 THEN 'PAN-OLD' ELSE 'PAN' END) AS registration_type_code, registration_number, effective_from, effective_to FROM {fx_reg}
UNION ALL
SELECT party_id, 10 * party_id AS party_site_id, cast(party_id % 3 AS int) AS org_id, 500000 + reg_id AS reg_id,
       'TAN' AS registration_type_code, registration_number, effective_from, effective_to FROM {fx_reg} WHERE party_id % 2 = 0
"""

VIEWS["fx_reg_both"] = """
SELECT party_id, cast(NULL AS bigint) AS party_site_id, cast(NULL AS int) AS org_id, registration_number FROM {fx_reg_in}
UNION ALL
SELECT party_id, 10 * party_id AS party_site_id, cast(party_id % 3 AS int) AS org_id, registration_number FROM {fx_reg_in}
"""


# --- the same documents in the shape of the source system's transaction tables -------------------------

VIEWS["fx_org"] = """
SELECT le_id AS organization_id, gstin, legal_name, location_id, org_id, line_of_business, reporting_code FROM {fx_le}
"""

VIEWS["fx_item"] = """
SELECT l.item_id, l.organization_id, 'P' || cast(l.item_id AS string) AS item_code, p.p_name AS item_name
FROM (SELECT DISTINCT l.item_id, h.le_id AS organization_id FROM {fx_line} l JOIN {fx_hdr} h ON h.document_id = l.document_id) l
JOIN {part} p ON p.p_partkey = l.item_id
WHERE p.p_brand <> 'Brand#13'
"""

# The pairs of item and organisation move once, to the item: they are made distinct there, and meet the parts there.
ARRIVED_ANYWAY = {
    "fx_item": f"""
SELECT {select_list("fx_item")}
FROM (SELECT DISTINCT item_id, organization_id
      FROM (SELECT l.item_id, h.le_id AS organization_id FROM {{fx_line}} l JOIN {{fx_hdr}} h ON h.document_id = l.document_id
            DISTRIBUTE BY item_id)) l
{VIEWS["fx_item"].partition("document_id) l")[2].strip()}
"""
}

VIEWS["fx_transfer"] = """
SELECT (CASE WHEN h.query_type = 'DTP Intra-state' THEN NULL ELSE h.document_num END) AS tax_invoice_no,
       (CASE WHEN h.query_type = 'DTP Intra-state' THEN h.document_num ELSE NULL END) AS del_challan_num,
       h.batch_id, l.item_id, h.document_date AS creation_date, h.reprocess_flag,
       (CASE WHEN h.document_id % 29 = 3 THEN 'PRJ' ELSE NULL END) AS project,
       (CASE WHEN h.query_type = 'Intransit' THEN NULL ELSE h.document_id END) AS mo_header_id,
       'PH' || cast(h.cust_id AS string) AS poc_no, l.price AS material_cost, l.quantity, h.le_id AS from_warehouse_id,
       (CASE WHEN h.document_id % 24 = 0 THEN h.le_id ELSE NULL END) AS to_warehouse_id,
       'SH' || cast(h.document_id AS string) AS shipment_num,
       (CASE WHEN h.priority = '5-LOW' THEN 'E' ELSE 'N' END) AS process_flag, h.document_id
FROM {fx_hdr} h JOIN {fx_line} l ON l.document_id = h.document_id
WHERE h.query_type <> 'AR INVOICE'
"""

VIEWS["fx_move"] = """
SELECT (CASE WHEN h.document_id % 31 = 5 THEN NULL ELSE h.document_id END) AS transaction_batch_id,
       h.document_id AS transaction_set_id, l.line_key AS move_line_id, h.le_id AS organization_id,
       h.le_id AS owning_organization_id, h.le_id - h.le_id % 2 AS transfer_organization_id,
       l.item_id, l.price AS actual_cost, -l.quantity AS move_quantity, 'POC' || cast(h.cust_id AS string) AS poc_name,
       'S' || cast(h.document_id AS string) AS shipment_id, 'SH' || cast(h.document_id AS string) AS shipment_num, h.batch_id
FROM {fx_hdr} h JOIN {fx_line} l ON l.document_id = h.document_id
WHERE h.query_type = 'DTP Inter-state' OR h.query_type = 'Intransit'
"""

VIEWS["fx_move_order"] = """
SELECT h.document_id AS header_id, 'M' || cast(h.document_id AS string) AS shipment_id, 'POC' || cast(h.cust_id AS string) AS poc_name,
       c.phone, (CASE WHEN h.document_id % 13 = 4 THEN NULL ELSE c.location_id END) AS location_id, h.le_id AS organization_id
FROM {fx_hdr} h JOIN {fx_cust} c ON c.cust_id = h.cust_id
WHERE h.query_type = 'DTP Inter-state' OR h.query_type = 'DTP Intra-state'
"""

VIEWS["fx_invoice"] = """
SELECT h.document_id, h.document_num, h.document_date, h.document_date AS creation_date,
       (CASE WHEN h.document_id % 37 = 0 THEN 'N' ELSE 'Y' END) AS complete_flag, h.reprocess_flag,
       (CASE WHEN h.document_id % 8 = 3 THEN 'ORDER ENTRY' WHEN h.document_id % 24 = 7 THEN NULL ELSE 'DIRECT' END) AS context,
       h.cust_id, (CASE WHEN h.document_id % 6 = 1 THEN NULL ELSE h.cust_id - h.cust_id % 2 END) AS ship_to_cust_id,
       (CASE h.document_type WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END) AS trx_type_id,
       e.org_id, h.le_id AS legal_entity_id, h.batch_id, 'S' || cast(h.document_id AS string) AS shipment_id,
       h.document_type
FROM {fx_hdr} h JOIN {fx_le} e ON e.le_id = h.le_id
WHERE h.query_type = 'AR INVOICE'
"""

VIEWS["fx_trx_type"] = """
SELECT DISTINCT trx_type_id, org_id, document_type AS type FROM {fx_invoice}
"""

VIEWS["fx_invoice_line"] = """
SELECT i.document_id, l.line_key AS invoice_line_id, i.context AS line_context,
       (CASE WHEN i.context = 'ORDER ENTRY' THEN 'SO' || cast(i.document_id AS string) END) AS order_number,
       (CASE WHEN i.context = 'ORDER ENTRY' THEN l.line_key END) AS order_line_id,
       l.item_id, i.legal_entity_id AS warehouse_id, (CASE WHEN i.document_type = 'O' THEN NULL ELSE l.quantity END) AS quantity_invoiced,
       (CASE WHEN i.document_type = 'O' THEN -l.quantity ELSE NULL END) AS quantity_credited,
       cast(l.base_amount * 0.1 AS decimal(14,3)) AS unit_price,
       (CASE WHEN l.source_line % 6 = 5 THEN 'FREIGHT' ELSE 'LINE' END) AS line_type, 'Free text ' || l.item_name AS description
FROM {fx_invoice} i JOIN {fx_line} l ON l.document_id = i.document_id
"""

VIEWS["fx_order"] = """
SELECT document_id + 900000000 AS order_id, 'SO' || cast(document_id AS string) AS order_number, legal_entity_id AS ship_from_org_id
FROM {fx_invoice} WHERE context = 'ORDER ENTRY'
"""

VIEWS["fx_order_line"] = """
SELECT i.document_id + 900000000 AS order_id, l.line_key AS order_line_id, l.item_id, i.legal_entity_id AS line_org_id,
       cast(l.base_amount * 0.1 AS decimal(14,3)) AS unit_price,
       (CASE WHEN i.document_type = 'O' THEN -l.quantity ELSE l.quantity END) AS ordered_quantity
FROM {fx_invoice} i JOIN {fx_line} l ON l.document_id = i.document_id
WHERE i.context = 'ORDER ENTRY'
"""

# tax determination of each taxed line
VIEWS["fx_tax_factor"] = """
SELECT (CASE WHEN i.context = 'ORDER ENTRY' THEN h.document_id + 900000000 ELSE h.document_id END) AS trx_id,
       l.line_key AS trx_line_id,
       (CASE WHEN h.query_type <> 'AR INVOICE' THEN 'MTL_TRANSACTION' WHEN i.context = 'ORDER ENTRY' THEN 'OE_ORDER_HEADERS'
             ELSE 'TRANSACTIONS' END) AS entity_code,
       h.document_id * 100000000 + l.line_key AS det_factor_id, l.hsn_code,
       (CASE WHEN l.hsn_code IS NULL AND l.item_id % 2 = 0 THEN '9987' END) AS sac_code, h.le_id AS organization_id,
       (CASE WHEN h.document_id % 47 = 8 THEN 99 ELSE i.org_id END) AS org_id,
       (CASE WHEN h.document_type = 'O' THEN 'INV' || cast(h.document_id - 8 AS string) END) AS original_invoice_num,
       (CASE WHEN h.document_type <> 'O' THEN NULL WHEN h.document_id % 9 = 0 THEN cast('1999-09-09 00:00:00' AS {ts})
             ELSE q.prior_date END) AS original_invoice_date,
       h.document_num, h.document_id, l.base_amount, l.tax_rate
FROM {fx_hdr} h JOIN {fx_line} l ON l.document_id = h.document_id
LEFT JOIN {fx_invoice} i ON i.document_id = h.document_id
LEFT JOIN (SELECT document_id + 8 AS next_id, document_date AS prior_date FROM {fx_hdr}) q ON q.next_id = h.document_id
WHERE h.query_type <> 'DTP Intra-state'
"""

VIEWS["fx_tax_line"] = """
SELECT f.trx_id, f.trx_line_id, f.entity_code, f.det_factor_id, f.organization_id, f.document_num AS tax_invoice_num, t.tax_type_id,
       cast(CASE WHEN t.movement = 'INTRA' THEN f.tax_rate * 0.5 ELSE f.tax_rate END AS decimal(6,3)) AS tax_rate,
       cast(CASE WHEN t.movement = 'INTRA' THEN f.base_amount * f.tax_rate * 0.5 ELSE f.base_amount * f.tax_rate END AS decimal(20,4)) AS tax_amount
FROM {fx_tax_factor} f
JOIN {fx_tax_name} t ON t.movement = (CASE WHEN f.document_id % 5 = 0 THEN 'INTRA' ELSE 'INTER' END)
"""

VIEWS["fx_segment"] = """
SELECT cast(100 + r_regionkey AS int) AS org_id, '0' || cast(r_regionkey AS string) AS segment1, 'B' AS segment2, 'D' AS segment4,
       (CASE WHEN r_regionkey = 1 THEN NULL ELSE 'E' END) AS segment5, 'F' AS segment6, 'G' AS segment7, 'H' AS segment8,
       'I' AS segment9, TRUE AS segment_set
FROM {region}
"""

VIEWS["fx_report_code"] = """
SELECT reporting_code_id, reporting_code, reporting_type_id, cast(ended AS {ts}) AS effective_end
FROM (VALUES (11, 'INDIVIDUAL', 5, NULL), (12, 'company', 5, '2002-03-31 00:00:00'), (7, 'Company', 5, '2000-03-31 00:00:00'),
             (8, 'Individual', 6, NULL), (13, 'HUF', 5, NULL)) AS v(reporting_code_id, reporting_code, reporting_type_id, ended)
"""

# registrations with levels: party rows have no site
VIEWS["fx_party_reg"] = """
SELECT employee_id AS party_id, cast(NULL AS bigint) AS party_site_id, cast(NULL AS int) AS org_id, 'Y' AS supplier_flag
FROM {fx_vendor_queue} WHERE vendor_site_code = 'PROVISIONAL'
UNION ALL
SELECT employee_id, employee_id * 10 + org_id % 10, cast(org_id AS int), 'Y' FROM {fx_vendor_queue} WHERE vendor_site_code = 'HOME'
"""


def needed(name: str, seen: list[str] | None = None) -> list[str]:
    """Views a view is built on, in dependency order, itself last."""
    seen = [] if seen is None else seen
    for _, field, _, _ in string.Formatter().parse(VIEWS[name]):
        if field in VIEWS and field not in seen:
            needed(field, seen)
    if name not in seen:
        seen.append(name)
    return seen


def check_sql(views: list[str], body: str) -> str:
    """DuckDB text: the views as CTEs in front of `body` (which starts with SELECT or with more CTEs)."""
    order: list[str] = []
    for v in views:
        needed(v, order)
    names = {t: t for t in TABLES} | {v: v for v in VIEWS} | {"ts": "timestamp"}
    ctes = ",\n".join(f"{v} AS ({VIEWS[v].strip().format(**names)})" for v in order)
    body = body.strip()
    if body.lower().startswith("with recursive "):
        return f"WITH RECURSIVE {ctes},\n{body[15:]}"
    if body.lower().startswith("with "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}" if ctes else body


class Inputs:
    """The views over one data folder as DataFrames, built on first use."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._frames: dict[str, DataFrame] = {}
        self._stored: set[str] = set()

    def once(self, key: str, build: Callable[[], DataFrame], *placed: str) -> DataFrame:
        """A table written once and shared by everything built from these inputs, bucketed by the columns `placed`."""
        if key not in self._frames:
            self._frames[key] = cut_buckets(build(), *placed) if placed else cut_lineage(build())
        return self._frames[key]

    def stored(self, *names: str) -> None:
        """Write these views once, in this order; what is built from them afterwards reads the written tables, as a job
        reads its source tables."""
        for name in names:
            if name not in self._stored:
                self._frames[name] = cut_lineage(self[name])
                self._stored.add(name)

    def placed(self, views: Mapping[str, tuple[Sequence[str], Sequence[str]]]) -> Inputs:
        """Inputs over the same folder of which these views are written once, in this order: view -> (columns, columns to bucket
        by). What joins them on the latter reads them without a shuffle. The frames of this object stay as they are."""
        own = Inputs(self.spark, self.folder)
        for name, (columns, keys) in views.items():
            # few files for each bucket, however the view's last join has left the rows
            if name in PLACED_TEXT:
                rows = own._read(PLACED_TEXT[name]).select(*columns)
            else:
                rows = own[name].select(*columns).repartition(*keys)
            own._frames[name] = cut_buckets(rows, *keys)
            own._stored.add(name)
        return own

    def _read(self, text: str) -> DataFrame:
        fields = {f for _, f, _, _ in string.Formatter().parse(text) if f and f != "ts"}
        return self.spark.sql(text.replace("{ts}", "timestamp_ntz"), **{f: self[f] for f in fields})

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            if name in VIEWS:
                # views that are written already are joined as they lie
                text = VIEWS[name] if self._stored else ARRIVED.get(name, VIEWS[name])
                self._frames[name] = self._read(ARRIVED_ANYWAY.get(name, text))
            else:
                self._frames[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._frames[name]
