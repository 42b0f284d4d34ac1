"""Headers, lines, taxes, reconciliation, categorization and validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.catalog.registry import NOW, RUN_TS, doubles, query
from ledgerloom.functions.moments import iso_day
from ledgerloom.operators import categorize, headers, lines, lookups, reconcile, validate
from ledgerloom.operators.staging import update_where

# ---------------------------------------------------------------- shared inputs of the queries below


# the staging view joins its tables on the document id, so no row lacks one and all rows of a document lie together
PLACED = "document_id"
DOCUMENT = [PLACED, "document_num"]


def stage(i):
    """The staging rows are read by headers, lines and taxes: written once, as a run does, and kept together by document."""
    return i.once("stage", lambda: i["fx_stage"], PLACED)


def all_headers(source):
    """Headers of all staging rows as one run; ids are the document ids so that results can be compared by value."""
    return headers.build_headers(source, 2).withColumn("transaction_id", F.col("document_id"))


def unique_headers(source):
    """Those whose number occurs once: lines and taxes are tied to headers by number."""
    return lines.without_duplicates(all_headers(source), placed=PLACED)


def run_headers(i):
    """Headers for queries that join them more than once: the columns that lines, taxes and checks read, kept by document."""
    return i.once("headers", lambda: unique_headers(stage(i)).select("transaction_id", *DOCUMENT, "batch_id"), PLACED)


def enriched(i, mode, missing_type="null", hdr=None):
    hdr = all_headers(i["fx_stage"]) if hdr is None else hdr
    return headers.enrich_headers(hdr, i["fx_loc"], i["fx_lookup"], mode, missing_type)


def line_rows(i):
    return lines.line_rows(stage(i), run_headers(i), DOCUMENT)


def categorized(i, mode, missing_type="null"):
    facts = validate.document_facts(
        enriched(i, mode, missing_type, unique_headers(stage(i))), lines.document_lines(stage(i), DOCUMENT),
        lines.document_taxes(stage(i), DOCUMENT), key=DOCUMENT,
    )
    return categorize.categorize(facts, i["fx_lookup"], i["fx_eligible"], RUN_TS)


def source_documents(i):
    return i["fx_hdr"].select("document_num", iso_day(F.col("document_date")).alias("document_date"))


def validated(i, mode):
    """Both modes run over all documents; document kinds a mode does not know fail its rules."""
    if mode == "receivable":
        df = categorized(i, mode, "keep")
        return validate.validate_receivable(df, i["fx_lookup"], source_documents(i), note_codes=("O",), max_lines=7, placed=PLACED)
    return validate.validate_transfer(categorized(i, mode), max_lines=7)


# ---------------------------------------------------------------- SQL of the same, step by step

HDR_SQL = """
hdr0 AS (SELECT DISTINCT supplier_gstin, supplier_legal_name, supplier_location_id, sez_unit, recipient_gstin, recipient_location_id,
    recipient_phone_num, recipient_email, recipient_poc_name, recipient_pan, ship_to_location_id, dispatch_location_id, document_num,
    strftime(document_date, '%Y-%m-%d') AS document_date, document_type_code, document_id, customer_type_code, cust_id,
    preceding_doc_num, strftime(preceding_doc_date, '%Y-%m-%d') AS preceding_doc_date, batch_id, org_id, owning_organization_id,
    line_of_business, query_type AS invoice_process, CASE query_type WHEN 'DTP Intra-state' THEN 'N' ELSE 'Y' END AS eligible_flag,
    document_id AS transaction_id FROM fx_stage),
hdr AS (SELECT * FROM hdr0 WHERE document_num IN (SELECT document_num FROM hdr0 GROUP BY document_num HAVING count(*) = 1)),
ln0 AS (SELECT DISTINCT h.transaction_id, s.item_name, s.item_code, s.item_id, s.quantity, s.price, s.hsn_code, s.base_amount,
    s.tax_amount, s.gross_amount, s.tax_trx_id, s.tax_trx_line_id,
    CASE WHEN substr(s.hsn_code, 1, 1) = '9' THEN 'SERVICE' WHEN s.hsn_code IS NOT NULL THEN 'GOODS' END AS item_class
    FROM fx_stage s JOIN hdr h ON h.document_num = s.document_num),
ln AS (SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY item_name NULLS FIRST, item_code NULLS FIRST, item_id NULLS FIRST,
    quantity NULLS FIRST, price NULLS FIRST, hsn_code NULLS FIRST, base_amount NULLS FIRST, tax_amount NULLS FIRST,
    gross_amount NULLS FIRST, tax_trx_id NULLS FIRST, tax_trx_line_id NULLS FIRST) AS line_number FROM ln0),
tx AS (SELECT DISTINCT l.transaction_id, l.line_number, s.tax_name, s.tax_rate, s.taxable_amount, s.tax_type_id
    FROM fx_stage s JOIN hdr h ON h.document_num = s.document_num
    JOIN ln l ON l.transaction_id = h.transaction_id AND l.tax_trx_id = s.tax_trx_id AND l.tax_trx_line_id = s.tax_trx_line_id
    WHERE s.tax_trx_id IS NOT NULL)"""

ALL_HDR_SQL = HDR_SQL.replace(" WHERE document_num IN (SELECT document_num FROM hdr0 GROUP BY document_num HAVING count(*) = 1)", "")

_ROLE = """{a}.address1 AS {r}_address1, {a}.address2 AS {r}_address2, {a}.place AS {r}_place, {a}.state_number AS {r}_state_number,
    {a}.state_code AS {r}_state_code, {a}.state_name AS {r}_state_name, {a}.pincode AS {r}_pincode, {a}.country_code AS {r}_country_code,
    {a}.description AS {r}_description"""
ROLE_SQL = ",\n    ".join(
    _ROLE.format(a=a, r=r) for a, r in (("ls", "supplier"), ("lr", "recipient"), ("lp", "ship_to"), ("ld", "dispatch_from"))
)


def enriched_sql(mode: str, keep_type: bool = False, hdr: str = HDR_SQL) -> str:
    """CTEs hdr .. enr."""
    if mode == "receivable":
        pick = """recipient_poc_name AS recipient_legal_name, coalesce(recipient_address2, recipient_address1) AS recipient_address,
    cast(NULL AS varchar) AS ship_to_legal_name, coalesce(ship_to_address2, ship_to_address1) AS ship_to_address,
    ship_to_state_number AS pos_state_number, ship_to_state_code AS pos_state_code"""
        code = "(SELECT max(k.meaning) FROM fx_lookup k WHERE k.lookup_type = 'DOCUMENT_TYPES' AND k.lookup_code = r.document_type_code AND k.description = 'Document Type Code' AND k.enabled_flag = 'Y')"
        kind = f"coalesce({code}, r.document_type_code)" if keep_type else code
        same = "CASE WHEN customer_type_code LIKE '%SEZ%' OR customer_type_code LIKE '%EXP%' THEN 'INTER' ELSE 'INTRA' END"
    else:
        pick = """CASE WHEN invoice_process = 'DTP Intra-state' THEN supplier_legal_name ELSE recipient_address1 END AS recipient_legal_name,
    CASE WHEN invoice_process = 'DTP Intra-state' THEN recipient_address1 ELSE recipient_address2 END AS recipient_address,
    CASE WHEN invoice_process = 'Intransit' THEN ship_to_address1 WHEN invoice_process IN ('DTP Inter-state', 'DTP Intra-state')
         THEN coalesce(ship_to_description, ship_to_address1) END AS ship_to_legal_name,
    CASE WHEN invoice_process = 'Intransit' THEN ship_to_address2 WHEN invoice_process IN ('DTP Inter-state', 'DTP Intra-state')
         THEN coalesce(ship_to_address1, ship_to_address2) END AS ship_to_address,
    CASE invoice_process WHEN 'Intransit' THEN recipient_state_number WHEN 'DTP Intra-state' THEN recipient_state_number
         WHEN 'DTP Inter-state' THEN coalesce(ship_to_state_number, recipient_state_number) END AS pos_state_number,
    CASE invoice_process WHEN 'Intransit' THEN recipient_state_code WHEN 'DTP Intra-state' THEN recipient_state_code
         WHEN 'DTP Inter-state' THEN coalesce(ship_to_state_code, recipient_state_code) END AS pos_state_code"""
        kind = "r.document_type_code"
        same = "'INTRA'"
    return f"""{hdr},
rol AS (SELECT hdr.*, {ROLE_SQL}
    FROM hdr LEFT JOIN fx_loc ls ON ls.location_id = supplier_location_id LEFT JOIN fx_loc lr ON lr.location_id = recipient_location_id
    LEFT JOIN fx_loc lp ON lp.location_id = ship_to_location_id LEFT JOIN fx_loc ld ON ld.location_id = dispatch_location_id),
pos AS (SELECT r.* REPLACE ({kind} AS document_type_code), supplier_address2 AS supplier_address, {pick},
    dispatch_from_address2 AS dispatch_from_address FROM rol r),
enr AS (SELECT *, CASE WHEN supplier_state_code = pos_state_code THEN {same} WHEN supplier_state_code <> pos_state_code THEN 'INTER' END AS shipment_type FROM pos)"""


_TYPE_IN = "customer_type_code IN (SELECT upper(meaning) FROM fx_lookup WHERE lookup_type = 'CUSTOMER_TYPES' AND enabled_flag = 'Y'{d})"
_LE = f"""EXISTS (SELECT 1 FROM fx_eligible x WHERE x.legal_entity = supplier_legal_name AND x.{{c}} IN ({{v}})
    AND {NOW} BETWEEN x.effective_start AND coalesce(x.effective_end, {NOW} + INTERVAL 1 DAY))"""


def _standins(cond: str, supply: str, sez: bool) -> str:
    changes = {
        "supply_type_code": f"'{supply}'", "recipient_gstin": "'URP'", "recipient_state_number_upd": "'96'",
        "recipient_state_code_upd": "'96'", "pos_state_number_upd": "'96'", "pos_state_code_upd": "'96'",
        "recipient_pincode_upd": "'999999'",
    }
    if sez:
        changes["sez_unit"] = "'true'"
    return ", ".join(f"CASE WHEN {cond} THEN {v} ELSE {c} END AS {c}" for c, v in changes.items())


def categorized_sql(mode: str, keep_type: bool = False) -> str:
    """CTEs hdr .. cat, one CTE per rule in the order of the run."""
    open_ = "status_code = 'PENDING' AND eligible_flag = 'Y'"

    def typed(d):
        return _TYPE_IN.format(d=f" AND description = '{d}'" if d else "")

    def close(cond, text):
        return f"""CASE WHEN {cond} THEN 'SUCCESS-INELIGIBLE' ELSE status_code END AS status_code,
    CASE WHEN {cond} THEN coalesce(status_message, '') || '{text}####' ELSE status_message END AS status_message,
    CASE WHEN {cond} THEN 'N' ELSE eligible_flag END AS eligible_flag"""

    def reject(cond, text):
        return f"""CASE WHEN {cond} THEN 'ERROR' ELSE status_code END AS status_code,
    CASE WHEN {cond} THEN coalesce(status_message, '') || {text} || ';####' ELSE status_message END AS status_message,
    CASE WHEN {cond} THEN 'NA' ELSE supply_type_code END AS supply_type_code, CASE WHEN {cond} THEN 'N' ELSE eligible_flag END AS eligible_flag"""

    def le(column, values):
        return _LE.format(c=column, v=values)

    first = open_.replace("'Y'", "'N'")
    unregistered = f"{open_} AND {typed('Unregistered')}"
    export = f"{open_} AND recipient_country_code <> 'IN' AND {typed('Export Type')} AND total_tax_amount = 0"
    zone = f"{open_} AND {typed('SEZ Type')} AND total_tax_amount"
    equal = """supply_type_code = 'B2B' AND recipient_gstin = supplier_gstin AND EXISTS
    (SELECT 1 FROM tx WHERE tx.transaction_id = p.transaction_id AND tx.taxable_amount = 0)"""
    odd = f"status_code = 'PENDING' AND NOT ({typed('')})"
    none = "status_code IN ('PENDING', 'ERROR') AND customer_type_code IS NULL"
    steps = [
        f"""CASE WHEN {first} THEN 'SUCCESS-INELIGIBLE' ELSE status_code END AS status_code,
    CASE WHEN {first} THEN 'Extracted as not eligible - delivery challan records####' ELSE status_message END AS status_message,
    CASE WHEN {first} THEN 'NA' ELSE supply_type_code END AS supply_type_code""",
        f"CASE WHEN {unregistered} THEN 'B2C' ELSE supply_type_code END AS supply_type_code, CASE WHEN {unregistered} THEN 'N' ELSE eligible_flag END AS eligible_flag",
        _standins(export, "EXPWOP", False),
        _standins(f"{zone} = 0", "SEZWOP", True),
        _standins(f"{zone} <> 0", "SEZWP", True),
        f"CASE WHEN {open_} AND {typed('Regular')} THEN 'B2B' ELSE supply_type_code END AS supply_type_code",
        f"CASE WHEN {equal} THEN 'B2C' ELSE supply_type_code END AS supply_type_code, CASE WHEN {equal} THEN 'N' ELSE eligible_flag END AS eligible_flag",
        reject(odd, "'Unexpected customer registration code ' || coalesce(customer_type_code, '')"),
        reject(none, "'Null customer registration code '"),
        close(f"supply_type_code <> 'B2C' AND NOT {le('irn_flag', chr(39) + 'Y' + chr(39) + ',' + chr(39) + 'P' + chr(39))}", "LE have revenue less than 500/100 crore INR"),
        close(f"supply_type_code <> 'B2C' AND {le('irn_flag', chr(39) + 'P' + chr(39))}", "Though enabled at source but B2B E-Invoicing not enabled in target"),
        close(f"supply_type_code = 'B2C' AND NOT {le('b2c_flag', chr(39) + 'Y' + chr(39) + ',' + chr(39) + 'P' + chr(39))}", "LE have revenue less than 500/100 crore INR(B2C)"),
        close(f"supply_type_code = 'B2C' AND {le('b2c_flag', chr(39) + 'P' + chr(39))}", "Though enabled at source but B2C E-Invoicing not enabled in target"),
    ]
    ctes = [
        enriched_sql(mode, keep_type),
        """amt AS (SELECT transaction_id, sum(base_amount) AS total_base_amount, sum(tax_amount) AS total_tax_amount, sum(gross_amount) AS gross_amount
    FROM ln0 GROUP BY transaction_id)""",
        """k0 AS (SELECT enr.*, a.total_base_amount, a.total_tax_amount, a.gross_amount, 'PENDING' AS status_code,
    cast(NULL AS varchar) AS status_message, cast(NULL AS varchar) AS supply_type_code,
    recipient_state_number AS recipient_state_number_upd, recipient_state_code AS recipient_state_code_upd,
    recipient_pincode AS recipient_pincode_upd, pos_state_number AS pos_state_number_upd, pos_state_code AS pos_state_code_upd
    FROM enr LEFT JOIN amt a ON a.transaction_id = enr.transaction_id)""",
    ]
    for n, step in enumerate(steps, 1):
        ctes.append(f"k{n} AS (SELECT p.* REPLACE ({step}) FROM k{n - 1} p)")
    ctes.append(f"cat AS (SELECT * FROM k{len(steps)})")
    return ",\n".join(ctes)


STAGE_VIEWS = ["fx_stage", "fx_loc", "fx_lookup", "fx_eligible"]


# ---------------------------------------------------------------- headers


HEADER_OUT = (
    "transaction_id document_num document_date document_type_code invoice_process eligible_flag supplier_gstin "
    "supplier_legal_name recipient_gstin recipient_phone_num customer_type_code preceding_doc_num preceding_doc_date "
    "batch_id org_id line_of_business"
).split()


@query(
    "q_headers",
    ["fx_stage"],
    f"""WITH {ALL_HDR_SQL}
SELECT {', '.join(HEADER_OUT)}, 'PENDING' AS status_code, 'N' AS mail_sent, 2 AS request_id FROM hdr""",
)
def q_headers(i):
    return all_headers(i["fx_stage"]).select(*HEADER_OUT, "status_code", "mail_sent", "request_id")


@query(
    "q_supersede",
    ["fx_hdr"],
    """
WITH st AS (SELECT document_id, document_num, batch_id, request_id, CASE WHEN document_type = 'F' THEN 'ERROR' WHEN document_type = 'O' THEN 'SUCCESS' ELSE 'PENDING' END AS status_code FROM fx_hdr),
cur AS (SELECT document_num, batch_id FROM st WHERE request_id = 2)
SELECT document_id, document_num, CASE WHEN status_code = 'ERROR' AND EXISTS (SELECT 1 FROM cur WHERE cur.document_num = st.document_num
   AND coalesce(cur.batch_id, 1) = coalesce(st.batch_id, 1)) THEN 'RE-EXTRACTED' ELSE status_code END AS status_code
FROM st WHERE request_id <> 2
UNION ALL
SELECT document_id, document_num || '/1', CASE WHEN status_code = 'ERROR' THEN 'RE-EXTRACTED' ELSE status_code END FROM st WHERE request_id = 2
""",
)
def q_supersede(i):
    """Earlier rows: those of request 1, and an earlier version of every row of the current run."""
    status = F.when(F.col("document_type") == "F", "ERROR").when(F.col("document_type") == "O", "SUCCESS").otherwise("PENDING")
    state = i["fx_hdr"].select("document_id", "document_num", "batch_id", "request_id", status.alias("status_code"))
    current = state.where("request_id = 2")
    keys = {"document_num": None, "batch_id": 1}
    out = headers.supersede(state.where("request_id <> 2"), current, keys)
    again = headers.supersede(current, current, keys).withColumn("document_num", F.concat("document_num", F.lit("/1")))
    columns = ["document_id", "document_num", "status_code"]
    return out.select(*columns).unionByName(again.select(*columns))


@query(
    "q_assign_ids",
    ["fx_hdr"],
    """
SELECT document_id, document_num, 5000 + row_number() OVER (ORDER BY document_num, document_id) AS transaction_id FROM fx_hdr
""",
)
def q_assign_ids(i):
    return headers.assign_ids(i["fx_hdr"].select("document_id", "document_num"), 5001, ["document_num", "document_id"])


ROLE_OUT = [f"{r}_{a}" for r in ("supplier", "recipient", "ship_to", "dispatch_from") for a in ("address", "place", "state_number", "state_code", "state_name", "pincode", "country_code")]
ENRICHED_OUT = ["transaction_id", *ROLE_OUT, "recipient_legal_name", "ship_to_legal_name"]
POS_OUT = ["transaction_id", "invoice_process", "supplier_state_code", "pos_state_number", "pos_state_code"]
MOVE_OUT = ["transaction_id", "invoice_process", "customer_type_code", "shipment_type"]

for _mode in ("receivable", "transfer"):
    _sql = enriched_sql(_mode, hdr=ALL_HDR_SQL)
    _suffix = "" if _mode == "receivable" else "_transfer"
    for _name, _out in (("q_enrich_roles", ENRICHED_OUT), ("q_place_of_supply", POS_OUT), ("q_movement_type", MOVE_OUT)):
        query(f"{_name}{_suffix}", STAGE_VIEWS, f"WITH {_sql}\nSELECT {', '.join(_out)} FROM enr")(
            lambda i, mode=_mode, out=_out: enriched(i, mode).select(*out)
        )


@query(
    "q_translate_code",
    ["fx_hdr", "fx_lookup"],
    """
SELECT document_id, document_type, (SELECT max(meaning) FROM fx_lookup WHERE lookup_type = 'DOCUMENT_TYPES' AND enabled_flag = 'Y'
   AND description = 'Document Type Code' AND lookup_code = document_type) AS document_type_code,
  (SELECT max(lookup_code) FROM fx_lookup WHERE lookup_type = 'INVOICE_PROCESSES' AND enabled_flag = 'Y' AND upper(meaning) = upper(query_type)) AS process_code
FROM fx_hdr
""",
)
def q_translate_code(i):
    df = lookups.translate(i["fx_hdr"], "document_type", i["fx_lookup"], "DOCUMENT_TYPES", "document_type_code", "Document Type Code")
    df = lookups.translate(df, "query_type", i["fx_lookup"], "INVOICE_PROCESSES", "process_code", match_on="meaning", give="lookup_code", ignore_case=True)
    return df.select("document_id", "document_type", "document_type_code", "process_code")


@query(
    "q_attach_attributes",
    ["fx_hdr", "fx_le", "fx_cust"],
    """
SELECT h.document_id, e.gstin AS supplier_gstin, e.legal_name, e.org_id, e.line_of_business, c.email, c.customer_type
FROM fx_hdr h LEFT JOIN fx_le e ON e.le_id = h.le_id LEFT JOIN fx_cust c ON c.cust_id = h.cust_id
""",
)
def q_attach_attributes(i):
    df = lookups.attach_attributes(
        i["fx_hdr"], i["fx_le"], "le_id",
        {"gstin": "supplier_gstin", "legal_name": "legal_name", "org_id": "org_id", "line_of_business": "line_of_business"}, "le_id",
    )
    df = lookups.attach_attributes(df, i["fx_cust"], "cust_id", {"email": "email", "customer_type": "customer_type"}, "cust_id")
    return df.select("document_id", "supplier_gstin", "legal_name", "org_id", "line_of_business", "email", "customer_type")


# ---------------------------------------------------------------- lines and taxes


@query(
    "q_build_lines",
    ["fx_stage"],
    f"""WITH {HDR_SQL}
SELECT transaction_id, line_number, item_code, item_name, hsn_code, cast(quantity AS double) AS quantity, cast(coalesce(price, 0) AS double) AS price,
  cast(base_amount AS double) AS base_amount, cast(tax_amount AS double) AS tax_amount, cast(gross_amount AS double) AS gross_amount, tax_trx_line_id FROM ln""",
)
def q_build_lines(i):
    built = lines.build_lines(stage(i), run_headers(i), DOCUMENT)
    amounts = ["quantity", "price", "base_amount", "tax_amount", "gross_amount"]
    return doubles(built, *amounts).select(
        "transaction_id", "line_number", "item_code", "item_name", "hsn_code", *amounts, "tax_trx_line_id"
    )


@query(
    "q_classify_line",
    ["fx_line"],
    """
SELECT document_id, item_code, source_line, hsn_code, CASE WHEN hsn_code IS NULL THEN NULL WHEN hsn_code LIKE '9%' THEN 'SERVICE' ELSE 'GOODS' END AS item_class FROM fx_line
""",
)
def q_classify_line(i):
    return i["fx_line"].select(
        "document_id", "item_code", "source_line", "hsn_code", lines.classify_code(F.col("hsn_code")).alias("item_class")
    )


@query(
    "q_header_class",
    ["fx_stage"],
    f"""WITH {HDR_SQL},
c AS (SELECT transaction_id, count(DISTINCT item_class) AS n, min(item_class) AS k FROM ln0 GROUP BY transaction_id)
SELECT hdr.transaction_id, CASE WHEN n > 1 THEN 'M' WHEN k = 'GOODS' THEN 'N' WHEN k = 'SERVICE' THEN 'Y' END AS is_service
FROM hdr LEFT JOIN c ON c.transaction_id = hdr.transaction_id""",
)
def q_header_class(i):
    return lines.header_class(unique_headers(i["fx_stage"]), lines.document_lines(i["fx_stage"]), "document_num").select("transaction_id", "is_service")


@query(
    "q_rollup_amounts",
    ["fx_stage"],
    f"""WITH {HDR_SQL}
SELECT hdr.transaction_id, cast((SELECT sum(base_amount) FROM ln0 WHERE ln0.transaction_id = hdr.transaction_id) AS double) AS total_base_amount,
  cast((SELECT sum(tax_amount) FROM ln0 WHERE ln0.transaction_id = hdr.transaction_id) AS double) AS total_tax_amount,
  cast((SELECT sum(gross_amount) FROM ln0 WHERE ln0.transaction_id = hdr.transaction_id) AS double) AS gross_amount FROM hdr""",
)
def q_rollup_amounts(i):
    out = lines.rollup_amounts(unique_headers(i["fx_stage"]), lines.document_lines(i["fx_stage"]), "document_num")
    names = list(lines.AMOUNTS.values())
    return doubles(out, *names).select("transaction_id", *names)


@query(
    "q_build_taxes",
    ["fx_stage"],
    f"""WITH {HDR_SQL}
SELECT transaction_id, line_number, tax_name, cast(tax_rate AS double) AS tax_rate, cast(taxable_amount AS double) AS taxable_amount, tax_type_id FROM tx""",
)
def q_build_taxes(i):
    hdr = run_headers(i)
    out = lines.build_taxes(stage(i), hdr, lines.build_lines(stage(i), hdr, DOCUMENT), DOCUMENT)
    return doubles(out, "tax_rate", "taxable_amount")


# ---------------------------------------------------------------- reconciliation


@query(
    "q_duplicates",
    ["fx_hdr"],
    "SELECT request_id, document_num, count(*) AS occurrences FROM fx_hdr GROUP BY request_id, document_num HAVING count(*) > 1",
)
def q_duplicates(i):
    return reconcile.duplicates(i["fx_hdr"], ["request_id", "document_num"])


@query(
    "q_quarantine",
    ["fx_stage"],
    f"""WITH {HDR_SQL}
SELECT s.document_id, s.document_num, s.batch_id, s.item_id, s.item_code, s.tax_name, cast(s.gross_amount AS double) AS gross_amount
FROM fx_stage s WHERE s.document_num IN (SELECT document_num FROM hdr0 GROUP BY document_num HAVING count(*) > 1)""",
)
def q_quarantine(i):
    rows = stage(i)
    out = lines.quarantined(rows, reconcile.duplicates(all_headers(rows), ["document_num"]))
    return doubles(out.select("document_id", "document_num", "batch_id", "item_id", "item_code", "tax_name", "gross_amount"), "gross_amount")


@query(
    "q_already_processed",
    ["fx_hdr"],
    """
WITH st AS (SELECT document_id, document_num, request_id, CASE WHEN document_type = 'F' THEN 'ERROR' WHEN document_type = 'O' THEN 'SUCCESS' END AS status_code FROM fx_hdr)
SELECT a.document_id, a.document_num, a.request_id FROM st a WHERE EXISTS (SELECT 1 FROM st b WHERE b.document_num = a.document_num
  AND b.request_id <> a.request_id AND b.status_code NOT IN ('ERROR', 'RE-EXTRACTED'))
""",
)
def q_already_processed(i):
    status = F.when(F.col("document_type") == "F", "ERROR").when(F.col("document_type") == "O", "SUCCESS")
    state = i["fx_hdr"].select("document_id", "document_num", "request_id", status.alias("status_code"))
    return reconcile.already_processed(state, state).select("document_id", "document_num", "request_id")


@query(
    "q_missing_in_target",
    ["fx_transfer", "fx_hdr"],
    """
WITH tgt AS (SELECT document_num, batch_id, query_type AS invoice_process FROM fx_hdr WHERE reprocess_flag IS NULL AND query_type <> 'AR INVOICE')
SELECT s.tax_invoice_no, s.del_challan_num, s.batch_id, s.item_id, s.document_id FROM fx_transfer s
WHERE s.process_flag <> 'E' AND s.batch_id IS NOT NULL AND (s.tax_invoice_no IS NOT NULL OR s.del_challan_num IS NOT NULL)
  AND NOT EXISTS (SELECT 1 FROM tgt t WHERE CASE WHEN t.invoice_process = 'DTP Intra-state' THEN s.del_challan_num ELSE s.tax_invoice_no END = t.document_num
     AND t.batch_id = s.batch_id)
""",
)
def q_missing_in_target(i):
    source = i["fx_transfer"].where(
        (F.col("process_flag") != "E")
        & F.col("batch_id").isNotNull()
        & (F.col("tax_invoice_no").isNotNull() | F.col("del_challan_num").isNotNull())
    )
    target = i["fx_hdr"].where(F.col("reprocess_flag").isNull() & (F.col("query_type") != "AR INVOICE"))
    out = reconcile.missing_in_target(
        source, target, {True: "del_challan_num", False: "tax_invoice_no"}, F.col("query_type") == headers.CHALLAN
    )
    return out.select("tax_invoice_no", "del_challan_num", "batch_id", "item_id", "document_id")


@query(
    "q_amount_mismatch",
    ["fx_stage"],
    f"""WITH {HDR_SQL},
p AS (SELECT transaction_id, sum(gross_amount) + CASE WHEN transaction_id % 50 = 7 THEN 1 ELSE 0 END AS amount FROM ln0 GROUP BY transaction_id)
SELECT p.transaction_id, cast(p.amount AS double) AS parent_amount, cast(c.s AS double) AS child_sum
FROM p JOIN (SELECT transaction_id, sum(gross_amount) AS s FROM ln0 GROUP BY transaction_id) c ON c.transaction_id = p.transaction_id WHERE c.s <> p.amount""",
)
def q_amount_mismatch(i):
    """Amounts of some documents are disturbed, as a clean run cannot fail this check."""
    hdr, ls = run_headers(i), line_rows(i)
    parent = update_where(
        lines.rollup_amounts(hdr, ls), F.col("transaction_id") % 50 == 7, {"gross_amount": F.col("gross_amount") + 1}
    )
    out = reconcile.amount_mismatch(parent, ls, ["transaction_id"], "gross_amount", "gross_amount")
    return doubles(out, "parent_amount", "child_sum")


@query(
    "q_count_mismatch",
    ["fx_stage", "fx_transfer"],
    f"""WITH {HDR_SQL},
e AS (SELECT h.document_num, h.batch_id, count(*) AS target_rows FROM ln0 JOIN hdr h ON h.transaction_id = ln0.transaction_id GROUP BY ALL),
a AS (SELECT tax_invoice_no, batch_id, count(*) AS source_rows FROM fx_transfer WHERE process_flag <> 'E' OR quantity < 25 GROUP BY ALL)
SELECT e.document_num, e.batch_id, e.target_rows, a.source_rows FROM e JOIN a ON a.tax_invoice_no = e.document_num AND a.batch_id = e.batch_id
WHERE a.source_rows <> e.target_rows""",
)
def q_count_mismatch(i):
    """Failed source rows of large quantity are missing on the source side."""
    hdr = run_headers(i)
    target = line_rows(i).join(hdr.select("transaction_id", "document_num", "batch_id"), "transaction_id")
    source = i["fx_transfer"].where((F.col("process_flag") != "E") | (F.col("quantity") < 25))
    return reconcile.count_mismatch(source.withColumnRenamed("tax_invoice_no", "document_num"), target, ["document_num", "batch_id"])


@query(
    "q_row_count_check",
    ["fx_stage", "fx_line"],
    f"""WITH {HDR_SQL}
SELECT (SELECT count(*) FROM fx_line) AS source_rows, (SELECT count(*) FROM ln0) AS target_rows,
  (SELECT count(*) FROM fx_line) = (SELECT count(*) FROM ln0) AS agrees""",
)
def q_row_count_check(i):
    return reconcile.row_count_check(i["fx_line"], line_rows(i))


@query(
    "q_missing_detail",
    ["fx_hdr", "fx_transfer"],
    """
SELECT DISTINCT document_num FROM fx_hdr h WHERE NOT EXISTS (SELECT 1 FROM fx_transfer t WHERE t.process_flag = 'N'
  AND coalesce(t.tax_invoice_no, t.del_challan_num) = h.document_num AND t.batch_id = h.batch_id)
""",
)
def q_missing_detail(i):
    detail = i["fx_transfer"].where("process_flag = 'N'").select(
        F.coalesce("tax_invoice_no", "del_challan_num").alias("document_num"), "batch_id"
    )
    return reconcile.missing_detail(i["fx_hdr"], detail)


SUMMARY_SQL = """count(*) AS documents, count(*) FILTER (WHERE supply_type_code <> 'B2C' AND status_code = 'ERROR') AS errors,
  count(*) FILTER (WHERE supply_type_code <> 'B2C' AND status_code = 'PENDING') AS marked_for_integration,
  count(*) FILTER (WHERE status_code = 'SUCCESS-INELIGIBLE') AS not_eligible,
  count(*) FILTER (WHERE supply_type_code = 'B2C' AND status_code = 'ERROR') AS b2c_errors,
  count(*) FILTER (WHERE supply_type_code = 'B2C' AND status_code = 'SUCCESS') AS b2c_successes,
  count(*) FILTER (WHERE supply_type_code = 'B2C') AS b2c_extracted,
  CASE WHEN count(*) FILTER (WHERE supply_type_code <> 'B2C' AND status_code = 'ERROR') > 0 THEN 1 ELSE 0 END AS return_code"""


# ---------------------------------------------------------------- categorization


CATEGORY_OUT = (
    "transaction_id status_code status_message supply_type_code eligible_flag recipient_gstin sez_unit "
    "recipient_state_number_upd recipient_state_code_upd pos_state_number_upd pos_state_code_upd recipient_pincode_upd"
).split()
CATEGORY_SQL = categorized_sql("receivable")


@query("q_categorize", STAGE_VIEWS, f"WITH {CATEGORY_SQL}\nSELECT {', '.join(CATEGORY_OUT)} FROM cat")
def q_categorize(i):
    return categorized(i, "receivable").select(*CATEGORY_OUT)


@query("q_categorize_transfer", STAGE_VIEWS, f"WITH {categorized_sql('transfer')}\nSELECT {', '.join(CATEGORY_OUT)} FROM cat")
def q_categorize_transfer(i):
    return categorized(i, "transfer").select(*CATEGORY_OUT)


@query(
    "q_effective_flags",
    ["fx_le", "fx_eligible"],
    f"""SELECT le_id, {', '.join(f"{_LE.format(c=c, v=v).replace('supplier_legal_name', 'legal_name')} AS {n}" for n, c, v in (
        ("le_b2b_any", "irn_flag", "'Y','P'"), ("le_b2b_partial", "irn_flag", "'P'"), ("le_b2c_any", "b2c_flag", "'Y','P'"), ("le_b2c_partial", "b2c_flag", "'P'")))}
FROM fx_le""",
)
def q_effective_flags(i):
    out = lookups.effective_flags(i["fx_le"], i["fx_eligible"], "legal_name", "legal_entity", categorize.ENTITY_FLAGS, RUN_TS)
    return out.select("le_id", *categorize.ENTITY_FLAGS)


@query(
    "q_entity_eligibility",
    STAGE_VIEWS,
    f"WITH {CATEGORY_SQL}\nSELECT supplier_legal_name, supply_type_code, status_code, eligible_flag, count(*) AS documents FROM cat GROUP BY ALL",
)
def q_entity_eligibility(i):
    return categorized(i, "receivable").groupBy(
        "supplier_legal_name", "supply_type_code", "status_code", "eligible_flag"
    ).agg(F.count("*").alias("documents"))


# ---------------------------------------------------------------- validation

_LINE_BAD = """((item_class = 'GOODS' AND NOT regexp_matches(cast(length(hsn_code) AS varchar), '4|6|8'))
   OR (item_class = 'SERVICE' AND NOT regexp_matches(cast(length(hsn_code) AS varchar), '4|5|6')){extra})"""
_TAX_BAD = """EXISTS (SELECT 1 FROM tx WHERE tx.transaction_id = p.transaction_id) AND (
   (p.shipment_type = 'INTRA' AND (EXISTS (SELECT 1 FROM tx WHERE tx.transaction_id = p.transaction_id AND tx.tax_name = 'IGST')
      OR NOT EXISTS (SELECT 1 FROM tx WHERE tx.transaction_id = p.transaction_id AND tx.tax_name = 'CGST')
      OR NOT EXISTS (SELECT 1 FROM tx WHERE tx.transaction_id = p.transaction_id AND tx.tax_name = 'SGST')))
   OR (p.shipment_type = 'INTER' AND (NOT EXISTS (SELECT 1 FROM tx WHERE tx.transaction_id = p.transaction_id AND tx.tax_name = 'IGST')
      OR EXISTS (SELECT 1 FROM tx WHERE tx.transaction_id = p.transaction_id AND tx.tax_name IN ('CGST', 'SGST'))))
   OR (p.supply_type_code LIKE '%WOP' AND EXISTS (SELECT 1 FROM tx WHERE tx.transaction_id = p.transaction_id AND tx.taxable_amount <> 0)))"""


def validated_sql(mode: str) -> str:
    """CTEs hdr .. val: each rule of the run as one CTE that reads the state left by the one before."""
    ar = mode == "receivable"
    b2b = "supply_type_code = 'B2B' AND "
    recipient = ["recipient_legal_name", "recipient_address", "recipient_state_code_upd", "recipient_phone_num"]
    recipient += ([] if ar else ["recipient_email"]) + ["recipient_country_code", "recipient_place", "recipient_state_number_upd"]
    supplier = ["supplier_legal_name", "supplier_address", "supplier_state_code", "supplier_country_code", "supplier_place"]
    document = ["shipment_type", "pos_state_code_upd", "sez_unit", "document_date", "supply_type_code"]

    def nulls(columns):
        return "(" + " OR ".join(f"{c} IS NULL" for c in columns) + ")"

    def lines_where(cond):
        return f"EXISTS (SELECT 1 FROM ln0 WHERE ln0.transaction_id = p.transaction_id AND {cond})"

    both, first_only = "status_code IN ('PENDING', 'ERROR')", "status_code = 'PENDING'"
    bad_line = _LINE_BAD.format(extra=" OR item_class IS NULL" if ar else "")
    mail = "" if ar else "email,"
    rules = [
        (both if ar else first_only, b2b + "(recipient_gstin IS NULL OR recipient_gstin = 'GSTNOTAVAILABLE' OR length(recipient_gstin) <> 15)", "Invalid or null recipient GSTIN ;"),
        (both, b2b + "recipient_gstin = supplier_gstin", "Recipient GSTIN is equal to Supplier GSTIN ;"),
        (both, nulls(recipient), f"Invalid recipient data, check billing address,place,phone number,{mail}country and state code"),
        (both, nulls(supplier), "Invalid supplier data, check legal name and address details"),
        (both, nulls(document), "Invoice Type or POS State or SEZ unit or document_date or Supply Type is null"),
        (both, "(supplier_gstin IS NULL OR supplier_gstin = 'GSTNOTAVAILABLE')" if ar else "supplier_gstin IS NULL", "Invalid or null Supplier GSTIN" if ar else "Supplier GSTIN is null"),
        (both, "substr(document_num, 1, 1) IN ('0', '/', '-')", "Document num can not start with 0, / and -" if ar else "Document num to start with 0, / and -"),
        (both, b2b + "(substr(supplier_gstin, 1, 2) <> supplier_state_number OR substr(recipient_gstin, 1, 2) <> recipient_state_number_upd)", "Invalid Recipient or Supplier GSTN"),
    ]
    if ar:
        rules.append((both, b2b + "substr(recipient_gstin, 3, 10) <> coalesce(recipient_pan, 'XXXXXX')", "Invalid PAN number in GSTIN"))
    rules += [
        (both, lines_where(bad_line), "Invalid or null HSN or SAC Code"),
        (both, "(SELECT count(*) FROM ln0 WHERE ln0.transaction_id = p.transaction_id) > 7", "Line count less than 1 or greater than 1000"),
        (both, _TAX_BAD, "Incorrect taxes extracted"),
        (both, "line_of_business IS NULL", "Line of Business is null"),
    ]
    if ar:
        rules.append((both, """document_type_code IN (SELECT meaning FROM fx_lookup WHERE lookup_type = 'DOCUMENT_TYPES' AND description = 'Document Type Code'
     AND enabled_flag = 'Y' AND lookup_code IN ('O')) AND NOT EXISTS (SELECT 1 FROM fx_hdr s WHERE s.document_num = p.preceding_doc_num
     AND strftime(s.document_date, '%Y-%m-%d') = p.preceding_doc_date)""", "Original invoice Number and Date is not correct"))
    ctes = [categorized_sql(mode, keep_type=ar)]
    last = "cat"
    if ar:
        odd = """status_code IN ('PENDING', 'SUCCESS-INELIGIBLE') AND document_type_code NOT IN (SELECT meaning FROM fx_lookup
     WHERE lookup_type = 'DOCUMENT_TYPES' AND description = 'Document Type Code' AND enabled_flag = 'Y')"""
        home = f"status_code = 'PENDING' AND recipient_country_code = 'IN' AND {_TYPE_IN.format(d=chr(32) + 'AND description = ' + chr(39) + 'Export Type' + chr(39))}"
        ctes.append(f"""v1 AS (SELECT p.* REPLACE (CASE WHEN {odd} THEN 'SUCCESS-INELIGIBLE' ELSE status_code END AS status_code,
   CASE WHEN {odd} THEN coalesce(status_message, '') || 'Ineligible Document Type Code####' ELSE status_message END AS status_message,
   CASE WHEN {odd} THEN 'N' ELSE eligible_flag END AS eligible_flag) FROM cat p)""")
        ctes.append(f"""v2 AS (SELECT p.* REPLACE (CASE WHEN {home} THEN 'ERROR' ELSE status_code END AS status_code,
   CASE WHEN {home} THEN coalesce(status_message, '') || 'Country value India is not eligible for EXPORT customers####' ELSE status_message END AS status_message) FROM v1 p)""")
        last = "v2"
    for n, (guard, cond, text) in enumerate(rules, 1):
        hit = f"{guard} AND {cond}"
        ctes.append(f"""w{n} AS (SELECT p.* REPLACE (CASE WHEN {hit} THEN 'ERROR' ELSE status_code END AS status_code,
   CASE WHEN {hit} THEN coalesce(status_message, '') || '{text}####' ELSE status_message END AS status_message) FROM {last} p)""")
        last = f"w{n}"
    ctes.append(f"""val AS (SELECT p.* REPLACE (CASE WHEN status_code = 'ERROR' THEN 'ERROR:' || coalesce(status_message, '') ELSE status_message END AS status_message) FROM {last} p)""")
    return ",\n".join(ctes)


VALID_VIEWS = [*STAGE_VIEWS, "fx_hdr"]
VALID_OUT = ["transaction_id", "status_code", "supply_type_code", "eligible_flag", "status_message"]
RECEIVABLE_SQL = validated_sql("receivable")


@query("q_validate_ar", VALID_VIEWS, f"WITH {RECEIVABLE_SQL}\nSELECT {', '.join(VALID_OUT)} FROM val")
def q_validate_ar(i):
    return validated(i, "receivable").select(*VALID_OUT)


@query("q_validate_mat", VALID_VIEWS, f"WITH {validated_sql('transfer')}\nSELECT {', '.join(VALID_OUT)} FROM val")
def q_validate_mat(i):
    return validated(i, "transfer").select(*VALID_OUT)


@query(
    "q_run_summary",
    VALID_VIEWS,
    f"WITH {RECEIVABLE_SQL}\nSELECT 2 AS request_id, {SUMMARY_SQL} FROM val",
)
def q_run_summary(i):
    return reconcile.run_summary(validated(i, "receivable"))


@query(
    "q_entity_outcome",
    VALID_VIEWS,
    f"""WITH {RECEIVABLE_SQL}
SELECT supplier_legal_name, {SUMMARY_SQL}, cast(sum(total_base_amount) AS double) AS base_amount, cast(sum(total_tax_amount) AS double) AS tax_amount,
  cast(sum(gross_amount) AS double) AS gross_amount FROM val GROUP BY supplier_legal_name""",
)
def q_entity_outcome(i):
    counted = ["supplier_legal_name", "supply_type_code", "status_code", "total_base_amount", "total_tax_amount", "gross_amount"]
    out = i.once("outcomes", lambda: validated(i, "receivable").select(*counted))
    counts = reconcile.run_summary(out, ["supplier_legal_name"])
    sums = out.groupBy("supplier_legal_name").agg(
        F.sum("total_base_amount").alias("base_amount"), F.sum("total_tax_amount").alias("tax_amount"), F.sum("gross_amount").alias("gross_amount")
    )
    return doubles(counts.join(sums, "supplier_legal_name"), "base_amount", "tax_amount", "gross_amount")


@query(
    "q_error_breakdown",
    VALID_VIEWS,
    f"""WITH {RECEIVABLE_SQL}
SELECT status_code, message, count(*) AS documents FROM (SELECT status_code,
  unnest(string_split(CASE WHEN status_message LIKE 'ERROR:%' THEN substr(status_message, 7) ELSE status_message END, '####')) AS message FROM val)
WHERE message <> '' GROUP BY status_code, message""",
)
def q_error_breakdown(i):
    return validate.error_breakdown(validated(i, "receivable"))


@query(
    "q_validate_code_length",
    ["fx_stage"],
    f"""WITH {HDR_SQL}
SELECT transaction_id, bool_or(coalesce({_LINE_BAD.format(extra='')}, false)) AS any_bad_code, bool_or(item_class IS NULL) AS any_unclassed,
  bool_or(coalesce((item_class = 'GOODS' AND length(hsn_code) NOT IN (4, 6, 8)) OR (item_class = 'SERVICE' AND length(hsn_code) NOT IN (4, 5, 6)), false)) AS any_bad_code_strict
FROM ln0 GROUP BY transaction_id""",
)
def q_validate_code_length(i):
    return line_rows(i).groupBy("transaction_id").agg(
        F.bool_or(validate.bad_code()).alias("any_bad_code"),
        F.bool_or(F.col("item_class").isNull()).alias("any_unclassed"),
        F.bool_or(validate.bad_code(strict=True)).alias("any_bad_code_strict"),
    )


@query(
    "q_validate_line_count",
    ["fx_hdr", "fx_line"],
    """
SELECT h.document_id, count(l.document_id) > 7 AS too_many, count(l.document_id) > 7 OR count(l.document_id) = 0 AS too_many_or_empty
FROM fx_hdr h LEFT JOIN fx_line l ON l.document_id = h.document_id GROUP BY h.document_id
""",
)
def q_validate_line_count(i):
    counts = i["fx_line"].groupBy("document_id").agg(F.count("*").alias("line_count"))
    return i["fx_hdr"].select("document_id").join(counts, "document_id", "left").select(
        "document_id",
        validate.count_out_of_range(7).alias("too_many"),
        validate.count_out_of_range(7, include_empty=True).alias("too_many_or_empty"),
    )


@query(
    "q_validate_tax_pattern",
    STAGE_VIEWS,
    f"""WITH {CATEGORY_SQL}
SELECT transaction_id, shipment_type, supply_type_code, coalesce({_TAX_BAD}, false) AS wrong FROM cat p""",
)
def q_validate_tax_pattern(i):
    return categorized(i, "receivable").select("transaction_id", "shipment_type", "supply_type_code", F.coalesce(validate.wrong_taxes(), F.lit(False)).alias("wrong"))


@query(
    "q_validate_original_doc",
    ["fx_stage", "fx_hdr"],
    f"""WITH {HDR_SQL}
SELECT transaction_id, preceding_doc_num, EXISTS (SELECT 1 FROM fx_hdr s WHERE s.document_num = hdr.preceding_doc_num
  AND strftime(s.document_date, '%Y-%m-%d') = hdr.preceding_doc_date) AS original_found FROM hdr""",
)
def q_validate_original_doc(i):
    out = validate.original_document_flag(unique_headers(i["fx_stage"]), source_documents(i), "document_num", "document_date")
    return out.select("transaction_id", "preceding_doc_num", "original_found")
