"""New hires, vendor requests and registrations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.catalog.registry import NOW, RUN_TS, query
from ledgerloom.operators import people, registrations, vendors

_VALID = "flow_id = 1 AND process_flag = 'V' AND worker_type = 'Employee'"


@query(
    "q_new_hires",
    ["fx_hire", "fx_people"],
    f"""SELECT employee_number, gender, title FROM fx_hire h WHERE {_VALID} AND emp_status LIKE 'Active%'
  AND NOT EXISTS (SELECT 1 FROM fx_people p WHERE p.employee_number = h.employee_number)""",
)
def q_new_hires(i):
    return people.new_hires(i["fx_hire"], i["fx_people"], 1).select("employee_number", "gender", "title")


@query(
    "q_match_existing",
    ["fx_hire", "fx_people", "fx_assign"],
    f"""
WITH m AS (SELECT p.employee_number, p.person_id, a.assignment_id, row_number() OVER (PARTITION BY p.employee_number ORDER BY p.person_id, a.assignment_id) AS n
  FROM fx_people p JOIN fx_assign a ON a.person_id = p.person_id WHERE {NOW} BETWEEN date_trunc('day', a.effective_start) AND date_trunc('day', a.effective_end))
SELECT h.employee_number, h.flow_id, CASE WHEN {_VALID} THEN m.person_id END AS person_id, CASE WHEN {_VALID} THEN m.assignment_id END AS assignment_id
FROM fx_hire h LEFT JOIN m ON m.employee_number = h.employee_number AND m.n = 1
""",
)
def q_match_existing(i):
    out = people.match_existing(i["fx_hire"], i["fx_people"], i["fx_assign"], 1, RUN_TS)
    return out.select("employee_number", "flow_id", "person_id", "assignment_id")


@query(
    "q_resolve_number",
    ["fx_hire", "fx_people"],
    """SELECT employee_number, employee_number || (CASE WHEN employee_number IN (SELECT npw_number FROM fx_people WHERE npw_number IS NOT NULL) THEN '-1' ELSE '' END) AS new_number
FROM fx_hire""",
)
def q_resolve_number(i):
    return people.resolve_number(i["fx_hire"], i["fx_people"]).select("employee_number", "new_number")


@query(
    "q_standardise",
    ["fx_hire", "fx_lookup"],
    """
SELECT employee_number, (SELECT max(lookup_code) FROM fx_lookup WHERE lookup_type = 'SEX' AND upper(meaning) = upper(gender)) AS gender_code,
  (SELECT max(lookup_code) FROM fx_lookup WHERE lookup_type = 'TITLE' AND upper(lookup_code) = upper(title)) AS title_code, 'O' AS mail_code, 'RO' AS residency_code,
  cast((CASE WHEN cast(substr(dob, 8, 2) AS integer) < 50 THEN '20' ELSE '19' END) || substr(dob, 8, 2) || '-' ||
    (CASE substr(dob, 4, 3) WHEN 'JAN' THEN '01' WHEN 'Jul' THEN '07' ELSE '12' END) || '-' || substr(dob, 1, 2) AS varchar) AS birth_date
FROM fx_hire
""",
)
def q_standardise(i):
    out = people.standardise(i["fx_hire"], i["fx_lookup"], RUN_TS.year)
    return out.select(
        "employee_number", "gender_code", "title_code", "mail_code", "residency_code", F.col("birth_date").cast("string").alias("birth_date")
    )


# ---------------------------------------------------------------- vendors

DEFAULT_UNIT = ("OU4", 104)


def request_sql(number: str, name: str, flag: str) -> str:
    """Six branches, as many statements: three sites for the mapped unit, three for the default unit."""
    branches = []
    for unit, org, keep in (("m.operating_unit", "m.org_id", "m.operating_unit <> 'OU4'"), ("'OU4'", "104", "true")):
        for site, account in (("OFFICE", "office_prepay"), ("HOME", "home_prepay"), ("PROVISIONAL", "prov_prepay")):
            branches.append(f"""
SELECT 3 AS request_id, p.person_id AS employee_id, {number} AS employee_number, p.full_name AS employee_name, a.legal_entity,
  coalesce(p.current_employee_flag, 'C') AS current_employee_flag, {unit} AS operating_unit, {org} AS org_id, {name} AS vendor_name,
  p.full_name AS vendor_name_alt, 'E' || {number} AS vendor_code, '{site}' AS vendor_site_code, p.email_address, p.pan, 'N' AS process_flag
FROM fx_people p JOIN fx_assign a ON a.person_id = p.person_id JOIN fx_account_map m ON m.legal_entity = a.legal_entity
WHERE m.enabled_flag = 'Y' AND coalesce(m.effective_end, {NOW} + INTERVAL 1 DAY) >= {NOW} AND {keep} AND m.{account} IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM fx_vendor v WHERE v.employee_id = p.person_id) AND NOT EXISTS (SELECT 1 FROM fx_vendor_queue q WHERE q.employee_id = p.person_id)
  AND {NOW} BETWEEN p.effective_start AND coalesce(p.effective_end, {NOW}) AND {NOW} BETWEEN a.effective_start AND coalesce(a.effective_end, {NOW})
  AND {flag} = 'Y'""")
    return " UNION ".join(branches)


_NUMBER = "coalesce(p.employee_number, p.npw_number)"
_FLAG = "coalesce(p.current_employee_flag, p.current_npw_flag)"


def _requests(i, **options):
    return vendors.vendor_requests(
        i["fx_people"], i["fx_assign"], i["fx_account_map"], i["fx_vendor"], i["fx_vendor_queue"], DEFAULT_UNIT, RUN_TS, 3, **options
    )


REQUEST_VIEWS = ["fx_people", "fx_assign", "fx_account_map", "fx_vendor", "fx_vendor_queue"]


@query("q_vendor_requests", REQUEST_VIEWS, request_sql(_NUMBER, f"{_NUMBER} || '-' || p.full_name", _FLAG))
def q_vendor_requests(i):
    return _requests(i)


@query(
    "q_vendor_requests_as_is",
    REQUEST_VIEWS,
    request_sql(_NUMBER, "coalesce(p.employee_number, p.npw_number || '-' || p.full_name)", _FLAG),
)
def q_vendor_requests_as_is(i):
    return _requests(i, name_style="as_is")


@query(
    "q_vendor_requests_employees",
    REQUEST_VIEWS,
    request_sql("p.employee_number", "p.employee_number || '-' || p.full_name", "p.current_employee_flag"),
)
def q_vendor_requests_employees(i):
    return _requests(i, employees_only=True)


@query(
    "q_plan_vendors",
    ["fx_vendor_queue", "fx_vendor"],
    """
WITH w AS (SELECT q.*, (SELECT min(v.vendor_id) FROM fx_vendor v WHERE v.vendor_code = q.vendor_code AND v.vendor_name = q.vendor_name) AS known,
  row_number() OVER (PARTITION BY vendor_code, vendor_name ORDER BY employee_id, org_id, vendor_site_code) AS n
  FROM fx_vendor_queue q WHERE process_flag = 'N' AND request_id = 1)
SELECT employee_id, org_id, vendor_site_code, known AS known_vendor_id,
  CASE WHEN vendor_id IS NOT NULL OR vendor_site_id IS NOT NULL THEN 'REGISTER' WHEN known IS NOT NULL THEN 'REUSE' WHEN n = 1 THEN 'CREATE' ELSE 'ADD_SITE' END AS action
FROM w
""",
)
def q_plan_vendors(i):
    return vendors.plan_vendors(i["fx_vendor_queue"], i["fx_vendor"], 1).select(
        "employee_id", "org_id", "vendor_site_code", "known_vendor_id", "action"
    )


@query(
    "q_site_address",
    ["fx_vendor_queue", "fx_org", "fx_loc"],
    """
SELECT q.employee_id, q.org_id, q.vendor_site_code, l.address1 AS address_line1, l.address2 AS address_line2, l.place AS city, l.pincode AS zip, l.country_code AS country
FROM fx_vendor_queue q LEFT JOIN fx_org o ON o.organization_id = q.org_id - 100 + (q.employee_id % 90) LEFT JOIN fx_loc l ON l.location_id = o.location_id
""",
)
def q_site_address(i):
    queue = i["fx_vendor_queue"].withColumns(
        {"unit": F.col("org_id"), "org_id": F.col("org_id") - 100 + F.col("employee_id") % 90}
    )
    columns = {"address1": "address_line1", "address2": "address_line2", "place": "city", "pincode": "zip", "country_code": "country"}
    out = vendors.site_address(queue, i["fx_org"], i["fx_loc"], columns)
    return out.select("employee_id", F.col("unit").alias("org_id"), "vendor_site_code", *columns.values())


def account_sql(kind: str) -> str:
    def pick(alias):
        return f"CASE q.vendor_site_code WHEN 'OFFICE' THEN {alias}.office_{kind} WHEN 'HOME' THEN {alias}.home_{kind} WHEN 'PROVISIONAL' THEN {alias}.prov_{kind} END"

    return f"""CASE WHEN s.org_id IS NOT NULL AND (m.org_id IS NOT NULL OR f.org_id IS NOT NULL) THEN
  coalesce(s.segment1, '') || '.' || coalesce(s.segment2, '') || '.' || coalesce(CASE WHEN m.org_id IS NOT NULL THEN {pick('m')} ELSE {pick('f')} END, '') || '.' ||
  coalesce(s.segment4, '') || '.' || coalesce(s.segment5, '') || '.' || coalesce(s.segment6, '') || '.' || coalesce(s.segment7, '') || '.' || coalesce(s.segment8, '') || '.' ||
  coalesce(s.segment9, '') END AS {kind}_account"""


@query(
    "q_account_string",
    ["fx_vendor_queue", "fx_segment", "fx_account_map"],
    f"""
SELECT q.employee_id, q.org_id, q.vendor_site_code, q.legal_entity, {account_sql('liab')}, {account_sql('prepay')}
FROM fx_vendor_queue q LEFT JOIN fx_segment s ON s.org_id = q.org_id
LEFT JOIN fx_account_map m ON m.org_id = q.org_id AND m.legal_entity = q.legal_entity
LEFT JOIN (SELECT * FROM fx_account_map WHERE operating_unit = 'OU4' ORDER BY legal_entity LIMIT 1) f ON f.org_id = q.org_id
""",
)
def q_account_string(i):
    queue = i["fx_vendor_queue"].select("employee_id", "org_id", "vendor_site_code", "legal_entity")
    liab = vendors.account_string(queue, i["fx_segment"], i["fx_account_map"], "OU4", "liab")
    return vendors.account_string(liab, i["fx_segment"], i["fx_account_map"], "OU4", "prepay")


# ---------------------------------------------------------------- registrations

_CODE = """(SELECT min(c.{c}) FROM fx_lookup k JOIN fx_report_code c ON upper(c.reporting_code) = upper(k.meaning)
  WHERE k.lookup_type = 'PAN_VENDOR_TYPE' AND k.enabled_flag = 'Y' AND k.lookup_code = {t} AND c.reporting_type_id = 5
  AND (c.effective_end IS NULL OR c.effective_end >= {now}) AND (k.effective_end IS NULL OR k.effective_end >= {now}))"""


def _code_sql(column: str, pan: str) -> str:
    own = _CODE.format(c=column, now=NOW, t=f"coalesce(nullif(substr({pan}, 4, 1), ''), 'P')")
    return f"coalesce({own}, {_CODE.format(c=column, now=NOW, t=chr(39) + 'P' + chr(39))})"


REPORT_CODE_VIEWS = ["fx_person", "fx_lookup", "fx_report_code"]


@query(
    "q_reporting_code",
    REPORT_CODE_VIEWS,
    f"""
WITH p AS (SELECT person_id, CASE WHEN current_npw_flag = 'Y' THEN NULL ELSE pan END AS pan FROM fx_person)
SELECT person_id, pan, {_code_sql('reporting_code_id', 'pan')} AS reporting_code_id, {_code_sql('reporting_code', 'pan')} AS reporting_code FROM p
""",
)
def q_reporting_code(i):
    who = i["fx_person"].select("person_id", F.when(F.col("current_npw_flag").isNull(), F.col("pan")).alias("pan"))
    out = registrations.reporting_code(who, "pan", i["fx_lookup"], i["fx_report_code"], 5, RUN_TS)
    return out.select("person_id", "pan", "reporting_code_id", "reporting_code")


_REQUESTED = f"""
req AS (SELECT q.employee_id AS party_id, q.employee_id * 10 + q.org_id % 10 AS party_site_id, q.org_id, p.pan,
   {_code_sql('reporting_code_id', 'p.pan')} AS reporting_code_id FROM fx_vendor_queue q LEFT JOIN fx_person p ON p.person_id = q.employee_id),
party AS (SELECT DISTINCT party_id, pan, reporting_code_id FROM req WHERE NOT EXISTS (SELECT 1 FROM fx_party_reg g WHERE g.party_id = req.party_id AND g.party_site_id IS NULL AND g.supplier_flag = 'Y')),
site AS (SELECT DISTINCT party_id, party_site_id, org_id, pan, reporting_code_id FROM req WHERE NOT EXISTS (SELECT 1 FROM fx_party_reg g
   WHERE g.party_id = req.party_id AND g.party_site_id = req.party_site_id AND g.org_id = req.org_id)),
made AS (SELECT 'party' AS level, 9000 + row_number() OVER (ORDER BY party_id) AS party_reg_id, party_id, cast(NULL AS bigint) AS party_site_id, NULL AS org_id, pan, reporting_code_id FROM party
  UNION ALL SELECT 'site', 90000 + row_number() OVER (ORDER BY party_id, party_site_id, org_id), party_id, party_site_id, org_id, pan, reporting_code_id FROM site)"""


def _registration_requests(i):
    persons = i["fx_person"].select("person_id", "pan")
    queue = i["fx_vendor_queue"].select(
        F.col("employee_id").alias("party_id"), (F.col("employee_id") * 10 + F.col("org_id") % 10).alias("party_site_id"), "org_id"
    )
    rows = queue.join(persons, F.col("party_id") == F.col("person_id"), "left").drop("person_id")
    return registrations.reporting_code(rows, "pan", i["fx_lookup"], i["fx_report_code"], 5, RUN_TS)


@query(
    "q_missing_registrations",
    [*REPORT_CODE_VIEWS, "fx_vendor_queue", "fx_party_reg"],
    f"""WITH {_REQUESTED}
SELECT m.level, m.party_reg_id, CASE m.level WHEN 'party' THEN 'THIRD_PARTY' ELSE 'THIRD_PARTY_SITE' END AS party_type_code,
  CASE m.level WHEN 'party' THEN 'N' ELSE 'Y' END AS site_flag, m.party_id, m.party_site_id, m.org_id, coalesce(m.pan, 'PANNOTAVBL') AS registration_number,
  '2017-07-01' AS effective_from, m.reporting_code_id FROM made m""",
)
def q_missing_registrations(i):
    """The three outputs of both levels side by side, joined on the new id."""
    requests, out = _registration_requests(i), None
    for level, start in (("party", 9001), ("site", 90001)):
        made = registrations.missing_registrations(requests, i["fx_party_reg"], level, start, 5)
        rows = (
            made["header"]
            .join(made["line"], "party_reg_id")
            .join(made["association"], "party_reg_id", "left")
            .select(
                F.lit(level).alias("level"), "party_reg_id", "party_type_code", "site_flag", "party_id", "party_site_id", "org_id",
                "registration_number", F.date_format("effective_from", "yyyy-MM-dd").alias("effective_from"), "reporting_code_id",
            )
        )
        out = rows if out is None else out.unionByName(rows)
    return out


@query(
    "q_scd2_change",
    ["fx_reg_all", "fx_reg_both"],
    """
WITH held AS (SELECT *, count(*) FILTER (WHERE effective_to IS NULL AND registration_number IS NOT NULL AND registration_type_code LIKE 'PAN%')
    OVER (PARTITION BY party_id, party_site_id, org_id) AS open_rows FROM fx_reg_all),
ch AS (SELECT h.*, coalesce(i.registration_number, 'PANNOTAVBL') AS new FROM held h JOIN fx_reg_both i ON i.party_id = h.party_id
    AND i.party_site_id IS NOT DISTINCT FROM h.party_site_id AND i.org_id IS NOT DISTINCT FROM h.org_id
  WHERE h.open_rows = 1 AND h.effective_to IS NULL AND h.registration_number IS NOT NULL AND h.registration_type_code LIKE 'PAN%'
    AND coalesce(i.registration_number, 'PANNOTAVBL') <> h.registration_number)
SELECT r.party_id, r.party_site_id, r.org_id, r.reg_id, r.registration_type_code, r.registration_number,
  strftime(r.effective_from, '%Y-%m-%d') AS effective_from,
  strftime(CASE WHEN r.effective_to IS NULL AND r.registration_type_code = 'PAN' AND EXISTS (SELECT 1 FROM ch WHERE ch.reg_id = r.reg_id
    AND upper(trim(ch.registration_number)) = upper(trim(r.registration_number))) THEN timestamp '2001-07-31 00:00:00' ELSE r.effective_to END, '%Y-%m-%d') AS effective_to
FROM fx_reg_all r
UNION ALL SELECT party_id, party_site_id, org_id, reg_id, 'PAN', new, '2001-08-01', NULL FROM ch
""",
)
def q_scd2_change(i):
    out = registrations.scd2_change(i["fx_reg_all"], i["fx_reg_both"], RUN_TS)
    return out.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in ("effective_from", "effective_to")})
