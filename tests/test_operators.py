"""Operators on hand-made rows, invariants, and the runs with their files."""

import os
import tempfile
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerloom.catalog import extracts, reporting, statuses
from ledgerloom.catalog.registry import RUN, RUN_TS
from ledgerloom.catalog.whole_runs import _tables
from ledgerloom.operators import headers, lines, lookups, people, purge, reassign, reconcile, registrations, reports, staging, vendors, writeback
from ledgerloom.plans import runs
from ledgerloom.session import RunContext, cut_lineage
from ledgerloom.sources.sinks import append_run, write_delimited, write_run
from ledgerloom.sources.tables import scan
from tests.conftest import SMALL

NTZ = "timestamp_ntz"


def folder():
    return tempfile.mkdtemp(prefix="run-")


def test_membership_is_three_valued(spark):
    lookup = spark.createDataFrame([("T", "Regular", "a", "Y"), ("T", "Old", "a", "N"), ("U", "Odd", "a", "Y")], "lookup_type string, meaning string, description string, enabled_flag string")
    df = spark.createDataFrame([("REGULAR",), ("OLD",), ("ODD",), (None,)], "c string")
    out = lookups.membership(df, "c", lookup, "T", {"f": F.col("enabled_flag") == "Y"}, F.upper("meaning"))
    assert {r.c: r.f for r in out.collect()} == {"REGULAR": True, "OLD": False, "ODD": False, None: None}


def test_null_batch_equals_one_when_superseding(spark):
    schema = "document_num string, batch_id int, status_code string"
    history = spark.createDataFrame([("A", None, "ERROR"), ("A", 1, "ERROR"), ("A", 2, "ERROR"), ("A", 1, "SUCCESS"), ("B", 1, None)], schema)
    current = spark.createDataFrame([("A", 1, "PENDING"), ("A", 1, "PENDING"), ("B", None, "PENDING")], schema)
    out = headers.supersede(history, current, {"document_num": None, "batch_id": 1})
    assert sorted(map(str, (tuple(r) for r in out.collect()))) == sorted(map(str, [
        ("A", None, "RE-EXTRACTED"), ("A", 1, "RE-EXTRACTED"), ("A", 2, "ERROR"), ("A", 1, "SUCCESS"), ("B", 1, None)]))


def test_already_processed_reads_other_requests_only(spark):
    schema = "document_num string, request_id int, status_code string"
    held = spark.createDataFrame([("A", 1, "SUCCESS"), ("A", 2, "PENDING"), ("B", 2, "PENDING"), ("C", 1, "ERROR"), ("D", 3, None), ("E", 1, "PENDING"), ("E", 1, "PENDING")], schema)
    current = spark.createDataFrame([(n, 2, "PENDING") for n in "ABCDE"], schema)
    assert sorted(r.document_num for r in reconcile.already_processed(current, held).collect()) == ["A", "E"]


def test_header_class_cases(spark):
    hdr = spark.createDataFrame([(n, "Y" if n == 5 else None) for n in range(1, 7)], "transaction_id int, is_service string")
    ls = spark.createDataFrame(
        [(1, "GOODS"), (1, "SERVICE"), (2, "GOODS"), (3, "SERVICE"), (4, None), (5, "GOODS"), (2, None)], "transaction_id int, item_class string")
    got = {r.transaction_id: r.is_service for r in lines.header_class(hdr, ls).collect()}
    assert got == {1: "M", 2: "N", 3: "Y", 4: None, 5: "Y", 6: None}


def test_missing_price_becomes_zero_and_lines_are_distinct(spark, inputs):
    stage = inputs["fx_stage"]
    hdr = lines.without_duplicates(headers.build_headers(stage, 2)).withColumn("transaction_id", F.col("document_id"))
    built = lines.build_lines(stage, hdr)
    assert built.where("price IS NULL").isEmpty() and not built.where("price = 0").isEmpty()
    assert reconcile.duplicates(built, ["transaction_id", "line_number"]).isEmpty()
    rolled = lines.rollup_amounts(hdr, built)
    assert reconcile.amount_mismatch(rolled, built, ["transaction_id"], "gross_amount", "gross_amount").isEmpty()


def test_require_empty_stops(spark):
    with pytest.raises(reconcile.ReconciliationError):
        reconcile.require_empty(spark.range(3), "three rows")
    reconcile.require_empty(spark.range(0), "none")


def test_overlay_replaces_and_inserts(spark):
    dim = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    rows = spark.createDataFrame([("b", 3), ("c", 4)], "k string, v int")
    assert sorted(map(tuple, staging.overlay_rows(dim, rows, ["k"]).collect())) == [("a", 1), ("b", 3), ("c", 4)]


def test_split_params_refuses_and_trims(spark):
    df = spark.createDataFrame([(1, " a1, b 2 ,,c,, "), (2, "a;b"), (3, None), (4, " ")], "id int, p string")
    got = sorted((r.id, r.v) for r in reports.split_params(df, "p", "v").collect())
    assert got == [(1, "a1"), (1, "b2"), (1, "c")]
    numbers = spark.createDataFrame([(1, "1,2"), (2, "1,x")], "id int, p string")
    assert reports.split_params(numbers, "p", "v", reports.BATCH_PATTERN).count() == 2


def test_purge_keeps_and_logs_everything(spark, inputs):
    head, *_ = statuses.receipts(inputs)
    kept, log, check = purge.purge_with_audit(head, statuses.orphans(inputs), ["header_id"], RUN)
    c = check.first()
    assert c.agrees and c.logged_rows > 0 and c.kept_rows + c.logged_rows == c.input_rows
    assert kept.join(log, "header_id", "left_semi").isEmpty()


def test_notification_key_prefix(spark, inputs):
    n = inputs["fx_notif"]
    everything = reassign.select_notifications(n, "PR", None, "USER3").count()
    some = reassign.select_notifications(n, "PR", "13-9", "USER3")
    assert 0 < some.count() < everything
    assert some.where(~F.col("item_key").contains("13")).isEmpty()


def test_write_back_with_rows_without_a_key(spark):
    source = spark.createDataFrame([("A", 1, "old"), ("A", 2, "old"), (None, 1, "old"), (None, None, "old"), ("B", None, "old")], "num string, batch int, state string")
    result = spark.createDataFrame([("A", 1, "new"), ("B", 3, "new"), (None, 1, "new")], "document_num string, batch_id int, outcome string")
    out = writeback.write_back(source, result, {"document_num": F.col("num"), "batch_id": F.col("batch")}, {"state": F.col("outcome")})
    assert out.columns == source.columns
    rows = {(r.num, r.batch): r.state for r in out.collect()}
    assert rows == {("A", 1): "new", ("A", 2): "old", (None, 1): "old", (None, None): "old", ("B", None): "old"}


def test_reporting_code_in_force_and_of_its_type(spark, inputs):
    who = spark.createDataFrame([(1, "AAAPA"), (2, "AAACA"), (3, "AAAHA"), (4, None)], "id int, pan string")
    found = lambda kind: {r.id: r.reporting_code_id for r in registrations.reporting_code(who, "pan", inputs["fx_lookup"], inputs["fx_report_code"], kind, RUN_TS).collect()}
    # the list's entry for H has ended, so its code is not reached
    assert found(5) == {1: 11, 2: 12, 3: 11, 4: 11}
    assert found(6) == {1: 8, 2: 8, 3: 8, 4: 8} and set(found(9).values()) == {None}


def test_scd2_cases(spark):
    d0, run = datetime(1998, 7, 1), RUN_TS
    regs = spark.createDataFrame(
        [(1, 11, "OLD", d0, None), (2, 12, "SAME", d0, None), (3, 13, "A", d0, None), (3, 14, "B", d0, None), (4, 15, "X", d0, datetime(2000, 1, 1)),
         (5, 16, "KEEP", d0, None), (6, 17, "PANNOTAVBL", d0, None)],
        f"party_id int, reg_id int, registration_number string, effective_from {NTZ}, effective_to {NTZ}")
    incoming = spark.createDataFrame([(1, "NEW"), (2, "SAME"), (3, "C"), (4, "Y"), (6, None)], "party_id int, registration_number string")
    once = registrations.scd2_change(regs, incoming, run)
    new = [(r.party_id, r.registration_number) for r in once.where(F.col("effective_from") == F.lit("2001-08-01 00:00:00").cast(NTZ)).collect()]
    closed = [(r.party_id, r.effective_to) for r in once.where("effective_to IS NOT NULL").collect()]
    assert new == [(1, "NEW")]
    assert sorted(closed) == [(1, datetime(2001, 7, 31)), (4, datetime(2000, 1, 1))]
    # a second run with the same numbers changes nothing
    assert once.exceptAll(registrations.scd2_change(once, incoming, run)).isEmpty()


def test_number_change_of_each_registration(spark):
    """Party and site level of one vendor change apart; other types and other registrations stay."""
    d0 = datetime(1998, 7, 1)
    schema = f"party_id long, party_site_id long, org_id int, reg_id long, registration_type_code string, registration_number string, effective_from {NTZ}, effective_to {NTZ}"
    regs = spark.createDataFrame(
        [(1, None, None, 10, "PAN", "OLD", d0, None), (1, 7, 2, 11, "PAN", "OLD", d0, None), (1, 7, 2, 11, "TAN", "OLD", d0, None),
         (1, 8, 2, 12, "PAN", "OLD", d0, None)], schema)
    incoming = spark.createDataFrame(
        [(1, None, None, "NEW"), (1, 7, 2, "NEW")], "party_id long, party_site_id long, org_id int, registration_number string")
    out = registrations.scd2_change(regs, incoming, RUN_TS)
    got = sorted((r.reg_id, r.registration_type_code, r.registration_number, r.effective_to is None) for r in out.collect())
    assert got == [(10, "PAN", "NEW", True), (10, "PAN", "OLD", False), (11, "PAN", "NEW", True), (11, "PAN", "OLD", False),
                   (11, "TAN", "OLD", True), (12, "PAN", "OLD", True)]
    assert out.exceptAll(registrations.scd2_change(out, incoming, RUN_TS)).isEmpty()


def test_failed_action_mail_flags_the_whole_request(spark):
    log = spark.createDataFrame(
        [(1, 5, "PO", "SUCCESS"), (2, 5, "REQUISITION", "SUCCESS"), (3, 6, "PO", "SUCCESS")],
        "document_id int, request_id int, document_type_code string, status_code string").withColumns(
        {"mail_sent_flag": F.lit(None).cast("string"), "status_message": F.lit(None).cast("string")})
    outcome = spark.createDataFrame(
        [(5, "PO", "SUCCESS", False), (5, "REQUISITION", "SUCCESS", True), (6, "PO", "SUCCESS", True)],
        "request_id int, document_type_code string, status_code string, sent boolean")
    got = {r.document_id: r.mail_sent_flag for r in writeback.closure_transition(log, outcome).collect()}
    assert got == {1: "N", 2: "N", 3: "Y"}
    with pytest.raises(reconcile.ReconciliationError):
        writeback.closure_transition(log, spark.createDataFrame([(5, "PO", "PENDING", False)], outcome.schema))


def test_report_file_keeps_outer_blanks(spark, tmp_path):
    rows = spark.createDataFrame([("  lead", "mid", "trail  ")], "a string, b string, c string")
    write_delimited(rows, {"a": " A", "b": "B", "c": "Z "}, str(tmp_path / "report"))
    written = [l for p in (tmp_path / "report").glob("part-*") for l in p.read_text().splitlines()]
    assert set(written) == {" A~B~Z ", "  lead~mid~trail  "} and written.count("  lead~mid~trail  ") == 1


def test_vendor_plan_orders_requests(spark):
    schema = "employee_id int, vendor_code string, vendor_name string, org_id int, vendor_site_code string, process_flag string, request_id int, vendor_id long, vendor_site_id long"
    queue = spark.createDataFrame(
        [(1, "E1", "n", 2, "HOME", "N", 3, None, None), (1, "E1", "n", 1, "OFFICE", "N", 3, None, None), (2, "E2", "m", 1, "HOME", "N", 3, None, None),
         (3, "E3", "k", 1, "HOME", "N", 3, 77, 88), (4, "E4", "j", 1, "HOME", "E", 3, None, None)], schema)
    known = spark.createDataFrame([("E2", "m", 5), ("E1", "other", 6)], "vendor_code string, vendor_name string, vendor_id int")
    got = {(r.employee_id, r.vendor_site_code): (r.action, r.known_vendor_id) for r in vendors.plan_vendors(queue, known, 3).collect()}
    assert got == {(1, "HOME"): ("ADD_SITE", None), (1, "OFFICE"): ("CREATE", None), (2, "HOME"): ("REUSE", 5), (3, "HOME"): ("REGISTER", 77)}


def test_match_existing_ignores_expired_assignments(spark):
    stage = spark.createDataFrame([(1, "E1", "V", "Employee"), (1, "E2", "V", "Employee"), (1, "E1", "E", "Employee")], "flow_id int, employee_number string, process_flag string, worker_type string")
    persons = spark.createDataFrame([(7, "E1"), (7, "E1"), (8, "E2")], "person_id int, employee_number string")
    a, b, end = datetime(1999, 1, 1), datetime(2000, 1, 1), datetime(2001, 8, 1, 9)
    assign = spark.createDataFrame([(7, 71, a, b), (7, 73, a, end), (7, 72, a, end), (8, 81, a, b)], f"person_id int, assignment_id int, effective_start {NTZ}, effective_end {NTZ}")
    got = sorted((r.employee_number, r.process_flag, r.assignment_id) for r in people.match_existing(stage, persons, assign, 1, RUN_TS).collect() if r.assignment_id)
    assert got == [("E1", "V", 72)]


def test_scan_pushes_filter_and_columns(spark):
    df = scan(spark, SMALL, "orders", F.col("o_orderkey") > 100, ["o_orderkey", "o_custkey"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(o_orderkey,100)" in plan and "o_totalprice" not in plan.split("ReadSchema")[1]


def test_written_table_has_the_same_rows(spark):
    df = spark.range(100).withColumn("s", F.when(F.col("id") % 3 == 0, F.col("id").cast("string")))
    assert cut_lineage(df).exceptAll(df).isEmpty()


def test_delimited_report_file(spark):
    path = f"{folder()}/report"
    df = spark.createDataFrame([("x", None, 'q "t"'), ("", "b", "c")], "a string, b string, c string")
    write_delimited(df, {"a": "One", "b": "Same", "c": "Same"}, path)
    text = "\n".join(p.read_text() for p in Path(path).glob("part-*"))
    assert set(text.split("\n")) - {""} == {"One~Same~Same", 'x~~q "t"', "~b~c"}


def test_rerun_replaces_only_its_request(spark):
    path = f"{folder()}/t"
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "request_id int, v string")
    append_run(rows, path)
    for _ in range(2):
        write_run(spark.createDataFrame([(2, "c"), (2, "d")], "request_id int, v string"), path)
    got = sorted((r.request_id, r.v) for r in spark.read.parquet(path).collect())
    assert got == [(1, "a"), (2, "c"), (2, "d")]


def test_shared_folder_is_the_sessions(spark):
    from ledgerloom.session import shared_folder

    assert spark.conf.get("spark.checkpoint.dir") in shared_folder(spark)


# ---------------------------------------------------------------- runs


@pytest.fixture(scope="module")
def receivable_run(spark, inputs):
    history = inputs["fx_hdr"].where("query_type = 'AR INVOICE' AND document_id < 300").select(
        "document_num", "batch_id", "document_id", F.lit(1).alias("request_id"),
        F.when(F.col("document_id") % 2 == 0, "SUCCESS").otherwise("ERROR").alias("status_code"))
    history = history.unionByName(history.where("document_id % 11 = 0").withColumn("status_code", F.lit("PENDING")))
    return runs.run_extract(
        _tables(inputs, extracts.receivable_tables(inputs)), "receivable", RUN, 1000, extracts.DAYS, extracts.FLOOR,
        history=history, on_violation="exclude", note_codes=("O",))


def test_extract_run_is_consistent(receivable_run):
    r, s = receivable_run, receivable_run.summary.first()
    n = r.headers.count()
    assert n > 50 and s.documents == n
    ids = r.headers.agg(F.min("transaction_id"), F.max("transaction_id"), F.count_distinct("transaction_id")).first()
    assert tuple(ids) == (1000, 999 + n, n)
    assert r.lines.join(r.headers, "transaction_id", "left_anti").isEmpty()
    assert r.taxes.join(r.lines, ["transaction_id", "line_number"], "left_anti").isEmpty()
    assert reconcile.amount_mismatch(r.headers, r.lines, ["transaction_id"], "gross_amount", "gross_amount").isEmpty()
    assert not r.violations["documents already processed"].isEmpty()
    assert not r.history.where("status_code = 'RE-EXTRACTED'").isEmpty()
    assert r.headers.join(r.violations["documents already processed"], "document_num", "left_semi").isEmpty()
    # what was left out is kept apart, with all its rows; what was done is written back
    left_out = r.violations["documents already processed"].union(r.violations["duplicate document numbers"].select("document_num")).distinct()
    assert r.quarantine.select("document_num").distinct().exceptAll(left_out).isEmpty() and not r.quarantine.isEmpty()
    assert r.source.where("result_request IS NOT NULL").count() == n


def test_extract_run_raises_when_told(spark, inputs):
    with pytest.raises(reconcile.ReconciliationError):
        runs.run_extract(
            _tables(inputs, extracts.receivable_tables(inputs)), "receivable", RUN, 1, extracts.DAYS, extracts.FLOOR,
            history=inputs["fx_hdr"].select("document_num", F.lit(9).alias("request_id"), F.lit("SUCCESS").alias("status_code"), "batch_id"))


def test_failed_check_reports_once_before_it_stops(spark, inputs):
    reported = []
    with pytest.raises(reconcile.ReconciliationError):
        runs.run_extract(
            _tables(inputs, extracts.receivable_tables(inputs)), "receivable", RUN, 1, extracts.DAYS, extracts.FLOOR,
            history=inputs["fx_hdr"].select("document_num", F.lit(9).alias("request_id"), F.lit("SUCCESS").alias("status_code"), "batch_id"),
            on_failure=lambda rows: reported.append(rows.count()))
    assert len(reported) == 1 and reported[0] > 0


def test_transfer_run_lists_what_it_did_not_find(spark, inputs):
    tables = _tables(inputs, extracts.transfer_tables(inputs) | {"transfers": inputs["fx_transfer"]})
    r = runs.run_extract(tables, "transfer", RUN, 1000, extracts.DAYS, extracts.FLOOR, extracts.MAIL, on_violation="exclude")
    lost = r.violations["source rows without header"]
    plain = {(h.document_num, h.batch_id, h.invoice_process == "DTP Intra-state") for h in r.headers.select("document_num", "batch_id", "invoice_process").collect()}
    wanted = runs.open_transfers(inputs["fx_transfer"], RUN, extracts.DAYS, extracts.FLOOR).collect()
    expected = sorted(s.document_id for s in wanted if (s.tax_invoice_no, s.batch_id, False) not in plain and (s.del_challan_num, s.batch_id, True) not in plain)
    assert sorted(x.document_id for x in lost.collect()) == expected
    assert {x.return_code for x in r.summary.collect()} == {1} or not expected
    mismatch = r.violations["source and line counts"]
    assert mismatch.where("source_rows = target_rows").isEmpty()
    rows = r.violations["written-back rows and lines"].collect()
    marked = r.source.where("result_request = 2 AND result_type IS NOT NULL").count()
    assert bool(rows) == (marked != r.lines.count())


def test_placed_and_overflow_make_up_all_addresses(spark):
    from ledgerloom.operators import recipients

    df = spark.range(400).select(F.lit("S").alias("g"), F.concat(F.lit("user"), F.col("id") % 300, F.lit("@example.com")).alias("a"))
    packed = recipients.pack_recipients(df, ["g"], "a", 100, 2)
    placed = [x for r in packed.collect() for x in r.recipients.split(" ")]
    left = [r.a for r in recipients.overflow(df, ["g"], "a", 100, 2).collect()]
    assert sorted(placed + left) == sorted({r.a for r in df.collect()}) and left


def test_write_back_then_nothing_is_open(spark, inputs, receivable_run):
    source = inputs["fx_invoice"].withColumns(
        {"result_request": F.lit(None).cast("int"), "result_type": F.lit(None).cast("string"), "result_message": F.lit(None).cast("string"),
         "result_eligible": F.lit(None).cast("string"), "result_id": F.lit(None).cast("long")})
    state = runs.write_back_invoices(source, receivable_run.headers, RUN)
    done = state.where("result_request IS NOT NULL")
    assert done.count() == receivable_run.headers.count()
    assert done.where("reprocess_flag <> 'N' OR result_message IS NULL").isEmpty()
    again = runs.write_back_invoices(state, receivable_run.headers, RUN)
    assert state.exceptAll(again).isEmpty()


def test_status_report_run_writes_and_marks(spark, inputs):
    hdr = reporting.report_headers(inputs)
    names = {"owning_organization_name": (inputs["fx_le"], "le_id", "le_id", "legal_name")}
    path = f"{folder()}/alert"
    errors = inputs["fx_err"].withColumnRenamed("document_id", "transaction_id")
    state = runs.run_status_report(hdr, errors, names, RUN, path, mode="ALERT", lookup=inputs["fx_lookup"], process="TRANSFER", status="ERROR")
    written = [l for p in Path(path).glob("part-*") for l in p.read_text().splitlines()]
    titles = {l for l in written if l.startswith("Batch ID~")}
    assert len(titles) == 1
    marked = state.where("mail_sent = 'Y'").count() - hdr.where("mail_sent = 'Y'").count()
    assert marked > 0 and len([l for l in written if l not in titles]) == marked
    second = reports.report_filter(state, "ALERT", RUN_TS, inputs["fx_lookup"], "TRANSFER", status="ERROR")
    assert second.isEmpty()


def test_print_run(spark, inputs, receivable_run):
    hdr = receivable_run.headers.withColumns(
        {"status_code": F.lit("SUCCESS"), "eligible_flag": F.lit("Y"), "signed_code": F.lit("data:image/png;base64,abc")})
    wanted = hdr.select("document_num").limit(3).agg(F.array_join(F.collect_list(F.regexp_replace("document_num", "[^0-9A-Za-z]", "")), ", ").alias("p"))
    detail, missing = runs.run_print(hdr, receivable_run.lines, receivable_run.taxes, wanted, "p", "Multiple Invoices", inputs["fx_lookup"], "RECEIVABLE")
    assert 0 < detail.select("document_num").distinct().count() <= 3
    assert {r.code_1 for r in detail.collect()} == {"abc"} and missing.columns == ["document_num"]


def test_other_runs(spark, inputs):
    batches, listed = runs.run_closure(inputs["fx_closure"], RunContext(RUN_TS, 2), "PENDING", f"{folder()}/closure")
    assert batches.count() > 0 and listed.count() > 0
    head, ls, tx, iface = statuses.receipts(inputs)
    out = runs.run_purge(head, ls, tx, iface, 365, RUN)
    assert out["headers"].count() + out["header_log"].count() == head.count()
    assert runs.run_reassign(inputs["fx_notif"], "AP", None, "USER3", "USER8").count() > 0
    matched, fresh = runs.run_new_hires(inputs["fx_hire"], inputs["fx_people"], inputs["fx_assign"], inputs["fx_lookup"], 1, RUN)
    assert matched.count() == inputs["fx_hire"].count() and fresh.count() > 0
    t = {"queue": inputs["fx_vendor_queue"], "people": inputs["fx_people"], "assignments": inputs["fx_assign"], "vendors": inputs["fx_vendor"],
         "account_map": inputs["fx_account_map"], "segments": inputs["fx_segment"]}
    done = runs.run_vendors(t, ("OU4", 104), RunContext(RUN_TS, 9), reprocess=True)
    assert done["queue"].where("process_flag = 'E'").isEmpty()
    plan = done["plan"]
    assert plan.where("action = 'CREATE'").select("vendor_code", "vendor_name").distinct().count() == plan.where("action = 'CREATE'").count() > 0
    requests = plan.select(F.col("employee_id").alias("party_id"), (F.col("employee_id") * 10 + F.col("org_id") % 10).alias("party_site_id"), F.col("org_id").cast("int").alias("org_id"), F.lit("ABCPE1234K").alias("pan"))
    made = runs.run_registrations(requests, inputs["fx_party_reg"], inputs["fx_reg"], inputs["fx_lookup"], inputs["fx_report_code"], 1, 5, RUN)
    assert made["header"].count() == made["line"].count() == made["header"].select("party_reg_id").distinct().count()
