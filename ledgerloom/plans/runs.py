"""End-to-end runs. Each takes tables as DataFrames and returns the new tables as DataFrames; the caller
decides where they are written (`sources.sinks`). Tables that several later steps read are written once."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ledgerloom.functions.moments import iso_day
from ledgerloom.operators import (
    categorize, headers, lines, people, purge, reassign, recipients, reconcile, registrations, reports, staging,
    validate, vendors, writeback,
)
from ledgerloom.operators.lookups import attach_attributes
from ledgerloom.session import RunContext, cut_buckets, cut_lineage
from ledgerloom.sources.sinks import write_delimited
from ledgerloom.sources.stored import StoredTable


# facts only the rules and messages read; not part of the header table
RULE_FLAGS = [
    *categorize.TYPE_FLAGS, *categorize.ENTITY_FLAGS, "is_known_type", "is_enabled_type", "is_note", "original_found",
    "any_bad_code", "any_unclassed", "any_tax_amount", "any_zero_tax", "has_CGST", "has_SGST", "has_IGST",
]


# the column that the tables of a run lie by, and the key of a document among them: one number has one header
PLACED = "document_num"
DOCUMENT = [PLACED, "transaction_id"]


@dataclass
class ExtractRun:
    headers: DataFrame
    lines: DataFrame
    taxes: DataFrame
    payments: DataFrame
    history: DataFrame | None
    summary: DataFrame
    source: DataFrame  # all source documents with the outcome written back
    source_changes: DataFrame  # new state of those that the run changed
    quarantine: DataFrame  # staging rows of the documents that were left out
    violations: dict[str, DataFrame] = field(default_factory=dict)
    counts: dict[str, int] = field(default_factory=dict)  # rows of each of the violations, as the run counted them
    superseded: DataFrame | None = None  # new state of the earlier headers that the run extracted again
    superseding_keys: dict[str, object] = field(default_factory=dict)


def stage_transfers(t: Mapping[str, DataFrame], run: RunContext, days: int, floor: datetime, mail: str) -> DataFrame:
    gated = dict(t) | {
        "transfers": staging.recent_window(t["transfers"], "creation_date", days, floor, "reprocess_flag", run.run_ts)
    }
    rows = staging.transfer_rows(gated, written=True)
    return staging.stage_union(
        staging.extract_transit(gated, mail, rows), staging.extract_inter(gated, mail, rows),
        staging.extract_challan(gated, mail, placed=True),
    )


def stage_receivables(t: Mapping[str, DataFrame], run: RunContext, days: int, floor: datetime) -> DataFrame:
    gated = dict(t) | {
        "all_invoices": t["invoices"],
        "invoices": staging.recent_window(
            t["invoices"], "creation_date", days, floor, "reprocess_flag", run.run_ts, whole_days=False
        ),
    }
    rows = cut_lineage(staging.invoice_rows(gated, "real"))
    return staging.stage_union(
        staging.extract_order_invoices(gated, invoices=rows), staging.extract_direct_invoices(gated, invoices=rows)
    ).repartition(PLACED)


def open_transfers(transfers: DataFrame, run: RunContext, days: int, floor: datetime) -> DataFrame:
    """Source rows of the window that a transfer run has to find: not failed, in a batch, with a number."""
    rows = staging.recent_window(transfers, "creation_date", days, floor, "reprocess_flag", run.run_ts)
    numbered = F.col("tax_invoice_no").isNotNull() | F.col("del_challan_num").isNotNull()
    return rows.where((F.col("process_flag") != "E") & F.col("batch_id").isNotNull() & numbered)


Report = Callable[[DataFrame], object]


def _handle(counts: Mapping[str, int], on_violation: str, headers_so_far: DataFrame, on_failure: Report | None) -> None:
    """Stop at the first check that found anything; the report on the headers goes out before."""
    failed = [name for name, rows in counts.items() if rows]
    if failed and on_violation == "raise":
        if on_failure is not None:
            on_failure(headers_so_far)
        raise reconcile.ReconciliationError(failed[0])


def _checked_facts(facts: DataFrame, lines_: DataFrame, taxes: DataFrame, transfers: DataFrame) -> tuple[DataFrame, dict[str, int], int]:
    """(facts written once, findings of the line and tax checks, lines of all documents). The findings are observed while
    the facts are written, so no check needs a job of its own. They are added up over tasks: a repeated task may add to a
    finding, but cannot make one where there is none."""
    own = facts.join(reconcile.document_checks(lines_, taxes, DOCUMENT), DOCUMENT, "left")
    # only the rows of the run's own documents are counted
    rows = transfers.join(facts.select("document_num", "batch_id"), ["document_num", "batch_id"], "left_semi")
    own = own.join(rows.groupBy("document_num", "batch_id").agg(F.count("*").alias("source_rows")), ["document_num", "batch_id"], "left")
    seen = Observation()
    totals = {
        "duplicate items": F.sum("repeated_items"),
        "duplicate taxes": F.sum("repeated_taxes"),
        "line and tax amounts": F.sum("unequal_taxes"),
        "source and line counts": F.count_if(F.col("source_rows") != F.col("line_count")),
        "lines": F.sum("line_count"),
    }
    written = cut_buckets(own.observe(seen, *[F.coalesce(total, F.lit(0)).cast("long").alias(name) for name, total in totals.items()]), PLACED)
    found = dict(seen.get)
    return written.select(*facts.columns), {name: found[name] for name in totals if name != "lines"}, found["lines"]


def run_extract(
    t: Mapping[str, DataFrame],
    mode: str,
    run: RunContext,
    first_id: int,
    days: int = 90,
    floor: datetime = datetime(2020, 10, 1),
    mail: str = "",
    history: DataFrame | None = None,
    on_violation: str = "raise",
    note_codes: tuple[str, ...] = ("CM", "DM"),
    max_lines: int = validate.MAX_LINES,
    on_failure: Report | None = None,
) -> ExtractRun:
    """Extract -> headers -> lines and taxes -> categorize -> validate -> payments -> summary.

    `on_violation='raise'` stops at the first failed check, as the source job does; `'exclude'` leaves out
    documents with repeated or already processed numbers, returns their rows as `quarantine` and reports the
    checks. The outcome is written back to the source documents (`source`), so that a rerun finds them done.
    A failed check calls `on_failure` with the headers so far, once, before it stops the run. Source rows of a
    transfer run without a header do not stop it: they are listed and the summary returns a failure.

    Checks cost one job before the headers get their ids, none for lines and taxes (their findings are observed while the
    facts are written) and one at the end. `store_run` keeps the outcome; inside `session.scratch` the intermediate tables
    go when the run is over.
    """
    receivable = mode == "receivable"
    # headers, lines, taxes and facts are grouped and joined where the staging rows of a document lie
    stage = cut_buckets(
        stage_receivables(t, run, days, floor) if receivable else stage_transfers(t, run, days, floor, mail), PLACED
    )
    built = cut_buckets(headers.build_headers(stage, run.request_id), PLACED)
    found = {"duplicate document numbers": reconcile.duplicates(built, ["document_num"])}
    if history is not None:
        found["documents already processed"] = reconcile.already_processed(built, history).select("document_num")
    counts = reconcile.violation_counts(found)
    _handle(counts, on_violation, built, on_failure)
    left_out = [rows for name, rows in found.items() if counts[name]]
    quarantine = lines.quarantined(stage, *left_out) if left_out else stage.where("false")
    for rows in left_out:
        built = built.join(rows.select("document_num"), "document_num", "left_anti")
    keyed = headers.assign_ids(built, first_id, [PLACED], placed=True)
    superseded, keys = None, {}
    if history is not None:
        keys = {"document_num": None, "batch_id": 1}
        if "document_id" in keyed.columns and "document_id" in history.columns:
            keys["document_id"] = 1
        superseded = headers.superseded_rows(history, keyed, keys)
        history = headers.supersede(history, keyed, keys)

    placed_lines = cut_buckets(lines.build_lines(stage, keyed, PLACED, keep_key=True), PLACED)
    placed_taxes = cut_buckets(lines.build_taxes(stage, keyed, placed_lines, PLACED, keep_key=True), PLACED)
    line_table, tax_table = placed_lines.drop(PLACED), placed_taxes.drop(PLACED)
    described = keyed
    if receivable:
        described = attach_attributes(keyed, t["customers"], "cust_id", {"pan": "recipient_pan"}, "cust_id").repartition(PLACED)
    described = cut_buckets(described, PLACED)
    enriched = headers.enrich_headers(described, t["locations"], t["lookup"], mode)
    facts = validate.document_facts(enriched, placed_lines, placed_taxes, key=DOCUMENT)
    if not receivable:
        transfers = t["transfers"].select(F.col("tax_invoice_no").alias("document_num"), "batch_id")
        facts, findings, line_rows = _checked_facts(facts, placed_lines, placed_taxes, transfers)
        documents = keyed.select("transaction_id", "document_num", "batch_id")
        checks = {
            "duplicate items": reconcile.duplicates(line_table, ["transaction_id", "item_code"]),
            "duplicate taxes": reconcile.duplicates(tax_table, ["transaction_id", "line_number", "tax_name"]),
            "line and tax amounts": reconcile.amount_mismatch(
                line_table, tax_table, ["transaction_id", "line_number"], "tax_amount", "taxable_amount"
            ),
            "source and line counts": reconcile.count_mismatch(
                transfers.join(documents, ["document_num", "batch_id"], "left_semi"), line_table.join(documents, "transaction_id"),
                ["document_num", "batch_id"],
            ),
        }
        _handle(findings, on_violation, enriched, on_failure)
        found |= checks
        counts |= findings
    result = categorize.categorize(facts, t["lookup"], t["eligible"], run.run_ts)
    if receivable:
        source = t["invoices"].select("document_num", iso_day(F.col("document_date")).alias("document_date"))
        result = validate.validate_receivable(result, t["lookup"], source, note_codes, max_lines)
    else:
        result = validate.validate_transfer(result, max_lines)
    result = writeback.source_message(result, t["lookup"], partial=receivable).drop(*RULE_FLAGS)
    result = cut_lineage(staging.with_audit(result, run))
    payments = writeback.payment_payload(result, t["payment_addresses"], t["lookup"], run.run_ts)
    final = writeback.apply_payment(result, payments)
    source = _with_results(t["invoices"] if receivable else t["transfers"])
    on, sets = (invoice_keys if receivable else transfer_keys)(), _result_columns(run)
    back, changes = writeback.write_back(source, final, on, sets), writeback.changed_rows(source, final, on, sets)
    reconciled = True
    if not receivable:
        lost = reconcile.missing_in_target(
            open_transfers(t["transfers"], run, days, floor), final, {True: "del_challan_num", False: "tax_invoice_no"},
            F.col("invoice_process") == headers.CHALLAN,
        )
        marked = changes.where(F.col("result_type").isNotNull())
        # the headers as they will be stored, against their lines
        apart = reconcile.amount_mismatch(
            result.select("transaction_id", "gross_amount"), line_table, ["transaction_id"], "gross_amount", "gross_amount"
        )
        last = reconcile.violation_counts({"header and line amounts": apart, "source rows without header": lost, "marked": marked})
        reconciled = last["source rows without header"] == 0
        last["written-back rows and lines"] = int(last.pop("marked") != line_rows)
        _handle({name: n for name, n in last.items() if name != "source rows without header"}, on_violation, final, on_failure)
        rows = reconcile.row_count_check(marked, line_table).where(~F.col("agrees"))
        found |= {"header and line amounts": apart, "source rows without header": lost, "written-back rows and lines": rows}
        counts |= last
    summary = reconcile.run_summary(final, reconciled=reconciled)
    return ExtractRun(final, line_table, tax_table, payments, history, summary, back, changes, quarantine, found, counts, superseded, keys)


def store_run(done: ExtractRun, mode: str, run: RunContext, header_table: StoredTable, source_table: StoredTable) -> dict[str, list[object]]:
    """Keep a run in stored tables; returns the rewritten partitions of each. Earlier headers that were extracted again
    are replaced in their requests' partitions, the run's own headers take the place of what an earlier attempt of the
    same request left, and of the source documents only the partitions with changed rows are rewritten."""
    old = [] if done.superseded is None else header_table.rewrite(
        done.superseded, lambda rows: headers.supersede(rows, done.headers, done.superseding_keys)
    )
    kept = header_table.schema.names
    absent = {f.name: F.lit(None).cast(f.dataType) for f in header_table.schema if f.name not in done.headers.columns}
    header_table.replace(done.headers.withColumns(absent).select(*kept))
    on, sets = (invoice_keys if mode == "receivable" else transfer_keys)(), _result_columns(run)
    changes = writeback.changed_rows(source_table.read(), done.headers, on, sets)
    return {"headers": old, "source": source_table.rewrite(changes, lambda rows: writeback.write_back(rows, done.headers, on, sets))}


RESULT_COLUMNS = {
    "result_request": "int", "result_type": "string", "result_message": "string", "result_eligible": "string", "result_id": "long",
}


def _with_results(source: DataFrame) -> DataFrame:
    """Source documents with the columns of the outcome; absent ones are empty."""
    return source.withColumns({c: F.lit(None).cast(kind) for c, kind in RESULT_COLUMNS.items() if c not in source.columns})


def transfer_keys():
    """Key of the result -> expression over the source transfers: number and batch."""
    return {"document_num": F.coalesce("tax_invoice_no", "del_challan_num"), "batch_id": F.col("batch_id")}


def invoice_keys():
    return {"document_num": F.col("document_num"), "document_id": F.col("document_id")}


def write_back_transfers(transfers: DataFrame, result: DataFrame, run: RunContext) -> DataFrame:
    """Source transfers with type, message, eligibility and id of their document."""
    return writeback.write_back(_with_results(transfers), result, transfer_keys(), _result_columns(run))


def write_back_invoices(invoices: DataFrame, result: DataFrame, run: RunContext) -> DataFrame:
    return writeback.write_back(_with_results(invoices), result, invoice_keys(), _result_columns(run))


def _result_columns(run: RunContext):
    return {
        "result_request": F.lit(run.request_id),
        "result_type": F.col("supply_type_code"),
        "result_message": F.col("source_message"),
        "result_eligible": F.col("eligible_flag"),
        "reprocess_flag": F.lit("N"),
        "result_id": F.col("transaction_id"),
    }


def run_status_report(
    header_table: DataFrame, errors: DataFrame, names: Mapping[str, tuple[DataFrame, str, str, str]], run: RunContext,
    path: str, **filters
) -> DataFrame:
    """Write the report file; an ALERT returns the header state with the reported rows marked as sent."""
    selected = reports.report_filter(header_table, run_ts=run.run_ts, **filters)
    report = reports.status_report(selected, errors, names)
    columns = {c: title for c, title in reports.STATUS_TITLES.items() if c in report.columns}
    write_delimited(report, columns, path)
    return writeback.mark_sent(header_table, selected) if filters.get("mode") == "ALERT" else header_table


def run_print(
    header_table: DataFrame, line_table: DataFrame, tax_table: DataFrame, parameters: DataFrame, column: str, mode: str,
    lookup: DataFrame, process: str, footer: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """(print rows, documents selected without detail) for comma lists of document numbers or batches."""
    pattern = reports.BATCH_PATTERN if "Batch" in mode else reports.LIST_PATTERN
    values = reports.split_params(parameters, column, "_item", pattern).select("_item").distinct()
    selected = reports.select_documents(header_table, values, mode, lookup, process)
    detail = reports.print_detail(header_table, line_table, tax_table, selected, footer)
    return detail, reconcile.missing_detail(selected, detail)


def run_closure(log: DataFrame, run: RunContext, status: str, path: str) -> tuple[DataFrame, DataFrame]:
    """Write the closure list, pack the recipients; (notification batches, listed documents)."""
    listed = reports.closure_list(log, run.request_id, status)
    columns = {c: title for c, title in reports.CLOSURE_TITLES.items() if c in listed.columns}
    write_delimited(listed, columns, path)
    packed = recipients.pack_recipients(
        recipients.closure_recipients(log, status), ["status_code", "document_type_code"], "requestor_email"
    )
    return recipients.notification_batches(packed), listed


def run_purge(
    receipt_headers: DataFrame, receipt_lines: DataFrame, transactions: DataFrame, interface: DataFrame, days: int, run: RunContext
) -> dict[str, DataFrame]:
    """Orphan headers, then their interface rows: kept and logged tables of both, checked before returning."""
    victims = cut_lineage(
        purge.find_orphans(receipt_headers, receipt_lines, transactions, interface, days, run.run_ts).select("header_id")
    )
    kept, log, check = purge.purge_with_audit(receipt_headers, victims, ["header_id"], run)
    kept_if, log_if, check_if = purge.purge_with_audit(interface, victims, ["header_id"], run)
    for part, c in (("headers", check), ("interface", check_if)):
        reconcile.require_empty(c.where(~F.col("agrees")), f"purged and logged {part} differ")
    return {"headers": kept, "header_log": log, "interface": kept_if, "interface_log": log_if}


def run_reassign(notifications: DataFrame, kind: str, key: str | None, from_user: str, to_user: str) -> DataFrame:
    return reassign.reassign_plan(reassign.select_notifications(notifications, kind, key, from_user), to_user)


def run_new_hires(
    stage: DataFrame, persons: DataFrame, assignments: DataFrame, lookup: DataFrame, flow: int | str, run: RunContext
) -> tuple[DataFrame, DataFrame]:
    """(staging state with known people matched, creation requests with standardised codes)."""
    matched = people.match_existing(stage, persons, assignments, flow, run.run_ts)
    fresh = people.resolve_number(people.new_hires(stage, persons, flow), persons)
    return matched, people.standardise(fresh, lookup, run.run_ts.year)


def run_vendors(t: Mapping[str, DataFrame], default_unit: tuple[str, int], run: RunContext, reprocess: bool = False) -> dict[str, DataFrame]:
    """New queue state and the plan of what to ask the vendor service for."""
    queue = t["queue"]
    new = vendors.vendor_requests(
        t["people"], t["assignments"], t["account_map"], t["vendors"], queue, default_unit, run.run_ts, run.request_id
    )
    state = queue.unionByName(new.select(*[c for c in new.columns if c in queue.columns]), allowMissingColumns=True)
    if reprocess:
        state = writeback.reset_failed(state, run.request_id)
    state = cut_lineage(state)
    plan = vendors.plan_vendors(state, t["vendors"], run.request_id)
    for kind in ("liab", "prepay"):
        plan = vendors.account_string(plan, t["segments"], t["account_map"], default_unit[0], kind)
    return {"queue": state, "plan": plan}


def run_registrations(
    requests: DataFrame, party_regs: DataFrame, reg_lines: DataFrame, lookup: DataFrame, codes: DataFrame, first_id: int,
    reporting_type_id: int | None, run: RunContext
) -> dict[str, DataFrame]:
    """Registrations missing at party and site level, and the type-2 history after number changes."""
    coded = cut_lineage(registrations.reporting_code(requests, "pan", lookup, codes, reporting_type_id, run.run_ts))
    party = registrations.missing_registrations(coded, party_regs, "party", first_id, reporting_type_id)
    next_id = first_id + party["header"].count()
    site = registrations.missing_registrations(coded, party_regs, "site", next_id, reporting_type_id)
    # a vendor's number holds for its registration and for those of its sites
    number = F.col("pan").alias("registration_number")
    incoming = coded.select("party_id", "party_site_id", "org_id", number).union(
        coded.select("party_id", F.lit(None).cast("long"), F.lit(None).cast("int"), number)
    )
    return {
        **{name: party[name].unionByName(site[name]) for name in party},
        "history": registrations.scd2_change(reg_lines, incoming, run.run_ts),
    }
