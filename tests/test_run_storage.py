"""Runs kept in stored tables, checks without jobs of their own, scratch folders of runs."""

import tempfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame as ClassicFrame

from ledgerloom.catalog import extracts
from ledgerloom.catalog.registry import RUN
from ledgerloom.operators import reconcile
from ledgerloom.plans import runs
from ledgerloom.session import scratch
from ledgerloom.sources.stored import StoredTable
from tests.test_operators import _tables
from tests.test_stored import files, folders


def state(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("mode", ["receivable", "transfer"])
def test_run_is_stored_by_touched_partitions(spark, inputs, monkeypatch, mode):
    receivable = mode == "receivable"
    given = extracts.receivable_tables(inputs) if receivable else extracts.transfer_tables(inputs) | {"transfers": inputs["fx_transfer"]}
    name = "invoices" if receivable else "transfers"
    folder, scratches = tempfile.mkdtemp(prefix="run-"), tempfile.mkdtemp(prefix="run-")
    source = given[name].withColumn("month", F.date_format("creation_date", "yyyy-MM"))
    kind = "AR INVOICE" if receivable else "TRANSFER"
    history = inputs["fx_hdr"].select(
        "document_num", "batch_id", "document_id", (F.col("document_id") % 12 + 10).cast("int").alias("request_id"),
        F.when(F.col("document_id") % 3 == 0, "ERROR").otherwise("RE-EXTRACTED").alias("status_code"), F.lit(None).cast("long").alias("transaction_id"))
    if not receivable:
        history = history.drop("document_id")
    calls = []
    monkeypatch.setattr(ClassicFrame, "isEmpty", lambda self: calls.append(self) or True)
    with scratch(spark, scratches) as path:
        source_table = StoredTable.create(runs._with_results(source), f"{folder}/source", "month")
        header_table = StoredTable.create(history, f"{folder}/headers", "request_id")
        before = files(source_table), files(header_table)
        tables = _tables(inputs, given | {name: source_table.read()})
        done = runs.run_extract(
            tables, mode, RUN, 1000, extracts.DAYS, extracts.FLOOR, extracts.MAIL, history=header_table.read(), on_violation="exclude", note_codes=("O",))
        # whatever was counted while writing is what the checks find when asked one by one
        assert {k: done.violations[k].count() for k in done.counts if k not in ("line and tax amounts", "duplicate items", "duplicate taxes")} == {
            k: n for k, n in done.counts.items() if k not in ("line and tax amounts", "duplicate items", "duplicate taxes")}
        assert all(bool(done.violations[k].count()) == bool(n) for k, n in done.counts.items())
        want, want_changes = state(done.source), state(done.source_changes)
        want_headers = state(done.history.select(*header_table.schema.names))
        own = state(done.headers.withColumns({c: F.lit(None) for c in header_table.schema.names if c not in done.headers.columns}).select(*header_table.schema.names))
        assert Path(path).is_dir()
        touched = runs.store_run(done, mode, RUN, header_table, source_table)
    assert calls == [] and list(Path(scratches).iterdir()) == []
    # the stored state is the full new state, and only folders with changed rows are new
    assert state(source_table.read()) == want and set(want_changes) <= set(want)
    after = files(source_table)
    assert {n for n in before[0] if n not in after} == {n for n in before[0] if n.split("/")[0] in {f"month={m}" for m in touched["source"]}}
    assert 0 < len(touched["source"]) < len(folders(before[0]))
    assert state(header_table.read()) == sorted(want_headers + own, key=str)
    kept = files(header_table)
    assert folders(n for n in before[1] if n not in kept) == {f"request_id={r}" for r in touched["headers"]}
    # the same run once more: nothing doubles
    assert f"request_id={RUN.request_id}" in folders(kept)


def test_failed_run_leaves_no_tables(spark, inputs):
    folder = tempfile.mkdtemp(prefix="run-")
    with pytest.raises(reconcile.ReconciliationError):
        with scratch(spark, folder):
            runs.run_extract(
                _tables(inputs, extracts.receivable_tables(inputs)), "receivable", RUN, 1, extracts.DAYS, extracts.FLOOR,
                history=inputs["fx_hdr"].select("document_num", F.lit(9).alias("request_id"), F.lit("SUCCESS").alias("status_code"), "batch_id"))
    assert list(Path(folder).iterdir()) == []


def test_document_checks_find_what_the_single_checks_find(spark):
    lines = spark.createDataFrame(
        [(1, 1, "A", 5.0), (1, 2, "A", 6.0), (1, 3, None, 1.0), (1, 4, None, 1.0), (2, 1, "B", 2.0), (3, 1, "C", None), (4, 1, "D", 9.0)],
        "transaction_id long, line_number int, item_code string, tax_amount double")
    taxes = spark.createDataFrame(
        [(1, 1, "X", 2.0), (1, 1, "Y", 3.0), (1, 2, "X", 1.0), (1, 2, "X", 5.0), (2, 1, "X", 7.0), (3, 1, "X", 1.0), (9, 1, "X", 1.0), (9, 1, "X", 1.0)],
        "transaction_id long, line_number int, tax_name string, taxable_amount double")
    found = {r["transaction_id"]: tuple(r)[1:] for r in reconcile.document_checks(lines, taxes).collect()}
    assert found == {1: (2, 1, 0), 2: (None, 0, 1), 9: (None, 1, 0)}
    assert reconcile.duplicates(lines, ["transaction_id", "item_code"]).count() == 2
    assert reconcile.duplicates(taxes, ["transaction_id", "line_number", "tax_name"]).count() == 2
    assert reconcile.amount_mismatch(lines, taxes, ["transaction_id", "line_number"], "tax_amount", "taxable_amount").count() == 1
    assert reconcile.violation_counts({"a": lines, "b": taxes.where("false")}) == {"a": 7, "b": 0} and reconcile.violation_counts({}) == {}
