"""Stored tables: only partitions with changed rows are rewritten; scratch folders end with their owner."""

import tempfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import headers, writeback
from ledgerloom.session import cut_lineage, fresh_path, scratch
from ledgerloom.sources.stored import StoredTable


def files(table):
    folder = Path(table.path.removeprefix("file:"))
    found = {str(p.relative_to(folder)): p.stat().st_mtime_ns for p in folder.rglob("part-*")}
    assert found
    return found


def folders(names):
    return {n.split("/")[0] for n in names}


@pytest.fixture
def table(spark):
    # twelve months, one without a value; number 7 stands in two months, NULL numbers in all
    month = F.when(F.col("id") % 13 == 12, None).otherwise(F.format_string("2024-%02d", F.col("id") % 13 + 1))
    rows = spark.range(1300).select(
        "id", F.when(F.col("id") % 50 != 0, F.concat(F.lit("N"), F.col("id") % 400)).alias("num"), month.alias("month"), F.lit("open").alias("state"),
        F.lit("Y").alias("reprocess_flag"),
    )
    return StoredTable.create(rows, fresh_path(spark), "month")


def test_write_back_rewrites_touched_months_only(spark, table):
    result = spark.createDataFrame([("N7", "done"), ("N20", "done"), ("N999", "done"), ("N12", "done")], "num string, outcome string")
    on, sets = {"num": F.col("num")}, {"state": F.col("outcome"), "reprocess_flag": F.lit("N")}
    whole = writeback.write_back(table.read(), result, on, sets)
    want, before = sorted(map(tuple, whole.collect()), key=str), files(table)
    changes = writeback.changed_rows(table.read(), result, on, sets)
    assert sorted(map(tuple, changes.collect()), key=str) == [r for r in want if r[3] == "done"]
    counts = {r["month"]: r["changed_rows"] for r in writeback.touched_partitions(changes, "month").collect()}
    values = table.rewrite(changes, lambda rows: writeback.write_back(rows, result, on, sets))
    assert values == sorted(counts, key=lambda v: (v is not None, v)) and None in values and 1 < len(values) < 13
    after = files(table)
    touched = {f"month={v or '__HIVE_DEFAULT_PARTITION__'}" for v in values}
    assert {n for n, t in before.items() if after.get(n) == t} == {n for n in before if n.split("/")[0] not in touched}
    assert folders(after) == folders(before) and not set(before) & {n for n in after if n.split("/")[0] in touched}
    assert sorted(map(tuple, table.read().collect()), key=str) == want


def test_nothing_to_change_writes_nothing(spark, table):
    before = files(table)
    none = writeback.changed_rows(table.read(), spark.createDataFrame([], "num string, outcome string"), {"num": F.col("num")}, {"state": F.col("outcome")})
    assert table.rewrite(none, lambda rows: rows) == [] and files(table) == before


def test_failed_update_leaves_the_table(spark, table):
    before = sorted(map(tuple, table.read().collect()), key=str)
    with pytest.raises(Exception):
        table.rewrite(table.read().where("id = 3"), lambda rows: rows.withColumn("state", F.raise_error(F.lit("stop")).cast("string")))
    assert sorted(map(tuple, table.read().collect()), key=str) == before


def test_rewriting_reads_only_the_named_folders(spark, table):
    seen = []

    def update(rows):
        seen.append(rows._jdf.queryExecution().executedPlan().toString())
        return rows

    table.rewrite(table.read().where("id = 3"), update)
    assert "PartitionFilters: [isnotnull(month" in seen[0] or "PartitionFilters: [(month" in seen[0] or "month#" in seen[0].split("PartitionFilters:")[1].split("]")[0]


def test_superseding_rewrites_requests_with_failed_rows(spark):
    rows = spark.range(240).select(
        (F.col("id") % 12).cast("int").alias("request_id"), F.concat(F.lit("D"), F.col("id") % 40).alias("document_num"),
        F.when(F.col("id") % 3 == 0, None).otherwise(F.lit(1)).alias("batch_id"), F.when(F.col("id") % 24 < 3, "ERROR").otherwise("SUCCESS").alias("status_code"),
    )
    table = StoredTable.create(rows, fresh_path(spark), "request_id")
    current, keys = spark.createDataFrame([("D0", None), ("D1", 1), ("D5", 1)], "document_num string, batch_id int"), {"document_num": None, "batch_id": 1}
    want = sorted(map(tuple, headers.supersede(table.read(), current, keys).collect()), key=str)
    plan = headers.superseded_rows(table.read(), current, keys)
    assert "EqualTo(status_code,ERROR)" in plan._jdf.queryExecution().executedPlan().toString()
    before = files(table)
    touched = table.rewrite(plan, lambda part: headers.supersede(part, current, keys))
    after = files(table)
    assert 0 < len(touched) < 12 and sorted(map(tuple, table.read().collect()), key=str) == want
    assert folders(n for n in before if n not in after) == {f"request_id={v}" for v in touched}


def test_marks_and_answers_name_the_rows_they_change(spark):
    state = spark.createDataFrame([(1, "N"), (2, "Y"), (3, None), (4, "N")], "transaction_id long, mail_sent string")
    sent = spark.createDataFrame([(1,), (2,), (3,), (3,)], "transaction_id long")
    assert sorted(r[0] for r in writeback.sent_rows(state, sent).collect()) == [1, 3]
    changed = writeback.mark_sent(state, sent).exceptAll(state)
    assert sorted(r[0] for r in changed.collect()) == [1, 3]
    queue = spark.createDataFrame([(1, "N"), (2, "S"), (3, "N"), (None, "N")], "employee_id long, process_flag string")
    answer = spark.createDataFrame([(1,), (2,), (None,)], "employee_id long")
    assert [r[0] for r in writeback.answered_rows(queue, answer, ["employee_id"], F.col("process_flag") == "N").collect()] == [1]


def test_scratch_ends_with_its_owner(spark):
    folder = tempfile.mkdtemp(prefix="run-")
    with scratch(spark, folder) as path:
        assert cut_lineage(spark.range(5)).count() == 5 and Path(path).is_dir()
        with scratch(spark, folder) as inner:
            cut_lineage(spark.range(5))
            assert inner != path and len(list(Path(folder).iterdir())) == 2
        assert not Path(inner).exists()
    assert list(Path(folder).iterdir()) == []
    with pytest.raises(RuntimeError):
        with scratch(spark, folder):
            cut_lineage(spark.range(5))
            raise RuntimeError("stop")
    assert list(Path(folder).iterdir()) == []
