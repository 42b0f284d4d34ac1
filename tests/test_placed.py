"""Rows of a document stay where the staging table has put them: what moves, and that the results are those of plain joins."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.catalog import documents, extracts, reporting, statuses
from ledgerloom.operators import lines, validate
from ledgerloom.operators.spread import join_placed
from ledgerloom.plans.inputs import Inputs
from ledgerloom.session import cut_buckets, tune

SMALLEST = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def shuffled(spark):
    """Joins as over large tables."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lines_of_headers_are_numbered_without_moving(shuffled):
    out = documents.q_build_lines(Inputs(tune(shuffled), SMALLEST))
    assert plan(out).count("Exchange hashpartitioning") <= 1  # the keys of the headers


def test_staging_rows_move_as_read(shuffled):
    """Orders with their customers, and lines with their parts, move to the document before anything is derived from them."""
    rows = plan(Inputs(tune(shuffled), SMALLEST)["fx_stage"]).splitlines()
    depth = [len(r) - len(r.lstrip(" :+-")) for r in rows]

    def moved(key):
        """What lies below each exchange by this key."""
        for at, row in enumerate(rows):
            if f"Exchange hashpartitioning({key}#" in row:
                end = next((k for k in range(at + 1, len(rows)) if depth[k] <= depth[at]), len(rows))
                yield "\n".join(rows[at:end])

    (documents_,) = moved("o_orderkey")
    (lines_,) = (text for text in moved("l_orderkey") if "p_name" in text)
    assert "c_name" in documents_ and "concat(" not in documents_
    assert "concat(" not in lines_


def test_staging_rows_are_those_of_the_view(spark, tmp_path, monkeypatch):
    """Keys that repeat, are null or lead nowhere."""
    day = "timestamp_ntz'2000-01-0{}'"
    orders = [(k, c, "FOP"[(k or 0) % 3], 10.5, day.format((k or 0) % 9 + 1), "5-LOW") for k, c in
              ((1, 1), (2, 1), (3, 2), (4, 3), (4, 3), (7, 2), (8, 9), (9, None), (None, 1), (11, 4), (12, 4), (13, 1))]
    def literal(v):
        return "NULL" if v is None else v if isinstance(v, str) and v.startswith("timestamp") else repr(v)
    def table(name, columns, rows):
        values = ", ".join("(" + ", ".join(map(literal, r)) + ")" for r in rows)
        cast = ", ".join(f"cast({c} AS {t}) AS {c}" for c, t in columns.items())
        spark.sql(f"SELECT {cast} FROM VALUES {values} AS v({', '.join(columns)})").write.parquet(str(tmp_path / f"{name}.parquet"))
    table("orders", dict(o_orderkey="long", o_custkey="long", o_orderstatus="string", o_totalprice="double", o_orderdate="timestamp_ntz", o_orderpriority="string"), orders)
    table("customer", dict(c_custkey="long", c_name="string", c_nationkey="int", c_acctbal="double", c_mktsegment="string"),
          [(1, "c1", 1, 1.0, "BUILDING"), (2, "c2", 2, 1.0, "MACHINERY"), (2, "c2 again", None, 1.0, None), (3, None, 3, 1.0, "HOUSEHOLD"),
           (None, "none", 1, 1.0, "BUILDING"), (4, "c4", 1, None, "AUTOMOBILE")])
    table("supplier", dict(s_suppkey="long", s_name="string", s_nationkey="int", s_acctbal="double"),
          [(1, "s1", 1, 1.0), (2, "s2", 2, 1.0), (2, "s2 again", 1, 1.0), (None, "none", 1, 1.0)])
    table("part", dict(p_partkey="long", p_name="string", p_brand="string", p_type="string", p_size="int", p_retailprice="double"),
          [(1, "p1", "b", "t", 1, 9.99), (2, "p2", "b", "t", 7, None), (2, "p2 again", "b", "t", None, 5.25), (60, "p60", "b", "t", 4, 1.005), (None, "none", "b", "t", 1, 1.0)])
    table("lineitem", dict(l_orderkey="long", l_partkey="long", l_suppkey="long", l_linenumber="int", l_quantity="double", l_extendedprice="double",
                           l_tax="double", l_shipdate="timestamp_ntz"),
          [(o, p, s, n, q, e, x, day.format(3)) for o, p, s, n, q, e, x in (
              (1, 1, 1, 1, 5.0, 100.01, 0.05), (1, 2, 2, 2, None, 0.005, 0.08), (2, 60, 2, 1, 7.5, 12.345, None), (3, 1, None, 1, 1.0, 1.0, 0.01),
              (4, 2, 2, 1, 2.0, None, 0.02), (4, 2, 2, 1, 2.0, None, 0.02), (5, 1, 1, 1, 1.0, 1.0, 0.0), (7, 9, 1, 1, 1.0, 1.0, 0.0), (7, None, 2, 2, 1.0, 1.0, 0.0),
              (None, 1, 1, 1, 1.0, 1.0, 0.0), (11, 1, 1, 1, 3.0, 33.33, 0.07), (12, 1, 7, 1, 3.0, 33.33, 0.07), (13, 60, 1, None, 4.0, 44.4, 0.06))])
    moved = Inputs(tune(spark), str(tmp_path))["fx_stage"]
    monkeypatch.setattr("ledgerloom.plans.inputs.ARRIVED", {})
    view = Inputs(tune(spark), str(tmp_path))["fx_stage"]
    assert moved.dtypes == view.dtypes
    assert rows_of(moved) == rows_of(view)
    assert {r.document_id for r in moved.collect()} == {1, 2, 4, 11, 13}


def test_headers_are_written_as_read(shuffled):
    """Once and kept by document: lines do not wait for a move of the headers."""
    i = Inputs(tune(shuffled), SMALLEST)
    out = documents.line_rows(i)
    assert i._frames["headers"].columns == ["transaction_id", "document_id", "document_num", "batch_id"]
    assert "Exchange hashpartitioning" not in plan(out)


def test_headers_do_not_move_to_their_facts(shuffled):
    i = Inputs(tune(shuffled), SMALLEST)
    text = plan(lines.without_duplicates(documents.all_headers(documents.stage(i)), placed=documents.PLACED))
    assert text.count("Exchange hashpartitioning") == 2  # numbers to their count, ids of the single ones back
    text = plan(documents.validated(i, "receivable").select("transaction_id", "status_code", "status_message", "recipient_address"))
    moved = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    assert not any("document_id" not in line and "_preceding" in line for line in moved)


def test_print_rows_are_not_sorted(shuffled):
    """Headers with long codes are hashed against ids and details; the codes are not written with the header table."""
    i = Inputs(tune(shuffled), SMALLEST)
    out = reporting.q_print_detail(i)
    assert "signed_code" not in i._frames["printable"].columns
    text = plan(out)
    assert "ShuffledHashJoin [transaction_id" in text
    last = text[: text.index("ShuffledHashJoin")]
    assert "Sort [" not in last


def test_payments_write_staging_rows_only(spark):
    i = Inputs(tune(spark), SMALLEST)
    statuses.q_payment_payload(i)
    assert "categorized" not in i._frames


def test_taxed_extracts_share_their_rows(spark):
    i = Inputs(tune(spark), SMALLEST)
    extracts.stage_union(i)
    assert "transfer rows" in i._frames


def test_outcomes_are_validated_once(spark):
    i = Inputs(tune(spark), SMALLEST)
    documents.q_entity_outcome(i)
    assert "outcomes" in i._frames


def test_join_by_the_first_key(spark):
    left = spark.createDataFrame([(1, "a", 10), (1, "b", 11), (2, "a", 12), (2, None, 13)], "d int, n string, v int")
    right = spark.createDataFrame([(1, "a", "x"), (2, "a", "y"), (2, None, "z")], "d int, n string, w string")
    assert sorted(join_placed(left, right, ["d", "n"]).select("v", "w").collect()) == [(10, "x"), (12, "y")]
    kept = join_placed(left, right, ["d", "n"], "left").select("v", "w").collect()
    assert sorted((r.v, r.w or "") for r in kept) == [(10, "x"), (11, ""), (12, "y"), (13, "")]
    assert join_placed(left, right, ["d", "n"], "left_semi").columns == ["d", "n", "v"]


def test_single_numbers_by_id(spark):
    rows = [(1, "A", "x"), (1, "A", "y"), (2, "B", "x"), (3, "C", "x"), (4, "C", "x"), (5, None, "x"), (3, "D", "x")]
    headers = spark.createDataFrame(rows, "document_id int, document_num string, place string")
    plain = lines.without_duplicates(headers)
    assert rows_of(lines.without_duplicates(headers, placed="document_id")) == rows_of(plain)
    assert sorted(r.document_num for r in plain.collect()) == ["B", "D"]


def staged(spark, documents_):
    """documents_: id, number, lines of each."""
    rows = [
        (d, n, f"item {k % 7}", f"P{k}", k, 1, None if k % 3 else 5, "9983", 10 * k, k, 11 * k, d, k)
        for d, n, count in documents_ for k in range(count) for _ in range(2)
    ]
    columns = ", ".join(f"{c} string" if c in ("item_name", "item_code", "hsn_code") else f"{c} decimal(12,2)" if c == "price" else f"{c} long"
                        for c in lines.LINE_COLUMNS)
    rows = [(*r[:6], None if r[6] is None else Decimal(r[6]), *r[7:]) for r in rows]
    return spark.createDataFrame(rows, f"document_id long, document_num string, {columns}")


def test_large_and_small_documents_are_numbered_alike(spark, monkeypatch):
    stage = staged(spark, [(1, "A", 40), (2, "B", 3), (3, "C", 1)])
    headers = stage.select("document_id", "document_num").distinct().withColumn("transaction_id", F.col("document_id") + 100)
    keys = ["document_id", "document_num"]
    small = rows_of(lines.build_lines(cut_buckets(stage, "document_id"), headers, keys))
    assert len(small) == 44
    monkeypatch.setattr(lines, "LARGE_DOCUMENT", 20)
    assert rows_of(lines.build_lines(stage, headers, keys)) == small
    assert rows_of(lines.build_lines(stage, headers)) == small


def test_references_by_placed_rows(spark):
    rows = [(1, "N1", "2020-01-01"), (2, "N1", "2020-01-02"), (3, None, "2020-01-01"), (4, "N1", None), (1, "N2", "2020-01-01"), (1, "N1", "2020-01-01")]
    df = spark.createDataFrame(rows, "document_id int, preceding_doc_num string, preceding_doc_date string")
    source = spark.createDataFrame([("N1", "2020-01-01"), ("N1", "2020-01-01"), (None, "2020-01-01")], "n string, d string")
    plain = validate.original_document_flag(df, source, "n", "d")
    placed = validate.original_document_flag(df, source, "n", "d", "document_id").select(*plain.columns)
    assert rows_of(placed) == rows_of(plain)
    assert [r.original_found for r in placed.collect()].count(True) == 2


def test_facts_are_hashed(spark):
    """No line is sorted for the facts of its document."""
    stage = staged(spark, [(1, "A", 4)])
    rows = lines.document_lines(stage).groupBy("document_num").agg(*lines.class_range(), *lines.amount_sums(), *validate.line_facts(False))
    assert "SortAggregate" not in plan(rows)


def test_classes_of_a_document(spark):
    rows = [(1, "GOODS"), (1, "SERVICE"), (1, None), (2, "GOODS"), (2, None), (3, "SERVICE"), (4, None)]
    found = spark.createDataFrame(rows, "d int, item_class string").groupBy("d").agg(*lines.class_range())
    assert sorted(found.collect()) == [(1, "GOODS", "SERVICE"), (2, "GOODS", "GOODS"), (3, "SERVICE", "SERVICE"), (4, None, None)]
