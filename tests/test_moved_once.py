"""Source rows and documents move once: what the transfer extracts, the runs and the print move, and that the rows are those of plain joins."""

import re

import duckdb
import pytest
from pyspark.sql import functions as F

from ledgerloom.catalog import documents, extracts, reporting
from ledgerloom.operators import lines, reports, staging
from ledgerloom.operators.spread import number_placed, number_rows
from ledgerloom.plans import inputs as views
from ledgerloom.plans.inputs import Inputs
from ledgerloom.session import PLACED_BY_ALL, cut_buckets, cut_placed, placed_by_some, tune
from tests.conftest import SMALL


def rows_of(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def moved_by(df):
    """The keys of each exchange of a plan, as many as it has columns."""
    keys = re.findall(r"Exchange hashpartitioning\((.*), \d+\)", plan(df))
    return [re.findall(r"(\w+)#\d+", k) for k in keys]


@pytest.fixture()
def shuffled(spark):
    """Joins as over large tables."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def result_plan(monkeypatch, build, spark):
    """Keys of the exchanges of what a query writes last."""
    seen = []
    monkeypatch.setattr(extracts, "cut_placed", lambda df: seen.append(df) or df)
    build(Inputs(tune(spark), SMALL))
    (df,) = seen
    with placed_by_some(spark):
        return moved_by(df.select("*"))


def test_union_moves_keys_alone(shuffled, monkeypatch):
    """Taxed rows stay with their transactions and challans with their numbers, also when they are made distinct."""
    keys = result_plan(monkeypatch, extracts.stage_union, shuffled)
    assert keys and max(map(len, keys)) <= 3  # placement and the two keys of an item, made distinct


@pytest.mark.parametrize("build", [extracts.extract_transit, extracts.extract_inter])
def test_taxed_extract_moves_by_one_column(shuffled, monkeypatch, build):
    keys = result_plan(monkeypatch, build, shuffled)
    assert keys and all(len(k) == 1 for k in keys)
    assert keys.count(["trx_id"]) <= 5  # tax lines, determination rows, moves, open transfers, and their numbers


HAND_MADE = {
    "fx_transfer": ("tax_invoice_no string, del_challan_num string, batch_id long, item_id long, creation_date timestamp_ntz, reprocess_flag string, "
                    "project string, mo_header_id long, poc_no string, material_cost decimal(12,2), quantity decimal(12,2), from_warehouse_id long, "
                    "to_warehouse_id long, shipment_num string, document_id long", [
        ("A", None, 1, 1, "2000-01-01", None, None, None, "p1", 1, 1, 1, None, "s", 1), ("A", None, 1, 1, "2000-01-01", None, None, None, "p1", 1, 1, 1, None, "s", 1),
        ("A", None, 1, 2, "2000-01-02", "Y", None, None, "p2", 1, 1, 1, None, "s", 1), ("B", None, 1, 1, "2000-01-03", "N", None, None, "p3", 1, 1, 1, None, "s", 2),
        ("C", None, 1, 1, "2000-01-04", None, "PRJ", 7, "p4", 1, 1, 1, None, "s", 3), ("C", None, 1, 1, "2000-01-04", None, None, 8, "p4", 1, 1, 1, None, "s", 3),
        ("C", None, 1, 2, "2000-01-04", None, None, 9, "p5", 1, 1, 1, None, "s", 3), (None, None, 1, 1, "2000-01-05", None, None, None, "p6", 1, 1, 1, None, "s", 4),
        ("D", None, 1, 1, "2000-01-06", None, None, None, "p7", 1, 1, 1, None, "s", 5), ("E", None, 1, None, "2000-01-06", None, None, None, "p8", 1, 1, 1, None, "s", 5),
        (None, "X", 1, 1, "2000-01-07", None, None, 7, "p", 2, -3, 1, None, "s", 6), (None, "X", 1, 1, "2000-01-07", None, None, 7, "p", 2, -3, 1, None, "s", 6),
        (None, "Y", 1, 2, "2000-01-07", None, None, 8, "p", None, 4, 2, None, "s", 7), (None, "Z", 1, 2, "2000-01-07", None, None, None, "p", 1, 4, 2, None, "s", 8),
        (None, "V", 1, 3, "2000-01-07", None, None, 7, "p", 1, 4, None, None, "s", 9), (None, "W", 1, 3, "2000-01-07", None, None, 7, "p", 1, 4, 9, 1, "s", 9)]),
    "fx_move": ("transaction_batch_id long, transaction_set_id long, move_line_id long, organization_id long, owning_organization_id long, "
                "transfer_organization_id long, item_id long, actual_cost decimal(12,2), move_quantity decimal(12,2), poc_name string, shipment_id string, "
                "shipment_num string, batch_id long", [
        (10, 10, 1, 1, 1, 2, 1, 2, -3, "m1", "S1", "N1", 1), (10, 10, 2, 1, 1, None, 2, None, -4, "m2", "S2", "N2", 1), (10, 11, 1, 1, 9, 2, 1, 5, 6, "m3", "S3", "N3", 1),
        (None, 10, 1, 1, 1, 2, 1, 7, 8, "m4", "S4", "N4", 1), (20, 20, 1, 2, 2, 1, 1, 9, 1, "m5", "S5", "N5", None), (20, 20, 2, 2, None, 1, 2, 9, 1, "m6", "S6", "N6", 2),
        (30, 30, 1, None, 1, 1, 1, 9, 1, "m7", "S7", "N7", 2), (20, 20, 1, 2, 2, 1, 1, 9, 1, "m5", "S5", "N5", None)]),
    "fx_move_order": ("header_id long, shipment_id string, poc_name string, phone string, location_id long, organization_id long", [
        (7, "M7", "o7", "ph7", 1, 1), (8, "M8", "o8", None, None, 2), (8, "M8", "o8b", "ph8", 3, 2), (None, "M0", "o0", "ph0", 1, 1)]),
    "fx_tax_line": ("trx_id long, trx_line_id long, entity_code string, det_factor_id long, organization_id long, tax_invoice_num string, tax_type_id int, "
                    "tax_rate decimal(6,3), tax_amount decimal(20,4)", [
        # the total of a line has all its rows, also those under another or no number
        (10, 1, "MTL_TRANSACTION", 100, 1, "A", 1, 5, 10), (10, 1, "MTL_TRANSACTION", 100, 1, "A", 2, 5, 11), (10, 1, "MTL_TRANSACTION", 100, 1, "B", 2, 5, 1000),
        (10, 1, "MTL_TRANSACTION", 100, 1, None, 2, 5, 5000), (10, 1, "MTL_TRANSACTION", 100, 2, "A", 2, 5, 70000), (10, 1, "OTHER", 100, 1, "A", 1, 5, 999999),
        (10, 2, "MTL_TRANSACTION", 101, 1, "A", 3, 5, None), (20, 1, "MTL_TRANSACTION", 200, 2, "C", 3, 5, 12), (20, 1, "MTL_TRANSACTION", 201, 2, "C", 3, 5, 13),
        (20, 2, "MTL_TRANSACTION", 202, 2, "C", 3, 5, 14), (30, 1, "MTL_TRANSACTION", 300, None, "D", 3, 5, 15), (None, 1, "MTL_TRANSACTION", 300, 1, "A", 3, 5, 15)]),
    "fx_tax_factor": ("trx_id long, trx_line_id long, entity_code string, det_factor_id long, hsn_code string", [
        (10, 1, "MTL_TRANSACTION", 100, "h1"), (10, 2, "MTL_TRANSACTION", 101, None), (20, 1, "MTL_TRANSACTION", 200, "h3"), (20, 1, "MTL_TRANSACTION", 200, "h3b"),
        (20, 2, "MTL_TRANSACTION", 202, "h4"), (30, 1, "MTL_TRANSACTION", 300, "h5"), (None, 1, "MTL_TRANSACTION", 300, "h6"), (20, 1, "OTHER", 201, "h7")]),
    "fx_tax_name": ("tax_type_id int, tax_name string", [(1, "CGST"), (2, "SGST"), (3, "IGST")]),
    "fx_item": ("item_id long, organization_id long, item_code string, item_name string", [
        (1, 1, "P1", "one"), (1, 2, "P1", "one"), (2, 1, "P2", None), (2, 2, "P2", "two"), (2, 2, "P2", "two again"), (3, 9, "P3", "three"), (3, None, "P3", "three")]),
    "fx_org": ("organization_id long, gstin string, legal_name string, location_id int, org_id long, line_of_business string, reporting_code string", [
        (1, "g1", "L1", 1, 1, "lob", "reg"), (2, None, "L2", 2, 2, None, None)]),
}


@pytest.fixture()
def hand_made(spark):
    """(tables of the extracts, the same in DuckDB): numbers that several transactions share and transactions of several numbers, repeated rows, missing keys."""
    i, con = Inputs(tune(spark), SMALL), duckdb.connect()
    for name, (columns, values) in HAND_MADE.items():
        casts = [F.col(c.split()[0]).cast(c.split()[1]) for c in re.split(r", (?=\w+ )", columns)]
        names = [c.split()[0] for c in re.split(r", (?=\w+ )", columns)]
        df = spark.createDataFrame([tuple(None if v is None else str(v) for v in r) for r in values], ", ".join(f"{n} string" for n in names)).select(*casts)
        i._frames[name] = df
        kinds = [re.sub("timestamp_ntz", "timestamp", re.sub("string", "varchar", re.sub(r"\blong\b", "bigint", c))) for c in re.split(r", (?=\w+ )", columns)]
        con.execute(f"CREATE TABLE {name} ({', '.join(kinds)})")
        con.executemany(f"INSERT INTO {name} VALUES ({', '.join('?' * len(names))})", [list(r) for r in values])
    return extracts.transfer_tables(i), con


def expected(con, sql, columns):
    out = con.execute(f"SELECT {extracts._money_sql(columns)} FROM ({sql})").fetchall()
    return sorted(repr(r) for r in out)


def found(df, columns):
    return sorted(repr(tuple(r)) for r in extracts._out(df, columns).collect())


def test_hand_made_transfers(hand_made, spark):
    t, con = hand_made
    by_document = staging.transfer_rows(t, written=True)
    by_transaction = cut_buckets(staging.transfer_rows(t), "tax_trx_id")
    out = extracts.TRANSFER_OUT
    for extract, sql in ((staging.extract_transit, extracts.TRANSIT_SQL), (staging.extract_inter, extracts.INTER_SQL)):
        rows = expected(con, sql, out)
        assert len(rows) >= 3
        for df in (extract(t, extracts.MAIL), extract(t, extracts.MAIL, by_document), extract(t, extracts.MAIL, by_transaction, "tax_trx_id"),
                   cut_placed(extract(t, extracts.MAIL)), cut_placed(extract(t, extracts.MAIL, by_transaction, "tax_trx_id"))):
            assert found(df, out) == rows
    rows = expected(con, extracts.CHALLAN_SQL, extracts.CHALLAN_OUT)
    assert len(rows) >= 3
    for df in (staging.extract_challan(t, extracts.MAIL), cut_placed(staging.extract_challan(t, extracts.MAIL, placed=True))):
        assert found(df, extracts.CHALLAN_OUT) == rows
    assert spark.conf.get(PLACED_BY_ALL) == "true"


def test_items_and_lines_are_those_of_their_views(spark):
    """Keys that repeat, are null or lead nowhere."""
    lineitem = spark.sql("""SELECT cast(o AS long) AS l_orderkey, cast(p AS long) AS l_partkey, cast(s AS long) AS l_suppkey, cast(n AS int) AS l_linenumber, cast(q AS double) AS l_quantity,
        cast(e AS double) AS l_extendedprice, cast(t AS double) AS l_tax, timestamp_ntz'2000-01-01' AS l_shipdate FROM VALUES (1, 1, 1, 1, 5, 100.005, 0.05), (1, 1, 1, 2, 5, 100.01, 0.05),
        (2, 2, 2, 1, NULL, 7, 0.1), (2, 2, NULL, 1, 3, NULL, NULL), (NULL, 1, 1, 1, 1, 1, 0.0), (3, NULL, 1, 1, 1, 1, 0.0), (4, 9, 1, 1, 1, 1, 0.0), (5, 60, 3, 1, 1, 1, 0.0), (5, 60, 3, 1, 1, 1, 0.0)
        AS v(o, p, s, n, q, e, t)""")
    part = spark.sql("""SELECT cast(k AS long) AS p_partkey, name AS p_name, b AS p_brand, cast(z AS int) AS p_size, cast(r AS double) AS p_retailprice FROM VALUES (1, 'a', 'Brand#1', 1, 9.99),
        (2, 'b', 'Brand#2', 3, NULL), (2, 'b2', 'Brand#2', NULL, 1.005), (60, 'c', 'Brand#13', 4, 1.0), (60, 'c2', NULL, 4, 1.0), (NULL, 'n', 'Brand#1', 1, 1.0) AS v(k, name, b, z, r)""")
    orders = spark.sql("""SELECT cast(k AS long) AS o_orderkey, cast(1 AS long) AS o_custkey, 'F' AS o_orderstatus, 1D AS o_totalprice, timestamp_ntz'2000-01-01' AS o_orderdate, '1-URGENT' AS o_orderpriority
        FROM VALUES (1), (2), (2), (3), (4), (5), (NULL) AS v(k)""")
    i = Inputs(tune(spark), SMALL)
    i._frames = {"lineitem": lineitem, "part": part, "orders": orders}
    item = spark.sql(views.VIEWS["fx_item"], fx_line=i["fx_line"], fx_hdr=i["fx_hdr"], part=part)
    assert i["fx_item"].dtypes == item.dtypes and rows_of(i["fx_item"]) == rows_of(item) and item.count() == 3
    line = i._read(views.PLACED_TEXT["fx_line"])
    assert line.dtypes == i["fx_line"].dtypes and rows_of(line) == rows_of(i["fx_line"]) and line.count() == 11


def test_numbers_of_rows_that_stay(spark):
    """Headers do not move for their ids; rows of one key, or of none, are told apart."""
    tune(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        some = spark.range(200).select(F.concat(F.lit("D"), F.col("id") * 7 % 200).alias("k"), F.col("id").alias("v"))
        df = cut_buckets(some.repartition("k"), "k")
        placed = number_placed(df, "k", "n", start=1000)
        assert "Exchange" not in plan(placed)
        assert placed.columns == ["k", "v", "n"] and rows_of(placed) == rows_of(number_rows(df, ["k"], "n", start=1000))
        odd = spark.createDataFrame([("b", 1), ("a", 2), (None, 3), ("b", 4), (None, 5), ("c", None)], "k string, v int")
        out = number_placed(cut_buckets(odd.repartition("k"), "k"), "k", "n", start=5).collect()
        assert sorted((r.n, r.k, r.v) for r in out) == [(5, None, 3), (6, None, 5), (7, "a", 2), (8, "b", 1), (9, "b", 4), (10, "c", None)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_print_moves_ids_alone(shuffled):
    i = Inputs(tune(shuffled), SMALL)
    out = reporting.q_print_detail(i)
    # the ids of the selected headers; neither headers nor lines nor taxes nor print rows
    assert sum(k == ["transaction_id"] for k in moved_by(out)) <= 1
    hdr, base = reporting.printable(i), documents.run_headers(i)
    built = i._frames["lines"]
    taxes = lines.build_taxes(documents.stage(i), base, built, documents.DOCUMENT)
    selected = reports.select_documents(hdr, reporting.number_list(i), "Multiple Invoices", i["fx_lookup"], "TRANSFER")
    plain = reports.print_detail(hdr, built, taxes, selected, footer="No sale")
    placed = reports.print_detail(
        hdr, built, lines.build_taxes(documents.stage(i), base, built, documents.DOCUMENT, keep_key=True), selected, footer="No sale", placed=documents.PLACED
    )
    assert placed.columns == plain.columns and placed.count() > 0 and rows_of(placed) == rows_of(plain)
