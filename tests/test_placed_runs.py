"""Complete runs: the source views are built and the rows of a document are worked on where they lie."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.catalog import documents, extracts, whole_runs
from ledgerloom.operators import lines, reconcile, staging
from ledgerloom.operators.lookups import attach_attributes
from ledgerloom.plans import runs
from ledgerloom.plans.inputs import Inputs
from ledgerloom.session import PLACED_BY_ALL, cut_buckets, tune
from tests.conftest import SMALL


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


def test_source_views_are_joined_where_their_documents_lie(shuffled):
    plain = Inputs(tune(shuffled), SMALL)
    own = plain.placed(whole_runs.PLACED_VIEWS["receivable"])
    assert plain._frames == {}
    for name in ("fx_invoice_line", "fx_order_line"):
        assert "Exchange" not in plan(own[name])
        assert rows_of(own[name]) == rows_of(plain[name])
    for name in ("fx_tax_line", "fx_item"):
        assert rows_of(own[name]) == rows_of(plain[name])
    assert "Scan parquet" in plan(own["fx_tax_factor"]) and "Join" not in plan(own["fx_tax_factor"])
    own = plain.placed(whole_runs.PLACED_VIEWS["transfer"])
    for name in ("fx_transfer", "fx_move"):
        assert "Exchange" not in plan(own[name])
        assert rows_of(own[name]) == rows_of(plain[name])
    assert rows_of(own["fx_tax_line"]) == rows_of(plain["fx_tax_line"])


def test_attributes_of_placed_rows(shuffled):
    spark = tune(shuffled)
    df = cut_buckets(spark.createDataFrame(
        [("A", 1, "x"), ("A", 2, "x"), ("A", 1, "x"), ("B", None, "y"), ("C", 9, "z"), ("C", 3, "w")], "n string, k int, v string"
    ).repartition("n"), "n")
    dim = spark.createDataFrame([(1, "one"), (2, None), (3, "three"), (3, "again"), (None, "none")], "id int, name string")
    plain = attach_attributes(df, dim, "k", {"name": "name"}, "id")
    placed = attach_attributes(df, dim, "k", {"name": "name"}, "id", "n")
    assert placed.columns == plain.columns and rows_of(placed) == rows_of(plain)


def test_written_transfer_rows_give_the_same_extracts(spark):
    t = extracts.transfer_tables(Inputs(tune(spark), SMALL))
    rows = staging.transfer_rows(t, written=True)
    for extract in (staging.extract_transit, staging.extract_inter):
        assert rows_of(extract(t, "x", rows)) == rows_of(extract(t, "x"))
    assert spark.conf.get(PLACED_BY_ALL) == "true"


def test_lines_and_taxes_with_their_key(spark):
    i = Inputs(tune(spark), SMALL)
    stage = cut_buckets(documents.stage(i).repartition("document_num"), "document_num")
    hdr = lines.without_duplicates(documents.all_headers(stage))
    plain = lines.build_lines(stage, hdr)
    keyed = lines.build_lines(stage, hdr, keep_key=True)
    assert rows_of(keyed.drop("document_num")) == rows_of(plain)
    taxes, keyed_taxes = lines.build_taxes(stage, hdr, plain), lines.build_taxes(stage, hdr, keyed, keep_key=True)
    assert rows_of(keyed_taxes.drop("document_num")) == rows_of(taxes)
    checks = reconcile.document_checks(keyed, keyed_taxes, runs.DOCUMENT)
    assert rows_of(checks.drop("document_num")) == rows_of(reconcile.document_checks(plain, taxes))


def test_lines_of_a_run_are_not_repeated_by_customers(spark):
    """A customer that is listed twice gives a header twice, as it always did, but its lines once."""
    i = Inputs(tune(spark), SMALL)
    tables = whole_runs._tables(i, extracts.receivable_tables(i))
    tables["customers"] = tables["customers"].unionByName(tables["customers"])
    done = runs.run_extract(
        tables, "receivable", whole_runs.RUN, 1000, extracts.DAYS, extracts.FLOOR, on_violation="exclude", note_codes=("O",)
    )
    lines_ = done.lines.select("transaction_id", "line_number")
    assert 0 < lines_.count() == lines_.distinct().count()
    assert done.headers.count() == 2 * done.headers.select("transaction_id").distinct().count()


def test_documents_of_a_run_do_not_move(shuffled, monkeypatch):
    """Lines, taxes and facts are written from the staging rows where these lie: only keys and references are exchanged."""
    seen = []
    monkeypatch.setattr(runs, "cut_buckets", lambda df, *keys: seen.append((keys, df.columns)) or cut_buckets(df, *keys))
    done = whole_runs._transfer_run(Inputs(tune(shuffled), SMALL))
    assert len(seen) == 6 and all(keys == ("document_num",) for keys, _ in seen)  # staging rows, headers, lines, taxes, numbered headers, facts
    assert "document_num" not in done.lines.columns and "document_num" not in done.taxes.columns
    number = done.headers.select("transaction_id", F.col("line_count").cast("long").alias("lines"))
    assert rows_of(done.lines.groupBy("transaction_id").agg(F.count("*").alias("lines"))) == rows_of(number)
