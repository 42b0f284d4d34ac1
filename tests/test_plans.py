"""Plans of the extracts over stored source tables: how often a table is scanned, what reaches the scan."""

import re

import pytest

from ledgerloom.catalog import extracts
from ledgerloom.catalog.registry import RUN_TS
from ledgerloom.operators import staging
from ledgerloom.plans.inputs import Inputs
from ledgerloom.session import tune
from tests.conftest import SMALL

VIEWS = (
    "fx_hdr fx_line fx_transfer fx_move fx_move_order fx_tax_line fx_tax_factor fx_tax_name fx_item fx_org fx_invoice fx_invoice_line "
    "fx_order fx_order_line fx_trx_type fx_cust fx_le fx_lookup"
).split()


@pytest.fixture(scope="module")
def stored(spark):
    inputs = Inputs(tune(spark), SMALL)
    inputs.stored(*VIEWS)
    return inputs


def scans(df, table):
    """Scans of a table in the optimised plan, told by its columns."""
    columns = ",".join(rf"{c}#\d+L?" for c in table.columns[:6])
    return len(re.findall(rf"Relation \[{columns}", df._jdf.queryExecution().optimizedPlan().toString()))


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_transfer_extracts_scan_what_they_need(stored):
    tables = extracts.transfer_tables(stored)
    for extract in (staging.extract_transit, staging.extract_inter):
        df = extract(tables, "x")
        plan = physical(df)
        # open rows of the tax lines were written beforehand; the history is read once more, for the totals
        assert scans(df, stored["fx_tax_line"]) == 1 and scans(df, stored["fx_move"]) == 1 and scans(df, stored["fx_tax_factor"]) == 1
        assert plan.count("FileScan") <= 16 and "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_receivable_extracts_scan_what_they_need(stored):
    tables = extracts.receivable_tables(stored)
    tables["invoices"] = tables["open_invoices"]
    tables["all_invoices"] = stored["fx_invoice"]
    for extract in (staging.extract_order_invoices, staging.extract_direct_invoices):
        df = extract(tables)
        plan = physical(df)
        # the tax and determination rows of the open lines were written beforehand, each from one scan
        for table in ("fx_tax_line", "fx_tax_factor"):
            assert not set(df.inputFiles()) & set(stored[table].inputFiles())
        assert plan.count("FileScan") <= 16 and "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_window_reaches_the_scan(stored):
    plan = physical(staging.recent_window(stored["fx_transfer"], "creation_date", 90, extracts.FLOOR, "reprocess_flag", RUN_TS))
    assert re.search(r"PushedFilters: \[.*GreaterThan\(creation_date", plan)


def test_rule_fold_is_one_select(stored):
    from ledgerloom.operators import categorize
    from ledgerloom.operators.rules import apply_rules

    flags = [f"CAST(NULL AS boolean) AS {c}" for c in (*categorize.TYPE_FLAGS, *categorize.ENTITY_FLAGS, "is_known_type", "any_zero_tax")]
    text = [f"'x' AS {c}" for c in (*categorize.UNREGISTERED_RECIPIENT, "supplier_gstin", "status_code", "status_message", "supply_type_code",
                                   "eligible_flag", "customer_type_code", "recipient_country_code", "sez_unit")]
    df = stored.spark.range(1).selectExpr("id", "cast(0 AS decimal(20,4)) AS total_tax_amount", *flags, *text)
    out = apply_rules(df, categorize.category_rules())
    assert out.columns == df.columns
    # the expressions do not grow with the square of the rules: no state is written out twice
    assert len(out._jdf.queryExecution().optimizedPlan().toString()) < 20_000
