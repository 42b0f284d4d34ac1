"""Scans with run gates, the five extracts, staging union, audit columns and small targeted updates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.moments import at, midnight
from ledgerloom.functions.text import as_col
from ledgerloom.operators.lookups import attach_attributes, lookup_rows
from ledgerloom.operators.spread import join_where_placed, spread_nulls
from ledgerloom.session import RunContext, cut_buckets, cut_lineage

TRANSFER_ENTITY, ORDER_ENTITY, INVOICE_ENTITY = "MTL_TRANSACTION", "OE_ORDER_HEADERS", "TRANSACTIONS"


def recent_window(
    df: DataFrame,
    ts: str,
    days: int,
    floor: datetime,
    flag: str,
    run_ts: datetime,
    whole_days: bool = True,
) -> DataFrame:
    """Created within the last `days`, not before `floor`, and new or marked for another pass.

    The bounds are literals, so both reach the parquet reader.
    """
    since = run_ts - timedelta(days=days)
    if whole_days:
        since = midnight(since)
    return df.where(
        (F.col(ts) > at(since)) & (F.col(ts) >= at(floor)) & (F.coalesce(F.col(flag), F.lit("Y")) == "Y")
    )


def line_tax_total(taxes: DataFrame, keys: Sequence[str], amount: str = "tax_amount", beside: bool = False) -> DataFrame:
    """Tax of one source line over all its tax rows; grouped once instead of asked per row. `beside`: on each of these rows,
    so that the rows are read once for themselves and for their totals."""
    if beside:
        return taxes.withColumn("line_tax", F.sum(amount).over(Window.partitionBy(*keys)))
    return taxes.groupBy(*keys).agg(F.sum(amount).alias("line_tax"))


def _organisation(
    df: DataFrame, orgs: DataFrame, key: str, prefix: str, columns: Sequence[str], placed: str | None = None,
    written: DataFrame | None = None,
) -> DataFrame:
    return attach_attributes(df, orgs, key, {c: f"{prefix}_{c}" for c in columns}, "organization_id", placed, written)


def _with_amounts(df: DataFrame, base: Column, tax: Column) -> DataFrame:
    return df.withColumns(
        {
            "base_amount": base.cast("decimal(20,4)"),
            "tax_amount": tax.cast("decimal(20,4)"),
            "gross_amount": (base + tax).cast("decimal(20,4)"),
        }
    )


STAGE_COLUMNS = (
    "query_type supplier_gstin supplier_legal_name supplier_location_id recipient_gstin recipient_location_id "
    "recipient_phone_num recipient_email recipient_poc_name ship_to_legal_name ship_to_location_id "
    "dispatch_location_id document_num document_date document_type_code document_id customer_type_code cust_id "
    "preceding_doc_num preceding_doc_date preceding_doc_id shipment_id shipment_num batch_id org_id line_of_business "
    "owning_organization_id transfer_organization_id sez_unit item_code item_name item_id quantity price hsn_code "
    "base_amount tax_amount gross_amount tax_trx_id tax_trx_line_id tax_name tax_rate taxable_amount tax_type_id"
).split()


def _staged(df: DataFrame) -> DataFrame:
    """Common column list; what an extract does not provide is a typed NULL added by the union."""
    return df.select(*[c for c in STAGE_COLUMNS if c in df.columns])


def transfer_rows(t: Mapping[str, DataFrame], written: bool = False, also: Sequence[str] = ()) -> DataFrame:
    """Open transfers x stock moves x tax rows, shared by the two taxed transfer extracts.

    The open transfers name the documents, these the transactions that bear their numbers, and the transactions reduce tax lines,
    moves and determination rows before any of the histories is grouped or joined. Each history moves once, to its
    transaction, where all of them are joined; the open transfers move there, too. `written`: the rows move to the
    document number instead, before they meet the open transfers, and are written to lie by it. What items, organisations and
    orders tell of the rows is left to the extracts. `also`: further columns of the transfers."""
    line, determined = ["trx_id", "trx_line_id", "organization_id"], ["trx_id", "trx_line_id", "det_factor_id"]
    open_transfers = t["transfers"].select(
        F.col("tax_invoice_no").alias("document_num"),
        "item_id",
        F.col("creation_date").alias("document_date"),
        "poc_no",
        "project",
        "mo_header_id",
        *also,
    ).where("document_num IS NOT NULL")
    history = t["tax_lines"].where(F.col("entity_code") == TRANSFER_ENTITY).withColumnRenamed("tax_invoice_num", "document_num")
    numbers = history.select("trx_id", "document_num").where("trx_id IS NOT NULL").distinct()
    documents = open_transfers.select("document_num").distinct()
    numbers = cut_buckets(numbers.join(documents, "document_num", "left_semi").repartition("trx_id"), "trx_id")  # read three times

    def of_open_transactions(rows: DataFrame) -> DataFrame:
        return rows.repartition("trx_id").join(numbers.select("trx_id"), "trx_id", "left_semi")

    taxes = of_open_transactions(
        history.select(*line, "det_factor_id", "document_num", "tax_type_id", "tax_rate", F.col("tax_amount").alias("taxable_amount"))
    )
    # a line's total is that of all its rows, whatever their numbers
    taxes = line_tax_total(taxes, line, "taxable_amount", beside=True).join(numbers, ["trx_id", "document_num"], "left_semi")
    # a move has the determination rows of its batch; its tax lines have the batch's id if it is in one
    factors = of_open_transactions(
        t["tax_factors"].where(F.col("entity_code") == TRANSFER_ENTITY).select(*determined, "hsn_code")
    )
    moves = of_open_transactions(
        t["stock_moves"].withColumns(
            {"trx_id": F.coalesce("transaction_batch_id", "transaction_set_id"), "trx_line_id": F.col("move_line_id")}
        ).where("transaction_batch_id IS NOT NULL").drop("transaction_batch_id", "transaction_set_id", "move_line_id")
    )
    rows = (
        taxes.join(t["tax_types"].select("tax_type_id", "tax_name"), "tax_type_id")
        .join(factors, determined)
        .drop("det_factor_id")
        .join(moves, line)
    )
    if written:
        rows = rows.repartition("document_num").join(open_transfers, ["document_num", "item_id"])
    else:
        open_transfers = numbers.join(open_transfers, "document_num").repartition("trx_id")
        rows = rows.join(open_transfers, ["trx_id", "document_num", "item_id"])
    rows = rows.withColumnsRenamed({"trx_id": "tax_trx_id", "trx_line_id": "tax_trx_line_id"})
    return cut_buckets(rows, "document_num") if written else rows


def _described(rows: DataFrame, t: Mapping[str, DataFrame], placed: str | None, written: DataFrame | None = None) -> DataFrame:
    """Transfer rows with their items, organisations and amounts. `placed`: the column that rows lie by which were `written`."""
    items, item = t["items"].select("item_id", "organization_id", "item_code", "item_name"), ["item_id", "organization_id"]
    written = rows if written is None else written
    rows = rows.join(items, item) if placed is None else join_where_placed(rows, items, item, placed, written)
    rows = _organisation(
        rows, t["organizations"], "owning_organization_id", "own",
        ["gstin", "legal_name", "location_id", "org_id", "line_of_business"], placed, written,
    )
    rows = _organisation(
        rows, t["organizations"], "transfer_organization_id", "dest", ["gstin", "location_id", "reporting_code"], placed, written
    )
    rows = _with_amounts(rows, F.coalesce("actual_cost", F.lit(0)) * F.abs("move_quantity"), F.col("line_tax"))
    return rows.withColumns(
        {
            "supplier_gstin": F.col("own_gstin"),
            "supplier_legal_name": F.col("own_legal_name"),
            "supplier_location_id": F.col("own_location_id"),
            "dispatch_location_id": F.col("own_location_id"),
            "org_id": F.col("own_org_id"),
            "line_of_business": F.col("own_line_of_business"),
            "recipient_gstin": F.col("dest_gstin"),
            "recipient_location_id": F.col("dest_location_id"),
            "customer_type_code": F.upper("dest_reporting_code"),
            "price": F.col("actual_cost"),
            "quantity": F.abs("move_quantity"),
            "document_type_code": F.lit("Regular"),
            "sez_unit": F.lit("false"),
        }
    )


def extract_transit(
    t: Mapping[str, DataFrame], recipient_email: str, rows: DataFrame | None = None, placed: str = "document_num"
) -> DataFrame:
    """Physical transfers: no project and no move order behind them. `rows`: the shared transfer rows, written to lie by `placed`."""
    own = F.col("project").isNull() & F.col("mo_header_id").isNull()
    if rows is None:
        rows = _described(transfer_rows(dict(t) | {"transfers": t["transfers"].where(own)}), t, None)
    else:
        rows = _described(rows.where(own), t, placed)
    return _staged(
        rows.withColumns(
            {
                "query_type": F.lit("Intransit"),
                "recipient_phone_num": F.col("poc_no"),
                "recipient_email": F.lit(recipient_email),
                "recipient_poc_name": F.col("poc_name"),
                "ship_to_location_id": F.col("recipient_location_id"),
            }
        )
    )


def extract_inter(
    t: Mapping[str, DataFrame], recipient_email: str, rows: DataFrame | None = None, placed: str = "document_num"
) -> DataFrame:
    """Transfers ordered through a move order, distinct; contact and ship-to come from its header. `rows`: the
    shared transfer rows, written to lie by `placed`."""
    orders = t["move_orders"].select(
        F.col("header_id").alias("mo_header_id"),
        F.col("phone").alias("recipient_phone_num"),
        F.col("poc_name").alias("recipient_poc_name"),
        F.col("location_id").alias("ship_to_location_id"),
        F.col("shipment_id").alias("order_shipment_id"),
    )
    if rows is None:
        # the orders meet the open transfers, before these are joined with anything else
        ordered = dict(t) | {"transfers": t["transfers"].join(orders, "mo_header_id")}
        rows = _described(transfer_rows(ordered, also=orders.columns[1:]).drop("poc_name"), t, None)
    else:
        # only the keys of the rows and the ids of their orders move
        written = rows.where("mo_header_id IS NOT NULL")
        rows = _described(join_where_placed(written.drop("poc_name"), orders, ["mo_header_id"], placed, written), t, placed, written)
    return _staged(
        rows.withColumns(
            {
                "query_type": F.lit("DTP Inter-state"),
                "recipient_email": F.lit(recipient_email),
                "shipment_id": F.col("order_shipment_id"),
            }
        )
    ).distinct()


def extract_challan(t: Mapping[str, DataFrame], recipient_email: str, placed: bool = False) -> DataFrame:
    """Delivery challans: a challan number, no invoice number, no destination warehouse; untaxed. `placed`: the rows lie by
    the challan number, and only the keys of orders and items move; the transfers, a written table, are read three times."""
    source = t["transfers"].where(
        F.col("tax_invoice_no").isNull() & F.col("del_challan_num").isNotNull() & F.col("to_warehouse_id").isNull()
    )
    orders = t["move_orders"].select(
        F.col("header_id").alias("mo_header_id"),
        F.col("phone").alias("recipient_phone_num"),
        F.col("poc_name").alias("recipient_poc_name"),
        F.col("location_id").alias("recipient_location_id"),
        "shipment_id",
        F.col("organization_id").alias("owning_organization_id"),
    )
    source = source.withColumnsRenamed({"from_warehouse_id": "organization_id", "del_challan_num": "document_num"})
    items, item = t["items"].select("item_id", "organization_id", "item_code", "item_name"), ["item_id", "organization_id"]
    if placed:
        rows = join_where_placed(source.repartition("document_num"), orders, ["mo_header_id"], "document_num", source)
        rows = join_where_placed(rows, items, item, "document_num", source)
    else:
        rows = source.join(orders, "mo_header_id").join(items, item)
    rows = _organisation(
        rows, t["organizations"], "organization_id", "own",
        ["gstin", "legal_name", "location_id", "org_id", "line_of_business"], "document_num" if placed else None, source,
    )
    rows = _with_amounts(rows, F.coalesce("material_cost", F.lit(0)) * F.abs("quantity"), F.lit(0))
    return _staged(
        rows.withColumns(
            {
                "query_type": F.lit("DTP Intra-state"),
                "supplier_gstin": F.col("own_gstin"),
                "supplier_legal_name": F.col("own_legal_name"),
                "supplier_location_id": F.col("own_location_id"),
                "dispatch_location_id": F.col("own_location_id"),
                "org_id": F.col("own_org_id"),
                "line_of_business": F.col("own_line_of_business"),
                "ship_to_location_id": F.col("recipient_location_id"),
                "recipient_email": F.lit(recipient_email),
                "document_date": F.col("creation_date"),
                "document_type_code": F.lit("Regular"),
                "price": F.col("material_cost"),
                "quantity": F.abs("quantity"),
                "sez_unit": F.lit("false"),
            }
        )
    ).distinct()


def invoice_rows(t: Mapping[str, DataFrame], ship_to_name: str) -> DataFrame:
    """Complete invoices of an enabled document type with customer, ship-to and location attributes."""
    enabled = lookup_rows(t["lookup"], "DOCUMENT_TYPES", "Document Type Code").select(
        F.col("lookup_code").alias("document_type_code")
    )
    invoices = (
        t["invoices"]
        .where(F.col("complete_flag") == "Y")
        .join(t["trx_types"].select("trx_type_id", "org_id", F.col("type").alias("document_type_code")), ["trx_type_id", "org_id"])
        .join(enabled, "document_type_code", "left_semi")
        .join(
            t["customers"].select(
                F.col("cust_id"),
                F.col("gstin").alias("recipient_gstin"),
                F.col("cust_name").alias("recipient_poc_name"),
                F.col("phone").alias("recipient_phone_num"),
                F.col("email").alias("recipient_email"),
                F.upper("customer_type").alias("customer_type_code"),
                F.col("location_id").alias("recipient_location_id"),
            ),
            "cust_id",
        )
    )
    ship_to = t["customers"].select(
        F.col("cust_id").cast("string").alias("_ship_to"),
        F.col("cust_name").alias("_ship_name"),
        F.col("location_id").alias("_ship_location"),
    )
    # most invoices have no ship-to customer of their own
    keyed = spread_nulls(invoices.withColumn("_ship_to", F.col("ship_to_cust_id").cast("string")), "_ship_to", "_ship_to")
    invoices = keyed.join(ship_to, "_ship_to", "left").drop("_ship_to")
    name = F.col("_ship_name")
    if ship_to_name == "as_is":  # the source query shows the bill-to name whenever a ship-to customer exists
        name = F.when(name.isNotNull(), F.col("recipient_poc_name"))
    return invoices.withColumns(
        {
            "ship_to_legal_name": name,
            "ship_to_location_id": F.coalesce("_ship_location", "recipient_location_id"),
            "sez_unit": F.lit("false"),
        }
    ).drop("_ship_name", "_ship_location")


def _tax_rows(t: Mapping[str, DataFrame], entity: str, wanted: DataFrame) -> DataFrame:
    """Every tax row of a line with its type, beside every determination row of the same line, for the lines
    in `wanted` (trx_id, trx_line_id).

    Both sides hang on the line key only (the source joins them to the line, not to each other). Both histories
    are read once: their rows of the wanted lines are few and written, for themselves and for totals and earlier invoices.
    """
    keys = ["trx_id", "trx_line_id"]
    taxes = cut_lineage(t["tax_lines"].where(F.col("entity_code") == entity).join(wanted, keys, "left_semi"))
    rows = taxes.join(t["tax_types"].select("tax_type_id", "tax_name"), "tax_type_id").join(
        line_tax_total(taxes, keys), keys
    )
    factors = cut_lineage(t["tax_factors"].where(F.col("entity_code") == entity).join(wanted, keys, "left_semi"))
    referenced = factors.select(F.col("original_invoice_num").alias("document_num")).where("document_num IS NOT NULL").distinct()
    prior = t["all_invoices"].join(referenced, "document_num", "left_semi").groupBy("document_num").agg(F.min("document_id").alias("preceding_doc_id"))
    factors = spread_nulls(factors, "original_invoice_num", "_original").join(
        prior.withColumnRenamed("document_num", "_original"), "_original", "left"
    )
    return rows.select(*keys, "tax_type_id", "tax_name", "tax_rate", F.abs("tax_amount").alias("taxable_amount"), "line_tax").join(
        factors.select(
            *keys,
            F.col("organization_id").alias("factor_organization_id"),
            F.col("org_id").alias("factor_org_id"),
            F.coalesce("hsn_code", "sac_code").alias("hsn_code"),
            F.col("original_invoice_num").alias("preceding_doc_num"),
            F.col("original_invoice_date").alias("preceding_doc_date"),
            "preceding_doc_id",
        ),
        keys,
    )


def extract_order_invoices(t: Mapping[str, DataFrame], ship_to_name: str = "real", invoices: DataFrame | None = None) -> DataFrame:
    """Invoices raised from sales orders: amounts, item and taxes are those of the order line. `invoices`: the
    shared invoice rows."""
    invoices = (invoice_rows(t, ship_to_name) if invoices is None else invoices).where(F.col("context") == "ORDER ENTRY")
    lines = t["invoice_lines"].where(F.col("line_context") == "ORDER ENTRY")
    rows = (
        invoices.join(lines.select("document_id", "order_number", "order_line_id"), "document_id")
        .join(t["orders"], "order_number")
        .join(t["order_lines"], ["order_id", "order_line_id"])
        .join(
            t["items"].select("item_id", F.col("organization_id").alias("line_org_id"), "item_code", "item_name"),
            ["item_id", "line_org_id"],
        )
    )
    rows = cut_lineage(rows)  # the gated lines, read for their keys and for themselves
    wanted = rows.select(F.col("order_id").alias("trx_id"), F.col("order_line_id").alias("trx_line_id"))
    taxes = _tax_rows(t, ORDER_ENTITY, wanted).withColumnsRenamed({"trx_id": "order_id", "trx_line_id": "order_line_id"})
    rows = rows.join(taxes, ["order_id", "order_line_id"])
    rows = _organisation(rows, t["organizations"], "ship_from_org_id", "own", ["gstin", "legal_name", "location_id", "line_of_business"])
    net = F.col("unit_price") * F.col("ordered_quantity")
    rows = _with_amounts(rows, F.abs(net), F.abs("line_tax")).withColumn(
        "gross_amount", F.abs(F.col("line_tax") + net).cast("decimal(20,4)")
    )
    return _staged(
        rows.withColumns(
            {
                "query_type": F.col("context"),
                "supplier_gstin": F.col("own_gstin"),
                "supplier_legal_name": F.col("own_legal_name"),
                "supplier_location_id": F.col("own_location_id"),
                "dispatch_location_id": F.col("own_location_id"),
                "line_of_business": F.col("own_line_of_business"),
                "owning_organization_id": F.col("ship_from_org_id"),
                "price": F.abs("unit_price"),
                "quantity": F.col("ordered_quantity"),
                "tax_trx_id": F.col("order_id"),
                "tax_trx_line_id": F.col("order_line_id"),
            }
        )
    )


def extract_direct_invoices(t: Mapping[str, DataFrame], ship_to_name: str = "real", invoices: DataFrame | None = None) -> DataFrame:
    """Invoices entered by hand: quantity invoiced or credited, item optional. `invoices`: the shared invoice rows."""
    lines = t["invoice_lines"].where(
        (F.coalesce("line_context", F.lit("XXXXXX")) != "ORDER ENTRY") & (F.col("line_type") == "LINE")
    )
    items = t["items"].select("item_id", F.col("organization_id").alias("warehouse_id"), "item_code", F.col("item_name").alias("_item"))
    rows = (
        (invoice_rows(t, ship_to_name) if invoices is None else invoices)
        .join(lines.drop("order_number", "order_line_id"), "document_id")
        .join(items, ["item_id", "warehouse_id"], "left")
    )
    rows = cut_lineage(rows)  # the gated lines, read for their keys and for themselves
    wanted = rows.select(F.col("document_id").alias("trx_id"), F.col("invoice_line_id").alias("trx_line_id"))
    taxes = _tax_rows(t, INVOICE_ENTITY, wanted).withColumnsRenamed({"trx_id": "document_id", "trx_line_id": "invoice_line_id"})
    rows = rows.join(taxes, ["document_id", "invoice_line_id"]).where(F.col("factor_org_id") == F.col("org_id"))
    rows = _organisation(rows, t["organizations"], "factor_organization_id", "own", ["gstin", "location_id", "line_of_business"])
    rows = attach_attributes(rows, t["legal_entities"], "legal_entity_id", {"legal_name": "supplier_legal_name"}, "legal_entity_id")
    quantity = F.coalesce("quantity_invoiced", "quantity_credited")
    net = quantity * F.col("unit_price")
    rows = _with_amounts(rows, F.abs(net), F.abs("line_tax")).withColumn(
        "gross_amount", F.abs(net + F.col("line_tax")).cast("decimal(20,4)")
    )
    return _staged(
        rows.withColumns(
            {
                "query_type": F.lit("AR INVOICE"),
                "supplier_gstin": F.col("own_gstin"),
                "supplier_location_id": F.col("own_location_id"),
                "dispatch_location_id": F.col("own_location_id"),
                "line_of_business": F.col("own_line_of_business"),
                "owning_organization_id": F.col("factor_organization_id"),
                "item_name": F.coalesce("_item", "description"),
                "price": F.abs("unit_price"),
                "quantity": quantity,
                "tax_trx_id": F.col("document_id"),
                "tax_trx_line_id": F.col("invoice_line_id"),
            }
        )
    )


def stage_union(*extracts: DataFrame) -> DataFrame:
    """All extracts under one column list, by name; an empty extract adds nothing."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), extracts)


def with_audit(df: DataFrame, run: RunContext) -> DataFrame:
    """Who, when and under which request; time is the run's, not the row's."""
    return df.withColumns(
        {
            "created_at": at(run.run_ts),
            "created_by": F.lit(run.user),
            "updated_at": at(run.run_ts),
            "updated_by": F.lit(run.user),
            "session_id": F.lit(run.session_id),
            "request_id": F.lit(run.request_id),
        }
    )


def overlay_rows(dim: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Insert or replace rows of a code table by key."""
    return dim.join(rows.select(*keys).distinct(), list(keys), "left_anti").unionByName(
        rows.select(*dim.columns)
    )


def update_where(df: DataFrame, condition: Column, sets: Mapping[str, object]) -> DataFrame:
    """New state after an update; unknown conditions leave the row alone."""
    return df.withColumns({c: F.when(condition, as_col(v)).otherwise(F.col(c)) for c, v in sets.items()})
