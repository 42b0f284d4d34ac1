"""Recipient lists packed into a few address fields."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.text import blank_to_null
from ledgerloom.operators.spread import first_rows

# Process of an announced status and document type
PROCESS_NAMES = {
    ("PENDING", "PO"): "PO_EXTRACTION",
    ("PENDING", "REQUISITION"): "PR_EXTRACTION",
    ("SUCCESS", "PO"): "PO_ACTION",
    ("SUCCESS", "REQUISITION"): "PR_ACTION",
}


def closure_recipients(
    df: DataFrame, status: str, types: Sequence[str] = ("PO", "REQUISITION"), request_id: int | None = None
) -> DataFrame:
    rows = df.where(
        (F.col("eligible_flag") == "Y") & (F.col("status_code") == status) & F.col("document_type_code").isin(*types)
    )
    if request_id is not None:
        rows = rows.where(F.col("request_id") == request_id)
    return rows.select("status_code", "document_type_code", "requestor_email")


def _place(state: Column, address: Column, max_length: int) -> Column:
    """Append to the first batch still shorter than the limit; the overshoot stays in that batch."""
    open_at = F.array_position(F.transform(state["batches"], lambda b: F.length(b) < max_length), F.lit(True))
    batches = F.transform(
        state["batches"],
        lambda b, i: F.when(i + 1 == open_at, F.concat(b, F.lit(" "), address)).otherwise(b),
    )
    return F.struct(
        batches.alias("batches"), (state["placed"] + F.when(open_at > 0, 1).otherwise(0)).cast("int").alias("placed")
    )


def _filled(df: DataFrame, group: Sequence[str], address: str, max_length: int, max_batches: int) -> tuple[DataFrame, DataFrame]:
    """(distinct addresses, per group the state of its batches and the list the placed ones lead).

    Placing is sequential, but a batch takes at most ceil(max_length / 2) addresses (each adds a blank and
    at least one character), so only that many times `max_batches` addresses of a group can be placed at all.
    They are selected in parallel; the fold then runs over an array of bounded length.
    """
    addresses = df.select(*group, blank_to_null(F.col(address)).alias("_address")).where(
        F.col("_address").isNotNull()
    ).distinct()
    k = max_batches * -(-max_length // 2)
    lists = first_rows(addresses, group, ["_address"], k).groupBy(*group).agg(
        F.array_sort(F.collect_list("_address")).alias("_list")
    )
    start = F.struct(F.array_repeat(F.lit(""), max_batches).alias("batches"), F.lit(0).alias("placed"))
    return addresses, lists.withColumn("_state", F.aggregate("_list", start, lambda s, a: _place(s, a, max_length)))


def pack_recipients(
    df: DataFrame, group: Sequence[str], address: str, max_length: int = 2500, max_batches: int = 5
) -> DataFrame:
    """Distinct addresses of a group in order, filled into batches one after the other; those that no batch
    can take any more are counted in `dropped_count` and returned by `overflow`."""
    group = list(group)
    addresses, folded = _filled(df, group, address, max_length, max_batches)
    totals = addresses.groupBy(*group).agg(F.count("*").alias("address_count"))
    return (
        folded.join(totals, group)
        .select(
            *group,
            "address_count",
            (F.col("address_count") - F.col("_state.placed")).alias("dropped_count"),
            F.posexplode("_state.batches").alias("_position", "_batch"),
        )
        .where(F.col("_batch") != "")
        .select(
            *group,
            (F.col("_position") + 1).alias("batch_no"),
            F.trim("_batch").alias("recipients"),
            "address_count",
            "dropped_count",
        )
    )


def overflow(
    df: DataFrame, group: Sequence[str], address: str, max_length: int = 2500, max_batches: int = 5
) -> DataFrame:
    """The addresses that no batch can take. Batches fill in the order of the addresses, so these are the ones
    after the last that was placed."""
    group = list(group)
    addresses, folded = _filled(df, group, address, max_length, max_batches)
    last = folded.select(*group, F.element_at("_list", F.col("_state.placed")).alias("_last"))
    return addresses.join(last, group).where(F.col("_address") > F.col("_last")).select(*group, F.col("_address").alias(address))


def notification_batches(packed: DataFrame) -> DataFrame:
    """One row per message to send: the mail process of the status and type, and its address list."""
    name = F.lit(None).cast("string")
    for (status, kind), process in PROCESS_NAMES.items():
        name = F.when((F.col("status_code") == status) & (F.col("document_type_code") == kind), process).otherwise(name)
    return packed.withColumn("process_name", name).select("process_name", "batch_no", "recipients", "dropped_count")
