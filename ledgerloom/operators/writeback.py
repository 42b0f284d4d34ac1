"""Results back to source rows and queues. Tables are immutable files: an operator returns the new state of the rows it
is given. Which rows change is found by an inner join beforehand (`changed_rows`, `answered_rows`, `sent_rows`), so a
stored table (`sources.stored`) hands over and rewrites only the partitions that hold such rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ledgerloom.functions.moments import at
from ledgerloom.functions.text import cat, strip_breaks
from ledgerloom.operators.lookups import translate
from ledgerloom.operators.reconcile import require_empty
from ledgerloom.operators.rules import Rule, apply_rules
from ledgerloom.operators.spread import spread_nulls


def write_back(source: DataFrame, result: DataFrame, on: Mapping[str, Column], sets: Mapping[str, Column]) -> DataFrame:
    """Set columns of the source rows that have a result row. Source rows without a key do not meet in one task.

    `on` maps result column -> expression over the source, `sets` maps source column -> expression over the
    result. The result is unique on its key (a repeated document stops the run before this point).
    """
    side = _result_side(result, on, sets).withColumn("_matched", F.lit(True))
    # a text key is compared once more in a form whose NULLs are spread
    first, expression = next(iter(on.items()))
    columns = source.columns
    condition = _same_key(on)
    if isinstance(result.schema[first].dataType, StringType):
        source = spread_nulls(source.withColumn("_first", expression), "_first", "_spread")
        condition = (F.col("_spread") == F.col(f"_k_{first}")) & condition
    joined = source.join(side, condition, "left")
    return joined.withColumns(
        {c: F.when(F.col("_matched"), F.col(f"_v_{c}")).otherwise(F.col(c)) for c in sets}
    ).select(*columns)


def _result_side(result: DataFrame, on: Mapping[str, Column], sets: Mapping[str, Column]) -> DataFrame:
    return result.select(*[F.col(k).alias(f"_k_{k}") for k in on], *[e.alias(f"_v_{c}") for c, e in sets.items()])


def _same_key(on: Mapping[str, Column]) -> Column:
    return reduce(lambda a, b: a & b, [expression == F.col(f"_k_{k}") for k, expression in on.items()])


def changed_rows(source: DataFrame, result: DataFrame, on: Mapping[str, Column], sets: Mapping[str, Column]) -> DataFrame:
    """New state of the source rows that have a result row, and of no others (arguments as for `write_back`). Rows without
    a key drop out before the join, so nothing of the history is shuffled for them."""
    keyed = source.where(reduce(lambda a, b: a & b, [expression.isNotNull() for expression in on.values()]))
    joined = keyed.join(_result_side(result, on, sets), _same_key(on))
    return joined.withColumns({c: F.col(f"_v_{c}") for c in sets}).select(*source.columns)


def touched_partitions(changes: DataFrame, partition: str) -> DataFrame:
    """Partitions that hold changed rows, and how many."""
    return changes.groupBy(partition).agg(F.count("*").alias("changed_rows"))


def source_message(headers: DataFrame, lookup: DataFrame, partial: bool, into: str = "source_message") -> DataFrame:
    """Message shown at the source document, by eligibility, type, status and (receivables) partly enabled
    entities; an ERROR overrides all. Needs the entity flags when `partial`."""
    not_eligible = F.col("eligible_flag") == "N"
    consumer = F.col("supply_type_code") == "B2C"
    closed = F.col("status_code") == "SUCCESS-INELIGIBLE"
    code = F.when(F.col("status_code") == "ERROR", "EXTRACTION_ERROR").when(F.col("eligible_flag") == "Y", "PENDING")
    code = code.when(not_eligible & consumer & (F.col("status_code") == "PENDING"), "B2C_PENDING")
    if partial:
        other = ~F.col("supply_type_code").isin("B2C", "NA")
        code = code.when(not_eligible & other & closed & F.col("le_b2b_partial"), "PARTIAL")
        code = code.when(not_eligible & consumer & closed & F.col("le_b2c_partial"), "PARTIAL")
    df = headers.withColumn("_message_code", code.otherwise("NOT_ELIGIBLE"))
    return translate(df, "_message_code", lookup, "MESSAGES", into).drop("_message_code")


def closure_transition(df: DataFrame, outcome: DataFrame) -> DataFrame:
    """State of the closure log after notifications went out.

    `outcome`: request_id, document_type_code, status_code (what was announced), sent. Announced PENDING and
    sent: the documents of that request and type run; announced SUCCESS and sent: flagged sent; announced
    SUCCESS and failed: every row of the request is flagged not sent, whatever was sent before. An announced
    PENDING that failed stops the run.
    """
    require_empty(outcome.where(~F.col("sent") & (F.col("status_code") == "PENDING")), "notifications not sent")
    by_type = outcome.groupBy("request_id", "document_type_code").agg(
        F.bool_or(F.col("sent") & (F.col("status_code") == "PENDING")).alias("_running"),
        F.bool_or(F.col("sent") & (F.col("status_code") == "SUCCESS")).alias("_sent"),
    )
    by_request = outcome.groupBy("request_id").agg(
        F.bool_or(~F.col("sent") & (F.col("status_code") == "SUCCESS")).alias("_failed")
    )
    joined = df.join(by_type, ["request_id", "document_type_code"], "left").join(by_request, "request_id", "left")
    state = apply_rules(
        joined,
        [
            Rule(
                "sent", F.col("_sent") & (F.col("status_code") == "SUCCESS"),
                {"mail_sent_flag": "Y", "status_message": "Mail successfully sent"},
            ),
            Rule("failed", F.col("_failed"), {"mail_sent_flag": "N", "status_message": "Mail not sent"}),
            Rule("running", F.col("_running"), {"status_code": "RUNNING", "status_message": "Updating the status"}),
        ],
    )
    return state.select(*df.columns)


def sent_rows(df: DataFrame, sent: DataFrame, key: str = "transaction_id") -> DataFrame:
    """Rows that `mark_sent` changes."""
    ids = sent.select(F.col(key).alias("_id")).distinct()
    return df.where(F.coalesce(F.col("mail_sent") != "Y", F.lit(True))).join(ids, F.col(key) == F.col("_id"), "left_semi")


def mark_sent(df: DataFrame, sent: DataFrame, key: str = "transaction_id") -> DataFrame:
    """Reported rows are not reported again."""
    ids = sent.select(F.col(key).alias("_id")).distinct().withColumn("_sent", F.lit(True))
    joined = df.join(ids, F.col(key) == F.col("_id"), "left")
    return joined.withColumn(
        "mail_sent", F.when(F.col("_sent"), "Y").otherwise(F.col("mail_sent"))
    ).select(*df.columns)


def merge_outcome(
    queue: DataFrame,
    outcome: DataFrame,
    keys: Sequence[str],
    ids: Sequence[str],
    waiting: Column,
    success_flag: str | None = "S",
) -> DataFrame:
    """Answers of the external service onto the waiting rows: ids and the success flag, or E and the error.
    `success_flag=None` leaves the flag of a success as it is."""
    side = outcome.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        *[F.col(i).alias(f"_v_{i}") for i in ids],
        F.col("error_msg").alias("_error"),
        F.lit(True).alias("_answered"),
    )
    condition = None
    for k in keys:
        part = F.col(k) == F.col(f"_k_{k}")
        condition = part if condition is None else condition & part
    joined = queue.join(side, condition, "left")
    hit = F.coalesce(F.col("_answered") & waiting, F.lit(False))
    failed = F.col("_error").isNotNull()
    success = F.lit(success_flag) if success_flag is not None else F.col("process_flag")
    changed = {i: F.when(hit & ~failed, F.col(f"_v_{i}")).otherwise(F.col(i)) for i in ids}
    changed["process_flag"] = F.when(hit & failed, "E").when(hit, success).otherwise(F.col("process_flag"))
    changed["error_msg"] = F.when(hit, F.col("_error")).otherwise(F.col("error_msg"))
    return joined.withColumns(changed).select(*queue.columns)


def answered_rows(queue: DataFrame, outcome: DataFrame, keys: Sequence[str], waiting: Column) -> DataFrame:
    """Waiting rows that have an answer: those that `merge_outcome` changes."""
    side = outcome.select(*[F.col(k).alias(f"_k_{k}") for k in keys])
    on = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_k_{k}") for k in keys])
    return queue.where(waiting).join(side, on, "left_semi")


def reset_failed(queue: DataFrame, request_id: int) -> DataFrame:
    """Failed rows go back to the start under the new request."""
    failed = F.col("process_flag") == "E"
    return queue.withColumns(
        {
            "process_flag": F.when(failed, "N").otherwise(F.col("process_flag")),
            "request_id": F.when(failed, F.lit(request_id)).otherwise(F.col("request_id")),
            "error_msg": F.when(failed, F.lit(None)).otherwise(F.col("error_msg")),
        }
    )


def number_text(amount: Column) -> Column:
    """Decimal as text without trailing zeros."""
    text = amount.cast("string")
    return F.when(text.contains("."), F.regexp_replace(text, r"\.?0+$", "")).otherwise(text)


def payment_payload(
    headers: DataFrame, vpa: DataFrame, lookup: DataFrame, run_ts: datetime, reference_prefix: str = "REF-"
) -> DataFrame:
    """Payment code content of eligible consumer documents: payment address of (entity, organisation) in
    force, one item per carriage return, as a base64 data string; with the new status and message."""
    waiting = headers.where(
        (F.col("eligible_flag") == "N") & (F.col("status_code") == "PENDING") & (F.col("supply_type_code") == "B2C")
    )
    current = vpa.where(F.col("effective_end").isNull() | (F.col("effective_end") > at(run_ts))).select(
        F.col("legal_entity_name").alias("supplier_legal_name"), "org_id", "vpa_details"
    )
    cr = F.lit("\r")
    payload = cat(
        F.col("vpa_details"), cr, F.col("supplier_legal_name"), cr, number_text(F.col("gross_amount")), cr,
        F.col("document_num"), cr, reference_prefix, F.col("transaction_id").cast("string"), cr,
    )
    code = strip_breaks(F.concat(F.lit("data:text/plain;base64,"), F.base64(F.encode(payload, "UTF-8"))))
    made = waiting.join(current, ["supplier_legal_name", "org_id"]).select(
        "transaction_id", "document_num", code.alias("payment_code")
    )
    status = F.when(F.col("payment_code").isNotNull(), "SUCCESS").otherwise("ERROR")
    made = made.withColumn("status_code", status).withColumn(
        "_code", F.when(F.col("status_code") == "SUCCESS", "B2C_SUCCESS").otherwise("B2C_ERROR")
    )
    return translate(made, "_code", lookup, "MESSAGES", "status_message").drop("_code")


def apply_payment(headers: DataFrame, payments: DataFrame) -> DataFrame:
    """Header state after the payment codes were made."""
    side = payments.select(
        F.col("transaction_id").alias("_id"),
        F.col("payment_code").alias("_code"),
        F.col("status_code").alias("_status"),
        F.col("status_message").alias("_message"),
    )
    joined = headers.join(side, F.col("transaction_id") == F.col("_id"), "left")
    return joined.withColumns(
        {
            "signed_code": F.col("_code"),
            "status_code": F.coalesce("_status", "status_code"),
            "status_message": F.when(F.col("_id").isNotNull(), F.col("_message")).otherwise(F.col("status_message")),
        }
    ).drop("_id", "_code", "_status", "_message")
