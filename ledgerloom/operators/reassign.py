"""Selection of open approval notifications and the plan to forward them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.text import cat

# Message type of each document kind
MESSAGE_TYPES = {"PR": "REQAPPRV", "PO": "POAPPRV", "AP": "APINVAPR"}
MORE_INFO_TEXT = "More Information Requested"


def select_notifications(df: DataFrame, kind: str, key: str | None, user: str, more_info_text: str = MORE_INFO_TEXT) -> DataFrame:
    """Open notifications of a user and document kind. PR and PO match the part of the key before its first
    dash anywhere in the item key, AP matches the start of the item key; no key matches all. Where more information
    was requested, the one asked stands as addressee, by role name (the directory of display names is another system)."""
    rows = df.where(
        (F.col("status") == "OPEN")
        & (F.col("recipient_role") == user)
        & (F.col("message_type") == MESSAGE_TYPES[kind])
    )
    if kind == "AP":
        if key:
            rows = rows.where(F.col("item_key").startswith(key))
    else:
        rows = rows.where(F.col("item_key").contains((key or "").split("-", 1)[0]))
    subject = F.when(F.col("more_info_role").isNull(), F.col("subject")).otherwise(
        cat(more_info_text, " ", F.col("subject"))
    )
    return rows.select(
        "notification_id",
        "item_key",
        (-F.col("priority")).alias("priority"),
        subject.alias("subject"),
        "language",
        F.coalesce("sent_date", "begin_date").alias("begin_date"),
        "due_date",
        "end_date",
        "status",
        "message_type",
        "message_name",
        "mail_status",
        "from_user",
        "from_role",
        F.coalesce("more_info_role", "to_user").alias("to_user"),
        "recipient_role",
        "more_info_role",
        "original_recipient",
    ).distinct()


def reassign_plan(selected: DataFrame, to_user: str, comment: str | None = None) -> DataFrame:
    """What an external workflow service has to do: forward each notification to the new role."""
    return selected.select(
        "notification_id",
        "item_key",
        F.col("recipient_role").alias("from_role"),
        F.lit(to_user).alias("to_role"),
        F.lit(comment).cast("string").alias("forward_comment"),
        F.lit("RULE").alias("action_source"),
    )
