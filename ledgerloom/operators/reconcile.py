"""Reconciliation checks. Each returns its violations; an empty result means the check passed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.lines import Key, key_columns


class ReconciliationError(RuntimeError):
    pass


def require_empty(violations: DataFrame, what: str) -> None:
    """Stop the run if a check found anything (looks for one row only)."""
    if not violations.isEmpty():
        raise ReconciliationError(what)


def violation_counts(checks: Mapping[str, DataFrame]) -> dict[str, int]:
    """Rows that each check found, all counted in one job."""
    counts = [rows.agg(F.count("*").alias("found")).select(F.lit(name).alias("check"), "found") for name, rows in checks.items()]
    return {r["check"]: r["found"] for r in reduce(DataFrame.unionByName, counts).collect()} if counts else {}


def document_checks(lines: DataFrame, taxes: DataFrame, key: Key = "transaction_id") -> DataFrame:
    """One row per document with a finding: repeated items, repeated taxes of a line, lines whose taxes do not add up to
    their tax amount. Documents in order drop out before the last shuffle, so it carries findings only."""
    keys = key_columns(key)
    items = lines.groupBy(*keys, "item_code").agg(F.count("*").alias("_times")).where("_times > 1")
    items = items.groupBy(*keys).agg(F.count("*").alias("repeated_items"))
    names = taxes.groupBy(*keys, "line_number", "tax_name").agg(F.count("*").alias("_times"), F.sum("taxable_amount").alias("_amount"))
    sums = names.groupBy(*keys, "line_number").agg(F.count_if(F.col("_times") > 1).alias("_repeated"), F.sum("_amount").alias("_taxed"))
    apart = F.coalesce(F.col("_taxed") != F.col("tax_amount"), F.lit(False))
    checked = sums.join(lines.select(*keys, "line_number", "tax_amount"), [*keys, "line_number"], "left").where((F.col("_repeated") > 0) | apart)
    taxed = checked.groupBy(*keys).agg(F.sum("_repeated").alias("repeated_taxes"), F.count_if(apart).alias("unequal_taxes"))
    return items.join(taxed, keys, "full")


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("occurrences")).where(F.col("occurrences") > 1)


def already_processed(
    current: DataFrame, history: DataFrame, key: str = "document_num", ignore: Sequence[str] = ("ERROR", "RE-EXTRACTED")
) -> DataFrame:
    """Current documents that another request already holds in a status that counts.

    History is reduced to the lowest and highest request of each document, so many versions of one document
    do not meet pairwise: another request exists exactly if one of the two differs from the current one.
    """
    held = (
        history.where(~F.col("status_code").isin(*ignore))
        .groupBy(F.col(key).alias("_key"))
        .agg(F.min("request_id").alias("_low"), F.max("request_id").alias("_high"))
    )
    other = (F.col("_low") != F.col("request_id")) | (F.col("_high") != F.col("request_id"))
    return current.join(held, (F.col(key) == F.col("_key")) & other, "left_semi")


def missing_in_target(
    source: DataFrame,
    target: DataFrame,
    source_keys: Mapping[bool, str],
    special: Column,
    batch: str = "batch_id",
    document: str = "document_num",
) -> DataFrame:
    """Source rows without a header. Which source number must match depends on the header's kind:
    `source_keys[True]` where `special` holds for the header, `source_keys[False]` elsewhere. The choice is
    put into the target's join key, so each case is one plain anti join; NULL keys never match."""
    kinds = target.select(
        F.coalesce(special, F.lit(False)).alias("_special"), F.col(document).alias("_num"), F.col(batch).alias("_batch")
    ).distinct()
    for kind, column in source_keys.items():
        side = kinds.where(F.col("_special") == F.lit(kind))
        source = source.join(side, (F.col(column) == F.col("_num")) & (F.col(batch) == F.col("_batch")), "left_anti")
    return source


def amount_mismatch(
    parent: DataFrame, child: DataFrame, keys: Sequence[str], parent_amount: str, child_amount: str
) -> DataFrame:
    """Parents whose amount differs from the sum of their children; parents without children pass."""
    sums = child.groupBy(*keys).agg(F.sum(child_amount).alias("child_sum"))
    return (
        parent.join(sums, list(keys))
        .where(F.col("child_sum") != F.col(parent_amount))
        .select(*keys, F.col(parent_amount).alias("parent_amount"), "child_sum")
    )


def count_mismatch(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys present on both sides with different row counts."""
    actual = source.groupBy(*keys).agg(F.count("*").alias("source_rows"))
    extracted = target.groupBy(*keys).agg(F.count("*").alias("target_rows"))
    return extracted.join(actual, list(keys)).where(F.col("source_rows") != F.col("target_rows"))


def row_count_check(source: DataFrame, target: DataFrame) -> DataFrame:
    """One row with both counts and whether they agree."""
    def counted(df, mine, other):
        return df.agg(F.count("*").alias(mine)).withColumn(other, F.lit(0).cast("long"))

    both = counted(source, "source_rows", "target_rows").unionByName(counted(target, "target_rows", "source_rows"))
    return both.agg(
        F.sum("source_rows").alias("source_rows"), F.sum("target_rows").alias("target_rows")
    ).withColumn("agrees", F.col("source_rows") == F.col("target_rows"))


def missing_detail(selected: DataFrame, detail: DataFrame, keys: Sequence[str] = ("document_num", "batch_id")) -> DataFrame:
    """Selected documents for which no detail row was produced; a NULL key never matches."""
    return selected.join(detail.select(*keys).distinct(), list(keys), "left_anti").select(keys[0]).distinct()


def run_summary(headers: DataFrame, keys: Sequence[str] = ("request_id",), reconciled: bool = True) -> DataFrame:
    """Outcome counts of a run in one pass, and its return code."""
    consumer = F.col("supply_type_code") == "B2C"
    other = F.col("supply_type_code") != "B2C"
    status = F.col("status_code")
    counts = headers.groupBy(*keys).agg(
        F.count("*").alias("documents"),
        F.count_if(other & (status == "ERROR")).alias("errors"),
        F.count_if(other & (status == "PENDING")).alias("marked_for_integration"),
        F.count_if(status == "SUCCESS-INELIGIBLE").alias("not_eligible"),
        F.count_if(consumer & (status == "ERROR")).alias("b2c_errors"),
        F.count_if(consumer & (status == "SUCCESS")).alias("b2c_successes"),
        F.count_if(consumer).alias("b2c_extracted"),
    )
    failed = F.lit(True) if not reconciled else F.col("errors") > 0
    return counts.withColumn("return_code", F.when(failed, 1).otherwise(0))
