"""Document lines and taxes, classes and roll-ups."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ledgerloom.operators.spread import join_placed, number_rows
from ledgerloom.session import cut_lineage

LINE_COLUMNS = (
    "item_name item_code item_id quantity price hsn_code base_amount tax_amount gross_amount tax_trx_id "
    "tax_trx_line_id"
).split()

AMOUNTS = {"base_amount": "total_base_amount", "tax_amount": "total_tax_amount", "gross_amount": "gross_amount"}


def classify_code(code: Column, service_prefix: str = "9") -> Column:
    """GOODS or SERVICE by the prefix of the tariff code; no code, no class."""
    return F.when(code.startswith(service_prefix), "SERVICE").when(code.isNotNull(), "GOODS")


# staging rows from which on the lines of one document are numbered by many tasks
LARGE_DOCUMENT = 100_000

# A key of several columns starts with the one that the staging table is bucketed by, and both sides have a value in all of
# them. Where a header has one document number, and this number one header, the further columns do not tell rows apart.
Key = str | Sequence[str]


def key_columns(key: Key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def header_keys(headers: DataFrame, key: Key = "document_num") -> DataFrame:
    return headers.select("transaction_id", *key_columns(key))


def document_lines(stage: DataFrame, key: Key = "document_num") -> DataFrame:
    """Distinct line-grain rows with their class, still under the document number. Totals and flags of a
    document are grouped from these directly, without joining every line to its header."""
    return stage.select(*key_columns(key), *LINE_COLUMNS).distinct().withColumn("item_class", classify_code(F.col("hsn_code")))


def keyed_lines(stage: DataFrame, headers: DataFrame, key: Key) -> DataFrame:
    return join_placed(document_lines(stage, key), header_keys(headers, key), key_columns(key))


def line_rows(stage: DataFrame, headers: DataFrame, key: Key = "document_num") -> DataFrame:
    """Lines of each header, not yet numbered. The tax fan-out is undone before the join; as a header has one
    document number, the joined rows are distinct again without another shuffle."""
    return keyed_lines(stage, headers, key).drop(*key_columns(key))


def build_lines(stage: DataFrame, headers: DataFrame, key: Key = "document_num", keep_key: bool = False) -> DataFrame:
    """Lines numbered 1..n within their document, in the order of all their columns; a missing price is 0.
    The lines of a document are numbered where the join has put them, those of a large one in parallel. Runs a job to find
    the large ones: each has `LARGE_DOCUMENT` staging rows at least, so they are few. `keep_key`: with the key of the staging
    table, so that lines that lie by it can be joined where they are."""
    keys = key_columns(key)
    seen = Observation()
    large = stage.groupBy(*keys).count().where(F.col("count") >= LARGE_DOCUMENT).select(*keys)
    large = cut_lineage(large.observe(seen, F.count(F.lit(1)).alias("documents")))
    rows = keyed_lines(stage, headers, key)
    unkeyed = [] if keep_key else keys
    within = Window.partitionBy(*keys, "transaction_id").orderBy(*LINE_COLUMNS)
    if not seen.get.get("documents"):  # counted while they were written
        numbered = rows.withColumn("line_number", F.row_number().over(within).cast("long")).drop(*unkeyed)
    else:
        small = rows.join(F.broadcast(large), keys, "left_anti")
        cut = number_rows(
            rows.join(F.broadcast(large), keys, "left_semi").drop(*unkeyed), LINE_COLUMNS, "line_number", within=["transaction_id"]
        )
        numbered = small.withColumn("line_number", F.row_number().over(within).cast("long")).drop(*unkeyed).unionByName(cut)
    return numbered.withColumn("price", F.coalesce(F.col("price"), F.lit(0).cast("decimal(12,2)")))


def class_range() -> list[Column]:
    """Lowest and highest of the two classes, from flags: least and greatest texts would be grouped by sorting all lines."""
    goods, service = F.bool_or(F.col("item_class") == "GOODS"), F.bool_or(F.col("item_class") == "SERVICE")
    return [
        F.when(goods, "GOODS").when(service, "SERVICE").alias("low_class"),
        F.when(service, "SERVICE").when(goods, "GOODS").alias("high_class"),
    ]


def amount_sums() -> list[Column]:
    return [F.sum(c).cast("decimal(28,4)").alias(n) for c, n in AMOUNTS.items()]


def set_service_flag(headers: DataFrame) -> DataFrame:
    """M if a document has lines of both classes; else, only where still NULL, Y (service) or N (goods).
    Unclassed lines do not count. Lowest and highest class decide, so no distinct count is needed."""
    low, high = F.col("low_class"), F.col("high_class")
    current = F.col("is_service") if "is_service" in headers.columns else F.lit(None).cast("string")
    single = F.when(low == "GOODS", "N").when(low == "SERVICE", "Y")
    flagged = headers.withColumn("is_service", F.coalesce(F.when(low != high, "M"), current, single))
    return flagged.drop("low_class", "high_class")


def header_class(headers: DataFrame, lines: DataFrame, key: str = "transaction_id") -> DataFrame:
    return set_service_flag(headers.join(lines.groupBy(key).agg(*class_range()), key, "left"))


def rollup_amounts(headers: DataFrame, lines: DataFrame, key: str = "transaction_id") -> DataFrame:
    """Three sums of the lines on their header, from one grouping."""
    return headers.join(lines.groupBy(key).agg(*amount_sums()), key, "left")


def build_taxes(stage: DataFrame, headers: DataFrame, lines: DataFrame, key: Key = "document_num", keep_key: bool = False) -> DataFrame:
    """Distinct tax rows of each line, tied to it by the tax factor keys; rows without a factor have no tax.
    A line has one pair of factor keys, so the joined rows need no second distinct. `keep_key`: with the key of the staging table,
    which the lines have as well."""
    factors = ["tax_trx_id", "tax_trx_line_id"]
    keys = key_columns(key)
    rows = stage.where(F.col("tax_trx_id").isNotNull()).select(
        *keys, *factors, "tax_name", F.col("tax_rate"), "taxable_amount", "tax_type_id"
    )
    taxes = join_placed(rows.distinct(), header_keys(headers, key), keys)
    on = [*(keys if keep_key else []), "transaction_id", *factors]
    return (
        taxes.join(lines.select(*on, "line_number"), on)
        .select(*on[: -len(factors)], "line_number", "tax_name", "tax_rate", "taxable_amount", "tax_type_id")
    )


def document_taxes(stage: DataFrame, key: Key = "document_num") -> DataFrame:
    """Distinct tax rows per document number: all that document-level rules need."""
    rows = stage.where(F.col("tax_trx_id").isNotNull()).select(*key_columns(key), "tax_trx_line_id", "tax_name", "taxable_amount")
    return rows.distinct()


def without_duplicates(headers: DataFrame, keys: Sequence[str] = ("document_num",), placed: str | None = None) -> DataFrame:
    """Headers whose key occurs once; a repeated document number would multiply its lines. `placed`: a column that the
    headers lie by, and that none lacks; then only keys move, and the headers themselves stay where they are."""
    if placed is not None:
        count = headers.groupBy(*keys).agg(F.count("*").alias("count"), F.min(placed).alias(placed))
        once = count.where(F.col("count") == 1).drop("count")
        return join_placed(headers, once, [placed, *keys], "left_semi")
    once = headers.groupBy(*keys).count().where(F.col("count") == 1).drop("count")
    return headers.join(once, list(keys), "left_semi")


def quarantined(stage: DataFrame, *refused: DataFrame, key: str = "document_num") -> DataFrame:
    """Staging rows of the documents that a run leaves out, for the numbers in any of `refused`."""
    numbers = reduce(lambda a, b: a.union(b), [r.select(key) for r in refused])
    return stage.join(numbers.distinct(), key, "left_semi").select(*stage.columns)
