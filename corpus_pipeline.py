"""From raw documents to packed sequences: quality, language, near-duplicates, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept; all but the last return the
columns of documents, values unchanged, whatever further columns are called. Rows with a NULL doc_id, NULL or empty texts
pass through the same decisions as others: an empty text is scored and has no language, so it goes at the second stage at
the latest. Rows of equal id are documents of their own: each is judged by its own text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import langid, packing, quality, simhash
from ledgerloom.llm.common import fresh_folder, prepared, table, written

#: Least score of a document's language: a fifth of its letters in clear spans of one language, so texts of several stay.
LEAST_LANGUAGE = 0.2
#: Near duplicates: words of a shingle, most differing bits of 64.
WORDS, RADIUS = 4, 4


def beside(docs: DataFrame) -> DataFrame:
    """The text, and the whole row as one column, so that columns of an operator cannot meet those of the rows."""
    return docs.select(F.struct(*docs.columns).alias("_doc"), "text")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    labels = table(spark, sf_dir, "labels")
    machine = quality.fitted(docs.select("doc_id", "text"), labels, quality.held_out())
    return quality.scored(beside(docs), machine).where(F.col("predicted") == 1).select("_doc.*")


def keep_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in languages that were learned, and clearly so."""
    prepared(spark)
    model = langid.fitted(docs.select("doc_id", "text", "lang"), langid.held_out())
    found = langid.identified(beside(docs), model)
    return found.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_LANGUAGE)).select("_doc.*")


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near duplicates the document of smallest id; rows of the same id count one by one."""
    prepared(spark)
    rows = written(docs.select(F.struct(*docs.columns).alias("_doc"), F.monotonically_increasing_id().alias("_row")))
    groups = simhash.near_duplicates(rows.select("_row", "_doc.text"), key="_row", words=WORDS, radius=RADIUS)
    named = groups.select("_row", "component").join(rows.select("_row", F.col("_doc.doc_id").alias("_id")), "_row")
    first = named.groupBy("component").agg(F.min_by("_row", F.struct(F.col("_id").isNull(), "_id", "_row")).alias("_row"))
    return rows.join(first.select("_row"), "_row", "left_semi").select("_doc.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2,048 tokens."""
    prepared(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality classifier", keep_quality), ("language ID", keep_language), ("SimHash near-dedup", keep_distinct), ("packing", pack)]

# learned models and fingerprints of hashed shingles are beyond SQL; tests compare each stage with a plain version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; every stage before it is written to the shared folder and read back."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = fresh_folder(spark)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
