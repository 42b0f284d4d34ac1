"""Content-addressed WARC archive.

An archive is two tables in one folder. `payloads` holds the bytes of every distinct payload once, under their SHA-256;
`headers` holds the exact header of every record (WARC header and HTTP header) with the digest of its payload. Records
come back by joining the two; a stored payload is hashed again on the way and a mismatch ends the job.

Of records with equal payloads of at least `least_bytes`, the one with the smallest page id is the response and the
others are revisits that refer to it; smaller payloads are all responses. NULL html is an empty payload, NULL url leaves
the target line out, line ends inside a url are percent-encoded. Repeated rows of the smallest id are all responses. A
NULL page id comes after all others and is written as an empty id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import written

END = "\r\n"
# fixed values: the alphabet of base32, the profile that marks equal payloads
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(data: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: of every five bits of the hexadecimal digest, one letter."""
    digits = F.sha1(data)
    letters = []
    for k in range(32):
        at, rest = divmod(5 * k, 4)
        pair = F.conv(F.substring(digits, at + 1, 2), 16, 10).cast("int")
        letters.append(F.substring(F.lit(ALPHABET), F.shiftright(pair, 3 - rest).bitwiseAND(F.lit(31)) + F.lit(1), F.lit(1)))
    return F.concat(*letters)


def page_urn(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def write_archive(
    pages: DataFrame, path: str, key: str = "page_id", url: str = "url", body: str = "html", least_bytes: int = 0,
    date: str = "2024-01-01T00:00:00Z",
) -> None:
    """Write the two tables of the archive. Only digests are shuffled to find equal payloads; the bytes move once, to
    be stored."""
    payload = F.encode(F.coalesce(F.col(body), F.lit("")), "utf-8")
    rows = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).alias("url"), payload.alias("payload"))
    digested = rows.withColumn("sha256", F.sha2("payload", 256)).withColumn("bytes", F.length("payload").cast("long"))
    facts = written(digested.select("page_id", "url", "sha256", "bytes", base32_sha1(F.col("payload")).alias("sha1"), F.crc32("payload").alias("crc")))
    known = facts.groupBy("sha256").agg(
        F.min("page_id").alias("first"), F.min("crc").alias("low"), F.max("crc").alias("high"), F.count("*").alias("uses")
    )
    clash = F.when(F.col("low") != F.col("high"), F.raise_error(F.lit("two payloads with one digest"))).otherwise(F.col("first"))
    known = known.select("sha256", clash.cast("long").alias("first"), "uses")
    first = F.col("page_id").eqNullSafe(F.col("first"))
    revisit = (F.col("bytes") >= least_bytes) & ~first
    address = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "), F.col("bytes").cast("string"), F.lit(END + END))
    block = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("bytes"))
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), page_urn(F.col("page_id"))),
        F.concat(F.lit("WARC-Target-URI: "), address),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("sha1")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), page_urn(F.col("first")))),
        F.when(revisit, F.lit(f"WARC-Profile: {PROFILE}")),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), block.cast("string")),
    ]
    head = F.concat(F.concat_ws(END, *lines), F.lit(END + END), http)
    facts.join(known, "sha256").select("page_id", head.alias("head"), "sha256").write.parquet(f"{path}/headers")
    stored = digested.select("sha256", "payload").dropDuplicates(["sha256"])
    stored.write.option("compression", "zstd").parquet(f"{path}/payloads")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Every record again: page_id, record_type, refers_to, head, payload, payload_bytes, payload_digest.

    The payload of a revisit is that of the record it refers to. Length and digests are taken from the stored bytes."""
    stored = spark.read.parquet(f"{path}/payloads")
    checked = F.when(F.sha2("payload", 256) == F.col("sha256"), base32_sha1(F.col("payload"))).otherwise(
        F.raise_error(F.lit("a stored payload does not have its digest")).cast("string")
    )
    facts = stored.select("sha256", "payload", F.length("payload").cast("long").alias("payload_bytes"), checked.alias("payload_digest"))
    head = F.col("head")
    number = lambda name: F.expr(f"try_cast(nullif(regexp_extract(head, '{name}: <urn:page:(-?[0-9]*)>', 1), '') as bigint)")
    parsed = spark.read.parquet(f"{path}/headers").select(
        number("\\r\\nWARC-Record-ID").alias("page_id"),
        F.regexp_extract(head, "\r\nWARC-Type: ([a-z]+)\r\n", 1).alias("record_type"),
        number("\\r\\nWARC-Refers-To").alias("refers_to"),
        "head",
        "sha256",
    )
    return parsed.join(facts, "sha256").drop("sha256")


def records(archive: DataFrame) -> DataFrame:
    """The bytes of every WARC record: header, payload where the record carries it, the two line ends that close it."""
    body = F.when(F.col("record_type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    return archive.select("page_id", F.concat(F.col("head").cast("binary"), body, F.lit(b"\r\n\r\n")).alias("record"))


def export_files(archive: DataFrame, path: str) -> None:
    """WARC files, one per partition. A record ends with a line feed, which the text writer sets."""
    records(archive).select(F.expr("left(decode(record, 'utf-8'), length(decode(record, 'utf-8')) - 1)").alias("value")).write.option("lineSep", "\n").text(path)
