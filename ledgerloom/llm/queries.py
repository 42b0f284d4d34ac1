"""One query per operator over its whole table, with its SQL check where SQL can state it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import ann, extract, fingerprint, impact_search, importance, langid, log_bilinear, merge_dropout, packing, quality, simhash, url_trie, warc
from ledgerloom.llm.common import fresh_folder, table

BYTE_MODEL, MERGE_MODEL = "byte_bpe_50k.json", "piece_bpe_32k.model"
URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def op1_nearest(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings")
    return ann.search(rows, rows.where(F.col("vec_id") % 20 == 0))


def op2_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprint.edited_fingerprints(table(spark, folder, "documents"))


def op3_archive(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_folder(spark)
    warc.write_archive(table(spark, folder, "pages"), path, least_bytes=0)
    return warc.read_archive(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), public_tokenizers.path(BYTE_MODEL))


def op5_merge_dropout(spark: SparkSession, folder: str) -> DataFrame:
    return merge_dropout.encoded(table(spark, folder, "documents"), public_tokenizers.path(MERGE_MODEL))


def op6_main_text(spark: SparkSession, folder: str) -> DataFrame:
    pages = extract.extracted(table(spark, folder, "pages"))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op7_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    return url_trie.judged(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op8_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"), words=4, radius=4)
    digits = F.lpad(F.lower(F.hex("w0")), 16, "0")
    return found.select("doc_id", digits.alias("fingerprint"), F.col("component").alias("component_id"))


def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    machine = quality.fitted(docs, labels, quality.held_out())
    return quality.scored(docs, machine).select("doc_id", quality.held_out().alias("held_out"), "score", "predicted")


def op10_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = langid.fitted(docs, langid.held_out())
    return langid.identified(docs, model).select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def op11_log_bilinear(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = log_bilinear.fitted(docs, log_bilinear.held_out())
    found = log_bilinear.scored(docs, model).withColumn("train_tokens", F.lit(model.vocab.tokens).cast("long"))
    return found.select("doc_id", log_bilinear.held_out().alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op12_ranked(spark: SparkSession, folder: str) -> DataFrame:
    return impact_search.ranked(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op13_importance(spark: SparkSession, folder: str) -> DataFrame:
    return importance.resampled(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_nearest, op2_fingerprints, op3_archive, op4_packing, op5_merge_dropout, op6_main_text, op7_url_rules, op8_simhash, op9_quality,
        op10_language, op11_log_bilinear, op12_ranked, op13_importance,
    )
}

CHECKS = {
    "op3_archive": """
WITH payloads AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload, sha1(coalesce(html, '')) AS digits FROM pages
), known AS (
  SELECT page_id, octet_length(payload) AS payload_bytes, digits, min(page_id) OVER (PARTITION BY payload) AS first_id FROM payloads
), spelt AS (
  SELECT *, array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (
    ((16 * (strpos('0123456789abcdef', substr(digits, 1 + (5 * k) // 4, 1)) - 1)
      + greatest(strpos('0123456789abcdef', substr(digits || '0', 2 + (5 * k) // 4, 1)) - 1, 0)) >> (3 - (5 * k) % 4)) & 31)::BIGINT, 1)), '') AS payload_digest
  FROM known
)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM spelt""",
    "op7_url_rules": r"""
WITH split AS (
  SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
  FROM pages
), rules(verdict, rule_host, rule_path) AS (
  VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), fitting AS (
  SELECT s.page_id, s.host, s.path, r.verdict, r.rule_host || r.rule_path AS rule,
    row_number() OVER (PARTITION BY s.page_id ORDER BY length(r.rule_host || r.rule_path) DESC, r.verdict DESC) AS place
  FROM split s JOIN rules r ON (s.host = r.rule_host OR ends_with(s.host, '.' || r.rule_host)) AND starts_with(s.path, r.rule_path)
)
SELECT s.page_id, s.host, s.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM split s LEFT JOIN fitting f ON f.page_id = s.page_id AND f.place = 1""",
    "op12_ranked": r"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms, row_number() OVER () AS place FROM documents
), sized AS (
  SELECT place, doc_id, terms, len(terms)::BIGINT AS n FROM texts WHERE len(terms) > 0
), whole AS (
  SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS all_terms FROM sized
), held AS (
  SELECT place, term, count(*)::BIGINT AS tf FROM (SELECT place, unnest(terms) AS term FROM sized) GROUP BY place, term
), weighed AS (
  SELECT term, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM held, whole GROUP BY term
), asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), summed AS (
  SELECT a.item_id, h.place, any_value(s.doc_id) AS doc_id,
    sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // all_terms))))::BIGINT AS score
  FROM asked a JOIN held h USING (term) JOIN weighed USING (term) JOIN sized s ON s.place = h.place, whole
  GROUP BY a.item_id, h.place
), ordered AS (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM summed WHERE score > 0
)
SELECT item_id, rank::INT AS rank, doc_id, score FROM ordered WHERE rank <= 10""",
    "op13_importance": r"""
WITH remainders AS (
  SELECT list(list_reduce([n]::BIGINT[] || range(8), lambda c, step: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY n) AS steps
  FROM range(256) t(n)
), texts AS (
  SELECT 'd' AS side, row_number() OVER () AS place, doc_id, text FROM documents
  UNION ALL SELECT 't', row_number() OVER (), NULL, text FROM benchmark
), words AS (
  SELECT side, place, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM texts
), hashed AS (
  SELECT word, xor(list_reduce([4294967295]::BIGINT[] || list_transform(range(octet_length(encode(word))),
      lambda k: ('0x' || substr(hex(encode(word)), 2 * k::INT + 1, 2))::BIGINT),
    lambda c, b: xor(c >> 8, steps[xor(c & 255, b) + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT word FROM words), remainders
), counted AS (
  SELECT side, place, bucket, count(*)::BIGINT AS times FROM words JOIN hashed USING (word) GROUP BY side, place, bucket
), shares AS (
  SELECT bucket, coalesce(sum(times) FILTER (WHERE side = 'd'), 0)::BIGINT AS s, coalesce(sum(times) FILTER (WHERE side = 't'), 0)::BIGINT AS t
  FROM counted GROUP BY bucket
), gains AS (
  SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (s_all + 10000)::DOUBLE / ((s + 1)::DOUBLE * (t_all + 10000)::DOUBLE)))::BIGINT AS gain
  FROM shares, (SELECT sum(s)::BIGINT AS s_all, sum(t)::BIGINT AS t_all FROM shares)
), weights AS (
  SELECT place, sum(times)::BIGINT AS n_features, floor(sum(times * gain)::DOUBLE / sum(times)::DOUBLE)::BIGINT AS weight
  FROM counted JOIN gains USING (bucket) WHERE side = 'd' GROUP BY place
), scored AS (
  SELECT d.place, d.doc_id, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
    coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || d.doc_id::VARCHAR), 1, 8))::BIGINT::DOUBLE + 0.5) / 4294967296)))::BIGINT AS score
  FROM texts d LEFT JOIN weights w ON w.place = d.place WHERE d.side = 'd'
), ordered AS (
  SELECT place, row_number() OVER (ORDER BY score DESC, doc_id) AS pos, count(*) OVER () AS n FROM scored WHERE n_features >= 20 AND doc_id IS NOT NULL
)
SELECT doc_id, n_features, weight, score, CASE WHEN pos <= (10 * n) // 100 THEN pos END::BIGINT AS rank
FROM scored LEFT JOIN ordered USING (place)""",
}
