"""Registered queries on the smallest tables: SQL checks, and plain versions where SQL cannot state them."""

import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

import corpus_pipeline
from check import compare, connect
from ledgerloom.llm import extract, fingerprint, queries
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def frames(spark):
    return {name: spark.read.parquet(f"{SMALL}/{name}.parquet").toPandas() for name in ("documents", "embeddings", "pages", "labels")}


@pytest.fixture(scope="module")
def ids_of():
    tokenizer = Tokenizer.from_file(public_tokenizers.path(queries.BYTE_MODEL))
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


@pytest.mark.parametrize("name", sorted(queries.CHECKS))
def test_sql_check(spark, name):
    ok, rows, note = compare(spark, connect(SMALL), name, queries.QUERIES[name], queries.CHECKS[name], SMALL)
    assert ok and rows, note


def test_nearest_recall(spark, frames):
    table = frames["embeddings"]
    vectors, ids = np.stack(table["embedding"].to_numpy()).astype(float), table["vec_id"].to_numpy()
    found = queries.op1_nearest(spark, SMALL).toPandas().sort_values(["query_id", "rank"])
    hit = total = 0
    for query in ids[ids % 20 == 0]:
        score = vectors @ vectors[ids == query][0]
        best = sorted((-s, i) for s, i in zip(score, ids) if i != query)[:20]
        mine = found[found["query_id"] == query]
        assert mine["rank"].tolist() == list(range(1, len(mine) + 1)) and len(mine) == len(best)
        assert np.allclose(mine["score"], [score[ids == i][0] for i in mine["vec_id"]])
        hit += len({i for _, i in best} & set(mine["vec_id"]))
        total += len(best)
    assert hit >= 0.9 * total


def test_fingerprints_match_plain_version(spark, frames):
    docs = frames["documents"].sort_values("doc_id")
    texts = docs["text"].fillna("").tolist()
    mine = queries.op2_fingerprints(spark, SMALL).toPandas().set_index("doc_id")
    assert len(mine) == len(docs)
    for k, key in enumerate(docs["doc_id"]):
        own, after = texts[k], texts[(k + 1) % len(texts)]
        half = len(own) // 2
        edited = own[: len(own) - half] + after[:half]
        row, prints = mine.loc[key], [fingerprint.digest(t.encode()) for t in (own, edited, after)]
        assert (row["n_chars"], row["fingerprint"], row["edited_fingerprint"]) == (len(own), prints[0], prints[1])
        assert row["edited_sha256"] == __import__("hashlib").sha256(edited.encode()).hexdigest()
        assert row["near_edited"] == fingerprint.likeness(*prints[:2]) and row["near_next"] == fingerprint.likeness(prints[0], prints[2])
    assert mine["near_edited"].mean() > mine["near_next"].mean() + 0.1


def packed_right(rows, texts, ids_of, capacity=2048):
    """Every id in one piece, sequences without gaps, padding only up to the capacity."""
    for key, group in rows.groupby("doc_id"):
        ids, at = ids_of(texts[key]), 0
        for piece in group.sort_values("start").itertuples():
            assert piece.start == at and piece.doc_tokens == len(ids) and piece.length > 0
            raw = np.array(ids[at : at + piece.length], dtype="<u4").tobytes()
            assert piece.ids_crc32 == zlib.crc32(raw)
            at += piece.length
        assert at == len(ids)
    padding = 0
    for _, group in rows.groupby("sequence_id"):
        group = group.sort_values("offset")
        assert group["offset"].tolist() == [0, *np.cumsum(group["length"])[:-1]]
        size = int(group["length"].sum())
        assert size <= capacity
        padding += 0 if size & (size - 1) == 0 else capacity - size
    return padding


def test_packing_holds_every_id(spark, frames, ids_of):
    rows = queries.op4_packing(spark, SMALL).toPandas()
    texts = frames["documents"].set_index("doc_id")["text"].to_dict()
    assert set(rows["doc_id"]) == set(texts)
    assert packed_right(rows, texts, ids_of) == 0


def test_merge_dropout_decodes_to_every_text(spark, frames):
    rows = queries.op5_merge_dropout(spark, SMALL)
    from ledgerloom.llm.merge_dropout import decoded

    back = decoded(rows, public_tokenizers.path(queries.MERGE_MODEL)).toPandas().set_index("doc_id")
    assert back["lossless"].all()
    assert back["text"].to_dict() == frames["documents"].set_index("doc_id")["text"].fillna("").to_dict()


def test_main_text_is_the_article(spark, frames):
    import html
    import re

    mine = queries.op6_main_text(spark, SMALL).toPandas().set_index("page_id")
    for row in frames["pages"].itertuples():
        article = re.search(r"<article>(.*?)(</article>|$)", row.html, re.S)
        plain = " ".join(html.unescape(re.sub(r"<[^>]*(>|$)", " ", article[1] if article else "")).split())
        assert mine.loc[row.page_id, "text"] == plain and mine.loc[row.page_id, "n_chars"] == len(plain)


def plain_groups(prints: dict[int, int], radius: int) -> dict[int, int]:
    """Smallest key reachable, by comparing all pairs."""
    keys = sorted(prints)
    least = {k: k for k in keys}

    def top(k):
        while least[k] != k:
            k = least[k]
        return k

    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                x, y = sorted((top(a), top(b)))
                least[y] = x
    return {k: top(k) for k in keys}


def plain_simhash(text, words):
    tokens = (text or "").encode().lower().split()
    shingles = [b" ".join(tokens[i : i + words]) for i in range(max(1, len(tokens) - words + 1))] if tokens else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def test_simhash_matches_all_pairs(spark, frames):
    prints = {d: plain_simhash(t, 4) for d, t in zip(frames["documents"]["doc_id"], frames["documents"]["text"])}
    mine = queries.op8_simhash(spark, SMALL).toPandas().set_index("doc_id")
    assert {d: int(x, 16) for d, x in mine["fingerprint"].items()} == prints
    assert mine["component_id"].to_dict() == plain_groups(prints, 4)


def test_quality_on_held_out_rows(spark, frames):
    mine = queries.op9_quality(spark, SMALL).toPandas()
    assert len(mine) == len(frames["documents"]) and mine["score"].between(0, 1).all()
    assert ((mine["score"] >= 0.3).astype(int) == mine["predicted"]).all()
    assert (mine["held_out"] == [zlib.crc32(str(d).encode()) % 5 == 0 for d in mine["doc_id"]]).all()
    both = mine.merge(frames["labels"], on="doc_id")
    unseen = both[both["held_out"]]
    assert (unseen["predicted"] == unseen["quality"]).mean() > 0.8


def test_language_on_held_out_rows(spark, frames):
    mine = queries.op10_language(spark, SMALL).toPandas().merge(frames["documents"], on="doc_id")
    assert len(mine) == len(frames["documents"]) and mine["score"].between(0, 1).all()
    assert (mine["held_out"] == [zlib.crc32(str(d).encode()) % 3 == 1 for d in mine["doc_id"]]).all()
    unseen = mine[mine["held_out"]]
    assert (unseen["lang_pred"] == unseen["lang"]).mean() > 0.95


def test_pipeline_stage_by_stage(spark, frames, ids_of):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns
        rows = out.toPandas()
        kept[name] = rows.set_index("doc_id")["text"].to_dict()
        docs = spark.createDataFrame(rows, docs.schema)
    labels = frames["labels"].set_index("doc_id")["quality"].to_dict()
    first = kept["quality classifier"]
    judged = [(d, q) for d, q in labels.items() if d in set(frames["documents"]["doc_id"])]
    assert np.mean([(d in first) == (q == 1) for d, q in judged]) > 0.9
    second = kept["language ID"]
    assert len(second) >= 0.99 * len(first)
    groups = plain_groups({d: plain_simhash(t, 4) for d, t in second.items()}, 4)
    assert set(kept["SimHash near-dedup"]) == set(groups.values())
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).toPandas()
    assert packed_right(packed, kept["SimHash near-dedup"], ids_of) == 0


def test_extraction_helper_is_exported():
    assert extract.main_text(None) == ""
