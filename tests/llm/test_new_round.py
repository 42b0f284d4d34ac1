"""Log-bilinear scores, impact-sorted search and importance resampling against plain versions; odd rows."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import impact_search, importance, log_bilinear, queries
from ledgerloom.llm.common import prepared
from tests.conftest import SMALL

LONG = "the of and to " * 20_000
TEXTS = [None, "", " ", "one", "The of and to in is that it was for", "the of and to in is that it was for", LONG, "日本語 ÉÉ 🎉 a-b c_d", "x" * 5000]
SCHEMA = "doc_id long, text string, lang string, score int, key long, row string, rank int, word string"


@pytest.fixture(scope="module")
def docs(spark):
    prepared(spark)
    rows = [(k if k != 2 else None, t, "en", 9, 5, "r", 3, "w") for k, t in enumerate(TEXTS)]
    return spark.createDataFrame([*rows, rows[4]], SCHEMA)


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, "the of"), (1, "for"), (2, None), (3, ""), (4, "日本語 a X"), (None, "one"), (5, "nowhere")]
    return spark.createDataFrame([(a, b, 1) for a, b in rows], "item_id long, text string, score int")


def plain_words(text):
    return [w.encode() for w in (text or "").translate({k: k + 32 for k in range(65, 91)}).translate({k: 32 for k in range(9, 14)}).split(" ") if w] + [log_bilinear.END]


@pytest.fixture(scope="module")
def language_model(spark):
    return log_bilinear.fitted(spark.read.parquet(f"{SMALL}/documents.parquet"), log_bilinear.held_out())


def plain_score(model, text, counts):
    """Word by word: a softmax over all units for every context, and the word's share of its unit."""
    vocab, w, n = model.vocab, model.weights, model.vocab.units
    own = {word: k for k, word in enumerate(vocab.words[: vocab.own])}
    last, total = (n, n), 0.0
    for word in plain_words(text):
        unit = own.get(word, vocab.own + zlib.crc32(word[-2:]) % log_bilinear.CLASSES)
        context = w.table[last[0]].astype(float) + w.table[n + 1 + last[1]].astype(float)
        scores = w.table[2 * n + 2 :].astype(float) @ context
        top = scores.max()
        total += (scores[unit] - top - math.log(np.exp(scores - top).sum())) / math.log(10)
        if unit >= vocab.own:
            total += math.log10((counts[word] + 1) / (vocab.unit_times[unit] + vocab.unit_words[unit] + 1))
        last = (last[1], unit)
    return total


def test_language_model_scores_match_word_by_word(spark, language_model):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    counts = Counter()
    for key, text in texts.items():
        if zlib.crc32(str(key).encode()) % 7 != 2:
            counts.update(plain_words(text))
    tokens, distinct = sum(counts.values()), len(counts)
    # the sums of the units' shares are those of all words
    shares, size = Counter(), Counter()
    for word, times in counts.items():
        shares[zlib.crc32(word[-2:]) % log_bilinear.CLASSES] += times
        size[zlib.crc32(word[-2:]) % log_bilinear.CLASSES] += 1
    vocab = language_model.vocab
    assert (vocab.tokens, vocab.distinct, vocab.unit_times.sum(), vocab.unit_words.sum()) == (tokens, distinct, tokens, distinct)
    found = log_bilinear.scored(docs, language_model).toPandas().set_index("doc_id")
    assert len(found) == len(texts)
    for key, text in texts.items():
        row, words = found.loc[key], plain_words(text)
        assert (row["n_tokens"], row["n_known"]) == (len(words), sum(w in counts for w in words))
        assert row["base_score"] == pytest.approx(sum(math.log10((counts[w] + 1) / (tokens + distinct + 1)) for w in words), rel=1e-9)
    for key in sorted(texts)[::10]:
        assert found.loc[key, "score"] == pytest.approx(plain_score(language_model, texts[key], counts), rel=1e-4, abs=1e-3)


def test_language_model_is_normalised_and_learns(spark, language_model):
    n, sums = language_model.vocab.units, language_model.sums
    draw = np.random.default_rng(3)
    a, b = draw.integers(0, n + 1, (2, 50))
    scores = language_model.weights.context(a, b).astype(float) @ language_model.weights.following(np.arange(n)).astype(float).T
    assert np.allclose(np.exp(scores - sums[a, b][:, None]).sum(axis=1), 1, atol=1e-3)
    mine = queries.op11_log_bilinear(spark, SMALL).toPandas()
    assert (mine["held_out"] == [zlib.crc32(str(d).encode()) % 7 == 2 for d in mine["doc_id"]]).all()
    unseen = mine[mine["held_out"]]
    assert unseen["score"].sum() / unseen["n_tokens"].sum() > unseen["base_score"].sum() / unseen["n_tokens"].sum() + 0.1


def test_language_model_edges(spark, docs):
    model = log_bilinear.fitted(docs, F.lit(False))
    rows = log_bilinear.scored(docs, model).toPandas()
    assert len(rows) == len(TEXTS) + 1 and rows["doc_id"].isna().sum() == 1
    assert rows.set_index("doc_id").loc[0, "n_tokens"] == 1 and rows["score"].lt(0).all() and np.isfinite(rows["score"]).all()
    assert (rows["n_tokens"] == rows["n_known"]).all()
    none = log_bilinear.fitted(docs.where("false"), log_bilinear.held_out())
    unknown = log_bilinear.scored(docs, none).toPandas()
    assert (unknown["n_known"] == 0).all() and (unknown["base_score"] == 0).all() and np.isfinite(unknown["score"]).all()
    assert log_bilinear.scored(docs.where("false"), model).count() == 0


def test_words_outside_the_dictionary_meet_their_counts(spark, docs, monkeypatch):
    wide = log_bilinear.fitted(docs, F.lit(False))
    monkeypatch.setattr(log_bilinear, "DICTIONARY", 5)
    narrow = log_bilinear.fitted(docs, F.lit(False))
    assert len(narrow.vocab.words) < len(wide.vocab.words)
    a, b = (log_bilinear.scored(docs, m).orderBy("_row").toPandas() for m in (wide, narrow))
    assert (a["n_known"] == b["n_known"]).all() and np.allclose(a["base_score"], b["base_score"], rtol=1e-9)


def test_reading_lists_ends_with_exact_places():
    draw = np.random.default_rng(7)
    for _ in range(60):
        size, terms = int(draw.integers(1, 400)), int(draw.integers(0, 12))
        lists, total = [], np.zeros(size, dtype=np.int64)
        for _ in range(terms):
            held = draw.permutation(size)[: draw.integers(0, size + 1)]
            impact = np.sort(draw.integers(1, draw.integers(2, 60), len(held)))[::-1]
            lists.append((held, impact))
            total[held] += impact
        least = int(draw.integers(1, 30))
        found, scores = impact_search.resolved_top(lists, size, least, places=10, first=2)
        bar = max(least, int(np.sort(total)[::-1][9]) if size >= 10 else 1)
        assert found.tolist() == np.flatnonzero(total >= bar).tolist() and (scores == total[found]).all()


def test_search_reads_only_the_front_of_long_lists():
    class Watched(np.ndarray):
        read = 0

        def __getitem__(self, key):
            if isinstance(key, slice):
                Watched.read += key.stop - key.start
            return super().__getitem__(key)

    size = 100_000
    impact = np.concatenate((np.full(20, 10_000), np.arange(size - 20, 0, -1) % 50 + 1)).astype(np.int64)
    impact[20:] = np.sort(impact[20:])[::-1]
    documents = np.arange(size).view(Watched)
    found, _ = impact_search.resolved_top([(documents, impact), (np.arange(size), impact.copy())], size, 1)
    assert found.tolist() == list(range(20)) and Watched.read < size // 10


def plain_terms(text):
    low = (text or "").translate({k: k + 32 for k in range(65, 91)})
    return "".join(c if c.isascii() and c.isalnum() or ord(c) > 127 else " " for c in low).split(" ")


def plain_ranked(rows, items, places):
    held = [(key, Counter(t for t in plain_terms(text) if t)) for key, text in rows]
    held = [(k, c) for k, c in held if c]
    n, total, df = len(held), sum(sum(c.values()) for _, c in held), Counter(t for _, c in held for t in c)
    out = []
    for item in {i for i, _ in items}:
        asked = {t for i, text in items if i == item for t in plain_terms(text) if t}
        scores = []
        for key, c in held:
            m = 10 + (90 * sum(c.values()) * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in asked if c[t])
            if score > 0:
                scores.append((-score, math.inf if key is None else key, key))
        scores.sort(key=lambda s: s[:2])
        out += [(item, r + 1, key, -s) for r, (s, _, key) in enumerate(scores[:places])]
    return Counter(out)


@pytest.mark.parametrize("term_block, slice_", [(200_000, 1 << 20), (3, 4)])
def test_ranked_search_edges(spark, docs, items, term_block, slice_):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    asked = [(r["item_id"], r["text"]) for r in items.collect()]
    for places in (2, 10):
        found = impact_search.ranked(docs, items, places=places, term_block=term_block, slice_=slice_).collect()
        assert Counter(tuple(r) for r in found) == plain_ranked(rows, asked, places)
    assert impact_search.ranked(docs.where("false"), items).count() == 0 == impact_search.ranked(docs, items.where("false")).count()


def test_planes_add_up_to_the_sum_of_gains():
    draw = np.random.default_rng(5)
    for buckets in (1, 63, 64, 1000):
        gain = draw.integers(-9000, 9000, buckets)
        rows = [(p := np.flatnonzero(draw.random(buckets) < 0.3), draw.integers(1, 3000, len(p))) for _ in range(9)]
        rows.append((np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)))
        sums = importance.plane_sums(rows, importance.gain_planes(gain), buckets)
        assert sums.tolist() == [int((gain[p] * t).sum()) for p, t in rows]
    assert importance.plane_sums([], importance.gain_planes(np.zeros(5, dtype=np.int64)), 5).tolist() == []


@pytest.mark.parametrize("longest", [1, 3])
def test_resampling_edges(spark, docs, items, longest):
    target = items.withColumn("text", F.concat(F.coalesce("text", F.lit("")), F.lit(" the of and")))
    found = importance.resampled(docs, target, longest=longest, least_words=1, percent=50, buckets=97).toPandas()
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert len(found) == len(rows)

    def features(text):
        words = [w.encode() for w in plain_terms(text) if w]
        return [b" ".join(words[k : k + n]) for n in range(1, longest + 1) for k in range(len(words) - n + 1)]

    def shares(texts):
        return Counter(zlib.crc32(f) % 97 for t in texts for f in features(t))

    s, t = shares(x for _, x in rows), shares(r["text"] for r in target.collect())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s.total() + 97) / ((s[b] + 1) * (t.total() + 97)))) for b in range(97)]
    want = Counter()
    for key, text in rows:
        mine = [gain[zlib.crc32(f) % 97] for f in features(text)]
        want[key, len(mine), sum(mine) // len(mine) if mine else 0] += 1
    clean = found.astype(object).where(found.notna(), None)
    assert Counter(zip(clean["doc_id"], clean["n_features"], clean["weight"])) == want
    may = found[(found["n_features"] > 0) & found["doc_id"].notna()].sort_values(["score", "doc_id"], ascending=[False, True])
    drawn = found[found["rank"].notna()].sort_values("rank")
    assert drawn["rank"].tolist() == list(range(1, len(may) // 2 + 1))
    assert drawn["score"].tolist() == may["score"].tolist()[: len(drawn)] and drawn["doc_id"].tolist() == may["doc_id"].tolist()[: len(drawn)]
    assert found["score"].isna().sum() == found["doc_id"].isna().sum() == 1
    assert importance.resampled(docs.where("false"), target).count() == 0
    assert importance.resampled(docs, target.where("false")).count() == len(rows)
