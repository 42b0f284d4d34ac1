"""Nulls, empty and very long texts, ties, repeated rows, empty tables, extra and clashing columns, method internals."""

import hashlib
import itertools
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from ledgerloom.llm import ann, extract, fingerprint, langid, merge_dropout, packing, quality, simhash, url_trie, warc
from ledgerloom.llm.common import fresh_folder, prepared

LONG = "the of and to " * 20_000
TEXTS = [None, "", " ", "one", "the of and to in is that it was for", "the of and to in is that it was for", LONG, "▁x ▁▁ <s> 日本語 🎉\n\n  end ", "x" * 5000]
MERGES, BYTES = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def docs(spark):
    prepared(spark)
    rows = [(k if k != 2 else None, t, "en", "s", len(t or ""), 9, "clash", 0.5) for k, t in enumerate(TEXTS)]
    rows.append(rows[4])
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score int, _text string, component double")


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


def test_fingerprint_edges(docs, none):
    rows = fingerprint.edited_fingerprints(docs).toPandas()
    assert len(rows) == len(TEXTS) + 1
    first = rows.sort_values("doc_id").set_index("doc_id")
    assert first.loc[4, "fingerprint"].iloc[0] == first.loc[5, "fingerprint"]
    edited = "one"[:2] + TEXTS[4][:1]
    assert first.loc[3, "edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
    assert fingerprint.edited_fingerprints(none).count() == 0
    sole = fingerprint.edited_fingerprints(docs.where("doc_id = 3")).collect()
    assert len(sole) == 1 and sole[0]["near_next"] == 1
    a, b = fingerprint.digest(LONG.encode()), fingerprint.digest(b"")
    assert 0 <= fingerprint.difference(a, b) <= fingerprint.MOST and fingerprint.likeness(a, a) == 1
    assert set(fingerprint.fingerprints(docs).columns) == {*docs.columns, "fingerprint"}


def test_packing_edges(docs, none):
    rows = packing.pack(docs, BYTES).toPandas()
    tokenizer = Tokenizer.from_file(BYTES)
    want = sum(len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for t in [*TEXTS, TEXTS[4]])
    assert rows["length"].sum() == want and rows["doc_id"].isna().sum() == 1
    assert packing.pack(none, BYTES).count() == 0
    lengths = np.array([5000, 1, 2048, 700, 700, 1500, 3])
    pieces = packing.place(lengths)
    assert sum(p[2] for p in pieces) == lengths.sum()


def test_word_encoder_equals_library():
    tokenizer = Tokenizer.from_file(BYTES)
    odd = ["a  b", " a", "a ", "a\n b", "don't it 's 12ab", "<|endoftext|> x", "a <|endoftext|> b", "a  <|endoftext|><|endoftext|>", "<|endoftext| >", "tab\t x \x1c y", "é ü\u00a0 z", "ab\u3000 c", *[t or "" for t in TEXTS]]
    for text, ids in zip(odd, packing.Encoder(BYTES).encode(odd)):
        assert np.frombuffer(ids, dtype="<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_cost_balance():
    draw = np.random.default_rng(1)
    lengths = draw.integers(1, 900, 3000)
    cost = {}
    for _, _, n, seq, _ in packing.place(lengths):
        cost[seq] = cost.get(seq, 0) + packing.LINEAR * n + packing.QUADRATIC * n * n
    full = sorted(cost.values())[12:]
    assert max(full) < 1.6 * min(full)


def test_merge_dropout_edges(docs, none):
    rows = merge_dropout.encoded(docs, MERGES).collect()
    assert len(rows) == len(TEXTS) + 1 and all(r["lossless"] for r in rows)
    assert merge_dropout.encoded(none, MERGES).count() == 0


def test_no_dropout_is_the_plain_segmentation():
    m, model = merge_dropout.Model(MERGES), sentencepiece.SentencePieceProcessor(model_file=MERGES)
    texts = [t for t in TEXTS if t and "▁" not in t]
    ids, counts = merge_dropout.encode(m, texts, list(range(len(texts))), dropout=0.0)
    ends = np.cumsum(counts)
    for text, end, n in zip(texts, ends, counts):
        assert ids[end - n : end].tolist() == model.encode(text)


def test_dropout_by_queue_and_side_by_side_agree(monkeypatch):
    m = merge_dropout.Model(MERGES)
    draw = random.Random(3)
    words = [" " + "".join(draw.choice("etaoinshr") for _ in range(draw.randint(1, 40))) for _ in range(300)]
    key = merge_dropout.mixed(np.arange(300, dtype=np.uint64))
    for rate in (0.0, 0.1, 0.6):
        limit = int(rate * 2.0**64)
        ids, counts = merge_dropout.segment(m, words, key, limit)
        monkeypatch.setattr(merge_dropout, "LONG", 0)
        again, sizes = merge_dropout.segment(m, words, key, limit)
        monkeypatch.undo()
        assert ids.tolist() == again.tolist() and counts.tolist() == sizes.tolist()
    one = merge_dropout.encode(m, ["internationalisation of words"] * 2, [1, 1], seed=1)[0].tolist()
    seeds = {tuple(merge_dropout.encode(m, ["internationalisation of words"], [1], seed=s)[0].tolist()) for s in range(20)}
    assert one[: len(one) // 2] == one[len(one) // 2 :] and len(seeds) > 3


def test_archive_round_trip(spark, tmp_path):
    rows = [(3, "http://a/x\r\ny", "<p>same</p>"), (1, None, "<p>same</p>"), (2, "u", None), (4, "v", ""), (None, "w", "WARC/1.1\r\nü"), (3, "http://a/x\r\ny", "<p>same</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("sha256", F.lit("clash"))
    path = fresh_folder(spark)
    warc.write_archive(pages, path)
    archive = warc.read_archive(spark, path)
    got = sorted((r["page_id"] or 0, r["record_type"], r["refers_to"], bytes(r["payload"]).decode()) for r in archive.collect())
    same = "<p>same</p>"
    assert got == [(0, "response", None, "WARC/1.1\r\nü"), (1, "response", None, same), (2, "response", None, ""), (3, "revisit", 1, same), (3, "revisit", 1, same), (4, "revisit", 2, "")]
    assert spark.read.parquet(f"{path}/payloads").count() == 3
    warc.export_files(archive, str(tmp_path / "files"))
    data, found = b"".join(p.read_bytes() for p in (tmp_path / "files").glob("part-*")), 0
    while data:
        head, _, rest = data.partition(b"\r\n\r\n")
        size = int(head.rpartition(b"Content-Length: ")[2])
        assert head.startswith(b"WARC/1.1\r\n") and rest[size : size + 4] == b"\r\n\r\n"
        data, found = rest[size + 4 :], found + 1
    assert found == len(rows)
    large = fresh_folder(spark)
    warc.write_archive(pages, large, least_bytes=5)
    assert warc.read_archive(spark, large).where("record_type = 'revisit'").count() == 2
    empty = fresh_folder(spark)
    warc.write_archive(pages.where("false"), empty)
    assert warc.read_archive(spark, empty).count() == 0


def test_main_text_edges(spark):
    page = (
        "<html><head><title>x</title></head><body class='has-sidebar'><header><h1>Site</h1><nav><a href=/>Home</a></nav></header>"
        "<div class='cookie-notice'>We use cookies.</div><main><article><header><h1>Real title</h1></header><p>First &amp; more text here."
        "<p>Second with <a href=x>link</a> text.</p><aside>Related</aside><form>Sign up <input></form>"
        "<section class='comments'><article><p>I am a reader comment, long enough to be prose.</p></article></section></article></main>"
        "<div id='sidebar'><p>Side text long enough to be prose, too.</p></div><footer>© 2020</footer></body></html>"
    )
    assert extract.main_text(page) == "Real title First & more text here. Second with link text."
    rows = spark.createDataFrame([(1, page, "t"), (2, None, "t"), (3, "", "t"), (4, "<p>cut off <", "t"), (5, "<p class='x>" * 300, "t")], "page_id long, html string, text string")
    found = {r["page_id"]: r["text"] for r in extract.extracted(prepared(spark) and rows).collect()}
    assert found[2] == found[3] == "" and found[4] == "cut off" and len(found) == 5
    assert extract.extracted(rows.where("false")).count() == 0


def test_minimum_cut_matches_all_labellings():
    draw = random.Random(5)
    for _ in range(60):
        n = draw.randint(1, 8)
        lean = [draw.uniform(-3, 3) for _ in range(n)]
        edges = [(a, b, draw.uniform(0, 2)) for a, b in itertools.combinations(range(n), 2) if draw.random() < 0.5]

        def cost(labels):
            own = sum(max(0, x) if not y else max(0, -x) for x, y in zip(lean, labels))
            return own + sum(w for a, b, w in edges if labels[a] != labels[b])

        best = min(cost(labels) for labels in itertools.product((False, True), repeat=n))
        assert abs(cost(extract.minimum_cut(lean, edges)) - best) < 1e-9


def test_url_rules(spark):
    rules = [("block", "net", "/"), ("allow", "a.net", "/x/ab"), ("block", "a.net", "/x/abc/"), ("block", "b.org", ""), ("allow", "b.org", "")]
    urls = [None, "", "no-scheme/a", "http://NET/", "http://q.a.net/x/abd", "http://a.net/x/abc/d?e://f", "ftp://bnet/", "https://b.org", "https://x.b.org?y/z", "http://a.net/x"]
    rows = spark.createDataFrame([(k, u, "clash") for k, u in enumerate(urls)], "page_id long, url string, rule string")
    found = [(r["host"], r["path"], r["rule"], r["verdict"]) for r in url_trie.judged(rows, rules).orderBy("page_id").collect()]
    assert found[:3] == [("", "", None, "allow")] * 3
    assert found[3] == ("net", "/", "net/", "block") and found[4][2:] == ("a.net/x/ab", "allow") and found[5][1:] == ("/x/abc/d", "a.net/x/abc/", "block")
    assert found[6][2] is None and found[7] == ("b.org", "", "b.org", "block") and found[8] == ("x.b.org", "", "b.org", "block") and found[9][2] == "net/"
    assert url_trie.judged(rows.where("false"), rules).count() == 0
    with pytest.raises(ValueError):
        url_trie.build([("deny", "a", "/")])


def test_url_rules_are_bounded_by_bytes(monkeypatch):
    rules = [("block", f"host{k}.org", "/" + "é" * 10) for k in range(5)]
    monkeypatch.setattr(url_trie, "MOST_BYTES", sum(len((h + p).encode()) for _, h, p in rules))
    url_trie.build(rules)
    with pytest.raises(ValueError):
        url_trie.build([*rules, ("allow", "a", "")])


def test_nearest_edges(spark):
    prepared(spark)
    vectors = [[1.0, 0.0], [1.0, 0.0], [0.0, 0.0], None, [float("nan"), 1.0], [None, 1.0], [0.5, 0.5], [-1.0, 0.0], [2.0, 0.0, 1.0]]
    rows = spark.createDataFrame([(k, v, 0) for k, v in enumerate(vectors)], "vec_id long, embedding array<double>, rank int")
    found = {}
    for r in ann.search(rows, rows, k=3).collect():
        found.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    assert found == {0: {1: (1, 1.0), 2: (6, 0.5), 3: (7, -1.0)}, 1: {1: (0, 1.0), 2: (6, 0.5), 3: (7, -1.0)}, 6: {1: (0, 0.5), 2: (1, 0.5), 3: (7, -0.5)}, 7: {1: (6, -0.5), 2: (0, -1.0), 3: (1, -1.0)}}
    assert ann.search(rows.where("false"), rows).count() == 0


def ranks(found):
    """Neighbours of every query in the order of their ranks."""
    return {q: list(zip(g["rank"], g["vec_id"], g["score"])) for q, g in found.toPandas().sort_values("rank", kind="stable").groupby("query_id")}


@pytest.mark.parametrize("block_rows", [4096, 16])
def test_nearest_counts_copies_of_a_row(spark, block_rows):
    prepared(spark)
    vectors = [(1, [1.0, 0.0])] + [(2, [1.0, 0.0])] * 25 + [(k, [1.0 - k / 100, 0.5]) for k in range(3, 18)]
    rows = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    found = ranks(ann.search(rows, rows.where("vec_id = 1"), k=20, block_rows=block_rows, wanted=1.0))
    assert found == {1: [(r, 2, 1.0) for r in range(1, 21)]}
    most = ranks(ann.search(rows, rows.where("vec_id = 1"), k=30, block_rows=block_rows, wanted=1.0))[1]
    assert [v for _, v, _ in most] == [2] * 25 + [3, 4, 5, 6, 7]
    # rows of the query's own id are not found; each of its rows is a query
    twins = ranks(ann.search(rows, rows.where("vec_id = 2"), k=2, block_rows=block_rows, wanted=1.0))[2]
    assert sorted(twins) == sorted([(1, 1, 1.0), (2, 3, 0.97)] * 25)


def test_nearest_takes_the_most_frequent_length(spark):
    prepared(spark)
    vectors = [(0, [9.0, 9.0, 9.0])] + [(k, [float(k), 1.0]) for k in range(1, 29)] + [(29, [1.0])]
    rows = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").coalesce(1).withColumn("size", F.lit("clash")).withColumn("row", F.lit(0))
    found = ranks(ann.search(rows, rows, k=3))
    assert set(found) == set(range(1, 29)) and found[1] == [(1, 28, 29.0), (2, 27, 28.0), (3, 26, 27.0)]
    assert ann.search(rows, rows.where("false")).count() == 0
    tiny = spark.createDataFrame([(0, [1e-200, 0.0]), (1, [1e200, 0.0]), (2, [1.0, 1.0])], "vec_id long, embedding array<double>")
    assert ranks(ann.search(tiny, tiny, k=1)) == {0: [(1, 1, 1.0)], 1: [(1, 2, 1e200)], 2: [(1, 1, 1e200)]}


def test_nearest_over_many_blocks(spark):
    prepared(spark)
    draw = np.random.default_rng(2)
    data = np.concatenate((draw.standard_normal((1500, 16)), np.repeat(draw.standard_normal((1, 16)), 700, axis=0)))
    rows = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(data)], "vec_id long, embedding array<double>")
    found = ann.search(rows, rows.where("vec_id % 20 = 0"), k=10, block_rows=200).toPandas()
    hit = 0
    for query, group in found.groupby("query_id"):
        assert len(group) == 10 and query not in set(group["vec_id"])
        score = data @ data[query]
        score[query] = -np.inf
        hit += (group["score"] >= np.sort(score)[-10] - 1e-9).sum()
    assert hit >= 0.9 * len(found)
    # one step in a group or all of them: the same blocks meet
    apart = ann.search(rows, rows.where("vec_id % 20 = 0"), k=10, block_rows=200, steps_together=1).toPandas()
    order = ["query_id", "rank"]
    assert apart.sort_values(order).to_numpy().tolist() == found.sort_values(order).to_numpy().tolist()
    # a single query leaves most blocks unvisited
    one = ann.search(rows, rows.where("vec_id = 40"), k=10, block_rows=100, wanted=0.1).toPandas()
    assert one["rank"].tolist() == list(range(1, 11)) and set(one["query_id"]) == {40}


@pytest.mark.parametrize("spread_out", [True, False])
def test_nearest_takes_the_orders_of_least_cost(spark, monkeypatch, spread_out):
    """Evenly spread vectors: few orders and a long reach. Tight groups: a short reach. Either way the wanted share is found."""
    prepared(spark)
    draw = np.random.default_rng(5)
    data = draw.standard_normal((2400, 24))
    if not spread_out:
        data = np.repeat(data[:100], 24, axis=0) + 0.01 * data
    rows = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(data)], "vec_id long, embedding array<double>")
    plans, measured = [], ann.measured_orders
    monkeypatch.setattr(ann, "measured_orders", lambda *given: plans.append(measured(*given)) or plans[-1])
    found = ann.search(rows, rows.where("vec_id % 20 = 0"), k=10, block_rows=100).toPandas()
    (orders, reach), = plans
    assert ann.LEAST_CURVES <= orders <= ann.CURVES and (reach > 6 if spread_out else reach <= 2)
    truth = 0
    for query, group in found.groupby("query_id"):
        assert group["vec_id"].is_unique and len(group) == 10
        score = data @ data[query]
        score[query] = -np.inf
        truth += (group["score"] >= np.sort(score)[-10] - 1e-9).sum()
    assert truth >= 0.9 * len(found)


def test_hilbert_curve_visits_neighbours():
    cells = np.array(list(itertools.product(range(8), repeat=3)))
    keys = ann.hilbert_keys(cells, 3)
    walk = cells[np.argsort(keys)]
    assert sorted(keys.tolist()) == list(range(512)) and (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def plain_components(words, radius):
    least = list(range(len(words)))
    for _ in words:
        for i, j in itertools.combinations(range(len(words)), 2):
            if sum((int(a) ^ int(b)).bit_count() for a, b in zip(words[i], words[j])) <= radius:
                least[i] = least[j] = min(least[i], least[j])
    return least


@pytest.mark.parametrize(("width", "front"), [(1, 1 << 20), (2, 64)])
def test_index_walk_matches_all_pairs(monkeypatch, width, front):
    monkeypatch.setattr(simhash, "FRONT", front)
    draw = np.random.default_rng(4)
    words = draw.integers(0, 1 << 63, (60, width), dtype=np.uint64)
    near = words[draw.integers(0, 60, 60)].copy()
    near[:, 0] ^= np.uint64(1) << draw.integers(0, 64, 60, dtype=np.uint64)
    words = np.unique(np.concatenate((words, near)), axis=0)
    rank = simhash.gray_rank(words)
    words = np.ascontiguousarray(words[np.lexsort([rank[:, k] for k in range(width - 1, -1, -1)])])
    group = np.zeros(len(words), dtype=np.int64)
    assert simhash.local_least(group, words, np.full(len(words), -1), 2).tolist() == plain_components(words, 2)


def test_gray_rank_is_the_place_in_the_sequence():
    codes = np.array([[k ^ (k >> 1)] for k in range(300)], dtype=np.uint64)
    assert simhash.gray_rank(codes)[:, 0].tolist() == list(range(300))
    two = 5 << 64 | 77
    code = two ^ (two >> 1)
    assert simhash.gray_rank(np.array([[code >> 64, code & (1 << 64) - 1]], dtype=np.uint64)).tolist() == [[5, 77]]


def test_pigeonhole_masks_miss_no_pair():
    draw = random.Random(8)
    masks = [m[0] & (1 << 64) - 1 for m in simhash.pigeonhole_masks(4)]
    for _ in range(500):
        flips = sum(1 << b for b in draw.sample(range(64), 4))
        assert any(not flips & m for m in masks)


def test_simhash_edges_and_blocks(spark, docs, none):
    rows = simhash.near_duplicates(docs).toPandas()
    assert len(rows) == len(TEXTS)  # all but the NULL id, the repeated row twice
    found = rows.drop_duplicates("doc_id").set_index("doc_id")["component"].to_dict()
    assert found[0] == found[1] == 0 and found[4] == found[5] == 4
    assert simhash.near_duplicates(none).count() == 0
    draw = random.Random(6)
    base = draw.getrandbits(64)
    prints = sorted({base ^ sum(1 << b for b in draw.sample(range(64), draw.randint(0, 4))) for _ in range(120)})
    classes = spark.createDataFrame([(k, simhash.signed(p)) for k, p in enumerate(prints)], "node long, w0 long")
    links = simhash.near_links(classes, 3, simhash.pigeonhole_masks(3), block=16)
    mine = {r["node"]: r["component"] for r in simhash.components(links).collect()}
    want = plain_components([[p] for p in prints], 3)
    assert {k: mine.get(k, k) for k in range(len(prints))} == dict(enumerate(want))


def test_components_of_long_chains(spark):
    chain = [(k, k + 1) for k in range(60)] + [(100, 101), (101, 100), (7, 7)]
    found = {r["node"]: r["component"] for r in simhash.components(spark.createDataFrame(chain, "node long, to long")).collect()}
    assert found == {k: 0 for k in range(1, 61)} | {101: 100}


def test_quality_edges(spark, docs, none):
    labels = spark.createDataFrame([(3, 1, 0), (4, 0, 0), (4, 1, 0), (6, 0, 0), (8, None, 1), (None, 1, 0)], "doc_id long, quality int, toxic int")
    machine = quality.fitted(docs, labels, F.lit(False))
    rows = quality.scored(docs, machine).toPandas()
    assert len(rows) == len(TEXTS) + 1 and rows["score"].between(0, 1).all()
    assert quality.scored(none, machine).count() == 0
    blank = quality.fitted(docs, labels.where("false"), F.lit(False)) if labels.where("false").count() else quality.train([])
    assert 0 <= blank.score("x") <= 1


def test_factorisation_machine_pairs():
    draw = np.random.default_rng(3)
    machine = quality.Machine(0.3, draw.normal(size=50), draw.normal(size=(50, 4)))
    index, value = np.array([3, 7, 20, 41]), np.array([1.0, 0.5, -2.0, 1.5])
    pairs = sum(machine.factor[index[i]] @ machine.factor[index[j]] * value[i] * value[j] for i, j in itertools.combinations(range(4), 2))
    assert abs(machine.raw(index, value) - (0.3 + machine.weight[index] @ value + pairs)) < 1e-9


def test_language_edges(spark, docs, none):
    rows = [(1, "Der Hund und die Katze sind nicht hier", "de"), (2, "The dog and the cat are not here", "en"), (3, "Собака и кошка не здесь", "ru"), (4, None, "en"), (5, "123 !", None)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fitted(table, F.lit(False))
    assert model.languages == ["de", "en", "ru"]
    found = langid.identified(docs.withColumn("lang_pred", F.lit("clash")), model).toPandas()
    assert len(found) == len(TEXTS) + 1 and found["score"].between(0, 1).all()
    assert set(found[found["text"].fillna("").str.strip() == ""]["lang_pred"]) == {"und"}
    spans = langid.spans(model, "the dog and the cat are here and not there. Собака и кошка здесь")
    assert [s[2] for s in spans] == ["en", "ru"] and spans[0][0] == 0
    assert langid.identified(none, model).count() == 0
    empty = langid.fitted(table.where("false"), F.lit(False))
    assert {r["lang_pred"] for r in langid.identified(docs, empty).collect()} == {"und"}


def test_viterbi_in_chunks_matches_one_pass():
    draw = np.random.default_rng(0)
    for _ in range(10):
        sizes = draw.integers(0, 200, 5)
        text, score = np.repeat(np.arange(5), sizes), draw.normal(0, 3, (int(sizes.sum()), 3)).astype(np.float32)
        label = langid.viterbi(score, text, 5, 4.0)
        for k in range(5):
            own, path = score[text == k].astype(float), label[text == k]
            if len(own):
                best = own[0].copy()
                for row in own[1:]:
                    best = row + np.maximum(best, best.max() - 4.0)
                assert abs(best.max() - (own[np.arange(len(path)), path].sum() - 4.0 * (path[1:] != path[:-1]).sum())) < 1e-3


def test_pipeline_stages_take_odd_rows(spark, docs, none, tmp_path):
    docs.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic")).write.parquet(str(tmp_path / "labels.parquet"))
    columns = ["doc_id", "text", "lang", "source", "n_chars", "score", "component"]
    for table in (docs.select(*columns), none.select(*columns)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, table, str(tmp_path)).columns == columns
    kept = corpus_pipeline.keep_distinct(spark, docs.select(*columns), str(tmp_path)).toPandas()
    assert kept["doc_id"].dropna().is_unique


def test_pipeline_keeps_different_texts_of_one_id(spark):
    draw = random.Random(2)
    a, b = (" ".join(str(draw.randrange(1000)) for _ in range(400)) for _ in range(2))
    rows = [(7, a), (7, b), (8, b + " more"), (None, a), (None, "alone here"), (9, None), (3, "")]
    texts = [simhash.simhash(t)[0] for _, t in rows]
    assert (texts[1] ^ texts[2]).bit_count() <= 4 < (texts[0] ^ texts[1]).bit_count()
    table = spark.createDataFrame(rows, "doc_id long, text string")
    kept = corpus_pipeline.keep_distinct(spark, table, "").collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in kept) == sorted([(7, a), (7, b), (0, "alone here"), (3, "")])


def test_pipeline_leaves_columns_as_they_are(spark, docs, tmp_path):
    docs.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic")).write.parquet(str(tmp_path / "labels.parquet"))
    table = docs.select("doc_id", "text", "lang", F.lit(5.0).alias("score"), F.lit(8).alias("predicted"), F.lit("zz").alias("lang_pred"), F.lit(3).alias("_row"), F.lit(4).alias("w0"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, table, str(tmp_path))
        assert out.columns == table.columns
        assert {tuple(r)[3:] for r in out.collect()} == {(5.0, 8, "zz", 3, 4)}


def test_halves_of_two_languages_score_as_half():
    words = {"de": "der hund und die katze sind nicht hier gewesen", "en": "the dog and the cat have not been here"}
    languages = sorted(words)
    triplets, scripts = np.zeros((2, langid.BUCKETS)), np.zeros((2, len(langid.SCRIPT_NAMES)))
    for k, name in enumerate(languages):
        bucket, _, _, _, script, _ = langid.words_of([words[name] + " "] * 20)
        np.add.at(triplets[k], bucket, 1)
        np.add.at(scripts[k], script, 1)
    model = langid.Model(languages, triplets, scripts)
    names, scores, _ = langid.labelled(model, [" ".join([words["de"]] * 9 + [words["en"]] * 9), words["de"]])
    assert scores[0] > 0.4 and scores[1] > 0.9 and names[1] == "de"
