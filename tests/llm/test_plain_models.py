"""Whole queries of the learned operators against plain versions: pairs one by one, words and paths step by step."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import langid, quality, queries
from ledgerloom.llm.common import table
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def texts(spark):
    rows = table(spark, SMALL, "documents").select("doc_id", "text").collect()
    return {r["doc_id"]: r["text"] for r in rows}


def plain_inputs(text):
    """Input numbers and values, as a dictionary."""
    words = (text or "").encode().split()
    counts = Counter(words)
    length = math.sqrt(sum(math.log(1 + n) ** 2 for n in counts.values()))
    inputs = [(zlib.crc32(w) % quality.WORD_BUCKETS, math.log(1 + n) / length) for w, n in counts.items()]
    found = quality.statistics((text or "").encode(), words, counts)
    for k, (name, most) in enumerate(quality.STATISTICS.items()):
        step = min(quality.STEPS - 1, int(math.sqrt(max(0.0, found[name] / most)) * quality.STEPS))
        inputs.append((quality.WORD_BUCKETS + k * quality.STEPS + step, 1.0))
    return inputs


def test_quality_scores_match_the_sum_over_all_pairs(spark, texts):
    docs, labels = table(spark, SMALL, "documents"), table(spark, SMALL, "labels")
    machine = quality.fitted(docs, labels, quality.held_out())
    mine = {r["doc_id"]: r for r in queries.op9_quality(spark, SMALL).collect()}
    assert set(mine) == set(texts)
    for key, text in texts.items():
        inputs = plain_inputs(text)
        rows = np.array([machine.factor[i].astype(float) * x for i, x in inputs])
        pairs = sum(float(rows[i + 1 :].dot(rows[i]).sum()) for i in range(len(rows)))
        raw = machine.bias + sum(float(machine.weight[i]) * x for i, x in inputs) + pairs
        score = 1 / (1 + math.exp(-max(-30.0, min(30.0, raw))))
        assert abs(mine[key]["score"] - score) < 1e-5
        assert mine[key]["predicted"] == int(mine[key]["score"] >= 0.3)


def plain_words(text):
    """Runs of letters, each a list of (letter before, letter, letter after), 0 where there is none."""
    low = [c.lower() if len(c.lower()) == 1 else c for c in text]
    code = [ord(c) if c.isalpha() else 0 for c in low]
    words, open_ = [], False
    for k, c in enumerate(code):
        if c:
            if not open_:
                words.append([])
            words[-1].append((code[k - 1] if k else 0, c, code[k + 1] if k + 1 < len(code) else 0))
        open_ = bool(c)
    return words


def plain_bucket(triple):
    most = (1 << 64) - 1
    mixed = sum(c * odd for c, odd in zip(triple, (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))) & most
    mixed ^= mixed >> 29
    return (mixed * 0xBF58476D1CE4E5B9 & most) >> 64 - (langid.BUCKETS - 1).bit_length()


def plain_path(scores, switch):
    """Best path by plain dynamic programming."""
    best, back = scores[0].astype(float), []
    for row in scores[1:]:
        top = int(best.argmax())
        stays = best >= best[top] - switch
        back.append(np.where(stays, np.arange(len(best)), top))
        best = np.maximum(best, best[top] - switch) + row
    path = [int(best.argmax())]
    for came in reversed(back):
        path.append(int(came[path[-1]]))
    return path[::-1], float(best.max())


def path_cost(scores, path, switch):
    return sum(float(row[s]) for row, s in zip(scores, path)) - switch * sum(a != b for a, b in zip(path, path[1:]))


def test_languages_match_word_by_word_decoding(spark, texts):
    model = langid.fitted(table(spark, SMALL, "documents"), langid.held_out())
    mine = {r["doc_id"]: r for r in queries.op10_language(spark, SMALL).collect()}
    assert set(mine) == set(texts) and len(model.languages) > 1
    for key, text in texts.items():
        words = plain_words(text or "")
        if not words:
            assert (mine[key]["lang_pred"], mine[key]["score"]) == ("und", 0.0)
            continue
        scores = []
        for word in words:
            total = sum(model.table[plain_bucket(t)].astype(float) for t in word)
            total = np.clip(total - total.max(), -langid.WORD_BOUND, 0)
            script = max(k for k, (start, _) in enumerate(langid.SCRIPTS) if start <= word[0][1])
            open_ = model.open[langid.SCRIPT_NAMES.index(langid.SCRIPTS[script][1])]
            scores.append(np.where(open_, total, -2 * langid.WORD_BOUND))
        path, most = plain_path(scores, langid.SWITCH)
        assert abs(path_cost(scores, path, langid.SWITCH) - most) < 1e-6
        letters = np.zeros(len(model.languages))
        for word, state in zip(words, path):
            letters[state] += len(word)
        best = int(letters.argmax())
        inside = np.sum([row for row, state in zip(scores, path) if state == best], axis=0)
        lead = inside[best] - np.delete(inside, best).max()
        score = letters[best] / letters.sum() / (1 + math.exp(-max(-30, min(30, lead))))
        assert mine[key]["lang_pred"] == model.languages[best] and abs(mine[key]["score"] - score) < 1e-3


def test_language_spans_cover_the_words(spark):
    model = langid.fitted(table(spark, SMALL, "documents"), F.lit(False))
    assert langid.spans(model, "") == langid.spans(model, "123 !") == []
    text = "the of and to in is that it was for"
    spans = langid.spans(model, text)
    assert spans[0][0] == 0 and spans[-1][1] == len(text)
