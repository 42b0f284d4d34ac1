"""Language identification with spans.

The script of a word (ranges of code points) narrows the languages to those met in that script when learning. Letter
triplets of the word, hashed, give each of them a score; Viterbi decoding over the words of a text, with a penalty for
every switch, labels spans of one language. The language with the most letters in its spans is the text's, and the score
is the share of those letters, weakened where its words hardly prefer it.

Decoding runs in chunks: the best scores from every language at a chunk's start to every language at its end are found
for all chunks of a batch at once, the chunks of a text are then chained, and the path is read back. A text of any
length takes the same steps per word.

It learns triplet counts from a bounded sample: per language the PER_LANGUAGE rows of smallest hash outside the held-out
fold, whole texts. NULL texts and texts without a letter are `und` with score 0. A learned table of no rows gives `und`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import crc_fold, per_process, pieces, written

#: Rows of each language that the model learns from at most; languages at most.
PER_LANGUAGE, MOST_LANGUAGES = 600, 256
BUCKETS = 1 << 15
#: Penalty of a switch, in natural units of a word's score; bounds of what one word can say.
SWITCH, WORD_BOUND = 9.0, 6.0
CHUNK = 64
#: Characters worked on at once.
PIECE = 1 << 20
UNKNOWN = "und"
# fixed values: first code points of ranges of scripts, each up to the next
SCRIPTS = [
    (0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"), (0x0600, "Arabic"), (0x0700, "Other"),
    (0x0900, "Devanagari"), (0x0980, "Bengali"), (0x0A00, "Gurmukhi"), (0x0A80, "Gujarati"), (0x0B00, "Other"), (0x0B80, "Tamil"), (0x0C00, "Telugu"),
    (0x0C80, "Kannada"), (0x0D00, "Malayalam"), (0x0D80, "Sinhala"), (0x0E00, "Thai"), (0x0E80, "Lao"), (0x0F00, "Tibetan"), (0x1000, "Myanmar"),
    (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Ethiopic"), (0x13A0, "Other"), (0x1780, "Khmer"), (0x1800, "Mongolian"), (0x18B0, "Other"),
    (0x1E00, "Latin"), (0x1F00, "Greek"), (0x2000, "Other"), (0x2C60, "Latin"), (0x2C80, "Other"), (0x3040, "Kana"), (0x3100, "Han"), (0x3130, "Hangul"),
    (0x3190, "Han"), (0xA000, "Other"), (0xA720, "Latin"), (0xA800, "Other"), (0xAC00, "Hangul"), (0xD7B0, "Other"), (0xF900, "Han"), (0xFB00, "Latin"),
    (0xFB13, "Other"), (0xFB50, "Arabic"), (0xFE00, "Other"), (0xFF21, "Latin"), (0xFF66, "Kana"), (0xFFA0, "Other"), (0x20000, "Han"), (0x32000, "Other"),
]
SCRIPT_NAMES = sorted({name for _, name in SCRIPTS})
SCRIPT_STARTS = np.array([start for start, _ in SCRIPTS])
SCRIPT_OF = np.array([SCRIPT_NAMES.index(name) for _, name in SCRIPTS])


def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return per_process("letters", lambda: np.array([chr(c).isalpha() for c in range(0x110000)]))


def words_of(texts: list[str]):
    """Letters of all texts, lowered: hash of the triplet around each, its word; of each word: text, first letter, size,
    place of its first and last letter in the joined texts."""
    joined = "\n".join(texts)
    low = joined.lower()
    if len(low) != len(joined):  # a few letters grow when lowered; those stay as they are
        low = "".join(c if len(c.lower()) != 1 else c.lower() for c in joined)
    code = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    is_letter = letters()[code]
    code = np.where(is_letter, code, 0)
    padded = np.concatenate(([0], code, [0])).astype(np.uint64)
    triple = padded[:-2] * np.uint64(0x9E3779B97F4A7C15) + padded[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + padded[2:] * np.uint64(0x165667B19E3779F9)
    triple ^= triple >> np.uint64(29)
    triple *= np.uint64(0xBF58476D1CE4E5B9)
    at = np.flatnonzero(is_letter)
    bucket = (triple[at] >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)
    opens = np.flatnonzero(np.diff(at, prepend=-2) != 1)
    sizes = np.diff(np.concatenate((opens, [len(at)])))
    start = at[opens]
    ends = np.cumsum([len(t) + 1 for t in texts])
    text = np.searchsorted(ends, start, side="right")
    script = SCRIPT_OF[np.searchsorted(SCRIPT_STARTS, code[start], side="right") - 1]
    return bucket, opens, sizes, text, script, start - (ends[text] - np.array([len(t) + 1 for t in texts])[text] if len(texts) else 0)


class Model:
    """Languages, score of each triplet bucket per language, languages by script."""

    def __init__(self, languages: list[str], triplets: np.ndarray, scripts: np.ndarray):
        """triplets: counts by language and bucket; scripts: counts of words by language and script."""
        self.languages = languages
        smooth = triplets.astype(np.float64) + 0.5
        share = np.log(smooth / smooth.sum(axis=1, keepdims=True))
        middle = share.mean(axis=0) if languages else 0.0
        self.table = np.ascontiguousarray((share - middle).T.astype(np.float32))
        wide = scripts / np.maximum(1, scripts.sum(axis=1, keepdims=True)) >= 0.02
        # a script that no language was learned in leaves all open
        self.open = np.where(wide.any(axis=0), wide, True).T

    def word_scores(self, bucket, opens, script) -> np.ndarray:
        if not len(opens):
            return np.empty((0, len(self.languages)), dtype=np.float32)
        score = np.add.reduceat(self.table[bucket], opens, axis=0)
        score = np.clip(score - score.max(axis=1, keepdims=True), -WORD_BOUND, 0)
        return np.where(self.open[script], score, -2 * WORD_BOUND).astype(np.float32)


def viterbi(score: np.ndarray, text: np.ndarray, texts: int, switch: float = SWITCH) -> np.ndarray:
    """Language of every word: the best path of its text, where each switch costs `switch`. Words come by text."""
    n, size = score.shape
    if not n:
        return np.empty(0, dtype=np.int64)
    per_text = np.bincount(text, minlength=texts)
    chunks = -(-per_text // CHUNK)
    total = int(chunks.sum())
    chunk_text = np.repeat(np.arange(texts), chunks)
    rank = np.arange(total) - np.repeat(np.cumsum(chunks) - chunks, chunks)
    first = (np.cumsum(per_text) - per_text)[chunk_text] + rank * CHUNK
    length = np.minimum(CHUNK, per_text[chunk_text] - rank * CHUNK)
    order = np.argsort(-length, kind="stable")
    first, length = first[order], length[order]
    lasting = np.array([np.count_nonzero(length > t) for t in range(CHUNK)])
    # best from language a at the first word of a chunk to language b at its latest word
    gain = np.full((total, size, size), -1e9, dtype=np.float32)
    gain[:, np.arange(size), np.arange(size)] = score[first]
    for t in range(1, CHUNK):
        k = lasting[t]
        if not k:
            break
        now = gain[:k]
        gain[:k] = np.maximum(now, now.max(axis=2, keepdims=True) - switch) + score[first[:k] + t][:, None, :]
    place = np.empty(total, dtype=np.int64)
    place[order] = np.arange(total)
    # chain the chunks of each text: best score that ends in each language
    head = np.cumsum(chunks) - chunks
    best = np.full((texts, size), 0.0)
    entered, left_from = np.zeros((total, size), dtype=np.int64), np.zeros((total, size), dtype=np.int64)
    deep = int(chunks.max())
    by_depth = np.argsort(-chunks, kind="stable")
    alive = np.array([np.count_nonzero(chunks > d) for d in range(deep)])
    for d in range(deep):
        some = by_depth[: alive[d]]
        chunk = place[head[some] + d]
        if d:
            top = best[some].argmax(axis=1)
            jump = np.take_along_axis(best[some], top[:, None], axis=1) - switch
            start = np.maximum(best[some], jump)
            left_from[chunk] = np.where(best[some] >= jump, np.arange(size), top[:, None])
        else:
            start = np.zeros((len(some), size))
        through = start[:, :, None] + gain[chunk]
        entered[chunk] = through.argmax(axis=1)
        best[some] = through.max(axis=1)
    # read the path back, chunk by chunk, then inside all chunks at once
    end_state, start_state = np.zeros(total, dtype=np.int64), np.zeros(total, dtype=np.int64)
    state = best.argmax(axis=1)
    for d in range(deep - 1, -1, -1):
        some = by_depth[: alive[d]]
        chunk = place[head[some] + d]
        end_state[chunk] = state[some]
        start_state[chunk] = entered[chunk, state[some]]
        state[some] = left_from[chunk, start_state[chunk]]
    # where each language came from, now that the language at a chunk's first word is known
    row = np.arange(total)
    walk = np.full((total, size), -1e9, dtype=np.float32)
    walk[row, start_state] = score[first, start_state]
    came = np.zeros((CHUNK, total, size), dtype=np.int16)
    for t in range(1, CHUNK):
        k = lasting[t]
        if not k:
            break
        now = walk[:k]
        top = now.argmax(axis=1)[:, None]
        jump = np.take_along_axis(now, top, axis=1) - switch
        came[t, :k] = np.where(now >= jump, np.arange(size), top)
        walk[:k] = np.maximum(now, jump) + score[first[:k] + t]
    label = np.empty(n, dtype=np.int64)
    current = end_state.copy()
    for t in range(CHUNK - 1, -1, -1):
        k = lasting[t]
        if k:
            label[first[:k] + t] = current[:k]
            if t:
                current[:k] = came[t, row[:k], current[:k]]
    return label


def labelled(model: Model, texts: list[str]):
    """(predictions, scores, per text a list of spans (start, words, letters, language))."""
    bucket, opens, sizes, text, script, start = words_of(texts)
    size, n = len(model.languages), len(texts)
    if not size:
        return [UNKNOWN] * n, [0.0] * n, None
    score = model.word_scores(bucket, opens, script)
    label = viterbi(score, text, n)
    weight = np.bincount(text * size + label, weights=sizes, minlength=n * size).reshape(n, size)
    letters_ = weight.sum(axis=1)
    best = weight.argmax(axis=1)
    rows = np.arange(n)
    share = weight[rows, best] / np.maximum(1, letters_)
    # how far the words of the best language's spans leave the second language behind, per text
    inside = label == best[text]
    total = np.stack([np.bincount(text[inside], weights=score[inside, k], minlength=n) for k in range(size)], axis=1)
    lead = total[rows, best] - np.where(np.arange(size) == best[:, None], -np.inf, total).max(axis=1) if size > 1 else np.full(n, 30.0)
    sure = 1 / (1 + np.exp(-np.clip(lead, -30, 30)))
    names = [model.languages[b] if c else UNKNOWN for b, c in zip(best, letters_)]
    return names, np.where(letters_ > 0, share * sure, 0.0).tolist(), (label, text, start, sizes)


def fitted(docs: DataFrame, fold: Column, text: str = "text", lang: str = "lang", key: str = "doc_id", per_language: int = PER_LANGUAGE) -> Model:
    """Model learned from rows outside the held-out fold (`fold` is true there) that have a language."""
    known = docs.select(F.col(lang).alias("_lang"), F.col(key).cast("long").alias("_key"), F.col(text).alias("_text"), fold.alias("_held"))
    ids = known.where(F.col("_lang").isNotNull() & F.col("_text").isNotNull() & ~F.col("_held")).select("_lang", "_key")
    # a language's rows of small hash, about four times as many as wanted, stand for it: what reaches the task that
    # ranks them does not grow with the corpus
    sizes = ids.groupBy("_lang").agg(F.count("*").alias("_rows"))
    if sizes.count() > MOST_LANGUAGES:
        raise ValueError(f"over {MOST_LANGUAGES} languages")
    few = ids.join(F.broadcast(sizes), "_lang").where(
        F.pmod(F.xxhash64("_key"), F.lit(1 << 40)) <= F.lit(4.0 * per_language) / F.col("_rows") * F.lit(float(1 << 40))
    )
    order = Window.partitionBy("_lang").orderBy(F.pmod(F.xxhash64("_key"), F.lit(1 << 40)), "_key")
    ranked = few.select("_lang", "_key").distinct().withColumn("_rank", F.row_number().over(order))
    chosen = written(ranked.where(F.col("_rank") <= per_language).drop("_rank"))

    def count(batches: Iterator[pd.DataFrame]):
        for frame in batches:
            for name, group in frame.groupby("_lang"):
                texts = group["_text"].tolist()
                for a, b in pieces(texts, PIECE):
                    bucket, _, _, _, script, _ = words_of(texts[a:b])
                    for kind, found in (("t", bucket), ("s", script)):
                        place, times = np.unique(found, return_counts=True)
                        yield pd.DataFrame({"lang": name, "kind": kind, "place": place, "times": times})

    sample = known.where(~F.col("_held")).join(F.broadcast(chosen), ["_lang", "_key"]).select("_lang", "_text")
    counts = sample.mapInPandas(count, "lang string, kind string, place long, times long").groupBy("lang", "kind", "place").agg(F.sum("times").alias("times"))
    # at most MOST_LANGUAGES x (buckets + scripts) numbers
    table = counts.toPandas()
    languages = sorted(table["lang"].unique())
    number = {name: k for k, name in enumerate(languages)}
    triplets, scripts = np.zeros((len(languages), BUCKETS)), np.zeros((len(languages), len(SCRIPT_NAMES)))
    for into, kind in ((triplets, "t"), (scripts, "s")):
        part = table[table["kind"] == kind]
        into[part["lang"].map(number).to_numpy(dtype=np.int64), part["place"].to_numpy(dtype=np.int64)] = part["times"].to_numpy()
    return Model(languages, triplets, scripts)


def identified(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All columns of the rows with lang_pred and score, the share of letters in spans of that language times the certainty
    of those spans. Columns of these names are replaced; without a learned language every row is `und`, score 0."""
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.table, model.open))

    @F.pandas_udf("lang_pred string, score double")
    def run(column):
        model_ = Model.__new__(Model)
        model_.languages, model_.table, model_.open = shared.value
        texts, names, scores = [t or "" for t in column], [], []
        # a chunk's table grows with the square of the languages
        for a, b in pieces(texts, PIECE // max(1, len(model_.languages) ** 2 // 1024)):
            name, score, _ = labelled(model_, texts[a:b])
            names += name
            scores += score
        return pd.DataFrame({"lang_pred": names, "score": scores})

    kept = docs.drop("lang_pred", "score")
    return kept.withColumn("_found", run(F.col(text).cast("string"))).select("*", "_found.lang_pred", "_found.score").drop("_found")


def spans(model: Model, text: str) -> list[tuple[int, int, str]]:
    """(start, end, language) of the runs of words of one language in a text, in code points."""
    _, _, found = labelled(model, [text])
    if found is None or not len(found[0]):
        return []
    label, _, start, sizes = found
    out = []
    for k, a, n in zip(label.tolist(), start.tolist(), sizes.tolist()):
        if out and out[-1][2] == model.languages[k]:
            out[-1] = (out[-1][0], a + n, model.languages[k])
        else:
            out.append((a, a + n, model.languages[k]))
    return out


def held_out(key: str = "doc_id", folds: int = 3) -> Column:
    return F.coalesce(crc_fold(key, folds) == 1, F.lit(False))
