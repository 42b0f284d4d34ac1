"""The whole merge-dropout query against a plain agenda over strings, with the same keyed hash in plain numbers."""

import re

import public_tokenizers
import sentencepiece

from ledgerloom.llm import merge_dropout, queries
from ledgerloom.llm.common import table
from tests.conftest import SMALL

MOST = (1 << 64) - 1


def mixed(x):
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & MOST
    x = (x ^ x >> 27) * 0x94D049BB133111EB & MOST
    return x ^ x >> 31


class Plain:
    def __init__(self, path):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        real = [i for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.piece = {model.id_to_piece(i): i for i in real}
        self.place = {i: (-model.get_score(i), i) for i in real}
        self.byte = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]

    def word(self, word, key, limit):
        # a space mark of the text itself is no space: it joins with nothing
        parts = [(k, k + 1, {" ": "▁", "▁": "\0"}.get(c, c)) for k, c in enumerate(word)]
        while True:
            least = None
            for k, ((start, middle, left), (_, end, right)) in enumerate(zip(parts, parts[1:])):
                found = self.piece.get(left + right)
                if found is None or mixed(key ^ mixed(start << 42 | middle << 21 | end)) < limit:
                    continue
                if least is None or self.place[found] < least[0]:
                    least = self.place[found], k
            if least is None:
                break
            k = least[1]
            parts[k : k + 2] = [(parts[k][0], parts[k + 1][1], parts[k][2] + parts[k + 1][2])]
        ids = []
        for start, end, text in parts:
            ids += [self.piece[text]] if text in self.piece else [self.byte[b] for b in word[start:end].encode()]
        return ids

    def text(self, text, row, rate, seed):
        salt = mixed(mixed(seed) ^ row & MOST)
        words = re.findall(" +[^ ]*", " " + text) if text else []
        return [i for at, word in enumerate(words) for i in self.word(word, mixed(salt + at & MOST), int(rate * 2.0**64))]


def test_segmentations_match_a_plain_agenda(spark):
    plain = Plain(public_tokenizers.path(queries.MERGE_MODEL))
    texts = {r["doc_id"]: r["text"] or "" for r in table(spark, SMALL, "documents").select("doc_id", "text").collect()}
    mine = {r["doc_id"]: r for r in queries.op5_merge_dropout(spark, SMALL).collect()}
    assert set(mine) == set(texts)
    for key, text in texts.items():
        ids = plain.text(text, key, merge_dropout.DROPOUT, merge_dropout.SEED)
        assert mine[key]["ids"] == ids and mine[key]["n_ids"] == len(ids)


def test_odd_texts_and_rates_match_a_plain_agenda():
    path = public_tokenizers.path(queries.MERGE_MODEL)
    plain, m = Plain(path), merge_dropout.Model(path)
    texts = ["", " ", "  a  b ", "▁x ▁▁ <s> 日本語 🎉\n\n  end ", "x" * 130, "internationalisation " * 8, "\x00 é"]
    for rate in (0.0, 0.1, 0.7, 1.0):
        for seed in (1, 77):
            ids, counts = merge_dropout.encode(m, texts, list(range(len(texts))), dropout=rate, seed=seed)
            want = [plain.text(t, k, min(rate, 1 - 2.0**-53), seed) for k, t in enumerate(texts)]
            assert ids.tolist() == [i for w in want for i in w] and counts.tolist() == [len(w) for w in want]
