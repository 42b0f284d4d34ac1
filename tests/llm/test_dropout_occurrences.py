"""Merge-dropout of single occurrences."""

import numpy as np
import public_tokenizers

from ledgerloom.llm import merge_dropout

MERGES = public_tokenizers.path("piece_bpe_32k.model")


def cut(ids, counts):
    ends = np.cumsum(counts)
    return [tuple(ids[e - n : e].tolist()) for e, n in zip(ends, counts)]


def test_every_occurrence_has_its_own_segmentation():
    m = merge_dropout.Model(MERGES)
    found = cut(*merge_dropout.encode(m, ["internationalisation"] * 400, list(range(400))))
    assert len(set(found)) > 30
    # a word of one merge is left whole in 0.9 of its occurrences, wherever they stand
    whole = cut(*merge_dropout.encode(m, ["a"], [1], dropout=0.0))[0]
    assert len(whole) == 1
    one = cut(*merge_dropout.encode(m, [" ".join(["a"] * 4000)], [5]))[0]
    assert abs((np.array(one) == whole[0]).sum() / 4000 - 0.9) < 0.02


def test_memory_changes_no_occurrence():
    m = merge_dropout.Model(MERGES)
    texts = ["the quick  brown fox " * 50 + "x" * 200, "", "jumps over the lazy dogs 日本語 " * 30]
    keys, words = [], []
    for row, text in zip((3, 4, 9), texts):
        own = merge_dropout.WORDS.findall(" " + text) if text else []
        salt = merge_dropout.mixed(np.array([merge_dropout.SEED], dtype=np.uint64))
        keys.append(merge_dropout.mixed(merge_dropout.mixed(salt ^ np.uint64(row)) + np.arange(len(own), dtype=np.uint64)))
        words += own
    want, _ = merge_dropout.segment(m, words, np.concatenate(keys), int(0.1 * 2.0**64))
    assert merge_dropout.encode(m, texts, [3, 4, 9])[0].tolist() == want.tolist()
