import re

import numpy as np
from cases import edge_texts, words

from winnow.llm import words as W

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))


def test_words_are_those_of_the_pattern():
    texts = edge_texts() + ["A\x0bB\x0cC\x1cD", "x\u00a0y \u3000 z", "HeLLo hello"]
    _, _, _, keys, first = W.batch_words(texts)
    by_word = {}
    for i, t in enumerate(texts):
        own = keys[first[i] : first[i + 1]]
        assert len(own) == len(plain(t))
        for w, k in zip(plain(t), own.tolist()):
            assert by_word.setdefault(w, k) == k
    assert len(set(by_word.values())) == len(by_word)


def test_hash_does_not_depend_on_the_batch(monkeypatch):
    text = words(3, 5000)
    whole = W.batch_words([text])[3]
    monkeypatch.setattr(W, "CHUNK", 100)
    assert (W.batch_words(["other", text])[3][1:] == whole).all()


def test_shingles():
    keys = W.batch_words(["a b c d e f", "a b c d e", "x y"])[3]
    assert len(W.shingles(keys[:6], 5)) == 2
    assert W.shingles(keys[:6], 5)[0] == W.shingles(keys[6:11], 5)[0]
    assert len(W.shingles(keys[11:], 5)) == 1 and not len(W.shingles(keys[:0], 5))
    assert W.shingles(np.array([1, 2], np.uint64), 5)[0] != W.shingles(np.array([2, 1], np.uint64), 5)[0]
