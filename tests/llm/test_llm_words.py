"""Word and shingle hashes against plain Python."""

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import alnum, prose, spaced

from layerstar.llm import words as W

TEXTS = ["", None, "a", "A a\tb  B", "  ", prose(3, 40), "x" * 5000, "é è É ß 数据", "a-b_c 9!x", prose(4, 900), "end"]


@pytest.mark.parametrize("kept, plain", [(W.SPACED, spaced), (W.ALNUM, alnum)])
@pytest.mark.parametrize("group", [64, 1 << 19])
def test_hashes_follow_the_words(kept, plain, group, monkeypatch):
    monkeypatch.setattr(W, "GROUP_BYTES", group)
    got = []
    for g in W.word_groups(pa.array(TEXTS), kept):
        assert g.row == len(got)
        got += [g.hash[g.first[i]:g.first[i + 1]] for i in range(len(g))]
    names = {}
    assert len(got) == len(TEXTS)
    for text, hashes in zip(TEXTS, got, strict=True):
        words = plain(text)
        assert len(words) == len(hashes)
        for w, h in zip(words, hashes.tolist(), strict=True):
            assert names.setdefault(w, h) == h
    assert len(set(names.values())) == len(names)


def test_shingles():
    (g,) = W.word_groups(pa.array(["a b c d e f", "a b", None, "b c d e f", "A  B"]), W.SPACED)
    value, first = W.shingles(g, 5)
    assert np.diff(first).tolist() == [2, 1, 0, 1, 1]
    assert value[first[0] + 1] == value[first[3]]          # b c d e f
    assert value[first[1]] == value[first[4]]              # a b, the whole text
    assert len(set(value.tolist())) == 3


def test_slices_of_a_batch():
    texts = pa.array(TEXTS).slice(3, 5)
    assert sum(len(g.hash) for g in W.word_groups(texts, W.SPACED)) == sum(len(spaced(t)) for t in TEXTS[3:8])
    assert list(W.word_groups(pa.array([], pa.string()), W.SPACED)) == []


def test_a_long_text_in_pieces(monkeypatch):
    text = prose(5, 3000) + " " + "y" * 300 + "  " + prose(6, 50)
    (whole,) = W.word_groups(pa.array([text]), W.SPACED)
    monkeypatch.setattr(W, "GROUP_BYTES", 100)
    first, second = W.word_groups(pa.array([text, "a b"]), W.SPACED)
    for name in ("hash", "begin", "end", "first", "data", "text_at"):
        assert np.array_equal(getattr(whole, name), getattr(first, name)), name
    assert len(second.hash) == 2
