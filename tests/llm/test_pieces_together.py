"""N-best segmentations of texts encoded together are those of each whole text."""

import random

import numpy as np
import pytest

from vulnloom.llm import pieces, tokens
from vulnloom.llm.queries import PIECES

SOME = ["la", "The", "thn", "aaaa", "éoß", ",", ".", " ", " ", "\n", "&", "9", "漢", "𝄞", "▁", "\x1f", "  "]


def of_whole_text(lattice, text, n):
    """The n best scores of a text's whole lattice."""
    found = lattice.n_best("▁" + text.replace(" ", "▁"), n) if text else [(0.0, ())]
    return [score for score, _ in found]


def test_texts_together_have_the_n_best_of_their_lattices(monkeypatch):
    monkeypatch.setattr(tokens, "SPAN", 7)
    rng = random.Random(9)
    texts = ["", " ", "a", "a.", "▁", "The cat.\nThe cat, the cat."] + ["".join(rng.choices(SOME, k=rng.randrange(12))).lstrip(",.") for _ in range(150)]
    own = pieces.Segmenter(PIECES, 4)
    for text, found in zip(texts, own.encode_all(texts)):
        assert [s for s, _ in found] == pytest.approx(of_whole_text(own.lattice, text, 4)), text
        score = {i: s for i, s in own.lattice.pieces.values()}
        for total, raw in found:
            ids = np.frombuffer(raw, "<u4").tolist()
            assert own.lattice.decode(ids) == text.replace("▁", " ")
            if not set(ids) & set(own.lattice.byte_of):
                assert sum(score[i] for i in ids) == pytest.approx(total)
    assert own.encode_all([]) == []


def test_two_best_are_the_first_of_n_best():
    lattice, rng = pieces.Lattice(PIECES), random.Random(10)
    for word in ["", "x", "𝄞", "漢"] + ["▁" + "".join(rng.choices("thenlaio漢", k=rng.randrange(1, 12))) for _ in range(200)]:
        ids, score, loss = lattice.two_best(word)
        best = lattice.n_best(word, 2)
        assert score == pytest.approx(best[0][0]) and lattice.decode(ids) == word.replace("▁", " ").removeprefix(" ")
        assert loss == (pytest.approx(best[0][0] - best[1][0]) if len(best) > 1 else np.inf)


def test_a_distinct_word_is_looked_up_once_for_all_texts(monkeypatch):
    asked = []
    own = pieces.Segmenter(PIECES, 4)
    look = own.two_best.get
    monkeypatch.setattr(type(own.two_best), "get", lambda self, word, *rest: asked.append(word) or look(word, *rest))
    own.encode_all(["the cat the cat"] * 50 + ["the dog"] * 50)
    assert sorted(asked) == sorted({"▁the", "▁cat", "▁dog"})
