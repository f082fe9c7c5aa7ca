"""Texts encoded together: every distinct word is looked up once, new words are encoded in one call."""

import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from vulnloom.llm import packing, tokens
from vulnloom.llm.queries import BYTE_BPE, WORD_BPE

ODD = ["a  b   c\n\n d \t e\r\n'sX it's  ", "  lead", "trail  ", "\n", "a b c", "é ́x", "<|endoftext|>x", "ΑΣ Σ İ ǅ", "a\x1cb",
       "\x1f", "x.,y!,z. a,b.c", "don't 'S 3,000.5 ² œ, ª.", "one, two. one two one.\ntwo,", "LA!! la&&& lá!", " , . a ,b", ",a.", "</w> a", "",
       "é, Å. ssßªµ", "a_b a`b [c]{d}~ $$$. %%%,", "x" * 60]


def whole_ids(path, texts):
    whole = Tokenizer.from_file(path)
    whole.encode_special_tokens = True
    return [np.array(whole.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


@pytest.mark.parametrize("path, spaced", [(WORD_BPE, False), (BYTE_BPE, True)])
def test_ids_of_texts_together_are_those_of_whole_texts(path, spaced):
    rng = random.Random(5)
    some = ["la", "The", "thn", "éoß", ",", ".", "'", "'s", " ", "\n", "&&&", "9", "語", "́", "\xa0"]
    texts = ODD + ["".join(rng.choices(some, k=rng.randrange(40))) for _ in range(400)]
    encoder = tokens.Encoder(path, spaced)
    for _ in range(2):
        assert encoder.encode_all(texts) == whole_ids(path, texts)
    assert encoder.encode_all([]) == [] and encoder.encode_all(["", ""]) == [b"", b""]


def test_new_words_are_encoded_in_one_call(monkeypatch):
    single = []
    monkeypatch.setattr(tokens.Encoder, "whole", lambda self, text: single.append(text))
    words = ["".join(random.Random(i).choices("abcénst", k=9)) for i in range(500)]
    texts = [" ".join(words), ". ".join(w.title() for w in words), " ".join(f"{w}&&&" for w in words[:50]) + " end"]
    encoder = tokens.Encoder(WORD_BPE, False)
    got = encoder.encode_all(texts)
    assert not single and got == whole_ids(WORD_BPE, texts)


def test_a_word_before_a_mark_is_the_same_word():
    encoder = tokens.Encoder(BYTE_BPE, True)
    assert encoder.encode_all(["x alpha alpha, alpha.\nalpha alpha,x"]) == whole_ids(BYTE_BPE, ["x alpha alpha, alpha.\nalpha alpha,x"])
    assert {w for w in encoder.ids if "alpha" in w} == {"alpha", "\x1falpha"}


def test_pieces_of_documents_are_those_of_their_ids(spark):
    texts = [(i, t) for i, t in enumerate(ODD)] + [(99, None)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    ids = dict(zip(range(len(ODD)), whole_ids(WORD_BPE, ODD))) | {99: b""}
    got = {r.doc_id: r.length for r in packing.cut(docs, WORD_BPE).collect()}
    assert got == {i: len(own) // 4 + 1 for i, own in ids.items()}
