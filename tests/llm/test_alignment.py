"""Cross-tokenizer alignment against the two libraries over whole texts."""

import hashlib
import random
from bisect import bisect_left
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from vulnloom.llm import alignment
from vulnloom.llm.queries import BYTE_BPE, PIECES

DOCS = "doc_id long, text string, name string, copies string, block int, pair int, n_a int, `a.b` int"
ODD = ["a  b   c\n\n d \t e\r\n", "  lead", "trail  ", "trail ", "\nline", "line\n", "a\nb", "é ́x", "<|endoftext|>x <s> </s> <unk>", "x▁y z",
       "▁", "a\x1cb", "\x1f", "a\x00b", "don't 'S 3,000.5 ² œ, ª.", "語" * 30, "😀 👩‍👩‍👧 ﬁ ２", " ", "\n", "<0x0A> <0x41>", "a\xa0b", "ab" * 300,
       "\x85", "x y", "I'll we've", "é ́", "１２ ⅷ"]


def brute(docs):
    """Documents as (doc_id, text), one row each, by the two libraries on whole texts."""
    a_tok, b_tok = Tokenizer.from_file(BYTE_BPE), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    a_tok.encode_special_tokens = True
    shown = [b for b in range(256) if chr(b).isprintable() and b != 32 and b != 0xAD]
    hidden = [b for b in range(256) if b not in shown]
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    links, out, held = [], [], Counter()
    for _, text in docs:
        links.append([])
        out.append((0, 0, 0, 0, ""))
        if not text:
            continue
        a, b = a_tok.encode(" " + text, add_special_tokens=False).ids, b_tok.encode(text)
        a_bytes = [bytes(byte_of[c] for c in a_tok.id_to_token(i)) for i in a]
        b_bytes = [bytes([int(b_tok.id_to_piece(i)[3:5], 16)]) if b_tok.is_byte(i) else b_tok.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
            continue
        ends = [set(np.cumsum(list(map(len, x))).tolist()) for x in (a_bytes, b_bytes)]
        cuts = sorted(ends[0] & ends[1])
        groups = {end: ([], []) for end in cuts}
        for side, (ids, parts) in enumerate(((a, a_bytes), (b, b_bytes))):
            for i, end in zip(ids, np.cumsum(list(map(len, parts)))):
                groups[cuts[bisect_left(cuts, end)]][side].append(i)
        links[-1] = [(i, j) for own, other in groups.values() for i in own for j in other]
        held.update(set(links[-1]))
        said = ";".join(f"{','.join(map(str, own))}|{','.join(map(str, other))}" for own, other in groups.values())
        out[-1] = (len(a), len(b), len(groups), len(links[-1]), hashlib.sha256(said.encode()).hexdigest())
    best = defaultdict(int)
    for (i, _), n in held.items():
        best[i] = max(best[i], n)
    return Counter((doc_id, *own[:4], sum(held[x] == best[x[0]] for x in linked), sum(held[x] for x in linked), own[4])
                   for (doc_id, _), own, linked in zip(docs, out, links))


def aligned(spark, docs, **more):
    rows = [(d, t, "n", "c", 1, 2, 3, 4) for d, t in docs]
    return Counter(tuple(r) for r in alignment.align(spark.createDataFrame(rows, DOCS).repartition(3), BYTE_BPE, PIECES, **more).collect())


def prose(rng, n):
    return "".join(rng.choice(["The", "hello", "world,", "token.", "naïve", "größer", "don't", "x1y2", "Thonthe"]) + rng.choice([" ", " ", " ", "\n"])
                   for _ in range(n)).strip()


@pytest.mark.parametrize("block", [1 << 22, 200])
def test_measures_are_those_of_whole_texts(spark, block):
    rng = random.Random(8)
    texts = [prose(rng, n) for n in (1, 2, 5, 30, 60)] + ODD + ["", None]
    texts += ["".join(rng.choices([*ODD, " ", "\n", "the "], k=rng.randrange(8))) for _ in range(40)]
    texts += [texts[3]] * 30 + [texts[4], f"{texts[3]} {texts[4]}"]
    docs = [(3 * i, t) for i, t in enumerate(texts)] + [(0, texts[0]), (0, texts[1]), (0, None)]
    assert aligned(spark, docs, block=block) == brute(docs)


def test_a_very_long_text(spark):
    docs = [(1, prose(random.Random(1), 40_000)), (2, "no white space" + "z" * 3000)]
    assert aligned(spark, docs) == brute(docs)


def test_rows_without_doc_id_take_no_part(spark):
    docs = [(None, "hello world"), (4, "hello world"), (None, None)]
    assert aligned(spark, docs) == brute(docs[1:2])


def test_an_empty_table_gives_no_rows(spark):
    assert not aligned(spark, [])


def test_texts_without_tokens_alone(spark):
    docs = [(1, None), (2, ""), (3, "▁x")]
    assert aligned(spark, docs) == Counter({(i, 0, 0, 0, 0, 0, 0, ""): 1 for i in (1, 2, 3)})


def test_words_give_the_same_as_their_text(monkeypatch):
    """Cut at single spaces and line ends or not, with memos that renew themselves."""
    monkeypatch.setattr(alignment, "MEMO_WORDS", 5)
    monkeypatch.setattr(alignment, "LEARNT", 3)
    own = alignment.Aligner(BYTE_BPE, PIECES)
    rng = random.Random(3)
    texts = [prose(rng, rng.randrange(1, 30)) for _ in range(60)] + ODD
    for _ in range(2):
        block = alignment.Block(own, texts)
        for i, text in enumerate(texts):
            part = own.whole(text) or alignment.Part(0, 0, 0, "", b"")
            assert block.measures[:, i].tolist() == [part.n_a, part.n_b, part.n_groups, len(part.pairs) // 8], text
            assert block.names[i] == (hashlib.sha256(part.written.encode()).hexdigest() if part.n_a else "")
            pairs, times = np.unique(np.frombuffer(part.pairs, np.int64), return_counts=True)
            here = block.text == i
            assert block.pairs[block.pair[here]].tolist() == pairs.tolist() and block.links[here].tolist() == times.tolist()


def test_byte_level_characters_are_those_of_the_vocabulary():
    assert sorted(alignment.byte_level().values()) == list(range(256))
    vocabulary = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).get_vocab()
    assert all(c in vocabulary for c in alignment.byte_level())


def test_copies_are_tokenised_once(spark, monkeypatch):
    held = []
    staged = alignment.staged
    monkeypatch.setattr(alignment, "staged", lambda df, name: held.append((name, staged(df, name))) or held[-1][1])
    docs = [(i, "the same text" if i % 3 else f"text {i}") for i in range(300)]
    assert aligned(spark, docs) == brute(docs)
    rows = dict(held)["aligned"].select("names", "copies").collect()
    assert sum(len(r.names) for r in rows) == 101 and sum(sum(r.copies) for r in rows) == 300
