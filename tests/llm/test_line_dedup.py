"""Line dedup against brute force, its filters against exact counts."""

import random
from collections import Counter

import numpy as np
import pytest

from vulnloom.llm import line_dedup

DOCS = "doc_id long, text string, name string, drops string, kind int, `a.b` int"


def brute(docs):
    strip, lower = " \t\n\x0b\x0c\r", str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

    def key(line):
        return line.strip(strip).translate(lower)

    holders = {}
    for doc_id, text in docs:
        for line in (text or "").split("\n"):
            holders.setdefault(key(line), set()).add(doc_id)
    out = Counter()
    for doc_id, text in docs:
        lines = (text or "").split("\n")
        stay = [x for x in lines if len(key(x)) < 10 or len(holders[key(x)]) < 2 or min(holders[key(x)]) == doc_id]
        out[doc_id, len(lines), len(lines) - len(stay), "\n".join(stay)] += 1
    return out


def deduplicated(spark, docs, parts=3):
    rows = [(d, t, "n", "d", 1, 2) for d, t in docs]
    return Counter(tuple(r) for r in line_dedup.deduplicated(spark.createDataFrame(rows, DOCS).repartition(parts)).collect())


@pytest.fixture
def lines():
    rng = random.Random(2)
    return [f"line number {i} of the lot" for i in range(60)] + [
        "  padded LINE here \t", "Padded line here", "ÄÖÜ ÄÖÜ ÄÖÜ", "äöü äöü äöü", "short", "nine char", "ten  chars", "語" * 9, "語" * 10,
        "\x0b\x0cten  chars\r", "\xa0ten  chars", "", " ", "x" * 50_000, " ".join(str(rng.random()) for _ in range(9))]


@pytest.mark.parametrize("chunk", [1 << 24, 300])
def test_lines_are_those_of_brute_force(spark, lines, monkeypatch, chunk):
    monkeypatch.setattr(line_dedup, "CHUNK", chunk)
    rng = random.Random(1)
    docs = [(7 * i, "\n".join(rng.choices(lines, k=rng.randrange(1, 12)))) for i in range(80)]
    docs += [(5, ""), (6, None), (8, "\n\n"), (9, docs[3][1]), (10, docs[3][1]), (11, "header line of all\n" * 40)]
    docs += [(1000 + i, f"header line of all\n{rng.choice(lines)}") for i in range(60)]
    assert deduplicated(spark, docs) == brute(docs)


def test_rows_of_one_doc_id_never_lose_to_each_other(spark):
    docs = [(1, "the same line\nanother line"), (1, "the same line"), (1, "the same line"), (2, "the same line")]
    assert deduplicated(spark, docs) == brute(docs)
    assert deduplicated(spark, docs)[2, 1, 1, ""] == 1


def test_rows_without_doc_id_take_no_part(spark):
    docs = [(None, "the same line"), (3, "the same line"), (None, None)]
    assert deduplicated(spark, docs) == brute(docs[1:2])


def test_an_empty_table_gives_no_rows(spark):
    assert not deduplicated(spark, [])


def test_a_filter_loses_no_key_that_came_twice(monkeypatch):
    monkeypatch.setattr(line_dedup, "SLICE", 64)
    rng = np.random.default_rng(4)
    keys = rng.integers(0, 2**63, (3000, 4)).astype(np.uint64)
    at = rng.integers(0, 3000, 4000)
    times = np.bincount(at, minlength=3000)[at]
    for bits, most in ((16, 0.02), (1, 1.0)):
        found = line_dedup.suspected(keys[at], np.zeros(4000, bool), bits)
        assert found[times > 1].all()
        assert found[times == 1].mean() <= most
    assert line_dedup.suspected(keys[:5], np.arange(5) == 2).tolist() == [i == 2 for i in range(5)]


def test_only_suspected_lines_shuffle_beyond_the_filters(spark, monkeypatch):
    """Of keys that one document has, next to none reaches confirmation."""
    held = []
    staged = line_dedup.staged
    monkeypatch.setattr(line_dedup, "staged", lambda df, name: held.append((name, staged(df, name))) or held[-1][1])
    docs = [(i, "\n".join(f"line {i} {j} of its own" for j in range(50))) for i in range(100)]
    assert deduplicated(spark, [*docs, (100, docs[0][1])]) == brute([*docs, (100, docs[0][1])])
    n = {name: df.count() for name, df in held}
    # A task may have met both holders of a key at once, or not.
    assert n["lines"] == 5050 and 100 <= n["suspects"] <= 120 and n["repeats"] == 50


def test_a_hot_line_goes_through_the_filters_once_a_chunk(spark, monkeypatch):
    held = []
    staged = line_dedup.staged
    monkeypatch.setattr(line_dedup, "staged", lambda df, name: held.append((name, staged(df, name))) or held[-1][1])
    docs = [(i, f"the line of all\nline {i} of its own") for i in range(2000)]
    assert deduplicated(spark, docs, parts=4) == brute(docs)
    lines = dict(held)["lines"]
    assert lines.where("kind <> 2").count() <= 2000 + 4 and lines.where("kind = 2").count() >= 2000 - 4
