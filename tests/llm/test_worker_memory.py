"""What a Python worker holds at once follows from rows and characters, not from the size of Arrow's batches."""

from __future__ import annotations

import corpus_pipeline
import numpy as np
import pyarrow as pa

from vulnloom.llm import passages, tokens


def test_texts_of_one_large_batch_are_encoded_about_a_million_characters_at_a_time():
    texts = ["x" * 100_000] * 40 + ["y" * 3_000_000, "z"]
    part = pa.record_batch([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    got = list(tokens.together([part]))
    assert [i for ids, _ in got for i in ids] == list(range(len(texts)))
    assert [t for _, some in got for t in some] == texts
    assert all(len(some) == 1 or sum(map(len, some)) <= 1 << 20 for _, some in got)


def test_what_is_kept_of_texts_comes_in_small_batches():
    n = 2500
    chains = pa.array([None] * n, pa.list_(pa.struct([("links", pa.binary())])))
    rest = pa.array([{"a": i} for i in range(n)])
    part = pa.record_batch([pa.array(np.arange(n)), pa.array([f"text {i}" for i in range(n)]), chains, rest],
                           names=["doc_id", "text", "chains", "rest"])
    got = list(passages._cut([part]))
    assert [len(b) for b in got] == [1024, 1024, 452]
    table = pa.Table.from_batches(got).to_pydict()
    assert table["doc_id"] == list(range(n)) and table["rest"] == [{"a": i} for i in range(n)]
    assert table["kept"] == [f"text {i}" for i in range(n)]


def test_the_text_goes_through_the_passages_stage_once(spark, monkeypatch):
    long = " ".join(f"w{i}" for i in range(80))
    rows = [(1, long, 7, "a"), (2, "before " + long + " after", 8, "b"), (3, None, None, "c"), (4, "", 0, "d"),
            (4, "short", 5, "e"), (None, long, 9, "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars int, `odd.name_` string")
    carried, dedup = [], passages.deduplicated

    def seen(docs, carry):
        carried.extend(carry)
        return dedup(docs, carry=carry)

    monkeypatch.setattr(corpus_pipeline.passages, "deduplicated", seen)
    got = corpus_pipeline.without_passages(spark, docs, "")
    assert got.schema.simpleString() == docs.schema.simpleString()
    want = {*rows, (2, "before  after", 13, "b")} - {rows[1]}
    assert {tuple(r) for r in got.collect()} == want and got.count() == len(rows)
    assert "text" not in carried and {"doc_id", "n_chars", "odd.name_"} < set(carried)
