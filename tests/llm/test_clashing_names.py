"""Extra columns named like the operators' own, with dots and marks, or none at all."""

import random

import pytest
from pyspark.sql import Row

from vulnloom.llm import packing, passages
from vulnloom.llm.common import by_group, staged
from vulnloom.llm.queries import WORD_BPE

NAMES = ["__id", "__key", "__row", "id", "key", "row", "nth", "rest", "kept", "spans", "a.b", "a`b", "shard", "part", "to", "links"]


def prose(rng, n):
    return " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))


@pytest.fixture
def docs(spark):
    rng = random.Random(4)
    one, two, passage = prose(rng, 60), prose(rng, 70), prose(rng, 80)
    texts = [(1, f"{one} {passage}"), (2, one + " x"), (3, f"{two} {passage}"), (4, f"{one} {passage}"), (None, "no id"), (5, None)]
    columns = ", ".join(f"`{c.replace('`', '``')}` string" for c in NAMES)
    return spark.createDataFrame([(i, t, *NAMES) for i, t in texts], f"doc_id int, text string, {columns}").repartition(2)


def test_pipeline_stages_keep_extra_columns(spark, docs):
    import corpus_pipeline as pipeline

    kept = pipeline.one_of_each(spark, docs, "")
    assert kept.schema == docs.schema
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 2, 3, 5]
    after = pipeline.without_passages(spark, staged(kept, "names"), "")
    assert after.columns == docs.columns
    for r in after.collect():
        assert list(r)[2:] == NAMES
    texts = {r.doc_id: r.text for r in after.collect()}
    assert len(texts[3].split()) == 70 and texts[5] is None and texts[None] == "no id"


def test_passages_carry_any_column(spark, docs):
    rows = passages.deduplicated(docs, carry=docs.columns).collect()
    assert all(list(r.rest)[2:] == NAMES for r in rows) and len(rows) == 5


def test_pieces_keep_extra_columns(spark, docs):
    names = [n for n in NAMES if n != "a`b"]
    pieces = packing.cut(docs, WORD_BPE).crossJoin(docs.select(*(f"`{n}`" for n in names)).limit(1))
    placed = packing.place(staged(pieces, "pieces"))
    assert placed.columns == [*pieces.columns, "sequence_id", "offset"]
    rows = placed.collect()
    assert len(rows) == 5 and all(r["a.b"] == "a.b" and r["shard"] == "shard" for r in rows)
    assert sorted(r.offset for r in rows)[0] == 0


def test_groups_stay_together_and_rows_are_copied_once():
    import pyarrow as pa

    rng = random.Random(1)
    rows = sorted((rng.randrange(4), rng.randrange(3), i) for i in range(60))
    for size in (1, 2, 7, 60):
        parts = [pa.RecordBatch.from_pylist([Row(a=a, b=b, i=i).asDict() for a, b, i in rows[s:s + size]]) for s in range(0, 60, size)]
        empty = parts[0].slice(0, 0)
        got = [list(zip(*(t[c].to_pylist() for c in "abi"))) for t in by_group([empty, *parts, empty], ("a", "b"))]
        assert [x for g in got for x in g] == rows
        keys = [{(a, b) for a, b, _ in g} for g in got]
        assert sum(map(len, keys)) == len(set().union(*keys))
    assert not list(by_group([], ("a",)))
