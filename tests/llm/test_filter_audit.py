"""The filter audit against documents filtered one by one."""

import random
import re
from itertools import permutations

import numpy as np
import pytest

from vulnloom.llm import filter_audit

DOCS = "doc_id long, text string, source string, part string, name string, fails int, `a.b` int"
LABELS = "doc_id long, quality int, toxic int, first boolean"


def fails(docs, row):
    text = row[1] or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {
        "A": len(words) < 50,
        "B": 100 * len(set(words)) < 65 * len(words),
        "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
        "D": any(c in "#$%&*|" for c in text),
        "E": row[0] is not None and any(d is not None and d < row[0] and (t or "") == text for d, t, *_ in docs),
    }


def brute(docs, labels):
    good, toxic = ({d for d, *marks, _ in labels if marks[i] == 1} - {None} for i in (0, 1))
    judged = [(row, fails(docs, row)) for row in docs]
    out = {}
    for part in {row[2] or "" for row in docs}:
        own = [(row, f) for row, f in judged if (row[2] or "") == part]
        for order in permutations("ABCDE"):
            left = own
            for step, name in enumerate(order, 1):
                gone, left = [x for x in left if x[1][name]], [x for x in left if not x[1][name]]
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(f[name] for _, f in own) - len(gone),
                    sum(f[name] and sum(f.values()) == 1 for _, f in own),
                    sum(row[0] in good for row, _ in gone), sum(row[0] in toxic for row, _ in gone)]
    whole = {}
    for (part, order, step), m in out.items():
        whole[part, order[step - 1]] = whole.get((part, order[step - 1]), 0) + m[1]
    return {key: (*m, whole[key[0], key[1][key[2] - 1]]) for key, m in out.items()}


def audited(spark, docs, labels):
    rows = [(d, t, s, "clash", "clash", 7, 1) for d, t, s in docs]
    marks = [(d, q, x, True) for d, q, x in labels]
    found = filter_audit.audit(spark.createDataFrame(rows, DOCS).repartition(3), spark.createDataFrame(marks, LABELS)).collect()
    return rows, marks, {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in found}, len(found)


def test_every_order_is_as_filtering_one_by_one(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(90)] + ["X", "YZ", "$5", "a|b", "é", "語"]
    texts = [" ".join(rng.choices(words[:rng.choice([3, 40, 96])], k=rng.choice([0, 5, 49, 50, 51, 80]))) for _ in range(40)]
    texts += ["", None, None, " \t\n", "A" * 3, "word " * 30_000, texts[0], texts[0], "x\x0by " * 50, "x\xa0y " * 50]
    docs = [(i // 2 if i > 20 else i, t, rng.choice(["s", "s", "s", "t", "", None])) for i, t in enumerate(texts)]
    docs += [(None, texts[0], "s"), (None, None, None), docs[3], docs[3]]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 50, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1), (999, 1, 1)]
    rows, marks, got, n = audited(spark, docs, labels)
    want = brute(rows, marks)
    assert n == len(want) == len(got)
    assert got == want


def test_of_ties_each_row_counts(spark):
    """Repeated rows are no copies of each other; a later doc_id is one of both."""
    _, _, got, _ = audited(spark, [(1, "a", "s"), (1, "a", "s"), (2, "a", "s")], [])
    assert got["s", "EABCD", 1][:3] == (2, 1, 0)


def test_an_empty_table_has_no_parts(spark):
    assert audited(spark, [], [(1, 1, 1)])[3] == 0


def test_documents_without_labels(spark):
    _, _, got, n = audited(spark, [(1, "$", None)], [])
    assert n == 600 and got["", "DABCE", 1] == (0, 1, 0, 0, 0, 0, 60)


def test_a_hot_group_is_few_rows_before_the_counts_meet(spark):
    """A third of the rows one text and one source: the counts shuffle as cells, copies as their smallest doc_id."""
    docs = [(i, "same" if i % 3 else f"text {i}", "hot" if i % 3 else f"s{i % 7}") for i in range(900)]
    _, _, got, n = audited(spark, docs, [])
    assert n == 600 * 8
    assert got["hot", "EABCD", 1][:2] == (1, 599)


def test_contractions_are_sums_over_the_picked_places():
    rng = np.random.default_rng(1)
    counts = rng.integers(0, 9, (2, 2, 2, 2, 2, 2))
    chosen = filter_audit.selectors()["removed"]
    row = filter_audit.STEPS.index(("CABDE", 3))
    assert filter_audit.contracted(counts, chosen)[:, row].tolist() == counts[:, 0, 1, 0].sum(axis=(1, 2)).tolist()


@pytest.mark.parametrize("measure", ["kept", "removed", "unique_fails", "fails"])
def test_vectors_pick_pass_fail_or_all(measure):
    assert {tuple(v) for v in filter_audit.selectors()[measure].reshape(-1, 2).tolist()} <= {(1, 0), (0, 1), (1, 1)}
