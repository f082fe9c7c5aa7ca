"""The column rules against the same rules written as plain loops, on random input."""

import random
import re

import pytest
from pyspark.sql import functions as F

from vulnloom.functions import fields, labels

ENTRIES = """i int, entries array<struct<label: string, has_dd: boolean, value: string,
             anchors: array<string>, cells: array<string>>>"""
LABELS = ["source", "summary", "severity", "references", "events", "sources", ""]


def random_entry(rng):
    has_dd = rng.random() < 0.7
    return (
        rng.choice(LABELS),
        has_dd,
        rng.choice(["", "a b", "9.8 ("]) if has_dd else None,
        [rng.choice([None, "", "/1", "/2", "/3", "a; b"]) for _ in range(rng.randrange(4))] if has_dd else [],
        [rng.choice(["Introduced", "fixed", "FIXED", "1", "2", ""]) for _ in range(rng.randrange(7))] if has_dd else [],
    )


@pytest.fixture(scope="module")
def lists(spark):
    rng = random.Random(8)
    rows = [(i, [random_entry(rng) for _ in range(rng.randrange(8))]) for i in range(600)]
    rows.append((600, None))
    frame = spark.createDataFrame(rows, ENTRIES)
    return [entries or [] for _, entries in rows], frame


def evaluated(frame, column):
    return [r.x for r in frame.select("i", column.alias("x")).orderBy("i").collect()]


@pytest.mark.parametrize("label", ["Summary", "SEVERITY", "absent"])
def test_value(lists, label):
    plain, frame = lists
    want = [
        next((v for name, has, v, _, _ in entries if name == label.lower() and has), "") for entries in plain
    ]
    assert evaluated(frame, labels.value_of(labels.with_value(F.col("entries")), label)) == want


@pytest.mark.parametrize("label", ["Source", "references", "absent"])
def test_link(lists, label):
    plain, frame = lists
    want = [
        next((a[0] or "" for name, has, _, a, _ in entries if name == label.lower() and has and a), "")
        for entries in plain
    ]
    assert evaluated(frame, labels.link_of(labels.with_link(F.col("entries")), label)) == want


def first(entries, label):
    return next((e for e in entries if e[0] == label), None)


def test_first_label_decides(lists):
    plain, frame = lists
    severity = [(first(entries, "severity") or (0, 0, None))[2] or "" for entries in plain]
    assert evaluated(frame, fields.severity_text(F.col("entries"))) == severity
    links = []
    for entries in plain:
        entry = first(entries, "references")
        links.append(list(dict.fromkeys(a for a in entry[3] if a)) if entry else [])
    assert evaluated(frame, fields.reference_links(F.col("entries"))) == links


@pytest.mark.parametrize("kind", ["introduced", "fixed"])
def test_last_event(lists, kind):
    plain, frame = lists
    want = []
    for entries in plain:
        cells, found = (first(entries, "events") or ("", 0, 0, [], []))[4], ""
        for before, cell in zip(cells, cells[1:]):
            if before.lower() == kind:
                found = cell
        want.append(found)
    cells = fields.event_cells(F.col("entries"))
    assert evaluated(frame, fields.last_event(cells, kind)) == want


def test_event_history(lists):
    plain, frame = lists
    want = []
    for entries in plain:
        cells = (first(entries, "events") or ("", 0, 0, [], []))[4]
        want.append([
            (i, cells[i - 1].lower(), cells[i]) for i in range(1, len(cells))
            if cells[i - 1].lower() in ("introduced", "fixed")
        ])
    got = evaluated(frame, fields.event_history(fields.event_cells(F.col("entries"))))
    assert [[tuple(e) for e in row or []] for row in got] == want


def test_blocks(spark):
    rng = random.Random(12)
    bits = [
        '"cwe_ids"', "cwe_ids", '"CWE-79"', '"CWE-8"', "CWE-1", '"CWE-"', '"CWE-7x"', '"cna_assigner"',
        '"cna_assigner": "acme"', '"cna_assigner" :\n"b c"', '"cna_assigner":""', '"cna_assigner" "x"', ", ",
    ]
    plain = [
        ["".join(rng.choice(bits) for _ in range(rng.randrange(6))) for _ in range(rng.randrange(4))]
        for _ in range(800)
    ]
    frame = spark.createDataFrame(list(enumerate(plain)), "i int, blocks array<string>")
    ids, names = [], []
    for blocks in plain:
        cwe, name = [], ""
        for block in blocks:
            if "cwe_ids" in block:
                cwe = re.findall(r'"(CWE-\d+)"', block) or cwe
            if found := re.search(r'"cna_assigner"\s*:\s*"([^"]+)"', block):
                name = found[1]
        ids.append(cwe)
        names.append(name)
    assert evaluated(frame, fields.weaknesses(F.col("blocks"))) == ids
    assert evaluated(frame, fields.assigner(F.col("blocks"))) == names


def test_cvss(spark):
    rng = random.Random(13)
    bits = [
        "9.8 (", "10 (", "1.10.2  (", "7.5(High)", "CVSS_V3", "CVSS_V1", "CVSS_V42", "CVSS:3.1/AV:N/AC:L", "CVSS:4.0/",
        "CVSS:3/AV:N", "CVSS:10.25/a-b_c.d:e/F", "AV:N/AC:L", " ", " - ", "x",
    ]
    plain = ["".join(rng.choice(bits) for _ in range(rng.randrange(7))) for _ in range(1500)]
    frame = spark.createDataFrame(list(enumerate(plain)), "i int, t string")
    for column, pattern in (
        (fields.cvss_score, r"(\d+\.\d+)\s*\("),
        (fields.cvss_version, r"(CVSS_V[234])"),
        (fields.cvss_vector, r"(CVSS:\d+\.\d+/[A-Za-z0-9:/._-]+)"),
    ):
        want = [m[1] if (m := re.search(pattern, t)) else "" for t in plain]
        assert evaluated(frame, column(F.col("t"))) == want
