import pytest
from golden import EDGES, EXPECTED, FULL, REFUSED

from vulnloom.operators import html_scan
from vulnloom.operators.extract import accepted, extract, rejects
from vulnloom.schema import PAGES, RAW_COLUMNS


@pytest.fixture(scope="module")
def edge_rows(spark):
    names = list(EDGES)
    # The id must stay the requested one, so the case rides along in its place.
    pages = [
        (f"{i}", 200, FULL.replace(EDGES[n][0], EDGES[n][1], 1 if n != "packages_in_other_tag" else -1)
         if EDGES[n][0] else FULL)
        for i, n in enumerate(names)
    ]
    rows = extract(spark.createDataFrame(pages, PAGES)).collect()
    return {names[int(r.cve_id)]: r.asDict() for r in rows}


@pytest.mark.parametrize("name", EDGES)
def test_edge(edge_rows, name):
    old, _, changes = EDGES[name]
    assert old in FULL
    got = edge_rows[name]
    want = {**EXPECTED, **changes}
    assert got["reject_reason"] is None
    assert {c: got[c] for c in RAW_COLUMNS if c != "cve_id"} == {
        c: want[c] for c in RAW_COLUMNS if c != "cve_id"
    }


def test_whole_record_and_column_order(spark):
    rows = accepted(extract(spark.createDataFrame([("CVE-2024-0001", 200, FULL)], PAGES)))
    assert rows.columns == list(EXPECTED)
    assert rows.first().asDict() == EXPECTED


def test_title_mismatch_keeps_the_record(spark):
    pages = [("CVE-2024-0001", 200, FULL), ("CVE-2024-0002", 200, FULL)]
    rows = extract(spark.createDataFrame(pages, PAGES)).collect()
    assert {r.cve_id: (r.id_mismatch, r.reject_reason) for r in rows} == {
        "CVE-2024-0001": (False, None), "CVE-2024-0002": (True, None),
    }


def test_rejects(spark, monkeypatch):
    pages = [(reason, 200, FULL.replace(*change)) for reason, change in REFUSED.items()]
    pages += [(str(s), s, FULL) for s in (404, 429, 500)] + [("no response", None, None)]
    pages += [("fine", 200, FULL), ("empty", 200, "")]
    rows = extract(spark.createDataFrame(pages, PAGES))
    got = {r.cve_id: (r.reject_reason, r.reject_detail) for r in rejects(rows).collect()}
    assert got == {
        "page_not_found": ("page_not_found", None),
        "details_not_found": ("details_not_found", None),
        "404": ("http_error", "permanent"),
        "429": ("http_error", "rate_limited"),
        "500": ("http_error", "server_error"),
        "no response": ("http_error", "no_response"),
        "empty": ("page_not_found", None),
    }
    assert [r.cve_id for r in accepted(rows).collect()] == ["fine"]


def test_a_page_the_tokenizer_refuses_is_a_reject(spark, monkeypatch):
    def refuse(self, html):
        raise AssertionError("unreadable")

    monkeypatch.setattr(html_scan.PageRecord, "__init__", refuse)
    rows = extract(spark.createDataFrame([("a", 200, FULL)], PAGES)).collect()
    assert [(r.reject_reason, r.reject_detail) for r in rows] == [
        ("parse_error", "AssertionError: unreadable")
    ]


def test_result_does_not_depend_on_partitioning(spark):
    pages = [(str(i), 200 if i % 5 else 404, FULL.replace("demo", f"p{i}")) for i in range(60)]
    frame = spark.createDataFrame(pages, PAGES)
    one, many = (
        {r.cve_id: r for r in extract(frame.repartition(n)).collect()} for n in (1, 13)
    )
    assert one == many and len(one) == 60


def test_many_pages_in_one_task(spark):
    """More pages than one output chunk, all in one batch."""
    n = html_scan.CHUNK * 2 + 3
    pages = spark.range(n).coalesce(1).selectExpr(
        "cast(id as string) cve_id", "200 status", f"'{FULL.replace(chr(39), '')}' html"
    )
    assert extract(pages).filter("reject_reason is null").select("cve_id").distinct().count() == n
