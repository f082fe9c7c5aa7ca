import datetime
import random
import statistics
from collections import Counter, defaultdict
from decimal import Decimal

import pytest

from vulnloom.operators import analytics
from vulnloom.operators.typed import typed
from vulnloom.schema import RAW, RAW_COLUMNS


def raw(spark, records):
    return spark.createDataFrame([tuple(r.get(c, "") for c in RAW_COLUMNS) for r in records], RAW)


@pytest.fixture(scope="module")
def records():
    """A third of all advisories share one ecosystem, package and weakness."""
    rng = random.Random(4)
    out = []
    for n in range(900):
        hot = n % 3 == 0
        score = rng.randrange(101) if rng.random() < 0.9 else None
        out.append({
            "cve_id": f"CVE-{2020 + n % 5}-{n:04d}",
            "published": f"{2020 + n % 5}-{1 + n % 12:02d}-28T23:59:59Z" if n % 11 else "",
            "severity": "" if score is None else f"{score / 10:.1f} ({'High' if hot else 'Low'}) CVSS_V3 - x",
            "cvss_score": "" if score is None else f"{score / 10:.1f}",
            "cvss_version": "" if score is None else f"CVSS_V{2 + n % 3}",
            "cvss_vector": "CVSS:3.1/AV:N/AC:L" if n % 2 else "",
            "ecosystem": "hot" if hot else rng.choice(["", "npm", "PyPI", "Go"]),
            "package": "hot" if hot else rng.choice(["", "a", "b", "c", "d", "e"]),
            "fixed": "1" if rng.random() < 0.5 else "",
            "cwe_ids": "CWE-79; CWE-79" if hot else rng.choice(["", "CWE-1", "CWE-2; CWE-79"]),
            "details": "x" * 200 if hot else "y" * rng.randrange(60, 70),
        })
    return out


@pytest.fixture(scope="module")
def view(spark, records):
    return typed(raw(spark, records)).cache()


def pairs(frame, *columns):
    return {tuple(r[c] for c in columns[:-1]): r[columns[-1]] for r in frame.collect()}


def test_severity(view, records):
    bands = Counter(r["severity"].split("(")[1].split(")")[0] if r["severity"] else "none" for r in records)
    got = {r.severity_band: (r.n, r.share) for r in analytics.severity_distribution(view).collect()}
    assert got == {b: (n, n / len(records)) for b, n in bands.items()}


@pytest.mark.parametrize("by", ["cvss_version", "ecosystem"])
def test_scores(view, records, by):
    groups = defaultdict(list)
    for r in records:
        if r["cvss_score"]:
            groups[r[by] or None].append(float(r["cvss_score"]))
    got = {r[by]: r for r in analytics.score_summary(view, by).collect()}
    assert set(got) == set(groups)
    for key, scores in groups.items():
        row = got[key]
        assert row.scored == len(scores)
        assert (row.min_score, row.max_score) == (min(scores), max(scores))
        assert row.avg_score == pytest.approx(statistics.mean(scores))
        assert row.median_score == pytest.approx(statistics.median(scores))


def test_histogram(view, records):
    want = Counter(min(int(float(r["cvss_score"])), 9) for r in records if r["cvss_score"])
    assert pairs(analytics.score_histogram(view), "bin", "n") == {(b,): n for b, n in want.items()}


def test_weaknesses(view, records):
    want = Counter(w for r in records for w in set(r["cwe_ids"].split("; ")) if w)
    ranked = sorted(want.items(), key=lambda wn: (-wn[1], wn[0]))
    assert [tuple(r) for r in analytics.top_weaknesses(view, 2).collect()] == ranked[:2]


def test_ecosystems_and_fixes(view, records):
    want = Counter(r["ecosystem"] or None for r in records)
    fixed = Counter(r["ecosystem"] or None for r in records if r["fixed"])
    assert pairs(analytics.ecosystem_counts(view), "ecosystem", "n") == {(e,): n for e, n in want.items()}
    got = {r.ecosystem: (r.n, r.with_fix, r.fix_share) for r in analytics.fix_share(view).collect()}
    assert got == {e: (n, fixed[e], fixed[e] / n) for e, n in want.items()}


def test_packages(view, records):
    want = defaultdict(Counter)
    for r in records:
        if r["package"]:
            want[r["ecosystem"] or None][r["package"]] += 1
    got = defaultdict(list)
    for r in analytics.top_packages(view, 2).orderBy("place").collect():
        got[r.ecosystem].append((r.package, r.n))
    assert got == {
        e: sorted(c.items(), key=lambda pn: (-pn[1], pn[0]))[:2] for e, c in want.items()
    }


def test_trend(view, records):
    want = Counter(r["published"][:7] for r in records if r["published"])
    got = [(f"{r.month:%Y-%m}", r.n, r.running_total) for r in analytics.monthly_trend(view).orderBy("month").collect()]
    total, expected = 0, []
    for month, n in sorted(want.items()):
        total += n
        expected.append((month, n, total))
    assert got == expected


@pytest.mark.parametrize("zone", ["America/Los_Angeles", "Pacific/Kiritimati"])
def test_months_do_not_depend_on_the_session(spark, zone):
    texts = ["2024-01-31T23:59:59Z", "2024-02-01T00:00:00Z", "1969-12-31T23:00:00Z", "2024-02-01T01:00:00+02:00"]
    records = [{"cve_id": f"CVE-2024-{n}", "published": t} for n, t in enumerate(texts)]
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = analytics.monthly_trend(typed(raw(spark, records))).orderBy("month").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert [(f"{r.month}", r.n) for r in rows] == [("1969-12-01", 1), ("2024-01-01", 2), ("2024-02-01", 1)]


def test_metrics(view):
    got = {(r.metric, r.value): r.n for r in analytics.metric_counts(view).collect()}
    assert got == {("AV", "N"): 450, ("AC", "L"): 450}


def test_profile(spark, records):
    frame = raw(spark, records)
    got = {r.column: (r.rows, r.filled, r.distinct_values) for r in analytics.profile(frame).collect()}
    for c in RAW_COLUMNS:
        values = [r.get(c, "") for r in records if r.get(c, "")]
        assert got[c] == (len(records), len(values), len(set(values)))
    rough = {r.column: r for r in analytics.profile(frame, approximate=True).collect()}
    for c in RAW_COLUMNS:
        assert (rough[c].rows, rough[c].filled) == got[c][:2]
        assert rough[c].distinct_values == pytest.approx(got[c][2], rel=0.15, abs=1)


def test_typed(spark):
    rows = typed(raw(spark, [
        {
            "cve_id": "CVE-2024-12345", "aliases": "GHSA-a GHSA-b", "published": "2024-03-29T17:15:21Z",
            "modified": "2024-04-01T00:00:00.150Z", "severity": "9.8 ( Critical ) x", "cvss_score": "9.8",
            "cvss_vector": "CVSS:3.1/AV:N/AC:L/AV:P/E:/bare", "cwe_ids": "CWE-79; CWE-89; CWE-79",
            "references": "https://r/1; https://r/2",
        },
        {"cve_id": "junk", "published": "yesterday", "cvss_score": "x", "severity": "none"},
        {"cve_id": "CVE-2024-1", "cvss_score": "10.0", "cvss_vector": "AV:N/Au:N"},
        {"cve_id": "CVE-2024-2", "cvss_score": "123456.7"},
    ])).collect()
    full, junk, top, wide = rows
    assert (full.cve_year, full.cve_seq, full.cvss_score) == (2024, 12345, Decimal("9.8"))
    assert full.published == datetime.datetime(2024, 3, 29, 17, 15, 21)
    assert full.modified == datetime.datetime(2024, 4, 1, 0, 0, 0, 150000)
    assert full.severity_band == "Critical" and full.aliases == ["GHSA-a", "GHSA-b"]
    assert full.cvss_metrics == {"AC": "L", "AV": "P", "E": ""}
    assert full.cwe_ids == ["CWE-79", "CWE-89", "CWE-79"] and full.references == ["https://r/1", "https://r/2"]
    assert (junk.cve_year, junk.cve_seq, junk.published, junk.cvss_score, junk.severity_band) == (None,) * 5
    assert junk.aliases == [] and junk.package is None and junk.cvss_metrics is None
    assert top.cvss_score == Decimal("10.0") and top.cvss_metrics == {"AV": "N", "Au": "N"}
    assert wide.cvss_score is None


def test_profile_of_nothing_has_every_column(spark):
    from vulnloom.schema import RAW_COLUMNS
    empty = spark.createDataFrame([], ", ".join(f"`{c}` string" for c in RAW_COLUMNS))
    for approximate in (False, True):
        got = analytics.profile(empty, approximate=approximate).collect()
        assert sorted((r.column, r.rows, r.filled, r.distinct_values) for r in got) == sorted((c, 0, 0, 0) for c in RAW_COLUMNS)
