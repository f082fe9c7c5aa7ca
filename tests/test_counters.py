"""A run's counters come with what it writes."""

import pytest
from golden import FULL

from vulnloom.plans.collect import collect
from vulnloom.schema import LAKE, PAGES
from vulnloom.session import written_and_counted


@pytest.fixture
def counts(monkeypatch, spark):
    """The plans that a count job of their own was run for."""
    frame = type(spark.range(1))
    asked, count = [], frame.count
    monkeypatch.setattr(frame, "count", lambda self: asked.append(self.columns) or count(self))
    return asked


def counters(run):
    return next(iter(run.collect())).asDict()


def test_no_job_counts_what_is_written(spark, tmp_path, counts):
    lake = str(tmp_path / "lake")
    names = ["CVE-2024-1", " CVE-2024-1\n", "CVE-2024-2", "CVE-2024-3", "", " ", None, "CVE-2024-3"]
    ids = spark.createDataFrame(list(enumerate(names)), "ord long, cve_id string")
    pages = spark.createDataFrame([("CVE-2024-1", 200, FULL), ("CVE-2024-1", 200, FULL), ("CVE-2024-2", 404, None)], PAGES)
    assert counters(collect(ids, pages, lake, run=1)) == {
        "ids_available": 8, "existing_rows": 0, "already_collected": 0, "successes": 1, "skipped": 2,
        "final_rows": 1, "target": None,
    }
    more = spark.createDataFrame([("CVE-2024-3", 200, FULL)], PAGES)
    assert counters(collect(ids, more, lake, run=2)) == {
        "ids_available": 8, "existing_rows": 1, "already_collected": 1, "successes": 1, "skipped": 1,
        "final_rows": 2, "target": None,
    }
    # Of a run: the lake before it, the pending ids as their filter is sized, the given list.
    assert counts == [LAKE.fieldNames(), ["cve_id", "ord"], ["ord", "cve_id"]] * 2


def test_counters_of_empty_runs(spark, tmp_path):
    lake = str(tmp_path / "lake")
    ids, pages = spark.createDataFrame([], "ord long, cve_id string"), spark.createDataFrame([], PAGES)
    for target in (None, 0, 5):
        got = counters(collect(ids, pages, lake, run=1, target=target))
        assert got.pop("target") == target and set(got.values()) == {0}


def test_rows_are_counted_as_they_are_written(spark, tmp_path):
    for n, frame in enumerate([
        spark.range(0), spark.range(1000).repartition(7), spark.range(100).filter("id < 0"),
        spark.range(1000).selectExpr("id % 10 k").distinct(),
        spark.range(50).filter("id >= 0").limit(9),
    ]):
        table, rows = written_and_counted(frame, str(tmp_path / str(n)))
        assert rows == table.count() == (0, 1000, 0, 10, 9)[n]
