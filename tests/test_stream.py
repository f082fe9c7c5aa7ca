from golden import EXPECTED, FULL

from vulnloom.plans.collect import collect, read_advisories, rejects_path
from vulnloom.schema import PAGES, RAW_COLUMNS
from vulnloom.streaming.ingest import ingest, land, page_file_stream, page_stream


def drop(spark, landing, *rows):
    spark.createDataFrame(rows, PAGES).coalesce(1).write.mode("append").parquet(landing)


def run(spark, landing, lake, **options):
    ingest(page_stream(spark, landing, **options), lake, lake + "/_checkpoint").awaitTermination()
    return sorted((r.cve_id, r.package) for r in read_advisories(spark, lake).collect())


def page(package):
    return FULL.replace("demo", package)


def test_each_id_lands_once(spark, tmp_path):
    landing, lake = str(tmp_path / "in"), str(tmp_path / "lake")
    drop(spark, landing, ("CVE-2024-1", 200, "<p>"), ("CVE-2024-1", 200, page("first")),
         ("CVE-2024-1", 200, page("second")), ("CVE-2023-2", 503, None))
    assert run(spark, landing, lake) == [("CVE-2024-1", "first")]
    # Nothing new has arrived.
    assert run(spark, landing, lake) == [("CVE-2024-1", "first")]
    drop(spark, landing, ("CVE-2024-1", 200, page("third")), ("CVE-2023-2", 200, page("x")))
    drop(spark, landing, ("CVE-2023-2", 200, page("late")), (" GHSA-x\n", 200, page("y")),
         (None, 200, FULL), (" ", 200, FULL))
    want = [("CVE-2023-2", "x"), ("CVE-2024-1", "first"), ("GHSA-x", "y")]
    assert run(spark, landing, lake, maxFilesPerTrigger=1) == want
    drop(spark, landing, ("GHSA-x", 200, page("z")))
    assert run(spark, landing, lake) == want
    refused = spark.read.parquet(rejects_path(lake)).collect()
    assert sorted((r.run, r.cve_id, r.reject_reason) for r in refused) == [
        (0, "CVE-2023-2", "http_error"),
    ]


def test_rejects_of_a_run_outlive_a_stream(spark, tmp_path):
    landing, lake = str(tmp_path / "in"), str(tmp_path / "lake")
    ids = spark.createDataFrame([(i, f"CVE-2024-{i}") for i in range(5)], "ord long, cve_id string")
    collect(ids, spark.createDataFrame([], PAGES), lake, run=0)
    drop(spark, landing, ("CVE-2024-9", 404, None))
    run(spark, landing, lake)
    assert spark.read.parquet(rejects_path(lake)).count() == 6


def test_only_ids_of_a_batch_are_staged(spark, tmp_path):
    landing, lake = str(tmp_path / "in"), str(tmp_path / "lake")
    drop(spark, landing, *((f"CVE-2024-{n}", 200, FULL) for n in range(1, 40)))
    run(spark, landing, lake)
    drop(spark, landing, ("CVE-2024-1", 200, FULL), ("CVE-2024-99", 200, FULL))
    run(spark, landing, lake)
    assert [r.cve_id for r in spark.read.parquet(f"{lake}/_staging/done").collect()] == ["CVE-2024-1"]


def test_a_batch_run_again_adds_nothing(spark, tmp_path):
    landing, lake = str(tmp_path / "in"), str(tmp_path / "lake")
    drop(spark, landing, ("CVE-2024-1", 200, FULL), ("CVE-2024-2", 200, "<p>"))
    batch = spark.read.schema(PAGES).parquet(landing).selectExpr(
        "*", "_metadata.file_modification_time arrived", "_metadata.file_path file",
        "_metadata.row_index row_index",
    )
    for _ in range(3):
        land(batch, 7, lake)
    assert read_advisories(spark, lake).count() == 1
    assert spark.read.parquet(rejects_path(lake)).count() == 1


def test_html_files(spark, tmp_path):
    landing, lake = tmp_path / "in", str(tmp_path / "lake")
    landing.mkdir()
    (landing / "CVE-2024-0001.html").write_text(FULL)
    (landing / "CVE-2024-0002.html").write_text("<p>")
    ingest(page_file_stream(spark, str(landing)), lake, lake + "/_checkpoint").awaitTermination()
    rows = read_advisories(spark, lake).select(*RAW_COLUMNS).collect()
    assert [r.asDict() for r in rows] == [EXPECTED]


def test_stream_goes_on_from_a_batch_lake(spark, tmp_path):
    from vulnloom.plans.collect import collect

    landing, lake = str(tmp_path / "in"), str(tmp_path / "lake")
    ids = spark.createDataFrame([(1, "CVE-2024-1")], "ord bigint, cve_id string")
    collect(ids, spark.createDataFrame([("CVE-2024-1", 200, page("batch"))], PAGES), lake, run=1)
    drop(spark, landing, ("CVE-2024-1", 200, page("stream")), ("CVE-2024-2", 200, page("new")))
    assert run(spark, landing, lake) == [("CVE-2024-1", "batch"), ("CVE-2024-2", "new")]


def test_a_batch_that_died_is_landed_by_the_restart(spark, tmp_path, monkeypatch):
    import pytest
    from vulnloom.plans import collect as plan

    landing, lake = str(tmp_path / "in"), str(tmp_path / "lake")
    drop(spark, landing, ("CVE-2024-1", 200, FULL), ("CVE-2024-2", 200, "<p>"))

    def die(*_):
        raise RuntimeError("executor lost")

    with monkeypatch.context() as m:
        m.setattr(plan, "write_rejects", die)
        with pytest.raises(Exception, match="executor lost"):
            run(spark, landing, lake)
    drop(spark, landing, ("CVE-2024-3", 200, page("x")))
    assert run(spark, landing, lake) == [("CVE-2024-1", "demo"), ("CVE-2024-3", "x")]
    refused = spark.read.parquet(rejects_path(lake)).collect()
    assert [(r.cve_id, r.reject_reason) for r in refused] == [("CVE-2024-2", "page_not_found")]
