import random

import pytest
from golden import FULL
from pyspark.sql import functions as F

from vulnloom.operators import merge
from vulnloom.plans.collect import (
    collect,
    export_csv,
    import_csv,
    read_advisories,
    rejects_path,
)
from vulnloom.schema import PAGES, RAW_COLUMNS
from vulnloom.sources.dataset import read_csv_dataset, write_csv_dataset

IDS = "ord bigint, cve_id string"


def ids_of(spark, *names):
    return spark.createDataFrame(list(enumerate(names, 1)), IDS)


def pages_of(spark, **pages):
    """Keyword values: True an advisory, an int a status, a string a body."""
    rows = []
    for name, page in pages.items():
        cve_id = name.replace("_", "-")
        if page is True:
            rows.append((cve_id, 200, FULL.replace("demo", cve_id)))
        elif isinstance(page, int):
            rows.append((cve_id, page, None))
        else:
            rows.append((cve_id, 200, page))
    return spark.createDataFrame(rows, PAGES)


def landed(spark, lake):
    return [
        (r.run, r.ord, r.cve_id)
        for r in read_advisories(spark, lake).orderBy("run", "ord").collect()
    ]


def rejected(spark, lake, run):
    rows = spark.read.parquet(rejects_path(lake)).filter(F.col("run") == run).collect()
    assert len({(r.attempt, r.cve_id) for r in rows}) == len(rows)
    return {r.cve_id: r.reject_reason for r in rows}


def counters(frame):
    return frame.first().asDict()


def test_runs(spark, path):
    ids = ids_of(spark, "CVE-2024-3", "CVE-2024-1", "CVE-2024-3", "CVE-2023-2", "CVE-2024-9", "CVE-2024-8")
    pages = pages_of(
        spark, CVE_2024_1=True, CVE_2023_2=503, CVE_2024_3=True, CVE_2024_9="<p>", CVE_2024_7=True
    )
    first = counters(collect(ids, pages, path, run=1))
    assert landed(spark, path) == [(1, 1, "CVE-2024-3"), (1, 2, "CVE-2024-1")]
    assert rejected(spark, path, 1) == {
        "CVE-2023-2": "http_error", "CVE-2024-9": "page_not_found", "CVE-2024-8": "not_fetched",
    }
    assert first == {
        "ids_available": 6, "existing_rows": 0, "already_collected": 0, "successes": 2,
        "skipped": 3, "final_rows": 2, "target": None,
    }
    # Again with the same pages: nothing is added. With better pages: the rest.
    assert counters(collect(ids, pages, path, run=2))["successes"] == 0
    third = counters(collect(ids, pages_of(spark, CVE_2023_2=True, CVE_2024_1=True), path, run=3))
    assert landed(spark, path)[2:] == [(3, 4, "CVE-2023-2")]
    assert (third["existing_rows"], third["successes"], third["skipped"]) == (2, 1, 2)
    years = {r.cve_year for r in read_advisories(spark, path).collect()}
    assert years == {2023, 2024}


@pytest.mark.parametrize("target, added", [(None, 5), (3, 3), (0, 0), (100, 5)])
def test_target(spark, path, target, added):
    names = [f"CVE-2024-{n}" for n in (5, 1, 4, 2, 3)]
    pages = pages_of(spark, **{n.replace("-", "_"): True for n in names})
    collect(ids_of(spark, *names), pages, path, run=1, target=target)
    assert [i for _, _, i in landed(spark, path)] == names[:added]
    # The next run goes on where the target stopped this one.
    collect(ids_of(spark, *names), pages, path, run=2)
    assert sorted(i for _, _, i in landed(spark, path)) == sorted(names)


def test_target_counts_repeated_rows(spark):
    existing = spark.createDataFrame([("a",), ("a",), ("b",)], "cve_id string")
    new = spark.createDataFrame([(2, "d"), (1, "c")], IDS)
    assert sorted(r.cve_id for r in merge.until_target(existing, new, 4).collect()) == ["a", "a", "b", "c"]
    assert merge.until_target(existing, new, 2).count() == 3
    assert merge.until_target(existing, new).count() == 5


def test_counters(spark):
    row = merge.run_counters(spark, 9, existing_rows=5, already_collected=4, attempted=3, successes=2, target=None)
    assert row.first().asDict() == {
        "ids_available": 9, "existing_rows": 5, "already_collected": 4, "successes": 2, "skipped": 1,
        "final_rows": 7, "target": None,
    }


def test_done_ids_are_trimmed(spark):
    existing = spark.createDataFrame([(" a\u00a0",), ("a",), ("",), (None,), (" ",)], "cve_id string")
    assert [r.cve_id for r in merge.done_ids(existing).collect()] == ["a"]


def test_null_ids_are_not_pending(spark):
    ids = spark.createDataFrame([(1, None), (2, "a"), (3, ""), (4, " \u00a0")], IDS)
    done = spark.createDataFrame([], "cve_id string")
    assert [r.cve_id for r in merge.pending_ids(ids, done).collect()] == ["a"]


def test_copies_of_a_page(spark, path):
    """A hot id with most of the pages lands once, from its first good copy."""
    bad = [("CVE-2024-1", 200, "<p>")] * 5
    copies = [("CVE-2024-1", 200, FULL)] * 300
    rest = [(f"CVE-2024-{n}", 200, FULL) for n in range(2, 50)]
    rows = bad + copies + rest
    random.Random(2).shuffle(rows)
    pages = spark.createDataFrame(rows, PAGES).repartition(6)
    collect(ids_of(spark, *{r[0] for r in rows}), pages, path, run=1)
    got = [i for _, _, i in landed(spark, path)]
    assert len(got) == 49 and set(got) == {r[0] for r in rows}


@pytest.mark.parametrize("words", [1 << 20, 1])
def test_wanted_pages_are_found_whatever_the_filter_holds(spark, monkeypatch, words):
    """A filter of one word lets many others through, which the narrow join leaves out."""
    pending = spark.createDataFrame([(f"p{i}", i) for i in range(20)], "cve_id string, ord long")
    names = [f"{k}{i}" for k in "pd" for i in range(20)] * 2
    pages = spark.createDataFrame([(f" {n}\n", 200, "x") for n in names], PAGES)
    monkeypatch.setattr(merge, "MIN_WORDS", 1)
    monkeypatch.setattr(merge, "MAX_WORDS", words)
    near = merge.wanted_pages(pages, pending)
    assert near.columns == pages.columns
    got = [(r.cve_id, r.ord) for r in merge.placed(near, pending).collect()]
    assert sorted(got) == sorted((n, int(n[1:])) for n in names if n.startswith("p"))


def test_an_id_filter_loses_nothing_and_lets_little_through(spark):
    ids = spark.range(0, 40_000, 2).select(F.col("id").cast("string").alias("cve_id"))
    rows = spark.range(40_000).select(F.col("id").cast("string").alias("cve_id"), "id")
    found = merge.may_hold(rows, ids)
    assert found.columns == ["cve_id", "id"]
    assert found.filter("id % 2 = 0").count() == 20_000
    assert found.filter("id % 2 = 1").count() < 20_000 * 0.03
    assert merge.may_hold(rows, ids.limit(0)).count() == 0
    assert [merge.filter_words(n) for n in (0, 5000, 10**12)] == [merge.MIN_WORDS, 2048, merge.MAX_WORDS]


@pytest.mark.parametrize("share, target", [(1, 40), (2, 40), (5, 30), (5, 400)])
def test_a_target_reads_little_more_than_it_needs(spark, path, share, target):
    """One page in ``share`` is good: the rows are those of a run over all, the pages read few."""
    n = 600
    ids = spark.createDataFrame([(i, f"CVE-2024-{i}") for i in range(n)], IDS)
    pages = spark.createDataFrame([(f"CVE-2024-{i}", 200, FULL if i % share == 0 else "<p>") for i in range(n)], PAGES)
    collect(ids, pages, path, run=1, target=target)
    want = [f"CVE-2024-{i}" for i in range(0, n, share)][:target]
    assert sorted(i for _, _, i in landed(spark, path)) == sorted(want)
    read = spark.read.parquet(f"{path}/_staging/verdicts").count()
    assert read <= min(n, 2 * target * share + 1)
    tried = n if len(want) < target else int(want[-1].split("-")[-1]) + 1
    assert set(rejected(spark, path, 1)) == {f"CVE-2024-{i}" for i in range(tried)} - set(want)


def test_the_first_good_copy_is_picked_by_its_place(spark, path):
    """Of equal rank the same copy is taken whatever the order of the pages."""
    copies = [("CVE-2024-1", 200, FULL.replace("CVE-2024-0001", f"CVE-2024-{i}")) for i in range(2, 9)]
    got = []
    for run in (1, 2):
        pages = spark.createDataFrame(copies[::1 if run == 1 else -1], PAGES).repartition(3)
        collect(ids_of(spark, "CVE-2024-1"), pages, f"{path}{run}", run=1)
        got.append(read_advisories(spark, f"{path}{run}").drop("run").collect())
    assert got[0] == got[1] and len(got[0]) == 1


def test_untrimmed_ids_are_collected_once(spark, path):
    ids = spark.createDataFrame([(1, " CVE-2024-1 "), (2, "CVE-2024-1")], IDS)
    pages = spark.createDataFrame([(" CVE-2024-1 ", 200, FULL)], PAGES)
    for run in (1, 2):
        collect(ids, pages, path, run=run)
    assert landed(spark, path) == [(1, 1, "CVE-2024-1")]


def test_only_ids_tried_are_counted_and_refused(spark, path):
    names = [f"CVE-2024-{n}" for n in range(1, 6)]
    pages = pages_of(spark, CVE_2024_1=404, CVE_2024_2=True, CVE_2024_3=404, CVE_2024_4=True)
    first = counters(collect(ids_of(spark, *names), pages, path, run=1, target=1))
    assert (first["successes"], first["skipped"]) == (1, 1)
    assert rejected(spark, path, 1) == {"CVE-2024-1": "http_error"}
    again = counters(collect(ids_of(spark, *names), pages, path, run=1, target=1))
    assert (again["successes"], again["skipped"]) == (0, 0)
    assert spark.read.parquet(f"{path}/runs").filter("run = 1").agg(F.sum("successes")).first()[0] == 1
    assert rejected(spark, path, 1) == {"CVE-2024-1": "http_error"}


def test_an_accepted_id_is_not_refused(spark, path):
    rows = [("CVE-2024-1", 404, None), ("CVE-2024-1", 404, None), ("CVE-2024-1", 200, FULL), ("CVE-2024-2", 404, None),
            ("CVE-2024-2", 200, "<p>")]
    done = counters(collect(ids_of(spark, "CVE-2024-1", "CVE-2024-2"), spark.createDataFrame(rows, PAGES), path, run=1))
    assert (done["successes"], done["skipped"]) == (1, 1)
    assert list(rejected(spark, path, 1)) == ["CVE-2024-2"]


def test_accepted_and_rejected_are_all_ids(spark, path):
    rng = random.Random(9)
    names = [f"CVE-2024-{n}" for n in range(200)]
    kinds = [True, 404, "<p>", FULL.replace("vulnerability-details", "x"), None]
    chosen = {n: rng.choice(kinds) for n in names}
    pages = pages_of(spark, **{n.replace("-", "_"): k for n, k in chosen.items() if k is not None})
    collect(ids_of(spark, *names), pages.repartition(5), path, run=1)
    got, refused = {i for _, _, i in landed(spark, path)}, rejected(spark, path, 1)
    assert got == {n for n, k in chosen.items() if k is True}
    assert got | set(refused) == set(names) and not got & set(refused)


def test_export(spark, tmp_path):
    lake, out = str(tmp_path / "lake"), str(tmp_path / "csv")
    names = ["CVE-2024-2", "CVE-2023-1", "CVE-2024-10"]
    collect(ids_of(spark, *names), pages_of(spark, **{n.replace("-", "_"): True for n in names}), lake, run=1)
    export_csv(spark, lake, out)
    rows = read_csv_dataset(spark, out)
    assert rows.columns == RAW_COLUMNS
    in_files = rows.select("cve_id", F.col("package")).collect()
    assert sorted(r.cve_id for r in in_files) == sorted(names)
    assert all(r.package == r.cve_id for r in in_files)


def test_id_of_unknown_form(spark, path):
    """It goes to a partition of its own and is found again."""
    for run in (1, 2):
        collect(ids_of(spark, "GHSA-x"), pages_of(spark, GHSA_x=True), path, run=run)
    assert [(r.cve_id, r.cve_year) for r in read_advisories(spark, path).collect()] == [("GHSA-x", 0)]


@pytest.mark.parametrize("n", [0, 1, 9_999, 10_000, 10_001, 25_000, 40_000])
def test_a_large_target_takes_the_same_rows(spark, monkeypatch, n):
    rows = spark.range(30_000).selectExpr("id * 7 + 1 ord", "cast(id as string) cve_id").repartition(6)
    monkeypatch.setattr(merge, "SORTED_LIMIT", -1)
    got = sorted(r.ord for r in merge.first_in_order(rows, n).collect())
    assert got == [i * 7 + 1 for i in range(min(n, 30_000))]


def test_a_run_that_died_is_run_again(spark, path, monkeypatch):
    """The rows are in, the rejects are not: the same run completes it."""
    from vulnloom.plans import collect as plan

    ids = ids_of(spark, "CVE-2024-1", "CVE-2024-2", "CVE-2024-3")
    pages = pages_of(spark, CVE_2024_1=True, CVE_2024_2="<p>")

    def die(*_):
        raise RuntimeError("executor lost")

    with monkeypatch.context() as m:
        m.setattr(plan, "write_rejects", die)
        with pytest.raises(RuntimeError):
            collect(ids, pages, path, run=1)
    assert landed(spark, path) == [(1, 1, "CVE-2024-1")]
    collect(ids, pages, path, run=1)
    assert landed(spark, path) == [(1, 1, "CVE-2024-1")]
    assert rejected(spark, path, 1) == {"CVE-2024-2": "page_not_found", "CVE-2024-3": "not_fetched"}


def test_rows_written_in_part_are_not_written_twice(spark, path):
    """What an append that died has left behind counts as collected."""
    ids = ids_of(spark, "CVE-2024-1", "CVE-2023-2")
    collect(ids_of(spark, "CVE-2023-2"), pages_of(spark, CVE_2023_2=True), path, run=1)
    collect(ids, pages_of(spark, CVE_2023_2=True, CVE_2024_1=True), path, run=1)
    assert sorted(i for _, _, i in landed(spark, path)) == ["CVE-2023-2", "CVE-2024-1"]


def test_going_on_from_a_csv_dataset(spark, tmp_path):
    lake, old, out = (str(tmp_path / n) for n in ("lake", "old", "out"))
    rows = [("CVE-2024-1", "a"), (" CVE-2024-2 ", "b"), ("CVE-2024-1", "again"), ("", "no id")]
    frame = spark.createDataFrame(rows, "cve_id string, package string")
    missing = {c: F.lit("") for c in RAW_COLUMNS if c not in frame.columns}
    write_csv_dataset(frame.coalesce(1).withColumns(missing), old)
    for _ in range(2):
        import_csv(spark, old, lake)
    names = ["CVE-2024-3", "CVE-2024-2", "CVE-2024-1"]
    pages = pages_of(spark, **{n.replace("-", "_"): True for n in names})
    row = counters(collect(ids_of(spark, *names), pages, lake, run=1, target=4))
    assert (row["existing_rows"], row["already_collected"], row["successes"]) == (3, 2, 1)
    export_csv(spark, lake, out)
    got = [(r.cve_id, r.package) for r in read_csv_dataset(spark, out).collect()]
    assert sorted(got) == sorted([*rows[:3], ("CVE-2024-3", "CVE-2024-3")])
