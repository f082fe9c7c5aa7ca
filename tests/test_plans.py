"""What the physical plans must and must not do."""

import re

import pytest
from golden import FULL
from pyspark.sql import functions as F

from vulnloom.operators import analytics, index, merge
from vulnloom.operators.extract import accepted, extract
from vulnloom.operators.typed import typed
from vulnloom.plans.catalog import QUERIES
from vulnloom.schema import LISTING_PAGES, PAGES
from vulnloom.sources.dataset import append_by_year
from vulnloom.sources.pages import read_pages


def plan_of(frame, run=False):
    if run:
        frame.collect()
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def lake_pages(spark, tmp_path_factory):
    """Pages of five years in many files."""
    path = str(tmp_path_factory.mktemp("lake") / "pages")
    rows = [(f"CVE-{2020 + i % 5}-{i:04d}", 200, FULL) for i in range(100)]
    append_by_year(spark.createDataFrame(rows, PAGES), path)
    return path


@pytest.mark.parametrize("name", QUERIES)
def test_no_query_pairs_rows_or_runs_a_row_udf(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert node not in plan


def test_pages_are_parsed_where_they_lie(spark, lake_pages):
    """From scan to dataset row no page is moved."""
    plan = plan_of(accepted(extract(read_pages(spark, lake_pages))))
    assert "Exchange" not in plan and plan.count("MapInArrow") == 1


def test_a_narrow_question_computes_few_fields(spark, lake_pages):
    plan = plan_of(extract(read_pages(spark, lake_pages)).groupBy("cvss_version").count())
    assert "CVSS_V" in plan and "cna_assigner" not in plan


def test_an_id_filter_is_broadcast_and_years_pruned(spark, lake_pages):
    pending = spark.createDataFrame([("CVE-2021-0001",), ("GHSA-x",)], "cve_id string")
    wanted = merge.wanted_pages(read_pages(spark, lake_pages), pending)
    assert [r.cve_id for r in wanted.collect()] == ["CVE-2021-0001"]
    plan = plan_of(wanted)
    assert "BroadcastHashJoin" in plan
    assert set(re.findall(r"Exchange hashpartitioning\((\w+)#", plan)) == {"_word"}
    assert re.search(r"PartitionFilters: \[[^\]]*cve_year#\d+ IN \(", plan)


def test_too_many_years_prune_nothing(spark, lake_pages, monkeypatch):
    monkeypatch.setattr(merge, "MAX_YEARS", 2)
    ids = spark.createDataFrame([(f"CVE-{y}-0001",) for y in range(2000, 2030)], "cve_id string")
    pages = read_pages(spark, lake_pages)
    assert merge.in_years_of(pages, ids).count() == pages.count() == 100
    assert merge.in_years_of(pages, ids.limit(0)).count() == 0


def test_no_page_is_moved_for_a_large_id_set(spark, lake_pages, path):
    """Broadcasts of Spark's own choice off: what shuffles are words of the filter and narrow verdicts."""
    from vulnloom.plans.collect import PLACE

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ids = spark.range(200_000).selectExpr("concat('CVE-2024-', id) cve_id", "id ord")
        rows = extract(merge.wanted_pages(read_pages(spark, lake_pages), ids))
        plan = plan_of(rows)
        assert set(re.findall(r"Exchange hashpartitioning\((\w+)#", plan)) == {"_word"}
        assert plan.count("MapInArrow") == 1 and "SortMergeJoin" not in plan
        rows.withColumns({"_tie": F.lit(1), **{c: F.lit(1) for c in PLACE}}).write.parquet(path)
        kept = spark.read.parquet(path).select("cve_id", "reject_reason", "_tie", *PLACE)
        schema = re.findall(r"ReadSchema: struct<([^>]*)>", plan_of(merge.placed(kept, ids)))
        assert not any("references" in columns or "html" in columns for columns in schema)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_listing_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "listing")
    spark.createDataFrame([(2024, None, 0, 200, "x")], LISTING_PAGES).write.parquet(path)
    scope = index.listing_in_scope(spark.read.schema(LISTING_PAGES).parquet(path))
    plan = plan_of(index.directories(scope))
    pushed = re.search(r"PushedFilters: \[([^\]]*)\]", plan).group(1)
    for part in ("GreaterThanOrEqual(year,2020)", "LessThanOrEqual(year,2026)", "EqualTo(status,200)", "IsNull(directory)"):
        assert part in pushed
    counts = plan_of(scope.filter("directory IS NOT NULL").select("year", "directory").distinct())
    assert "html" not in counts


def test_analytics_read_their_columns_only(spark, tmp_path, lake_pages):
    path = str(tmp_path / "advisories")
    accepted(extract(read_pages(spark, lake_pages))).write.parquet(path)
    view = typed(spark.read.parquet(path))
    read = {
        "severity": analytics.severity_distribution(view),
        "cwe_ids": analytics.top_weaknesses(view),
        "published": analytics.monthly_trend(view),
        "cvss_vector": analytics.metric_counts(view),
        "ecosystem": analytics.ecosystem_counts(view),
    }
    for column, frame in read.items():
        schemas = set(re.findall(r"ReadSchema: struct<([^>]*)>", plan_of(frame)))
        assert schemas - {""} == {f"{column}:string"}


def test_rank_is_limited_before_the_shuffle(spark, lake_pages):
    view = typed(accepted(extract(read_pages(spark, lake_pages))))
    plan = plan_of(analytics.top_packages(view))
    partial, final = plan.index("3, Partial"), plan.index("3, Final")
    assert final < plan.index("Exchange hashpartitioning(ecosystem") < partial


def test_first_ids_are_a_bounded_sort(spark):
    ids = spark.range(100_000).selectExpr(
        "string(id) cve_id", "2024 year", "0 page_no", "0 dir_pos", "id link_pos", "'1xxx' directory"
    )
    assert "TakeOrderedAndProject" in plan_of(index.first_n(ids, 5000))


def test_copies_are_reduced_before_the_shuffle(spark):
    rows = spark.range(100).selectExpr("'a' cve_id", "id ord", "cast(null as string) reject_reason")
    plan = plan_of(merge.first_success(rows, F.col("ord"), ["ord"]))
    assert plan.index("partial_min") > plan.index("Exchange")


def test_first_rows_are_picked_by_place_not_aggregated(spark, path):
    """What is aggregated are verdicts; the 22 columns are joined to the chosen places."""
    from vulnloom.plans.collect import Staging, add_rows, read_advisories

    pages = spark.createDataFrame([(f"CVE-2024-{i % 9}", 200, FULL) for i in range(30)], PAGES)
    pending = spark.createDataFrame([(f"CVE-2024-{i}", i) for i in range(9)], "cve_id string, ord bigint")
    staging = Staging(pages, path)
    verdicts = staging.read(pending)
    assert set(verdicts.columns) == {"cve_id", "ord", "reject_reason", "reject_detail", "_tie", "_file", "_row"}
    assert add_rows(staging, verdicts, F.col("ord"), 1) == 9
    assert read_advisories(spark, path).count() == 9
    plan = plan_of(merge.first_success(verdicts, F.col("ord"), ["ord", "_file", "_row"]))
    assert "references" not in plan and "details" not in plan.replace("reject_detail", "")


def test_ids_are_sorted_by_ready_columns(spark):
    """A sort on expressions would work them out at every comparison."""
    ids = spark.range(100).selectExpr("concat('CVE-2024-', id) cve_id")
    (sort,) = re.findall(r"Sort \[([^\]]*)\]", plan_of(index.in_id_order(ids)))
    assert "split_part" not in sort and "_year" in sort and "_seq" in sort
