"""Named queries over the driver tables, one or more per operator."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vulnloom.functions.fields import event_cells, event_history, reference_links
from vulnloom.functions.text import listing_address, normalise, page_address
from vulnloom.operators import analytics, crawl_log, index, merge
from vulnloom.operators.extract import accepted, extract, rejects
from vulnloom.operators.parse import page_links, parse_pages, parse_titles
from vulnloom.operators.typed import typed
from vulnloom.plans import collect, grow_index, samples, statistics
from vulnloom.plans.oracles import ORACLES
from vulnloom.plans.samples import id_text, part_id, table
from vulnloom.schema import RAW_COLUMNS, TARGET_IDS, TARGET_RECORDS
from vulnloom.session import work_path, written
from vulnloom.sources.dataset import read_csv_dataset, write_csv_dataset
from vulnloom.sources.id_list import read_id_list, write_id_list
from vulnloom.streaming import attempts
from vulnloom.streaming.ingest import ingest, page_stream

QUERIES = {}


def query(fn):
    """Register a query under the name of its function, less a trailing ``_``."""
    QUERIES[fn.__name__.removesuffix("_")] = fn
    return fn


# -- inputs ---------------------------------------------------------------------


def _advisories(spark, sf_dir):
    """The dataset of the sample pages, read anew."""
    return accepted(extract(samples.advisory_pages(spark, sf_dir)))


def _typed(spark, sf_dir):
    return typed(_advisories(spark, sf_dir))


def _listing(spark, sf_dir):
    return index.listing_in_scope(samples.listing_pages(spark, sf_dir))


def _found(spark, sf_dir):
    """Ids of the sample listing; counts and cuts read them from a table."""
    return written(index.discovered(_listing(spark, sf_dir)), work_path(spark, "found-ids"))


def _order_ids(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        id_text(F.year("o_orderdate"), F.col("o_orderkey")).alias("cve_id")
    )


def _customer_ids(spark, sf_dir):
    """(listed ids, ids already collected)."""
    ids = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("ord"), id_text(F.lit(2024), F.col("o_custkey")).alias("cve_id")
    )
    year = F.when(F.col("c_acctbal") < 0, 2024).otherwise(2023)
    existing = table(spark, sf_dir, "customer").select(id_text(year, F.col("c_custkey")).alias("cve_id"))
    return ids, existing


def _part_ids(spark, sf_dir):
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(key.alias("ord"), part_id(key).alias("cve_id"))


# -- sources and sinks ------------------------------------------------------------


@query
def id_lines(spark, sf_dir):
    path = work_path(spark, "lines")
    table(spark, sf_dir, "documents").orderBy("doc_id").select("text").write.text(path)
    return read_id_list(spark, path).select("ord", F.md5("cve_id").alias("line_md5"))


@query
def id_list_file(spark, sf_dir):
    path = work_path(spark, "ids")
    write_id_list(_order_ids(spark, sf_dir).distinct(), path)
    return read_id_list(spark, path)


@query
def csv_dataset(spark, sf_dir):
    path = work_path(spark, "csv")
    write_csv_dataset(_advisories(spark, sf_dir), path)
    return read_csv_dataset(spark, path)


@query
def page_addresses(spark, sf_dir):
    key = F.col("p_partkey")
    directory = F.concat(F.floor(key / 1000).cast("string"), F.lit("xxx"))
    return table(spark, sf_dir, "part").select(
        page_address(part_id(key)).alias("address"),
        listing_address(2020 + key % 7).alias("year_page"),
        listing_address(2020 + key % 7, directory).alias("range_page"),
    )


# -- page structure ---------------------------------------------------------------


def _raw_pages(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", "html")


@query
def link_extract(spark, sf_dir):
    links = page_links(_raw_pages(spark, sf_dir))
    return links.withColumn("link_pos", F.col("link_pos").cast("bigint"))


@query
def page_title(spark, sf_dir):
    return parse_titles(_raw_pages(spark, sf_dir)).select("page_id", F.col("page.title").alias("title"))


@query
def text_normalise(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.md5(normalise(F.col("text"))).alias("text_md5")
    )


@query
def details_text(spark, sf_dir):
    rows = extract(samples.document_pages(spark, sf_dir), keep=["doc_id"])
    return rows.select(
        "doc_id",
        F.length("details").cast("bigint").alias("n_chars"),
        F.md5("details").alias("details_md5"),
    )


# -- advisory fields ----------------------------------------------------------------


def _from_pages(spark, sf_dir, *columns):
    return accepted(extract(samples.advisory_pages(spark, sf_dir))).select(*columns)


@query
def advisory_fields(spark, sf_dir):
    return _from_pages(spark, sf_dir, *RAW_COLUMNS)


@query
def severity_parse(spark, sf_dir):
    return _from_pages(
        spark, sf_dir, "cve_id", "severity", "cvss_score", "cvss_version", "cvss_vector"
    )


@query
def events_range(spark, sf_dir):
    return _from_pages(
        spark, sf_dir, "cve_id", "ecosystem", "package", "range_type", "repo", "introduced", "fixed"
    )


def _accepted_structs(spark, sf_dir):
    pages = parse_pages(samples.advisory_pages(spark, sf_dir))
    return pages.filter("status = 200 AND page.has_page AND page.has_details")


@query
def event_history_(spark, sf_dir):
    cells = event_cells(F.col("page.range"))
    return (
        _accepted_structs(spark, sf_dir)
        .select("cve_id", cells.alias("cells"))
        .select("cve_id", F.inline(event_history(F.col("cells"))))
        .withColumn("pos", F.col("pos").cast("bigint"))
    )


@query
def cwe_cna(spark, sf_dir):
    return _from_pages(spark, sf_dir, "cve_id", "cwe_ids", "cna_assigner")


@query
def reference_links_(spark, sf_dir):
    links = reference_links(F.col("page.details"))
    return (
        _accepted_structs(spark, sf_dir)
        .select("cve_id", F.posexplode(links).alias("link_pos", "href"))
        .withColumn("link_pos", F.col("link_pos").cast("bigint"))
    )


@query
def rejects_(spark, sf_dir):
    rows = extract(samples.advisory_pages(spark, sf_dir))
    return rejects(rows).select("cve_id", "reject_reason")


@query
def id_mismatch(spark, sf_dir):
    rows = extract(samples.advisory_pages(spark, sf_dir))
    return rows.filter("reject_reason IS NULL").select("cve_id", "id_mismatch")


# -- index --------------------------------------------------------------------------


@query
def index_directories(spark, sf_dir):
    nth = F.dense_rank().over(
        Window.partitionBy("year", "page_no").orderBy("dir_pos")
    )
    return index.directories(_listing(spark, sf_dir)).select(
        F.col("year").cast("bigint").alias("year"), "directory",
        F.col("page_no").cast("bigint").alias("page_no"), nth.cast("bigint").alias("nth"),
    )


@query
def index_ids(spark, sf_dir):
    return index.discovered(_listing(spark, sf_dir)).select(
        "cve_id", F.col("year").cast("bigint").alias("year"), "directory"
    )


def _grown(spark, sf_dir):
    """An index that got every other listing page first, then the rest, and the rest once more."""
    path = work_path(spark, "index")
    pages = samples.listing_pages(spark, sf_dir)
    half = F.pmod(F.xxhash64("year", "directory", "page_no"), F.lit(2))
    for batch, part in ((1, 0), (2, 1), (2, 1)):
        grow_index.add_pages(pages.filter(half == part), path, batch)
    return path


@query
def index_in_batches(spark, sf_dir):
    return grow_index.ids_of(spark, _grown(spark, sf_dir)).select(
        "cve_id", F.col("year").cast("bigint").alias("year"), "directory"
    )


@query
def index_counts_in_batches(spark, sf_dir):
    return grow_index.running_counts(spark, _grown(spark, sf_dir)).select(
        F.col("year").cast("bigint").alias("year"), "directory", "new_ids", "collected"
    )


@query
def index_first_n(spark, sf_dir):
    return index.first_n(index.discovered(_listing(spark, sf_dir)), TARGET_IDS).select("cve_id")


@query
def index_first_n_by_totals(spark, sf_dir):
    found = _found(spark, sf_dir)
    return index.first_by_totals(found, found.count() // 2).select("cve_id")


@query
def index_year_counts(spark, sf_dir):
    counts = index.year_counts(_listing(spark, sf_dir), _found(spark, sf_dir))
    return counts.withColumn("year", F.col("year").cast("bigint"))


@query
def index_running_counts(spark, sf_dir):
    counts = index.running_counts(_listing(spark, sf_dir), _found(spark, sf_dir))
    return counts.select(
        F.col("year").cast("bigint").alias("year"), "directory", "new_ids", "collected"
    )


@query
def index_totals(spark, sf_dir):
    return index.index_totals(_found(spark, sf_dir), TARGET_IDS)


@query
def id_rank(spark, sf_dir):
    return index.ranked(_order_ids(spark, sf_dir))


@query
def id_preview(spark, sf_dir):
    return index.preview(index.first_n(_found(spark, sf_dir), TARGET_IDS))


# -- joins, limits and set operations of a run -----------------------------------------


@query
def pending(spark, sf_dir):
    ids, existing = _customer_ids(spark, sf_dir)
    return merge.pending_ids(ids, merge.done_ids(existing)).select("cve_id", "ord")


@query
def until_target(spark, sf_dir):
    ids, existing = _customer_ids(spark, sf_dir)
    new = merge.pending_ids(ids, merge.done_ids(existing))
    return merge.until_target(existing, new, TARGET_RECORDS)


@query
def run_counters(spark, sf_dir):
    counters = collect.collect(
        _part_ids(spark, sf_dir), samples.advisory_pages(spark, sf_dir),
        work_path(spark, "lake"), run=1,
    )
    return counters.drop("target")


@query
def collect_runs(spark, sf_dir):
    lake, ids = work_path(spark, "lake"), _part_ids(spark, sf_dir)
    collect.collect(ids, samples.advisory_pages(spark, sf_dir), lake, run=1)
    collect.collect(ids, samples.advisory_pages(spark, sf_dir, healed=True), lake, run=2)
    return collect.read_advisories(spark, lake).select("cve_id", "run", "ord", "package", "cwe_ids")


@query
def csv_resume(spark, sf_dir):
    """A CSV dataset is taken over and gone on from with the pages that failed."""
    lake, old = work_path(spark, "lake"), work_path(spark, "csv")
    write_csv_dataset(_advisories(spark, sf_dir), old)
    collect.import_csv(spark, old, lake)
    healed = samples.advisory_pages(spark, sf_dir, healed=True)
    collect.collect(_part_ids(spark, sf_dir), healed, lake, run=1)
    return collect.read_advisories(spark, lake).select("cve_id", "run", "package", "cwe_ids")


@query
def csv_bad_rows(spark, sf_dir):
    """A CSV with records of too few and of too many cells is taken over; these are kept as they are."""
    lake, old = work_path(spark, "lake"), work_path(spark, "csv")
    samples.csv_lines(spark, sf_dir, old)
    collect.import_csv(spark, f"{old}/*", lake, keep_bad=True)
    bad = spark.read.parquet(collect.bad_rows_path(lake))
    return collect.read_advisories(spark, lake).select(
        F.lit("row").alias("kind"), F.concat_ws("|", "cve_id", "summary", "references").alias("content")
    ).unionByName(bad.select(F.lit("bad").alias("kind"), F.col("record").alias("content")))


def _two_runs(spark, sf_dir):
    """A lake filled by a run, and by another one after pages have healed, with statistics of each."""
    lake, ids = work_path(spark, "lake"), _part_ids(spark, sf_dir)
    for run, healed in ((1, False), (2, True)):
        collect.collect(ids, samples.advisory_pages(spark, sf_dir, healed=healed), lake, run=run)
        statistics.keep_statistics(spark, lake, run)
    return lake


@query
def profile_over_runs(spark, sf_dir):
    """The profile merged from what was kept of each run; its estimates lie close to exact counts."""
    lake = _two_runs(spark, sf_dir)
    exact = analytics.profile(collect.read_advisories(spark, lake)).select(
        "column", F.col("distinct_values").alias("exact")
    )
    near = F.abs(F.col("distinct_values") - F.col("exact")) <= 0.04 * F.col("exact")
    return statistics.profile(spark, lake).join(exact, "column").select(
        "column", "rows", "filled", near.alias("is_near")
    )


@query
def score_summary_over_runs(spark, sf_dir):
    return statistics.score_summary(spark, _two_runs(spark, sf_dir), "ecosystem")


@query
def collect_to_target(spark, sf_dir):
    lake = work_path(spark, "lake")
    collect.collect(
        _part_ids(spark, sf_dir), samples.advisory_pages(spark, sf_dir), lake, run=1,
        target=TARGET_RECORDS,
    )
    return collect.read_advisories(spark, lake).select("cve_id", "ord")


@query
def run_rejects(spark, sf_dir):
    lake, key = work_path(spark, "lake"), F.col("s_suppkey")
    no_pages = table(spark, sf_dir, "supplier").select(
        (-1 - key).alias("ord"), id_text(F.lit(2019), key).alias("cve_id")
    )
    ids = _part_ids(spark, sf_dir).unionByName(no_pages)
    collect.collect(ids, samples.advisory_pages(spark, sf_dir), lake, run=1)
    return spark.read.parquet(collect.rejects_path(lake)).select("cve_id", "reject_reason", "reject_detail")


@query
def run_counters_to_target(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    counters = collect.collect(
        _part_ids(spark, sf_dir), samples.advisory_pages(spark, sf_dir),
        work_path(spark, "lake"), run=1, target=max(1, parts.count() // 4),
    )
    return counters.drop("target")


@query
def target_rejects(spark, sf_dir):
    lake, parts = work_path(spark, "lake"), table(spark, sf_dir, "part")
    collect.collect(
        _part_ids(spark, sf_dir), samples.advisory_pages(spark, sf_dir), lake, run=1,
        target=max(1, parts.count() // 4),
    )
    return spark.read.parquet(collect.rejects_path(lake)).select("cve_id", "reject_reason", "reject_detail")


@query
def stream_ingest(spark, sf_dir):
    lake, landing = work_path(spark, "lake"), work_path(spark, "landing")
    for healed in (False, True):
        samples.advisory_pages(spark, sf_dir, healed).write.mode("append").parquet(landing)
        ingest(page_stream(spark, landing), lake, f"{lake}/_checkpoint").awaitTermination()
    return (
        collect.read_advisories(spark, lake)
        .groupBy("cve_id", "package", "cwe_ids")
        .agg(F.count("*").alias("copies"))
    )


# -- crawl log ----------------------------------------------------------------------------


@query
def response_class(spark, sf_dir):
    log = samples.fetch_log(spark, sf_dir)
    return log.groupBy(crawl_log.response_class(F.col("status")).alias("response")).agg(
        F.count("*").alias("n")
    )


@query
def fetch_outcome(spark, sf_dir):
    frontier = crawl_log.retry_frontier(samples.fetch_log(spark, sf_dir))
    return frontier.withColumns({
        "attempt": F.col("attempt").cast("bigint"), "status": F.col("status").cast("bigint")
    })


@query
def live_frontier(spark, sf_dir):
    """The same log taken in as a stream, a file a batch, and when each id is due."""
    path, landing = work_path(spark, "attempts"), work_path(spark, "landing")
    instant = F.expr("TIMESTAMP '1970-01-01 00:00:00Z' + (ts - TIMESTAMP_NTZ '1970-01-01 00:00:00')")
    samples.fetch_log(spark, sf_dir).withColumn("ts", instant).repartition(3).write.parquet(landing)
    log = attempts.attempt_stream(spark, landing, maxFilesPerTrigger=1)
    attempts.follow(log, path, f"{path}/_checkpoint").awaitTermination()
    return attempts.frontier(spark, path).select(
        "cve_id", F.col("attempt").cast("bigint").alias("attempt"), "outcome", "wait_seconds",
        F.unix_millis("due_at").alias("due_ms"),
    )


# -- analytics --------------------------------------------------------------------------------


@query
def top_cwes_from_html(spark, sf_dir):
    rows = accepted(extract(samples.advisory_pages(spark, sf_dir)))
    return analytics.top_weaknesses(typed(rows))


@query
def typed_view(spark, sf_dir):
    def count_of(column):
        return F.size(column).cast("bigint")

    return _typed(spark, sf_dir).select(
        "cve_id",
        F.col("cve_year").cast("bigint").alias("cve_year"),
        "cve_seq",
        F.unix_millis("published").alias("published_ms"),
        F.unix_millis("modified").alias("modified_ms"),
        F.col("cvss_score").cast("double").alias("cvss_score"),
        "cvss_version",
        "severity_band",
        F.try_element_at("cvss_metrics", F.lit("AV")).alias("attack_vector"),
        "fixed",
        count_of("aliases").alias("n_aliases"),
        count_of("cwe_ids").alias("n_cwe"),
        count_of("references").alias("n_references"),
    )


@query
def column_profile(spark, sf_dir):
    return analytics.profile(_advisories(spark, sf_dir))


@query
def severity_dist(spark, sf_dir):
    return analytics.severity_distribution(_typed(spark, sf_dir))


@query
def score_summary_by_version(spark, sf_dir):
    return analytics.score_summary(_typed(spark, sf_dir), "cvss_version")


@query
def score_summary_by_ecosystem(spark, sf_dir):
    return analytics.score_summary(_typed(spark, sf_dir), "ecosystem")


@query
def score_histogram(spark, sf_dir):
    return analytics.score_histogram(_typed(spark, sf_dir))


@query
def top_cwes(spark, sf_dir):
    return analytics.top_weaknesses(_typed(spark, sf_dir))


@query
def ecosystem_counts(spark, sf_dir):
    return analytics.ecosystem_counts(_typed(spark, sf_dir))


@query
def top_packages(spark, sf_dir):
    rows = analytics.top_packages(_typed(spark, sf_dir))
    return rows.withColumn("place", F.col("place").cast("bigint"))


@query
def monthly_trend(spark, sf_dir):
    months = analytics.monthly_trend(_typed(spark, sf_dir))
    return months.withColumn("month", F.date_format("month", "yyyy-MM"))


@query
def vector_metrics(spark, sf_dir):
    return analytics.metric_counts(_typed(spark, sf_dir))


@query
def fix_share(spark, sf_dir):
    return analytics.fix_share(_typed(spark, sf_dir))


ORACLES["top_cwes_from_html"] = ORACLES["top_cwes"]
ORACLES["index_in_batches"] = ORACLES["index_ids"]
ORACLES["index_counts_in_batches"] = ORACLES["index_running_counts"]
