"""Ids and pages to new rows of the dataset."""

import hashlib
import math
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vulnloom.functions.text import strip
from vulnloom.operators import merge
from vulnloom.operators.extract import extract
from vulnloom.schema import LAKE, RAW_COLUMNS
from vulnloom.session import written, written_and_counted
from vulnloom.sources.dataset import (
    append_by_year,
    read_csv_dataset,
    read_csv_leniently,
    read_table,
    write_csv_dataset,
)


def advisories_path(lake: str) -> str:
    return f"{lake}/advisories"


def rejects_path(lake: str) -> str:
    return f"{lake}/rejects"


def read_advisories(spark: SparkSession, lake: str) -> DataFrame:
    """The dataset of a lake; its columns are LAKE."""
    return read_table(spark, advisories_path(lake), LAKE)


# Where a row of the staging table lies.
PLACE = ["_file", "_row"]
# The next ids to be tried are as many as the acceptance so far asks for, and so much more.
MARGIN = 1.05


def staged_rows(spark: SparkSession, paths: list[str], schema: StructType) -> DataFrame:
    """Extracted rows, each with its place."""
    return spark.read.schema(schema).parquet(*paths).select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")
    )


class Staging:
    """What a run or batch reads of its pages, each page once.

    ``rows`` are wide and stay where they were written. ``verdicts`` has one narrow row for
    each of them that is of a pending id: what ``pending`` tells of it, its fate, its place.
    """

    def __init__(self, pages: DataFrame, lake: str, order: list[str] = ()) -> None:
        self.pages, self.lake, self.order = pages, lake, list(order)
        self.spark = pages.sparkSession
        self.keep = [c for c in pages.columns if c not in ("cve_id", "status", "html", "cve_year", "ord")]
        self.paths: list[str] = []
        self.rows = self.verdicts = None

    def read(self, pending: DataFrame) -> DataFrame:
        """Extract the pages of some pending ids, a written table; returns their verdicts."""
        number = len(self.paths)
        own = extract(merge.wanted_pages(self.pages, pending), self.keep)
        own = own.withColumn("_tie", F.xxhash64(*RAW_COLUMNS))
        path = f"{self.lake}/_staging/rows/slice={number}"
        own.write.mode("overwrite").parquet(path)
        narrow = staged_rows(self.spark, [path], own.schema).select(
            "cve_id", "reject_reason", "reject_detail", "_tie", *self.order, *PLACE
        )
        verdicts = written(merge.placed(narrow, pending), f"{self.lake}/_staging/verdicts/slice={number}")
        self.paths.append(path)
        self.rows = staged_rows(self.spark, self.paths, own.schema)
        self.verdicts = verdicts if self.verdicts is None else self.verdicts.unionByName(verdicts)
        return verdicts


def read_until(staging: Staging, pending: DataFrame, room: int) -> tuple[int, str] | None:
    """Read pending ids in order until ``room`` of them are accepted; (ord, cve_id) of the last of these.

    Ids are read in slices: as many as would fill the room if all were accepted, then as
    many as the share accepted so far asks for, so of a share that stays alike little more
    is read than needed. None where the ids do not fill the room.
    """
    spark = pending.sparkSession
    ranked, n_ids = written_and_counted(merge.in_ord_order(pending), f"{staging.lake}/_staging/ranked")
    tried, accepted = 0, 0
    while accepted < room and tried < n_ids:
        missing = room - accepted
        share = accepted / tried if tried else 1.0
        size = math.ceil(missing / share * MARGIN) if accepted else max(missing, 2 * tried)
        path = f"{staging.lake}/_staging/slice"
        now = written(ranked.filter(F.col("_nth").between(tried + 1, tried + size)).drop("_nth"), path)
        verdicts = staging.read(now)
        accepted += verdicts.filter("reject_reason IS NULL").select("cve_id").distinct().count()
        tried = min(tried + size, n_ids)
    if not tried:
        staging.read(written(pending.limit(0), f"{staging.lake}/_staging/slice"))
    return merge.last_tried(staging.verdicts, room)


def add_rows(staging: Staging, verdicts: DataFrame, order: Column, run: int) -> int:
    """Append the first accepted row of each id; returns how many.

    The first is found among verdicts; the rows themselves are then picked by their place.
    """
    chosen, n_ids = written_and_counted(
        merge.first_success(verdicts, F.struct(order, "_tie", *PLACE), ["ord", *PLACE]),
        f"{staging.lake}/_staging/chosen",
    )
    if n_ids:
        new = staging.rows.join(chosen.select("ord", *PLACE), PLACE)
        new = new.withColumn("run", F.lit(run).cast("bigint"))
        append_by_year(new.select(*RAW_COLUMNS, "run", "ord"), advisories_path(staging.lake))
    return n_ids


def write_rejects(rejected: DataFrame, lake: str, kind: str, run: int, attempt: str) -> None:
    """Write the refused ids of one attempt at a run; only the same attempt replaces them."""
    path = f"{rejects_path(lake)}/kind={kind}/run={run}/attempt={attempt}"
    rejected.hint("rebalance").write.mode("overwrite").parquet(path)


def collect(
    ids: DataFrame, pages: DataFrame, lake: str, run: int, target: int | None = None
) -> DataFrame:
    """Add the advisories of ``ids`` that the lake does not hold yet.

    Ids already collected are dropped before any page is parsed, and only the
    difference is appended, so a run that is repeated adds nothing. Pages are never moved;
    with a ``target`` they are read in slices of ids until it is met. ``ids`` has
    (ord, cve_id), ``pages`` (cve_id, status, html). Every id tried is either added or
    in the rejects table, once: without a page, or with one reason its pages were
    refused for. Ids after the one that meets the target are not tried. Returns the
    run's counters, which are kept per attempt, like the rejects.
    """
    spark, attempt = ids.sparkSession, uuid.uuid4().hex
    existing = read_advisories(spark, lake)
    n_existing = existing.count()
    done, n_done = written_and_counted(merge.done_ids(existing), f"{lake}/_staging/done")
    pending, n_pending = written_and_counted(merge.pending_ids(ids, done), f"{lake}/_staging/pending")
    room = None if target is None else max(0, target - n_existing)
    staging = Staging(pages, lake)
    if room is None:
        staging.read(pending)
        rows = staging.verdicts
    elif room == 0:
        pending, n_pending = pending.limit(0), 0
        rows = staging.read(written(pending, f"{lake}/_staging/slice"))
    else:
        last = read_until(staging, pending, room)
        rows, pending = merge.up_to(staging.verdicts, last), merge.up_to(pending, last)
        n_pending = n_pending if last is None else pending.count()
    counts = {
        "ids_available": ids.count(),
        "existing_rows": n_existing,
        "already_collected": n_done,
        "attempted": n_pending,
    }
    added = add_rows(staging, rows, F.col("ord"), run)
    no_page = pending.join(staging.verdicts.select("cve_id"), "cve_id", "left_anti").select(
        "cve_id",
        F.lit("not_fetched").alias("reject_reason"),
        F.lit(None).cast("string").alias("reject_detail"),
    )
    write_rejects(merge.refused(rows).unionByName(no_page), lake, "collect", run, attempt)
    counters = merge.run_counters(spark, **counts, successes=added, target=target)
    return written(counters, f"{lake}/runs/run={run}/attempt={attempt}")


def bad_rows_path(lake: str) -> str:
    return f"{lake}/bad_rows"


def import_csv(spark: SparkSession, path: str, lake: str, keep_bad: bool = False) -> None:
    """Take over a CSV dataset as run 0, to be gone on from.

    Its rows are kept as they are, repeated ids too; ids the lake holds already
    are left out, so it may be done again. A record that does not fit is an error; with
    ``keep_bad`` its text goes to the lake's bad rows instead and the others are taken over.
    The CSV itself is never written to.
    """
    if keep_bad:
        given, bad = read_csv_leniently(spark, path, f"{lake}/_staging/csv")
        # Named after the source, so an import done again replaces its own.
        source = hashlib.sha256(path.encode()).hexdigest()[:16]
        bad.write.mode("overwrite").parquet(f"{bad_rows_path(lake)}/source={source}")
    else:
        given = read_csv_dataset(spark, path)
    done = written(merge.done_ids(read_advisories(spark, lake)), f"{lake}/_staging/done")
    rows = given.withColumns({
        "_id": strip(F.col("cve_id")),
        "run": F.lit(0).cast("bigint"),
        "ord": F.monotonically_increasing_id(),
    })
    new = rows.join(done.withColumnRenamed("cve_id", "_id"), "_id", "left_anti").drop("_id")
    append_by_year(written(new, f"{lake}/_staging/rows"), advisories_path(lake))


def export_csv(spark: SparkSession, lake: str, path: str) -> None:
    """Write the dataset as CSV in the order it was collected."""
    rows = read_advisories(spark, lake).orderBy("run", "ord", "cve_id")
    write_csv_dataset(rows, path)
