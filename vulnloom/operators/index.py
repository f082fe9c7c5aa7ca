"""From listing pages to the ordered id index."""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vulnloom.functions.text import id_sequence, id_year
from vulnloom.operators.parse import might_hold, page_links, parse_links
from vulnloom.operators.running import running_total
from vulnloom.schema import (
    FIRST_YEAR,
    LAST_YEAR,
    LISTING_PREFIX,
    PREVIEW_FIRST,
    PREVIEW_LAST,
)
from vulnloom.session import work_path, written

# --- Fixed values ---------------------------------------------------------------
RANGE_DIRECTORY = r"^[0-9]+xxx\z"
ID_FILE = r"-[0-9]{4,}\.json"
FILE_SUFFIX = ".json"
# ----------------------------------------------------------------------------------

# Ids whose sequence numbers share this quotient are numbered together.
RANK_BLOCK = 10_000
# Ids that one task puts in order when ids are ranked.
RANKED_ROWS = 100_000
# Up to here the first ids are found by a bounded sort, beyond it by totals.
SORTED_LIMIT = 50_000


def listing_in_scope(
    listing: DataFrame, first_year: int = FIRST_YEAR, last_year: int = LAST_YEAR
) -> DataFrame:
    """Readable listing pages of the wanted years, both ends included."""
    return listing.filter(F.col("year").between(first_year, last_year) & (F.col("status") == 200))


def _match(text: Column, pattern: Column, group: int) -> Column:
    """A group of the first match of a pattern that is itself a column, or ''."""
    return F.call_function("regexp_extract", text, pattern, F.lit(group))


def directories(listing: DataFrame, prefix: str = LISTING_PREFIX) -> DataFrame:
    """Range directories the year pages link to: year, directory, page_no, dir_pos.

    A directory counts where it is linked first. ``prefix`` is plain text.
    """
    years = listing.filter("directory IS NULL").select(
        "year", F.coalesce("page_no", F.lit(0)).alias("page_no"), "html"
    )
    quoted = F.lit("\\Q" + prefix.replace("\\E", "\\E\\\\E\\Q") + "\\E")
    pattern = F.concat(quoted, F.col("year").cast("string"), F.lit("/([^/]+)"))
    found = page_links(years).withColumn("directory", _match(F.col("href"), pattern, 1))
    ranges = found.filter(F.col("directory").rlike(RANGE_DIRECTORY))
    return first_links(ranges.withColumnRenamed("link_pos", "dir_pos"))


def first_links(found: DataFrame) -> DataFrame:
    """Where each directory is linked first; it may be linked by several pages, or parts of an index."""
    return (
        found.groupBy("year", "directory")
        .agg(F.min(F.struct("page_no", "dir_pos")).alias("at"))
        .select("year", "directory", "at.*")
    )


def range_ids(listing: DataFrame) -> DataFrame:
    """Ids the range pages link to: year, directory, link_pos, cve_id.

    Repeats within a page are dropped in the page's own row; ``link_pos`` is
    the place among the ids that remain.
    """
    ranges = listing.filter("directory IS NOT NULL").select(
        "year", "directory", F.when(might_hold(F.col("html"), "CVE-"), F.col("html")).alias("html")
    )
    pattern = F.concat(F.lit("CVE-"), F.col("year").cast("string"), F.lit(ID_FILE))
    names = F.transform("page.anchors", lambda href: _match(href, pattern, 0))
    ids = F.transform(
        F.array_distinct(F.filter(names, lambda name: name != "")),
        lambda name: F.left(name, F.length(name) - len(FILE_SUFFIX)),
    )
    return parse_links(ranges).select(
        "year", "directory", F.posexplode(ids).alias("link_pos", "cve_id")
    )


def discovered(listing: DataFrame, prefix: str = LISTING_PREFIX) -> DataFrame:
    """Distinct ids with the place each was seen first.

    An id holds its year, so it is only ever found under that year. The HTML is
    read in place; what is joined are short id rows.
    """
    return first_places(range_ids(listing), directories(listing, prefix))


def first_places(links: DataFrame, dirs: DataFrame) -> DataFrame:
    """Distinct ids of ``links`` with the first place the directories give them."""
    place = ["year", "page_no", "dir_pos", "link_pos", "directory"]
    return (
        links.join(dirs, ["year", "directory"])
        .groupBy("cve_id")
        .agg(F.min(F.struct(*place)).alias("at"))
        .select("cve_id", *[f"at.{c}" for c in place])
    )


def first_n(ids: DataFrame, n: int | None) -> DataFrame:
    """The first ``n`` ids in discovery order, or all; either way of finding them gives the same."""
    if n is None:
        return ids
    if n <= SORTED_LIMIT:
        return ids.orderBy("year", "page_no", "dir_pos", "link_pos", "cve_id").limit(n)
    return first_by_totals(ids, n)


def first_by_totals(ids: DataFrame, n: int) -> DataFrame:
    """The same for an ``n`` too large to sort in one task.

    ``ids`` is read several times: give it a table.
    """
    blocked = ids.withColumn("_block", F.floor(F.col("link_pos") / RANK_BLOCK))
    placed = running_total(
        blocked, [], [["year"], ["page_no"], ["dir_pos"], ["_block"]], ["link_pos", "cve_id"],
        F.lit(1), "_nth",
    )
    return placed.filter(F.col("_nth") <= n).select(*ids.columns)


def readable(listing: DataFrame) -> DataFrame:
    return listing.filter("directory IS NOT NULL").select("year", "directory").distinct()


def new_ids(dirs: DataFrame, opened: DataFrame, ids: DataFrame) -> DataFrame:
    """Directories that were opened, with the number of ids first seen in them."""
    new = ids.groupBy("year", "directory").agg(F.count("*").alias("new_ids"))
    return (
        dirs.join(opened, ["year", "directory"])
        .join(new, ["year", "directory"], "left")
        .fillna(0, ["new_ids"])
    )


def visited(
    listing: DataFrame, ids: DataFrame, target: int | None = None, prefix: str = LISTING_PREFIX
) -> DataFrame:
    """Readable range directories in discovery order, with their new ids.

    ``ids`` are the ids kept. With a ``target``, directories after the one that
    met it were never opened and are left out.
    """
    opened = new_ids(directories(listing, prefix), readable(listing), ids)
    if target is None:
        return opened
    return (
        running_total(
            opened, [], [["year"], ["page_no"]], ["dir_pos"], F.col("new_ids"), "_upto"
        )
        .filter(F.col("_upto") - F.col("new_ids") < target)
        .drop("_upto")
    )


def running_counts(
    listing: DataFrame, ids: DataFrame, target: int | None = None, prefix: str = LISTING_PREFIX
) -> DataFrame:
    """Per directory opened, the ids found in its year so far."""
    return running_in_year(visited(listing, ids, target, prefix))


def running_in_year(opened: DataFrame) -> DataFrame:
    """Directories opened, with the ids found in their year so far."""
    return running_total(
        opened, ["year"], [["page_no"]], ["dir_pos"], F.col("new_ids"), "collected"
    ).select("year", "directory", "page_no", "dir_pos", "new_ids", "collected")


def year_counts(listing: DataFrame, ids: DataFrame, target: int | None = None) -> DataFrame:
    """New ids and the total so far, per readable year opened.

    A year without any counts 0; years after the target was met are left out.
    """
    years = listing.filter("directory IS NULL").select("year").distinct()
    found = ids.groupBy("year").agg(F.count("*").alias("new_ids"))
    counted = years.join(found, "year", "left").fillna(0, ["new_ids"])
    # One row per year, of which there are few.
    totals = running_total(counted, [], [], ["year"], F.col("new_ids"), "total")
    return totals if target is None else totals.filter(F.col("total") - F.col("new_ids") < target)


def index_totals(ids: DataFrame, target: int | None = None) -> DataFrame:
    """Ids discovered, and how many of them the target lets through."""
    n = F.count("*")
    saved = n if target is None else F.least(n, F.lit(target).cast("bigint"))
    return ids.agg(n.alias("discovered"), saved.alias("saved"))


def with_id_parts(ids: DataFrame) -> DataFrame:
    """Add ``_year`` and ``_seq``, the id's numbers; -1 where it has none.

    As columns they are worked out once per row, not at each comparison of a sort.
    """
    return ids.withColumns({
        "_year": F.coalesce(id_year(F.col("cve_id")), F.lit(-1)),
        "_seq": F.coalesce(id_sequence(F.col("cve_id")), F.lit(-1)),
    })


def in_id_order(ids: DataFrame) -> DataFrame:
    """Sorted by year and sequence as numbers: 9999 comes before 10000."""
    return with_id_parts(ids).orderBy("_year", "_seq", "cve_id").select(*ids.columns)


def ranked(ids: DataFrame, rows: int = RANKED_ROWS) -> DataFrame:
    """Distinct ids with their 1-based place in id order, as ``position``.

    Blocks are ranges of the order itself, cut at sampled ids to about ``rows`` each, so ids
    without numbers, or of one year, fill as many blocks as they need.
    """
    spark, order = ids.sparkSession, ["_year", "_seq", "cve_id"]
    own = written(ids.select("cve_id").distinct(), work_path(spark, "rank-ids"))
    n_blocks = max(1, math.ceil(own.count() / rows))
    # Written, so a task run again finds the blocks as they were cut.
    blocks = written(
        with_id_parts(own).repartitionByRange(n_blocks, *order).withColumn("_block", F.spark_partition_id()),
        work_path(spark, "rank-blocks"),
    )
    return running_total(blocks, [], [["_block"]], order, F.lit(1), "position").select("cve_id", "position")


def preview(ids: DataFrame, first: int = PREVIEW_FIRST, last: int = PREVIEW_LAST) -> DataFrame:
    """The first and last ids, marked by ``part``, each in id order."""
    keyed = with_id_parts(ids.select("cve_id"))
    order = ["_year", "_seq", "cve_id"]
    head = keyed.orderBy(*order).limit(first).withColumn("part", F.lit("first"))
    tail = keyed.orderBy(*map(F.desc, order)).limit(last).withColumn("part", F.lit("last"))
    return head.unionByName(tail).orderBy("part", *order).select("part", "cve_id")
