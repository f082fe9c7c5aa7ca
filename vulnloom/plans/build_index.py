"""Listing pages to the sorted id list."""

from dataclasses import dataclass

from pyspark.sql import DataFrame

from vulnloom.operators import index
from vulnloom.schema import FIRST_YEAR, LAST_YEAR, LISTING_PREFIX
from vulnloom.session import work_path, written
from vulnloom.sources.id_list import write_id_list


@dataclass
class IndexRun:
    """Frames over a finished index run."""

    ids: DataFrame
    years: DataFrame
    directories: DataFrame
    totals: DataFrame
    preview: DataFrame


def build_index(
    listing: DataFrame,
    path: str,
    target: int | None = None,
    first_year: int = FIRST_YEAR,
    last_year: int = LAST_YEAR,
    prefix: str = LISTING_PREFIX,
) -> IndexRun:
    """Write the ids found, sorted, or the first ``target`` of them, and report on the run.

    The ids found are written before they are cut and counted. The report per directory
    reads the year pages again.
    """
    spark = listing.sparkSession
    pages = index.listing_in_scope(listing, first_year, last_year)
    found = written(index.discovered(pages, prefix), work_path(spark, "found-ids"))
    kept = index.first_n(found, target)
    write_id_list(kept, path)
    return IndexRun(
        ids=kept,
        years=index.year_counts(pages, kept, target),
        directories=index.running_counts(pages, kept, target, prefix),
        totals=index.index_totals(kept, target),
        preview=index.preview(kept),
    )
