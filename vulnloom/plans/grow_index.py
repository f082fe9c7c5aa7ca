"""An index that listing pages are added to as they come.

An id holds its year and is only ever found under it, so years are blocks that never meet:
a batch reads again what is kept of the years it has pages of, and of no other. Pages are
parsed once; what is kept of them are links and places.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vulnloom.operators import index
from vulnloom.schema import FIRST_YEAR, LAST_YEAR, LISTING_PREFIX
from vulnloom.sources.dataset import read_table

LINKS = "directory string, link_pos int, cve_id string, batch bigint, year int"
DIRECTORIES = "year int, directory string, page_no int, dir_pos int, batch bigint"
OPENED = "year int, directory string, batch bigint"
IDS = "cve_id string, page_no int, dir_pos int, link_pos int, directory string, year int"
TOTALS = "directory string, page_no int, dir_pos int, new_ids bigint, year int"


def add_pages(
    listing: DataFrame,
    path: str,
    batch: int,
    first_year: int = FIRST_YEAR,
    last_year: int = LAST_YEAR,
    prefix: str = LISTING_PREFIX,
) -> None:
    """Add listing pages to the index at ``path``, which then equals that of all pages at once.

    Pages may come in any order: ids wait for the year page that links to their directory, and
    a directory may turn out to be linked earlier. A batch that is run again, or was cut short,
    replaces what it wrote. One writer per index.
    """
    spark = listing.sparkSession
    pages = index.listing_in_scope(listing, first_year, last_year)
    (
        index.range_ids(pages).hint("rebalance", F.col("year"))
        .write.mode("overwrite").partitionBy("year").parquet(f"{path}/links/batch={batch}")
    )
    index.directories(pages, prefix).write.mode("overwrite").parquet(f"{path}/directories/batch={batch}")
    index.readable(pages).write.mode("overwrite").parquet(f"{path}/opened/batch={batch}")
    # At most as many numbers as there are years in scope.
    touched = [r.year for r in pages.select("year").distinct().collect()]

    def kept(name: str, columns: str) -> DataFrame:
        return read_table(spark, f"{path}/{name}", columns).filter(F.col("year").isin(touched)).drop("batch")

    dirs = index.first_links(kept("directories", DIRECTORIES))
    _replace_years(index.first_places(kept("links", LINKS), dirs), f"{path}/ids")
    ids = ids_of(spark, path).filter(F.col("year").isin(touched))
    _replace_years(index.new_ids(dirs, kept("opened", OPENED).distinct(), ids), f"{path}/totals")


def _replace_years(rows: DataFrame, path: str) -> None:
    """Write the years that ``rows`` has, leaving the others; no year ever loses its last row."""
    (
        rows.hint("rebalance", F.col("year"))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year").parquet(path)
    )


def ids_of(spark: SparkSession, path: str) -> DataFrame:
    """Distinct ids with the place each was seen first."""
    return read_table(spark, f"{path}/ids", IDS)


def running_counts(spark: SparkSession, path: str) -> DataFrame:
    """Per directory opened, the ids found in its year so far; reads totals, not ids."""
    return index.running_in_year(read_table(spark, f"{path}/totals", TOTALS))
