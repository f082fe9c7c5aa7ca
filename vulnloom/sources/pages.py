"""Page bodies, already fetched."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vulnloom.schema import LISTING_PAGES, PAGES


def read_page_files(spark: SparkSession, path: str) -> DataFrame:
    """A folder of HTML files named after their id: cve_id, status, html."""
    name = F.col("_metadata.file_name")
    return spark.read.text(path, wholetext=True).select(
        F.regexp_replace(name, r"\.html?\z", "").alias("cve_id"),
        F.lit(200).alias("status"),
        F.col("value").alias("html"),
    )


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table of advisory pages.

    One that was written by ``append_by_year`` has ``cve_year`` as well, and a
    run reads only the years it has ids for.
    """
    return spark.read.schema(PAGES).parquet(path)


def read_listing_pages(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table of listing pages; partition it by year to prune years."""
    return spark.read.schema(LISTING_PAGES).parquet(path)
