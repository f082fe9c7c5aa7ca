"""Parsed pages to dataset rows, with every refused page accounted for."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vulnloom.functions.fields import advisory_columns, lookups
from vulnloom.operators.crawl_log import response_class
from vulnloom.operators.parse import parse_pages
from vulnloom.schema import RAW_COLUMNS


def _reject_reason(status: Column, page: Column) -> Column:
    return (
        F.when(response_class(status) != "ok", "http_error")
        .when(page["error"].isNotNull(), "parse_error")
        .when(~page["has_page"], "page_not_found")
        .when(~page["has_details"], "details_not_found")
    )


def _reject_detail(status: Column, page: Column) -> Column:
    response = response_class(status)
    return F.when(response != "ok", response).otherwise(page["error"])


def extract(pages: DataFrame, keep: list[str] = ()) -> DataFrame:
    """Advisory pages (cve_id, status, html) to the 22 columns and their fate.

    ``reject_reason`` is NULL for an accepted page. A page whose title is not
    the requested id is accepted and flagged by ``id_mismatch``. Columns named
    in ``keep`` are carried along.
    """
    page, status = F.col("page"), F.col("status")
    ready = parse_pages(pages).withColumns(lookups(page))
    return ready.select(
        *keep,
        *advisory_columns(F.col("cve_id"), page),
        (~page["title"].eqNullSafe(F.col("cve_id"))).alias("id_mismatch"),
        _reject_reason(status, page).alias("reject_reason"),
        _reject_detail(status, page).alias("reject_detail"),
    )


def accepted(rows: DataFrame) -> DataFrame:
    """The dataset rows among extracted rows."""
    return rows.filter("reject_reason IS NULL").select(*RAW_COLUMNS)


def rejects(rows: DataFrame) -> DataFrame:
    """The refused pages among extracted rows."""
    return rows.filter("reject_reason IS NOT NULL").select(
        "cve_id", "reject_reason", "reject_detail"
    )
