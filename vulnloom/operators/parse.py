"""The one Python pass over page HTML.

``mapInArrow`` reads each page once, where it lies: nothing is shuffled, the
HTML goes no further, and every rule above page structure stays in columns.
"""

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from vulnloom.operators import html_scan
from vulnloom.schema import LINKS, PARSED, TITLE, struct_of

# Executors need not have this package installed: the page reader travels with
# the job.
cloudpickle.register_pickle_by_value(html_scan)

def _read_pages(df: DataFrame, html: str, reader, ddl: str) -> DataFrame:
    kept = [c for c in df.columns if c != html]
    source = df.select(*kept, html)
    page_type = struct_of(ddl)
    schema = T.StructType(source.drop(html).schema.fields + [T.StructField("page", page_type)])
    return source.mapInArrow(
        html_scan.page_job(reader, to_arrow_type(page_type), len(kept)), schema
    )


def might_hold(html: Column, text: str) -> Column:
    """False only for pages that cannot hold ``text`` in a parsed attribute.

    An ASCII letter, digit or hyphen of an attribute may be written as a numeric
    character reference, hence the second test.
    """
    return F.contains(html, F.lit(text)) | F.contains(html, F.lit("&#"))


def parse_pages(pages: DataFrame, html: str = "html") -> DataFrame:
    """Replace the HTML of advisory pages by the struct ``page``.

    Bodies that cannot be accepted (wrong status, page class nowhere in the
    text) are blanked first, so they are neither sent to Python nor parsed.
    """
    wanted = might_hold(F.col(html), html_scan.PAGE_CLASS)
    if "status" in pages.columns:
        wanted = wanted & (F.col("status") == 200)
    body = F.when(wanted, F.col(html))
    return _read_pages(pages.withColumn(html, body), html, html_scan.read_advisory, PARSED)


def parse_links(pages: DataFrame, html: str = "html") -> DataFrame:
    """Replace HTML by ``page``: its link targets."""
    return _read_pages(pages, html, html_scan.read_links, LINKS)


def parse_titles(pages: DataFrame, html: str = "html") -> DataFrame:
    """Replace HTML by ``page``: its first heading."""
    return _read_pages(pages, html, html_scan.read_title, TITLE)


def page_links(pages: DataFrame, html: str = "html") -> DataFrame:
    """One row per link: the kept columns, ``link_pos`` and ``href``."""
    parsed = parse_links(pages, html)
    kept = [c for c in parsed.columns if c != "page"]
    return parsed.select(*kept, F.posexplode("page.anchors").alias("link_pos", "href"))
