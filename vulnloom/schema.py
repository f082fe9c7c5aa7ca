"""Column names, row types and the fixed values every job agrees on."""

from pyspark.sql import types as T

# --- Fixed values -----------------------------------------------------------
# The dataset columns, in file order.
RAW_COLUMNS = [
    "cve_id", "source", "import_source", "json_data", "aliases", "published",
    "modified", "severity", "cvss_score", "cvss_version", "cvss_vector",
    "summary", "details", "ecosystem", "package", "range_type", "repo",
    "introduced", "fixed", "cwe_ids", "cna_assigner", "references",
]
FIRST_YEAR = 2020
LAST_YEAR = 2026
TARGET_IDS = 5000
TARGET_RECORDS = 2000
MAX_ATTEMPTS = 8
PREVIEW_FIRST = 20
PREVIEW_LAST = 10
ADVISORY_BASE = "https://osv.dev/vulnerability/"
LISTING_BASE = "https://github.com/CVEProject/cvelistV5/tree/main/cves"
LISTING_PREFIX = "/CVEProject/cvelistV5/tree/main/cves/"
LIST_SEPARATOR = "; "
# ----------------------------------------------------------------------------

RAW = T.StructType([T.StructField(name, T.StringType()) for name in RAW_COLUMNS])

# The dataset in the lake: the run that added a row and its place in that run,
# and the year of the id, by which the table is partitioned.
LAKE = T.StructType(RAW.fields + [
    T.StructField("run", T.LongType()),
    T.StructField("ord", T.LongType()),
    T.StructField("cve_year", T.IntegerType()),
])

PAGES = "cve_id string, status int, html string"

# directory NULL marks a year page; a year whose directory list is spread over
# several pages numbers them in page_no.
LISTING_PAGES = "year int, directory string, page_no int, status int, html string"

FETCH_LOG = (
    "cve_id string, attempt int, status int, retry_after string, ts timestamp"
)

# What the HTML pass hands back for one advisory page. Both lists hold <dt>s of
# any depth in document order, labels in lower case: of each label a column asks
# for, the first without a value, the first with one and the first with a link.
PARSED = """
    error string,
    has_page boolean,
    title string,
    has_details boolean,
    details array<struct<label: string, has_dd: boolean, value: string,
                         anchors: array<string>>>,
    has_packages boolean,
    ecosystem string,
    package string,
    range array<struct<label: string, has_dd: boolean, value: string,
                       cells: array<string>>>,
    specific array<string>
"""

# What it hands back for a page read for its links, or for its title.
LINKS = "error string, anchors array<string>"
TITLE = "error string, title string"


def struct_of(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)
