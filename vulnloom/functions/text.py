"""Text helpers: whitespace, ids, HTML escaping."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from vulnloom.schema import ADVISORY_BASE, LISTING_BASE

# One Unicode whitespace character. With (?U) Java's \s covers everything but
# the four ASCII separators, which are whitespace for the pages' producer too.
SPACE = r"[\s\x1c-\x1f]"


def normalise(text: Column) -> Column:
    """Collapse each whitespace run to one space and trim; NULL becomes ''."""
    collapsed = F.regexp_replace(text, f"(?U){SPACE}+", " ")
    return F.coalesce(F.btrim(collapsed), F.lit(""))


def strip(text: Column) -> Column:
    """Trim Unicode whitespace at both ends; NULL becomes ''."""
    return F.coalesce(
        F.regexp_replace(text, f"(?U)^{SPACE}+|{SPACE}+\\z", ""), F.lit("")
    )


def id_year(cve_id: Column) -> Column:
    return F.split_part(cve_id, F.lit("-"), F.lit(2)).try_cast("int")


def id_sequence(cve_id: Column) -> Column:
    return F.split_part(cve_id, F.lit("-"), F.lit(3)).try_cast("bigint")


def escape_html(text: Column) -> Column:
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(char), F.lit(entity))
    return text


def page_address(cve_id: Column, base: str = ADVISORY_BASE) -> Column:
    """Address of an advisory page."""
    return F.concat(F.lit(base), cve_id)


def listing_address(
    year: Column, directory: Column | None = None, base: str = LISTING_BASE
) -> Column:
    """Address of a year page, or of a range page when a directory is given."""
    parts = [F.lit(base), year.cast("string")]
    return F.concat_ws("/", *parts, *([directory] if directory is not None else []))
