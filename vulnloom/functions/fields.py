"""The 22 dataset columns as expressions over one parsed page."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from vulnloom.functions.labels import first_of, link_of, value_of, with_link, with_value
from vulnloom.functions.text import SPACE
from vulnloom.schema import LIST_SEPARATOR

# --- Fixed values: what the text of a page is searched for -------------------
SCORE = r"(\d+\.\d+)\s*\("
VERSION = r"(CVSS_V[234])"
VECTOR = r"(CVSS:\d+\.\d+/[A-Za-z0-9:/._-]+)"
WEAKNESS = r'"(CWE-\d+)"'
ASSIGNER = f'(?U)"cna_assigner"{SPACE}*:{SPACE}*"([^"]+)"'
# ------------------------------------------------------------------------------


def _last(items: Column) -> Column:
    return F.try_element_at(items, F.lit(-1))


def severity_text(details: Column) -> Column:
    """The cell the three CVSS searches read: that of the first severity label."""
    return F.coalesce(first_of(details, "Severity")["value"], F.lit(""))


def cvss_score(severity: Column) -> Column:
    return F.regexp_extract(severity, SCORE, 1)


def cvss_version(severity: Column) -> Column:
    return F.regexp_extract(severity, VERSION, 1)


def cvss_vector(severity: Column) -> Column:
    return F.regexp_extract(severity, VECTOR, 1)


def event_cells(ranges: Column) -> Column:
    return first_of(ranges, "Events")["cells"]


def last_event(cells: Column, kind: str) -> Column:
    """The cell after the last cell that says ``kind``."""
    after = F.filter(cells, lambda _, i: F.lower(F.get(cells, i - 1)) == kind)
    return F.coalesce(_last(after), F.lit(""))


def event_history(cells: Column) -> Column:
    """Every (position, kind, value) event, each cell next to the one before."""
    steps = F.transform(
        cells,
        lambda v, i: F.struct(
            i.alias("pos"), F.lower(F.get(cells, i - 1)).alias("kind"), v.alias("value")
        ),
    )
    return F.filter(steps, lambda s: s["kind"].isin("introduced", "fixed"))


def weaknesses(blocks: Column) -> Column:
    """Weakness ids of the last block that names any, repeats kept."""
    named = F.filter(blocks, lambda b: F.contains(b, F.lit("cwe_ids")))
    found = F.transform(named, lambda b: F.regexp_extract_all(b, F.lit(WEAKNESS), F.lit(1)))
    return F.coalesce(
        _last(F.filter(found, lambda ids: F.size(ids) > 0)), F.array().cast("array<string>")
    )


def assigner(blocks: Column) -> Column:
    """Assigner named by the last block that has one."""
    found = F.transform(blocks, lambda b: F.regexp_extract(b, ASSIGNER, 1))
    return F.coalesce(_last(F.filter(found, lambda name: name != "")), F.lit(""))


def reference_links(details: Column) -> Column:
    """Non-empty link targets of the references cell, first of each kept."""
    links = F.filter(first_of(details, "References")["anchors"], lambda h: h != "")
    return F.coalesce(F.array_distinct(links), F.array().cast("array<string>"))


def joined(items: Column) -> Column:
    return F.array_join(items, LIST_SEPARATOR)


def lookups(page: Column) -> dict[str, Column]:
    """What several columns read of a page, to be worked out in a step of its own."""
    return {
        "_valued": with_value(page["details"]),
        "_linked": with_link(page["details"]),
        "_ranged": with_value(page["range"]),
        "_cvss": severity_text(page["details"]),
        "_cells": event_cells(page["range"]),
    }


def advisory_columns(cve_id: Column, page: Column) -> list[Column]:
    """The dataset row of an accepted page, in dataset order.

    The ``lookups`` of the page must be columns beside it. The id is the
    requested one, not the one printed on the page.
    """
    valued, linked, ranged, cvss, cells = (
        F.col(c) for c in ("_valued", "_linked", "_ranged", "_cvss", "_cells")
    )
    blocks, empty = page["specific"], F.lit("")
    values = {
        "cve_id": cve_id,
        "source": link_of(linked, "Source"),
        "import_source": link_of(linked, "Import Source"),
        "json_data": link_of(linked, "JSON Data"),
        "aliases": value_of(valued, "Aliases"),
        "published": value_of(valued, "Published"),
        "modified": value_of(valued, "Modified"),
        "severity": value_of(valued, "Severity"),
        "cvss_score": cvss_score(cvss),
        "cvss_version": cvss_version(cvss),
        "cvss_vector": cvss_vector(cvss),
        "summary": value_of(valued, "Summary"),
        "details": value_of(valued, "Details"),
        "ecosystem": F.coalesce(page["ecosystem"], empty),
        "package": F.coalesce(page["package"], empty),
        "range_type": value_of(ranged, "Type"),
        "repo": value_of(ranged, "Repo"),
        "introduced": last_event(cells, "introduced"),
        "fixed": last_event(cells, "fixed"),
        "cwe_ids": joined(weaknesses(blocks)),
        "cna_assigner": assigner(blocks),
        "references": joined(reference_links(page["details"])),
    }
    return [value.alias(name) for name, value in values.items()]
