"""The typed view of the dataset: NULL for missing, numbers and times as such."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vulnloom.functions.text import id_sequence, id_year
from vulnloom.schema import LIST_SEPARATOR

BAND = r"\(\s*([A-Za-z]+)\s*\)"


def _present(column: Column) -> Column:
    return F.nullif(column, F.lit(""))


def _list(column: Column, separator: str) -> Column:
    return F.filter(F.split(column, separator), lambda item: item != "")


def vector_metrics(vector: Column) -> Column:
    """(metric, value) pairs of a CVSS vector, without the leading version."""
    parts = F.split(F.regexp_replace(vector, "^CVSS:[^/]+/", ""), "/")
    pairs = F.transform(
        F.filter(parts, lambda p: F.contains(p, F.lit(":"))),
        lambda p: F.struct(
            F.split_part(p, F.lit(":"), F.lit(1)).alias("metric"),
            F.split_part(p, F.lit(":"), F.lit(2)).alias("value"),
        ),
    )
    return F.array_distinct(pairs)


def metric_map(vector: Column) -> Column:
    """Metric to value; a metric given twice keeps the value given last."""
    pairs = vector_metrics(vector)
    last = F.filter(
        pairs,
        lambda p, i: ~F.exists(
            F.slice(pairs, i + 2, F.size(pairs)), lambda later: later["metric"] == p["metric"]
        ),
    )
    return F.map_from_entries(last)


def typed(rows: DataFrame) -> DataFrame:
    """The 22 raw columns with types, and the columns analysis is done on."""
    missing = {
        c: _present(F.col(c))
        for c in (
            "source", "import_source", "json_data", "severity", "cvss_version", "cvss_vector",
            "summary", "details", "ecosystem", "package", "range_type", "repo",
            "introduced", "fixed", "cna_assigner",
        )
    }
    return rows.withColumns({
        **missing,
        "cve_year": id_year(F.col("cve_id")),
        "cve_seq": id_sequence(F.col("cve_id")),
        "aliases": _list(F.col("aliases"), " "),
        "published": F.try_to_timestamp("published"),
        "modified": F.try_to_timestamp("modified"),
        "severity_band": _present(F.regexp_extract("severity", BAND, 1)),
        "cvss_score": F.col("cvss_score").try_cast("decimal(3,1)"),
        "cvss_metrics": metric_map(_present(F.col("cvss_vector"))),
        "cwe_ids": _list(F.col("cwe_ids"), LIST_SEPARATOR),
        "references": _list(F.col("references"), LIST_SEPARATOR),
    })
