"""Questions asked of the dataset. Every function takes the typed view,
except ``profile``, which takes the raw strings.

Group-bys are combined before the shuffle, and what a hot group could make
large (scores, packages, column values) is counted per value first, so no group
is ever gathered whole.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vulnloom.operators.typed import vector_metrics
from vulnloom.schema import RAW_COLUMNS

# Values up to this long are compared as they are, longer ones by SHA-256.
PLAIN_VALUE = 64
# Log of the registers of a stored sketch.
SKETCH_LG_K = 14


def profile(raw: DataFrame, columns: list[str] = RAW_COLUMNS, approximate: bool = False) -> DataFrame:
    """Rows, filled cells and distinct values of each column.

    The exact count shuffles one short value per cell at most; the approximate
    one is a single pass that shuffles a sketch per column.
    """
    if approximate:
        per_column = F.array(*[
            F.struct(
                F.lit(c).alias("column"),
                F.count("*").alias("rows"),
                F.count(_filled(c)).alias("filled"),
                F.approx_count_distinct(_filled(c)).alias("distinct_values"),
            )
            for c in columns
        ])
        return raw.agg(per_column.alias("columns")).select(F.inline("columns"))
    cells = raw.select(*[_short(_filled(c)).alias(c) for c in columns])
    per_value = (
        cells.unpivot([], columns, "column", "value")
        .groupBy("column", "value")
        .agg(F.count("*").alias("n"))
    )
    counted = per_value.groupBy("column").agg(
        F.sum("n").alias("rows"),
        F.sum(F.when(F.col("value").isNotNull(), F.col("n"))).alias("filled"),
        F.count("value").alias("distinct_values"),
    )
    # An empty dataset has its columns all the same.
    named = raw.sparkSession.createDataFrame([(c,) for c in columns], "column string")
    return named.join(counted, "column", "left").fillna(0)


def profile_sketches(raw: DataFrame, columns: list[str] = RAW_COLUMNS, lg_k: int = SKETCH_LG_K) -> DataFrame:
    """What ``merged_profile`` needs of a set of rows: per column its counts and a sketch of its values.

    One pass; a sketch has some 16 KB however many values it has seen.
    """
    per_column = F.array(*[
        F.struct(
            F.lit(c).alias("column"),
            F.count("*").alias("rows"),
            F.count(_filled(c)).alias("filled"),
            F.hll_sketch_agg(_filled(c), lg_k).alias("sketch"),
        )
        for c in columns
    ])
    return raw.agg(per_column.alias("columns")).select(F.inline("columns"))


def merged_profile(sketches: DataFrame) -> DataFrame:
    """The profile of all sets that were sketched, without reading them again.

    Rows and filled cells are exact. Distinct values are an estimate, whose standard error is
    1.04 / sqrt(2 ** lg_k), below one percent, however many sets are merged.
    """
    return sketches.groupBy("column").agg(
        F.sum("rows").alias("rows"),
        F.sum("filled").alias("filled"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_values"),
    )


def _filled(column: str) -> Column:
    return F.nullif(F.col(column), F.lit(""))


def _short(value: Column) -> Column:
    return F.when(F.length(value) <= PLAIN_VALUE, value).otherwise(F.sha2(value, 256))


def severity_distribution(advisories: DataFrame) -> DataFrame:
    """Advisories per severity band and their share of all."""
    # The window is over the counts, one row per band.
    total = F.sum("n").over(Window.partitionBy())
    return (
        advisories.groupBy(F.coalesce("severity_band", F.lit("none")).alias("severity_band"))
        .agg(F.count("*").alias("n"))
        .withColumn("share", F.col("n") / total)
    )


def score_summary(advisories: DataFrame, by: str = "cvss_version") -> DataFrame:
    """Count, least, mean, greatest and median CVSS score per group.

    Scores have one decimal, so a group has few distinct ones. They are counted
    first, as tenths, and the exact median is taken over the counts.
    """
    return summary_of_counts(score_counts(advisories, by), by)


def score_counts(advisories: DataFrame, by: str) -> DataFrame:
    """How often each group has each score: (by, tenths, n). Counts of two sets of advisories add up."""
    return (
        advisories.filter("cvss_score IS NOT NULL")
        .groupBy(by, (F.col("cvss_score") * 10).cast("int").alias("tenths"))
        .agg(F.count("*").alias("n"))
    )


def summary_of_counts(counts: DataFrame, by: str) -> DataFrame:
    """The summary of all advisories counted; the counts of several sets may stand in one table."""
    scores = counts.groupBy(by, "tenths").agg(F.sum("n").alias("n"))
    return scores.groupBy(by).agg(
        F.sum("n").alias("scored"),
        (F.min("tenths") / 10).alias("min_score"),
        (F.sum(F.col("tenths") * F.col("n")) / (F.sum("n") * 10)).alias("avg_score"),
        (F.max("tenths") / 10).alias("max_score"),
        (F.percentile("tenths", 0.5, F.col("n")) / 10).alias("median_score"),
    )


def score_histogram(advisories: DataFrame) -> DataFrame:
    """Advisories per whole-number score bin; the last bin holds 9 to 10."""
    return (
        advisories.filter("cvss_score IS NOT NULL")
        .groupBy(F.least(F.floor("cvss_score"), F.lit(9)).cast("bigint").alias("bin"))
        .agg(F.count("*").alias("n"))
    )


def top_weaknesses(advisories: DataFrame, k: int = 10) -> DataFrame:
    """The weaknesses most advisories name; an advisory counts once for each."""
    return (
        advisories.select(F.explode(F.array_distinct("cwe_ids")).alias("cwe_id"))
        .groupBy("cwe_id")
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "cwe_id")
        .limit(k)
    )


def ecosystem_counts(advisories: DataFrame) -> DataFrame:
    return advisories.groupBy("ecosystem").agg(F.count("*").alias("n"))


def top_packages(advisories: DataFrame, k: int = 3) -> DataFrame:
    """The most affected packages of each ecosystem.

    The rank is limited before its shuffle too, so a hot ecosystem sends at
    most ``k`` rows per task.
    """
    place = Window.partitionBy("ecosystem").orderBy(F.desc("n"), "package")
    return (
        advisories.filter("package IS NOT NULL")
        .groupBy("ecosystem", "package")
        .agg(F.count("*").alias("n"))
        .withColumn("place", F.row_number().over(place))
        .filter(F.col("place") <= k)
    )


def monthly_trend(advisories: DataFrame) -> DataFrame:
    """Publications per month, in UTC whatever the session's zone, and their total so far.

    The window is over months, of which the calendar has few.
    """
    day = F.date_from_unix_date(F.floor(F.unix_seconds("published") / 86400).cast("int"))
    months = (
        advisories.filter("published IS NOT NULL")
        .groupBy(F.trunc(day, "month").alias("month"))
        .agg(F.count("*").alias("n"))
    )
    upto = Window.orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    return months.withColumn("running_total", F.sum("n").over(upto))


def metric_counts(advisories: DataFrame) -> DataFrame:
    """How often each vector metric takes each value."""
    return (
        advisories.select(F.inline(vector_metrics(F.col("cvss_vector"))))
        .groupBy("metric", "value")
        .agg(F.count("*").alias("n"))
    )


def fix_share(advisories: DataFrame) -> DataFrame:
    """Advisories with a fixed version, per ecosystem."""
    with_fix = F.count("fixed")
    return advisories.groupBy("ecosystem").agg(
        F.count("*").alias("n"),
        with_fix.alias("with_fix"),
        (with_fix / F.count("*")).alias("fix_share"),
    )
