"""Statistics kept per run of a lake, so a question about all runs reads a few rows of each."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vulnloom.operators import analytics
from vulnloom.operators.typed import typed
from vulnloom.plans.collect import read_advisories
from vulnloom.schema import RAW_COLUMNS
from vulnloom.sources.dataset import read_table

SCORE_GROUPS = ("cvss_version", "ecosystem")

PROFILES = "`column` string, `rows` bigint, filled bigint, sketch binary, run bigint"
SCORES = "value string, tenths int, n bigint, `by` string, run bigint"


def profiles_path(lake: str) -> str:
    return f"{lake}/statistics/profiles"


def scores_path(lake: str) -> str:
    return f"{lake}/statistics/scores"


def keep_statistics(spark: SparkSession, lake: str, run: int) -> None:
    """Sketch and count the rows of one run; doing it again replaces what was kept of that run."""
    rows = read_advisories(spark, lake).filter(F.col("run") == run)
    analytics.profile_sketches(rows.select(*RAW_COLUMNS)).write.mode("overwrite").parquet(
        f"{profiles_path(lake)}/run={run}"
    )
    view = typed(rows)
    for by in SCORE_GROUPS:
        counts = analytics.score_counts(view, by).select(F.col(by).alias("value"), "tenths", "n")
        counts.coalesce(1).write.mode("overwrite").parquet(f"{scores_path(lake)}/by={by}/run={run}")


def profile(spark: SparkSession, lake: str) -> DataFrame:
    """Rows, filled cells and estimated distinct values of each column, over all runs kept."""
    return analytics.merged_profile(read_table(spark, profiles_path(lake), PROFILES))


def score_summary(spark: SparkSession, lake: str, by: str) -> DataFrame:
    """The exact score summary over all runs kept, medians included."""
    kept = read_table(spark, scores_path(lake), SCORES).filter(F.col("by") == by)
    return analytics.summary_of_counts(kept.select(F.col("value").alias(by), "tenths", "n"), by)
