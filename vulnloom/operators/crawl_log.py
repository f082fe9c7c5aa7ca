"""What a crawl log says about each page: its outcome and the wait before a retry."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vulnloom.functions.text import strip
from vulnloom.schema import MAX_ATTEMPTS

# --- Fixed values, in seconds -------------------------------------------------
LIMITED_STEP, LIMITED_CAP = 60, 300
SERVER_STEP, SERVER_CAP = 30, 180
# Wait for a Retry-After header that is no whole number.
UNREADABLE_WAIT = 60
# The longest sleep a clock of 64-bit nanoseconds can express.
LONGEST_WAIT = 9223372036
# ------------------------------------------------------------------------------

WHOLE_NUMBER = r"^[+-]?[0-9]+(_[0-9]+)*\z"


def response_class(status: Column) -> Column:
    """ok, rate_limited, server_error, no_response or permanent."""
    return (
        F.when(status.isNull(), "no_response")
        .when(status == 200, "ok")
        .when(status == 429, "rate_limited")
        .when(status >= 500, "server_error")
        .otherwise("permanent")
    )


def retry_after_seconds(retry_after: Column) -> Column:
    """Seconds a Retry-After header asks for; NULL when it cannot be slept."""
    text = strip(retry_after)
    asked = F.replace(text, F.lit("_"), F.lit("")).try_cast("decimal(38,0)")
    usable = asked.between(0, LONGEST_WAIT)
    return F.when(text.rlike(WHOLE_NUMBER), F.when(usable, asked.cast("bigint"))).otherwise(
        F.lit(UNREADABLE_WAIT).cast("bigint")
    )


def attempt_wait(attempt: Column, status: Column, retry_after: Column) -> Column:
    """Seconds to wait after one attempt; NULL when there is nothing to wait for."""
    attempt = attempt.cast("bigint")
    response = response_class(status)
    stepped = F.least(attempt * LIMITED_STEP, F.lit(LIMITED_CAP).cast("bigint"))
    limited = F.when(F.coalesce(retry_after, F.lit("")) == "", stepped).otherwise(
        retry_after_seconds(retry_after)
    )
    server = F.least(attempt * SERVER_STEP, F.lit(SERVER_CAP).cast("bigint"))
    return F.when(response == "rate_limited", limited).when(
        response.isin("server_error", "no_response"), server
    )


def due(frontier: DataFrame, now: Column) -> DataFrame:
    """Ids whose wait is over: those to be tried again at ``now``."""
    return frontier.filter((F.col("outcome") == "retry") & (F.col("due_at") <= now))


def latest_attempts(fetch_log: DataFrame) -> DataFrame:
    """The latest attempt at each id, with the columns of the log.

    It is a plain maximum, so that of several parts of a log is found among those of the parts.
    """
    last = F.max(F.struct("attempt", "ts", "status", "retry_after")).alias("last")
    return fetch_log.groupBy("cve_id").agg(last).select("cve_id", "last.*")


def frontier(fetch_log: DataFrame, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """Per id, where its latest attempt leaves it, and when its wait is over, as ``due_at``.

    The latest attempt is a plain maximum, combined before the shuffle, so an
    id with very many attempts costs no more than any other.
    """
    latest = latest_attempts(fetch_log)
    attempt, status = F.col("attempt"), F.col("status")
    wait = attempt_wait(attempt, status, F.col("retry_after"))
    outcome = (
        F.when(response_class(status) == "ok", "ok")
        .when(F.col("wait").isNull(), "permanent")
        .when(attempt >= max_attempts, "exhausted")
        .otherwise("retry")
    )
    return latest.withColumn("wait", wait).select(
        "cve_id",
        "attempt",
        "status",
        outcome.alias("outcome"),
        F.when(outcome == "retry", F.col("wait"))
        .otherwise(F.lit(0).cast("bigint"))
        .alias("wait_seconds"),
        F.when(outcome == "retry", F.col("ts") + F.make_dt_interval(secs=F.col("wait")))
        .alias("due_at"),
    )


def retry_frontier(fetch_log: DataFrame, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """Per id, where its latest attempt leaves it."""
    return frontier(fetch_log, max_attempts).drop("due_at")
