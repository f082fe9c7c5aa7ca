"""A log of fetch attempts as it grows: which ids are due for another try."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from vulnloom.operators import crawl_log
from vulnloom.schema import FETCH_LOG, MAX_ATTEMPTS
from vulnloom.sources.dataset import read_table


def attempt_stream(spark: SparkSession, path: str, **options) -> DataFrame:
    """Parquet files of attempts, as they arrive."""
    return spark.readStream.schema(FETCH_LOG).options(**options).parquet(path)


def _changes(path: str) -> str:
    return f"{path}/changes"


def follow(attempts: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Keep the latest attempt at each id of a stream.

    The state store holds one row per id, and a batch writes those ids whose latest attempt it
    changed, so it costs what it brings. Attempts may arrive in any order and more than
    once; a batch that is run again replaces its own rows. Without a trigger, whatever has
    arrived is taken in and the query ends.
    """

    def land(batch: DataFrame, number: int) -> None:
        # A query keeps its id in its checkpoint; a new checkpoint is another query.
        source = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"
        batch.write.mode("overwrite").parquet(f"{_changes(path)}/source={source}/batch={number}")

    return (
        crawl_log.latest_attempts(attempts)
        .writeStream.outputMode("update")
        .foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def frontier(spark: SparkSession, path: str, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """Where each id stands, as of the last batch; ``crawl_log.due`` picks those whose wait is over."""
    kept = read_table(spark, _changes(path), FETCH_LOG)
    return crawl_log.frontier(kept, max_attempts)
