"""Continuous ingest: page files arrive, each id lands once."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vulnloom.functions.text import strip
from vulnloom.operators import merge
from vulnloom.plans import collect
from vulnloom.schema import PAGES
from vulnloom.session import written
from vulnloom.streaming.known_ids import landed_among

# The place of a page in the order of arrival.
ARRIVAL = ["arrived", "file", "row_index"]


def page_stream(spark: SparkSession, path: str, **options) -> DataFrame:
    """Parquet files of pages, as they arrive."""
    return spark.readStream.schema(PAGES).options(**options).parquet(path).select(
        "*",
        F.col("_metadata.file_modification_time").alias("arrived"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("row_index"),
    )


def page_file_stream(spark: SparkSession, path: str, **options) -> DataFrame:
    """HTML files named after their id, as they arrive."""
    return spark.readStream.options(**options).text(path, wholetext=True).select(
        F.regexp_replace("_metadata.file_name", r"\.html?\z", "").alias("cve_id"),
        F.lit(200).alias("status"),
        F.col("value").alias("html"),
        F.col("_metadata.file_modification_time").alias("arrived"),
        F.col("_metadata.file_path").alias("file"),
        F.lit(0).cast("bigint").alias("row_index"),
    )


def land(batch: DataFrame, batch_id: int, lake: str) -> None:
    """Add one batch of pages to the lake.

    A batch that is run again adds nothing: ids in the table are dropped first, and
    the batch's rejects replace themselves. Which ids those are is kept as state, so of the
    table only files that are new since the batch before are read. One writer per lake.
    """
    spark = batch.sparkSession
    arrived = batch.withColumn("cve_id", strip(F.col("cve_id"))).filter("cve_id <> ''")
    asked = written(arrived.select("cve_id").distinct(), f"{lake}/_staging/asked")
    done = written(landed_among(asked, lake), f"{lake}/_staging/done")
    pending = written(asked.join(done, "cve_id", "left_anti"), f"{lake}/_staging/pending")
    staging = collect.Staging(arrived, lake, ARRIVAL)
    rows = staging.read(pending).withColumn("ord", F.unix_micros("arrived"))
    collect.add_rows(staging, rows, F.struct(*ARRIVAL), batch_id)
    # A query keeps its id in its checkpoint; a new checkpoint is another query.
    source = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"
    collect.write_rejects(merge.refused(rows), lake, f"stream-{source}", batch_id, "0")


def ingest(pages: DataFrame, lake: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Start adding a page stream to the lake.

    ``pages`` comes from one of the streams above. Without a trigger, whatever
    has arrived is landed and the query ends.
    """
    return (
        pages.writeStream.foreachBatch(lambda batch, n: land(batch, n, lake))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
