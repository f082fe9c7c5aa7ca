"""Which ids a lake holds, as keyed state."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vulnloom.functions.text import strip
from vulnloom.plans.collect import advisories_path
from vulnloom.schema import LAKE
from vulnloom.session import read_if_present
from vulnloom.sources.dataset import append_by_year

ID = "cve_id string"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Copied files keep an old date, and the table's are never too old to be told of.
ANY_AGE = "36500d"


def known_path(lake: str, name: str) -> str:
    return f"{lake}/_known/{name}"


def _session(spark: SparkSession) -> SparkSession:
    """A session whose state is kept on disk, so it may outgrow the memory of the executors."""
    own = spark.newSession()
    for key, value in {
        "spark.sql.shuffle.partitions": spark.conf.get("spark.sql.shuffle.partitions"),
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }.items():
        own.conf.set(key, value)
    return own


def flags(landed: DataFrame, asked: DataFrame) -> DataFrame:
    """Each id of either stream and whether it has landed; batch or stream, combined before the shuffle."""
    told = landed.select(strip(F.col("cve_id")).alias("cve_id"), F.lit(True).alias("landed"))
    both = told.filter("cve_id <> ''").unionByName(asked.select("cve_id", F.lit(False).alias("landed")))
    return both.groupBy("cve_id").agg(F.max("landed").alias("landed"))


def take_in(spark: SparkSession, lake: str) -> StreamingQuery:
    """Bring the state up to what has been asked and landed since it was last brought up; answers
    are the asked or newly landed ids that the lake holds."""
    own = _session(spark)

    def answer(batch: DataFrame, number: int) -> None:
        batch.filter("landed").select("cve_id").write.mode("overwrite").parquet(known_path(lake, "answer"))

    landed = own.readStream.schema(LAKE).option("maxFileAge", ANY_AGE).parquet(advisories_path(lake))
    asked = own.readStream.schema(ID).option("cleanSource", "delete").parquet(known_path(lake, "asked"))
    return (
        flags(landed, asked)
        .writeStream.outputMode("update")
        .foreachBatch(answer)
        .option("checkpointLocation", known_path(lake, "checkpoint"))
        .trigger(availableNow=True)
        .start()
    )


def landed_among(asked: DataFrame, lake: str) -> DataFrame:
    """Those of some ids that the lake holds; ``asked`` is a written table of distinct ids.

    The state store holds a flag per id that was asked for or has landed. A call feeds it the
    ids asked and the files that have come to the table since the call before, whoever wrote
    them, so it costs what is new; the first call of a lake reads the ids of its whole table. A
    call that died is made again with its ids asked anew. One writer per lake; an id whose rows
    are taken out of the table by hand stays known until the lake's ``_known`` is taken away.
    """
    spark = asked.sparkSession
    # A stream can only be read from a folder that is there.
    read_if_present(
        lambda: spark.read.schema(LAKE).parquet(advisories_path(lake)),
        lambda: append_by_year(spark.createDataFrame([], LAKE).drop("cve_year"), advisories_path(lake)),
    )
    asked.select("cve_id").write.mode("append").parquet(known_path(lake, "asked"))
    take_in(spark, lake).awaitTermination()
    held = spark.read.schema(ID).parquet(known_path(lake, "answer"))
    return held.join(asked, "cve_id", "left_semi")
