"""Session settings and the shared work folder."""

import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def build_session(app_name: str = "vulnloom", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        # Pages are large: keep a batch handed to Python to a few megabytes.
        "spark.sql.execution.arrow.maxRecordsPerBatch": "500",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by spark.checkpoint.dir.

    Only a local-mode session may fall back to a folder of this machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.conf.get("spark.app.id")
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="vulnloom-")
    return _local_dirs[app]


def work_path(spark: SparkSession, name: str, unique: bool = True) -> str:
    """A path under the shared folder that belongs to this application."""
    path = f"{shared_dir(spark)}/vulnloom/{spark.conf.get('spark.app.id')}/{name}"
    return f"{path}-{uuid.uuid4().hex[:12]}" if unique else path


def read_if_present(read, otherwise):
    """Run a reader; a path that does not exist gives ``otherwise()`` instead."""
    try:
        return read()
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return otherwise()
        raise


def written(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` to a path all executors share and read it back.

    Cuts the lineage in a way that survives lost executors, and gives the
    planner the true size of the data.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written_and_counted(df: DataFrame, path: str) -> tuple[DataFrame, int]:
    """``written``, and how many rows, without a job to count them.

    The count stands last in the plan: a task of the last stage counts once, however often it
    is tried, and no rule for empty inputs takes it out.
    """
    counts = Observation()
    table = written(df.observe(counts, F.count(F.lit(1)).alias("n")), path)
    return table, counts.get["n"]
