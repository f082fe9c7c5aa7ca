"""Id lists: text files with one id per line."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vulnloom.functions.text import strip
from vulnloom.operators.index import in_id_order
from vulnloom.operators.running import running_total
from vulnloom.session import read_if_present

ID_LIST = "ord bigint, cve_id string"


def read_id_list(spark: SparkSession, path: str) -> DataFrame:
    """The lines that hold an id, with their 1-based position as ``ord``.

    Order and repeats are kept. A folder is read in file-name order. Lines are
    numbered within each file split, and only the split totals are brought
    together. A missing file gives no rows.
    """
    return read_if_present(
        lambda: _positions(spark.read.text(path)), lambda: spark.createDataFrame([], ID_LIST)
    )


def _positions(lines: DataFrame) -> DataFrame:
    at = lines.select(
        strip(F.col("value")).alias("cve_id"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        # Rises along the lines of one split, which is all it is used for.
        F.monotonically_increasing_id().alias("_line"),
    ).filter("cve_id <> ''")
    numbered = running_total(at, [], [["_file"], ["_start"]], ["_line"], F.lit(1), "ord")
    return numbered.select("ord", "cve_id")


def write_id_list(ids: DataFrame, path: str) -> None:
    """Write ids in id order, replacing what is there.

    The parts of the folder are in order; read one after another they are the
    sorted list.
    """
    in_id_order(ids.select("cve_id")).write.mode("overwrite").text(path)
