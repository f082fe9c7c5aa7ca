"""The advisory dataset: CSV for exchange, Parquet for work."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vulnloom.functions.text import strip
from vulnloom.operators.merge import with_year
from vulnloom.schema import RAW, RAW_COLUMNS
from vulnloom.session import read_if_present, written

# Holds the text of a record that does not fit.
BAD = "_bad_record"
CSV = {"header": True, "quote": '"', "escape": '"'}


def read_csv_dataset(spark: SparkSession, path: str) -> DataFrame:
    """A CSV dataset as 22 strings; rows without an id are left out.

    A missing file gives no rows. A file that does not fit the columns is an
    error: reading part of it and writing that back would lose data. Where rows
    end in CRLF, a CRLF inside a quoted cell is read as LF.
    """
    reader = spark.read.schema(RAW).options(
        **CSV, multiLine=True, mode="FAILFAST", enforceSchema=False,
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )
    rows = read_if_present(lambda: reader.csv(path), lambda: spark.createDataFrame([], RAW))
    return rows.fillna("").filter(strip(F.col("cve_id")) != "")


def read_csv_leniently(spark: SparkSession, path: str, work: str) -> tuple[DataFrame, DataFrame]:
    """(rows, bad): a CSV dataset as 22 strings, and as ``record`` the text of each record that
    does not have 22 cells.

    A record is in one of them, whole, but for rows without an id, which are left out. A quote
    that is never closed makes the rest of its file one bad record. The file is parsed once, into
    a table at ``work``. A missing file gives no rows; a wrong header is an error all the same.
    """
    schema = T.StructType([*RAW.fields, T.StructField(BAD, T.StringType())])
    reader = spark.read.schema(schema).options(
        **CSV, multiLine=True, mode="PERMISSIVE", columnNameOfCorruptRecord=BAD, enforceSchema=False,
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )
    # Written with all its columns: a reader of some of them would not see what is wrong with a record.
    parsed = written(
        read_if_present(lambda: reader.csv(path), lambda: spark.createDataFrame([], schema)), work
    )
    good = parsed.filter(F.col(BAD).isNull()).select(*RAW_COLUMNS).fillna("")
    bad = parsed.filter(F.col(BAD).isNotNull()).select(F.col(BAD).alias("record"))
    return good.filter(strip(F.col("cve_id")) != ""), bad


def write_csv_dataset(rows: DataFrame, path: str, rows_per_file: int = 200_000) -> None:
    """Write the 22 columns as CSV, replacing what is there.

    Files are kept to a size one reader handles, since quoted cells may hold
    line breaks and such a file is read by one task.
    """
    (
        rows.select(*RAW_COLUMNS)
        .write.mode("overwrite")
        .options(
            **CSV, emptyValue="", maxRecordsPerFile=rows_per_file,
            ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
        )
        .csv(path)
    )


def read_table(spark: SparkSession, path: str, columns: T.StructType | str) -> DataFrame:
    """A Parquet table of the lake, empty while it does not exist."""
    return read_if_present(
        lambda: spark.read.schema(columns).parquet(path),
        lambda: spark.createDataFrame([], columns),
    )


def append_by_year(rows: DataFrame, path: str) -> None:
    """Append rows, dataset or pages, to a lake table partitioned by year of id.

    The rebalance keeps files large and splits a year that holds most rows.
    """
    (
        with_year(rows)
        .hint("rebalance", F.col("cve_year"))
        .write.mode("append")
        .partitionBy("cve_year")
        .parquet(path)
    )
