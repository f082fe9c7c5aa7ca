"""The corpus pipeline: quality, near duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and works on all its predecessor kept. All but
the last return the columns of ``documents``. Extra columns stay; rows without doc_id
pass as they are until packing, which has no name for them, null texts are empty, an
empty table gives empty stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vulnloom.llm import packing, passages, quality, simhash
from vulnloom.llm.common import as_row, quoted, staged


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled ones, doesn't reject."""
    fold = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.where(quality.scores(fold, F.col("text")) >= quality.THRESHOLD)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each SimHash component, of its smallest doc_id; rows without doc_id all stay."""
    first = (simhash.grouped(docs).groupBy("root").agg(F.min(F.struct("doc_id", "key")).alias("first"))
             .select(F.col("first.doc_id").alias("id"), F.col("first.key").alias("key")))
    # Given columns travel in a struct, so no name of theirs meets one of these.
    named = docs.select(as_row(docs.columns).alias("row"), F.col("doc_id").cast("long").alias("id"), simhash.text_key().alias("key"))
    same = Window.partitionBy("id", "key").orderBy("row.text")
    kept = named.join(first, ["id", "key"], "left_semi").withColumn("nth", F.row_number().over(same)).where("nth = 1")
    return kept.unionByName(named.where("id IS NULL").withColumn("nth", F.lit(1))).select("row.*")


def without_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of an earlier one; n_chars, where there is one, follows. A text of
    nothing else stays, empty; rows without doc_id stay as they are."""
    # The text goes through once, as what is kept of it; with the other columns goes whether it is null,
    # under a name longer than all of theirs.
    no_text = max(docs.columns, key=len) + "_"
    others = [c for c in docs.columns if c != "text"]
    found = passages.deduplicated(docs.withColumn(no_text, F.col("text").isNull()), carry=[*others, no_text])

    def column(name: str) -> Column:
        if name == "text":
            return F.when(~F.col(f"rest.{quoted(no_text)}"), F.col("kept").cast(docs.schema[name].dataType))
        old = F.col(f"rest.{quoted(name)}")
        if name == "n_chars":
            return F.when(F.size("spans") > 0, F.length("kept").cast(docs.schema[name].dataType)).otherwise(old)
        return old

    cleaned = found.select(*(column(c).alias(c) for c in docs.columns))
    return cleaned.unionByName(docs.where(F.col("doc_id").cast("long").isNull()))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", one_of_each),
    ("passages", without_passages),
    ("packing", packed),
]

#: SQL cannot train a classifier; tests check what each stage keeps, and near duplicates by value.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
