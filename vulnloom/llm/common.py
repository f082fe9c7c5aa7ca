"""What the operators of this folder share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vulnloom.session import work_path


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def quoted(name: str) -> str:
    """A column name as it is written where dots and marks mean something."""
    return "`" + name.replace("`", "``") + "`"


def as_row(columns: list[str]) -> Column:
    """Columns as one struct, in which no name of theirs meets another."""
    return F.struct(*(F.col(quoted(c)) for c in columns))


def id_texts(docs: DataFrame, **more: Column) -> DataFrame:
    """doc_id and text alone, and what ``more`` names; a null text is empty, a row without doc_id
    takes no part."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        *(column.alias(name) for name, column in more.items()),
    ).where("doc_id IS NOT NULL")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a table in the shared folder and read it, so what follows has no lineage."""
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def width(df: DataFrame) -> int:
    """Partitions that a shuffle of this session has."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def with_facts(rows: DataFrame, facts: DataFrame, key: str, n_rows: int) -> DataFrame:
    """``rows`` with what ``facts`` has on their key; rows of other keys are left out.

    ``facts`` has one row per key and ``copies``, the number of rows of that key, of
    ``n_rows`` in all; give it a written table. A key of a thousandth of the rows or more
    would be one large group of a shuffle. There are a thousand such keys at most, so they
    are broadcast and their rows stay where they are; the others are joined by shuffle.
    """
    own = [c for c in facts.columns if c not in (key, "copies")]
    hot = F.col("copies") * 1000 >= n_rows
    told = F.struct(*own)
    often = facts.where(hot).select(F.col(key).alias("_hot"), told.alias("_often"))
    seldom = facts.where(~hot).select(F.col(key).alias("_cold"), told.alias("_seldom"))
    met = rows.join(F.broadcast(often), F.col(key) == F.col("_hot"), "left")
    # What has met its facts needs a key that nobody has, another one for every row.
    spread = F.concat(F.lit("-").cast("binary"), F.unhex(F.hex(F.xxhash64(*rows.columns))))
    met = met.withColumn("_key", F.when(F.col("_hot").isNull(), F.col(key)).otherwise(spread))
    both = met.join(seldom, F.col("_key") == F.col("_cold"), "left")
    return (both.withColumn("_told", F.coalesce("_often", "_seldom")).where("_told IS NOT NULL")
            .select(*rows.columns, *(F.col(f"_told.{c}").alias(c) for c in own)))


def batches(rows: Iterable[tuple], schema: pa.Schema, size: int = 8192) -> Iterator[pa.RecordBatch]:
    """Tuples as Arrow batches of a bounded number of rows."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def in_slices(parts: Iterable[pa.RecordBatch], size: int = 1024) -> Iterator[pa.RecordBatch]:
    """Batches in slices of at most ``size`` rows, for what makes strings of all rows of one at once."""
    for part in parts:
        for at in range(0, len(part), size):
            yield part.slice(at, size)


def by_group(parts: Iterable[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[pa.Table]:
    """Batches sorted by long keys, cut so that rows of one key stay together; a row is copied once."""
    held: list[pa.RecordBatch] = []
    for part in parts:
        if not len(part):
            continue
        own = [part.column(k).to_numpy() for k in keys]
        goes_on = bool(held) and all(held[-1].column(k)[-1].as_py() == c[0] for k, c in zip(keys, own))
        change = np.flatnonzero(np.any([c[1:] != c[:-1] for c in own], axis=0)) + 1
        if len(change):
            cut = int(change[-1])
        elif goes_on:
            held.append(part)
            continue
        else:
            cut = 0
        if held or cut:
            yield pa.Table.from_batches([*held, part.slice(0, cut)]).combine_chunks()
        held = [part.slice(cut)]
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


class Memo(dict):
    """What ``find`` gives for a word, remembered for words of up to 48 characters.

    ``renewed()`` gives the memo to go on with: once this one holds ``room`` words, a new one
    that takes over from it what is asked again. Up to twice ``room`` are kept.
    """

    def __init__(self, find: Callable, room: int, before: dict | None = None) -> None:
        super().__init__()
        self.find, self.room, self.before = find, room, before or {}

    def __missing__(self, word):
        value = self.before.get(word)
        if value is None:
            value = self.find(word)
        if len(word) <= 48:
            self[word] = value
        return value

    def renewed(self) -> Memo:
        if len(self) < self.room:
            return self
        self.before = {}
        return Memo(self.find, self.room, self)


_kept: dict = {}


def kept(key: tuple, make: Callable):
    """What ``make`` gives, kept by this process from task to task until another key is asked."""
    if key not in _kept:
        _kept.clear()
        _kept[key] = make()
    return _kept[key]


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array(values, field.type) for values, field in zip(zip(*rows), schema)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def id_text_rows(parts: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, bytes]]:
    """(doc_id, UTF-8 bytes) of batches whose first two columns are doc_id and text."""
    for part in parts:
        ids = part.column(0).to_pylist()
        texts = part.column(1).cast(pa.binary())
        for doc_id, text in zip(ids, texts):
            yield doc_id, text.as_py()
