"""Token ids in binary files: byte or bit planes of fixed-size blocks, with an index.

A file set is a Parquet table without Parquet compression, one row per block:

    shard int, block int     place; shards and blocks in order hold documents by doc_id
    first long               ids of the shard before the block
    n_ids int                ids in the block: ``BLOCK`` but for the last of a shard
    plane_at array<int>      the block's index: where each plane ends in ``planes``
    planes binary            zstandard frames, one per plane, lowest bits first
    parts array<struct>      documents in the block: doc_id, first (ids of the shard before
                             the document), at (ids of the document before the block),
                             n (its ids here), n_tokens (all its ids)

Each row can be read alone. Spark writes and reads it, so any store will do.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vulnloom.llm.common import id_texts, width
from vulnloom.llm.tokens import END, ID, encoder
from vulnloom.llm.tokens import together as _together

BLOCK = 65536
LEVEL = 1

_PART = pa.struct([("doc_id", pa.int64()), ("first", pa.int64()), ("at", pa.int64()),
                   ("n", pa.int32()), ("n_tokens", pa.int64())])
_FILE = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int32()),
                   ("plane_at", pa.list_(pa.int32())), ("planes", pa.binary()), ("parts", pa.list_(_PART))])
FILE = ("shard int, block int, first long, n_ids int, plane_at array<int>, planes binary, "
        "parts array<struct<doc_id: long, first: long, at: long, n: int, n_tokens: long>>")


def to_planes(ids: np.ndarray, kind: str = "byte") -> list[bytes]:
    """The transposed block: 4 byte planes or 32 bit planes, lowest first."""
    octets = ids.astype(ID).view(np.uint8).reshape(-1, 4)
    if kind == "byte":
        return [octets[:, i].tobytes() for i in range(4)]
    bits = np.unpackbits(octets, axis=1, bitorder="little")
    return [np.packbits(bits[:, i], bitorder="little").tobytes() for i in range(32)]


def from_planes(planes: list[bytes], n: int) -> np.ndarray:
    if len(planes) == 4:
        octets = np.zeros((n, 4), np.uint8)
        for i, plane in enumerate(planes):
            own = np.frombuffer(plane, np.uint8)
            if own.any():
                octets[:, i] = own
    else:
        bits = np.stack([np.unpackbits(np.frombuffer(p, np.uint8), count=n, bitorder="little") for p in planes], axis=1)
        octets = np.packbits(bits, axis=1, bitorder="little")
    return np.ascontiguousarray(octets).view(ID).reshape(n)


def pack_block(ids: np.ndarray, kind: str, press: zstandard.ZstdCompressor) -> tuple[list[int], bytes]:
    frames = [press.compress(plane) for plane in to_planes(ids, kind)]
    return np.cumsum([len(f) for f in frames]).tolist(), b"".join(frames)


def unpack_block(plane_at: list[int], planes: bytes, n: int, press: zstandard.ZstdDecompressor) -> np.ndarray:
    starts = [0, *plane_at[:-1]]
    return from_planes([press.decompress(planes[a:b]) for a, b in zip(starts, plane_at)], n)


def write_ids(docs: DataFrame, path: str, tokenizer_path: str, kind: str = "byte", block: int = BLOCK) -> None:
    """Encode every document, add the end id 0, write all ids in ascending doc_id order.

    A shard is a range of doc_id. A null or empty text is the end id alone; a long text
    goes over as many blocks as it needs; rows that repeat a doc_id follow each other by
    text; a row without doc_id takes no part; an empty table gives files without rows.
    """

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, press = encoder(tokenizer_path, True), zstandard.ZstdCompressor(level=LEVEL)
        shard, number, first = TaskContext.get().partitionId(), 0, 0
        held, here = bytearray(), []

        def full(n: int) -> pa.RecordBatch:
            nonlocal number, first, here
            plane_at, planes = pack_block(np.frombuffer(bytes(held[:4 * n]), ID), kind, press)
            row = [shard, number, first, n, plane_at, planes, here]
            del held[:4 * n]
            number, first, here = number + 1, first + n, []
            return pa.RecordBatch.from_arrays(
                [pa.array([v], f.type) for v, f in zip(row, _FILE)], schema=_FILE)

        for doc_ids, texts in _together(parts):
            for doc_id, ids in zip(doc_ids, own.encode_all(texts)):
                ids += END
                total, at, start = len(ids) // 4, 0, first + len(held) // 4
                while at < total:
                    n = min(total - at, block - len(held) // 4)
                    held += ids[4 * at:4 * (at + n)]
                    here.append({"doc_id": doc_id, "first": start, "at": at, "n": n, "n_tokens": total})
                    at += n
                    if len(held) == 4 * block:
                        yield full(block)
        if held:
            yield full(len(held) // 4)

    rows = id_texts(docs)
    (rows.repartitionByRange(width(rows), "doc_id").sortWithinPartitions("doc_id", "text")
     .mapInArrow(run, FILE).write.option("compression", "uncompressed").parquet(path))


def read_parts(spark: SparkSession, path: str) -> DataFrame:
    """Every document's ids as the files hold them: one row per part, ``ids`` binary."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns, ids in _blocks(rows):
            at = np.cumsum([0] + [p["n"] for p in columns["parts"]])
            raw = ids.tobytes()
            yield _part_batch(columns, [raw[4 * a:4 * b] for a, b in zip(at, at[1:])], pa.binary())

    return spark.read.schema(FILE).parquet(path).mapInArrow(run, f"{_PARTS}, ids binary")


_PARTS = "shard int, doc_id long, first long, at long, n int, n_tokens long"


def _blocks(rows: Iterator[pa.RecordBatch]):
    press = zstandard.ZstdDecompressor()
    for batch in rows:
        for columns in batch.to_pylist():
            yield columns, unpack_block(columns["plane_at"], columns["planes"], columns["n_ids"], press)


def _part_batch(columns: dict, values: list, kind: pa.DataType) -> pa.RecordBatch:
    parts = columns["parts"]
    names = ("doc_id", "first", "at", "n", "n_tokens")
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array([columns["shard"]] * len(parts), pa.int32()),
         *(pa.array([p[c] for p in parts], k) for c, k in zip(names, kinds)), pa.array(values, kind)],
        names=["shard", *names, "ids" if kind == pa.binary() else "crc"])


def joined_crc(parts: list[tuple[int, int]]) -> int:
    """The crc32 of parts one after another, of (bytes, crc32) each."""
    crc = 0
    for n, own in parts:
        zeros = bytes(n)
        crc = zlib.crc32(zeros, crc) ^ zlib.crc32(zeros) ^ own
    return crc


def document_index(spark: SparkSession, path: str) -> DataFrame:
    """Read the files back: doc_id, start, n_tokens and ids_crc32 of every document.

    Blocks are read in any order. What a block holds of a document is summed up by a
    crc32; documents over several blocks are put together from those.
    """

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns, ids in _blocks(rows):
            at = np.cumsum([0] + [p["n"] for p in columns["parts"]])
            raw = memoryview(ids.tobytes())
            yield _part_batch(columns, [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(at, at[1:])], pa.int64())

    def join(groups: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for own in groups:
            yield pa.array([joined_crc([(4 * p["n"], p["crc"]) for p in parts]) for parts in own.to_pylist()], pa.int64())

    files = spark.read.schema(FILE).parquet(path)
    key = ["shard", "doc_id", "first", "n_tokens"]
    each = (files.mapInArrow(run, f"{_PARTS}, crc long").groupBy(key)
            .agg(F.array_sort(F.collect_list(F.struct("at", "n", "crc"))).alias("own"))
            .select(*key, F.arrow_udf(join, "long")("own").alias("ids_crc32")))
    # One row per shard, and a shard is a partition of the write: a table of fixed size.
    sizes = files.groupBy("shard").agg(F.sum("n_ids").alias("n_ids"))
    before = F.sum("n_ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("shard", F.coalesce(before, F.lit(0)).alias("shard_start"))
    return each.join(F.broadcast(starts), "shard").select(
        "doc_id", (F.col("shard_start") + F.col("first")).alias("start"), "n_tokens", "ids_crc32")
