"""Vectors dealt to shards, and query blocks to every shard."""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vulnloom.llm.common import staged

SHARD_ROWS = 8192
BLOCK_ROWS = 512
EVERY = 20


def clean(embeddings: DataFrame) -> DataFrame:
    """vec_id and v, an array of finite doubles. Other vectors, empty ones and rows without
    vec_id are left out; of rows that repeat a vec_id the least vector counts."""
    v = F.col("embedding").cast("array<double>")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
            .where("vec_id IS NOT NULL AND v IS NOT NULL AND size(v) > 0").where(fine)
            .groupBy("vec_id").agg(F.min("v").alias("v")))


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def pack_arrays(arrays: dict[str, np.ndarray]) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def unpack_arrays(blob: bytes) -> dict[str, np.ndarray]:
    return dict(np.load(io.BytesIO(blob)))


def dealt(vectors: DataFrame, rows: int, name: str) -> DataFrame:
    """Vectors with the number of their part by hash, of about ``rows`` vectors each. Vectors
    of different length never meet."""
    sizes = vectors.groupBy(F.size("v").alias("dim")).agg(F.ceil(F.count("*") / rows).cast("int").alias("parts"))
    return (vectors.withColumn("dim", F.size("v")).join(F.broadcast(sizes), "dim")
            .withColumn(name, F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int")))


def indexed(vectors: DataFrame, build: Callable[[np.ndarray, np.ndarray], dict[str, np.ndarray]],
            rows: int = SHARD_ROWS) -> DataFrame:
    """One index per shard: dim, shard, parts and the flat arrays of ``build(ids, vectors)``."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("vec_id")
        arrays = build(table["vec_id"].to_numpy(), matrix(table["v"]))
        return pa.table({"dim": table["dim"][:1], "shard": table["shard"][:1], "parts": table["parts"][:1],
                         "arrays": pa.array([pack_arrays(arrays)], pa.binary())})

    shards = dealt(vectors, rows, "shard").groupBy("dim", "shard").applyInArrow(
        run, "dim int, shard int, parts int, arrays binary")
    return staged(shards, "shards")


def query_blocks(queries: DataFrame, index: DataFrame, rows: int = BLOCK_ROWS) -> DataFrame:
    """Queries in blocks of about ``rows``, each block once for every shard of its dimension.

    ``queries``: vec_id, v and floor, a score that results must reach."""
    shards = index.select("dim", "shard")
    blocks = (dealt(queries, rows, "block").groupBy("dim", "block")
              .agg(F.array_sort(F.collect_list(F.struct("vec_id", "v", "floor"))).alias("queries")))
    return blocks.join(index.groupBy("dim").agg(F.max("parts").alias("n")), "dim").select(
        "dim", F.explode(F.expr("sequence(0, n - 1)")).alias("shard"), "queries"
    ).join(shards, ["dim", "shard"], "left_semi")


def searched(index: DataFrame, blocks: DataFrame, search: Callable, score: str) -> DataFrame:
    """Every block against every shard: rows (query_id, vec_id, score).

    ``search(arrays, query ids, query vectors, floors)`` yields (query place, ids, scores).
    """
    kind = pa.int64() if score == "long" else pa.float64()

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for row in range(len(part)):
                arrays = unpack_arrays(part.column("arrays")[row].as_py())
                own = part.column("queries")[row].values
                ids, floors = own.field("vec_id").to_numpy(), own.field("floor").to_numpy()
                vectors = matrix(own.field("v"))
                found = list(search(arrays, ids, vectors, floors))
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate([np.full(len(i), ids[q]) for q, i, _ in found]), pa.int64()),
                         pa.array(np.concatenate([i for _, i, _ in found]), pa.int64()),
                         pa.array(np.concatenate([s for _, _, s in found]), kind)],
                        names=["query_id", "vec_id", "score"])

    pairs = index.select("dim", "shard", "arrays").join(blocks, ["dim", "shard"]).select("arrays", "queries")
    return pairs.mapInArrow(run, f"query_id long, vec_id long, score {score}")


def best(found: DataFrame, k: int) -> DataFrame:
    """The k highest scores of each query, ties to the smaller vec_id, ranked from 1."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
