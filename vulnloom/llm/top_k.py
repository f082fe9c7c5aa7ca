"""Exact top-k by inner product: ball trees per shard, searched by branch and bound."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vulnloom.llm.common import staged
from vulnloom.llm.vectors import EVERY, best, clean, indexed, query_blocks, searched

K = 20
LEAF = 128
#: Room for rounding in bounds, as a share of the sizes that enter them.
SLACK = 1e-9


def quantised(vectors: DataFrame, scale: int = 64) -> DataFrame:
    """Each component x as floor(scale * x), a whole double."""
    return vectors.withColumn("v", F.transform("v", lambda x: F.floor(x * scale).cast("double")))


def build(ids: np.ndarray, vectors: np.ndarray, leaf: int = LEAF) -> dict[str, np.ndarray]:
    """A ball tree as flat arrays. Node n holds rows start[n] to end[n]; left[n] is -1 in a leaf.

    A node is halved at the median of its projection on the line between two far points.
    """
    order = np.arange(len(ids))
    start, end, left, centre, radius = [], [], [], [], []

    def add(a: int, b: int) -> int:
        own = vectors[order[a:b]]
        middle = own.mean(axis=0)
        start.append(a), end.append(b), left.append(-1), centre.append(middle)
        radius.append(np.sqrt(((own - middle) ** 2).sum(axis=1).max()))
        return len(start) - 1

    open_nodes = [add(0, len(ids))]
    while open_nodes:
        node = open_nodes.pop()
        a, b = start[node], end[node]
        if b - a <= leaf or radius[node] == 0:
            continue
        own = vectors[order[a:b]]
        one = own[((own - centre[node]) ** 2).sum(axis=1).argmax()]
        two = own[((own - one) ** 2).sum(axis=1).argmax()]
        order[a:b] = order[a:b][np.argsort(own @ (two - one), kind="stable")]
        left[node] = add(a, (a + b) // 2)
        add((a + b) // 2, b)
        open_nodes += [left[node], left[node] + 1]
    return {"ids": ids[order], "vectors": vectors[order], "start": np.array(start), "end": np.array(end),
            "left": np.array(left), "centre": np.array(centre), "radius": np.array(radius)}


def search(tree: dict[str, np.ndarray], ids: np.ndarray, queries: np.ndarray, floors: np.ndarray,
           k: int = K, leaves: int | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The k best rows per query that reach its floor; ``leaves``: stop after so many leaves.

    No row of a node scores above q.centre + |q| radius. Nodes are taken in the order of
    that bound until it falls below the floor or the kth score so far. Equal bounds are
    searched, so ties are whole.
    """
    size = np.sqrt((queries ** 2).sum(axis=1))
    bounds = queries @ tree["centre"].T + size[:, None] * tree["radius"]
    bounds += SLACK * (1 + size[:, None] * (tree["radius"] + np.sqrt((tree["centre"] ** 2).sum(axis=1))))
    start, end, left = (tree[c].tolist() for c in ("start", "end", "left"))
    for q, query in enumerate(queries):
        bound = bounds[q]
        kth, scores, own = floors[q], np.zeros(0), np.zeros(0, np.int64)
        todo, seen = [(-bound[0], 0)], 0
        while todo and -todo[0][0] >= kth and (leaves is None or seen < leaves):
            node = heapq.heappop(todo)[1]
            if left[node] >= 0:
                for child in (left[node], left[node] + 1):
                    if bound[child] >= kth:
                        heapq.heappush(todo, (-bound[child], child))
                continue
            seen += 1
            a, b = start[node], end[node]
            got = tree["vectors"][a:b] @ query
            take = (got >= kth) & (tree["ids"][a:b] != ids[q])
            if take.any():
                scores = np.concatenate([scores, got[take]])
                own = np.concatenate([own, tree["ids"][a:b][take]])
                if len(scores) > k:
                    first = np.lexsort((own, -scores))[:k]
                    scores, own = scores[first], own[first]
                if len(scores) == k:
                    kth = max(kth, scores.min())
        if len(own):
            yield q, own, scores.astype(np.int64)


def top_k(embeddings: DataFrame, k: int = K, every: int = EVERY, scale: int = 64) -> DataFrame:
    """Each query's ``k`` rows of highest integer inner product: query_id, rank, vec_id, score.

    Components become floor(scale * x). Queries are rows whose vec_id is divisible by
    ``every``, candidates every row but the query's own; with fewer candidates all are
    returned, and ties go to the smaller vec_id. Vectors that are null, empty or hold
    null or non-finite components take no part, nor do rows without vec_id; of rows that
    repeat a vec_id the least vector counts; vectors of different length never meet.
    Scores are exact below 2**53. An empty table gives no rows.

    Vectors are dealt to shards with a ball tree each, queries to blocks that meet every
    shard. A first round scores each query's best leaf in every shard; its kth score over
    all shards is the floor that every shard starts from in the second round.
    """
    vectors = quantised(staged(clean(embeddings), "vectors"), scale)
    index = indexed(vectors, build)
    queries = vectors.where(F.col("vec_id") % every == 0).select("vec_id", "v")
    blocks = query_blocks(queries.withColumn("floor", F.lit(float("-inf"))), index)
    first = best(searched(index, blocks, lambda *a: search(*a, k=k, leaves=1), "long"), k)
    floors = first.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").cast("double").alias("kth"))
    raised = queries.join(floors, "vec_id", "left").select(
        "vec_id", "v", F.coalesce("kth", F.lit(float("-inf"))).alias("floor"))
    return best(searched(index, query_blocks(raised, index), lambda *a: search(*a, k=k), "long"), k)
