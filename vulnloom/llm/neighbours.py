"""Approximate nearest neighbours: one hierarchical navigable small-world graph per shard."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vulnloom.llm.common import staged
from vulnloom.llm.vectors import EVERY, best, clean, indexed, query_blocks, searched

K = 20
LINKS = 16
BUILD_BEAM = 64
SEARCH_BEAM = 128
AT_ONCE = 4
BATCH = 1024
FIRST = 256


def _beam(vectors: np.ndarray, links: np.ndarray, queries: np.ndarray, entry: np.ndarray, width: int):
    """Beam search of many queries in one layer; ids and similarities, best first, -1 and -inf
    where nothing was found. The layer is the first len(links) rows."""
    n, rows = len(queries), np.arange(len(queries))
    ids = np.full((n, width), -1, np.int64)
    near = np.full((n, width), -np.inf, np.float32)
    done = np.ones((n, width), bool)
    seen = np.zeros((n, len(links)), bool)
    ids[:, 0], done[:, 0] = entry, False
    near[:, 0] = (queries * vectors[entry]).sum(axis=1)
    seen[rows, entry] = True
    active = rows
    while len(active):
        rank = np.where(done[active], -np.inf, near[active])
        take = np.argpartition(-rank, min(AT_ONCE, width) - 1, axis=1)[:, :AT_ONCE]
        fresh = np.take_along_axis(rank, take, 1) > -np.inf
        done[active[:, None], take] = True
        around = np.where(fresh[:, :, None], links[np.take_along_axis(ids[active], take, 1)], -1).reshape(len(active), -1)
        around.sort(axis=1)
        valid = around >= 0
        valid[:, 1:] &= around[:, 1:] != around[:, :-1]
        valid &= ~seen[active[:, None], around]
        q, c = np.nonzero(valid)
        seen[active[q], around[q, c]] = True
        got = np.full(around.shape, -np.inf, np.float32)
        got[q, c] = np.einsum("ij,ij->i", queries[active[q]], vectors[around[q, c]])
        all_near = np.concatenate([near[active], got], axis=1)
        keep = np.argpartition(-all_near, width - 1, axis=1)[:, :width]
        all_ids = np.concatenate([ids[active], np.where(valid, around, -1)], axis=1)
        all_done = np.concatenate([done[active], ~valid], axis=1)
        ids[active] = np.take_along_axis(all_ids, keep, 1)
        near[active] = np.take_along_axis(all_near, keep, 1)
        done[active] = np.take_along_axis(all_done, keep, 1)
        active = active[~done[active].all(axis=1)]
    order = np.argsort(-near, axis=1, kind="stable")
    return np.take_along_axis(ids, order, 1), np.take_along_axis(near, order, 1)


def _choose(vectors: np.ndarray, ids: np.ndarray, near: np.ndarray, room: int) -> np.ndarray:
    """Up to ``room`` links of each row of candidates, best first: those nearer to the row than to
    any link chosen before, then the nearest of the rest; -1 fills up."""
    n, width = ids.shape
    own = vectors[np.maximum(ids, 0)]
    between = own @ own.transpose(0, 2, 1)
    valid = ids >= 0
    chosen = np.zeros((n, width), bool)
    count = np.zeros(n, np.int64)
    for j in range(width):
        closest = np.where(chosen, between[:, j], -np.inf).max(axis=1)
        chosen[:, j] = valid[:, j] & (count < room) & (near[:, j] >= closest)
        count += chosen[:, j]
    order = np.argsort(np.where(chosen, 0, np.where(valid, 1, 2)), axis=1, kind="stable")[:, :room]
    out = np.take_along_axis(np.where(valid, ids, -1), order, 1)
    if out.shape[1] < room:
        out = np.pad(out, ((0, 0), (0, room - out.shape[1])), constant_values=-1)
    return out


def _link_back(vectors: np.ndarray, links: np.ndarray, new: np.ndarray) -> None:
    """Add the new nodes to the lists of those they link to; full lists choose anew."""
    room = links.shape[1]
    a, b = np.repeat(new, room), links[new].ravel()
    a, b = a[b >= 0], b[b >= 0]
    to = np.unique(b)
    old = links[to]
    held_a, held_b = np.repeat(to, room)[old.ravel() >= 0], old.ravel()[old.ravel() >= 0]
    pairs = np.unique(np.stack([np.concatenate([held_a, b]), np.concatenate([held_b, a])], axis=1), axis=0)
    near = np.einsum("ij,ij->i", vectors[pairs[:, 0]], vectors[pairs[:, 1]])
    order = np.lexsort((-near, pairs[:, 0]))
    node, other, near = pairs[order, 0], pairs[order, 1], near[order]
    first = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
    place = np.arange(len(node)) - np.repeat(first, np.diff(np.r_[first, len(node)]))
    width = 2 * room
    keep = place < width
    row = np.searchsorted(to, node[keep])
    ids = np.full((len(to), width), -1, np.int64)
    sims = np.full((len(to), width), -np.inf, np.float32)
    ids[row, place[keep]], sims[row, place[keep]] = other[keep], near[keep]
    for at in range(0, len(to), BATCH):
        own = slice(at, at + BATCH)
        links[to[own]] = _choose(vectors, ids[own], sims[own], room)


def _layer(vectors: np.ndarray, n: int, room: int, above: list[np.ndarray]) -> np.ndarray:
    """The links of the first n rows, added in batches that never exceed what is there."""
    links = np.full((n, room), -1, np.int64)
    done = 0
    while done < n:
        new = np.arange(done, min(n, done + (FIRST if not done else min(done, BATCH))))
        among = vectors[new] @ vectors[new].T
        np.fill_diagonal(among, -np.inf)
        width = min(BUILD_BEAM, len(new))
        inside = np.argpartition(-among, width - 1, axis=1)[:, :width]
        near = np.take_along_axis(among, inside, 1).astype(np.float32)
        ids = np.where(near > -np.inf, inside + done, -1)
        if done:
            found, sims = _beam(vectors, links[:done], vectors[new], _descend(vectors, above, vectors[new], done), BUILD_BEAM)
            ids, near = np.concatenate([ids, found], axis=1), np.concatenate([near, sims], axis=1)
        order = np.argsort(-near, axis=1, kind="stable")[:, :BUILD_BEAM]
        links[new] = _choose(vectors, np.take_along_axis(ids, order, 1), np.take_along_axis(near, order, 1), room)
        done = int(new[-1]) + 1
        _link_back(vectors, links[:done], new)
    return links


def _descend(vectors: np.ndarray, layers: list[np.ndarray], queries: np.ndarray, limit: int | None = None) -> np.ndarray:
    """The node that the upper layers lead each query to; layers of more than ``limit`` rows are left out."""
    entry = np.zeros(len(queries), np.int64)
    for links in layers:
        if limit is None or len(links) <= limit:
            entry = _beam(vectors, links, queries, entry, AT_ONCE)[0][:, 0]
    return entry


def build(ids: np.ndarray, vectors: np.ndarray, links: int = LINKS, seed: int = 42) -> dict[str, np.ndarray]:
    """The graph of a shard as flat arrays.

    Copies of a vector are one node; ``members`` lists the ids of all nodes in order. A
    component that completes all vectors to the longest turns the largest inner product
    into the nearest vector. Nodes are numbered by level, highest first, so a layer is a
    first part of them; ``links0`` is the lowest layer.
    """
    nodes, of = np.unique(vectors, axis=0, return_inverse=True)
    of = of.ravel()
    dice = np.random.default_rng(seed)
    level = np.floor(-np.log(1 - dice.random(len(nodes))) / np.log(links)).astype(np.int64)
    order = np.argsort(-level, kind="stable")
    number = np.empty(len(nodes), np.int64)
    number[order] = np.arange(len(nodes))
    nodes, of = nodes[order], number[of]
    square = (nodes ** 2).sum(axis=1)
    space = np.concatenate([nodes, np.sqrt(np.maximum(square.max() - square, 0))[:, None]], axis=1)
    space = (space / max(np.sqrt(square.max()), 1e-300)).astype(np.float32)
    layers: list[np.ndarray] = []
    for at in range(int(level.max()), -1, -1):
        layers.append(_layer(space, int((level >= at).sum()), links * (2 if at == 0 else 1), layers))
    by_node = np.lexsort((ids, of))
    out = {"nodes": nodes, "space": space, "members": ids[by_node], "member_at": np.searchsorted(of[by_node], np.arange(len(nodes) + 1))}
    return out | {f"links{len(layers) - 1 - i}": own.astype(np.int32) for i, own in enumerate(layers)}


def search(graph: dict[str, np.ndarray], ids: np.ndarray, queries: np.ndarray, floors: np.ndarray,
           k: int = K, beam: int = SEARCH_BEAM) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The k best rows found for each query, scored on the original vectors in double precision."""
    layers = [graph[f"links{i}"] for i in range(sum(name.startswith("links") for name in graph) - 1, -1, -1)]
    size = np.sqrt((queries ** 2).sum(axis=1, keepdims=True))
    asked = np.concatenate([queries / size, np.zeros((len(queries), 1))], axis=1).astype(np.float32)
    found, _ = _beam(graph["space"], layers[-1], asked, _descend(graph["space"], layers[:-1], asked), beam)
    at = graph["member_at"]
    for q in range(len(queries)):
        nodes = found[q][found[q] >= 0]
        scores = graph["nodes"][nodes] @ queries[q]
        order = np.argsort(-scores, kind="stable")[:k + 1]
        own, values = [], []
        for node, value in zip(nodes[order], scores[order]):
            members = graph["members"][at[node]:at[node + 1]][:k + 1]
            own.append(members)
            values.append(np.full(len(members), value))
        own, values = np.concatenate(own), np.concatenate(values)
        other = own != ids[q]
        own, values = own[other], values[other]
        first = np.lexsort((own, -values))[:k]
        if len(first):
            yield q, own[first], values[first]


def nearest(embeddings: DataFrame, k: int = K, every: int = EVERY, beam: int = SEARCH_BEAM) -> DataFrame:
    """Each query's ``k`` nearest rows found by inner product: query_id, rank, vec_id, score.

    Queries are rows whose vec_id is divisible by ``every``, candidates every row but the
    query's own; nearest first, ties to the smaller vec_id. Vectors that are null, empty,
    zero or hold null or non-finite components take no part, nor do rows without vec_id;
    of rows that repeat a vec_id the least vector counts; vectors of different length
    never meet. An empty table gives no rows.

    Vectors are dealt by hash to shards of bounded size, each with one graph over all its
    vectors. Queries in blocks meet every shard, and their results are merged.
    """
    vectors = staged(clean(embeddings).where(F.exists("v", lambda x: x != 0)), "vectors")
    index = indexed(vectors, build)
    queries = vectors.where(F.col("vec_id") % every == 0).select("vec_id", "v", F.lit(float("-inf")).alias("floor"))
    return best(searched(index, query_blocks(queries, index), lambda *a: search(*a, k=k, beam=beam), "double"), k)
