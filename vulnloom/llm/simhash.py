"""SimHash near-duplicates by pigeonhole blocks."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vulnloom.llm.common import batches, id_text_rows, id_texts, staged
from vulnloom.llm.components import components

SHINGLE = 3
DISTANCE = 3
SEED = 42
BLOCKS = 6
TILE = 2048

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of a text; zero where it has no words."""
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    runs = words if shingle == 1 else map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    digest = xxhash.xxh64_intdigest
    hashes = [digest(run, SEED) for run in runs] or [digest(b" ".join(words), SEED)]
    octets = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(octets), 1 << 14):
        ones += np.unpackbits(octets[at:at + (1 << 14)], axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * ones > len(octets), bitorder="little").view("<u8")[0])


def text_key() -> Column:
    """What tells rows that repeat a doc_id apart: a hash of the text."""
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, its fingerprint as a signed long and the key of its text. A null text has no words."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            fps = [fingerprint(text, shingle) for _, text in id_text_rows([part])]
            signed = np.array(fps, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(signed), part.column("key")], names=["doc_id", "fp", "key"])

    return id_texts(docs, key=text_key()).mapInArrow(run, "doc_id long, fp long, key long")


def block_masks(blocks: int, distance: int) -> list[int]:
    """Masks of the block choices of which close fingerprints share one at least.

    64 bits are cut into ``blocks`` blocks. Where ``distance`` bits differ, at least
    ``blocks - distance`` blocks agree.
    """
    if not 0 <= distance < blocks <= 64:
        raise ValueError("there must be more blocks than differing bits")
    edges = [64 * i // blocks for i in range(blocks + 1)]
    own = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    masks = [sum(choice) for choice in combinations(own, blocks - distance)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _forest(fps: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Edges that join what close fingerprints of one tile join, one fewer than its members at most."""
    bits = fps.view(np.uint64)  # a count of bits takes the size of a signed number
    if len(fps) == 2:
        return [(fps[0], fps[1])] if int(np.bitwise_count(bits[0] ^ bits[1])) <= distance else []
    left = np.arange(len(fps))
    edges = []
    while len(left):
        reached, left = left[:1], left[1:]
        while len(reached) and len(left):
            at, reached = reached[0], reached[1:]
            near = np.bitwise_count(bits[left] ^ bits[at]) <= distance
            edges.extend((fps[at], fp) for fp in fps[left[near]])
            reached, left = np.concatenate([reached, left[near]]), left[~near]
    return edges


def links(fps: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS, tile: int = TILE) -> DataFrame:
    """Edges (a, b) between distinct fingerprints whose components are those of all close pairs.

    Every fingerprint is listed once under each choice of shared blocks; only keys that
    several fingerprints share go on. A key of more than ``tile`` fingerprints is dealt
    to hashed parts of about that size, and every pair of parts is a tile of its own, so
    each pair of fingerprints of a key meets in one task of bounded size and none is
    left out. A tile verifies distances and emits the edges of a spanning forest, never
    its pairs.
    """
    masks = F.array(*(F.lit(m).cast("long") for m in block_masks(blocks, distance)))
    keyed = (fps.select("fp").distinct()
             .select("fp", F.posexplode(masks).alias("choice", "mask"))
             .select("fp", "choice", F.col("mask").bitwiseAND(F.col("fp")).alias("key")))
    shared = keyed.groupBy("choice", "key").agg(F.count("*").alias("n")).where("n > 1")
    n_parts = F.ceil(F.col("n") / F.lit(tile)).cast("int")
    dealt = (keyed.join(shared, ["choice", "key"])
             .withColumn("parts", n_parts)
             .withColumn("own", F.pmod(F.xxhash64("fp", "choice"), F.col("parts")).cast("int"))
             .withColumn("other", F.explode(F.expr("sequence(0, parts - 1)")))
             .select("choice", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp"))
    tiles = ["choice", "key", "i", "j"]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

        def rows():
            kept = None
            for part in parts:
                keys = np.stack([part.column(c).to_numpy().astype(np.int64) for c in tiles], axis=1)
                own = part.column("fp").to_numpy()
                if kept is not None:
                    keys, own = np.concatenate([kept[0], keys]), np.concatenate([kept[1], own])
                cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
                cuts = [0, *cuts.tolist()]
                for a, b in zip(cuts, cuts[1:]):
                    yield from _forest(own[a:b], distance)
                kept = keys[cuts[-1]:], own[cuts[-1]:]
            if kept is not None:
                yield from _forest(kept[1], distance)

        yield from batches(((int(a), int(b)) for a, b in rows()), schema)

    return (dealt.repartition(*tiles).sortWithinPartitions(*tiles)
            .mapInArrow(run, "a long, b long").distinct())


def grouped(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE,
            blocks: int = BLOCKS, tile: int = TILE) -> DataFrame:
    """doc_id, fp, key, root and component_id of every row with a doc_id.

    ``root`` is the smallest fingerprint of the component. Components of unrelated texts
    under one doc_id can share component_id, but not root.
    """
    own = staged(fingerprints(docs, shingle), "fingerprints")
    classes = own.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    roots = components(links(own, distance, blocks, tile))
    joined = classes.join(roots, F.col("fp") == F.col("node"), "left")
    joined = joined.select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    least = joined.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = joined.join(least, "root").select("fp", "root", "component_id")
    return own.join(named, "fp")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE,
                    blocks: int = BLOCKS, tile: int = TILE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every document.

    Documents link where their fingerprints differ in ``distance`` bits or fewer;
    component_id is the smallest doc_id reachable. Copies share a fingerprint and take
    part as one. Texts that are null, empty or without words have fingerprint zero, and
    link like any other; rows that repeat a doc_id are returned each; a row without
    doc_id takes no part; an empty table gives no rows.
    """
    return grouped(docs, shingle, distance, blocks, tile).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
