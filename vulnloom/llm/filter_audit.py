"""Filter interaction audit: what each of five filters removes, in every order of applying them.

A document is five bits, one per filter it fails. Everything asked of an order of filters
depends on the counts of documents by these bits alone, so the documents are counted once
per part, and the counts of a part are a 2x2x2x2x2 tensor with an axis for each filter:
place 0 passes it, place 1 fails it. A step of an order contracts the tensor with one vector
per axis that picks pass, fail or all. Documents shuffle as narrow rows without their texts;
what reaches Python is 32 counts per part.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vulnloom.llm.common import staged

# --- Fixed values ---------------------------------------------------------------
FILTERS = "ABCDE"
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MARKS = "[#$%&*|]"
LEAST_WORDS = 50
LEAST_DISTINCT = 65
MOST_UPPER = 5
# ----------------------------------------------------------------------------------

ORDERS = ["".join(order) for order in permutations(FILTERS)]
#: (order, step) of each row of a part.
STEPS = [(order, step) for order in ORDERS for step in range(1, len(FILTERS) + 1)]
PASS, FAIL, ALL = np.array([1, 0]), np.array([0, 1]), np.array([1, 1])


def failures(text: Column) -> Column:
    """The filters A to D that a text fails, as bits from A's."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    upper = F.length(text) - F.length(F.translate(text, UPPER, ""))
    fails = [
        F.size(words) < LEAST_WORDS,
        100 * F.size(F.array_distinct(words)) < LEAST_DISTINCT * F.size(words),
        100 * upper.cast("long") > MOST_UPPER * F.length(text).cast("long"),
        text.rlike(MARKS),
    ]
    return sum((f.cast("int") * (1 << i) for i, f in enumerate(fails)), F.lit(0))


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, fails (five bits, A's the lowest) and how many documents: n, good, toxic.

    A text is an exact copy (E) of a smaller doc_id where its own is not the smallest of
    its SHA-256. That smallest one comes back by text and doc_id together, which no group
    of copies makes frequent.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    flags = staged(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("name"),
        failures(text).alias("fails"),
    ), "flags")
    first = flags.groupBy("name").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    marked = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    copy = (F.col("doc_id").isNotNull() & F.col("first").isNull()).cast("int")
    return (flags.join(first, ["name", "doc_id"], "left").join(marked, "doc_id", "left")
            .withColumn("fails", F.col("fails") + 16 * copy)
            .groupBy("part", "fails").agg(F.count("*").alias("n"), F.sum(F.coalesce("good", F.lit(0))).alias("good"),
                                          F.sum(F.coalesce("toxic", F.lit(0))).alias("toxic")))


def selectors() -> dict[str, np.ndarray]:
    """For each measure, the vectors of every step: step by filter by (pass, fail)."""
    out = {name: np.empty((len(STEPS), len(FILTERS), 2), np.int64) for name in ("kept", "removed", "unique_fails", "fails")}
    for row, (order, step) in enumerate(STEPS):
        own, before = order[step - 1], order[:step - 1]
        for axis, name in enumerate(FILTERS):
            out["kept"][row, axis] = PASS if name == own or name in before else ALL
            out["removed"][row, axis] = FAIL if name == own else PASS if name in before else ALL
            out["unique_fails"][row, axis] = FAIL if name == own else PASS
            out["fails"][row, axis] = FAIL if name == own else ALL
    return out


def contracted(counts: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Counts (parts by 2x2x2x2x2) under each row of vectors: parts by rows."""
    return np.einsum("pabcde,sa,sb,sc,sd,se->ps", counts, *(chosen[:, i] for i in range(len(FILTERS))), optimize=True)


_MEASURES = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def _tensors(lists: pa.ListArray) -> np.ndarray:
    """Counts of each part: (n, good, toxic) by parts by 2x2x2x2x2, an axis per filter from A."""
    out = np.zeros((3, len(lists), 32), np.int64)
    own = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    found = lists.flatten()
    for i, name in enumerate(("n", "good", "toxic")):
        out[i, own, found.field("fails").to_numpy()] = found.field(name).to_numpy()
    # The lowest bit is A's: it is the last axis of a plain reshape.
    return out.reshape(3, len(lists), 2, 2, 2, 2, 2).transpose(0, 1, 6, 5, 4, 3, 2)


def _steps(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    chosen = selectors()
    letter = np.array([FILTERS.index(order[step - 1]) for order, step in STEPS])
    orders, steps = pa.array([o for o, _ in STEPS]), pa.array([s for _, s in STEPS], pa.int32())
    for batch in parts:
        for a in range(0, len(batch), 64):
            some = batch.slice(a, 64)
            count, good, toxic = _tensors(some.column("cells"))
            m = {name: contracted(count, chosen[name]) for name in ("kept", "removed", "unique_fails")}
            m["redundant"] = contracted(count, chosen["fails"]) - m["removed"]
            m["good_lost"], m["toxic_lost"] = contracted(good, chosen["removed"]), contracted(toxic, chosen["removed"])
            whole = np.stack([m["removed"][:, letter == i].sum(axis=1) for i in range(len(FILTERS))], axis=1)
            m["shapley"] = whole[:, letter]
            yield pa.RecordBatch.from_arrays(
                [some.column("part").take(pa.array(np.repeat(np.arange(len(some)), len(STEPS)))),
                 pa.concat_arrays([orders] * len(some)), pa.concat_arrays([steps] * len(some)),
                 *(pa.array(m[name].ravel()) for name in _MEASURES)],
                names=["part", "filter_order", "step", *_MEASURES])


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the five filters and step.

    Returns part (the source; null is empty), filter_order, step and, of the part's
    documents: kept after the step, removed by it, redundant (fail its filter, removed
    earlier), unique_fails (fail its filter alone), good_lost and toxic_lost (removed here
    and labelled so) and shapley (what its filter removes, over all orders).

    Null and empty texts are the same: no words, so they fail A, and E as copies. Every
    row counts, repeated rows too, which are no copies of each other: E asks for a smaller
    doc_id. A row without doc_id never fails E and has no label; labels that repeat a
    doc_id count as one, 1 where any says so. A table without rows has no parts. Other
    columns are not read.
    """
    grouped = cells(docs, labels).groupBy("part").agg(F.collect_list(F.struct("fails", "n", "good", "toxic")).alias("cells"))
    kinds = ", ".join(f"{name} long" for name in _MEASURES)
    return grouped.mapInArrow(_steps, f"part string, filter_order string, step int, {kinds}")
