"""Repeated byte strings of fixed length, by prefix doubling over sampled positions.

Ranking every position costs a sort of about 16 bytes for each byte of text and round.
Here only sampled positions are ranked, about one in 32 (``shared_runs``): windows alike
have their sampled position at the same place, so a window can only repeat where its
sampled position's rank does.

1. Rank sampled positions by their 32-byte prefix. Those whose rank is unique leave.
2. Rank the rest by all bytes their windows cover, 100 to 168. Equal ranks are past the
   threshold: all windows of all but the earliest repeat.
3. Earliest positions whose prefix also starts other strings are the ends of repeats.
   Their windows are ranked by all 100 bytes; all but the earliest of a rank repeat.

A rank is a hash of the string: 64 bits of the prefix and 64 of what is compared further.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vulnloom.llm.common import by_group, id_text_rows, id_texts, staged, width
from vulnloom.llm.shared_runs import hashes, mixed, sampled_runs, segments, sums

WINDOW = 100
#: Sampled positions that a task compares before it sends them on.
CHUNK = 1 << 20
#: Different strings of one prefix in a chunk beyond which they are dealt out by string.
MANY = 16
#: Parts that the windows of such a prefix are dealt to, at least, and windows beyond which there are more.
PARTS = 64
PART_WINDOWS = 1 << 20

_ROW = pa.schema([("name", pa.int64()), ("salt", pa.int32()), ("run", pa.int64()), ("doc_id", pa.int64()),
                  ("place", pa.int64()), ("kind", pa.int8())])
# kind: what a row is. Local repeats are decided already; markers only tell that a name is frequent.
SEEN, REPEAT, MARKER, OPEN = 0, 1, 2, 3
# place: first window << 16 | sampled position after it << 8 | further windows.


def changes(*columns: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return new


def _table(name, salt, run, doc, place, kind) -> pa.RecordBatch:
    columns = [name.view(np.int64), salt.astype(np.int32), run.view(np.int64), doc, place, np.broadcast_to(np.int8(kind), len(name))]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=_ROW)


def _compare(doc, place, name, run) -> Iterator[pa.RecordBatch]:
    """Of a chunk's sampled positions, the earliest of each string, and the others as repeats."""
    order = np.lexsort((place, doc, run, name))
    doc, place, name, run = doc[order], place[order], name[order], run[order]
    fresh = changes(name, run, doc, place)
    doc, place, name, run = doc[fresh], place[fresh], name[fresh], run[fresh]
    first = changes(name, run)
    if not first.all():
        rest = ~first
        zero = np.zeros(int(rest.sum()), np.int64)
        yield _table(zero.view(np.uint64), zero, zero.view(np.uint64), doc[rest], place[rest], REPEAT)
    doc, place, name, run = doc[first], place[first], name[first], run[first]
    head = changes(name)
    of = np.cumsum(head) - 1
    many = np.bincount(of)[of] > MANY
    salt = np.where(many, 1 + (run % np.uint64(1 << 16)).astype(np.int64), 0)
    yield _table(name, salt, run, doc, place, SEEN)
    mark = head & many
    if mark.any():
        yield _table(name[mark], np.zeros(int(mark.sum()), np.int64), run[mark], doc[mark], place[mark], MARKER)


def _sample(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for group in segments(id_text_rows(parts), WINDOW):
        runs = sampled_runs([text for _, _, text in group], WINDOW)
        doc = np.array([d for d, _, _ in group], np.int64)[runs.segment]
        first = np.array([s for _, s, _ in group], np.int64)[runs.segment] + runs.first
        held.append((doc, first << 16 | runs.at << 8 | runs.more, runs.name, runs.run))
        size += len(doc)
        if size >= CHUNK:
            yield from _compare(*map(np.concatenate, zip(*held)))
            held, size = [], 0
    if size:
        yield from _compare(*map(np.concatenate, zip(*held)))


def _rank(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeats, and open positions whose windows must be compared one by one."""
    for table in by_group(parts, ("name", "salt")):
        name, salt, run, doc, place = (table[c].to_numpy() for c in ("name", "salt", "run", "doc_id", "place"))
        marker = table["kind"].to_numpy() == MARKER
        group = changes(name, salt)
        of = np.cumsum(group) - 1
        first = group | changes(run)
        class_of = np.cumsum(first) - 1
        n_classes = np.bincount(of, weights=first)[of]
        frequent = (salt > 0) | (np.bincount(of, weights=marker)[of] > 0)
        start = np.flatnonzero(first)[class_of]
        earliest = (doc == doc[start]) & (place == place[start])
        repeat = ~earliest & ~marker
        is_open = earliest & ~marker & ((n_classes > 1) | frequent)
        is_open &= changes(name, salt, run, doc, place)
        keep = repeat | is_open
        if keep.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array(name[keep]), pa.array(frequent[keep]), pa.array(doc[keep]),
                 pa.array(place[keep]), pa.array(np.where(repeat, REPEAT, OPEN)[keep].astype(np.int8))],
                names=["name", "frequent", "doc_id", "place", "kind"])


def _windows(parts: Iterator[pa.RecordBatch], part_count: int) -> Iterator[pa.RecordBatch]:
    """The hashes of the windows at open positions, packed by name and, of frequent ones, part."""
    names = ["name", "part", "doc_id", "windows"]
    for part in parts:
        out: list[tuple] = []
        texts = part.column("text").cast(pa.binary())
        for doc_id, text, spots in zip(part.column("doc_id").to_pylist(), texts, part.column("spots")):
            text = text.as_py()
            for spot in spots.as_py():
                first, at, more = spot["place"] >> 16, spot["place"] >> 8 & 255, spot["place"] & 255
                if first + more + WINDOW > len(text):
                    continue
                own = np.frombuffer(text, np.uint8, more + WINDOW, first)
                start = np.arange(more + 1)
                rank = hashes(sums(own), start, start + WINDOW)
                packed = np.stack([rank.view(np.int64), first + start, at - start], axis=1)
                if not spot["frequent"]:
                    out.append((spot["name"], 0, doc_id, packed.tobytes()))
                    continue
                to = (mixed(rank + (at - start).astype(np.uint64)) % np.uint64(part_count)).astype(np.int64)
                for p in np.unique(to).tolist():
                    out.append((spot["name"], p, doc_id, packed[to == p].tobytes()))
        if out:
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)


def _rank_windows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All windows but the earliest of each rank, as runs of starts."""
    for table in by_group(parts, ("name", "part")):
        name, part, doc = (table[c].to_numpy() for c in ("name", "part", "doc_id"))
        group = np.cumsum(changes(name, part))
        packed = table["windows"].to_pylist()
        sizes = np.array([len(p) // 24 for p in packed])
        rank, start, at = np.frombuffer(b"".join(packed), np.int64).reshape(-1, 3).T
        group, doc = np.repeat(group, sizes), np.repeat(doc, sizes)
        order = np.lexsort((start, doc, rank, at, group))
        group, doc, rank, start, at = (c[order] for c in (group, doc, rank, start, at))
        head = np.flatnonzero(changes(group, at, rank))
        of = np.cumsum(changes(group, at, rank)) - 1
        repeat = (doc != doc[head[of]]) | (start != start[head[of]])
        doc, start = doc[repeat], start[repeat]
        if not len(doc):
            continue
        order = np.lexsort((start, doc))
        doc, start = doc[order], start[order]
        new = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (start[1:] > start[:-1] + 1)])
        last = np.r_[new[1:], len(doc)] - 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(doc[new]), pa.array(start[new]), pa.array(start[last])], names=["doc_id", "first", "last"])


def _cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for part in parts:
        texts = part.column("text").cast(pa.binary())
        n_bytes, spans, kept = [], [], []
        for text, marks in zip(texts, part.column("marks").to_pylist()):
            text, own, held, at = text.as_py(), [], [], 0
            for m in sorted((m["first"], m["last"] + WINDOW) for m in marks or ()):
                if own and m[0] <= own[-1][1]:
                    own[-1][1] = max(own[-1][1], min(m[1], len(text)))
                else:
                    own.append([m[0], min(m[1], len(text))])
            for a, b in own:
                held.append(text[at:a])
                at = b
            n_bytes.append(len(text))
            spans.append([{"start": a, "end": b} for a, b in own])
            kept.append(b"".join(held) + text[at:] if own else text)
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array(n_bytes, pa.int64()), pa.array(spans, span), pa.array(kept, pa.binary())],
            names=["doc_id", "n_bytes", "spans", "kept"])


def deduplicated(docs: DataFrame) -> DataFrame:
    """Every document without the bytes of 100-byte strings that start earlier too.

    Earlier is at a smaller doc_id, or in the same document at an earlier place; strings
    may overlap, lie in one document, and are judged on the input. Returns doc_id,
    n_bytes, spans (array of start, end: maximal removed runs) and kept, binary, as a cut
    can fall inside a character. A null or empty text, or one shorter than 100 bytes,
    loses nothing. Rows that repeat a doc_id with the same text are one document and
    returned each; with different texts, each loses what any of them loses. A row
    without doc_id takes no part; an empty table gives no rows.

    A task sends one row for a string however often it met it, and deals prefixes with
    many different strings out by string, so copies and common passages do not meet in
    one task. Windows of such prefixes are dealt by their rank to as many parts as the most
    frequent one asks for.
    """
    rows = id_texts(docs)
    sampled = rows.mapInArrow(_sample, "name long, salt int, run long, doc_id long, place long, kind byte")
    # Repeats found in a task need no more comparing: they go by document.
    dealt = sampled.repartition(width(rows), F.when(F.col("kind") == REPEAT, F.col("doc_id")).otherwise(F.col("name")), "salt")
    ranked = staged(dealt.sortWithinPartitions("name", "salt", "run", "doc_id", "place").mapInArrow(
        _split_known, "name long, frequent boolean, doc_id long, place long, kind byte"), "ranked")
    first = F.shiftright("place", 16)
    known = ranked.where(F.col("kind") == REPEAT).select(
        "doc_id", first.alias("first"), (first + F.col("place").bitwiseAND(255)).alias("last"))
    spots = (ranked.where(F.col("kind") == OPEN).groupBy("doc_id")
             .agg(F.collect_list(F.struct("name", "frequent", "place")).alias("spots")))
    texts = rows.repartition(width(rows), "doc_id")
    of_name = (ranked.where((F.col("kind") == OPEN) & F.col("frequent")).groupBy("name")
               .agg(F.sum(F.col("place").bitwiseAND(255) + 1).alias("windows")))
    most = of_name.agg(F.max("windows")).first()[0] or 0
    part_count = max(PARTS, -(-most // PART_WINDOWS))

    def windows_of(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _windows(parts, part_count)

    windows = texts.join(spots, "doc_id").mapInArrow(windows_of, "name long, part int, doc_id long, windows binary")
    found = (windows.repartition(width(rows), "name", "part").sortWithinPartitions("name", "part")
             .mapInArrow(_rank_windows, "doc_id long, first long, last long"))
    marks = (known.unionByName(found).groupBy("doc_id")
             .agg(F.collect_list(F.struct("first", "last")).alias("marks")))
    return texts.join(marks, "doc_id", "left").select("doc_id", "text", "marks").mapInArrow(
        _cut, "doc_id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary")


def _split_known(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pass on what is known to repeat, rank the rest."""

    def rest() -> Iterator[pa.RecordBatch]:
        for part in parts:
            known = part.column("kind").to_numpy() == REPEAT
            if known.any():
                own = part.filter(pa.array(known))
                passed.append(pa.RecordBatch.from_arrays(
                    [own.column("name"), pa.array(np.zeros(len(own), bool)), own.column("doc_id"), own.column("place"),
                     own.column("kind")], names=["name", "frequent", "doc_id", "place", "kind"]))
                part = part.filter(pa.array(~known))
            if len(part):
                yield part

    passed: list[pa.RecordBatch] = []
    for out in _rank(rest()):
        yield from passed
        passed.clear()
        yield out
    yield from passed
