"""Line dedup: lines that several documents hold stay in the first of them only.

1. Scan. A line's key is its text without white space at its ends, A-Z as a-z; a key is
   known by its SHA-256. Of the keys that a task meets in several documents of some
   megabytes, one row goes on to the filters, so a key that is everywhere is few rows.
2. Filters. Keys are dealt by hash to shards of a bounded number of rows. A shard has two
   Bloom filters, of keys seen once and of keys seen twice; what the second one holds is
   suspected. A filter grows with nothing: more lines are more shards, and none is sent
   to all tasks.
3. Confirmation. Only suspected keys shuffle again, and those of two documents or more are
   repeats, which the smallest doc_id keeps.
4. Each document meets the repeats it must drop.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vulnloom.llm.common import id_text_rows, id_texts, staged, width, with_facts

# --- Fixed values ---------------------------------------------------------------
SPACE = b" \t\n\x0b\x0c\r"
# ----------------------------------------------------------------------------------

MIN_POINTS = 10
MIN_DOCUMENTS = 2
#: Rows of a shard, about, bits of a filter for each, and bits that a key sets.
SHARD_ROWS = 1 << 21
BITS_PER_ROW = 16
HASHES = 4
#: Bytes of text that a task looks through before it sends on; rows tested at a time.
CHUNK = 1 << 24
SLICE = 1 << 16

_DIGEST = 32
_ONCE, _AGAIN, _MORE = 0, 1, 2


def key_of(line: bytes) -> bytes:
    return line.strip(SPACE).lower()  # of bytes, only A-Z have lower case


def counts(key: bytes, min_points: int = MIN_POINTS) -> bool:
    """Whether a key has enough code points."""
    return len(key) >= 4 * min_points or len(key) >= min_points and len(key.decode()) >= min_points


def name_of(key: bytes) -> bytes:
    return hashlib.sha256(key).digest()


class Bloom:
    """A Bloom filter of hashes that come as rows of 64-bit words."""

    def __init__(self, n_bits: int) -> None:
        size = 1 << max(n_bits - 1, 63).bit_length()
        self.mask, self.bits = np.uint64(size - 1), np.zeros(size // 8, np.uint8)

    def _places(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = words[:, :HASHES] & self.mask
        return (at >> np.uint64(3)).astype(np.int64), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8)

    def add(self, words: np.ndarray) -> None:
        byte, bit = self._places(words)
        np.bitwise_or.at(self.bits, byte.ravel(), bit.ravel())

    def holds(self, words: np.ndarray) -> np.ndarray:
        byte, bit = self._places(words)
        return ((self.bits[byte] & bit) != 0).all(axis=1)


def suspected(words: np.ndarray, again: np.ndarray, bits_per_row: int = BITS_PER_ROW) -> np.ndarray:
    """Which rows have a key that came twice, or seems to have; ``again``: known to have."""
    once, twice = Bloom(bits_per_row * len(words)), Bloom(bits_per_row * len(words))
    for a in range(0, len(words), SLICE):
        part = words[a:a + SLICE]
        _, first, number = np.unique(part[:, 0], return_index=True, return_inverse=True)
        within = first[number] != np.arange(len(part))
        twice.add(part[within | again[a:a + SLICE] | once.holds(part)])
        once.add(part)
    return np.concatenate([twice.holds(words[a:a + SLICE]) for a in range(0, len(words), SLICE)])


def _rows(names: bytes, doc: np.ndarray, kind: np.ndarray) -> pa.RecordBatch:
    offsets = np.arange(len(doc) + 1, dtype=np.int32) * _DIGEST
    name = pa.Array.from_buffers(pa.binary(), len(doc), [None, pa.py_buffer(offsets), pa.py_buffer(names)])
    return pa.RecordBatch.from_arrays([name, pa.array(doc), pa.array(kind)], names=["name", "doc_id", "kind"])


def _line_rows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """name, doc_id and kind of the keys of each document: the first of a key in a chunk of
    texts goes through the filters, known to have come again or not; the others are more of it."""
    names: list[bytes] = []
    docs: list[int] = []
    size = 0

    def compared() -> pa.RecordBatch:
        words = np.frombuffer(b"".join(names), "<u8").reshape(-1, _DIGEST // 8)
        doc = np.array(docs, np.int64)
        order = np.lexsort((doc, words[:, 0]))
        words, doc = words[order], doc[order]
        head = np.diff(words[:, 0], prepend=~words[:1, 0]) != 0
        last = np.r_[np.flatnonzero(head)[1:], len(doc)] - 1
        several = doc[head] != doc[last]
        kind = np.where(head, _ONCE, _MORE).astype(np.int8)
        kind[head] = np.where(several, _AGAIN, _ONCE)
        return _rows(words.tobytes(), doc, kind)

    for doc_id, text in id_text_rows(parts):
        own = {key for key in map(key_of, text.split(b"\n")) if counts(key)}
        names.extend(map(name_of, own))
        docs.extend([doc_id] * len(own))
        size += len(text)
        if size >= CHUNK and docs:
            yield compared()
            names, docs, size = [], [], 0
    if docs:
        yield compared()


def _words(names: pa.BinaryArray) -> np.ndarray:
    return np.frombuffer(b"".join(names.to_pylist()), "<u8").reshape(-1, _DIGEST // 8)


def _filtered(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a shard that are suspected repeats."""
    held = [(_words(part.column("name")), part.column("doc_id").to_numpy(), part.column("kind").to_numpy()) for part in parts if len(part)]
    if not held:
        return
    words, doc, kind = (np.concatenate(c) for c in zip(*held))
    found = np.flatnonzero(suspected(words, kind == _AGAIN))
    for a in range(0, len(found), SLICE):
        at = found[a:a + SLICE]
        yield _rows(words[at].tobytes(), doc[at], kind[at])


def repeats(docs: DataFrame) -> DataFrame:
    """name (SHA-256 of a key) and doc_id of every line that an earlier document holds."""
    kind = "name binary, doc_id long, kind byte"
    lines = staged(id_texts(docs).mapInArrow(_line_rows, kind), "lines")
    heads = lines.where(F.col("kind") != _MORE)
    shards = max(width(docs), -(-heads.count() // SHARD_ROWS))
    suspects = staged(heads.repartition(shards, "name").mapInArrow(_filtered, kind)
                      .unionByName(lines.where(F.col("kind") == _MORE)).select("name", "doc_id"), "suspects")
    held = suspects.groupBy("name").agg(
        F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"), F.count("*").alias("copies"))
    confirmed = staged(held.where("first_id < last_id").drop("last_id"), "repeats")
    return with_facts(suspects, confirmed, "name", suspects.count()).where("doc_id > first_id").select("name", "doc_id")


def _kept(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        n_lines, n_dropped, kept = [], [], []
        for text, drops in zip(part.column("text"), part.column("drops")):
            text = text.as_py()
            lines = text.split("\n")
            n_lines.append(len(lines))
            if drops.is_valid:
                gone = set(drops.as_py())
                stays = [line for line, key in ((line, key_of(line.encode())) for line in lines)
                         if not counts(key) or name_of(key) not in gone]
                n_dropped.append(len(lines) - len(stays))
                kept.append("\n".join(stays))
            else:
                n_dropped.append(0)
                kept.append(text)
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(kept, pa.string())],
            names=["doc_id", "n_lines", "n_dropped", "kept"])


def deduplicated(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped and kept, the text without the lines of earlier documents.

    A text is cut at \\n. Keys of 10 code points or more that two documents hold or more
    lose all their lines but those in the smallest doc_id that holds them; a key that one
    document repeats stays there. A null or empty text is one empty line, which stays; a
    text that loses every line is empty. Rows that repeat a doc_id are returned each and
    never lose to each other; a row without doc_id takes no part; an empty table gives no
    rows. Other columns are not read.
    """
    drops = repeats(docs).groupBy("doc_id").agg(F.collect_list("name").alias("drops"))
    return id_texts(docs).join(drops, "doc_id", "left").select("doc_id", "text", "drops").mapInArrow(
        _kept, "doc_id long, n_lines long, n_dropped long, kept string")
