"""Best-fit packing of token pieces into sequences of a fixed room."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from vulnloom.llm.common import as_row, batches, id_texts, staged
from vulnloom.llm.tokens import END, encoder, together

ROOM = 2048
OPEN_BINS = 1024
#: How many times its open bins a shard would fill, so that bins must close.
SHARD_FILL = 8

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut(docs: DataFrame, tokenizer_path: str, room: int = ROOM) -> DataFrame:
    """The pieces of every document: its ids and the end id 0, cut where longer than ``room``."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                            ("length", pa.int64()), ("ids_crc32", pa.int64())])
        own = encoder(tokenizer_path, False)

        def rows():
            for doc_ids, texts in together(parts):
                for doc_id, ids in zip(doc_ids, own.encode_all(texts)):
                    ids = memoryview(ids + END)
                    for piece, at in enumerate(range(0, len(ids), 4 * room)):
                        here = ids[at:at + 4 * room]
                        yield doc_id, piece, at // 4, len(here) // 4, zlib.crc32(here)

        yield from batches(rows(), schema)

    return id_texts(docs).mapInArrow(run, PIECE)


class OpenBins:
    """A fixed number of open bins, found by their free space.

    Bit f of ``mask`` is set while a bin with f free places is open; ``bins[f]`` lists
    them. The best fit of a piece is the lowest set bit at or above its length. Beyond
    ``limit`` open bins the fullest one closes.
    """

    def __init__(self, room: int, limit: int) -> None:
        self.room, self.limit = room, limit
        self.mask, self.n_open, self.n_bins, self.n_closed = 0, 0, 0, 0
        self.bins: list[list[int]] = [[] for _ in range(room + 1)]

    def _take(self, free: int) -> int:
        own = self.bins[free]
        number = own.pop()
        if not own:
            self.mask &= ~(1 << free)
        self.n_open -= 1
        return number

    def place(self, length: int) -> tuple[int, int]:
        """The bin a piece goes to and its place there."""
        fitting = self.mask >> length
        if fitting:
            free = (fitting & -fitting).bit_length() - 1 + length
            number = self._take(free)
        else:
            free, number = self.room, self.n_bins
            self.n_bins += 1
        left = free - length
        if left:
            self.bins[left].append(number)
            self.mask |= 1 << left
            self.n_open += 1
            if self.n_open > self.limit:
                self._take((self.mask & -self.mask).bit_length() - 1)
                self.n_closed += 1
        return number, self.room - free


def place(pieces: DataFrame, room: int = ROOM, open_bins: int = OPEN_BINS) -> DataFrame:
    """Give every piece its ``sequence_id`` and ``offset``.

    ``pieces`` has doc_id, piece and length, 1 to ``room``; its other columns stay, and it
    should be a written table, as it is read twice. Pieces are dealt by hash to shards
    that fill ``SHARD_FILL`` times the open bins. One task packs a shard online, each piece
    as it comes in the order of doc_id and piece, with state of ``open_bins`` numbers
    whatever its size. Numbers of sequences are unique, not dense. An empty table gives no
    rows; of bins of the same free space the one last put there is taken.
    """
    total = pieces.agg(F.sum("length")).first()[0] or 0
    shards = -(-total // (SHARD_FILL * open_bins * room)) or 1
    columns = pieces.columns
    shard_of = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(shards))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, bins = None, None
        for part in parts:
            numbers, offsets = [], []
            rows = part.column("row").flatten()
            for own, length in zip(part.column("shard").to_pylist(), rows[columns.index("length")].to_pylist()):
                if own != shard:
                    shard, bins = own, OpenBins(room, open_bins)
                number, offset = bins.place(length)
                numbers.append((own << 40) + number)
                offsets.append(offset)
            yield pa.RecordBatch.from_arrays(
                rows + [pa.array(numbers, pa.int64()), pa.array(offsets, pa.int64())],
                names=[*columns, "sequence_id", "offset"])

    # Given columns travel in a struct, so no name of theirs meets one of these.
    dealt = pieces.select(shard_of.alias("shard"), as_row(columns).alias("row"))
    return (dealt.repartition("shard")
            .sortWithinPartitions("shard", "row.doc_id", "row.piece", "row.length")
            .mapInArrow(run, StructType([*pieces.schema, StructField("sequence_id", LongType()), StructField("offset", LongType())])))


def pack(docs: DataFrame, tokenizer_path: str, room: int = ROOM, open_bins: int = OPEN_BINS) -> DataFrame:
    """Pack whole documents into sequences of at most ``room`` tokens.

    One row per piece. A null or empty text is the end id alone; a long text is cut into
    full pieces and a rest; rows that repeat a doc_id are packed each; a row without
    doc_id takes no part. Tokenizing is done once and its pieces are written.
    """
    return place(staged(cut(docs, tokenizer_path, room), "pieces"), room, open_bins)
