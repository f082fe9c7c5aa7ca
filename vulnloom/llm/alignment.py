"""Cross-tokenizer alignment: which tokens of a byte-level BPE and of a SentencePiece model
stand over the same bytes, and how often the corpus pairs them.

1. Documents shuffle by their full text, so each distinct text is read once, with the
   number of its documents.
2. A task tokenises and aligns texts in blocks of some megabytes. Texts fall apart at
   single spaces and line ends, where both tokenizers end a token and no piece crosses;
   every distinct word of a block is aligned once.
3. What a block sends on is each of its distinct id pairs once, with the number of
   documents that hold it; summed over blocks, these are the corpus's counts.
4. The counts of its pairs come back to each block, and each text's links are weighed.
5. The measures of a text join the doc_ids that have it.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from vulnloom.llm.common import Memo, id_texts, kept, staged, with_facts

#: Bytes of text that a block has, about: a longer text is a block of its own.
BLOCK = 1 << 22
MEMO_WORDS = 200_000
#: Words that are learnt in one call.
LEARNT = 1 << 13

#: Stands before a part that has no space before it.
_CLOSE = "\x1f"
#: Where a text is not cut: white space other than single spaces and line ends, or at its ends.
_IN_A_ROW = ("  ", "\n\n", " \n", "\n ")
_OTHER_SPACE = re.compile(r"[^\S \n]|[\x1c-\x1f]")
_SPACE_MARK = "▁"


def falls_apart(text: str) -> bool:
    """Whether a text can be cut at all its white space."""
    return bool(text) and not (text[0] in " \n" or text[-1] in " \n" or any(pair in text for pair in _IN_A_ROW)
                               or _OTHER_SPACE.search(text))


def byte_level() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for.

    Visible Latin-1 characters stand for themselves, the other bytes in order for U+0100 on.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Tokens:
    """The bytes of each id of a vocabulary."""

    def __init__(self, by_id: list[bytes]) -> None:
        self.by_id = by_id
        self.size = np.array(list(map(len, by_id)), np.int64)

    def joined(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.by_id.__getitem__, ids.tolist()))


def groups_of(end_a: np.ndarray, end_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of each A and each B token, given where tokens end in the same bytes.

    Groups are cut where tokens of both end. A token without bytes is of the group it ends.
    """
    ends = np.intersect1d(end_a, end_b)
    return np.searchsorted(ends, end_a), np.searchsorted(ends, end_b)


def linked(ids_a: np.ndarray, ids_b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(pair, group) of every link, pair as A id times 2^32 plus B id, in order of groups."""
    n_groups = int(group_a[-1]) + 1 if len(group_a) else 0
    n_b = np.bincount(group_b, minlength=n_groups)
    first_b = np.cumsum(n_b) - n_b
    times = n_b[group_a]
    upto = np.cumsum(times)
    b = np.arange(upto[-1] if len(upto) else 0) + np.repeat(first_b[group_a] - upto + times, times)
    return np.repeat(ids_a << 32, times) | ids_b[b], np.repeat(group_a, times)


def written_groups(ids_a: np.ndarray, ids_b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray) -> list[str]:
    """Each group as ``a1,a2|b1``."""
    a, b = list(map(str, ids_a.tolist())), list(map(str, ids_b.tolist()))
    if not a:
        return []
    cut_a = np.flatnonzero(np.diff(group_a, prepend=-1)).tolist()
    cut_b = np.flatnonzero(np.diff(group_b, prepend=-1)).tolist()
    return [f"{a[i]}|{b[k]}" if j - i == 1 == m - k else f"{','.join(a[i:j])}|{','.join(b[k:m])}"
            for i, j, k, m in zip(cut_a, [*cut_a[1:], len(a)], cut_b, [*cut_b[1:], len(b)])]


class Part(NamedTuple):
    """What a word or text aligns to; ``pairs`` has 8 bytes for each link."""

    n_a: int
    n_b: int
    n_groups: int
    written: str
    pairs: bytes


_NOTHING = Part(0, 0, 0, "", b"")


class Aligner:
    def __init__(self, byte_path: str, piece_path: str) -> None:
        self.a = Tokenizer.from_file(byte_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        byte_of = byte_level()
        entry = {i: word for word, i in self.a.get_vocab().items()}
        self.bytes_a = Tokens([bytes(byte_of.get(c, 0) for c in entry.get(i, "")) for i in range(max(entry) + 1)])
        self.bytes_b = Tokens([self._piece(i) for i in range(self.b.get_piece_size())])
        self.words = Memo(None, MEMO_WORDS)

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace(_SPACE_MARK, " ").encode()

    def ids(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """The ids of a space and ``text``, by A and by B, which sets the space itself."""
        a = self.a.encode(" " + text, add_special_tokens=False).ids
        return np.array(a, np.int64), np.array(self.b.encode(text), np.int64)

    def whole(self, text: str) -> Part | None:
        """A text that is not empty, as it stands; None where tokens do not give its bytes."""
        a, b = self.ids(text)
        raw = b" " + text.encode()
        if self.bytes_a.joined(a) != raw or self.bytes_b.joined(b) != raw:
            return None
        end_a, end_b = np.cumsum(self.bytes_a.size[a]), np.cumsum(self.bytes_b.size[b])
        group_a, group_b = groups_of(end_a, end_b)
        pairs, _ = linked(a, b, group_a, group_b)
        return Part(len(a), len(b), int(group_a[-1]) + 1, ";".join(written_groups(a, b, group_a, group_b)), pairs.tobytes())

    def _apart(self, raw: bytes, sizes: np.ndarray, a: np.ndarray, b: np.ndarray) -> list[Part] | None:
        """The words of a text in which both tokenizers end tokens after each; ``sizes``: bytes of each."""
        if self.bytes_a.joined(a) != raw or self.bytes_b.joined(b) != raw:
            return None
        end_a, end_b, ends = np.cumsum(self.bytes_a.size[a]), np.cumsum(self.bytes_b.size[b]), np.cumsum(sizes)
        group_a, group_b = groups_of(end_a, end_b)
        cut_a, cut_b = np.searchsorted(end_a, ends, "right"), np.searchsorted(end_b, ends, "right")
        if (end_a[cut_a - 1] != ends).any() or (end_b[cut_b - 1] != ends).any():
            return None
        pairs, group = linked(a, b, group_a, group_b)
        written = written_groups(a, b, group_a, group_b)
        cut_g = group_a[cut_a - 1] + 1
        cut_p = np.searchsorted(group, cut_g - 1, "right")
        out = []
        at = (0, 0, 0, 0)
        for now in zip(cut_a.tolist(), cut_b.tolist(), cut_g.tolist(), cut_p.tolist()):
            out.append(Part(*(n - m for n, m in zip(now[:3], at)), ";".join(written[at[2]:now[2]]), pairs[at[3]:now[3]].tobytes()))
            at = now
        return out

    def _learn(self, words: list[str]) -> list[Part | None]:
        """Words without white space, each after a space."""
        text = " ".join(words)
        parts = self._apart(b" " + text.encode(), np.array([len(w.encode()) + 1 for w in words]), *self.ids(text))
        return parts if parts is not None else [self.whole(w) for w in words]

    def _learn_closed(self, words: list[str]) -> list[Part | None]:
        """Line ends, and words that stand after one: read as lines after a word of one letter."""
        lines = [w for w in words if w != "\n"]
        text = "a\n" + "\n".join(lines)
        sizes = [2, *(n for w in lines for n in (1, len(w.encode())))] if lines else [2, 1]
        parts = self._apart(f" {text}".encode(), np.array(sizes), *self.ids(text))
        if parts is not None:
            found = iter(parts[2::2])
            return [parts[1] if w == "\n" else next(found) for w in words]
        return [None] if len(words) == 1 else [part for w in words for part in self._learn_closed([w])]

    def found(self, words: list[str]) -> list[Part | None]:
        """What distinct words align to; one is a word after a space, or marked as without."""
        self.words = own = self.words.renewed()
        found: list = [None] * len(words)
        missing = []
        for i, word in enumerate(words):
            if word in own:
                found[i] = own[word]
            elif word in own.before:
                found[i] = own[word] = own.before[word]
            else:
                missing.append(i)
        closed = [words[i][:1] == _CLOSE for i in missing]
        for learn, own_kind in ((self._learn, False), (self._learn_closed, True)):
            these = [i for i, c in zip(missing, closed) if c == own_kind]
            for a in range(0, len(these), LEARNT):
                some = these[a:a + LEARNT]
                for i, part in zip(some, learn([words[i].removeprefix(_CLOSE) for i in some])):
                    found[i] = part
                    if len(words[i]) <= 48:
                        own[words[i]] = part
        return found


def aligner(byte_path: str, piece_path: str) -> Aligner:
    """The aligner of this process, kept from task to task."""
    return kept(("aligner", byte_path, piece_path), lambda: Aligner(byte_path, piece_path))


def _spans(lengths: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """The places of the chosen runs, one after another, in what holds all runs of these lengths."""
    n = lengths[chosen]
    upto = np.cumsum(n)
    first = np.cumsum(lengths) - lengths
    return np.arange(upto[-1] if len(upto) else 0) + np.repeat(first[chosen] - upto + n, n)


class Block:
    """Some texts aligned: per text its measures and its distinct pairs with their links."""

    def __init__(self, own: Aligner, texts: list[str]) -> None:
        cut = list(map(falls_apart, texts))
        marked = [text.replace("\n", f" {_CLOSE}\n {_CLOSE}") for text, c in zip(texts, cut) if c]
        split = pc.split_pattern(pa.array(marked, pa.large_string()), " ")
        words = split.flatten().dictionary_encode()
        parts = own.found(words.dictionary.to_pylist())
        # A text with a word that cannot be aligned is read as it stands, like those not cut.
        number = words.indices.to_numpy().astype(np.int64)
        bad = np.array([p is None for p in parts], bool)
        sizes = np.diff(split.offsets.to_numpy())
        starts = np.cumsum(sizes) - sizes
        at_text = np.flatnonzero(cut)
        runs: list[np.ndarray] = [np.zeros(0, np.int64)] * len(texts)
        if len(at_text):
            spoilt = np.add.reduceat(bad[number], starts) > 0
            for i, a, n, no in zip(at_text.tolist(), starts.tolist(), sizes.tolist(), spoilt.tolist()):
                if not no:
                    runs[i] = number[a:a + n]
        for i, text in enumerate(texts):
            if text and not len(runs[i]):
                part = own.whole(text)
                if part is not None:
                    parts.append(part)
                    runs[i] = np.array([len(parts) - 1])
        parts = [p or _NOTHING for p in parts]
        self.n_texts = len(texts)
        number = np.concatenate(runs) if runs else np.zeros(0, np.int64)
        text_of = np.repeat(np.arange(len(texts)), list(map(len, runs)))
        n_pairs = np.array([len(p.pairs) // 8 for p in parts], np.int64)
        self.measures = np.zeros((4, len(texts)), np.int64)
        for row, of_part in enumerate([*(np.array([p[m] for p in parts], np.int64) for m in range(3)), n_pairs]):
            self.measures[row] = np.bincount(text_of, of_part[number], len(texts)) if len(number) else 0
        written = [p.written for p in parts]
        self.names = [hashlib.sha256(";".join(map(written.__getitem__, run.tolist())).encode()).hexdigest() if len(run) else ""
                      for run in runs]
        # Pairs are numbered within the block; a word that a text repeats is looked at once.
        all_pairs = np.frombuffer(b"".join(p.pairs for p in parts), np.int64)
        self.pairs, pair_no = np.unique(all_pairs, return_inverse=True)
        seen, times = np.unique(text_of * len(parts) + number, return_counts=True)
        part = seen % max(len(parts), 1)
        key = np.repeat(seen // max(len(parts), 1), n_pairs[part]) * max(len(self.pairs), 1) + pair_no[_spans(n_pairs, part)]
        held, place = np.unique(key, return_inverse=True)
        self.links = np.bincount(place, np.repeat(times, n_pairs[part]), len(held)).astype(np.int64)
        self.text, self.pair = held // max(len(self.pairs), 1), held % max(len(self.pairs), 1)


def _packed(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values).tobytes())


def _unpacked(raw: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), kind)


_ALIGNED = ("block long, names array<binary>, copies array<long>, measures array<long>, groups array<string>, held array<long>, "
            "pair binary, links binary, pairs array<struct<pair: long, copies: long>>")
_MEASURES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


def _texts_together(parts: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[list[bytes], list[str], list[int]]]:
    held: tuple[list, list, list] = ([], [], [])
    room = size
    for part in parts:
        for name, text, copies in zip(*(part.column(c).to_pylist() for c in ("name", "text", "copies"))):
            if held[0] and len(text) > room:
                yield held
                held, room = ([], [], []), size
            for column, value in zip(held, (name, text, copies)):
                column.append(value)
            room -= len(text)
    if held[0]:
        yield held


def _aligned(own: Aligner, parts: Iterator[pa.RecordBatch], size: int, first: int) -> Iterator[pa.RecordBatch]:
    """Texts to blocks, one row each."""
    pair_type = pa.list_(pa.struct([("pair", pa.int64()), ("copies", pa.int64())]))
    for number, (names, texts, copies) in enumerate(_texts_together(parts, size)):
        block = Block(own, texts)
        documents = np.bincount(block.pair, np.array(copies, np.int64)[block.text], len(block.pairs)).astype(np.int64)
        pairs = pa.StructArray.from_arrays([pa.array(block.pairs), pa.array(documents)], ["pair", "copies"])
        yield pa.RecordBatch.from_arrays([
            pa.array([first + number], pa.int64()), pa.array([names], pa.list_(pa.binary())), pa.array([copies], pa.list_(pa.int64())),
            pa.array([block.measures.ravel()], pa.list_(pa.int64())), pa.array([block.names], pa.list_(pa.string())),
            pa.array([np.bincount(block.text, minlength=len(texts))], pa.list_(pa.int64())),
            # Pairs of a text come in order: the steps between them are small numbers.
            pa.array([_packed(np.diff(block.pair, prepend=0).astype("<i4"))], pa.binary()),
            pa.array([_packed(block.links.astype("<u4"))], pa.binary()),
            pa.ListArray.from_arrays(pa.array([0, len(pairs)], pa.int32()), pairs).cast(pair_type),
        ], names=["block", "names", "copies", "measures", "groups", "held", "pair", "links", "pairs"])


def _weighed(blocks: pa.Table, counts: pa.Table) -> pa.Table:
    """The measures of a block's texts, given the counts of its pairs."""
    out = []
    order = np.argsort(counts["pair"].to_numpy())
    count, best = counts["count"].to_numpy()[order], counts["best"].to_numpy()[order]
    for row in blocks.to_pylist():
        held = np.array(row["held"], np.int64)
        measures = np.array(row["measures"], np.int64).reshape(4, -1)
        pair = np.cumsum(_unpacked(row["pair"], "<i4"), dtype=np.int64)
        links = _unpacked(row["links"], "<u4").astype(np.int64)
        text = np.repeat(np.arange(len(held)), held)
        whole = [np.zeros(len(held), np.int64), np.zeros(len(held), np.int64)]
        np.add.at(whole[0], text, links * best[pair])
        np.add.at(whole[1], text, links * count[pair])
        out.append(pa.table([pa.array(row["names"], pa.binary()), pa.array(row["copies"], pa.int64()),
                             *map(pa.array, [*measures, *whole]), pa.array(row["groups"], pa.string())],
                            names=["name", "copies", *_MEASURES, "groups_sha256"]))
    return pa.concat_tables(out)


def align(docs: DataFrame, byte_path: str, piece_path: str, block: int = BLOCK) -> DataFrame:
    """How the two tokenizers of ``byte_path`` (A) and ``piece_path`` (B) align on each document.

    Returns doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256. A
    reads a space and the text, B the text. Where tokens of both end, their bytes are cut
    into groups; links are all pairs of an A and a B token of one group; the count of a
    pair of ids is the number of documents in which they are linked; n_best counts the
    links whose pair has the highest count of its A id, ties included; count_sum adds the
    counts of all links.

    Texts that are null, empty, or whose bytes the tokens of A or B do not give back have
    no tokens: zeros and ''. Strings of special tokens are plain text. Rows that repeat a
    doc_id are documents each; a row without doc_id takes no part; an empty table gives no
    rows. Other columns are not read.
    """
    name = F.unhex(F.sha2("text", 256)).alias("name")
    own = id_texts(docs)
    texts = own.groupBy("text").agg(F.count("*").alias("copies")).select(name, "text", "copies")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _aligned(aligner(byte_path, piece_path), parts, block, TaskContext.get().partitionId() << 32)

    # Blocks are numbered by task; the table is written, so a number stays with its texts.
    aligned = staged(texts.mapInArrow(run, _ALIGNED), "aligned")
    pairs = aligned.select(F.col("block").alias("home"), F.explode("pairs").alias("p")).select("home", "p.pair", "p.copies")
    counts = pairs.groupBy("pair").agg(F.sum("copies").alias("count"))
    highest = F.max("count").over(Window.partitionBy(F.shiftright("pair", 32)))
    weights = staged(counts.withColumn("best", (F.col("count") == highest).cast("int")), "counts")
    replies = pairs.select("home", "pair").join(weights, "pair")
    kinds = "name binary, copies long, " + ", ".join(f"{m} long" for m in _MEASURES) + ", groups_sha256 string"
    measured = staged(aligned.drop("pairs").groupBy("block")
                      .cogroup(replies.groupBy("home")).applyInArrow(_weighed, kinds), "measured")
    n_rows = measured.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    return with_facts(own.select("doc_id", name), measured, "name", n_rows).drop("name")
