"""SentencePiece n-best encoding and decoding over the piece lattice.

The lattice of a text has an edge for every piece of the vocabulary that stands in it;
the score of a segmentation is the sum of its piece scores. A character that no piece
covers is its UTF-8 bytes, at a score below that of any piece. Forward Viterbi scores
are the exact best score up to each place, so a backward A-star search that ranks
partial paths by (score of the tail + Viterbi score of its start) pops segmentations in
the order of their scores.

No piece has U+2581 after another character, so a lattice falls apart before each word.
Words repeat: their n-best lists are remembered, and the n best of a text are put
together from them.
"""

from __future__ import annotations

import heapq
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from vulnloom.llm.common import Memo, batches, id_texts, kept
from vulnloom.llm.tokens import END, looked_up, numbered, put_together, together

N_BEST = 4
MEMO_WORDS = 400_000
#: Characters of text that are encoded together; each has n best segmentations.
FEW = 1 << 22

_SPACE = "▁"
#: Cuts a text into its parts; one that holds it is no plain text.
_CUT = "\x1f"
_WORDS = re.compile(f"{_SPACE}*[^{_SPACE}]+|{_SPACE}+")
_LETTER = "a-zA-Z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff"
#: A comma or full stop after anything but a letter, two spaces, the mark itself, or the separator used to cut.
_NOT_PLAIN = re.compile(rf"[,.](?<=[^{_LETTER}][,.])| (?<=  )|[{_SPACE}\x1f]")
Path = tuple[float, tuple[int, ...]]


class Lattice:
    """Pieces and scores of a model file, and its n-best search."""

    def __init__(self, path: str) -> None:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.piece_of = [model.id_to_piece(i) for i in range(size)]
        self.byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.byte_of = {i: b for b, i in enumerate(self.byte_ids)}
        special = set(self.byte_ids)
        self.pieces: dict[str, tuple[int, float]] = {}
        for i, piece in enumerate(self.piece_of):
            if not (i in special or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.pieces[piece] = (i, model.get_score(i))
        #: Ends of pieces: a part of a text that is none of them ends no piece, nor does a longer one.
        self.tails = {p[i:] for p in self.pieces for i in range(len(p))}
        #: Of each of them its id and score; of what is no piece itself, nothing.
        self.hits = {tail: self.pieces.get(tail, ()) for tail in self.tails}
        self.unknown = min(s for _, s in self.pieces.values()) - 10
        pairs = {a + b for p in self.pieces for a, b in zip(p, p[1:])}
        #: Whether pieces never cross the place before a comma or full stop after a letter, nor a line end.
        self.marks_apart = not any(b in ",." and a.isalpha() or "\n" in (a, b) for a, b in pairs)
        self.bytes_of = [bytes([self.byte_of[i]]) if i in self.byte_of else p.encode() for i, p in enumerate(self.piece_of)]

    def edges(self, text: str) -> list[list[tuple[int, tuple[int, ...], float]]]:
        """For each end, (start, ids, score) of the edges that end there, shortest first."""
        find, tails = self.pieces.get, self.tails
        ends: list[list] = [[] for _ in range(len(text) + 1)]
        for end in range(1, len(text) + 1):
            own = ends[end]
            for start in range(end - 1, -1, -1):
                part = text[start:end]
                if part not in tails:
                    break
                hit = find(part)
                if hit is not None:
                    own.append((start, (hit[0],), hit[1]))
            if not own or own[0][0] != end - 1:
                own.append((end - 1, self._bytes(text[end - 1]), self.unknown))
        return ends

    def _bytes(self, char: str) -> tuple[int, ...]:
        return tuple(self.byte_ids[b] for b in char.encode())

    def two_best(self, text: str) -> tuple[tuple[int, ...], float, float]:
        """The ids and score of a best segmentation, and what the next best loses: Viterbi scores of
        the best and the second best way to each place."""
        look, unknown, nothing = self.hits.get, self.unknown, -np.inf
        first, second, back = [0.0], [nothing], [None]
        for end in range(1, len(text) + 1):
            best = next_best = nothing
            edge, start = None, end - 1
            hit = look(text[start:end])
            if not hit:
                best, next_best, edge = first[start] + unknown, second[start] + unknown, (start, None)
            while hit is not None:
                if hit:
                    piece, gain = hit
                    score = first[start] + gain
                    if score > best:
                        best, next_best, edge = score, best, (start, piece)
                    elif score > next_best:
                        next_best = score
                    score = second[start] + gain
                    if score > next_best:
                        next_best = score
                if not start:
                    break
                start -= 1
                hit = look(text[start:end])
            first.append(best)
            second.append(next_best)
            back.append(edge)
        ids: list[int] = []
        end = len(text)
        while end:
            start, piece = back[end]
            ids.extend((piece,) if piece is not None else reversed(self._bytes(text[start])))
            end = start
        return tuple(reversed(ids)), first[-1], first[-1] - second[-1]

    def n_best(self, text: str, n: int) -> list[Path]:
        """The n best segmentations of a text as (score, ids), best first."""
        ends = self.edges(text)
        ahead = [0.0] * (len(text) + 1)
        for end in range(1, len(text) + 1):
            ahead[end] = max([ahead[start] + score for start, _, score in ends[end]])
        found: list[Path] = []
        # Entries: (-(tail + ahead), number, start of the tail, tail score, tail as a chain).
        heap, number = [(-ahead[-1], 0, len(text), 0.0, None)], 0
        pops = [0] * (len(text) + 1)
        while heap and len(found) < n:
            _, _, at, tail, chain = heapq.heappop(heap)
            if not at:
                ids: list[int] = []
                while chain:
                    ids.extend(chain[0])
                    chain = chain[1]
                found.append((tail, tuple(ids)))
                continue
            pops[at] += 1
            if pops[at] > n:  # n better tails lead through here already
                continue
            for start, ids, score in ends[at]:
                number += 1
                own = tail + score
                heapq.heappush(heap, (-(own + ahead[start]), number, start, own, (ids, chain)))
        return found

    def decode(self, ids: Iterator[int]) -> str:
        """The text of ids: pieces, byte pieces as UTF-8, word marks as spaces, the first dropped."""
        raw = b"".join(map(self.bytes_of.__getitem__, ids))
        return raw.decode("utf-8", "replace").replace(_SPACE, " ").removeprefix(" ")


class Segmenter:
    """N-best segmentations of whole texts."""

    def __init__(self, path: str, n: int = N_BEST) -> None:
        self.lattice = Lattice(path)
        self.n, self.two_best = n, Memo(self._two_best, MEMO_WORDS)
        self.n_best = lru_cache(maxsize=20_000)(
            lambda word: [(score, array("I", ids).tobytes()) for score, ids in self.lattice.n_best(word, n)])

    def _two_best(self, word: str) -> tuple[bytes, float, float]:
        ids, score, loss = self.lattice.two_best(word)
        return array("I", ids).tobytes(), score, loss

    def _marked(self, text: str) -> str | None:
        """The parts of a plain text, with separators between them."""
        if not text or text[0] == " " or not self.lattice.marks_apart or _NOT_PLAIN.search(text):
            return None
        cut = text.replace(" ", f"{_CUT}{_SPACE}").replace("\n", f"{_CUT}\n{_CUT}")
        return _SPACE + cut.replace(",", f"{_CUT},").replace(".", f"{_CUT}.")

    def encode(self, text: str) -> list[tuple[float, bytes]]:
        """The n best segmentations as (score, ids as little-endian unsigned 32-bit bytes), best first.

        Of equal scores the one that departs from the best path later comes first.
        """
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[list[tuple[float, bytes]]]:
        """The n best segmentations of each of some texts, every distinct word looked up once."""
        marked = list(map(self._marked, texts))
        order = sorted(range(len(texts)), key=lambda i: marked[i] is None)
        n_plain = len(texts) - marked.count(None)
        odd = [_WORDS.findall(_SPACE + text.replace(" ", _SPACE)) if text else [] for text in (texts[i] for i in order[n_plain:])]
        words, number, ends = numbered([marked[i] for i in order[:n_plain]], _CUT, odd)
        self.two_best = self.two_best.renewed()
        found = looked_up(self.two_best, words)
        raw, n_ids = put_together(number, [ids for ids, _, _ in found])
        scores, losses = np.array([score for _, score, _ in found]), np.array([loss for _, _, loss in found])
        out: list[list[tuple[float, bytes]]] = [[]] * len(texts)
        for i, a, b in zip(order, [0, *ends.tolist()], ends.tolist()):
            own, at = number[a:b], len(END) * n_ids[a:b + 1]
            out[i] = self._varied(words, own, scores[own], losses[own], raw, at)
        return out

    def _varied(self, words: list[str], number: np.ndarray, scores: np.ndarray, losses: np.ndarray, raw: bytes,
                at: np.ndarray) -> list[tuple[float, bytes]]:
        """The n best of one text: its words by number, the score and loss of each, and where the ids of
        its best path lie in ``raw``."""
        if not len(number):
            return [(0.0, b"")]
        total = sum(scores.tolist())
        # The n best differ from the best in the n - 1 words of least loss only.
        odd = range(len(number))
        if len(number) >= self.n > 1:
            odd = sorted(np.argpartition(losses, self.n - 2)[:self.n - 1].tolist())
        # What lies between the odd words is taken once, and the odd words take their places.
        parts, place, done = [], {}, at[0]
        kept: list[tuple[float, tuple]] = [(0.0, ())]
        for word in odd:
            own = self.n_best(words[number[word]])
            parts.append(raw[done:at[word]])
            place[word], done = len(parts), at[word + 1]
            parts.append(own[0][1])
            grown = [(loss + own[0][0] - score, (*choice, (word, ids)) if i else choice)
                     for loss, choice in kept for i, (score, ids) in enumerate(own)]
            grown.sort(key=lambda x: x[0])
            kept = grown[:self.n]
        parts.append(raw[done:at[-1]])
        out = []
        for loss, choice in kept:
            own = parts.copy()
            for word, ids in choice:
                own[place[word]] = ids
            out.append((total - loss, b"".join(own)))
        return out


def segmenter(path: str, n: int) -> Segmenter:
    return kept(("segmenter", path, n), lambda: Segmenter(path, n))


def encode(docs: DataFrame, model_path: str, n: int = N_BEST) -> DataFrame:
    """doc_id and nbest, an array of (score, ids) of the ``n`` best segmentations, best first.

    Whole texts; a null or empty text has one segmentation of no ids and score 0. Rows
    that repeat a doc_id are encoded each; a row without doc_id takes no part; an empty
    table gives no rows.
    """

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = segmenter(model_path, n)
        schema = pa.schema([("doc_id", pa.int64()), ("nbest", pa.list_(pa.struct(
            [("score", pa.float64()), ("ids", pa.list_(pa.int32()))])))])

        def rows():
            for doc_ids, texts in together(parts, FEW):
                for doc_id, found in zip(doc_ids, own.encode_all(texts)):
                    yield doc_id, [{"score": s, "ids": np.frombuffer(ids, "<u4")} for s, ids in found]

        yield from batches(rows(), schema, 64)

    return id_texts(docs).mapInArrow(run, "doc_id long, nbest array<struct<score: double, ids: array<int>>>")


def decode(encoded: DataFrame, model_path: str, ids: str = "ids") -> DataFrame:
    """Every row of ``encoded`` with its ids turned to ``text``; null ids give a null text."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = segmenter(model_path, N_BEST).lattice
        for part in parts:
            texts = [None if own is None else lattice.decode(own) for own in part.column(ids).to_pylist()]
            rest = [c for c in part.schema.names if c != ids]
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in rest), pa.array(texts, pa.string())], names=[*rest, "text"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema if f.name != ids)
    return encoded.mapInArrow(run, f"{kinds}, text string")


def digest(docs: DataFrame, model_path: str, n: int = N_BEST) -> DataFrame:
    """What the n best segmentations of every document amount to, in one pass.

    doc_id, n_best (how many there are), n_pieces, score and ids_crc32 of the best,
    last_score, nbest_crc32 (all ids of all, best first), decoded_same (whether the best
    decodes to the text; U+2581 counts as a space). Edge cases as for ``encode``.
    """

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = segmenter(model_path, n)
        schema = pa.schema([("doc_id", pa.int64()), ("n_best", pa.int32()), ("n_pieces", pa.int64()), ("score", pa.float64()),
                            ("ids_crc32", pa.int64()), ("last_score", pa.float64()), ("nbest_crc32", pa.int64()),
                            ("decoded_same", pa.bool_())])

        def rows():
            decode = own.lattice.decode
            for doc_ids, texts in together(parts, FEW):
                for doc_id, text, found in zip(doc_ids, texts, own.encode_all(texts)):
                    crc = 0
                    for _, ids in found:
                        crc = zlib.crc32(ids, crc)
                    best = found[0]
                    same = decode(np.frombuffer(best[1], "<u4").tolist()) == text.replace(_SPACE, " ")
                    yield (doc_id, len(found), len(best[1]) // 4, best[0], zlib.crc32(best[1]), found[-1][0], crc, same)

        yield from batches(rows(), schema)

    return id_texts(docs).mapInArrow(
        run, "doc_id long, n_best int, n_pieces long, score double, ids_crc32 long, last_score double, "
             "nbest_crc32 long, decoded_same boolean")
