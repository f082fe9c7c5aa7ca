"""Token ids of whole texts by the tokenizers library, word by word.

Both tokenizers cut a text at white space and between letters and other characters
before they merge, so the ids of a text are the ids of its words one after another.
Words repeat; their ids are kept in a bounded memo of the worker process as
little-endian unsigned 32-bit bytes. How a text is cut follows from its characters:

* where white space has ids: before each space, around line ends, and also before commas
  and full stops where these follow letters only;
* where it is dropped: at white space, and also before commas and full stops where
  these follow letters or white space only and there is no apostrophe;
* holding U+001C to U+001F, which Python takes for white space and the tokenizers do
  not: nowhere.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from vulnloom.llm.common import Memo, in_slices, kept

ID = np.dtype("<u4")
END = (0).to_bytes(4, "little")
#: Words remembered where space is kept, and where space and case are dropped, which leaves fewer.
MEMO_WORDS = 400_000
MEMO_LOWERED = 200_000
#: Characters of text that are encoded together, words learnt in one call, words put together at once.
TOGETHER = 1 << 20
LEARNT = 1 << 13
SPAN = 1 << 18

_LETTER = "a-zA-Z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff"
_SEPARATOR = re.compile("[\x1c-\x1f]")
_MARK_NOT_AFTER_LETTER = re.compile(rf"[,.](?<=[^{_LETTER}][,.])")
_MARK_AFTER_OTHER = re.compile(rf"[,.](?<=[^\s{_LETTER}][,.])")
_CASED_ODDLY = re.compile("[\u03a3\u0130]")
_OTHER_SPACE = re.compile(r"[^\S \n]")
_DOUBLE_SPACE = ("  ", "\n\n", " \n", "\n ")
#: Stands before a part of a text that has no space before it.
_CLOSE = "\x1f"
_SPACED = re.compile(r" ?\S+|\s+(?!\S)|\s")
#: Letters, then marks: what the tokenizer that drops white space merges apart, each to an end.
_SIMPLE = re.compile(rf"([{_LETTER}]*)([!-&(-/:-@\[-^`{{-~]*)")


def _uneven(text: str) -> bool:
    """Whether white space stands in a row, or is other than spaces and line ends."""
    return any(pair in text for pair in _DOUBLE_SPACE) or bool(_OTHER_SPACE.search(text))


def _marked(text: str) -> str:
    """A text that is not uneven, to be cut at its spaces: line ends, what follows them and marks after
    letters are marked."""
    if not _MARK_NOT_AFTER_LETTER.search(text):
        text = text.replace(",", f" {_CLOSE},").replace(".", f" {_CLOSE}.")
    return _CLOSE + text.replace("\n", f" {_CLOSE}\n {_CLOSE}")


def _lowered(text: str) -> str:
    """A text whose space is dropped, in lower case and with marks apart where that changes no ids."""
    if "'" in text or _MARK_AFTER_OTHER.search(text) or _CASED_ODDLY.search(text):
        return text
    return text.lower().replace(",", " ,").replace(".", " .")


def numbered(even: list[str], separator: str, odd: list[list[str]]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct parts of texts, the number of each part in turn, and how many parts there are up to
    the end of each text. ``even`` texts are cut at the separator; of the others the parts are given."""
    cut = pc.split_pattern(pa.array(even, pa.large_string()), separator)
    own = [pa.array(parts, pa.large_string()) for parts in odd]
    parts = pa.concat_arrays([cut.flatten(), *own]).dictionary_encode()
    ends = np.cumsum(np.concatenate([np.diff(cut.offsets.to_numpy()), np.array(list(map(len, own)), np.int64)]))
    return parts.dictionary.to_numpy(zero_copy_only=False).tolist(), parts.indices.to_numpy(), ends


def put_together(number: np.ndarray, found: list[bytes]) -> tuple[bytes, np.ndarray]:
    """The ids of all parts one after another, and how many ids there are before each part and at the end."""
    size = np.array(list(map(len, found)), np.int64) // len(END)
    ids = np.frombuffer(b"".join(found), ID)
    first = np.cumsum(size) - size
    joined, n_ids = [], np.zeros(len(number) + 1, np.int64)
    for a in range(0, len(number), SPAN):
        here = number[a:a + SPAN]
        n = size[here]
        upto = np.cumsum(n)
        joined.append(ids[np.repeat(first[here] - upto + n, n) + np.arange(n.sum())].tobytes())
        n_ids[a + 1:a + 1 + len(here)] = n_ids[a] + upto
    return b"".join(joined), n_ids


def together(parts: Iterable[pa.RecordBatch], room: int = TOGETHER) -> Iterator[tuple[list[int], list[str]]]:
    """doc_id and text of rows in order, about ``room`` characters of text at a time or one longer text."""
    doc_ids, texts, size = [], [], 0
    for part in in_slices(parts):
        for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_numpy(zero_copy_only=False)):
            if texts and size + len(text) > room:
                yield doc_ids, texts
                doc_ids, texts, size = [], [], 0
            doc_ids.append(doc_id)
            texts.append(text)
            size += len(text)
    if texts:
        yield doc_ids, texts


def looked_up(memo: Memo, parts: list[str], learn: Callable | None = None) -> list:
    """What a memo has of distinct parts. ``learn``, if given, is handed those it lacks, some at a time."""
    before = memo.before.get
    found = list(map(memo.get, parts))
    missing = []
    for i in (i for i, value in enumerate(found) if value is None):
        value = before(parts[i])
        if value is None:
            missing.append(i)
        else:
            found[i] = memo[parts[i]] = value
    if learn is not None:
        for a in range(0, len(missing), LEARNT):
            learn([parts[i] for i in missing[a:a + LEARNT]])
    for i in missing:
        found[i] = memo[parts[i]]
    return found


class Encoder:
    """Text to id bytes. ``keeps_space``: white space has ids, a word takes one space before
    it and case counts; else white space and case are dropped."""

    def __init__(self, path: str, keeps_space: bool) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.keeps_space = keeps_space
        #: By id, whether its string starts with the sign for a space, and whether it ends with that for a word's end.
        vocab = self.tokenizer.get_vocab()
        self.spaced_id, self.ending_id = np.zeros((2, max(vocab.values()) + 1), bool)
        self.spaced_id[[i for word, i in vocab.items() if word[0] == "\u0120"]] = True
        self.ending_id[[i for word, i in vocab.items() if word.endswith("</w>")]] = True
        self.ids = Memo(self.spaced, MEMO_WORDS) if keeps_space else Memo(self.whole, MEMO_LOWERED)

    def whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return array("I", ids).tobytes()

    def spaced(self, word: str) -> bytes:
        return self.whole(word[1:] if word[:1] == _CLOSE else " " + word)

    def words(self, text: str) -> list[str]:
        """The parts of a text. Where space is kept, one goes without its space, or is marked."""
        if _SEPARATOR.search(text):
            return [_CLOSE + text if self.keeps_space else text]
        if self.keeps_space:
            if _uneven(text):
                return [_CLOSE + part for part in _SPACED.findall(text)]
            return _marked(text).split(" ")
        return _lowered(text).split()

    def encode(self, text: str) -> bytes:
        if self.keeps_space:
            return self.encode_all([text])[0]
        self.ids = own = self.ids.renewed()
        return b"".join(map(own.__getitem__, self.words(text)))

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The id bytes of each of some texts, every distinct word looked up once."""
        uneven = [bool(_SEPARATOR.search(text)) or self._uneven(text) for text in texts]
        order = sorted(range(len(texts)), key=uneven.__getitem__)
        n_even = len(texts) - sum(uneven)
        parts, number, ends = numbered([self._even(texts[i]) for i in order[:n_even]], " ", [self.words(texts[i]) for i in order[n_even:]])
        self.ids = self.ids.renewed()
        raw, n_ids = put_together(number, looked_up(self.ids, parts, self._learn))
        cuts = len(END) * n_ids[np.r_[0, ends]]
        out = [b""] * len(texts)
        for i, a, b in zip(order, cuts.tolist(), cuts[1:].tolist()):
            out[i] = raw[a:b]
        return out

    def _uneven(self, text: str) -> bool:
        return _uneven(text) if self.keeps_space else bool(_OTHER_SPACE.search(text))

    def _even(self, text: str) -> str:
        """A text that is not uneven, its parts between spaces; parts of nothing have no ids where space is dropped."""
        return _marked(text) if self.keeps_space else _lowered(text).replace("\n", " ")

    def _learn(self, parts: list[str]) -> None:
        """Encode new words in one call. Where space is kept, each goes after a space, and where ids start
        with one, a word starts; else the ids that end a word tell."""
        if self.keeps_space:
            new, runs = [p for p in parts if p and p[0] != _CLOSE and len(p) <= 48], []
            text, marks = " " + " ".join(new) if new else "", self.spaced_id
        else:
            simple = ((p, _SIMPLE.fullmatch(p)) for p in parts if p and len(p) <= 48)
            new, runs = [], []
            for p, own in simple:
                if own:
                    new.append(p)
                    runs.append(bool(own[1]) + bool(own[2]))
            text, marks = " ".join(new), self.ending_id
        [found] = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
        raw = array("I", found.ids).tobytes()
        at = np.flatnonzero(marks[np.frombuffer(raw, ID)])
        if not self.keeps_space:
            if len(at) != sum(runs):
                return
            at = np.r_[0, at[np.cumsum(runs, dtype=np.int64) - 1] + 1][:-1]
        if len(at) == len(new):
            at = (len(END) * at).tolist()
            self.ids.update(zip(new, (raw[a:b] for a, b in zip(at, [*at[1:], len(raw)]))))


def encoder(path: str, keeps_space: bool) -> Encoder:
    """The encoder of this process, kept from task to task."""
    return kept(("encoder", path, keeps_space), lambda: Encoder(path, keeps_space))
