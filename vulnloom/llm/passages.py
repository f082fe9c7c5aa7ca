"""Substring dedup: fuzzy passages by collinear chaining of shared word k-mers.

1. Seeds. Hashes of k words in a row, sampled so that each stretch of ``SPREAD`` of them
   has its least one. A seed that starts in several documents links each of them to the
   earliest of all, and to the earliest and the one before it of what its task has read:
   first within a task, then between tasks, so a seed that is everywhere is one row per
   task there. What a document has of a seed after the first time counts once more, as a
   seed of its own by its number.
   Links travel packed, one row for each pair of documents.
2. Chains. The links of a pair of documents are chained: ordered in both texts, worth a
   seed each less a cost for the gaps, the best predecessor found by Fenwick trees.
3. Alignment. The words of a chain are aligned in both texts: equal words on a diagonal,
   a table of edits where a gap has two lengths, and outward while words agree. Every
   part of a chain with enough words and similarity is a passage.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vulnloom.llm.common import as_row, batches, by_group, id_text_rows, id_texts, in_slices, staged, width
from vulnloom.llm.repeats import changes
from vulnloom.llm.shared_runs import hashes, mixed, sums

K = 5
SPREAD = 10
MIN_WORDS = 50
SIMILARITY = 0.8
#: Cost of a word of gap in either text, in words matched; gaps beyond LARGEST end a chain.
GAP_COST = 0.05
LARGEST = 40
#: Words beyond its ends that a chain may grow.
MARGIN = 64
#: Bytes of text that a task compares before it sends on.
CHUNK = 1 << 25

_SPACES = np.zeros(256, bool)
_SPACES[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ORDER = np.uint64(0xD6E8FEB86659FD93)


def word_places(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the words between ASCII white space start and end, in bytes."""
    space = _SPACES[np.frombuffer(text, np.uint8)]
    edge = np.flatnonzero(np.diff(np.r_[True, space, True].astype(np.int8)))
    return edge[::2], edge[1::2]


def word_hashes(text: bytes, start: np.ndarray, end: np.ndarray, span: int = 1 << 17) -> np.ndarray:
    """64-bit hashes of the words, A-Z as a-z. Hashed by spans, a longer word by its bytes in spans."""
    out = np.zeros(len(start), np.uint64)
    blob = _LOWER[np.frombuffer(text, np.uint8)]
    at = 0
    while at < len(start):
        base = int(start[at])
        upto = max(int(np.searchsorted(end, base + span, side="right")), at + 1)
        part = blob[base:int(end[upto - 1])]
        if len(part) <= span:
            out[at:upto] = hashes(sums(part), start[at:upto] - base, end[at:upto] - base)
        else:
            value = np.uint64(0)
            for a in range(0, len(part), span):
                piece = part[a:a + span]
                value = mixed(np.array([value]) * _ORDER + hashes(sums(piece), np.array([0]), np.array([len(piece)])))[0]
            out[at] = value
        at = upto
    return out


def words_of(text: bytes) -> np.ndarray:
    return word_hashes(text, *word_places(text))


def seeds(words: np.ndarray, k: int = K, spread: int = SPREAD) -> tuple[np.ndarray, np.ndarray]:
    """Sampled seeds of a text and the words they start at."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    seed = words[:n].copy()
    for i in range(1, k):
        seed = mixed(seed * _ORDER + words[i:i + n])
    if n <= spread:
        at = np.array([int(seed.argmin())])
    else:
        at = np.unique(np.lib.stride_tricks.sliding_window_view(seed, spread).argmin(axis=1) + np.arange(n - spread + 1))
    return seed[at], at


def repeated(seed: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Seeds that a text has already had, each under a number that tells which time it is.

    A seed links to one place of another text. In text that repeats itself, like one word
    many times, it is these that go up in both texts and can be chained.
    """
    order = np.lexsort((at, seed))
    seed, at = seed[order], at[order]
    head = changes(seed)
    time = np.arange(len(seed)) - np.flatnonzero(head)[np.cumsum(head) - 1]
    return mixed(seed * _ORDER + time.astype(np.uint64))[~head], at[~head]


_SEED = pa.schema([("seed", pa.int64()), ("doc_id", pa.int64()), ("at", pa.int64()), ("to", pa.int64()), ("seeds", pa.binary()), ("places", pa.binary())])
_LINKS = "doc_id long, to long, earliest boolean, seeds binary, places binary"
_LOW = (1 << 32) - 1


def _linked(seed: np.ndarray, doc: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of rows sorted by seed, document and place: which link, to which rows, whether these are their
    seed's first; each links to its seed's first in the earliest document and in the document
    before its own. Then which rows stay: the first of a seed, and what its document has of it
    ``LARGEST`` words on."""
    head = changes(seed)
    first = np.flatnonzero(head)[np.cumsum(head) - 1]
    own = changes(seed, doc)
    at_own = np.flatnonzero(own)
    own_number = np.cumsum(own) - 1
    before = at_own[np.maximum(own_number - 1, 0)]
    other = doc != doc[first]
    near = other & (doc[before] != doc[first])
    far = ~other & (np.diff(at, prepend=at[:1]) > LARGEST)
    row = np.concatenate([np.flatnonzero(other), np.flatnonzero(near)])
    to = np.concatenate([first[other], before[near]])
    return row, to, np.arange(len(row)) < int(other.sum()), np.flatnonzero(head | far)


def _binary(values: np.ndarray, cuts: np.ndarray) -> pa.BinaryArray:
    """64-bit values as one binary per run, runs starting at ``cuts``."""
    offsets = (np.r_[cuts, len(values)] * 8).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(cuts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def _values(rows: pa.ChunkedArray | pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """The values of all binaries, one after another, and the row of each."""
    raw = rows.to_pylist()
    return np.frombuffer(b"".join(raw), kind), np.repeat(np.arange(len(raw)), [len(r) // 8 for r in raw])


def _by_pair(doc: np.ndarray, to: np.ndarray, earliest: np.ndarray, seed: np.ndarray, at: np.ndarray, to_at: np.ndarray) -> list[pa.Array]:
    """Links as one row for each pair of documents: doc_id, to, earliest, seeds and places, a place of
    either text in one number."""
    order = np.lexsort((earliest, to, doc))
    doc, to, earliest = doc[order], to[order], earliest[order]
    cuts = np.flatnonzero(changes(doc, to, earliest))
    places = (at << 32 | to_at)[order]
    return [pa.array(doc[cuts]), pa.array(to[cuts]), pa.array(earliest[cuts]), _binary(seed[order], cuts), _binary(places, cuts)]


def _seed_rows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What stays of the seeds of a task's texts, one row each with ``to`` null, and their links, one
    row for each pair of documents."""
    held, size = [], 0

    def compared() -> Iterator[pa.RecordBatch]:
        seed, doc, at = (np.concatenate(c) for c in zip(*held))
        order = np.lexsort((at, doc, seed))
        seed, doc, at = seed[order], doc[order], at[order]
        row, to, first, stay = _linked(seed, doc, at)
        null = [pa.nulls(len(stay), kind) for kind in (pa.int64(), pa.binary(), pa.binary())]
        yield pa.RecordBatch.from_arrays([pa.array(seed[stay].view(np.int64)), pa.array(doc[stay]), pa.array(at[stay]), *null], schema=_SEED)
        own, other, _, seeds, places = _by_pair(doc[row], doc[to], first, seed[row], at[row], at[to])
        none = pa.nulls(len(own), pa.int64())
        yield pa.RecordBatch.from_arrays([none, own, none, other, seeds, places], schema=_SEED)

    for doc_id, text in id_text_rows(parts):
        own = seeds(words_of(text))
        seed, at = (np.concatenate(c) for c in zip(own, repeated(*own)))
        held.append((seed, np.full(len(seed), doc_id, np.int64), at))
        size += len(text)
        if size >= CHUNK:
            yield from compared()
            held, size = [], 0
    if held:
        yield from compared()


def _global_links(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between tasks, a row for each pair of documents of those met at once, and whether they
    are to their seeds' earliest document."""
    for table in by_group(parts, ("seed",)):
        seed, doc, at = (table[c].to_numpy() for c in ("seed", "doc_id", "at"))
        row, to, first, _ = _linked(seed, doc, at)
        if len(row):
            columns = _by_pair(doc[row], doc[to], first, seed[row], at[row], at[to])
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "to", "earliest", "seeds", "places"])


def _beyond(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of tasks to a task's first of a seed, as links to the earliest of all.

    Rows of one ``via`` come together: what it links to its seeds' earliest documents
    (``asks`` false, ``other`` the earlier document), and what of its task links to it.
    """
    for table in by_group(parts, ("via",)):
        via, other, asks = (table[c].to_numpy(zero_copy_only=False) for c in ("via", "other", "asks"))
        seed, row = _values(table["seeds"], np.uint64)
        place, _ = _values(table["places"], np.int64)
        asked = asks[row]
        # Where via has the seed: the later text's place in its own links, the earlier one's in links to it.
        at_via = np.where(asked, place & _LOW, place >> 32)
        key = mixed(seed * _ORDER + mixed(via[row].astype(np.uint64) * _ORDER + at_via.astype(np.uint64)))
        told = np.flatnonzero(~asked)
        told = told[np.lexsort((other[row[told]], key[told]))]
        ask = np.flatnonzero(asked)
        if not len(told) or not len(ask):
            continue
        found = told[np.minimum(np.searchsorted(key[told], key[ask]), len(told) - 1)]
        good = (key[found] == key[ask]) & (seed[found] == seed[ask]) & (other[row[found]] != other[row[ask]])
        ask, found = ask[good], found[good]
        if len(ask):
            columns = _by_pair(other[row[ask]], other[row[found]], np.ones(len(ask), bool), seed[ask], place[ask] >> 32, place[found] & _LOW)
            yield pa.RecordBatch.from_arrays([columns[0], columns[1], columns[4]], names=["doc_id", "to", "places"])


class _Stretch:
    """The best chain ends by their place in a stretch of the earlier text: a Fenwick tree of maxima."""

    def __init__(self, size: int) -> None:
        self.size, self.tree = size, [(-np.inf, -1)] * (size + 1)

    def add(self, place: int, end: tuple[float, int]) -> None:
        place += 1
        while place <= self.size:
            if end > self.tree[place]:
                self.tree[place] = end
            place += place & -place

    def before(self, place: int) -> tuple[float, int]:
        """The best end at a place less than this one."""
        best = (-np.inf, -1)
        while place:
            if self.tree[place] > best:
                best = self.tree[place]
            place &= place - 1
        return best


def chains(at: np.ndarray, to: np.ndarray, k: int = K, gap_cost: float = GAP_COST, largest: int = LARGEST) -> list[list[int]]:
    """The chains of links at[i] -> to[i], as lists of link numbers, each link in one at most.

    Links come sorted by ``at``, then ``to``. A chain goes up in both texts. It is worth k
    words a link, less ``gap_cost`` for each word between links in either text. Chain ends
    are held in Fenwick trees by their place in ``to``, a tree for each stretch that a link
    can reach in either text, so ends expire with their stretch. Scores are kept with the
    cost of all words before them added, so ends compare alike from anywhere, and the best
    before a link is a prefix maximum of a tree. Where that one is of the last stretch but
    out of reach, the link looks at the ends within reach, so it never hides a nearer one.
    """
    n, reach = len(at), largest + k
    at, to = at.tolist(), to.tolist()
    score, before = [0.0] * n, [-1] * n
    trees: dict[tuple[int, int], _Stretch] = {}
    ends: dict[int, deque[tuple[float, int]]] = {}

    def within_reach(own: int, other: int) -> tuple[float, int]:
        best = (-np.inf, -1)
        for place in range(other - reach, other):
            held = ends.get(place)
            if held:
                while held and at[held[0][1]] < own - reach:
                    held.popleft()
                if held and held[0] > best:
                    best = held[0]
        return best

    i, last = 0, -1
    while i < n:
        j, here = i, at[i] // reach
        if here != last:
            trees = {key: tree for key, tree in trees.items() if key[0] == here - 1}
            last = here
        while j < n and at[j] == at[i]:
            there, place = divmod(to[j], reach)
            best = (-np.inf, -1)
            for own in (here, here - 1):
                for other, upto in ((there, place), (there - 1, reach)):
                    tree = trees.get((own, other))
                    if tree is not None:
                        best = max(best, tree.before(upto))
            if best[1] >= 0 and (at[best[1]] < at[j] - reach or to[best[1]] < to[j] - reach):
                best = within_reach(at[j], to[j])
            cost = gap_cost * (at[j] + to[j])
            score[j] = k
            if best[0] - cost > 0:
                score[j], before[j] = k + best[0] - cost, best[1]
            j += 1
        for m in range(i, j):
            end = (score[m] + gap_cost * (at[m] + to[m] + 2 * k), m)
            there, place = divmod(to[m], reach)
            if (here, there) not in trees:
                trees[here, there] = _Stretch(reach)
            trees[here, there].add(place, end)
            held = ends.setdefault(to[m], deque())
            while held and held[-1][0] <= end[0]:
                held.pop()
            held.append(end)
        i = j
    used, out = [False] * n, []
    for end in sorted(range(n), key=lambda m: -score[m]):
        chain = []
        while end >= 0 and not used[end]:
            used[end] = True
            chain.append(end)
            end = before[end]
        if chain:
            out.append(chain[::-1])
    return out


def _chain_rows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("to", pa.int64()), ("from_word", pa.int64()),
                        ("to_word", pa.int64()), ("links", pa.binary())])

    def rows():
        for table in by_group(parts, ("doc_id", "to")):
            doc, to = (table[c].to_numpy() for c in ("doc_id", "to"))
            place, row = _values(table["places"], np.int64)
            pair = (np.cumsum(changes(doc, to)) - 1)[row]
            order = np.lexsort((place, pair))
            pair, place, row = pair[order], place[order], row[order]
            fresh = changes(pair, place)
            pair, place, row = pair[fresh], place[fresh], row[fresh]
            cuts = np.r_[np.flatnonzero(changes(pair)), len(pair)]
            several = np.flatnonzero(np.diff(cuts) > 1)
            for a, b in zip(cuts[several].tolist(), cuts[several + 1].tolist()):
                at, to_at = place[a:b] >> 32, place[a:b] & _LOW
                for chain in chains(at, to_at):
                    if len(chain) > 1:
                        own = np.stack([at[chain], to_at[chain]], axis=1)
                        yield (int(doc[row[a]]), int(to[row[a]]), max(int(own[0, 1]) - MARGIN, 0), int(own[-1, 1]) + K + MARGIN, own.tobytes())

    yield from batches(rows(), schema, 2048)


def _slice(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each chain with the words around it of the earlier document."""
    last, words = None, None
    for part in parts:
        ids, texts = part.column("to").to_pylist(), part.column("text").cast(pa.binary())
        out = []
        for row, (a, b) in enumerate(zip(part.column("from_word").to_pylist(), part.column("to_word").to_pylist())):
            if ids[row] != last:
                last, words = ids[row], words_of(texts[row].as_py())
            out.append(words[a:b].tobytes())
        yield pa.RecordBatch.from_arrays(
            [*(part.column(c) for c in ("doc_id", "to", "from_word", "links")), pa.array(out, pa.binary())],
            names=["doc_id", "to", "from_word", "links", "words"])


def _edit_matches(a: np.ndarray, b: np.ndarray) -> int:
    """The longest common subsequence of two short runs of words."""
    row = np.zeros(len(b) + 1, np.int64)
    for word in a:
        new = np.maximum(row[1:], row[:-1] + (b == word))
        row[1:] = np.maximum.accumulate(new)
    return int(row[-1])


def _outward(own: np.ndarray, other: np.ndarray) -> tuple[int, int]:
    """How far two runs go on together, and how many words agree there: where agreement less
    twice the disagreement is greatest."""
    n = min(len(own), len(other), MARGIN)
    if not n:
        return 0, 0
    same = own[:n] == other[:n]
    gain = np.cumsum(np.where(same, 1, -2))
    far = int(gain.argmax())
    return (far + 1, int(same[:far + 1].sum())) if gain[far] > 0 else (0, 0)


def _runs(own: np.ndarray, other: np.ndarray, links: np.ndarray) -> tuple[list[int], np.ndarray]:
    """The first link of each run of links between which all words agree, and how many words agree
    from the first link of all to each link."""
    heads, matches = [0], [0]
    for number, ((at, to), (i, j)) in enumerate(zip(links[:-1].tolist(), links[1:].tolist()), 1):
        if i - at == j - to:
            same = int((own[at:i] == other[to:j]).sum())
        else:
            same = _edit_matches(own[at:i], other[to:j])
        if same < max(i - at, j - to):
            heads.append(number)
        matches.append(matches[-1] + same)
    return heads, np.array(matches)


def _reaches(own: np.ndarray, other: np.ndarray) -> list[tuple[int, int]]:
    """How far a run may go on, and how many words agree there: not at all, as long as every word
    agrees, and as ``_outward`` has it."""
    n = min(len(own), len(other), MARGIN)
    differ = np.flatnonzero(own[:n] != other[:n])
    exact = int(differ[0]) if len(differ) else n
    return sorted({(0, 0), (exact, exact), _outward(own, other)})


def aligned(own: np.ndarray, other: np.ndarray, links: np.ndarray, k: int = K,
            min_words: int = MIN_WORDS, similarity: float = SIMILARITY) -> list[tuple[int, int]]:
    """The spans of a chain in ``own`` that are passages: every part of it, from the start of a run of
    links to the end of one, of ``min_words`` words and ``similarity`` at least. That is words
    that agree, as a share of the longer side's. Parts that overlap are one span. ``links``:
    places in both word lists, in order.
    """
    heads, matches = _runs(own, other, links)
    starts, ends = [], []
    for run, (a, b) in enumerate(zip(heads, [*heads[1:], len(links)])):
        (i, j), (at, to) = links[a].tolist(), (links[b - 1] + k).tolist()
        for more, same in _reaches(own[:i][::-1], other[:j][::-1]):
            starts.append((i - more, j - more, matches[a] - same, run))
        for more, same in _reaches(own[at:], other[to:]):
            ends.append((at + more, to + more, matches[b - 1] + k + same, run))
    ends = np.array(sorted(ends))
    found: list[tuple[int, int]] = []
    for i, j, before, run in sorted(starts):
        far = found[-1][1] if found else 0
        if far == ends[-1, 0]:
            break
        last = ends[np.searchsorted(ends[:, 0], max(i + min_words, far + 1)):]
        longer = np.maximum(last[:, 0] - i, last[:, 1] - j)
        passes = np.flatnonzero((last[:, 3] >= run) & (last[:, 2] - before >= similarity * longer - 1e-9))
        if len(passes):
            end = int(last[passes[-1], 0])
            if found and i <= far:
                found[-1] = (found[-1][0], end)
            else:
                found.append((i, end))
    return found


def _cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("like", pa.int64())]))
    for part in in_slices(parts):
        texts = part.column("text")
        n_bytes, spans, kept = [], [], []
        for text, own_chains in zip(texts, part.column("chains").to_pylist()):
            text, found = text.as_py(), []
            raw = text.encode()
            if own_chains:
                start, end = word_places(raw)
                words = word_hashes(raw, start, end)
                for chain in own_chains:
                    links = np.frombuffer(chain["links"], np.int64).reshape(-1, 2) - [0, chain["from_word"]]
                    for a, b in aligned(words, np.frombuffer(chain["words"], np.uint64), links):
                        found.append((int(start[a]), int(end[b - 1]), chain["to"]))
                found = _apart(found)
                text = _without(raw, found)
            n_bytes.append(len(raw))
            spans.append([{"start": a, "end": b, "like": like} for a, b, like in found])
            kept.append(text)
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array(n_bytes, pa.int64()), pa.array(spans, span), pa.array(kept, pa.string()), part.column("rest")],
            names=["doc_id", "n_bytes", "spans", "kept", "rest"])


def _apart(spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans in order that do not overlap; where they do, the earlier goes on and the rest is cut."""
    out: list[tuple[int, int, int]] = []
    for a, b, like in sorted(spans, key=lambda s: (s[0], -s[1], s[2])):
        a = max(a, out[-1][1]) if out else a
        if a < b:
            out.append((a, b, like))
    return out


def _without(raw: bytes, spans: list[tuple[int, int, int]]) -> str:
    kept, at = [], 0
    for a, b, _ in spans:
        kept.append(raw[at:a])
        at = b
    return b"".join([*kept, raw[at:]]).decode()


def deduplicated(docs: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """Every document without passages like one in an earlier document.

    Returns doc_id, n_bytes, spans (array of start, end in UTF-8 bytes and ``like``, the doc_id of
    the earlier document) and kept, the text without them, and rest, a struct of the
    columns named in ``carry``. A passage is 50 words or more
    (between white space, A-Z like a-z) of similarity 0.8 or more with words of a document
    of smaller doc_id; whole copies are passages too. What is removed is that, but not every
    passage is found: two sampled seeds must have stayed unchanged and link its two
    documents, which changed words can prevent and of which a seed links only some. The
    README has the measured recall. Passages within one document stay.
    A null or empty text, or one of fewer words, loses nothing. Rows that repeat a doc_id
    are returned each and never lose to each other; where their texts differ, spans are
    found in each from the seeds of all. A row without doc_id takes no part; an empty
    table gives no rows.
    """
    rows = id_texts(docs)
    sampled = staged(rows.mapInArrow(_seed_rows, "seed long, doc_id long, at long, to long, seeds binary, places binary"), "seeds")
    firsts = sampled.where("to IS NULL").select("seed", "doc_id", "at")
    between = staged(
        firsts.repartition(width(rows), "seed").sortWithinPartitions("seed", "doc_id", "at")
        .mapInArrow(_global_links, _LINKS), "between")
    within = sampled.where("to IS NOT NULL").select("doc_id", "to", "seeds", "places")
    # What links to a task's first of a seed links to the earliest of all as well. It is looked up
    # for each pair of documents at once; of one ``via`` there is no more than one task has compared.
    told = between.where("earliest").select(F.col("doc_id").alias("via"), F.col("to").alias("other"), F.lit(False).alias("asks"), "seeds", "places")
    asked = within.select(F.col("to").alias("via"), F.col("doc_id").alias("other"), F.lit(True).alias("asks"), "seeds", "places")
    beyond = (told.unionByName(asked).repartition(width(rows), "via").sortWithinPartitions("via")
              .mapInArrow(_beyond, "doc_id long, to long, places binary"))
    links = within.drop("seeds").unionByName(between.select("doc_id", "to", "places")).unionByName(beyond)
    chained = staged(
        links.repartition(width(rows), "doc_id", "to").sortWithinPartitions("doc_id", "to")
        .mapInArrow(_chain_rows, "doc_id long, to long, from_word long, to_word long, links binary"), "chains")
    rest = as_row(carry) if carry else F.struct(F.lit(None).cast("int").alias("none"))
    texts = rows.repartition(width(rows), "doc_id")
    # A document that very many have text of meets their chains in parts; there are a thousand such
    # at most. The others are met where their texts lie already.
    n_chains = chained.count()
    hot = F.broadcast(chained.groupBy("to").agg(F.count("*").alias("n")).where(F.col("n") * 1000 >= n_chains)
                      .select("to", F.ceil(F.col("n") * 1000 / F.lit(max(n_chains, 1))).cast("int").alias("parts")))
    part = F.pmod(F.xxhash64("doc_id"), "parts").alias("part")
    hot_texts = (rows.join(hot, F.col("doc_id") == F.col("to"))
                 .select("to", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts").cast("long") - 1)).alias("part"), "text"))
    sides = ["doc_id", "to", "from_word", "to_word", "links", "text"]
    met = chained.join(hot, "to", "left_anti").join(texts.select(F.col("doc_id").alias("to"), "text"), "to").select(sides)
    met_hot = chained.join(hot, "to").select("*", part).join(hot_texts, ["to", "part"]).select(sides)
    sliced = met.unionByName(met_hot).mapInArrow(_slice, "doc_id long, to long, from_word long, links binary, words binary")
    own = sliced.groupBy("doc_id").agg(F.collect_list(F.struct("to", "from_word", "links", "words")).alias("chains"))
    whole = texts.withColumn("rest", rest) if not carry else id_texts(docs, rest=rest).repartition(width(rows), "doc_id")
    kinds = StructType.fromDDL("doc_id long, n_bytes long, spans array<struct<start: long, end: long, like: long>>, kept string")
    return whole.join(own, "doc_id", "left").select("doc_id", "text", "chains", "rest").mapInArrow(
        _cut, kinds.add("rest", whole.schema["rest"].dataType))
