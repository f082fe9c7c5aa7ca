"""Sampled positions of texts: where two texts share 100 bytes, they share a sampled position."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np

#: Bytes that are hashed from a sampled position on, the first offset of the doubling.
PREFIX = 32
BLOB = 1 << 18
_POSITION_BITS = 20

_dice = np.random.default_rng(42)
_VALUE = _dice.integers(0, 1 << 64, 256, np.uint64)
_SECOND = _dice.integers(0, 1 << 64, 256, np.uint64)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    out[1:] = np.uint64(base)
    return np.multiply.accumulate(out)


_SPAN = 2 * BLOB + 1024
_UP, _DOWN = _powers(_BASE, _SPAN), _powers(_INVERSE, _SPAN)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def sums(blob: np.ndarray, values: np.ndarray = _VALUE) -> np.ndarray:
    """Prefix sums of the bytes' values times powers of a base, modulo 2**64."""
    out = np.zeros(len(blob) + 1, np.uint64)
    np.cumsum(values[blob] * _UP[:len(blob)], out=out[1:])
    return out


def hashes(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of blob[start:end], alike for alike bytes anywhere."""
    return mixed((prefix[end] - prefix[start]) * _DOWN[start])


class Runs(NamedTuple):
    """Runs of windows that share a sampled position: per run the number of its segment, its first
    window in the segment's text, the sampled position after that, the number of further windows,
    the hash of the prefix there and that of all bytes the windows cover."""

    segment: np.ndarray
    first: np.ndarray
    at: np.ndarray
    more: np.ndarray
    name: np.ndarray
    run: np.ndarray


def segments(texts: Iterable[tuple[int, bytes]], window: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """(doc_id, start, bytes) in lists of about a blob. A longer text comes in parts that overlap
    by a window less one, so that each window is whole in one of them."""
    held, size = [], 0
    for doc_id, text in texts:
        for at in range(0, max(len(text) - window + 1, 1), BLOB):
            part = text[at:at + BLOB + window - 1]
            held.append((doc_id, at, part))
            size += len(part)
            if size >= BLOB // 2:
                yield held
                held, size = [], 0
    if held:
        yield held


def sampled_runs(parts: list[bytes], window: int) -> Runs:
    """The runs of all windows of the segments.

    The sampled position of a window is where the least hash of a prefix starts in it,
    the first of equals. It depends on the window's bytes alone, so windows alike have
    it at the same place.
    """
    blob = np.frombuffer(b"".join(parts), np.uint8)
    sizes = np.array([len(p) for p in parts])
    ends = np.cumsum(sizes)
    starts = ends - sizes
    n = len(blob) - window + 1
    empty = np.zeros(0, np.int64)
    if n <= 0:
        return Runs(empty, empty, empty, empty, empty.view(np.uint64), empty.view(np.uint64))
    prefix = sums(blob)
    at = np.arange(len(blob) - PREFIX + 1)
    name = hashes(prefix, at, at + PREFIX)
    key = (name >> np.uint64(_POSITION_BITS) << np.uint64(_POSITION_BITS)) | at.astype(np.uint64)
    reach, wide = 1, window - PREFIX + 1
    while 2 * reach <= wide:
        key = np.minimum(key[:-reach], key[reach:])
        reach *= 2
    if reach < wide:
        key = np.minimum(key[:-(wide - reach)], key[wide - reach:])
    sample = (key & np.uint64((1 << _POSITION_BITS) - 1)).astype(np.int64)
    valid = np.zeros(n + 1, np.int8)
    long = sizes >= window
    valid[starts[long]] += 1
    valid[ends[long] - window + 1] -= 1
    valid = np.cumsum(valid)[:n] > 0
    change = np.r_[True, sample[1:] != sample[:-1]] | np.r_[True, valid[1:] != valid[:-1]]
    first = np.flatnonzero(change)
    last = np.r_[first[1:], n] - 1
    keep = valid[first]
    first, last = first[keep], last[keep]
    place = sample[first]
    segment = np.searchsorted(ends, first, side="right")
    run = mixed(hashes(prefix, first, last + window) + (place - first).astype(np.uint64) * np.uint64(_BASE))
    return Runs(segment, first - starts[segment], place - first, last - first, name[place], run)
