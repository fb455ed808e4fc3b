"""Hashes of all windows of a sequence, and the places that stand for them, over arrays.

A window's place is the smallest hash among the shorter runs inside it, the leftmost of equal ones. It depends on the
window's content alone, so equal windows have equal places, and few places stand for many windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_A, _B = np.uint64(0xD6E8FEB86659FD93), np.uint64(32)
#: Odd bases of two independent polynomial hashes modulo 2**64, and their inverses.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_INVERSES = tuple(pow(b, -1, 1 << 64) for b in BASES)
_POSITION = np.uint64(30)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _B)) * _A
    x = (x ^ (x >> _B)) * _A
    return x ^ (x >> _B)


_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """The first ``n`` powers; kept for the next text up to a bounded length."""
    known = _POWERS.get(base, np.zeros(0, np.uint64))
    if len(known) < n:
        known = np.full(max(n, min(2 * n, 1 << 21)), base, np.uint64)
        known[0] = 1
        known = np.multiply.accumulate(known)
        if len(known) <= 1 << 21:
            _POWERS[base] = known
    return known[:n]


class Hasher:
    """Hashes of windows of a sequence of 64-bit values, any length, from prefix sums."""

    def __init__(self, values: np.ndarray, which: int = 0):
        n = len(values)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values * _powers(BASES[which], n), out=self.sums[1:])
        self.back = _powers(_INVERSES[which], n + 1)

    def windows(self, length: int) -> np.ndarray:
        """The hash of each window of ``length`` values."""
        if len(self.sums) <= length:
            return np.zeros(0, np.uint64)
        return mixed((self.sums[length:] - self.sums[:-length]) * self.back[: len(self.sums) - length])

    def spans(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """The hash of each span; its length is part of it."""
        return mixed((self.sums[stop] - self.sums[start]) * self.back[start] + (stop - start).astype(np.uint64))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` neighbours, from the smallest of half as many each time."""
    if len(values) < width:
        return values[:0]
    size = 1
    while size < width:
        more = min(size, width - size)
        values = np.minimum(values[:-more], values[more:])
        size += more
    return values


def places(runs: np.ndarray, per_window: int) -> np.ndarray:
    """For each window of ``per_window`` neighbouring runs, the index of the run that stands for it."""
    ranked = (runs >> _POSITION << _POSITION) | np.arange(len(runs), dtype=np.uint64)
    return (sliding_min(ranked, per_window) & np.uint64((1 << 30) - 1)).view(np.int64)


def distinct(ordered: np.ndarray) -> np.ndarray:
    """Values of a sequence whose equal ones are neighbours."""
    return ordered[np.flatnonzero(np.diff(ordered, prepend=-1))]


def covered(starts: np.ndarray, stops: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` positions lie in a span."""
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, stops, -1)
    return np.cumsum(edges[:-1]) > 0


class Rows:
    """Columns of output rows gathered over the documents of a batch."""

    def __init__(self, *kinds):
        self.kinds, self.parts, self.counts, self.total = kinds, [[] for _ in kinds], [], 0

    def add(self, *columns: np.ndarray) -> None:
        for part, column in zip(self.parts, columns, strict=True):
            part.append(column)

    def close_document(self) -> None:
        total = sum(map(len, self.parts[0]))
        self.counts.append(total - self.total)
        self.total = total

    def arrays(self) -> list[pa.Array]:
        return [pa.array(np.concatenate([np.zeros(0, k), *p]).astype(k)) for k, p in zip(self.kinds, self.parts, strict=True)]


def as_long(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def as_check(x: np.ndarray) -> np.ndarray:
    """32 more bits of a hash."""
    return (x >> _B).astype(np.uint32).view(np.int32)


def runs_of(stand: np.ndarray, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, size) of the stretches of neighbouring windows that one run stands for and that are all kept."""
    key = np.where(kept, stand, -1)
    first = np.flatnonzero(np.diff(key, prepend=-2))
    size = np.diff(np.append(first, len(key)))
    own = key[first] >= 0
    return first[own], size[own]


def place_hash(key: int | np.ndarray, at: np.ndarray) -> np.ndarray:
    """A hash of a place: a document's key and a start in it."""
    return mixed(np.asarray(key).astype(np.uint64) * np.uint64(BASES[0]) + at.astype(np.uint64))


def place_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (h) from (key, at)."""
    for batch in batches:
        key, at = batch.column("key").to_numpy(zero_copy_only=False), batch.column("at").to_numpy(zero_copy_only=False)
        yield pa.RecordBatch.from_arrays([pa.array(as_long(place_hash(key, at)))], names=["h"])
