"""Words, word hashes and window hashes of whole Arrow batches of texts, in numpy.

A batch is cut into slabs of consecutive texts, so that working memory is a small multiple of the slab,
never of the batch. A text longer than a slab is a slab of its own.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import lru_cache, wraps

import numpy as np
import pyarrow as pa

SLAB_BYTES = 1 << 19
_BASE = 0x9E3779B97F4A7C15 | 1

#: Bytes that belong to words `[^\x20\x09-\x0D]+`.
SPACED = np.ones(256, bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False
#: Bytes that belong to words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` of lower-cased text.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mixed(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes so that every bit depends on all of them."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def _table(lower: bool) -> np.ndarray:
    t = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
    return t[LOWER] if lower else t


_TABLES = {low: _table(low) for low in (False, True)}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    def of(base: int) -> np.ndarray:
        p = np.full(n, base, np.uint64)
        p[0] = 1
        return np.multiply.accumulate(p)

    return of(_BASE), of(pow(_BASE, -1, 1 << 64))


_kept_powers = lru_cache(maxsize=1)(_powers)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64, at least n of each.

    Those that a slab needs are kept; those of a longer text are let go, so a worker doesn't hold them on.
    """
    return _kept_powers(SLAB_BYTES + 1) if n <= SLAB_BYTES + 1 else _powers(n)


class Slab:
    """Texts lo..hi-1 of a batch: their bytes, and the words in them."""

    def __init__(self, lo: int, hi: int, data: np.ndarray, offsets: np.ndarray):
        self.lo, self.hi, self.data, self.offsets = lo, hi, data, offsets

    def split(self, is_word: np.ndarray) -> Slab:
        """Find the words: starts, ends, and the index of each text's first word."""
        inside = is_word[self.data]
        n = len(inside)
        begin = inside.copy()
        begin[1:] &= ~inside[:-1]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        edges = self.offsets[:-1][self.offsets[:-1] < n]
        begin[edges] = inside[edges]
        edges = self.offsets[1:][self.offsets[1:] > 0] - 1
        last[edges] = inside[edges]
        self.starts = np.flatnonzero(begin)
        self.ends = np.flatnonzero(last) + 1
        self.first = np.searchsorted(self.starts, self.offsets)
        return self

    @property
    def n_words(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self, lower: bool = False) -> np.ndarray:
        """One 64-bit hash per word; `lower` treats A-Z as a-z."""
        power, inverse = powers(len(self.data))
        c = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum(_TABLES[lower][self.data] * power[: len(self.data)], out=c[1:])
        return mixed((c[self.ends] - c[self.starts]) * inverse[self.starts])

    def windows(self, h: np.ndarray, k: int, short: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rolling hashes of every k consecutive words of one text: first word, text index, hash.

        With `short`, a text of fewer words, but not none, is one window.
        """
        n_words = self.n_words
        counts = np.maximum(n_words - (k - 1), 0)
        if short:
            counts = np.where((counts == 0) & (n_words > 0), 1, counts)
        owner = np.repeat(np.arange(len(counts)), counts)
        base = np.cumsum(counts) - counts
        at = np.arange(counts.sum()) - base[owner] + self.first[:-1][owner]
        power, inverse = powers(len(h))
        c = np.zeros(len(h) + 1, np.uint64)
        np.cumsum(h * power[: len(h)], out=c[1:])
        end = np.minimum(at + k, self.first[1:][owner])
        return at, owner, mixed((c[end] - c[at]) * inverse[at])

    def text(self, i: int) -> bytes:
        """Bytes of the slab's i-th text."""
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()


def slabs(column: pa.Array | pa.ChunkedArray, limit: int = SLAB_BYTES) -> Iterator[Slab]:
    """Cut a string column into slabs; a null text is an empty one."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if len(column) == 0:
        return
    _, where, what = column.buffers()
    offsets = np.frombuffer(where, np.int64, len(column) + 1 + column.offset)[column.offset :]
    data = np.frombuffer(what, np.uint8) if what is not None and what.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        hi = min(hi, len(column))
        yield Slab(lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
        lo = hi


def give_back() -> None:
    """Hand memory that is free within this process back to the system; Python workers live on after a task."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not every C library has it
    if trim is not None:
        trim(0)


def released(step: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """A step over batches that gives its memory back when a task ends."""

    @wraps(step)
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from step(parts)
        finally:
            give_back()

    return run
