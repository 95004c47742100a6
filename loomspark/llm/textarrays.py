"""Vectorised word hashing of Arrow text columns.

All texts of a batch are hashed in a few numpy passes over their UTF-8 bytes: a polynomial hash modulo 2**64 over
random byte values, taken per word from prefix sums, then finalised by a bit mixer. Equal words get equal hashes
everywhere; different words get different ones but for chance (2**-64 a pair).
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Memory that is freed goes back to the system at once: executors share theirs with the JVM.
pa.set_memory_pool(pa.system_memory_pool())

#: What tasks keep in a reused worker for the next ones; a pass that needs the memory clears it first.
KEPT_BY_WORKER: list[dict] = []


_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Return freed memory to the system, where the C library can."""
    if _TRIM:
        _TRIM(0)


def clear_kept() -> None:
    for kept in KEPT_BY_WORKER:
        kept.clear()
    give_back()


#: Odd constants of the hash (arbitrary, but equal everywhere).
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MUL1 = np.uint64(0xBF58476D1CE4E5B9)
_MUL2 = np.uint64(0x94D049BB133111EB)
_S1, _S2, _S3 = np.uint64(30), np.uint64(27), np.uint64(31)
#: Bytes of text that one numpy pass takes; a longer text is a pass of its own.
SLICE = 1 << 19

ASCII_SPACE = frozenset([0x20, *range(0x09, 0x0E)])
#: All ASCII but letters and digits.
ASCII_PUNCT = frozenset(b for b in range(0x80) if not chr(b).isalnum())


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _S1)) * _MUL1
    h = (h ^ (h >> _S2)) * _MUL2
    return h ^ (h >> _S3)


def _inverse(x: int) -> int:
    return pow(x, -1, 1 << 64)


class Powers:
    """Powers of the base and of its inverse, grown on demand and kept for the next batches."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def upto(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            for name, base in (("up", _BASE), ("down", np.uint64(_inverse(int(_BASE))))):
                p = np.full(n, base, np.uint64)
                p[0] = 1
                setattr(cls, name, np.cumprod(p, dtype=np.uint64))
        return cls.up, cls.down


def text_slices(column: pa.Array, limit: int = SLICE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets of the rows in these bytes) for runs of rows of about `limit` bytes. Null is empty."""
    column = column.cast(pa.large_string())
    n = len(column)
    if not n:
        return
    _, offs, data = column.buffers()
    off = np.frombuffer(offs, np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(off, off[at] + limit, "right")) - 1)
        yield at, raw[off[at] : off[to]], off[at : to + 1] - off[at]
        at = to


class Words:
    """Words of a run of texts: hash, text number, and first and last byte of each."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, separators: frozenset = ASCII_SPACE, lower: bool = True):
        n = len(raw)
        rows = len(offsets) - 1
        if not n:
            self.hash, self.row = np.zeros(0, np.uint64), np.zeros(0, np.int64)
            self.start = self.end = np.zeros(0, np.int64)
            self.first, self._sums, self._down = np.zeros(
                rows + 1, np.int64
            ), np.zeros(1, np.uint64), np.ones(1, np.uint64)
            return
        kept = np.ones(256, bool)
        kept[list(separators)] = False
        inside = kept[raw]
        begin = inside.copy()
        begin[1:] &= ~inside[:-1]
        heads = offsets[:-1][offsets[:-1] < offsets[1:]]
        begin[heads] = inside[heads]
        final = inside.copy()
        final[:-1] &= ~inside[1:]
        final[heads[1:] - 1] = inside[heads[1:] - 1]
        self.start = np.flatnonzero(begin)
        self.end = np.flatnonzero(final) + 1
        up, down = Powers.upto(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_values(lower)[raw] * up[:n], out=sums[1:])
        self._sums, self._down = sums, down
        self.hash = mix((sums[self.end] - sums[self.start]) * down[self.start])
        #: first[i]: number of the first word of text i
        self.first = np.searchsorted(self.start, offsets)
        self.row = np.repeat(np.arange(rows), np.diff(self.first))


    def beginnings(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(numbers of the words of more than k bytes, hashes of their first k bytes)."""
        at = np.flatnonzero(self.end - self.start > k)
        start = self.start[at]
        return at, mix(
            ((self._sums[start + k] - self._sums[start]) * self._down[start]) ^ np.uint64(k * 0x9E3779B97F4A7)
        )


def _values(lower: bool) -> np.ndarray:
    if lower not in _VALUES:
        v = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _BASE)
        if lower:
            v[65:91] = v[97:123]
        _VALUES[lower] = v
    return _VALUES[lower]


_VALUES: dict[bool, np.ndarray] = {}


def grams(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every run of k words."""
    h = words.hash
    if len(h) < k:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    m = len(h) - k + 1
    g = mix(h[:m] + np.uint64(k))
    for j in range(1, k):
        g = mix(g * _BASE + h[j : m + j])
    same = words.row[:m] == words.row[k - 1 :]
    return g[same], words.row[:m][same]


def shingle_sets(column: pa.Array, k: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its k-word shingles; of a text with fewer words, its whole
    sequence as one; of a text without words, none."""
    for _, raw, offsets in text_slices(column):
        words = Words(raw, offsets)
        g, row = grams(words, k)
        cuts = np.searchsorted(row, np.arange(len(offsets)))
        for i in range(len(offsets) - 1):
            a, b = words.first[i], words.first[i + 1]
            if b - a >= k:
                s = np.sort(g[cuts[i] : cuts[i + 1]])
                keep = np.ones(len(s), bool)
                np.not_equal(s[1:], s[:-1], out=keep[1:])
                yield s[keep]
            elif b > a:
                h = np.array([b - a], np.uint64)
                for j in range(a, b):
                    h = mix(h * _BASE + words.hash[j : j + 1])
                yield h
            else:
                yield np.zeros(0, np.uint64)
