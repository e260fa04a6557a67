"""Vectorised text primitives for Arrow batches.

A text column is handled as one UTF-8 byte buffer plus row offsets, so words, rolling
hashes and counts are numpy passes and no Python object exists per word.  Rows are cut
into blocks of bounded bytes; only a single text larger than a block exceeds it.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
BLOCK = 1 << 19  # bytes of text handled at once; arrays beside it take some fifty times that


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, a bijection on 64-bit words."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _stream(n: int, seed: int) -> np.ndarray:
    return mix64((np.arange(1, n + 1, dtype=U64) + U64(seed)) * U64(0x9E3779B97F4A7C15))


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BYTE_VALUE = _stream(256, 11)
LOWER_VALUE = BYTE_VALUE[LOWER]
_COEF = [_stream(4096, 77) | U64(1)]


def coefficients(n: int) -> np.ndarray:
    """The first n odd position multipliers; the table grows to the longest word met."""
    if len(_COEF[0]) < n:
        _COEF[0] = _stream(n, 77) | U64(1)
    return _COEF[0]


#: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z: digits, letters, every byte >= 0x80.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True
#: [^\x20\x09-\x0D]+
NONSPACE = np.ones(256, dtype=bool)
NONSPACE[0x20] = NONSPACE[0x09:0x0E] = False


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls count as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, offs, data = column.buffers()
    offs = np.frombuffer(offs, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offs[0] : offs[-1]], offs - offs[0]


def blocks(offs: np.ndarray, limit: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Row ranges of at most `limit` bytes, one row at least."""
    lo, n = 0, len(offs) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, "right")) - 1)
        yield lo, hi
        lo = hi


def release() -> None:
    """Give memory that is no longer used back to the system; the C library else keeps tens of MB after large arrays."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # another C library


def task(run: Callable) -> Callable:
    """run, as a task's function that gives its memory back when it ends, since workers stay for later tasks."""

    def whole(batches):
        try:
            yield from run(batches)
        finally:
            release()

    return whole


class Words:
    """The words of some rows: byte starts and ends, row of each, first word of each row."""

    def __init__(self, data: np.ndarray, offs: np.ndarray, table: np.ndarray):
        self.data, self.offs = data, offs
        mask = table[data]
        before = np.empty_like(mask)
        before[1:] = mask[:-1]
        after = np.empty_like(mask)
        after[:-1] = mask[1:]
        if len(mask):
            edges = offs[:-1][offs[:-1] < len(mask)]
            before[edges] = False
            after[edges[edges > 0] - 1] = False
            after[-1] = False
        self.starts = np.flatnonzero(mask & ~before)
        self.ends = np.flatnonzero(mask & ~after) + 1
        self.first = np.searchsorted(self.starts, offs)
        self.counts = np.diff(self.first)
        self.row = np.repeat(np.arange(len(offs) - 1), self.counts)

    def hashes(self, lower: bool = True) -> np.ndarray:
        """A 64-bit hash per word, of A-Z lower-cased bytes unless told otherwise."""
        if not len(self.starts):
            return np.zeros(0, U64)
        lens = self.ends - self.starts
        at = np.cumsum(lens) - lens
        where = np.arange(int(lens.sum()))
        pos = where - np.repeat(at, lens)
        value = (LOWER_VALUE if lower else BYTE_VALUE)[self.data[np.repeat(self.starts, lens) + pos]]
        value *= coefficients(int(lens.max()))[pos]
        return mix64(np.add.reduceat(value, at) + lens.astype(U64) * U64(0xD6E8FEB86659FD93))

    def word(self, i: int) -> bytes:
        return bytes(LOWER[self.data[self.starts[i] : self.ends[i]]])

    def phrase(self, i: int, k: int) -> bytes:
        """Words i to i+k, lower-cased and joined by single blanks."""
        return b" ".join(self.word(j) for j in range(i, i + k))


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Rolling hashes of k consecutive words; entry i is of words i to i+k."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    out = h[:n].copy()
    for j in range(1, k):
        out *= U64(0x9E3779B97F4A7C15)
        out += h[j : j + n]
    return mix64(out)


def inside(words: Words, k: int) -> np.ndarray:
    """For each rolling k-gram: do its words lie in one row?"""
    n = len(words.starts) - k + 1
    return words.row[:n] == words.row[k - 1 :] if n > 0 else np.zeros(0, bool)


def shingle_hashes(words: Words, h: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every k-word shingle; a row of fewer words, but not none, has one of them all."""
    g, ok = grams(h, k), inside(words, k)
    rows = words.row[: len(g)][ok]
    g = g[ok]
    short = np.flatnonzero((words.counts > 0) & (words.counts < k))
    if len(short):
        extra = np.empty(len(short), U64)
        for i, r in enumerate(short):
            lo, n = words.first[r], words.counts[r]
            extra[i] = grams(h[lo : lo + n], n)[0] ^ U64(n)
        g, rows = np.concatenate([g, extra]), np.concatenate([rows, short])
    return g, rows


class HashSet:
    """Membership of 64-bit hashes: a small bitmap screens, a sorted array decides."""

    def __init__(self, values: np.ndarray, bits: int = 20):
        self.sorted = np.unique(values)
        self.shift = U64(64 - bits)
        self.bitmap = np.zeros(1 << bits, bool)
        self.bitmap[(self.sorted >> self.shift).astype(np.int64)] = True

    def where(self, x: np.ndarray) -> np.ndarray:
        """Indices of the members of x."""
        if not len(self.sorted):
            return np.zeros(0, np.int64)
        maybe = np.flatnonzero(self.bitmap[(x >> self.shift).astype(np.int64)])
        at = np.searchsorted(self.sorted, x[maybe])
        at[at == len(self.sorted)] = 0
        return maybe[self.sorted[at] == x[maybe]]
