"""Token ids of a byte-level BPE tokenizer over Arrow text columns.

Texts are cut into the tokenizer's words by numpy passes over code points; a word is
tokenized once and its ids are kept in a bounded cache of the worker, sorted by the words'
hashes, which when full keeps the words that were met again.  How a code point
counts (letter, number, space or other) is asked of the tokenizer itself when the point is
first met, so both cut alike.  Tokenizers of another kind take texts whole.
"""

from __future__ import annotations

import json
import os
from itertools import chain

import numpy as np
import pyarrow as pa

from . import textbatch as tb

LETTER, NUMBER, OTHER, SPACE, GAP, UNKNOWN = range(6)
BLOCK = 1 << 18  # bytes of text handled at once
CACHE_WORDS = 1 << 19  # some 50 bytes each
AT_ONCE = 4096  # words tokenized at once


class ByteBpe:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True  # as the tokenizers' description has it: strings of special tokens in a text are ordinary text
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        self.by_words = not spec.get("normalizer") and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space", True) and pre.get("use_regex", True)
        self.kind = np.full(0x110000, UNKNOWN, np.uint8)
        self._forget()

    def _forget(self) -> None:
        """An empty cache: sorted hashes of words, where the ids of each are in the store, how often it was met again."""
        self.known, self.store = np.zeros(0, np.uint64), np.zeros(0, np.uint32)
        self.start, self.size, self.met = (np.zeros(0, np.int64) for _ in range(3))

    def _shrink(self) -> None:
        """Keep the words that were met again, if they are at most half of what fits."""
        keep = np.flatnonzero(self.met)
        if len(keep) > CACHE_WORDS // 2:
            return self._forget()
        self.store = self.store[self._flat(keep)]
        self.known, self.size = self.known[keep], self.size[keep]
        self.start, self.met = np.cumsum(self.size) - self.size, np.zeros(len(keep), np.int64)

    def _flat(self, slot: np.ndarray) -> np.ndarray:
        """Places in the store of the ids of some words, one after another."""
        size = self.size[slot]
        return np.arange(int(size.sum())) + np.repeat(self.start[slot] - (np.cumsum(size) - size), size)

    def _kind(self, point: int) -> int:
        """By whether the point joins a letter's, a number's or a dot's word."""
        for kind, lead in ((LETTER, "a"), (NUMBER, "1"), (OTHER, ".")):
            if len(self.tok.pre_tokenizer.pre_tokenize_str(lead + chr(point))) == 1:
                return kind
        return SPACE

    def _kinds(self, points: np.ndarray) -> np.ndarray:
        kinds = self.kind[points]
        if (kinds == UNKNOWN).any():
            for p in np.unique(points[kinds == UNKNOWN]).tolist():
                self.kind[p] = self._kind(p)
            kinds = self.kind[points]
        return kinds

    def word_starts(self, points: np.ndarray, gaps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(starts, kinds): where words begin; gaps are the places between texts."""
        kinds = self._kinds(points)
        kinds[gaps] = GAP
        n = len(points)
        start = np.ones(n, bool)
        start[1:] = kinds[1:] != kinds[:-1]
        start[gaps] = True
        blank = kinds == SPACE
        solid = kinds < SPACE
        # The last white space before a word stands alone or, if a blank, goes to that word.
        lasts = np.flatnonzero(blank[:-1] & solid[1:])
        start[lasts] = True
        start[lasts[points[lasts] == 0x20] + 1] = False
        # Contractions: an apostrophe that begins a word takes s, t, m, d, re, ve or ll with it.
        for i in np.flatnonzero((points == 0x27) & start & (kinds == OTHER)):
            a = points[i + 1] if i + 1 < n and kinds[i + 1] == LETTER else 0
            b = points[i + 2] if i + 2 < n and kinds[i + 2] == LETTER else 0
            take = 1 if a in (0x73, 0x74, 0x6D, 0x64) else 2 if (a, b) in ((0x72, 0x65), (0x76, 0x65), (0x6C, 0x6C)) else 0
            if take:
                start[i + 1] = False
                if i + 1 + take < n:
                    start[i + 1 + take] = True
        return np.flatnonzero(start), kinds

    def _learn(self, hashes: np.ndarray, words: list[str]) -> None:
        """Add the words of some ascending hashes that are not known."""
        sizes, stores = [], []
        for lo in range(0, len(words), AT_ONCE):  # the tokenizer's own results are large objects
            ids = [e.ids for e in self.tok.encode_batch_fast(words[lo : lo + AT_ONCE], add_special_tokens=False)]
            sizes.append(np.fromiter(map(len, ids), np.int64, len(ids)))
            stores.append(np.fromiter(chain.from_iterable(ids), np.uint32, int(sizes[-1].sum())))
        size = np.concatenate(sizes)
        at = np.searchsorted(self.known, hashes)
        self.known, self.size = np.insert(self.known, at, hashes), np.insert(self.size, at, size)
        self.start, self.met = np.insert(self.start, at, len(self.store) + np.cumsum(size) - size), np.insert(self.met, at, 0)
        self.store = np.concatenate([self.store, *stores])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, number of ids of each)."""
        if not self.by_words:
            got = [np.array(e.ids, np.uint32) for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]
            return np.concatenate([np.zeros(0, np.uint32), *got]), np.array([len(g) for g in got], np.int64)
        ends = np.cumsum(np.array([len(t) + 1 for t in texts], np.int64))
        joined = "\n".join(texts) + "\n"
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        starts, kinds = self.word_starts(points, ends - 1)
        stops = np.append(starts[1:], len(points))
        real = kinds[starts] != GAP
        lens = stops - starts
        pos = np.arange(len(points)) - np.repeat(starts, lens)
        value = (points.astype(np.uint64) + tb.U64(1)) * tb.coefficients(int(lens.max()))[pos]
        h = tb.mix64(np.add.reduceat(value, starts) ^ (lens.astype(np.uint64) << tb.U64(48)))[real]
        starts, stops = starts[real], stops[real]
        known, first, inverse = np.unique(h, return_index=True, return_inverse=True)
        if len(self.known) + len(known) > CACHE_WORDS:
            self._shrink()
        at = np.searchsorted(self.known, known)
        fresh = np.flatnonzero(self.known[np.minimum(at, len(self.known) - 1)] != known) if len(self.known) else np.arange(len(known))
        self.met[np.delete(at, fresh)] += 1
        if len(fresh):
            self._learn(known[fresh], [joined[a:b] for a, b in zip(starts[first[fresh]].tolist(), stops[first[fresh]].tolist(), strict=True)])
        slot = np.searchsorted(self.known, known)[inverse]
        size, flat = self.size[slot], self._flat(slot)
        bounds = np.concatenate([[0], np.cumsum(size)])
        counts = np.diff(bounds[np.searchsorted(starts, np.concatenate([[0], ends]))])
        return self.store[flat], counts


_LOADED: dict[str, ByteBpe] = {}


def tokenizer(path: str) -> ByteBpe:
    """One per worker process; its cache outlives a task."""
    if path not in _LOADED:
        _LOADED[path] = ByteBpe(path)
    return _LOADED[path]


def encoded(column: pa.Array, path: str):
    """(row, ids) of every row of a text column; nulls are empty."""
    tok = tokenizer(path)
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offs = tb.text_buffers(column)
    for lo, hi in tb.blocks(offs, BLOCK):  # only a block's texts are Python strings at a time
        ids, counts = tok.encode([t or "" for t in column.slice(lo, hi - lo).to_pylist()])
        at = 0
        for i, c in enumerate(counts.tolist()):
            yield lo + i, ids[at : at + c]
            at += c
