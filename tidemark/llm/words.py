"""Words of whole text columns as numpy arrays, for functions that run inside Spark tasks.

A word is a run of bytes of UTF-8 text, A-Z lower-cased, that are digits, a-z or part of a character beyond ASCII. Texts
are taken as Arrow hands them over, in slices of about a megabyte of whole texts, so that memory does not follow the size
of a batch; a longer text is a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[65:91] += 32
IS_WORD = np.zeros(256, dtype=bool)
IS_WORD[48:58] = IS_WORD[97:123] = IS_WORD[128:] = True
IS_LETTER = IS_WORD.copy()
IS_LETTER[48:58] = False
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
BYTE_VALUE = np.random.default_rng(20240101).integers(1, 1 << 63, 256, dtype=np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    """A finaliser that spreads 64-bit hashes."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


#: Bytes that are hashed at a time, so that scratch space doesn't follow the longest text.
PIECE = 1 << 20


@cache
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse modulo 2^64, as many as a piece needs."""
    out = []
    for base in (BASE, INVERSE):
        x = np.full(PIECE + 1, base)
        x[0] = 1
        out.append(np.multiply.accumulate(x))
    return out[0], out[1]


@dataclass
class Words:
    """The words of the rows lo..hi of a column."""

    lo: int
    hi: int
    raw: np.ndarray  # bytes as they are
    low: np.ndarray  # bytes, A-Z lower-cased
    at: np.ndarray  # bounds of the rows among the bytes
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray  # bounds of the rows among the words

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def row(self) -> np.ndarray:
        """The row, from 0, of each word."""
        return np.repeat(np.arange(self.hi - self.lo), self.counts)

    def hashes(self, prefix: int | None = None) -> np.ndarray:
        """64 bits for each word, or for its first bytes, the same for the same bytes anywhere."""
        up, down = _powers()
        out = np.zeros(len(self.start), dtype=np.uint64)
        stop = self.end if prefix is None else np.minimum(self.end, self.start + prefix)
        for lo in range(0, len(self.low), PIECE):
            hi = min(lo + PIECE, len(self.low))
            i, j = np.searchsorted(self.end, lo, side="right"), np.searchsorted(self.start, hi)
            if i == j:
                continue
            run = np.zeros(hi - lo + 1, dtype=np.uint64)
            np.cumsum(BYTE_VALUE[self.low[lo:hi]] * up[: hi - lo], out=run[1:])
            a = np.maximum(self.start[i:j], lo) - lo
            b = np.maximum(np.minimum(stop[i:j], hi) - lo, a)
            part = (run[b] - run[a]) * down[a]
            if self.start[i] < lo:  # only the first word can have begun in an earlier piece
                part[:1] *= np.uint64(pow(int(BASE), lo - int(self.start[i]), 1 << 64))
            out[i:j] += part
        return mixed(out)

    def word(self, i: int) -> str:
        return self.low[self.start[i] : self.end[i]].tobytes().decode()

    def counted(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.LargeStringArray]:
        """(row, code, n, terms): how often each row has each of its words, by row; a word is terms[code], compared as a whole."""
        length = self.end - self.start
        edge = np.zeros(len(self.low) + 1, dtype=np.int8)
        edge[self.start] = 1
        edge[self.end] -= 1
        inside = np.cumsum(edge[:-1], dtype=np.int8).astype(bool)
        bounds = np.concatenate([[0], np.cumsum(length)]).astype(np.int64)
        coded = pa.Array.from_buffers(pa.large_string(), len(length), [None, pa.py_buffer(bounds), pa.py_buffer(self.low[inside])]).dictionary_encode()
        terms = coded.dictionary
        pair, n = np.unique(self.row * max(1, len(terms)) + coded.indices.to_numpy(zero_copy_only=False), return_counts=True)
        row, code = np.divmod(pair, max(1, len(terms)))
        return row, code, n, terms


def column(values: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bounds, bytes) of a text column; null is the empty text."""
    a = values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values
    a = pc.fill_null(a.cast(pa.large_string()), "")
    _, bounds, data = a.buffers()
    bounds = np.frombuffer(bounds, dtype=np.int64)[a.offset : a.offset + len(a) + 1] if len(a) else np.zeros(1, dtype=np.int64)
    return bounds, np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)


def slices(values: pa.Array | pa.ChunkedArray, is_letter: np.ndarray = IS_WORD) -> Iterator[Words]:
    """is_letter: which (lower-cased) bytes words are made of."""
    bounds, data = column(values)
    lo, n = 0, len(bounds) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + SLICE_BYTES, side="right")) - 1)
        raw = data[bounds[lo] : bounds[hi]]
        at = bounds[lo : hi + 1] - bounds[lo]
        low = LOWERED[raw]
        is_word = is_letter[low]
        edge = np.zeros(len(raw) + 1, dtype=bool)
        edge[at] = True
        start = is_word.copy()
        start[1:] &= ~is_word[:-1] | edge[1:-1]
        end = is_word.copy()
        end[:-1] &= ~is_word[1:] | edge[1:-1]
        start, end = np.flatnonzero(start), np.flatnonzero(end) + 1
        yield Words(lo, hi, raw, low, at, start, end, np.searchsorted(start, at))
        lo = hi


def grams(hashes: np.ndarray, row: np.ndarray, k: int, tag: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(hash, valid) of the k words from each word on; valid where all are of one row."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=bool)
    out = np.full(n, np.uint64(tag * 2 + 1))
    for j in range(k):
        out = out * BASE + hashes[j : j + n]
    return mixed(out), row[:n] == row[k - 1 :]


def sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of values between bounds along axis 0, 0 where there are none. Each sum is of its own values alone: other rows don't even change its rounding."""
    kind = np.float64 if values.dtype.kind == "f" else np.int64
    out = np.zeros((len(first) - 1, *values.shape[1:]), dtype=kind)
    full = np.flatnonzero(first[1:] > first[:-1])
    if len(full):
        out[full] = np.add.reduceat(values, first[full], axis=0, dtype=kind)
    return out
