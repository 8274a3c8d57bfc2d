"""Whole texts as numpy arrays, straight from an Arrow column.

A text column of an Arrow batch is one byte buffer with offsets. The functions
here find words and hash words and n-grams for many documents at once, with no
Python loop over words. A word is a maximal run of bytes other than
0x20 and 0x09-0x0D; UTF-8 continuation bytes never equal those, so byte words
and code point words agree. A null text is an empty text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text handled at once: bounds the memory of the 8-byte arrays.
SLICE_BYTES = 1 << 20

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


@dataclass
class Texts:
    """Some consecutive rows of a batch: ``data`` holds their bytes, row ``i``
    is ``data[offsets[i]:offsets[i + 1]]``; ``first`` is the row number of row 0."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Texts]:
    """Cut a string column into runs of whole rows of about ``limit`` bytes
    (a longer text is a run of its own)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if n == 0:
        return
    _, offset_buffer, data_buffer = column.buffers()
    offsets = np.frombuffer(offset_buffer, np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(data_buffer, np.uint8) if data_buffer is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(n, max(first + 1, last))
        yield Texts(first, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first])
        first = last


@dataclass
class Words:
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray       # row of each word, ascending
    first: np.ndarray     # index of the first word of each row, rows + 1 entries


def words(texts: Texts) -> Words:
    """Places of all words of a run of rows."""
    inside = ~SPACE[texts.data]
    cut = np.zeros(len(inside) + 1, bool)          # a row starts at this byte
    cut[texts.offsets] = True
    before = np.zeros(len(inside) + 1, bool)
    before[1:] = inside
    before &= ~cut
    after = np.zeros(len(inside) + 1, bool)
    after[:-1] = inside
    after &= ~cut
    start = np.flatnonzero(inside & ~before[:-1])
    end = np.flatnonzero(inside & ~after[1:]) + 1
    first = np.searchsorted(start, texts.offsets)
    row = np.repeat(np.arange(texts.rows), np.diff(first))
    return Words(start, end, row, first)


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, _BASE), np.full(n, _BASE_INVERSE)
    up[:1] = down[:1] = 1
    return np.cumprod(up), np.cumprod(down)


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: spreads every input bit over the result."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte strings ``data[start[i]:end[i]]``: a polynomial
    in an odd base, taken from one running sum, then mixed with the length."""
    size = 1 << max(16, int(len(data)).bit_length())
    up, down = _powers(size)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=total[1:])
    inside = (total[end] - total[start]) * down[np.minimum(start, size - 1)]
    return mix(inside + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def pieces(data: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Cut the bytes of one text behind white space into pieces of at most ``limit``
    bytes. A word of ``limit`` bytes or more is a piece of its own."""
    a, n = 0, len(data)
    while a < n:
        b = min(n, a + limit)
        if b < n:
            blank = np.flatnonzero(SPACE[data[a:b]])
            if len(blank):
                b = a + int(blank[-1]) + 1
            else:
                while b < n and not len(blank):
                    blank = np.flatnonzero(SPACE[data[b:b + limit]])
                    b = b + int(blank[0]) if len(blank) else min(n, b + limit)
        yield a, b
        a = b


def word_hashes(texts: Texts, lower: bool = False, limit: int = SLICE_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a run of rows (A-Z lower-cased if asked), and the
    index of the first word of each row, rows + 1 entries. A text longer than a
    slice is worked a piece at a time: only its hashes are held whole."""
    if texts.rows != 1 or len(texts.data) <= limit:
        w = words(texts)
        data = LOWER[texts.data] if lower else texts.data
        return span_hashes(data, w.start, w.end) if len(w.start) else np.zeros(0, np.uint64), w.first
    out = []
    for a, b in pieces(texts.data, limit):
        data = LOWER[texts.data[a:b]] if lower else texts.data[a:b]
        if b - a >= limit and not SPACE[data].any():
            whole = hashlib.blake2b(data.tobytes(), digest_size=8).digest()
            out.append(np.frombuffer(whole, np.uint64))
        else:
            w = words(Texts(0, data, np.array([0, b - a])))
            out.append(span_hashes(data, w.start, w.end))
    hashes = np.concatenate(out) if out else np.zeros(0, np.uint64)
    return hashes, np.array([0, len(hashes)])


def combine(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of every ``n`` consecutive entries (``len - n + 1`` of them)."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:m].copy()
    for k in range(1, n):
        out = out * np.uint64(0x9FB21C651E98DF25) + hashes[k:k + m]
    return mix(out)


def windows(w: Words, n: int) -> np.ndarray:
    """Index of the first word of each ``n``-word window inside one row."""
    m = len(w.row) - n + 1
    if m <= 0:
        return np.zeros(0, np.int64)
    return np.flatnonzero(w.row[:m] == w.row[n - 1:])


def per_row(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between consecutive entries of ``first``."""
    total = np.zeros(len(values) + 1, np.result_type(values.dtype, np.int64)
                     if values.dtype.kind in "biu" else np.float64)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]
