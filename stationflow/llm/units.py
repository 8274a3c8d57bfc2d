"""Encoding whole texts by way of their distinct units.

A text is cut into units such that the ids of the text are the ids of its units
one after another; then each distinct unit needs encoding only once.

* Plain texts (ASCII and Latin letters up to U+024F, no added token of the
  file): the units are the pre-tokens of the file's pattern. They are found for
  a whole slice of rows with numpy, from the classes of the bytes, and repeated
  ones are brought together by a 64-bit hash within the slice.
* Other texts, ``word`` kind (white space is dropped by the tokenizer): the
  units are the runs without ASCII white space. Nothing in the tokenizer reaches
  over such white space: normalization composes no character with a blank, no
  pre-token and no added token holds one.
* Other texts, ``byte`` kind (a blank belongs to the word after it): the units
  follow the white space alternatives of the pattern, with everything between
  white space in one unit. A text that holds an added token, or white space
  outside ASCII, is one unit as a whole, so that the library sees it in full.

The library encodes every unit; its merges are not written anew here. Within a
slice of about 200,000 pre-tokens two different ones share a hash with a
probability near 1e-9.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

from tokenizers import Tokenizer  # noqa: E402

from stationflow.llm import textarrays as T  # noqa: E402

_WORD_RUN = re.compile(r"[^\x20\x09-\x0D]+")
_BYTE_RUN = re.compile(
    r" ?[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+(?![^\x20\x09-\x0D])|[\x20\x09-\x0D]+")
# White space outside ASCII.
_OTHER_SPACE = re.compile(
    "[\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]")

# Classes of bytes of plain texts; bytes from 0x80 on are parts of letters.
_S, _L, _N, _O = range(4)
_CLASS = np.full(256, _O, np.uint8)
_CLASS[T.SPACE] = _S
_CLASS[[*range(65, 91), *range(97, 123), *range(0x80, 0x100)]] = _L
_CLASS[48:58] = _N


def alphabet() -> str:
    """The character that stands for each byte in a byte-level vocabulary:
    printable ones for themselves, the others from U+0100 on in order."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return "".join(chr(b if b in printable else next(others)) for b in range(256))


_TO_ALPHABET = {b: c for b, c in enumerate(alphabet())}

# Distinct units kept by a worker; the older half goes when there are more.
CACHE_UNITS = 600_000
SLICE_BYTES = 2 << 20


def not_plain(t: T.Texts) -> np.ndarray:
    """Rows with a byte that plain texts may not hold."""
    d = t.data
    bad = (d >= 0x1C) & (d <= 0x1F) | (d >= 0xCA) | (d == 0xC2)
    high = np.flatnonzero(d >= 0xC3)
    if len(high):
        lead, tail = d[high], d[np.minimum(high + 1, len(d) - 1)]
        odd = ((lead == 0xC3) & ((tail == 0x97) | (tail == 0xB7))     # U+00D7, U+00F7
               | (lead == 0xC4) & (tail == 0xB0)                       # U+0130
               | (lead == 0xC9) & (tail > 0x8F))                       # from U+0250 on
        bad[high[odd]] = True
    return T.per_row(bad, t.offsets) > 0


def pre_tokens(t: T.Texts, data: np.ndarray, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each pre-token of plain rows; ``data`` is the text as
    the pattern sees it (lower-cased for the ``word`` kind)."""
    n = len(data)
    cls = _CLASS[data]
    edge = np.zeros(n + 1, bool)
    edge[t.offsets] = True
    same_row = ~edge[:n]                                  # byte i and i - 1 are in one row
    prev = np.concatenate(([_S], cls[:-1]))
    start = (cls != prev) | ~same_row
    if kind == "word":
        start |= cls == _N
    # Contractions: an apostrophe that starts a token, and one or two letters.
    quote = np.flatnonzero((data == 39) & start)
    if kind == "byte" and len(quote):
        quote = quote[~(same_row[quote] & (data[np.maximum(quote - 1, 0)] == 0x20))]
    if len(quote):
        row_end = t.offsets[np.searchsorted(t.offsets, quote, "right")]
        at = lambda k: np.where(quote + k < row_end, data[np.minimum(quote + k, n - 1)], 0)
        a, b = at(1), at(2)
        one = np.isin(a, [115, 116, 109, 100])            # s t m d
        two = ((a == 114) | (a == 118)) & (b == 101) | (a == 108) & (b == 108)   # re ve ll
        size = np.where(one, 2, np.where(two, 3, 0))
        hit = size > 0
        start[quote[hit] + 1] = False
        over = (quote + size)[hit & (quote + size < row_end)]
        start[over] = True
    if kind == "byte":
        space = cls == _S
        follows = np.zeros(n, bool)                       # a non-space of the same row comes next
        follows[:-1] = space[:-1] & ~space[1:] & same_row[1:]
        start |= follows                                  # the last blank of a run stands alone
        joined = np.flatnonzero(follows & (data == 0x20)) + 1
        start[joined] = False                             # ... or with the token after it
        first = np.flatnonzero(start)
        return first, np.append(first[1:], n) if len(first) else first
    first = np.flatnonzero(start & (cls != _S))
    stops = np.flatnonzero(start | (cls == _S) | ~same_row)
    nxt = np.searchsorted(stops, first, "right")
    return first, np.append(stops, n)[nxt] if len(first) else first


class Units:
    """A tokenizer file with a bounded memory of encoded units."""

    def __init__(self, path: str, kind: str, cache_units: int = CACHE_UNITS):
        if kind not in ("word", "byte"):
            raise ValueError(f"unknown unit kind {kind!r}")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.kind = kind
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.half = max(1, cache_units // 2)
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    # --- coarse units, for any text ------------------------------------------

    def split(self, text: str) -> list[str]:
        if self.kind == "word":
            return _WORD_RUN.findall(text)
        if any(a in text for a in self.added) or _OTHER_SPACE.search(text):
            return [text] if text else []
        return _BYTE_RUN.findall(text)

    def encode_units(self, units: list[str]) -> list[bytes]:
        """Ids of each unit as little-endian unsigned 32-bit integers."""
        done = self.tokenizer.encode_batch_fast(units, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in done]

    # --- plain rows, a slice at a time ---------------------------------------

    def encode_plain_unit(self, unit: bytes) -> bytes:
        """A pre-token goes to the file's model, as the library's own pipeline
        passes it on: lower-cased if the file does so, byte by byte in the
        byte-level alphabet."""
        if self.kind == "word":
            unit = unit.decode().lower().encode()
        tokens = self.model.tokenize(unit.decode("latin-1").translate(_TO_ALPHABET))
        return np.array([t.id for t in tokens], "<u4").tobytes()

    def _known(self, units: list[bytes]) -> list[bytes]:
        if len(self.young) > self.half:
            self.old, self.young = self.young, {}
        out, young, old = [], self.young, self.old
        for u in units:
            ids = young.get(u)
            if ids is None:
                ids = old.get(u)
                young[u] = ids = self.encode_plain_unit(u) if ids is None else ids
            out.append(ids)
        return out

    def distinct(self, t: T.Texts) -> tuple[np.ndarray, list[bytes], np.ndarray]:
        """Pre-tokens of plain rows: the code of each, the distinct ones in
        order of code, and the number of pre-tokens before each row."""
        data = T.LOWER[t.data] if self.kind == "word" else t.data
        start, end = pre_tokens(t, data, self.kind)
        codes, uniques = pd.factorize(T.span_hashes(data, start, end))
        place = np.zeros(len(uniques), np.int64)
        place[codes[::-1]] = np.arange(len(codes))[::-1]
        raw = data.tobytes()
        units = [raw[a:b] for a, b in zip(start[place].tolist(), end[place].tolist())]
        return codes, units, np.searchsorted(start, t.offsets)

    def encode_plain(self, t: T.Texts) -> tuple[np.ndarray, np.ndarray]:
        codes, units, first = self.distinct(t)
        if not units:
            return np.zeros(0, np.uint32), np.zeros(t.rows + 1, np.int64)
        known = self._known(units)
        sizes = np.array([len(k) >> 2 for k in known], np.int64)
        table = np.frombuffer(b"".join(known), "<u4")
        return gather(table, np.cumsum(sizes) - sizes, sizes, codes, first)

    def encode(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each slice of rows: its first row, the ids of its rows (null: no
        ids) and where each row's ids begin (one entry more than rows)."""
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        column = pc.fill_null(column.cast(pa.large_string()), "")
        coarse = np.zeros(len(column), bool)
        for a in self.added:
            coarse |= pc.match_substring(column, a).to_numpy(zero_copy_only=False)
        for t in T.slices(column, SLICE_BYTES):
            rows = coarse[t.first:t.first + t.rows] | not_plain(t)
            if not rows.any():
                yield t.first, *self.encode_plain(t)
                continue
            sizes = np.diff(t.offsets)
            plain = T.Texts(0, t.data[np.repeat(~rows, sizes)],
                            np.concatenate(([0], np.cumsum(np.where(rows, 0, sizes)))))
            ids, first = self.encode_plain(plain)
            parts = []
            for i in range(t.rows):
                if rows[i]:
                    units = self.split(column[t.first + i].as_py())
                    parts.append(np.frombuffer(b"".join(self.encode_units(units)), "<u4"))
                else:
                    parts.append(ids[first[i]:first[i + 1]])
            yield (t.first, np.concatenate(parts),
                   np.concatenate(([0], np.cumsum([len(p) for p in parts]))))


def gather(table: np.ndarray, begin: np.ndarray, sizes: np.ndarray, codes: np.ndarray,
           first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Put the runs ``table[begin[c]:begin[c] + sizes[c]]`` of all codes one
    after another; ``first`` gives the codes before each row, the second result
    the entries before each row."""
    count = sizes[codes]
    total = np.concatenate(([0], np.cumsum(count)))
    where = np.repeat(begin[codes] - total[:-1], count) + np.arange(total[-1])
    return table[where], total[first]


@lru_cache(maxsize=4)
def units_for(path: str, kind: str) -> Units:
    """One instance per worker process, so that tasks share the memory."""
    return Units(path, kind)
