"""Operator 8: BPE encoding and decoding by a table of distinct words.

1. Texts are split into words (the units of ``units.py``) and counted; the
   counts of equal words meet in one row.
2. Each distinct word is encoded once: the word table (word, count, ids).
3. Ids go back by position. The most frequent words, at most ``head_words`` of
   them, are sent to every task, which resolves their places at once. Every
   other word is joined with the word table by a shuffle; such words are by
   their choice not frequent, so no key of that join is hot.
4. Decoding joins ids with the table of pieces (as many rows as the vocabulary
   has, sent to every task).

Results do not depend on ``head_words``: it only decides which of the two ways a
word takes. The head is found by hash and then compared byte by byte.

Defined results: a null or empty text has no ids and decodes to the empty text;
every row is answered, also rows that share doc_id and text; an empty table
gives no row; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.llm import textarrays as T
from stationflow.llm.idfiles import Encoding
from stationflow.llm.store import least_step, saved
from stationflow.llm.units import SLICE_BYTES, alphabet, gather, not_plain, pre_tokens, units_for

# Largest number of frequent words that are broadcast (about 40 bytes each).
HEAD_WORDS = 800_000
# Words of more than SHORT_BYTES bytes have LONG_SHARE bytes for each word of the
# head (16 MB in all): those that do not fit go by the shuffle join.
SHORT_BYTES = 64
LONG_SHARE = 20

# Ranks from NEAR on have one low byte beside their symbol, from FAR on two; the
# 256 symbols reach to rank MOST_RANKS.
NEAR, FAR, MOST_RANKS = 160, 1 << 14, 1 << 21

_PLAIN_WORD = re.compile(rb" ?[A-Za-z]+\Z")


class WordList:
    """Distinct words of one slice as a byte buffer with begins and sizes."""

    def __init__(self, data: np.ndarray, start: np.ndarray, end: np.ndarray):
        self.data, self.start, self.size = data, start, end - start
        self.hash = T.span_hashes(data, start, end) if len(start) else np.zeros(0, np.uint64)

    def raw(self, which: np.ndarray) -> list[bytes]:
        buf = self.data.tobytes()
        s, e = self.start[which], self.start[which] + self.size[which]
        return [buf[a:b] for a, b in zip(s.tolist(), e.tolist())]


def split_slices(units, column: pa.Array) -> Iterator[tuple[int, np.ndarray, WordList, np.ndarray]]:
    """For each slice of rows: its first row, the code of every word, the
    distinct words, and the number of words before each row."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    coarse = np.zeros(len(column), bool)
    for a in units.added:
        coarse |= pc.match_substring(column, a).to_numpy(zero_copy_only=False)
    for t in T.slices(column, SLICE_BYTES):
        rows = coarse[t.first:t.first + t.rows] | not_plain(t)
        data = T.LOWER[t.data] if units.kind == "word" else t.data
        if not rows.any():
            start, end = pre_tokens(t, data, units.kind)
            first = np.searchsorted(start, t.offsets)
        else:                                        # words of each row by its own rule
            starts, ends, first = [], [], [0]
            for i in range(t.rows):
                a, b = int(t.offsets[i]), int(t.offsets[i + 1])
                if rows[i]:
                    parts = [len(u.encode()) for u in units.split(column[t.first + i].as_py())] \
                        if units.kind == "byte" else None
                    if parts is None:
                        one = T.Texts(0, t.data[a:b], np.array([0, b - a]))
                        w = T.words(one)
                        s, e = w.start, w.end
                    else:
                        e = np.cumsum(np.array(parts, np.int64))
                        s = e - np.array(parts, np.int64)
                else:
                    one = T.Texts(0, t.data[a:b], np.array([0, b - a]))
                    s, e = pre_tokens(one, data[a:b], units.kind)
                starts.append(s + a)
                ends.append(e + a)
                first.append(first[-1] + len(s))
            start, end, first = np.concatenate(starts), np.concatenate(ends), np.array(first)
            data = t.data
        codes, uniques = pd.factorize(T.span_hashes(data, start, end))
        place = np.zeros(len(uniques), np.int64)
        place[codes[::-1]] = np.arange(len(codes))[::-1]
        yield t.first, codes, WordList(data, start[place], end[place]), first


def word_table(docs: DataFrame, encoding: Encoding) -> DataFrame:
    """word binary, n long, ids binary (unsigned 32-bit, little-endian)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = units_for(encoding.path, encoding.kind)
        for batch in batches:
            held: dict[bytes, int] = {}
            for _, codes, found, _ in split_slices(units, batch.column(0)):
                n = np.bincount(codes, minlength=len(found.size)).tolist()
                for w, k in zip(found.raw(np.arange(len(n))), n):
                    held[w] = held.get(w, 0) + k
            if held:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())],
                    names=["word", "n"])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = units_for(encoding.path, encoding.kind)
        for batch in batches:
            words = batch.column("word").to_pylist()
            ids: list[bytes | None] = [units.encode_plain_unit(w) if _PLAIN_WORD.match(w) else None for w in words]
            rest = [i for i, x in enumerate(ids) if x is None]
            for i, x in zip(rest, units.encode_units([words[i].decode() for i in rest])):
                ids[i] = x
            yield pa.RecordBatch.from_arrays(
                [batch.column("word"), batch.column("n"), pa.array(ids, pa.binary())],
                names=["word", "n", "ids"])

    counted = (docs.select("text").mapInArrow(count, "word binary, n long")
               .groupBy("word").agg(F.sum("n").alias("n")))
    return saved(counted.mapInArrow(encode, "word binary, n long, ids binary"), "word_table")


def _octave(n: str = "n"):
    """Counts in steps of an eighth of a doubling: few hundred values in all."""
    return F.floor(F.log2(F.col(n)) * 8).cast("int")


def _flat(values: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, begins and sizes of a binary column, without a Python object each."""
    values = values.cast(pa.large_binary())
    _, offsets, data = values.buffers()
    edge = np.frombuffer(offsets, np.int64)[values.offset:values.offset + len(values) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, edge[:-1], np.diff(edge)


def _hashes(raw: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Hashes of consecutive strings, a slice at a time (the sums take eight
    bytes for each byte)."""
    out, first, end = [np.zeros(0, np.uint64)], 0, start + size
    while first < len(start):
        last = max(first + 1, int(np.searchsorted(end, start[first] + T.SLICE_BYTES, "right")))
        base = start[first]
        out.append(T.span_hashes(raw[base:end[last - 1]], start[first:last] - base, end[first:last] - base))
        first = last
    return np.concatenate(out)


class Head:
    """Frequent words, the most frequent first, with their ids; found by hash."""

    def __init__(self, words: pa.Array, ids: pa.Array, n: np.ndarray):
        by = np.argsort(-n, kind="stable")
        raw, start, size = _flat(words)
        hashes = _hashes(raw, start, size)[by]
        self.order = np.argsort(hashes).astype(np.int32)
        self.hash = hashes[self.order]
        self.blob = raw.copy()
        self.start, self.size = start[by].astype(np.int32), size[by].astype(np.int32)
        raw, start, size = _flat(ids)
        table, edge = gather(raw, start, size, by, np.arange(len(by) + 1))
        self.ids = np.concatenate((np.frombuffer(table.tobytes(), "<u4"), [HOLE])).astype("<u4")
        # One more entry for the words outside: a placeholder.
        self.begin = (edge >> 2).astype(np.int32)
        self.count = np.append(np.diff(edge) >> 2, 1).astype(np.int32)

    def find(self, words: WordList) -> np.ndarray:
        """Place of each word in the head, or -1."""
        if not len(self.hash) or not len(words.hash):
            return np.full(len(words.hash), -1)
        near = np.minimum(np.searchsorted(self.hash, words.hash), len(self.hash) - 1)
        at = self.order[near]
        same = (self.hash[near] == words.hash) & (self.size[at] == words.size)
        w = np.flatnonzero(same)
        size = words.size[w].astype(np.int64)
        k = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        differ = words.data[np.repeat(words.start[w], size) + k] != self.blob[np.repeat(self.start[at[w]], size) + k]
        first = np.concatenate(([0], np.cumsum(size)))
        same[w[T.per_row(differ, first) > 0]] = False
        return np.where(same, at, -1)

    def skeleton(self, ranks: np.ndarray) -> bytes:
        """Ranks of a text's words: one symbol a word, which is the whole rank of a
        frequent word and else says how many low bytes follow. Symbols and low
        bytes are compressed apart, as the latter are close to noise."""
        one, two = ranks >= NEAR, ranks >= FAR
        symbol = np.where(two, NEAR + (FAR >> 8) + (ranks >> 16), np.where(one, NEAR + (ranks >> 8), ranks))
        first = _codecs()[0].compress(symbol.astype(np.uint8).tobytes())
        low = (ranks[one] & 255).astype(np.uint8).tobytes() + (ranks[two] >> 8 & 255).astype(np.uint8).tobytes()
        packed = _codecs()[0].compress(low)
        return len(first).to_bytes(4, "little") + first + (packed if len(packed) < len(low) else low)

    def ranks(self, raw: bytes) -> np.ndarray:
        edge = 4 + int.from_bytes(raw[:4], "little")
        rank = np.frombuffer(_codecs()[1].decompress(raw[4:edge]), np.uint8).astype(np.int64)
        one, two = rank >= NEAR, rank >= NEAR + (FAR >> 8)
        n, low = int(one.sum()), raw[edge:]
        if len(low) < n + int(two.sum()):
            low = _codecs()[1].decompress(low)
        rank = np.where(two, (rank - NEAR - (FAR >> 8)) << 16, np.where(one, (rank - NEAR) << 8, rank))
        rank[one] |= np.frombuffer(low, np.uint8, n)
        rank[two] |= np.frombuffer(low, np.uint8, offset=n).astype(np.int64) << 8
        return rank


class Pieces:
    """Bytes of each id, as text piece and as decimal number with a comma."""

    def __init__(self, path: str, kind: str):
        units = units_for(path, kind)
        back = {c: b for b, c in enumerate(alphabet())}
        added = {i: t.content for i, t in units.tokenizer.get_added_tokens_decoder().items()}
        n = units.tokenizer.get_vocab_size()
        text, number = [], []
        for i in range(n):
            token = units.tokenizer.id_to_token(i) or ""
            text.append(token.encode() if i in added or any(c not in back for c in token)
                        else bytes(back[c] for c in token))
            number.append(b"%d," % i)
        self.text, self.number = self._table(text), self._table(number)

    @staticmethod
    def _table(values: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        size = np.array([len(v) for v in values], np.int64)
        return np.frombuffer(b"".join(values), np.uint8), np.cumsum(size) - size, size


def head_rule(table: DataFrame, head_words: int):
    """Which words of the table are in the head: the most frequent, at most
    ``head_words`` in all. Words over ``SHORT_BYTES`` bytes (whole texts may be
    words) are also held to ``LONG_SHARE`` bytes for each word of the head."""
    size = F.octet_length("word")
    short = size <= SHORT_BYTES
    long_bound = least_step(table.where(~short), _octave(), head_words * LONG_SHARE, weight=size)
    n_long = table.where(~short & (_octave() >= long_bound)).count()
    bound = least_step(table.where(short), _octave(), head_words - n_long)
    return F.when(short, _octave() >= bound).otherwise(_octave() >= long_bound)


def skeletons(docs: DataFrame, encoding: Encoding, head_words: int):
    """Every row with the ranks of its words (skeleton) and the ids of the words
    outside the head, each after its position in four bytes (found); and the head, sent to every task."""
    if head_words >= MOST_RANKS:
        raise ValueError(f"head_words must be below {MOST_RANKS}")
    spark = docs.sparkSession
    table = word_table(docs, encoding)
    in_head = head_rule(table, head_words)
    top = table.where(in_head).select("word", "ids", "n").toArrow()
    head = spark.sparkContext.broadcast(Head(
        top.column("word").combine_chunks(), top.column("ids").combine_chunks(), top.column("n").to_numpy()))
    del top

    def skeleton(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per row: the ranks of its words, and the words outside the head."""
        units, h = units_for(encoding.path, encoding.kind), head.value
        for batch in batches:
            for first_row, codes, found, first in split_slices(units, batch.column("text")):
                at = h.find(found)
                rank = np.where(at < 0, len(h.hash), at)[codes] if len(codes) else np.zeros(0, np.int64)
                rare_at = np.flatnonzero(rank == len(h.hash))
                rare = np.searchsorted(rare_at, first)
                words = found.raw(codes[rare_at])
                n = len(first) - 1
                rows = batch.slice(first_row, n)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), rows.column("h"),
                     pa.array([h.skeleton(rank[first[i]:first[i + 1]]) for i in range(n)], pa.binary()),
                     pa.array([words[rare[i]:rare[i + 1]] for i in range(n)], pa.list_(pa.binary()))],
                    names=["doc_id", "h", "skeleton", "rare"])

    rows = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("doc_id", "text").alias("h"))
    split = rows.mapInArrow(skeleton, "doc_id long, h long, skeleton binary, rare array<binary>")
    # Equal rows have equal words at equal places: one answer serves all of them.
    # Places are grouped by the join's own keys, so the answers stay where they are.
    keyed = split.withColumn("k", F.coalesce("doc_id", F.lit(0)))
    places = keyed.select("h", "k", F.posexplode("rare").alias("pos", "word"))
    at = F.unhex(F.lpad(F.hex("pos"), 8, "0"))
    answers = (places.join(table.where(~in_head).select("word", "ids"), "word")
               .groupBy("h", "k").agg(F.collect_set(F.concat(at, "ids")).alias("found")))
    joined = keyed.select("doc_id", "h", "k", "skeleton").join(answers, ["h", "k"], "left")

    return joined.select("doc_id", "skeleton", "found"), head


Batches = Iterator[pa.RecordBatch]


def _fill(head: Head, batches: Batches) -> Batches:
    """Ids of ranked words, and of the other words at their places: doc_id, ids."""
    for every in batches:
        for lo in range(0, every.num_rows, 500):
            batch, out = every.slice(lo, 500), []
            for raw, found in zip(batch.column("skeleton"), batch.column("found")):
                rank = head.ranks(raw.as_py())
                ids, _ = gather(head.ids, head.begin, head.count, rank, np.array([0, len(rank)]))
                if found.is_valid:
                    hole = np.flatnonzero(ids == HOLE)
                    # Position (big-endian, so bytes sort as numbers) and ids of each.
                    parts = [np.frombuffer(x, "<u4", offset=4) for x in sorted(found.as_py())]
                    keep = np.ones(len(ids), np.int64)
                    keep[hole] = [len(p) for p in parts]
                    to = np.cumsum(keep) - keep
                    full = np.repeat(ids, keep)
                    where = np.repeat(to[hole] - (np.cumsum(keep[hole]) - keep[hole]), keep[hole])
                    full[where + np.arange(len(where))] = np.concatenate(parts)
                    ids = full
                out.append(ids.astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.binary())],
                                             names=["doc_id", "ids"])


def _decode(pieces: Pieces, batches: Batches) -> Batches:
    """Join ids with their pieces: doc_id, ids, text."""
    for every in batches:
        for lo in range(0, every.num_rows, 500):
            batch = every.slice(lo, 500)
            arrays = [np.frombuffer(x.as_py(), "<u4") for x in batch.column("ids")]
            texts = [t.decode("utf-8", "replace") for t in decode_arrays(pieces, arrays)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("ids"), pa.array(texts, pa.string())],
                names=["doc_id", "ids", "text"])


def _digest(pieces: Pieces, batches: Batches) -> Batches:
    sha = lambda b: hashlib.sha256(b).hexdigest()
    for rows in batches:
        arrays = [np.frombuffer(x.as_py(), "<u4") for x in rows.column("ids")]
        yield pa.RecordBatch.from_arrays(
            [rows.column("doc_id"), pa.array([len(a) for a in arrays], pa.int64()),
             pa.array([sha(x[:-1]) for x in decode_arrays(pieces, arrays, "number")], pa.string()),
             pa.array([sha(t.as_py().encode()) for t in rows.column("text")], pa.string())],
            names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def encode_documents(docs: DataFrame, encoding: Encoding, head_words: int = HEAD_WORDS) -> DataFrame:
    """doc_id, ids (binary, unsigned 32-bit little-endian) of every row."""
    rows, head = skeletons(docs, encoding, head_words)
    return rows.mapInArrow(lambda batches: _fill(head.value, batches), "doc_id long, ids binary")


def decode_documents(encoded: DataFrame, encoding: Encoding) -> DataFrame:
    """Adds ``text``: the pieces of each row's ids, joined with the piece table.
    Bytes that are no UTF-8 become replacement characters, as in the library."""
    shared = encoded.sparkSession.sparkContext.broadcast(Pieces(encoding.path, encoding.kind))
    return encoded.mapInArrow(lambda batches: _decode(shared.value, batches),
                              "doc_id long, ids binary, text string")


def op8_digests(docs: DataFrame, encoding: Encoding, head_words: int = HEAD_WORDS) -> DataFrame:
    """Contract columns: counts and digests of the ids and of the decoded texts.
    Encoding, decoding and digests are one step of the plan: every step of its
    own would add a Python process to each core."""
    shared = docs.sparkSession.sparkContext.broadcast(Pieces(encoding.path, encoding.kind))
    rows, head = skeletons(docs, encoding, head_words)
    return rows.mapInArrow(
        lambda batches: _digest(shared.value, _decode(shared.value, _fill(head.value, batches))),
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


# Mark of a word that is not in the head; no id has this value.
HOLE = 0xFFFFFFFF


@lru_cache(maxsize=1)
def _codecs() -> tuple[zstandard.ZstdCompressor, zstandard.ZstdDecompressor]:
    return zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def decode_arrays(pieces: Pieces, arrays: list[np.ndarray], part: str = "text") -> list[bytes]:
    """The pieces (or numbers) of each array of ids, joined."""
    if not arrays:
        return []
    table = getattr(pieces, part)
    first = np.concatenate(([0], np.cumsum([len(a) for a in arrays])))
    flat = np.concatenate(arrays).astype(np.int64)
    out, edge = gather(*table, flat, first)
    raw = out.tobytes()
    return [raw[a:b] for a, b in zip(edge[:-1].tolist(), edge[1:].tolist())]
