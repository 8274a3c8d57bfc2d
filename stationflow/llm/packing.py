"""Operator 7: packing documents into sequences by non-negative least squares.

Everything is decided on the histogram of piece lengths (one number per length,
at most ``capacity`` of them): patterns of one to three lengths that fill a
sequence are enumerated, non-negative least squares finds how often each should
be used, the counts are rounded down to what the histogram holds, and the
lengths left over are packed best-fit, longest first, again by counts. The plan
is a list of patterns with counts. A piece finds its place by its rank among
the pieces of its length, so no piece ever passes through the driver.

Defined results: a null or empty text has only the end id; a document with more
than ``capacity`` ids is cut into pieces of ``capacity``, the first may be
shorter; rows that share a doc_id are packed each on its own; an empty table
gives no row; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationflow.llm.idfiles import Encoding
from stationflow.llm.store import saved, tidy
from stationflow.llm.units import units_for

CAPACITY = 1024
# Steps of the least squares solver, and of the ranking's finest pieces.
STEPS = 600
RANK_BUCKETS = 64
RANK_ROWS = 1_000_000

PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary, dealt long"
PLACED_SCHEMA = ("doc_id long, piece int, start long, length long, ids_crc32 long, "
                 "sequence_id long, offset long")

Plan = list[tuple[tuple[int, ...], int]]


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` ids."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def patterns(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Patterns over the given lengths, as rows of three lengths (0: none): each
    length alone, and pairs and triples that fill the capacity exactly or, for
    pairs, leave the least room."""
    have = np.zeros(capacity + 1, bool)
    have[lengths] = True
    best = np.zeros(capacity + 1, np.int64)         # the longest length that fits a room
    best[lengths] = lengths
    best = np.maximum.accumulate(best)
    out = [np.stack([lengths, 0 * lengths, 0 * lengths], 1)]
    mate = best[capacity - lengths]
    out.append(np.stack([lengths, mate, 0 * lengths], 1)[mate > 0])
    for a in lengths:                               # a >= b >= c > 0, a + b + c = capacity
        b = np.arange((capacity - a + 1) // 2, min(a, capacity - a - 1) + 1)
        b = b[b > 0]
        c = capacity - a - b
        good = have[b] & have[c]
        out.append(np.stack([np.full(good.sum(), a), b[good], c[good]], 1))
    every = -np.sort(-np.concatenate(out), axis=1)
    return np.unique(every, axis=0)


def least_squares(pats: np.ndarray, hist: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """Repeat counts x >= 0 of the patterns that bring the lengths they use near
    the histogram: accelerated projected gradient on weighted squares. Errors in
    longer lengths weigh more, as they leave more room unused; every pattern
    costs a little for the room it leaves."""
    n, size = len(pats), len(hist)
    weight = np.sqrt(np.arange(size) / size + 1e-3)
    scale = max(1.0, float(hist.max()))
    target = weight * hist / scale
    room = 1.0 - pats.sum(1) / (size - 1)
    rows = weight[pats] * (pats > 0)

    def forward(x):
        y = np.zeros(size)
        for k in range(3):
            y += np.bincount(pats[:, k], rows[:, k] * x, size)
        return y

    def backward(r):
        return (rows * r[pats]).sum(1)

    v = np.ones(n)
    for _ in range(30):                             # the largest eigenvalue bounds the step
        v = backward(forward(v))
        top = np.linalg.norm(v)
        v /= top
    x = z = np.zeros(n)
    t = 1.0
    for _ in range(steps):
        g = backward(forward(z) - target) + 1e-4 * room
        new = np.maximum(0.0, z - g / (top * 1.02))
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x * scale


def best_fit(hist: np.ndarray, capacity: int) -> Plan:
    """Best-fit, longest first, on counts: sequences of equal content move together."""
    rooms: dict[int, Counter] = {}
    for length in np.flatnonzero(hist)[::-1].tolist():
        left = int(hist[length])
        while left:
            fits = [r for r in rooms if r >= length and rooms[r]]
            if not fits:
                each = capacity // length
                if left >= each:
                    rooms.setdefault(capacity - each * length, Counter())[(length,) * each] += left // each
                if left % each:
                    k = left % each
                    rooms.setdefault(capacity - k * length, Counter())[(length,) * k] += 1
                break
            r = min(fits)
            held, n = next(iter(rooms[r].items()))
            used = min(n, left)
            left -= used
            rooms[r][held] -= used
            if not rooms[r][held]:
                del rooms[r][held]
            rooms.setdefault(r - length, Counter())[(*held, length)] += used
    return [(p, n) for c in rooms.values() for p, n in sorted(c.items()) if n]


def plan(hist: np.ndarray, capacity: int = CAPACITY) -> Plan:
    """Patterns and how often to use each, holding every piece of ``hist``
    (counts by length 0..capacity) once."""
    left = hist.astype(np.int64).copy()
    if left[1:].sum() == 0:
        return []
    out: Plan = []
    if left[capacity]:
        out.append(((capacity,), int(left[capacity])))
        left[capacity] = 0
    lengths = np.flatnonzero(left)
    if len(lengths):
        pats = patterns(lengths, capacity)
        x = least_squares(pats, left.astype(float))
        x *= pats.sum(1) >= 0.97 * capacity         # a pattern that leaves room is left to the residual
        for i in np.argsort(-x, kind="stable"):
            n = int(x[i] + 1e-9)
            if n == 0:
                break
            p = [int(v) for v in pats[i] if v]
            need = Counter(p)
            n = min(n, *(int(left[v]) // k for v, k in need.items()))
            if n > 0:
                out.append((tuple(p), n))
                for v, k in need.items():
                    left[v] -= k * n
        out += best_fit(left, capacity)
    return out


class Slots:
    """Where the r-th piece of a length goes: patterns own runs of ranks."""

    def __init__(self, planned: Plan):
        by: dict[int, list[tuple[int, int, int, int]]] = {}
        base = 0
        ranks: Counter = Counter()
        for pattern, n in planned:
            at, offsets = 0, {}
            for length in pattern:
                offsets.setdefault(length, []).append(at)
                at += length
            for length, places in offsets.items():
                # One run of ranks per place in the pattern.
                for place in places:
                    by.setdefault(length, []).append((ranks[length], base, place))
                    ranks[length] += n
            base += n
        self.runs = {k: tuple(np.array(c, np.int64) for c in zip(*v)) for k, v in by.items()}

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
        for v in np.unique(length):
            m = length == v
            first, base, place = self.runs[int(v)]
            k = np.searchsorted(first, rank[m], "right") - 1
            sequence[m] = base[k] + rank[m] - first[k]
            offset[m] = place[k]
        return sequence, offset


def pieces(docs: DataFrame, encoding: Encoding, capacity: int = CAPACITY) -> DataFrame:
    """Encoded pieces of all documents, with their ids. ``dealt`` spreads the
    pieces of one length over buckets for the ranking."""
    end = np.array([] if encoding.end_id is None else [encoding.end_id], "<u4")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = units_for(encoding.path, encoding.kind)
        for batch in batches:
            keys = batch.column(0)
            for first, ids, begin in units.encode(batch.column(1)):
                rows = []
                for i in range(len(begin) - 1):
                    a = np.concatenate((ids[begin[i]:begin[i + 1]], end)).astype("<u4")
                    key = keys[first + i].as_py()
                    for k, (s, n) in enumerate(cut(len(a), capacity) if len(a) else []):
                        raw = a[s:s + n].tobytes()
                        crc = zlib.crc32(raw)
                        rows.append((key, k, s, n, crc, raw, zlib.crc32(f"{key},{k}".encode(), crc)))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows), (
                            pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(),
                            pa.binary(), pa.int64()))],
                        names=["doc_id", "piece", "start", "length", "ids_crc32", "ids", "dealt"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(tidy(encode), PIECE_SCHEMA)


def place(piece_rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Give each piece its sequence and offset. Besides the columns of
    ``PLACED_SCHEMA`` the given rows need only ``dealt``."""
    sc = piece_rows.sparkSession.sparkContext
    hist = np.zeros(capacity + 1, np.int64)
    for r in piece_rows.groupBy("length").count().collect():     # at most ``capacity`` rows
        hist[r["length"]] = r["count"]
    slots = sc.broadcast(Slots(plan(hist, capacity)))
    buckets = max(RANK_BUCKETS, int(hist.sum()) // RANK_ROWS)
    dealt = piece_rows.select("doc_id", "piece", "start", "length", "ids_crc32",
                              F.pmod("dealt", F.lit(buckets)).alias("bucket"))
    before = (dealt.groupBy("length", "bucket").count()
              .withColumn("before", F.sum("count").over(
                  Window.partitionBy("length").orderBy("bucket")) - F.col("count"))
              .drop("count"))
    rank = F.row_number().over(Window.partitionBy("length", "bucket")
                               .orderBy("doc_id", "piece", "ids_crc32"))
    ranked = (dealt.withColumn("nth", rank.cast("long") - 1)
              .join(F.broadcast(before) if buckets == RANK_BUCKETS else before, ["length", "bucket"])
              .select("doc_id", "piece", "start", "length", "ids_crc32",
                      (F.col("nth") + F.col("before")).alias("rank")))

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sequence, offset = slots.value.place(b.column("length").to_numpy(), b.column("rank").to_numpy())
            yield pa.RecordBatch.from_arrays(
                [*(b.column(i) for i in range(5)), pa.array(sequence), pa.array(offset)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.mapInArrow(tidy(put), PLACED_SCHEMA)


def pack_documents(docs: DataFrame, encoding: Encoding, capacity: int = CAPACITY) -> tuple[DataFrame, DataFrame]:
    """The table of pieces with their ids (written once), and their places."""
    held = saved(pieces(docs, encoding, capacity), "pieces")
    return held, place(held, capacity)


def sequences(piece_rows: DataFrame, placed: DataFrame) -> DataFrame:
    """The packed sequences: sequence_id and its pieces in order of offset, at
    most ``capacity`` of them, with document, place and ids."""
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    joined = placed.join(piece_rows.select(*key, "ids").dropDuplicates(key), key)
    return joined.groupBy("sequence_id").agg(F.sort_array(F.collect_list(
        F.struct("offset", "doc_id", "piece", "length", "ids"))).alias("pieces"))
