"""Operator 10: toxicity by maximum-scoring segments of token log-odds.

1. Tokens are runs of letters, lower-cased. For each token of the training rows the
   log-odds between toxic and other documents are taken from the documents that hold
   it, under a Dirichlet prior of ``PRIOR`` documents for every token, split as the
   classes share all tokens. So a token seen once or twice says little, and every
   counted token has a signed score, however weak. A token that was never seen costs
   ``DRIFT``.
2. The scan of Ruzzo and Tompa finds all maximal scoring segments of a document in
   linear time: only tokens of positive score begin or end one, the others are in
   the running total; a candidate keeps a link to the nearest earlier one that
   starts lower, so none is passed over twice.
3. Extreme-value statistics (Karlin-Altschul) turn a segment's score into the
   number of such segments expected by chance in a clean text of that length.
   The evidence of the significant segments is summed and calibrated to a
   probability on training rows that the scores were not learned from: a
   logistic curve, placed such that 1/2 is the cut with the fewest errors.

Defined results: a null or empty text has no segment and the score of no
evidence; without labels of both kinds the score is the share of label 1 (0
without any); repeated rows are scored alike; an empty table gives no row;
extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.llm import hashed as H
from stationflow.llm import textarrays as T
from stationflow.llm.quality_rank import remainder
from stationflow.llm.store import tidy

# Training rows of each label at most; the tokens of these rows are all that the model holds.
ROWS_PER_CLASS = 20_000
STEMS = (4, 5, 6, 7, 8)
PRIOR = 2.0
# Log-odds of a significance (in standard deviations) like this count half.
FIRM = 8.0
DRIFT = 0.05
CUT = 0.5
# Scores of tokens are counted in steps of 1 / STEPS for the decay of chance scores.
STEPS = 64

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(0x80, 0x100)]] = True


@dataclass(frozen=True)
class Tokens:
    """Letter runs of a slice: distinct forms, and for every run its form."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    codes: np.ndarray
    place: np.ndarray       # a run of each form
    first: np.ndarray       # runs before each row


def fold(data: np.ndarray) -> np.ndarray:
    """Lower case for A-Z and for the Latin letters U+00C0-U+00DE."""
    out = T.LOWER[data]
    lead = np.flatnonzero(out[:-1] == 0xC3) + 1 if len(out) else np.zeros(0, np.int64)
    tail = out[lead]
    up = lead[(tail >= 0x80) & (tail <= 0x9E) & (tail != 0x97)]
    out[up] += 0x20
    return out


def tokens(t: T.Texts) -> Tokens:
    data = fold(t.data)
    inside = _LETTER[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[t.offsets] = True
    prev = np.concatenate(([False], inside[:-1])) if len(inside) else inside
    start = np.flatnonzero(inside & (~prev | edge[:-1]))
    after = np.concatenate((inside[1:], [False])) if len(inside) else inside
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    hashes = T.span_hashes(data, start, end) if len(start) else np.zeros(0, np.uint64)
    codes, distinct = pd.factorize(hashes)
    place = np.zeros(len(distinct), np.int64)
    place[codes[::-1]] = np.arange(len(codes))[::-1]
    return Tokens(data, start, end, codes, place, np.searchsorted(start, t.offsets))


def names(k: Tokens) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each kind of name (the whole form; its first ``STEMS`` bytes, to the end of
    a character): the forms that have it, and its hash."""
    start, end = k.start[k.place], k.end[k.place]
    if not len(start):
        return []
    out = [(np.arange(len(start)), T.span_hashes(k.data, start, end))]
    inside = np.append((k.data & 0xC0) == 0x80, np.zeros(4, bool))
    for n in STEMS:
        stop = start + n
        for _ in range(3):
            stop = stop + inside[np.minimum(stop, len(k.data))]
        long = np.flatnonzero(stop <= end)
        if len(long):
            out.append((long, T.mix(T.span_hashes(k.data, start[long], stop[long]) + np.uint64(n))))
    return out


@dataclass(frozen=True)
class Model:
    """Sorted hashes of names with their log-odds and significance, extreme-value
    parameters, and the calibration of the evidence."""

    hash: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    odds: np.ndarray = field(default_factory=lambda: np.zeros(0))
    z: np.ndarray = field(default_factory=lambda: np.zeros(0))
    rate: float = 1.0
    k: float = 1.0
    slope: float = 0.0
    bias: float = -30.0


def token_scores(k: Tokens, model: Model) -> np.ndarray:
    """Score of each token: the log-odds of its most significant name, as far as they
    are, or the drift."""
    if not len(k.codes):
        return np.zeros(0)
    best = np.full(len(k.place), -1.0)
    out = np.full(len(k.place), -DRIFT)
    if len(model.hash):
        for who, h in names(k):
            at = np.minimum(np.searchsorted(model.hash, h), len(model.hash) - 1)
            hit = (model.hash[at] == h) & (np.abs(model.z[at]) > best[who])
            best[who[hit]] = np.abs(model.z[at[hit]])
            out[who[hit]] = model.odds[at[hit]]
    return out[k.codes]


def maximal_segments(score: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, last, score) of a sequence of scores.
    Each candidate keeps the running total before it (left) and after it (right)
    and its link; a new one is joined to the nearest earlier one that starts lower,
    unless that one's end is at least as high."""
    total = np.concatenate(([0.0], np.cumsum(score)))
    at = np.flatnonzero(score > 0)
    held: list[tuple] = []              # first, last, left, right, link
    for p, left, right in zip(at.tolist(), total[at].tolist(), total[at + 1].tolist()):
        first, j = p, len(held) - 1
        while True:
            while j >= 0 and held[j][2] >= left:
                j = held[j][4]
            if j < 0 or held[j][3] >= right:
                break
            first, _, left, _, link = held[j]
            del held[j:]
            j = link
        held.append((first, p, left, right, j))
    return [(a, b, r - left) for a, b, left, r, _ in held]


@dataclass(frozen=True)
class Scored:
    """Tokens of a run of rows with their scores: token ``i`` of row ``r`` is at
    ``first[r] + i``."""

    score: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def segments(self) -> list[list[tuple[int, int, float]]]:
        """Maximal segments of each row, in tokens of the row."""
        return [maximal_segments(self.score[a:b]) for a, b in zip(self.first[:-1].tolist(), self.first[1:].tolist())]


def scored_tokens(t: T.Texts, model: Model) -> Scored:
    """A text longer than a slice is worked in pieces that end at white space."""
    if t.rows != 1 or len(t.data) <= T.SLICE_BYTES:
        k = tokens(t)
        return Scored(token_scores(k, model), k.start, k.end, k.first)
    parts = []
    for a, b in T.pieces(t.data, T.SLICE_BYTES):
        k = tokens(T.Texts(t.first, t.data[a:b], np.array([0, b - a])))
        parts.append((token_scores(k, model), k.start + a, k.end + a))
    score, start, end = map(np.concatenate, zip(*parts))
    return Scored(score, start, end, np.array([0, len(score)]))


def evidence(segments: list[tuple[int, int, float]], n: int, model: Model) -> float:
    """Sum over significant segments of -log of their expected number by chance."""
    floor = math.log(max(model.k * max(n, 1), 1e-12))
    return sum(e for _, _, s in segments if (e := model.rate * s - floor) > 0)


def solve_rate(values: np.ndarray, weights: np.ndarray) -> float:
    """The positive root of sum(w * exp(rate * value)) = sum(w): the decay of
    chance scores. Without one (no positive or no falling score) 1."""
    if not (values > 0).any() or (weights * values).sum() >= 0:
        return 1.0
    share = weights / weights.sum()
    lo, hi = 0.0, 1.0
    f = lambda r: (share * np.exp(np.minimum(r * values, 700))).sum() - 1
    while f(hi) < 0 and hi < 64:
        hi *= 2
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if f(mid) < 0 else (lo, mid)
    return max(hi, 1e-3)


def lexicon(rows: DataFrame) -> Model:
    """Log-odds of all names of the (bounded) training rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column("label").to_numpy()
            for t in T.slices(batch.column("text")):
                k = tokens(t)
                row = np.repeat(np.arange(t.rows), np.diff(k.first))
                for who, h in names(k):
                    # Each name once a document: names of the slice by number, 0 for none.
                    codes, distinct = pd.factorize(h)
                    number = np.zeros(len(k.place), np.int64)
                    number[who] = codes + 1
                    pair = np.unique(row * np.int64(len(distinct) + 1) + number[k.codes])
                    doc, name = pair // (len(distinct) + 1), pair % (len(distinct) + 1)
                    n1 = np.bincount(name, label[t.first + doc], len(distinct) + 1).astype(np.int64)[1:]
                    n = np.bincount(name, minlength=len(distinct) + 1)[1:]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(distinct.astype(np.int64)), pa.array(n - n1), pa.array(n1)], names=["h", "n0", "n1"])

    got = rows.select("text", "label").mapInArrow(tidy(count), "h long, n0 long, n1 long") \
        .groupBy("h").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toArrow()
    h, n0, n1 = (got.column(c).to_numpy() for c in ("h", "n0", "n1"))
    h, order = h.astype(np.uint64), np.argsort(h.astype(np.uint64))
    share = n1.sum() / max(n1.sum() + n0.sum(), 1)
    if not 0 < share < 1:
        return Model()
    one, zero = n1 + PRIOR * share, n0 + PRIOR * (1 - share)
    odds = np.log(one / share) - np.log(zero / (1 - share))
    # Significance: twice the log of the likelihood ratio against no difference.
    n = n0 + n1
    ratio = 2 * (n1 * np.log(np.maximum(n1, 1) / (n * share)) + n0 * np.log(np.maximum(n0, 1) / (n * (1 - share))))
    ratio = np.maximum(ratio, 0)
    return Model(h[order], (odds * ratio / (ratio + FIRM ** 2))[order], np.sqrt(ratio)[order])


def _observed(rows: DataFrame, model: Model) -> tuple[list, dict[int, int]]:
    """Per training row: label, tokens and the scores of all segments; and how often
    each score (in steps) of a token occurs in clean rows."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in T.slices(batch.column("text")):
                k = scored_tokens(t, shared.value)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("label").slice(t.first, t.rows), pa.array(np.diff(k.first)),
                     pa.array([[s for _, _, s in f] for f in k.segments()], pa.list_(pa.float64()))],
                    names=["label", "n", "scores"])

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in T.slices(batch.column("text")):
                own = np.rint(scored_tokens(t, shared.value).score * STEPS).astype(np.int64)
                step, n = np.unique(own, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(step), pa.array(n)], names=["step", "n"])

    seen = rows.select("text", "label").mapInArrow(run, "label int, n long, scores array<double>").collect()
    counted = rows.where("label = 0").select("text").mapInArrow(steps, "step long, n long") \
        .groupBy("step").agg(F.sum("n").alias("n")).collect()
    return seen, {r.step: r.n for r in counted}


def train(docs: DataFrame, labels: DataFrame, rows_per_class: int = ROWS_PER_CLASS) -> Model:
    """``labels`` has doc_id and label (1: toxic)."""
    shares = {r.label: r["count"] for r in labels.where("label IN (0, 1)").groupBy("label").count().collect()}
    if len(shares) < 2:
        return Model(bias=30.0 if shares.get(1) else -30.0)
    rows = H.training_rows(docs, labels, rows_per_class)
    words = lexicon(rows.where("fold > 0"))
    seen, steps = _observed(rows.where("fold = 0"), words)
    label = np.array([r.label for r in seen], np.int64)
    if len(np.unique(label)) < 2:
        return words
    clean = [r for r in seen if r.label == 0]
    rate = solve_rate(np.array(list(steps)) / STEPS, np.array(list(steps.values()), float))
    top = np.array([max(r.scores, default=0.0) for r in clean])
    size = np.array([max(r.n, 1) for r in clean])
    k = len(clean) / max((size * np.exp(-rate * top)).sum(), 1e-9)
    model = Model(words.hash, words.odds, words.z, rate, float(k))
    x = np.log1p([evidence([(0, 0, s) for s in r.scores], r.n, model) for r in seen])
    weight = np.where(label == 1, shares[1] / (label == 1).sum(), shares[0] / (label == 0).sum())
    slope, _ = H.platt(x, label, weight * len(label) / weight.sum())
    slope = max(slope, 1e-3)
    return Model(words.hash, words.odds, words.z, rate, float(k), slope, -slope * best_split(x, label, weight))


def best_split(x: np.ndarray, label: np.ndarray, weight: np.ndarray) -> float:
    """The cut with the least weighted error, in the middle between the nearest
    values (label 1 above); of equal ones the middle one."""
    values = np.unique(x)
    cuts = np.concatenate(([values[0] - 1], (values[1:] + values[:-1]) / 2, [values[-1] + 1]))
    order = np.argsort(x, kind="stable")
    one = np.concatenate(([0], np.cumsum((weight * (label == 1))[order])))
    zero = np.concatenate(([0], np.cumsum((weight * (label == 0))[order])))
    below = np.searchsorted(x[order], cuts)
    error = one[below] + zero[-1] - zero[below]
    best = np.flatnonzero(error <= error.min() + 1e-12)
    return float(cuts[best[len(best) // 2]])


def probability(segments: list[tuple[int, int, float]], n: int, model: Model) -> float:
    return float(H.sigmoid(np.array(model.slope * math.log1p(evidence(segments, n, model)) + model.bias)))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, predicted, n_passages (significant segments)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for t in T.slices(batch.column("text")):
                k = scored_tokens(t, m)
                found, n = k.segments(), np.diff(k.first).tolist()
                p = np.array([probability(f, c, m) for f, c in zip(found, n)])
                passages = [sum(m.rate * s > math.log(max(m.k * max(c, 1), 1e-12)) for _, _, s in f)
                            for f, c in zip(found, n)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(t.first, t.rows), pa.array(p),
                     pa.array((p >= CUT).astype(np.int32)), pa.array(passages, pa.int64())],
                    names=["doc_id", "score", "predicted", "n_passages"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        tidy(run), "doc_id long, score double, predicted int, n_passages long")


def passages(docs: DataFrame, model: Model) -> DataFrame:
    """The significant segments: doc_id, start and end (bytes of the UTF-8 text),
    passage, score, expected (number of such segments by chance)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            keys = batch.column("doc_id").to_pylist()
            out = []
            for t in T.slices(batch.column("text")):
                k = scored_tokens(t, m)
                for i, own in enumerate(k.segments()):
                    n, base = int(k.first[i + 1] - k.first[i]), int(k.first[i])
                    for a, b, s in own:
                        expected = m.k * n * math.exp(-m.rate * s)
                        if expected < 1:
                            lo, hi = int(k.start[base + a]), int(k.end[base + b])
                            row = int(t.offsets[i])
                            out.append((keys[t.first + i], lo - row, hi - row,
                                        t.data[lo:hi].tobytes().decode("utf-8", "replace"), s, expected))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, ty) for c, ty in zip(zip(*out), (
                        pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.float64()))],
                    names=["doc_id", "start", "end", "passage", "score", "expected"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, start long, end long, passage string, score double, expected double")


def op10_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    known = labels.select("doc_id", F.col("toxic").alias("label")).where(remainder(5) != 0)
    return score(docs, train(docs, known)).select(
        "doc_id", F.coalesce(remainder(5) == 0, F.lit(False)).alias("held_out"),
        "score", "predicted", "n_passages")
