"""Linear models on hashed word and character n-grams.

A text's features are, for every family (word n-grams, character n-grams), the
shares that hashed n-grams have among all n-grams of the family. The score of a
text is then the sum over families of a mean of weights, which numpy works out
for a whole slice of texts without building a sparse row. Sparse rows are built
only for the rows that a model is trained on, whose number is bounded.

Training is by parameter mixing: Spark tasks run AdaGrad over their share of the
training rows, starting from the common weights; the weights are averaged, and
the next round starts there.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationflow.llm import textarrays as T
from stationflow.llm.store import hash_below, saved, tidy

# Tasks that share the training rows (more when a task would have more than
# ``PART_ROWS``), and rounds of mixing.
PARTS = 4
PART_ROWS = 1500
# Pieces in which the tasks' weights are averaged.
BLOCKS = 64
ROUNDS = 2
EPOCHS = 6
BATCH = 64
RATE = 0.5
SCALE = 16.0


@dataclass(frozen=True)
class Families:
    """Word and character n-gram lengths, and 2 ** bits weights for each."""

    words: tuple[int, ...] = (1, 2)
    chars: tuple[int, ...] = (3, 4)
    bits: int = 16

    @property
    def size(self) -> int:
        return (len(self.words) + len(self.chars)) << self.bits


def grams(t: T.Texts, f: Families) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each family: the weight number of every n-gram in order, and for each
    row the half-open range of its n-grams."""
    shift, base = np.uint64(64 - f.bits), 0
    if f.words:
        w = T.words(t)
        hashes = T.span_hashes(t.data, w.start, w.end) if len(w.start) else np.zeros(0, np.uint64)
    for n in f.words:
        h = hashes if n == 1 else T.combine(hashes, n)
        if n == 2:                                  # a word and itself: one n-gram for all words
            h = np.where(hashes[:len(h)] == hashes[1:len(h) + 1], np.uint64(1 << 63), h)
        lo = np.minimum(w.first[:-1], len(h))
        yield base + (h >> shift).astype(np.int64), lo, np.clip(w.first[1:] - n + 1, lo, len(h))
        base += 1 << f.bits
    for n in f.chars:
        m = max(0, len(t.data) - n + 1)
        h = np.zeros(m, np.uint64)
        for k in range(n):
            h |= t.data[k:k + m].astype(np.uint64) << np.uint64(8 * k)
        h *= np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        lo = np.minimum(t.offsets[:-1], m)
        yield base + (h >> shift).astype(np.int64), lo, np.clip(t.offsets[1:] - n + 1, lo, m)
        base += 1 << f.bits


def scores(t: T.Texts, f: Families, weights: np.ndarray) -> np.ndarray:
    """Score of each row, without the bias."""
    out = np.zeros(t.rows)
    for at, lo, hi in grams(t, f):
        total = np.zeros(len(at) + 1)
        np.cumsum(weights[at], out=total[1:])
        out += (total[hi] - total[lo]) / np.maximum(hi - lo, 1)
    return out * SCALE


@dataclass
class Rows:
    """Sparse training rows."""

    at: np.ndarray
    value: np.ndarray
    first: np.ndarray

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n = self.first[rows + 1] - self.first[rows]
        begin = np.cumsum(n) - n
        k = np.repeat(self.first[rows] - begin, n) + np.arange(n.sum())
        return self.at[k], self.value[k], np.append(begin, n.sum())


def sparse_rows(column: pa.Array, f: Families) -> Rows:
    at, value, count = [], [], []
    for t in T.slices(column, 1 << 18):
        keys, shares = [], []
        for a, lo, hi in grams(t, f):
            n = hi - lo
            k = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
            keys.append(np.repeat(np.arange(t.rows), n) * f.size + a[k])
            shares.append(np.repeat(SCALE / np.maximum(n, 1), n))
        key, back = np.unique(np.concatenate(keys), return_inverse=True)
        at.append((key % f.size).astype(np.int32))
        value.append(np.bincount(back, np.concatenate(shares), len(key)).astype(np.float32))
        count.append(np.bincount(key // f.size, minlength=t.rows))
    if not count:
        return Rows(np.zeros(0, np.int32), np.zeros(0, np.float32), np.zeros(1, np.int64))
    return Rows(np.concatenate(at), np.concatenate(value),
                np.concatenate(([0], np.cumsum(np.concatenate(count)))))


# Given margins and labels of the rows of a step: the derivative of the loss by
# each margin.
Slope = Callable[[np.ndarray, np.ndarray], np.ndarray]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def adagrad(rows: Rows, labels: np.ndarray, start: np.ndarray, slope: Slope,
            steps: Iterator[np.ndarray]) -> np.ndarray:
    """Minimize a loss of the margins; the last weight is the bias."""
    w = start.astype(np.float64).copy()
    seen = np.full(len(w), 1e-6)
    for pick in steps:
        at, value, first = rows.take(pick)
        prod = np.concatenate(([0.0], np.cumsum(w[at] * value)))
        margin = prod[first[1:]] - prod[first[:-1]] + w[-1]
        g = slope(margin, labels[pick])
        each = np.repeat(g, np.diff(first)) * value
        uniq, back = np.unique(at, return_inverse=True)
        grad = np.bincount(back, each, len(uniq))
        seen[uniq] += grad * grad
        w[uniq] -= RATE * grad / np.sqrt(seen[uniq])
        total = g.sum()
        seen[-1] += total * total
        w[-1] -= RATE * total / np.sqrt(seen[-1])
    return w


def training_rows(docs: DataFrame, labels: DataFrame, rows_per_class: int | None = None) -> DataFrame:
    """All labelled documents, or about ``rows_per_class`` of each class at most, those
    whose id's hash lies in the share of hashes that this number is of the class:
    columns doc_id, text, label, fold (0..4). ``labels`` has doc_id and label
    (others than 0 and 1 are left out; of several labels of a document the
    largest counts)."""
    known = (labels.where("doc_id IS NOT NULL AND label IN (0, 1)")
             .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.max("label").cast("int").alias("label"))
             .join(docs.select(F.col("doc_id").cast("long").alias("doc_id")), "doc_id", "left_semi"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if rows_per_class is None:
        joined = texts.join(known, "doc_id")
    else:
        known = saved(known, "labelled")
        size = {r.label: r["count"] for r in known.groupBy("label").count().collect()}
        h = F.xxhash64(F.lit("train"), "doc_id")
        picked = known.where(F.lit(False))
        for c, n in sorted(size.items()):
            picked = picked.unionByName(known.where((F.col("label") == c) & hash_below(h, rows_per_class / n)))
        # The two lists are bounded by the parameter, so they may go to every task.
        joined = texts.join(F.broadcast(picked), "doc_id")
    one = joined.groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    return saved(one.withColumn("fold", F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(5)).cast("int")),
                 "training")


def fit(train: DataFrame, f: Families, make_steps, slope: Slope, start: np.ndarray | None = None) -> np.ndarray:
    """Weights (and bias, last) mixed over the tasks. ``make_steps(labels, seed)``
    yields the row numbers of each step. Rows are dealt by doc_id to groups, as many as
    the rows ask for however many partitions there are, and ordered, so that equal rows
    give equal weights. The groups' weights are averaged piece by piece in tasks; the
    driver gets one vector."""
    spark = train.sparkSession
    w = np.zeros(f.size + 1) if start is None else start
    parts = max(PARTS, -(-train.count() // PART_ROWS))
    part = F.pmod(F.xxhash64(F.lit("deal"), "doc_id"), F.lit(parts)).cast("int")
    dealt = train.select("doc_id", "text", "label", part.alias("part")).groupBy("part")
    for r in range(ROUNDS):
        shared = spark.sparkContext.broadcast(w.astype(np.float32))

        def local(t: pa.Table) -> pa.Table:
            t = t.sort_by("doc_id")
            labels = t.column("label").to_numpy().astype(np.int64)
            got = []
            if len(np.unique(labels)) == 2:
                rows = sparse_rows(t.column("text").combine_chunks(), f)
                got = np.array_split(adagrad(rows, labels, shared.value, slope, make_steps(labels, r)).astype("<f4"), BLOCKS)
            return pa.table({"block": pa.array(range(len(got)), pa.int32()),
                             "part": pa.array([t.column("part")[0].as_py()] * len(got), pa.int32()),
                             "w": pa.array([x.tobytes() for x in got], pa.binary())})

        def one(t: pa.Table) -> pa.Table:
            return [*tidy(lambda own: [local(own)])(t)][0]

        def mean(t: pa.Table) -> pa.Table:
            own = [np.frombuffer(x.as_py(), "<f4") for x in t.sort_by("part").column("w")]
            return pa.table({"block": t.column("block")[:1],
                             "w": pa.array([np.mean(own, axis=0, dtype=np.float64).tobytes()], pa.binary())})

        found = sorted(dealt.applyInArrow(one, "block int, part int, w binary")
                       .groupBy("block").applyInArrow(mean, "block int, w binary").collect())
        if not found:
            break
        w = np.concatenate([np.frombuffer(x.w, "<f8") for x in found])
    return w


def margins(rows: DataFrame, f: Families, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Margins and labels of a bounded table of labelled rows, in order of margin."""
    got = score_table(rows.select("text", "label"), f, weights, "label int").select("label", "margin").collect()
    got.sort(key=lambda r: (r.margin, r.label))
    return np.array([r.margin for r in got]), np.array([r.label for r in got], np.int64)


def score_table(rows: DataFrame, f: Families, weights: np.ndarray, keep: str) -> DataFrame:
    """Columns ``keep`` (as a schema) of ``rows`` and ``margin``, by Arrow batches."""
    shared = rows.sparkSession.sparkContext.broadcast(weights.astype(np.float32))
    names = [c.split()[0] for c in keep.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for batch in batches:
            out = [scores(t, f, w[:-1]) + w[-1] for t in T.slices(batch.column("text"))]
            if out:
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in names), pa.array(np.concatenate(out))],
                    names=[*names, "margin"])

    return rows.mapInArrow(tidy(run), keep + ", margin double")


def logistic_steps(labels: np.ndarray, seed: int) -> Iterator[np.ndarray]:
    rng = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        order = rng.permutation(len(labels))
        for i in range(0, len(order), BATCH):
            yield order[i:i + BATCH]


def logistic_slope(margin: np.ndarray, labels: np.ndarray) -> np.ndarray:
    return (sigmoid(margin) - labels) / len(labels)


def pair_steps(labels: np.ndarray, seed: int) -> Iterator[np.ndarray]:
    """Steps of preference pairs: the first half of each step is preferred, row
    by row, to the second half."""
    rng = np.random.default_rng(seed)
    good, bad = np.flatnonzero(labels == 1), np.flatnonzero(labels == 0)
    n = max(len(good), len(bad))
    for _ in range(EPOCHS):
        a = np.resize(rng.permutation(good), n)
        b = np.resize(rng.permutation(bad), n)
        for i in range(0, n, BATCH // 2):
            yield np.concatenate((a[i:i + BATCH // 2], b[i:i + BATCH // 2]))


def pair_slope(margin: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Bradley-Terry: logistic loss of the differences of margins."""
    half = len(margin) // 2
    g = -sigmoid(margin[half:] - margin[:half]) / max(half, 1)
    return np.concatenate((g, -g))


def platt(margin: np.ndarray, labels: np.ndarray, weight: np.ndarray | None = None) -> tuple[float, float]:
    """a, b such that sigmoid(a * margin + b) is calibrated (Newton's method with
    smoothed targets)."""
    weight = np.ones(len(margin)) if weight is None else weight
    if len(np.unique(labels)) < 2:
        return 1.0, 0.0
    p, n = weight[labels == 1].sum(), weight[labels == 0].sum()
    target = np.where(labels == 1, (p + 1) / (p + 2), 1 / (n + 2))
    x = np.stack([margin, np.ones(len(margin))], 1)
    theta = np.array([1.0, 0.0]) / max(1.0, np.abs(margin).std())
    for _ in range(50):
        q = sigmoid(x @ theta)
        g = x.T @ (weight * (q - target))
        h = (x * (weight * q * (1 - q))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(h, g)
        step *= min(1.0, 2.0 / max(1e-12, np.abs(step).max()))
        theta = theta - step
        if np.abs(step).max() < 1e-8:
            break
    return float(theta[0]), float(theta[1])


# Digits in which sums over tables are exact, so that their order shows nowhere.
EXACT = "decimal(38, 18)"


def platt_table(scored: DataFrame, weight: dict[int, float]) -> tuple[float, float]:
    """``platt`` over a written table of any size (columns label, margin), with one
    weight for each label: every step sums in the tasks."""
    def sums(**terms: Column) -> dict[str, float]:
        row = scored.agg(*(F.sum(t.cast(EXACT)).alias(k) for k, t in terms.items())).first()
        return {k: float(row[k]) for k in terms}

    x, one = F.col("margin"), F.lit(1.0)
    good = F.col("label") == 1
    w = F.when(good, F.lit(weight[1])).otherwise(F.lit(weight[0]))
    s = sums(n=one, a=F.abs(x), aa=x * x, p=F.when(good, w).otherwise(0.0), w=w)
    p, n = s["p"], s["w"] - s["p"]
    target = F.when(good, F.lit((p + 1) / (p + 2))).otherwise(F.lit(1 / (n + 2)))
    spread = max(0.0, s["aa"] / s["n"] - (s["a"] / s["n"]) ** 2) ** 0.5
    theta = np.array([1.0, 0.0]) / max(1.0, spread)
    for _ in range(50):
        z = F.greatest(F.lit(-40.0), F.least(F.lit(40.0), x * float(theta[0]) + float(theta[1])))
        q = one / (one + F.exp(-z))
        miss, curve = w * (q - target), w * q * (one - q)
        s = sums(g1=miss * x, g0=miss, h2=curve * x * x, h1=curve * x, h0=curve)
        h = np.array([[s["h2"], s["h1"]], [s["h1"], s["h0"]]]) + 1e-6 * np.eye(2)
        step = np.linalg.solve(h, np.array([s["g1"], s["g0"]]))
        step *= min(1.0, 2.0 / max(1e-12, np.abs(step).max()))
        theta = theta - step
        if np.abs(step).max() < 1e-8:
            break
    return float(theta[0]), float(theta[1])


def quantiles(scored: DataFrame, rows: int, levels: int) -> np.ndarray:
    """The ``levels`` + 1 quantiles of all margins (interpolated as numpy does), by
    their places in the sorted table."""
    at = np.linspace(0, 1, levels + 1) * (rows - 1)
    low = np.floor(at).astype(np.int64)
    high = np.minimum(low + 1, rows - 1)
    wanted = {*low.tolist(), *high.tolist()}
    got = {i: r.margin for r, i in scored.select("margin").orderBy("margin").rdd.zipWithIndex()
           .filter(lambda x: x[1] in wanted).collect()}
    a, b = (np.array([got[i] for i in k.tolist()]) for k in (low, high))
    t = at - low
    return np.where(t < 0.5, a + (b - a) * t, b - (b - a) * (1 - t))
