"""Operator 3: quality classifier by Bradley-Terry ranking.

Training pairs prefer a document of label 1 to one of label 0; the logistic loss
of the difference of their features gives every text a score. The threshold is a
quantile of the scores of held-back training rows: the level at which the fewest
of them, weighted to the labels' true shares, lie on the wrong side. The score
is mapped to 0..1 such that the threshold becomes ``CUT``.

Defined results: a null text is empty and gets the score of a text without
n-grams; without labels of both kinds every score is ``CUT``; every row is
scored by its own text; an empty table gives no row; extra columns are ignored
by ``score`` and kept by ``keep``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.llm import hashed as H
from stationflow.llm import textarrays as T
from stationflow.llm.store import saved, tidy

FAMILIES = H.Families(words=(1, 2), chars=(3, 5))
CUT = 0.7
LEVELS = 400


@dataclass(frozen=True)
class Model:
    weights: np.ndarray | None
    threshold: float = 0.0
    slope: float = 1.0


def quantile_threshold(scored: DataFrame, rows: int, weight: dict[int, float]) -> float:
    """The quantile of the scores with the least weighted error over all rows of the
    written table ``scored`` (label, margin); of several neighbouring best levels the
    middle one. The driver gets the levels and a count for each."""
    levels = H.quantiles(scored, rows, LEVELS)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            passed = np.searchsorted(levels, b.column("margin").to_numpy(), "right")
            yield pa.RecordBatch.from_arrays([b.column("label"), pa.array(passed, pa.int64())], names=["label", "passed"])

    count = np.zeros((2, len(levels) + 1), np.int64)
    for r in scored.select("label", "margin").mapInArrow(place, "label int, passed long").groupBy("label", "passed").count().collect():
        count[r.label, r.passed] = r["count"]
    # A row is above a level if it has passed it: bad ones above and good ones below are wrong.
    below = count.cumsum(axis=1)[:, :-1]
    error = weight[1] * below[1] + weight[0] * (count[0].sum() - below[0])
    best = np.flatnonzero(error <= error.min() + 1e-12)
    return float(levels[best[len(best) // 2]])


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """``labels`` has doc_id and label (1: good). Weights, slope and threshold come
    from all labelled rows: four fifths for the weights, the others for the rest."""
    rows = H.training_rows(docs, labels)
    shares = {r.label: r["count"] for r in labels.where("label IN (0, 1)").groupBy("label").count().collect()}
    if len(shares) < 2:
        return Model(None)
    weights = H.fit(rows.where("fold > 0"), FAMILIES, H.pair_steps, H.pair_slope)
    scored = saved(H.score_table(rows.where("fold = 0").select("text", "label"), FAMILIES, weights, "label int"),
                   "margins")
    held = {r.label: r["count"] for r in scored.groupBy("label").count().collect()}
    if len(held) < 2:
        return Model(weights)
    n = sum(held.values())
    weight = {c: shares[c] / held[c] for c in (0, 1)}
    each = {c: weight[c] * n / sum(shares.values()) for c in (0, 1)}
    slope, _ = H.platt_table(scored, each)
    return Model(weights, quantile_threshold(scored, n, weight), max(slope, 1e-6))


def text_scores(t: T.Texts, model: Model) -> np.ndarray:
    if model.weights is None:
        return np.full(t.rows, CUT)
    margin = H.scores(t, FAMILIES, model.weights[:-1]) + model.weights[-1]
    # The threshold maps to CUT exactly: sigmoid(log(CUT / (1 - CUT))) = CUT.
    p = H.sigmoid(model.slope * (margin - model.threshold) + np.log(CUT / (1 - CUT)))
    return np.where(margin >= model.threshold, np.maximum(p, CUT), np.minimum(p, np.nextafter(CUT, 0)))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in T.slices(batch.column("text")):
                p = text_scores(t, shared.value)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(t.first, t.rows), pa.array(p), pa.array((p >= CUT).astype(np.int32))],
                    names=["doc_id", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        tidy(run), "doc_id long, score double, predicted int")


def keep(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that are predicted good, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [text_scores(t, shared.value) >= CUT for t in T.slices(batch.column("text"))]
            if kept:
                yield batch.filter(pa.array(np.concatenate(kept)))

    return docs.mapInArrow(tidy(run), docs.schema)


def remainder(modulus: int):
    """crc32 of the doc_id as text, modulo ``modulus`` (null for a null id)."""
    return F.pmod(F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")), F.lit(modulus))


def op3_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    known = labels.select("doc_id", F.col("quality").alias("label")).where(remainder(4) != 2)
    return score(docs, train(docs, known)).select(
        "doc_id", F.coalesce(remainder(4) == 2, F.lit(False)).alias("held_out"), "score", "predicted")
