"""Operator 1: quality rules.

Fixed rules on counts of a whole text, then a logistic regression on hashed word
and character n-grams. The regression is trained on labelled rows (at most
``ROWS_PER_CLASS`` of each label), its probability is calibrated on rows that it
was not trained on, weighted to the labels' true shares, and compared with a
fixed threshold. Texts are counted and scored in Arrow batches.

Defined results: a null text is empty: it has no words, fails the base rules and
is not kept; every row is judged by its own text, repeated rows alike; without
labels of both kinds the base rules alone decide; an empty table gives no row;
extra columns are ignored by ``judge`` and kept by ``keep``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.llm import hashed as H
from stationflow.llm import textarrays as T
from stationflow.llm.store import tidy

FAMILIES = H.Families(words=(1, 2), chars=(3, 4))
ROWS_PER_CLASS = 3000
THRESHOLD = 0.5
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_ROW = np.uint64(0x9E3779B97F4A7C15)

SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
          "n_repeat_words long, base_failed boolean, kept boolean, probability double")


@dataclass(frozen=True)
class Model:
    """Weights with bias, and the calibration of the margin (none: no labels)."""

    weights: np.ndarray | None
    slope: float = 1.0
    bias: float = 0.0


def _keys(row: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Hashes that differ between rows."""
    return T.mix(hashes + row.astype(np.uint64) * _ROW)


def duplicate_lines(t: T.Texts) -> np.ndarray:
    """Lines with a word that equal an earlier line of their row."""
    newline = np.flatnonzero(t.data == 10)
    start = np.sort(np.concatenate((t.offsets[:-1], newline + 1)))
    end = np.sort(np.concatenate((t.offsets[1:], newline)))
    row = np.repeat(np.arange(t.rows), 1 + T.per_row(t.data == 10, t.offsets))
    inside = np.concatenate(([0], np.cumsum(~T.SPACE[t.data])))
    ok = inside[end] > inside[start]
    start, end, row = start[ok], end[ok], row[ok]
    if not len(start):
        return np.zeros(t.rows, np.int64)
    codes, distinct = pd.factorize(_keys(row, T.span_hashes(t.data, start, end)))
    owner = np.zeros(len(distinct), np.int64)
    owner[codes] = row
    return np.bincount(row, minlength=t.rows) - np.bincount(owner, minlength=t.rows)


def repeated_words(w: T.Words, hashes: np.ndarray, rows: int) -> np.ndarray:
    """Words in windows of ``WINDOW`` words that their row has more than once."""
    at = T.windows(w, WINDOW)
    if not len(at):
        return np.zeros(rows, np.int64)
    codes, distinct = pd.factorize(_keys(w.row[at], T.combine(hashes, WINDOW)[at]))
    twice = at[np.bincount(codes, minlength=len(distinct))[codes] > 1]
    step = np.zeros(len(w.row) + 1, np.int64)
    np.add.at(step, twice, 1)
    np.add.at(step, twice + WINDOW, -1)
    return T.per_row(np.cumsum(step[:-1]) > 0, w.first)


def measure(t: T.Texts, model: Model) -> list[np.ndarray]:
    """The columns of ``SCHEMA`` after doc_id, for a slice of texts."""
    w = T.words(t)
    hashes = T.span_hashes(t.data, w.start, w.end) if len(w.start) else np.zeros(0, np.uint64)
    n_words = np.diff(w.first)
    n_repeat = repeated_words(w, hashes, t.rows)
    failed = (n_words < MIN_WORDS) | (100 * n_repeat > MAX_REPEAT_PERCENT * n_words)
    if model.weights is None:
        p = np.ones(t.rows)
    else:
        margin = H.scores(t, FAMILIES, model.weights[:-1]) + model.weights[-1]
        p = H.sigmoid(model.slope * margin + model.bias)
    chars = ((t.data & 0xC0) != 0x80) & ~T.SPACE[t.data]
    return [n_words, T.per_row(chars, t.offsets), T.per_row(_SYMBOL[t.data], t.offsets),
            duplicate_lines(t), n_repeat, failed, ~failed & (p >= THRESHOLD), p]


def train(docs: DataFrame, labels: DataFrame, rows_per_class: int = ROWS_PER_CLASS) -> Model:
    """Fit and calibrate; ``labels`` has doc_id and label (1: good)."""
    rows = H.training_rows(docs, labels, rows_per_class)
    shares = {r.label: r["count"] for r in labels.where("label IN (0, 1)").groupBy("label").count().collect()}
    if len(shares) < 2:
        return Model(None)
    weights = H.fit(rows.where("fold > 0"), FAMILIES, H.logistic_steps, H.logistic_slope)
    margin, label = H.margins(rows.where("fold = 0"), FAMILIES, weights)
    if len(np.unique(label)) < 2:
        return Model(weights)
    weight = np.where(label == 1, shares[1] / (label == 1).sum(), shares[0] / (label == 0).sum())
    return Model(weights, *H.platt(margin, label, weight * len(label) / weight.sum()))


def judge(docs: DataFrame, model: Model) -> DataFrame:
    """Counts, verdict of the rules and probability of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in T.slices(batch.column("text")):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(t.first, t.rows), *map(pa.array, measure(t, shared.value))],
                    names=[c.split()[0] for c in SCHEMA.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(tidy(run), SCHEMA)


def keep(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [measure(t, shared.value)[6] for t in T.slices(batch.column("text"))]
            if kept:
                yield batch.filter(pa.array(np.concatenate(kept)))

    return docs.mapInArrow(tidy(run), docs.schema)
