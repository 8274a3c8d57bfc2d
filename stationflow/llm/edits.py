"""Operator 6: token counts that follow edits.

A text is cut into segments of about ``SEGMENT_BYTES`` at places where the
pre-token pattern always cuts: before a blank between two visible ASCII
characters. No pre-token and no added token reaches over such a place, so the
count of the text is the sum of the counts of its segments. A segment tree per
document holds the characters and tokens below each node. An edit replaces
``del`` characters at ``pos`` by ``ins``. Only the segments that it touches, and
a neighbour where it comes near a boundary, are encoded anew; then the sums on
the way to the root are brought up to date. Edits apply in order, each to the
text that the one before left.

``token_trees`` gives the leaves of the trees as a table to be kept; ``edit_trees``
applies a batch of edits to such a table and gives it back with the new leaves, so
a later batch encodes only what it touches. The sums above the leaves are
integers that a task adds up again without the tokenizer. ``count_edited`` does
both for texts whose trees nobody keeps.

Defined results: a null text is empty; null edits are none; a null ``ins`` is
empty; ``pos`` is brought into 0..length and ``del`` into 0..rest (null: 0); an
empty table gives no row; repeated rows are counted each on its own; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.llm import textarrays as T
from stationflow.llm.idfiles import Encoding
from stationflow.llm.store import saved, tidy
from stationflow.llm.units import SLICE_BYTES, Units, units_for

SEGMENT_BYTES = 256
EDITS_TYPE = "array<struct<pos:long,del:long,ins:string>>"
TREES = "doc_id long, segments array<string>, tokens array<long>"
COUNTS = "n_before long, n_after long, n_edits long, n_encoded_chars long, n_chars long"
SCHEMA = "doc_id long, n_before long, n_after long, n_edits long, n_encoded_chars long, n_chars long"


def _visible(d: np.ndarray) -> np.ndarray:
    return (d > 0x20) & (d < 0x7F)


def segment_offsets(t: T.Texts) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets of the segments of all rows, and the first segment of each row."""
    d = t.data
    safe = np.zeros(len(d), bool)
    if len(d) > 2:
        safe[1:-1] = (d[1:-1] == 0x20) & _visible(d[:-2]) & _visible(d[2:])
    safe[t.offsets[:-1][t.offsets[:-1] < len(d)]] = False
    # The first safe place of each step of SEGMENT_BYTES within a row.
    at = np.flatnonzero(safe)
    row = np.searchsorted(t.offsets, at, "right") - 1
    step = (at - t.offsets[row]) // SEGMENT_BYTES
    ok = step > 0
    at, row, step = at[ok], row[ok], step[ok]
    first = np.ones(len(at), bool)
    first[1:] = (row[1:] != row[:-1]) | (step[1:] != step[:-1])
    at, row = at[first], row[first]
    cuts = np.sort(np.concatenate((t.offsets[:-1], at)))
    per = 1 + np.bincount(row, minlength=t.rows)
    return np.append(cuts, len(d)), np.concatenate(([0], np.cumsum(per)))


class Tree:
    """Sums of characters and tokens over the segments of a document."""

    def __init__(self, texts: list[str], tokens: list[int]):
        self.texts = texts
        self.size = 1 << max(0, (len(texts) - 1).bit_length())
        self.chars = [0] * (2 * self.size)
        self.tokens = [0] * (2 * self.size)
        for i, (s, n) in enumerate(zip(texts, tokens)):
            self.chars[self.size + i], self.tokens[self.size + i] = len(s), n
        for k in range(self.size - 1, 0, -1):
            self._sum(k)

    def _sum(self, k: int) -> None:
        self.chars[k] = self.chars[2 * k] + self.chars[2 * k + 1]
        self.tokens[k] = self.tokens[2 * k] + self.tokens[2 * k + 1]

    def find(self, pos: int) -> tuple[int, int]:
        """Segment that holds character ``pos`` and the place in it; the end of
        the text belongs to the last segment."""
        if pos >= self.chars[1]:
            last = len(self.texts) - 1
            return last, pos - (self.chars[1] - self.chars[self.size + last])
        k = 1
        while k < self.size:
            k *= 2
            if pos >= self.chars[k]:
                pos -= self.chars[k]
                k += 1
        return k - self.size, pos

    def region(self, pos: int, cut: int, ins: str) -> tuple[int, int, str]:
        """Segments first..last that the edit makes stale, and their new text."""
        a, in_a = self.find(pos)
        b, in_b = self.find(pos + cut)
        first, last = a, b
        # A boundary stays one while the character before it and the two after
        # it stay. Nearer edits take the neighbour in.
        while first > 0 and in_a < 2:
            first -= 1
            in_a += len(self.texts[first])
        rest = len(self.texts[b]) - in_b
        while last + 1 < len(self.texts) and rest < 1:
            last += 1
            rest += len(self.texts[last])
        old = "".join(self.texts[first:last + 1])
        return first, last, old[:in_a] + ins + old[in_a + cut:]

    def replace(self, first: int, last: int, text: str, tokens: int) -> None:
        """The region becomes one segment; segments it took in are empty."""
        for i in range(first, last + 1):
            self.texts[i] = text if i == first else ""
            k = self.size + i
            self.chars[k] = len(self.texts[i])
            self.tokens[k] = tokens if i == first else 0
        nodes = {(self.size + i) // 2 for i in range(first, last + 1)}
        while nodes and 0 not in nodes:
            for k in nodes:
                self._sum(k)
            nodes = {k // 2 for k in nodes}

    @property
    def total(self) -> int:
        return self.tokens[1]

    @property
    def text(self) -> str:
        return "".join(self.texts)


def counts_of(units: Units, texts: list[str]) -> list[int]:
    out: list[int] = []
    for _, _, first in units.encode(pa.array(texts, pa.large_string())):
        out += np.diff(first).tolist()
    return out


def trees(units: Units, t: T.Texts) -> list[Tree]:
    """Trees of all rows of a slice; all their segments are encoded together."""
    offsets, first = segment_offsets(t)
    segments = pa.LargeStringArray.from_buffers(
        len(offsets) - 1, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(t.data.tobytes()))
    tokens: list[int] = []
    for _, _, begin in units.encode(segments):
        tokens += np.diff(begin).tolist()
    texts = segments.to_pylist()
    return [Tree(texts[a:b], tokens[a:b]) for a, b in zip(first[:-1].tolist(), first[1:].tolist())]


def apply_edits(units: Units, grown: list[Tree], edits: list[list[dict]]) -> list[int]:
    """Apply each document's edits in order, all documents a step at a time so
    that their regions are encoded together. Returns the characters encoded anew."""
    encoded = [0] * len(grown)
    for k in range(max(map(len, edits), default=0)):
        todo = []
        for i, (tree, own) in enumerate(zip(grown, edits)):
            if k < len(own):
                e = own[k] or {"pos": 0, "del": 0, "ins": ""}
                n = tree.chars[1]
                pos = min(max(e["pos"] or 0, 0), n)
                cut = min(max(e["del"] or 0, 0), n - pos)
                todo.append((i, *tree.region(pos, cut, e["ins"] or "")))
        for (i, first, last, text), n in zip(todo, counts_of(units, [x[3] for x in todo])):
            grown[i].replace(first, last, text, n)
            encoded[i] += len(text)
    return encoded


def count_edited(docs: DataFrame, encoding: Encoding) -> DataFrame:
    """Counts before and after the edits of column ``edits`` (``EDITS_TYPE``),
    with the characters that the edits made the tokenizer read again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = units_for(encoding.path, encoding.kind)
        for batch in batches:
            for t in T.slices(batch.column("text"), SLICE_BYTES):
                rows = batch.slice(t.first, t.rows)
                grown = trees(units, t)
                before = [g.total for g in grown]
                edits = [x or [] for x in rows.column("edits").to_pylist()]
                again = apply_edits(units, grown, edits)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), *(pa.array(v, pa.int64()) for v in (
                        before, [g.total for g in grown], list(map(len, edits)), again,
                        [g.chars[1] for g in grown]))],
                    names=["doc_id", "n_before", "n_after", "n_edits", "n_encoded_chars", "n_chars"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                       F.col("edits").cast(EDITS_TYPE).alias("edits"))
    return rows.mapInArrow(run, SCHEMA)


def token_trees(docs: DataFrame, encoding: Encoding, keep: str = "") -> DataFrame:
    """``TREES``: the segments of each document and the tokens in each, to be written
    and kept, and columns ``keep`` (as a schema) of ``docs``. A null text has one
    empty segment; repeated rows have a tree each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = units_for(encoding.path, encoding.kind)
        for batch in batches:
            for t in T.slices(batch.column("text"), SLICE_BYTES):
                yield _leaves(batch.slice(t.first, t.rows), trees(units, t), _names(keep))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *_names(keep))
    return rows.mapInArrow(tidy(run), ", ".join(filter(None, (TREES, keep))))


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ") if c]


def _leaves(rows: pa.RecordBatch, grown: list[Tree], keep: list[str],
            counts: dict[str, list[int]] | None = None) -> pa.RecordBatch:
    """The leaves of the trees that hold text (at least one), with further counts."""
    held = [[i for i, s in enumerate(g.texts) if s] or [0] for g in grown]
    return pa.RecordBatch.from_arrays(
        [rows.column("doc_id"),
         pa.array([[g.texts[i] for i in h] for g, h in zip(grown, held)], pa.list_(pa.string())),
         pa.array([[g.tokens[g.size + i] for i in h] for g, h in zip(grown, held)], pa.list_(pa.int64())),
         *(rows.column(c) for c in keep), *(pa.array(v, pa.int64()) for v in (counts or {}).values())],
        names=["doc_id", "segments", "tokens", *keep, *(counts or {})])


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows of stored trees, about ``SLICE_BYTES`` of text at a time."""
    segments = batch.column("segments")
    ends = np.concatenate(([0], np.cumsum(pc.binary_length(segments.flatten()).to_numpy(zero_copy_only=False))))
    rows = np.cumsum(pc.list_value_length(segments).to_numpy(zero_copy_only=False))
    piece = ends[rows.astype(np.int64)] // SLICE_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def with_edits(stored: DataFrame, edits: DataFrame) -> DataFrame:
    """Stored trees with column ``edits`` from a table (doc_id, edits) that has one row
    per document; documents without a row get none, rows without a document go."""
    given = edits.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("edits").cast(EDITS_TYPE).alias("edits"))
    return stored.select("doc_id", "segments", "tokens").join(given, "doc_id", "left")


def edit_trees(stored: DataFrame, encoding: Encoding, keep: str = "") -> DataFrame:
    """``TREES`` after the edits of column ``edits``, columns ``keep`` (as a schema) and
    ``COUNTS``. Only the regions of the edits are encoded; documents without edits
    pass the tokenizer by."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = units_for(encoding.path, encoding.kind)
        for batch in batches:
            for rows in _pieces(batch):
                grown = [Tree(s, n) for s, n in zip(rows.column("segments").to_pylist(),
                                                    rows.column("tokens").to_pylist())]
                before = [g.total for g in grown]
                edits = [x or [] for x in rows.column("edits").to_pylist()]
                again = apply_edits(units, grown, edits)
                yield _leaves(rows, grown, _names(keep), {
                    "n_before": before, "n_after": [g.total for g in grown], "n_edits": list(map(len, edits)),
                    "n_encoded_chars": again, "n_chars": [g.chars[1] for g in grown]})

    rows = stored.select("doc_id", "segments", "tokens", *_names(keep),
                         F.col("edits").cast(EDITS_TYPE).alias("edits"))
    return rows.mapInArrow(tidy(run), ", ".join(filter(None, (TREES, keep, COUNTS))))


def op6_counts(docs: DataFrame, encoding: Encoding) -> DataFrame:
    """Two edits of every document as two batches on stored trees: the trees are
    written once, the second batch takes those that the first left straight from it,
    as nothing else reads them. Whoever edits again later writes them between."""
    pending = f"pending {EDITS_TYPE}"
    trees_of = token_trees(docs.select("doc_id", "text", derived_edits().alias("pending")), encoding, pending)
    first = edit_trees(saved(trees_of, "token_trees").withColumn("edits", F.slice("pending", 1, 1)),
                       encoding, pending)
    done = first.select("doc_id", "segments", "tokens", F.slice("pending", 2, 1).alias("edits"),
                        F.col("n_before").alias("n0"), F.col("n_edits").alias("e0"), F.col("n_encoded_chars").alias("c0"))
    second = edit_trees(done, encoding, "n0 long, e0 long, c0 long")
    return second.select("doc_id", F.col("n0").alias("n_before"), "n_after", (F.col("e0") + F.col("n_edits")).alias("n_edits"),
                         (F.col("c0") + F.col("n_encoded_chars")).alias("n_encoded_chars"), "n_chars")


def derived_edits(text: str = "text"):
    """Two edits for any text, made from the text itself: a run of characters is
    replaced by the first line of the text, then up to 24 characters go."""
    n = F.coalesce(F.length(text), F.lit(0)).cast("long")
    h = lambda k: F.xxhash64(F.lit(k), text)
    return F.array(
        F.struct(F.pmod(h("a"), n + 1).alias("pos"), F.pmod(h("b"), F.lit(40)).alias("del"),
                 F.substring_index(text, "\n", 1).substr(1, 120).alias("ins")),
        F.struct(F.pmod(h("c"), n + 1).alias("pos"), F.pmod(h("d"), F.lit(25)).alias("del"),
                 F.lit("").alias("ins"))).cast(EDITS_TYPE)
