"""Operator 12: MinHash near-duplicate removal by min-max hashing.

1. One pass hashes every document's shingle set under ``PERMUTATIONS`` permutations
   and keeps the minimum and the maximum of each, so a signature of twice as many
   values costs one evaluation a permutation. Either value agrees between two sets
   with the probability of their Jaccard similarity, so their mean is unbiased.
   Documents with equal sets are one class, by 128 bits of the set.
2. Bands of ``ROWS`` minima, and bands of ``ROWS`` maxima, are hashed; classes that
   share a band are candidates. At 85 % a pair of classes shares no band of the 32
   with probability 7e-9 (at 80 %: 3e-6).
3. In every band bucket each class is held against the bucket's leader, its smallest
   class: signatures first (pairs whose signatures agree less than nine deviations
   below the threshold go), then the whole sets. Confirmed pairs are edges; a group
   of near copies falls together here, in work linear in its size.
4. In buckets that still hold several components, every pair of classes that are not
   both in the largest one is compared in the same two steps, in tiles of blocks
   of about ``BLOCK``. So no candidate is left out, and no pair is written.
5. Connected components of all edges; of each component one document stays.

Defined results: a document without words has the empty set, links with nothing and
stays; with fewer words than ``n`` the whole sequence is the one shingle; a null
text is empty; a text of any length is hashed a piece at a time; rows that share
doc_id are separate documents; a null doc_id takes part, a component's id is its
smallest non-null doc_id (null if it has none), and ``kept`` says that the two ids
are the same; an empty table gives no row; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.llm import textarrays as T
from stationflow.llm.jaccard import _by_tile, _distinct_columns, _link_tile, _longs, roots, shingle_sets, signature, star_edges, star_rounds
from stationflow.llm.store import joined_by_class, saved, tidy
from stationflow.session import broadcast_max_rows

WORDS = 3
PERCENT = 85
PERMUTATIONS = 80
ROWS = 5
BLOCK = 256
# Rounds of stars on the leaders' edges before the rest is compared; more would only
# spare comparisons.
EARLY_ROUNDS = 2
# Values of a signature, four bytes each.
VALUES = 2 * PERMUTATIONS
# Deviations below the threshold from which a pair of signatures is dropped.
DEVIATIONS = 9

_ODD = np.random.default_rng(12).integers(0, 1 << 63, PERMUTATIONS, np.uint64) * np.uint64(2) + np.uint64(1)
_MEMBER = "h long, ti long, tj long, block long, s1 long, s2 long"


def min_max(sets: list[np.ndarray]) -> np.ndarray:
    """The smallest and largest value of every non-empty set under each permutation
    (multiplication by an odd number modulo 2 ** 64): sets x 2 x permutations."""
    first = np.concatenate(([0], np.cumsum([len(s) for s in sets])))[:-1]
    every = T.mix(np.concatenate(sets))
    out = np.empty((len(sets), 2, PERMUTATIONS), np.uint64)
    for k, odd in enumerate(_ODD):
        moved = every * odd
        out[:, 0, k] = np.minimum.reduceat(moved, first)
        out[:, 1, k] = np.maximum.reduceat(moved, first)
    return out


def bands(values: np.ndarray) -> np.ndarray:
    """Hashes of the bands of minima, then of maxima; equal only for equal bands of
    the same number."""
    cut = values.reshape(len(values), VALUES // ROWS, ROWS)
    out = np.zeros(cut.shape[:2], np.uint64)
    for r in range(ROWS):
        out = T.mix(out * np.uint64(0x9FB21C651E98DF25) + cut[:, :, r])
    return T.mix(out + np.arange(1, cut.shape[1] + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def sketch(values: np.ndarray) -> np.ndarray:
    """The values as 32 bits each."""
    return (T.mix(values.reshape(len(values), VALUES)) >> np.uint64(32)).astype(np.uint32)


def agreement_needed(percent: int) -> float:
    share = percent / 100
    return share - DEVIATIONS * math.sqrt(share * (1 - share) / VALUES)


def _describe(n_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in T.slices(batch.column("text")):
                sets = shingle_sets(t, n_words)
                some = [i for i, s in enumerate(sets) if len(s)]
                keys: list = [None] * t.rows
                marks: list = [None] * t.rows
                if some:
                    values = min_max([sets[i] for i in some])
                    for i, b, s in zip(some, bands(values).astype(np.int64), sketch(values)):
                        keys[i], marks[i] = b, s.tobytes()
                sig = [signature(s) for s in sets]
                rows = batch.slice(t.first, t.rows)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), rows.column("th"), pa.array([len(s) for s in sets], pa.int64()),
                     _longs(sig, 0), _longs(sig, 1), pa.array(keys, pa.list_(pa.int64())),
                     pa.array(marks, pa.binary())],
                    names=["doc_id", "th", "n", "s1", "s2", "bands", "sketch"])
    return run


def described(docs: DataFrame, n_words: int = WORDS) -> DataFrame:
    """doc_id, th (hash of the text), n (size of the set), s1 and s2 (its class),
    bands and sketch of every document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("th"))
    return saved(rows.mapInArrow(
        tidy(_describe(n_words)),
        "doc_id long, th long, n long, s1 long, s2 long, bands array<long>, sketch binary"), "minmax_signatures")


def _sketch_tile(percent: int):
    """Rows (block, s1, s2, sketch): the classes of a tile with a pair left."""

    def solve(h: int, cross: bool, rows: list[tuple]) -> pa.RecordBatch | None:
        block = np.array([r[0] for r in rows])
        marks = np.frombuffer(b"".join(r[3] for r in rows), np.uint32).reshape(len(rows), VALUES)
        need = agreement_needed(percent) * VALUES
        left = np.zeros(len(rows), bool)
        # Against a leader there is one row to go through, else all of one block.
        for i in np.flatnonzero(block == block.min()) if cross else range(len(rows) - 1):
            other = np.flatnonzero(block != block[i]) if cross else np.arange(i + 1, len(rows))
            near = other[(marks[other] == marks[i]).sum(1) >= need]
            left[near] = True
            left[i] |= len(near) > 0
        who = [rows[i] for i in np.flatnonzero(left)]
        if not who:
            return None
        at = [(h, r[4], r[5], r[0], r[1], r[2]) for r in who]
        return pa.RecordBatch.from_arrays([_longs(at, k) for k in range(6)],
                                          names=["h", "ti", "tj", "block", "s1", "s2"])

    return solve


def _in_tiles(tiles: DataFrame, columns: list[str], solve, schema: str) -> DataFrame:
    return (tiles.repartition("h", "ti", "tj").sortWithinPartitions("h", "ti", "tj")
            .mapInArrow(tidy(_by_tile(columns, solve)), schema))


def _sets(n_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in T.slices(batch.column("text")):
                rows = batch.slice(t.first, t.rows)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("s1"), rows.column("s2"),
                     pa.array([s.tobytes() for s in shingle_sets(t, n_words)], pa.binary())],
                    names=["s1", "s2", "shingles"])
    return run


def whole_sets(docs: DataFrame, classes: DataFrame, wanted: DataFrame, n_words: int) -> DataFrame:
    """(s1, s2, shingles) of the wanted classes, from the text of one document each."""
    giver = saved(classes.select("s1", "s2", F.col("doc_id").alias("d"), F.col("th").alias("t"))
                  .join(wanted, ["s1", "s2"], "left_semi"), "minmax_givers")
    if giver.count() <= broadcast_max_rows(docs.sparkSession):      # four numbers a row
        giver = F.broadcast(giver)
    texts = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("th"))
             .join(giver, F.expr("th <=> t AND doc_id <=> d")).select("s1", "s2", "text"))
    return texts.mapInArrow(tidy(_sets(n_words)), "s1 long, s2 long, shingles binary").dropDuplicates(["s1", "s2"])


def _confirmed(docs: DataFrame, classes: DataFrame, tiles: DataFrame, n_words: int, percent: int,
               name: str) -> DataFrame:
    """Edges between classes that link, of all pairs of the tiles: signatures first,
    then whole sets."""
    marked = tiles.join(classes.select("s1", "s2", "sketch"), ["s1", "s2"])
    # The tile's numbers go with the rows, so that its survivors keep them.
    near = saved(_in_tiles(marked.withColumns({"a": F.col("ti"), "b": F.col("tj")}),
                           ["block", "s1", "s2", "sketch", "a", "b"], _sketch_tile(percent), _MEMBER), name + "_near")
    sets = whole_sets(docs, classes, near.select("s1", "s2"), n_words)
    full = near.join(sets, ["s1", "s2"]).withColumn("cols", F.array().cast("array<long>"))
    return saved(_in_tiles(full, ["block", "s1", "s2", "shingles", "cols"], _link_tile(percent, False),
                           "a1 long, a2 long, b1 long, b2 long, n_links long").drop("n_links"), name + "_edges")


def _leader_tiles(members: DataFrame) -> DataFrame:
    """Every class of a bucket against the bucket's leader: tiles of the leader and
    a block of the classes that have it as a leader."""
    lead = members.groupBy("h").agg(F.min(F.struct("s1", "s2")).alias("lead"))
    pairs = saved(members.join(lead, "h").where("s1 <> lead.s1 OR s2 <> lead.s2")
                  .select(F.col("lead.s1").alias("l1"), F.col("lead.s2").alias("l2"), "s1", "s2").distinct(),
                  "minmax_leaders")
    # As many blocks as the leader with the most classes needs; the others' classes are
    # spread over them, and a leader goes only where it has one.
    most = pairs.groupBy("l1", "l2").count().agg(F.max("count")).first()[0] or 0
    block = F.pmod(F.xxhash64("s1", "s2"), F.lit(-(-most // BLOCK) or 1))
    own = pairs.select("l1", "l2", F.xxhash64("l1", "l2").alias("h"), F.lit(-1).cast("long").alias("ti"),
                       block.alias("tj"), block.alias("block"), "s1", "s2")
    lead = own.select("h", "ti", "tj", F.lit(-1).cast("long").alias("block"), F.col("l1").alias("s1"),
                      F.col("l2").alias("s2")).distinct()
    return own.drop("l1", "l2").unionByName(lead)


def _open_tiles(members: DataFrame, found: DataFrame) -> DataFrame:
    """Tiles of the buckets with several components (as far as known): each pair of
    blocks of which one at least is outside the bucket's largest component."""
    rooted = saved(members.select("h", "s1", "s2").join(roots(found), ["s1", "s2"], "left").select(
        "h", "s1", "s2", F.coalesce("r1", "s1").alias("r1"), F.coalesce("r2", "s2").alias("r2")), "minmax_rooted")
    size = rooted.groupBy("h", "r1", "r2").agg(F.count(F.lit(1)).alias("n"))
    core = size.groupBy("h").agg(F.max(F.struct("n", "r1", "r2")).alias("core"), F.sum("n").alias("m")).where("core.n < m")
    blocks = core.select("h", F.col("core.r1").alias("c1"), F.col("core.r2").alias("c2"),
                         F.ceil((F.col("m") - F.col("core.n")) / F.lit(BLOCK)).cast("long").alias("free"),
                         F.ceil(F.col("core.n") / F.lit(BLOCK)).cast("long").alias("held"))
    inside = F.expr("r1 = c1 AND r2 = c2")
    spread = F.xxhash64("s1", "s2")
    placed = rooted.join(blocks, "h").select(
        "h", "s1", "s2",
        F.when(inside, F.col("free") + F.pmod(spread, F.col("held"))).otherwise(F.pmod(spread, F.col("free"))).alias("block"),
        F.explode(F.sequence(F.lit(0).cast("long"),
                             F.when(inside, F.col("free")).otherwise(F.col("free") + F.col("held")) - 1)).alias("other"))
    return placed.select("h", F.least("block", "other").alias("ti"), F.greatest("block", "other").alias("tj"),
                         "block", "s1", "s2")


def near_components(docs: DataFrame, n_words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id of every document."""
    rows = described(docs, n_words)
    worded = rows.where("n > 0")
    classes = saved(worded.drop("n").dropDuplicates(["s1", "s2"]), "minmax_classes")
    members = saved(_distinct_columns(classes.select(F.explode("bands").alias("h"), "s1", "s2"), "minmax_columns"),
                    "minmax_members")
    edges = _confirmed(docs, classes, _leader_tiles(members), n_words, percent, "minmax_leader")
    stars = star_rounds(star_edges(edges), EARLY_ROUNDS)
    edges = _confirmed(docs, classes, _open_tiles(members, stars), n_words, percent, "minmax_open")
    stars = star_rounds(stars.unionByName(star_edges(edges)).distinct())
    own = worded.groupBy("s1", "s2").agg(F.min("doc_id").alias("least"))
    rooted = saved(own.join(roots(stars), ["s1", "s2"], "left").select(
        "s1", "s2", "least", F.coalesce("r1", "s1").alias("r1"), F.coalesce("r2", "s2").alias("r2")), "minmax_roots")
    total = rooted.groupBy("r1", "r2").agg(F.min("least").alias("component_id"))
    answer = rooted.select("s1", "s2", "r1", "r2").join(total, ["r1", "r2"]).select("s1", "s2", "component_id")
    sized = worded.select("doc_id", "n", "s1", "s2")
    return joined_by_class(sized, answer, ["s1", "s2"]).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id").unionByName(
            rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def op12_rows(docs: DataFrame) -> DataFrame:
    return near_components(docs.select("doc_id", "text")).select(
        "*", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
