"""Operator 4: n-gram Jaccard join by blocked sparse matrix products.

Rows of the matrix are distinct shingle sets (documents with equal sets are one
class, so copies are never compared), columns are shingles. Two sets link when
``100 * overlap >= percent * union``.

1. One pass gives every document its set size and a 128-bit signature of its
   set, and finds shingles that are common (seen in several documents of one
   Arrow batch).
2. All shingles are ordered: uncommon ones first, common ones by their count,
   then by hash. The order only decides how much work there is; any order that
   is the same for all documents gives the same links. It is refined once by the
   shingles that several documents show at its beginning.
3. Linked sets share a shingle among their first ``n - ceil(t * n) + 1`` in this
   order. A second pass writes these prefixes, the only columns of the matrix
   that are looked at first. Columns with one class can link nothing and go; of
   columns with the same classes one stays.
4. A column's classes are cut into blocks of about ``BLOCK``; every pair of
   blocks is a tile, so a hot column becomes many small tasks. A tile multiplies
   the incidence matrices of its two blocks, a range of columns at a time, adds
   up the overlap counts, and drops pairs as soon as what is left cannot reach
   the bound that their sizes demand.
5. Tiles are worked twice: on the prefixes from the tile's column on (a pair is
   decided where its smallest common column is), where the bound leaves hardly a
   pair but near duplicates, and then, for classes with a pair left, on whole sets,
   for which the texts of these classes are read again. There a pair that
   shares several columns belongs to the tile of the smallest one.
6. A tile returns, for each class, its number of links and the smallest class it
   is connected with in the tile; so its output is linear in its classes. (With
   ``pairs=True`` it returns the links themselves.) Connected components of these
   edges are found by alternating large and small stars.

Defined results: a document without words has the empty set, links with nothing
and is a component of its own; with fewer words than ``n`` the whole sequence is
the one shingle; a null text is empty; rows that share doc_id are separate
documents; a null doc_id takes part, and a component's id is its smallest
non-null doc_id (null if it has none); an empty table gives no row; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.llm import textarrays as T
from stationflow.llm.store import joined_by_class, least_step, saved, tidy, with_plain_names
from stationflow.session import broadcast_max_rows

WORDS = 3
PERCENT = 90
# A shingle is common if so many documents of one batch have it. At most
# COMMON_LIMIT of them, those with the most, are sent to every task.
COMMON_IN_BATCH = 4
COMMON_IN_PREFIX = 3
COMMON_LIMIT = 500_000
BLOCK = 256
# Columns of a block of the product.
COLUMNS = 4096


def shingle_sets(t: T.Texts, n: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each row (A-Z lower-cased)."""
    hashes, first = T.word_hashes(t, lower=True)
    if not len(hashes):
        return [np.zeros(0, np.uint64)] * t.rows
    grams = T.combine(hashes, n)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= n:
            out.append(np.unique(grams[a:b - n + 1]))
        elif b > a:
            short = T.combine(hashes[a:b], b - a)
            out.append(T.mix(short + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signature(s: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set of hashes."""
    if not len(s):
        return 0, 0
    a = np.add.reduce(T.mix(s + np.uint64(0x5851F42D4C957F2D)))
    b = np.bitwise_xor.reduce(T.mix(s * np.uint64(0xDA942042E4DD58B5) + np.uint64(len(s))))
    two = T.mix(np.array([a, b + np.uint64(len(s))], np.uint64)).astype(np.int64)
    return int(two[0]), int(two[1])


def overlap_needed(percent: int, a, b):
    """The least overlap with which sets of these sizes link."""
    return -(-percent * (a + b) // (100 + percent))


def prefix_size(percent: int, n: int) -> int:
    return n + (-percent * n // 100) + 1 if n else 0


def _describe(n_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["kind", "doc_id", "th", "n", "s1", "s2"]
        for batch in batches:
            every = []
            for t in T.slices(batch.column("text")):
                sets = shingle_sets(t, n_words)
                every += sets
                sig = [signature(s) for s in sets]
                rows = batch.slice(t.first, t.rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([0] * t.rows, pa.int32()), rows.column("doc_id"), rows.column("th"),
                     pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([a for a, _ in sig], pa.int64()), pa.array([b for _, b in sig], pa.int64())],
                    names=names)
            found = np.sort(np.concatenate(every)) if every else np.zeros(0, np.uint64)
            if len(found):
                start = np.flatnonzero(np.concatenate(([True], found[1:] != found[:-1])))
                count = np.diff(np.append(start, len(found)))
                own = count >= COMMON_IN_BATCH
                if own.any():
                    m = int(own.sum())
                    none = pa.nulls(m, pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([1] * m, pa.int32()), none, none, pa.array(count[own].astype(np.int64)),
                         pa.array(found[start[own]].astype(np.int64)), none], names=names)
    return run


class Order:
    """The common order of shingles: a level for common ones, 0 for the others."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        """``keys`` are 58-bit hashes, each once."""
        at = np.argsort(keys)
        self.key = keys[at].astype(np.uint64)
        self.level = np.minimum(31, 1 + np.log2(np.maximum(counts[at], 1))).astype(np.uint64)

    def first(self, s: np.ndarray, n: int) -> np.ndarray:
        """The ``n`` first shingles of a set, as sorted keys: five bits of level and
        58 of the hash. (Two shingles that share a key count as one column, which
        may leave a pair too many to the whole sets, never one too few.)"""
        key = s >> np.uint64(6)
        if len(self.key):
            at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
            level = np.where(self.key[at] == key, self.level[at], np.uint64(0))
            key = np.sort(key | level << np.uint64(58))
        return key[:n].astype(np.int64)


def _prefixes(n_words: int, percent: int, order):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in T.slices(batch.column("text")):
                sets = shingle_sets(t, n_words)
                keys = [order.value.first(s, prefix_size(percent, len(s))) for s in sets]
                sig = [signature(s) for s in sets]
                edge = np.concatenate(([0], np.cumsum([len(k) for k in keys]))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([a for a, _ in sig], pa.int64()), pa.array([b for _, b in sig], pa.int64()),
                     pa.array([len(s) for s in sets], pa.int64()),
                     pa.ListArray.from_arrays(pa.array(edge), pa.array(np.concatenate(keys)))],
                    names=["s1", "s2", "n", "keys"])
    return run


def _written_prefixes(docs: DataFrame, n_words: int, percent: int, order: Order, name: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(order)
    return saved(docs.select("text").mapInArrow(
        tidy(_prefixes(n_words, percent, shared)), "s1 long, s2 long, n long, keys array<long>"), name)


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


def products(sets: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The incidence matrix of ``sets`` times itself, a block of columns at a time:
    the overlaps so far, and the columns that each set has left. Columns of one
    set are in no overlap and left out."""
    m = len(sets)
    row = np.repeat(np.arange(m), [len(s) for s in sets])
    codes, distinct = pd.factorize(np.concatenate(sets))
    shared = np.bincount(codes, minlength=len(distinct)) > 1
    column = np.cumsum(shared) - 1
    keep = shared[codes]
    row, col = row[keep], column[codes[keep]]
    left = np.bincount(row, minlength=m)
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    count = np.zeros((m, m), np.float32)
    total = int(shared.sum())
    for lo in range(0, max(total, 1), COLUMNS):
        a, b = np.searchsorted(col, [lo, lo + COLUMNS])
        block = np.zeros((m, min(COLUMNS, total - lo)), np.float32)
        block[row[a:b], col[a:b] - lo] = 1
        count += block @ block.T
        left = left - np.bincount(row[a:b], minlength=m)
        yield count, left


def overlaps(sets: list[np.ndarray], alive: np.ndarray, percent: int) -> np.ndarray:
    """Links among ``sets`` where ``alive`` (upper triangle)."""
    size = np.array([len(s) for s in sets], np.int64)
    need = overlap_needed(percent, size[:, None], size[None, :])
    alive = alive & (np.minimum(size[:, None], size[None, :]) >= need)
    if not alive.any():
        return alive
    if len(sets) == 2:
        return alive & (len(np.intersect1d(sets[0], sets[1], assume_unique=True)) >= need)
    for count, left in products(sets):
        alive &= count + np.minimum(left[:, None], left[None, :]) >= need
        if not alive.any():
            return alive
    return alive


def prefix_bound(sets: list[np.ndarray], size: np.ndarray, behind: np.ndarray, alive: np.ndarray,
                 percent: int) -> np.ndarray:
    """Pairs that may still link, by the sorted keys of their prefixes from a
    column on. ``behind`` shingles of each set come from that column on; a pair
    whose smallest common column it is has no others in common. Before the smaller
    of the two last keys both sets are known; the rest can at most all agree.
    Shortened keys that collide count as rest, so they never lower a bound."""
    need = overlap_needed(percent, size[:, None], size[None, :])
    alive = alive & (np.minimum(behind[:, None], behind[None, :]) >= need)
    if not alive.any():
        return alive
    sets = [np.unique(s) for s in sets]
    last = np.array([s[-1] for s in sets])
    known = np.stack([np.searchsorted(s, last, "left") for s in sets])
    rest = behind[:, None] - known
    rest = np.minimum(rest, rest.T)
    if len(sets) == 2:
        return alive & (len(np.intersect1d(sets[0], sets[1], assume_unique=True)) + rest >= need)
    for count, left in products(sets):
        alive &= count + np.minimum(left[:, None], left[None, :]) + rest >= need
        if not alive.any():
            return alive
    return alive


def smallest_reached(links: np.ndarray) -> np.ndarray:
    """For each row of a symmetric link matrix, the smallest row connected with it."""
    label = np.arange(len(links))
    reach = links | np.eye(len(links), dtype=bool)
    while True:
        new = np.where(reach, label[None, :], len(links)).min(1)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _candidates(block: np.ndarray, cross: bool) -> np.ndarray:
    alive = np.triu(np.ones((len(block), len(block)), bool), 1)
    return alive & (block[:, None] != block[None, :]) if cross else alive


def _longs(rows: list[tuple], k: int) -> pa.Array:
    return pa.array([r[k] for r in rows], pa.int64())


def _bound_tile(percent: int):
    """Rows (block, s1, s2, n, behind, keys): the classes that have a pair left."""

    def solve(h: int, cross: bool, rows: list[tuple]) -> pa.RecordBatch | None:
        keys = [r[5] for r in rows]
        size, behind = np.array([r[3:5] for r in rows], np.int64).T
        left = prefix_bound(keys, size, behind, _candidates(np.array([r[0] for r in rows]), cross), percent)
        who = [r for r, ok in zip(rows, (left | left.T).any(1)) if ok]
        return pa.RecordBatch.from_arrays(
            [pa.array([h] * len(who), pa.int64()), _longs(who, 1), _longs(who, 2)],
            names=["h", "s1", "s2"]) if who else None

    return solve


def _link_tile(percent: int, pairs: bool):
    """Rows (block, s1, s2, shingles, cols): edges and numbers of links."""

    def solve(h: int, cross: bool, rows: list[tuple]) -> pa.RecordBatch | None:
        rows.sort(key=lambda r: (r[1], r[2]))
        sets = [np.frombuffer(r[3], np.uint64) for r in rows]
        m = len(rows)
        alive = _candidates(np.array([r[0] for r in rows]), cross)
        # Pairs with a smaller column in common belong to that column's tile.
        smaller = [r[4][r[4] < h] for r in rows]
        if any(map(len, smaller)):
            row = np.repeat(np.arange(m), [len(c) for c in smaller])
            codes, distinct = pd.factorize(np.concatenate(smaller))
            seen = np.zeros((m, len(distinct)), np.float32)
            seen[row, codes] = 1
            alive &= (seen @ seen.T) == 0
        links = overlaps(sets, alive, percent)
        if not links.any():
            return None
        if pairs:
            a, b = np.nonzero(links)
            degree = np.ones(len(a), np.int64)
        else:
            links = links | links.T
            a = np.flatnonzero(links.any(1))
            b, degree = smallest_reached(links)[a], links.sum(1)[a].astype(np.int64)
        one, two = [rows[i] for i in a], [rows[i] for i in b]
        return pa.RecordBatch.from_arrays(
            [_longs(one, 1), _longs(one, 2), _longs(two, 1), _longs(two, 2), pa.array(degree)],
            names=["a1", "a2", "b1", "b2", "n_links"])

    return solve


def _values(column: pa.Array) -> list:
    """The values of a column; lists of numbers as views of one array."""
    if not pa.types.is_list(column.type):
        return column.to_pylist()
    flat = column.values.to_numpy(zero_copy_only=False)
    edge = column.offsets.to_numpy()
    return [flat[a:b] for a, b in zip(edge[:-1].tolist(), edge[1:].tolist())]


def _by_tile(columns: list[str], solve):
    """Work through the rows of a partition, sorted by tile."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows, out, held = None, [], [], 0

        def close() -> None:
            nonlocal held
            done = solve(key[0], key[1] != key[2], rows) if len(rows) > 1 else None
            if done is not None:
                out.append(done)
                held += done.num_rows

        for batch in batches:
            for h, ti, tj, *row in zip(*(_values(batch.column(c)) for c in ["h", "ti", "tj", *columns])):
                if (h, ti, tj) != key:
                    if key is not None:
                        close()
                    key, rows = (h, ti, tj), []
                rows.append(tuple(row))
                if held > 4096:
                    yield pa.Table.from_batches(out).combine_chunks().to_batches()[0]
                    out, held = [], 0
        if key is not None:
            close()
        if out:
            yield pa.Table.from_batches(out).combine_chunks().to_batches()[0]

    return run


def _distinct_columns(members: DataFrame, name: str) -> DataFrame:
    """(h, s1, s2, m): of columns with the same classes one stays; columns with
    one class go. ``m`` is the number of classes."""
    columns = members.groupBy("h").agg(F.count(F.lit(1)).alias("m"), F.bit_xor("s1").alias("x1"),
                                       F.bit_xor("s2").alias("x2")).where("m > 1")
    columns = saved(columns.groupBy("m", "x1", "x2").agg(F.min("h").alias("h")).select("h", "m"), name)
    return members.join(columns, "h")


def _tiles(members: DataFrame, rows: DataFrame) -> DataFrame:
    """Members, once for every tile they are in, with what ``rows`` has of their class."""
    placed = (members.withColumn("k", F.ceil(F.col("m") / F.lit(BLOCK)).cast("long"))
              .withColumn("block", F.pmod(F.xxhash64("s1", "s2"), F.col("k")))
              .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("k") - 1)))
              .select("h", "s1", "s2", "block", F.least("block", "other").alias("ti"),
                      F.greatest("block", "other").alias("tj")))
    return placed.join(rows, ["s1", "s2"])


def _dealt(tiles: DataFrame) -> DataFrame:
    return tiles.repartition("h", "ti", "tj").sortWithinPartitions("h", "ti", "tj")


def _from_column_on(tiles: DataFrame) -> DataFrame:
    """What a tile needs of the prefixes: the keys from its column on, of which 31
    bits keep their order and tell nearly all of them apart."""
    at = F.array_position("keys", F.col("h")).cast("int")
    later = F.transform(F.slice("keys", at, F.size("keys")), lambda k: F.shiftright(k, 32).cast("int"))
    return tiles.select("h", "ti", "tj", "block", "s1", "s2", "n",
                        (F.col("n") - at + 1).alias("behind"), later.alias("keys"))


def classes(docs: DataFrame, n_words: int = WORDS) -> tuple[DataFrame, DataFrame]:
    """(doc_id, th, n, s1, s2) of every document, and the common shingles (s1: its
    hash, n: documents that showed it)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("th"))
    both = saved(rows.mapInArrow(
        tidy(_describe(n_words)), "kind int, doc_id long, th long, n long, s1 long, s2 long"),
        "shingle_classes", partition_by="kind")
    return (both.where("kind = 0").drop("kind"),
            both.where("kind = 1").groupBy("s1").agg(F.sum("n").alias("n")))


def common_order(common: DataFrame) -> Order:
    """At most ``COMMON_LIMIT`` common shingles (key, n): those from the step of
    counts on (an eighth of a doubling) that keeps within it."""
    common = saved(common.groupBy("key").agg(F.max("n").alias("n")), "common_shingles")
    step = F.floor(F.log2("n") * 8).cast("int")
    got = common.where(step >= least_step(common, step, COMMON_LIMIT)).select("key", "n").toArrow()
    return Order(got.column("key").to_numpy(), got.column("n").to_numpy())


def jaccard_edges(docs: DataFrame, described: DataFrame, common: DataFrame, n_words: int = WORDS,
                  percent: int = PERCENT, pairs: bool = False) -> DataFrame:
    """Edges between classes: (a1, a2) and the smallest class (b1, b2) it is
    connected with in a tile, with its links there; or all links (``pairs``)."""
    spark = docs.sparkSession
    common = common.select(F.shiftrightunsigned("s1", 6).alias("key"), "n")
    # Which shingles of the prefixes several documents share shows only now: those
    # join the common ones, and the prefixes are taken again.
    first = _written_prefixes(docs, n_words, percent, common_order(common), "first_prefixes")
    again = (first.select(F.explode("keys").alias("h"))
             .groupBy("h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= COMMON_IN_PREFIX)
             .select(F.col("h").bitwiseAND((1 << 58) - 1).alias("key"), "n"))
    prefixes = _written_prefixes(docs, n_words, percent, common_order(common.unionByName(again)),
                                 "shingle_prefixes")
    entries = prefixes.select(F.explode("keys").alias("h"), "s1", "s2")
    several = (entries.groupBy("h").agg(F.min("s1").alias("lo"), F.max("s1").alias("hi"))
               .where("lo < hi").select("h"))
    members = saved(entries.join(several, "h", "left_semi").distinct(), "shingle_members")
    members = _distinct_columns(members, "prefix_columns")
    own = members.select("s1", "s2").distinct()
    rows = prefixes.join(own, ["s1", "s2"], "left_semi").dropDuplicates(["s1", "s2"])
    left = _dealt(_from_column_on(_tiles(members, rows))).mapInArrow(
        tidy(_by_tile(["block", "s1", "s2", "n", "behind", "keys"], _bound_tile(percent))), "h long, s1 long, s2 long")
    members = _distinct_columns(saved(left.distinct(), "near_members"), "near_columns")

    # One document of each class that has a pair left gives its set.
    cols = members.groupBy("s1", "s2").agg(F.sort_array(F.collect_set("h")).alias("cols"))
    giver = saved(described.join(cols.select("s1", "s2"), ["s1", "s2"], "left_semi")
                  .groupBy("s1", "s2").agg(F.min(F.struct("doc_id", "th")).alias("g"))
                  .select("s1", "s2", F.col("g.doc_id").alias("d"), F.col("g.th").alias("t")), "givers")
    if giver.count() <= broadcast_max_rows(spark):      # four numbers a row
        giver = F.broadcast(giver)
    texts = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("th"))
             .join(giver, F.expr("th = t AND doc_id <=> d")).select("s1", "s2", "text"))
    sets = (texts.mapInArrow(tidy(_sets(n_words)), "s1 long, s2 long, shingles binary")
            .dropDuplicates(["s1", "s2"]).join(cols, ["s1", "s2"]))
    return saved(_dealt(_tiles(members, sets)).mapInArrow(
        tidy(_by_tile(["block", "s1", "s2", "shingles", "cols"], _link_tile(percent, pairs))),
        "a1 long, a2 long, b1 long, b2 long, n_links long"), "jaccard_edges")


def star_edges(edges: DataFrame) -> DataFrame:
    """The edges between different classes as (u, v) with u > v."""
    return (edges.select(F.struct(F.col("a1").alias("x"), F.col("a2").alias("y")).alias("u"),
                         F.struct(F.col("b1").alias("x"), F.col("b2").alias("y")).alias("v"))
            .where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())


def star_rounds(now: DataFrame, most: int | None = None) -> DataFrame:
    """Alternates large stars and small stars on edges (u, v) until nothing changes, or
    ``most`` times: the edges then connect the same classes as before. The number
    of rounds grows with the logarithm of the longest path."""
    now = saved(now, "stars")

    def mark(df: DataFrame):
        r = df.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u.x", "u.y", "v.x", "v.y")).alias("x")).first()
        return r.n, r.x

    seen, done = mark(now), 0
    while seen[0] and done != most:
        done += 1
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").repartition("u"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v").where("u <> v").distinct())
        now = saved(small, "stars")
        new = mark(now)
        if new == seen:
            break
        seen = new
    return now


def roots(now: DataFrame) -> DataFrame:
    """(s1, s2, r1, r2): the smallest class that a class has an edge to. A class
    without one, in the middle of a star, is its own root."""
    low = now.groupBy("u").agg(F.min("v").alias("m"))
    return low.select(F.col("u.x").alias("s1"), F.col("u.y").alias("s2"),
                      F.col("m.x").alias("r1"), F.col("m.y").alias("r2"))


def components(edges: DataFrame) -> DataFrame:
    """(s1, s2, r1, r2): the smallest class connected with each class, of those that
    are not the smallest themselves."""
    return roots(star_rounds(star_edges(edges)))


def jaccard_components(docs: DataFrame, n_words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, th (hash of the text), n_shingles, component_id, n_links (distinct
    other sets that the document's set links with) and the component's smallest
    class (r1, r2; null for the empty set) of every document."""
    described, common = classes(docs, n_words)
    edges = jaccard_edges(docs, described, common, n_words, percent)
    # Each tile counts a pair once, from both sides.
    degree = edges.groupBy(F.col("a1").alias("s1"), F.col("a2").alias("s2")).agg(F.sum("n_links").alias("n_links"))
    own = described.where("n > 0").groupBy("s1", "s2").agg(F.min("doc_id").alias("least"))
    rooted = own.join(components(edges), ["s1", "s2"], "left").select(
        "s1", "s2", "least", F.coalesce("r1", "s1").alias("r1"), F.coalesce("r2", "s2").alias("r2"))
    total = rooted.groupBy("r1", "r2").agg(F.min("least").alias("component_id"))
    answer = rooted.join(total, ["r1", "r2"]).join(degree, ["s1", "s2"], "left").select(
        "s1", "s2", "component_id", "n_links", "r1", "r2")
    none = F.lit(None).cast("long")
    return (joined_by_class(described.where("n > 0"), answer, ["s1", "s2"])
            .select("doc_id", "th", F.col("n").alias("n_shingles"), "component_id",
                    F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), "r1", "r2")
            .unionByName(described.where("n = 0").select(
                "doc_id", "th", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"),
                F.lit(0).cast("long").alias("n_links"), none.alias("r1"), none.alias("r2"))))


def links(docs: DataFrame, n_words: int = WORDS, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """All links between distinct sets, (a1, a2) with (b1, b2), and the
    membership: (doc_id, n_shingles, s1, s2)."""
    described, common = classes(docs, n_words)
    found = jaccard_edges(docs, described, common, n_words, percent, pairs=True)
    return (found.select("a1", "a2", "b1", "b2"),
            described.select("doc_id", F.col("n").alias("n_shingles"), "s1", "s2"))


@with_plain_names
def keep_one(docs: DataFrame, n_words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row of each component with all its columns: that of the smallest
    doc_id (null ids last; of several texts one, of repeated rows one). Rows
    without words all stay."""
    found = jaccard_components(docs, n_words, percent)
    key = [F.coalesce(F.col("doc_id").cast("long"), F.lit(0).cast("long")).alias("_k0"),
           F.col("doc_id").isNull().alias("_k1")]
    first = (found.where("n_shingles > 0").groupBy("r1", "r2")
             .agg(F.min(F.struct(F.col("doc_id").isNull().alias("x"), "doc_id", "th")).alias("f"))
             .select("f.doc_id", "f.th").select(*key, F.col("th").alias("_k2")))
    keyed = docs.select("*", *key, F.xxhash64("text").alias("_k2"))
    words = F.length(F.btrim(F.coalesce("text", F.lit("")), F.lit(" \t\n\x0b\x0c\r"))) > 0
    names = ["_k0", "_k1", "_k2"]
    kept = keyed.where(words).join(first, names, "left_semi").dropDuplicates(names)
    return kept.unionByName(keyed.where(~words)).drop(*names)


def op4_components(docs: DataFrame) -> DataFrame:
    return jaccard_components(docs.select("doc_id", "text")).select(
        "doc_id", "n_shingles", "component_id", "n_links")
