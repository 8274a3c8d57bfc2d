"""Operator 9: exact top-k search by tiled matrix products.

Vectors become integers (``floor(scale * x)``) and are packed, many to a row, into
shards and query blocks. Every query block meets every shard as one tile: a
matrix product, of which the best ``k`` of each query are selected at once. The
lists of a query are then merged in a tree, ``FAN_IN`` shards at a time, so no
task holds more than a few short lists of a query.

Products are exact: they are done in doubles where no sum can pass 2**53, else
in 64-bit integers. Vectors of different lengths do not meet.

Defined results: vectors that are null or hold a null or non-finite component
take no part, nor do rows without an id; a candidate with the query's id is the
query's own row; a repeated query with an equal vector is asked once, with
another vector it gets a list of its own; repeated candidates count each; ties
go to the smaller id; an empty table gives no row; extra columns are ignored.
A component whose products could pass 64 bits raises an error.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationflow.llm.store import saved

SCALE = 256.0
K = 5
SHARD_ROWS = 4096
QUERY_ROWS = 1024
# Tiles are dealt by (group of shards, group of query blocks). There are at least
# GROUPS groups of shards, and as many groups of both as the data needs for about
# GROUP_BLOCKS blocks in each, so the work of one key stays the same at any size.
GROUPS = 32
GROUP_BLOCKS = 16
FAN_IN = 16

PACK_SCHEMA = "dim int, part int, seq int, n int, ids binary, vectors binary"


def usable(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows that take part, the length of each row, and the flat components
    (those of rows that are left out included)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    size = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = pc.fill_null(column.flatten(), float("nan")).to_numpy(zero_copy_only=False).astype(np.float64)
    first = np.concatenate(([0], np.cumsum(size)))
    bad = np.concatenate(([0], np.cumsum(~np.isfinite(flat))))
    ok = column.is_valid().to_numpy(zero_copy_only=False) & (bad[first[1:]] == bad[first[:-1]]) & (size > 0)
    return (ok, size, flat) if n else (np.zeros(0, bool), size, flat)


def _pack(rows_per_block: int, scale: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

        def flush(dim: int) -> pa.RecordBatch:
            nonlocal seq
            ids = np.concatenate([a for a, _ in held[dim]])
            v = np.concatenate([b for _, b in held[dim]])
            held[dim] = []
            row = [dim, part, seq, len(ids), ids.astype("<i8").tobytes(), v.astype("<i8").tobytes()]
            seq += 1
            return pa.RecordBatch.from_arrays(
                [pa.array([x], t) for x, t in zip(row, (pa.int32(),) * 4 + (pa.binary(),) * 2)],
                names=["dim", "part", "seq", "n", "ids", "vectors"])

        for batch in batches:
            ids = batch.column("vec_id")
            ok, size, flat = usable(batch.column("embedding"))
            ok &= ids.is_valid().to_numpy(zero_copy_only=False)
            ids = pc.fill_null(ids, 0).to_numpy(zero_copy_only=False)
            first = np.cumsum(size) - size
            for dim in np.unique(size[ok]).tolist():
                who = np.flatnonzero(ok & (size == dim))
                for lo in range(0, len(who), rows_per_block):
                    own = who[lo:lo + rows_per_block]
                    v = np.floor(flat[first[own][:, None] + np.arange(dim)] * scale)
                    if np.abs(v).max(initial=0) >= 2.0 ** 62:
                        raise ValueError("a component is too large for 64-bit products")
                    held.setdefault(dim, []).append((ids[own], v.astype(np.int64)))
                    if sum(len(a) for a, _ in held[dim]) >= rows_per_block:
                        yield flush(dim)
        for dim in [d for d, h in held.items() if h]:
            yield flush(dim)

    return run


def pack(vectors: DataFrame, rows_per_block: int, scale: float = SCALE) -> DataFrame:
    """(dim, part, seq, n, ids, vectors): blocks of at most about twice
    ``rows_per_block`` vectors of one length as integers."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                          F.col("embedding").cast("array<double>").alias("embedding"))
    return rows.mapInArrow(_pack(rows_per_block, scale), PACK_SCHEMA)


def products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows."""
    top = int(np.abs(q).max(initial=0)) * int(np.abs(c).max(initial=0)) * q.shape[1]
    if top < 1 << 53:
        return (q.astype(np.float64) @ c.T.astype(np.float64)).astype(np.int64)
    if top >= 1 << 63:
        raise ValueError("inner products do not fit 64 bits")
    return q @ c.T


def select(score: np.ndarray, own: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Query and candidate numbers of the best ``k`` of each row of ``score``,
    without candidates marked ``own``; ties to the smaller id."""
    least = np.iinfo(np.int64).min
    s = np.where(own, least, score)
    if s.shape[1] > k:
        bound = np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k]
        q, c = np.nonzero((s >= bound[:, None]) & ~own)
    else:
        q, c = np.nonzero(~own)
    order = np.lexsort((ids[c], -s[q, c], q))
    q, c = q[order], c[order]
    nth = np.arange(len(q)) - np.searchsorted(q, q)
    return q[nth < k], c[nth < k]


def _tiles(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                get = lambda c: batch.column(c)[i].as_py()
                qi, ci = np.frombuffer(get("q_ids"), "<i8"), np.frombuffer(get("ids"), "<i8")
                q = np.frombuffer(get("q_vectors"), "<i8").reshape(len(qi), -1)
                c = np.frombuffer(get("vectors"), "<i8").reshape(len(ci), -1)
                score = products(q, c)
                a, b = select(score, qi[:, None] == ci[None, :], ci, k)
                tag = q.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.arange(q.shape[1], dtype=np.uint64)
                tag = np.bitwise_xor.reduce(tag * (tag >> np.uint64(29) | np.uint64(1)), axis=1).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(qi[a]), pa.array(tag[a]), pa.array(ci[b]), pa.array(score[a, b]),
                     pa.array(np.full(len(a), get("node"), np.int64))],
                    names=["query_id", "tag", "vec_id", "score", "node"])
    return run


def _best(rows: DataFrame, keys: list, k: int) -> DataFrame:
    """The best ``k`` of each group, which holds some short lists."""
    best = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("m"), "vec_id"))), 1, k)
    return rows.groupBy(*keys).agg(best.alias("best"))


def top_k(vectors: DataFrame, is_query: Column, k: int = K, scale: float = SCALE) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best candidates of each query
    among all vectors but the query's own."""
    shards = saved(pack(vectors, SHARD_ROWS, scale), "vector_shards")
    asked = vectors.where(is_query).dropDuplicates(["vec_id", "embedding"])
    queries = saved(pack(asked, QUERY_ROWS, scale), "query_blocks")
    n_shards = shards.count()
    n_groups = max(GROUPS, math.ceil(n_shards / GROUP_BLOCKS))
    n_asked = max(1, math.ceil(queries.count() / GROUP_BLOCKS))
    levels = max(1, math.ceil(math.log(max(n_shards, 2), FAN_IN)))
    dealt = lambda n: F.pmod(F.xxhash64("part", "seq"), F.lit(n))
    copies = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    node = F.pmod(F.xxhash64(F.lit("node"), "part", "seq"), F.lit(FAN_IN ** levels))
    left = shards.select("dim", "ids", "vectors", node.alias("node"), dealt(n_groups).alias("group"),
                         copies(n_asked).alias("asked"))
    right = queries.select("dim", F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"),
                           dealt(n_asked).alias("asked"), copies(n_groups).alias("group"))
    lists = left.join(right, ["dim", "group", "asked"]).mapInArrow(
        _tiles(k), "query_id long, tag long, vec_id long, score long, node long")
    for level in range(levels):
        lists = lists.withColumn("node", F.floor(F.col("node") / FAN_IN))
        best = _best(lists, ["query_id", "tag", "node"], k)
        if level < levels - 1:
            lists = best.select("query_id", "tag", "node", F.explode("best").alias("b")).select(
                "query_id", "tag", "node", "b.vec_id", (-F.col("b.m")).alias("score"))
    return best.select("query_id", F.posexplode("best").alias("rank", "b")).select(
        "query_id", (F.col("rank") + 1).cast("int").alias("rank"), "b.vec_id", (-F.col("b.m")).alias("score"))


def op9_search(vectors: DataFrame) -> DataFrame:
    return top_k(vectors, F.col("vec_id") % 50 == 0)
