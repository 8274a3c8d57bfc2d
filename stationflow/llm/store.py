"""Intermediate tables of the operators, written to the shared checkpoint folder.

A written table cuts the lineage: a lost executor never forces an expensive
stage to be run again, and a table that is read twice is computed once.
"""

from __future__ import annotations

import ctypes
import shutil
import tempfile
from collections.abc import Callable, Iterator
from functools import lru_cache, wraps
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import stationflow
from stationflow.session import shared_path

# Archives of this package by application; they must stay as long as it runs.
_SHIPPED: dict[str, tempfile.TemporaryDirectory] = {}


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package, once per application (a cluster
    started with ``--py-files`` has it already; a second copy does no harm)."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    source = Path(stationflow.__file__).parent
    folder = tempfile.TemporaryDirectory(prefix="stationflow-")
    _SHIPPED[sc.applicationId] = folder
    shutil.copytree(source, Path(folder.name, "tree", source.name),
                    ignore=shutil.ignore_patterns("__pycache__"))
    sc.addPyFile(shutil.make_archive(str(Path(folder.name, source.name)), "zip", Path(folder.name, "tree")))


def saved(df: DataFrame, name: str, *, compression: str = "zstd",
          partition_by: str | None = None) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` as Parquet and read it again."""
    path = shared_path(df.sparkSession, "llm", name)
    writer = df.write.option("compression", compression)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@lru_cache(maxsize=1)
def _trim():
    """The C library's call that gives freed memory back, where it has one."""
    return getattr(ctypes.CDLL(None), "malloc_trim", lambda _: 0)


def tidy(step: Callable) -> Callable:
    """A step of ``mapInArrow`` that gives freed memory back to the system when its
    task ends. Spark uses its Python workers again, which would keep the peak of
    every earlier step beside what the next one needs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from step(batches)
        finally:
            pa.default_memory_pool().release_unused()
            _trim()(0)

    return run


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_plain_names(step: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A step on documents that gives back their columns: while it works, the columns
    other than doc_id and text have names that clash with none of its own."""

    @wraps(step)
    def run(docs: DataFrame, *args, **kwargs) -> DataFrame:
        plain = [c if c in ("doc_id", "text") else f"other{i}" for i, c in enumerate(docs.columns)]
        out = step(docs.toDF(*plain), *args, **kwargs)
        back = dict(zip(plain, docs.columns))
        return out.select(*(F.col(c).alias(back.get(c, c)) for c in out.columns))

    return run


def least_step(df: DataFrame, step: Column, limit: int, weight: Column | None = None) -> int:
    """The least value of the integer ``step`` (of which there are few) such that
    the rows from it on (or the sum of their ``weight``) are at most ``limit``: a
    top list without a sort, whose size is proven before it is brought together."""
    left, bound = limit, 1 << 30
    size = F.count(F.lit(1)) if weight is None else F.sum(weight)
    for r in sorted(df.groupBy(step.alias("o")).agg(size.alias("count")).collect(), key=lambda r: -r["o"]):
        left -= r["count"]
        if left < 0:
            break
        bound = r["o"]
    return bound


def hash_below(h: Column, share: float) -> Column:
    """Rows whose 64-bit hash lies in the lowest ``share`` of all values."""
    return h < F.lit(max(-(1 << 63), min((1 << 63) - 1, int(share * 2.0 ** 64) - (1 << 63)))) if share < 1 else F.lit(True)


# Values of a key that count as hot, those with the most rows, and the tasks that
# share the rows of one.
HOT_VALUES = 100_000
HOT_SPREAD = 64


def joined_by_class(rows: DataFrame, answers: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join with ``answers``, which has one row for each value of ``keys``,
    where a value may have very many ``rows`` (a written table). The answers for the
    values with the most rows, a bounded list, are repeated, and their rows dealt
    over the copies; all others meet in one task per value."""
    size = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n >= 256")
    step = F.floor(F.log2("n")).cast("int")
    size = saved(size, "class_sizes")
    hot = F.broadcast(size.where(step >= least_step(size, step, HOT_VALUES)).select(*keys, F.lit(True).alias("_hot")))
    salt = F.when(F.col("_hot"), F.pmod(F.monotonically_increasing_id(), F.lit(HOT_SPREAD))).otherwise(F.lit(0))
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(HOT_SPREAD - 1))).otherwise(F.array(F.lit(0)))
    dealt = rows.join(hot, keys, "left").withColumn("_salt", salt.cast("int")).drop("_hot")
    many = answers.join(hot, keys, "left").withColumn("_salt", F.explode(copies)).drop("_hot")
    return dealt.join(many, [*keys, "_salt"]).drop("_salt")
