"""History compaction (A4, A5): de-duplicate the union of report parts and
list the distinct values of a column.

``dropDuplicates`` is an aggregate on all columns with partial aggregation: a
map task collapses its own copies first, so even a row repeated across a third
of the input reaches its reducer as at most one copy per map task.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from stationflow.session import exists, shared_path
from stationflow.sources.history import REPORT_SCHEMA, read_csv_parts
from stationflow.sources.sinks import append_parquet, flatten_structs


def dedupe(df: DataFrame) -> DataFrame:
    """A4: whole-row distinct; NULLs (and NaNs) compare equal."""
    return df.dropDuplicates()


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """A5: the distinct values of one column, NULL kept as a value. Spark has
    no arrival order, so callers that need one sort by the value."""
    return df.select(column).distinct()


def combine_history(spark: SparkSession, paths, schema: StructType = REPORT_SCHEMA,
                    out_path: str | None = None,
                    quarantine_path: str | None = None) -> DataFrame:
    """S3 + A6 + A4: CSV parts -> union by name -> distinct rows. With
    ``out_path`` the result is also written as Parquet (the compacted table)
    and read back from there; with ``quarantine_path`` the parts that could not
    be used are listed there (JSON)."""
    rows, unusable = read_csv_parts(spark, paths, schema, with_quarantine=True)
    if quarantine_path:
        unusable.write.mode("overwrite").json(quarantine_path)
    combined = dedupe(rows)
    if out_path is None:
        return combined
    combined.write.mode("overwrite").parquet(out_path)
    return spark.read.parquet(out_path)


def by_day(report: DataFrame) -> DataFrame:
    """The report with flat window columns and its ``window_date``."""
    return flatten_structs(report).withColumn("window_date", F.to_date("window_start"))


def append_daily(report: DataFrame, path: str) -> None:
    """Append the report as Parquet in ``window_date`` partitions. Rows of a day
    are brought together first, hashed by station within it, so that a day is a few
    files and no day is one task."""
    append_parquet(by_day(report).repartition("window_date", F.pmod(F.xxhash64("station_id"), F.lit(4))),
                   path, ["window_date"])


def read_days(spark: SparkSession, path: str, first: dt.date, last: dt.date) -> DataFrame:
    """The report rows of the days from ``first`` to ``last``; other partitions are not
    read."""
    return spark.read.parquet(path).where(F.col("window_date").between(first, last)).drop("window_date")


def merge_days(spark: SparkSession, rows: DataFrame, path: str) -> None:
    """A4: merge report rows into the ``window_date`` partitions of a compacted table.
    Only days that occur in ``rows`` are read and written; repeating a merge changes
    nothing."""
    new = rows.withColumn("window_date", F.to_date("window_start"))
    if exists(spark, path):
        held = spark.read.schema(new.schema).parquet(path)
        new = new.unionByName(held.join(new.select("window_date").distinct(), "window_date", "left_semi"))
    # A table is not overwritten by what is read from it: the merged days are written
    # beside it first.
    staged = shared_path(spark, "compaction")
    dedupe(new).write.parquet(staged)
    (spark.read.schema(new.schema).parquet(staged).repartition("window_date").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("window_date").parquet(path))


def start_compaction_stream(spark: SparkSession, parts_path: str, out_path: str, *, checkpoint_path: str,
                            schema: StructType = REPORT_SCHEMA, quarantine_path: str | None = None,
                            trigger: dict | None = None, max_files_per_trigger: int = 1000) -> StreamingQuery:
    """A4 + A6, incrementally: a file stream finds the CSV parts that are new since the
    last run, and their rows are merged into the compacted table. Of the parts
    already merged nothing is read. A batch that runs again merges the same rows."""
    found = (spark.readStream.format("binaryFile").schema(
        "path string, modificationTime timestamp, length long, content binary")
        .option("maxFilesPerTrigger", max_files_per_trigger).option("pathGlobFilter", "*.csv*")
        .option("recursiveFileLookup", "true").load(parts_path).select("path"))

    def merge(batch: DataFrame, batch_id: int) -> None:
        files = [r.path for r in batch.collect()]       # as many as a trigger takes
        if not files:
            return
        rows, unusable = read_csv_parts(spark, files, schema, with_quarantine=True)
        if quarantine_path:
            unusable.write.mode("overwrite").json(f"{quarantine_path}/batch_id={batch_id}")
        merge_days(spark, rows, out_path)

    writer = found.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint_path)
    return (writer.trigger(**trigger) if trigger else writer).start()
