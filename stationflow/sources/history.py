"""Historical report files (S2, S3): CSV parts written batch after batch.

``read_csv_parts`` aligns columns **by header name in every file**: the parts are
grouped by their header line, and each group is read by Spark's CSV source with the
schema in the order of that header. A plain multi-file ``spark.read.csv`` would map
columns by position and silently mix up files whose headers differ.

A column that a part lacks is NULL in its rows; columns beyond the schema are
left out, their rows stay. What cannot be read as a row is listed. Finding the
headers is a pass over the lines of the parts.
"""

from __future__ import annotations

import csv
import zlib
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType, FloatType, StringType, StructField, StructType, TimestampType,
)

from stationflow.operators.normalize import parsed_once

# The report as the streaming job writes it (flattened window, no batch id).
REPORT_SCHEMA = StructType([
    StructField("station_id", StringType()),
    StructField("temperature", FloatType()),
    StructField("wind_speed", FloatType()),
    StructField("cloudiness", FloatType()),
    *[StructField(c, DoubleType()) for c in (
        "station_utilization_rate", "citywide_utilization_rate", "min_utilization",
        "max_utilization", "avg_utilization", "std_dev_docking_station_utilisation")],
    StructField("window_start", TimestampType()),
    StructField("window_end", TimestampType()),
])


def read_csv(spark: SparkSession, path, *, schema: StructType | None = None,
             infer: bool = False) -> DataFrame:
    """CSV with a header row. A fixed schema by default; ``infer=True`` is
    the opt-in (an extra pass over the data) for ad-hoc files."""
    reader = spark.read.option("header", "true")
    reader = reader.option("inferSchema", "true") if infer else reader.schema(schema or REPORT_SCHEMA)
    return reader.csv(path)


_BAD = "_bad"


def _part_headers(reader: DataFrameReader, paths) -> list:
    """(file, its first line that is not blank) of every part that has one. Spark's
    listing of the parts is on the driver as well."""
    lines = reader.text(paths).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("line"))
    # Rows of the block at offset 0 are in one partition in file order.
    return (lines.where((F.col("block") == 0) & (F.trim("line") != ""))
            .withColumn("place", F.monotonically_increasing_id())
            .groupBy("file").agg(F.min_by("line", "place").alias("header")).collect())


def _part_schema(columns: list[str], schema: StructType) -> StructType:
    """The schema of parts with these columns: those of the target by name and type,
    the others as text (under another name if theirs is taken)."""
    types = {f.name: f.dataType for f in schema.fields}
    taken = {c.lower() for c in [*types, _BAD, "_file", ""]}
    fields = []
    for i, c in enumerate(columns):
        if c in types and c not in columns[:i]:
            fields.append(StructField(c, types[c]))
        else:
            fields.append(StructField(f"_extra{i}" if c.lower() in taken else c, StringType()))
            taken.add(c.lower())
    return StructType([*fields, StructField(_BAD, StringType())])


def _broken_off(spark: SparkSession, files: list[str]) -> DataFrame:
    """The gzip parts whose last stream does not end."""
    def check(batches):
        for batch in batches:
            out = []
            for name, content in zip(batch.column("file").to_pylist(), batch.column("content")):
                data, rest = zlib.decompressobj(31), memoryview(content.as_buffer())
                try:
                    while len(rest):
                        for at in range(0, len(rest), 1 << 20):
                            data.decompress(rest[at:at + (1 << 20)])
                            if data.eof:
                                break
                        if not data.eof:
                            break
                        rest = data.unused_data         # a file may hold several streams
                        data = zlib.decompressobj(31) if rest else data
                    if not data.eof:
                        out.append(name)
                except zlib.error:
                    out.append(name)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["file"])
    return (spark.read.format("binaryFile").load(files)
            .select(F.col("_metadata.file_path").alias("file"), "content").mapInArrow(check, "file string"))


def read_csv_parts(spark: SparkSession, paths, schema: StructType = REPORT_SCHEMA, *,
                   with_quarantine: bool = False, skip_unreadable: bool = True, multi_line: bool = True):
    """S3 + A6: union by column name of all CSV parts under ``paths``.

    Parts are read by Spark's CSV source, one read for each header that occurs. A row
    that does not fit its header and the types (too few or too many values, a value
    of another type) is listed, not nulled. ``multi_line`` lets values hold line
    breaks; a part is then read by one task. Raises ``FileNotFoundError`` when no part
    holds a line (the union of nothing).

    Returns the typed rows; with ``with_quarantine`` also ``_file, _line, _reason``:
    the rows that do not fit, the lines of parts without a column of the schema, and
    one row with a NULL line for each part that gave no line at all, and for each
    gzip part that breaks off (none of its rows are taken; to see it, such parts are
    read one more time). Without ``skip_unreadable`` a corrupt part fails the read.
    """
    names = [f.name for f in schema.fields]
    def reader() -> DataFrameReader:
        return spark.read.option("ignoreCorruptFiles", str(skip_unreadable).lower())

    def broken_off(files) -> set[str]:
        packed = [unquote(r.file) for r in files if r.file.endswith(".gz")]
        return {r.file for r in _broken_off(spark, packed).collect()} if packed else set()

    if not skip_unreadable:
        # Before the headers are read, which may fail with Spark's own error.
        broken = broken_off(spark.read.format("binaryFile").load(paths)
                            .select(F.col("_metadata.file_path").alias("file")).collect())
        if broken:
            raise OSError(f"parts that break off: {sorted(broken)}")
    headers = _part_headers(reader(), paths)
    if not headers:
        raise FileNotFoundError(f"no CSV parts under {paths}")
    broken = broken_off(headers) if skip_unreadable else set()
    parts: dict[tuple[str, ...], list[str]] = {}
    for r in headers:
        if r.file in broken:
            continue
        columns = tuple(c.strip() for c in next(csv.reader([r.header.lstrip("\ufeff")])))
        parts.setdefault(columns, []).append(unquote(r.file))

    good, bad = [], []
    for columns, files in parts.items():
        if not set(columns) & set(names):
            bad.append(reader().text(files).select(
                F.col("_metadata.file_path").alias("_file"), F.col("value").alias("_line"),
                F.lit("no column of the schema").alias("_reason")).where(F.trim("_line") != ""))
            continue
        own = _part_schema(list(columns), schema)
        rows = (reader().schema(own).option("header", "true").option("mode", "PERMISSIVE")
                .option("columnNameOfCorruptRecord", _BAD).option("multiLine", str(multi_line).lower())
                .option("escape", '"').csv(files))
        # All values are converted, whichever are asked for, so that a row is good or
        # listed in every query.
        every = parsed_once(rows, F.col("_metadata.file_path").alias("_file"), *[F.col(c) for c in own.names])
        fits = every.where(F.col(_BAD).isNull())
        good.append(fits.select(*[(F.col(f.name) if f.name in own.names else F.lit(None).cast(f.dataType)).alias(f.name)
                                  for f in schema.fields]))
        bad.append(every.where(F.col(_BAD).isNotNull()).select(
            "_file", F.col(_BAD).alias("_line"), F.lit("does not fit the schema").alias("_reason")))
    found = reduce(DataFrame.unionByName, good) if good else spark.createDataFrame([], schema)
    if not with_quarantine:
        return found
    # Listed without reading their content.
    listed = (spark.read.format("binaryFile").load(paths).select(F.col("_metadata.file_path").alias("file")))
    seen = spark.createDataFrame([(r.file,) for r in headers], "file string")
    reasons = [(listed.join(seen, "file", "left_anti"), "no readable line")]
    if broken:
        reasons.append((spark.createDataFrame([(f,) for f in sorted(broken)], "file string"), "breaks off"))
    for files, reason in reasons:
        bad.append(files.select(F.col("file").alias("_file"), F.lit(None).cast("string").alias("_line"),
                                F.lit(reason).alias("_reason")))
    return found, reduce(DataFrame.unionByName, bad)
