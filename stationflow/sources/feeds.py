"""Keyed message sources (S1): a Kafka topic or a landing-zone folder of JSON
lines with ``key`` and ``value`` text, read as a batch or as a stream.

Both give ``key string, value string``; the parse step does not care where the
messages came from. Kafka needs the ``spark-sql-kafka-0-10`` package matching
the Spark build on the classpath (supplied through spark-submit); the broker
list and topics come from the caller, never from code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow import schemas as S


def read_messages(spark: SparkSession, *, source: str = "files", path: str | None = None,
                  topic: str | None = None, bootstrap_servers: str | None = None,
                  streaming: bool = True, starting_offsets: str = "earliest",
                  max_files_per_trigger: int | None = None,
                  max_offsets_per_trigger: int | None = None,
                  min_partitions: int | None = None,
                  options: dict[str, str] | None = None) -> DataFrame:
    """Messages of one feed as ``key string, value string``.

    ``source="files"``: JSON lines under ``path`` with the fixed MESSAGE schema
    (no inference). ``source="kafka"``: one topic; ``min_partitions`` lets a
    single-partition topic fan out over many tasks. Offsets and file progress
    are tracked by the stream's checkpoint, so a restart resumes where it left.
    ``max_files_per_trigger`` and ``max_offsets_per_trigger`` bound a micro-batch.
    Folders are read with what lies below them (the ingest job writes one folder
    per batch).
    """
    opts = dict(options or {})
    if source == "files":
        opts.setdefault("recursiveFileLookup", "true")
        if not path:
            raise ValueError("files source needs a path")
        if streaming and max_files_per_trigger:
            opts["maxFilesPerTrigger"] = str(max_files_per_trigger)
        reader = spark.readStream if streaming else spark.read
        return reader.schema(S.MESSAGE).options(**opts).json(path)
    if source == "kafka":
        if not (topic and bootstrap_servers):
            raise ValueError("kafka source needs topic and bootstrap_servers")
        opts.update({"kafka.bootstrap.servers": bootstrap_servers, "subscribe": topic,
                     "startingOffsets": starting_offsets})
        if min_partitions:
            opts["minPartitions"] = str(min_partitions)
        if streaming and max_offsets_per_trigger:
            opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
        reader = spark.readStream if streaming else spark.read
        raw = reader.format("kafka").options(**opts).load()
        return raw.select(F.col("key").cast("string").alias("key"),
                          F.col("value").cast("string").alias("value"))
    raise ValueError(f"unknown source {source!r}")


def read_payloads(spark: SparkSession, path: str, *, streaming: bool = False,
                  options: dict[str, str] | None = None) -> DataFrame:
    """Landed raw payloads: JSON lines ``{"stamp": "...Z", "payload": "<json text>"}``."""
    reader = spark.readStream if streaming else spark.read
    return reader.schema("stamp string, payload string").options(**(options or {})).json(path)
