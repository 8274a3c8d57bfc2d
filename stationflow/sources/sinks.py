"""Sinks (S6, S8-S10): keyed messages, append-only Parquet / CSV, and a per-batch
writer for ``foreachBatch`` that publishes each batch once."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stationflow.session import exists, publish


def write_messages(messages: DataFrame, *, sink: str = "files", path: str | None = None,
                   topic: str | None = None, bootstrap_servers: str | None = None,
                   mode: str = "append", batch_id: int | None = None) -> None:
    """Batch write of ``key, value`` messages to a topic or a landing folder. With
    ``batch_id`` a folder gets each micro-batch once, however often it is replayed;
    a topic has no such key and gets a replayed batch again."""
    if sink == "files" and batch_id is not None:
        write_batch(messages.select("key", "value"), path, batch_id, fmt="json")
    elif sink == "files":
        messages.select("key", "value").write.mode(mode).json(path)
    elif sink == "kafka":
        (messages.select("key", "value").write.format("kafka")
         .option("kafka.bootstrap.servers", bootstrap_servers).option("topic", topic).save())
    else:
        raise ValueError(f"unknown sink {sink!r}")


def flatten_structs(df: DataFrame) -> DataFrame:
    """Top-level struct columns -> ``<name>_<field>`` columns (CSV holds no structs)."""
    cols = []
    for field in df.schema.fields:
        if isinstance(field.dataType, StructType):
            cols += [F.col(f"`{field.name}`.`{sub.name}`").alias(f"{field.name}_{sub.name}")
                     for sub in field.dataType.fields]
        else:
            cols.append(F.col(f"`{field.name}`"))
    return df.select(*cols)


def append_csv(df: DataFrame, path: str) -> None:
    """Append with a header row; structs are flattened first."""
    flatten_structs(df).write.mode("append").option("header", "true").csv(path)


def append_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Append Parquet, optionally partitioned."""
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_batch(df: DataFrame, path: str, batch_id: int, *, fmt: str = "parquet") -> bool:
    """Publish one micro-batch as the folder ``batch_id=<n>``, once: it is written to a
    hidden folder, which readers skip, and renamed when it is whole. A batch
    replayed after a failure finds its folder and leaves it, so batch readers and
    streams that follow the folder get every row once. False: it was there."""
    if fmt not in ("parquet", "csv", "json"):
        raise ValueError(f"unknown format {fmt!r}")
    spark = df.sparkSession
    target = f"{path.rstrip('/')}/batch_id={int(batch_id)}"
    if exists(spark, target):
        return False
    staged = f"{path.rstrip('/')}/_staged/{uuid.uuid4().hex}"
    writer = (flatten_structs(df) if fmt == "csv" else df).write.format(fmt)
    (writer.option("header", "true") if fmt == "csv" else writer).save(staged)
    return publish(spark, staged, target)
