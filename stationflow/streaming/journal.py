"""A journal of streaming progress (T8, T9): one JSON line per micro-batch, and the
exception of a query that fails, in files below a shared folder.

A query itself holds only its last progress reports; the journal holds all of them,
so that counts of a long stream add up and late rows can be found afterwards.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from stationflow.session import write_text

SCHEMA = ("query string, run string, batch_id long, input_rows long, dropped_rows long, state_rows long, "
          "watermark string, error string")


class ProgressJournal(StreamingQueryListener):
    """Add it with ``spark.streams.addListener``; it writes what it hears of."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _line(self, **row) -> None:
        write_text(self.spark, f"{self.path}/{uuid.uuid4().hex}.json", json.dumps(row) + "\n")

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = json.loads(event.progress.json)
        operators = p.get("stateOperators", [])
        self._line(query=p["id"], run=p["runId"], batch_id=p["batchId"], input_rows=p.get("numInputRows", 0),
                   dropped_rows=sum(o.get("numRowsDroppedByWatermark", 0) for o in operators),
                   state_rows=sum(o.get("numRowsTotal", 0) for o in operators),
                   watermark=p.get("eventTime", {}).get("watermark"), error=None)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            self._line(query=str(event.id), run=str(event.runId), error=event.exception)


def read_journal(spark: SparkSession, path: str) -> DataFrame:
    """The journal, a row for each micro-batch (a batch that was run again, as often)."""
    return spark.read.schema(SCHEMA).json(path).withColumn(
        "watermark", F.try_to_timestamp("watermark"))


def late_rows(messages: DataFrame, journal: DataFrame, ts_col: str) -> DataFrame:
    """The messages (with the ``batch_id`` that read them) that stateful operators drop
    as late: not above the watermark that was in force in the batch before. (An
    operator's late filter stays one batch behind the watermark that clears its state,
    so that operators above it still get what the one below gives out.)"""
    marks = journal.where("batch_id IS NOT NULL").groupBy((F.col("batch_id") + 1).alias("batch_id")) \
        .agg(F.max("watermark").alias("watermark"))
    return messages.join(marks, "batch_id").where(F.col(ts_col) <= F.col("watermark"))
