"""Streaming ingest (S4-S6 as a stream): landed raw payloads -> keyed messages
-> a topic or a message folder.

This is the data side of the polling producer: whatever fetches the feeds
lands each response as one JSON line ``{"stamp": "...Z", "payload": "..."}``
(one stamp per poll, shared by the three feeds); this job flattens every new
payload into one message per station (or per weather reading) in parallel
and publishes the messages. Payloads without a station list are written to a
quarantine folder instead of being dropped. Progress is tracked by the
checkpoint, and both folders are written by batch id: a batch replayed after a
failure replaces what it wrote before. A topic may get a replayed batch twice
(the consumer's in-watermark de-duplication drops such copies).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from stationflow.operators import normalize as N
from stationflow.sources.feeds import read_payloads
from stationflow.sources.sinks import write_batch, write_messages


def flatten_feed(payloads: DataFrame, feed: str):
    """(messages, quarantine) for one feed: ``info``, ``status`` or ``weather``."""
    if feed in ("info", "status"):
        return N.flatten_station_payloads(payloads, feed, with_quarantine=True)
    if feed == "weather":
        return N.flatten_weather_payloads(payloads, with_quarantine=True)
    raise ValueError(f"unknown feed {feed!r}")


def start_ingest_stream(spark, payload_path: str, feed: str, *, checkpoint_path: str,
                        sink: str = "files", path: str | None = None,
                        topic: str | None = None, bootstrap_servers: str | None = None,
                        quarantine_path: str | None = None,
                        trigger: dict | None = None,
                        max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start publishing the messages of one feed; returns the running query."""
    opts = {"maxFilesPerTrigger": str(max_files_per_trigger)} if max_files_per_trigger else None
    payloads = read_payloads(spark, payload_path, streaming=True, options=opts)

    def publish(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            msgs, bad = flatten_feed(batch, feed)
            if quarantine_path:
                write_batch(bad, quarantine_path, batch_id, fmt="json")
            write_messages(msgs, sink=sink, path=path, topic=topic,
                           bootstrap_servers=bootstrap_servers, batch_id=batch_id)
        finally:
            batch.unpersist()

    writer = (payloads.writeStream.foreachBatch(publish)
              .option("checkpointLocation", checkpoint_path))
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()
