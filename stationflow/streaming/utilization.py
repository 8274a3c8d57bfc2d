"""The streaming utilization job (S8, T1-T9, F1): three message streams ->
parse -> watermark -> stream-stream joins -> report per micro-batch or per
closed event-time window -> idempotent sink.

Modes
-----
``snapshot``   the report of each micro-batch's joined rows, like a job that
               reports every poll: an hour spread over several batches gives
               several partial rows (one per batch).
``event_time`` true hourly values: a streaming ``groupBy(window, station, ...)``
               in append mode emits each station-hour once, after the watermark
               passes the end of the hour; all groups of one hour close in the
               same micro-batch, where the window totals are computed and joined.

Partitions: every micro-batch opens and commits every state store of every
partition, whatever it holds, so ``state_partitions`` follows the data of a
micro-batch (``partitions_for``) and not the session's setting for batch jobs.

State: the info/status join is keyed on (station_id, event time) and every
input carries a watermark, so join and aggregation state is purged as event
time advances (RocksDB state store, see ``session.DEFAULT_CONF``). Rows older
than the watermark are dropped and counted by Spark
(``numRowsDroppedByWatermark`` in the query progress). A micro-batch's own rows are all
in the state until the next one, so a backlog should come in micro-batches that follow
event time (``plans.utilization.land_feed_backlog``) and not in a single one.

Failures: an error in a batch fails the query; it restarts from the
checkpoint and re-runs the batch, whose output partition is overwritten.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stationflow.operators import metrics as M
from stationflow.operators import normalize as N
from stationflow.operators.join import SALT_BUCKETS, buckets_in_span, join_feeds, time_span_seconds
from stationflow.sources.sinks import write_batch
from stationflow.streaming.record import check_settings

WATERMARK = "1 minute"
PREVIEW_ROWS = 20
SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"
MIN_BATCHES = "spark.sql.streaming.minBatchesToRetain"
# Bytes of landed messages that a state partition holds (some 100,000 messages).
STATE_BYTES = 16 << 20


def partitions_for(spark: SparkSession, landed_bytes: int) -> int:
    """State partitions for a micro-batch (and what its state keeps of earlier ones) of
    so many bytes: at least one for each core, at most the session's shuffle partitions."""
    need = max(spark.sparkContext.defaultParallelism, -(-landed_bytes // STATE_BYTES))
    return max(1, min(int(spark.conf.get(SHUFFLE_PARTITIONS)), need))


def drop_batch_copies(messages: DataFrame) -> DataFrame:
    """Map-side combine for repeated deliveries: within every Arrow batch of
    every input partition, keep one copy of identical ``(key, value)``
    messages. Stateless and vectorized; memory is bounded by one batch
    (``spark.sql.execution.arrow.maxRecordsPerBatch``). The stateful
    de-duplication after it then receives at most one copy per batch."""
    def first_copies(batches):
        for pdf in batches:
            yield pdf[~pdf.duplicated(subset=["key", "value"])]

    msgs = messages.select(F.col("key").cast("string").alias("key"),
                           F.col("value").cast("string").alias("value"))
    return msgs.mapInPandas(first_copies, schema="key string, value string")


def watermarked_feeds(info_msgs: DataFrame, status_msgs: DataFrame, weather_msgs: DataFrame,
                      watermark: str = WATERMARK, *, dedupe_messages: bool = False
                      ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Parse the three message streams, keep joinable rows, set watermarks.

    ``dedupe_messages`` drops repeated deliveries of a message (same station
    and instant; same instant for weather) within the watermark delay, with
    state bounded by the watermark; identical copies are first collapsed
    map-side (``drop_batch_copies``), so a message repeated across a third of
    the input does not land whole on one state partition. Off by default:
    repeated readings then fan out in the joins, as an equi-join does.
    """
    if dedupe_messages:
        info_msgs, status_msgs, weather_msgs = (
            drop_batch_copies(m) for m in (info_msgs, status_msgs, weather_msgs))
    info, _ = N.quarantine_parsed(N.parse_info(info_msgs), "info_timestamp")
    status, _ = N.quarantine_parsed(N.parse_status(status_msgs), "status_timestamp")
    weather, _ = N.quarantine_parsed(N.parse_weather(weather_msgs), "timestamp", id_col=None)
    info = info.withWatermark("info_timestamp", watermark)
    status = status.withWatermark("status_timestamp", watermark)
    weather = weather.withWatermark("timestamp", watermark)
    if dedupe_messages:
        info = info.dropDuplicatesWithinWatermark(["station_id", "info_timestamp"])
        status = status.dropDuplicatesWithinWatermark(["station_id", "status_timestamp"])
        weather = weather.dropDuplicatesWithinWatermark(["timestamp"])
    return info, status, weather


def start_quarantine_stream(info_msgs: DataFrame, status_msgs: DataFrame,
                            weather_msgs: DataFrame, *, path: str, checkpoint_path: str,
                            trigger: dict | None = None) -> StreamingQuery:
    """Append the messages the report cannot use (malformed JSON, no station
    id, unreadable time) to JSON files under ``path`` with their feed name.
    Stateless; run it beside the report query on the same message sources."""
    bad = (N.unusable_messages(info_msgs, "info")
           .unionByName(N.unusable_messages(status_msgs, "status"))
           .unionByName(N.unusable_messages(weather_msgs, "weather")))
    writer = (bad.writeStream.outputMode("append").format("json")
              .option("path", path).option("checkpointLocation", checkpoint_path))
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def _report_batch(builder, sink_path: str, fmt: str, window_seconds: int):
    """foreachBatch body: persist once, skip empty, report, write idempotently.

    One global min/max over the batch's time column both detects an empty
    batch (no span: joined rows always carry a time) and bounds the number of
    windows for the broadcast of the window totals.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            span = time_span_seconds(batch, builder.ts_col)
            if span is None:
                return
            bound = buckets_in_span(span, window_seconds)
            if fmt == "console":  # S11 preview, opt-in: first rows to the driver log
                print(f"--- batch {batch_id} ---")
                builder(batch, bound).show(PREVIEW_ROWS, truncate=False)
            else:
                write_batch(builder(batch, bound), sink_path, batch_id, fmt=fmt)
        finally:
            batch.unpersist()
    return run


class _SnapshotReport:
    ts_col = "timestamp"

    def __init__(self, window_duration: str):
        self.window_duration = window_duration

    def __call__(self, joined: DataFrame, bound: int) -> DataFrame:
        return M.utilization_report(joined, window_duration=self.window_duration,
                                    windows_bound=bound)


class _ClosedWindowReport:
    ts_col = "window_start"

    def __call__(self, hourly: DataFrame, bound: int) -> DataFrame:
        hourly = hourly.withColumn("window", F.struct(
            F.col("window_start").alias("start"), F.col("window_end").alias("end")))
        return M.report_from_hourly(hourly.drop("window_start", "window_end"),
                                    windows_bound=bound)


def start_feeds_stream(info: DataFrame, status: DataFrame, weather: DataFrame, *,
                       sink_path: str, checkpoint_path: str, mode: str = "event_time",
                       window_duration: str = M.WINDOW_DURATION,
                       trigger: dict | None = None, fmt: str = "parquet",
                       query_name: str | None = None, salt_buckets: int = SALT_BUCKETS,
                       settings: dict | None = None,
                       state_partitions: int | None = None,
                       retain_batches: int | None = None) -> StreamingQuery:
    """Start the report over parsed, watermarked feed streams (info:
    key, station_id, capacity, info_timestamp; status: key, station_id,
    num_bikes_available, status_timestamp; weather: timestamp, temperature,
    wind_speed, cloudiness) - from ``watermarked_feeds`` or from any typed
    streaming source with watermarks on those time columns. What the state depends on
    (``settings`` are more of it) is stored beside the checkpoint, and a restart with
    other values is refused. ``state_partitions`` (default: the session's shuffle
    partitions) holds for the first start; the checkpoint keeps it. ``retain_batches``
    (default: the session's ``minBatchesToRetain``) batches can be gone back to; older
    state files are deleted."""
    check_settings(info.sparkSession, checkpoint_path, {
        **(settings or {}), "mode": mode, "window_duration": window_duration, "salt_buckets": salt_buckets})
    joined = join_feeds(info, status, weather, salt_buckets=salt_buckets)
    seconds = M.duration_seconds(window_duration)
    if mode == "snapshot":
        stream, body = joined, _report_batch(_SnapshotReport(window_duration), sink_path,
                                             fmt, seconds)
    elif mode == "event_time":
        hourly = M.station_hourly(M.clean_joined(joined), window_duration)
        stream = hourly.select("*", F.col("window.start").alias("window_start"),
                               F.col("window.end").alias("window_end")).drop("window")
        body = _report_batch(_ClosedWindowReport(), sink_path, fmt, seconds)
    else:
        raise ValueError(f"mode must be 'snapshot' or 'event_time', not {mode!r}")
    writer = (stream.writeStream.outputMode("append").foreachBatch(body)
              .option("checkpointLocation", checkpoint_path))
    if query_name:
        writer = writer.queryName(query_name)
    if trigger:
        writer = writer.trigger(**trigger)
    # The query works in a copy of the session that it makes when it starts.
    conf = info.sparkSession.conf
    own = {k: str(v) for k, v in ((SHUFFLE_PARTITIONS, state_partitions), (MIN_BATCHES, retain_batches))
           if v is not None}
    before = {k: conf.get(k) for k in own}
    try:
        for k, v in own.items():
            conf.set(k, v)
        return writer.start()
    finally:
        for k, v in before.items():
            conf.set(k, v)


def start_utilization_stream(info_msgs: DataFrame, status_msgs: DataFrame,
                             weather_msgs: DataFrame, *, sink_path: str,
                             checkpoint_path: str, mode: str = "event_time",
                             watermark: str = WATERMARK,
                             window_duration: str = M.WINDOW_DURATION,
                             trigger: dict | None = None, fmt: str = "parquet",
                             query_name: str | None = None,
                             dedupe_messages: bool = False,
                             salt_buckets: int = SALT_BUCKETS,
                             state_partitions: int | None = None,
                             retain_batches: int | None = None) -> StreamingQuery:
    """Start the job on the three keyed message streams; returns the query.

    ``trigger`` is passed to ``DataStreamWriter.trigger`` (for example
    ``{"processingTime": "5 minutes"}`` or ``{"availableNow": True}``); the
    default runs batches as fast as data arrives.
    """
    info, status, weather = watermarked_feeds(info_msgs, status_msgs, weather_msgs, watermark,
                                              dedupe_messages=dedupe_messages)
    return start_feeds_stream(info, status, weather, sink_path=sink_path,
                              checkpoint_path=checkpoint_path, mode=mode,
                              window_duration=window_duration, trigger=trigger, fmt=fmt,
                              query_name=query_name, salt_buckets=salt_buckets,
                              state_partitions=state_partitions, retain_batches=retain_batches,
                              settings={"watermark": watermark, "dedupe_messages": dedupe_messages})


def dropped_by_watermark(query: StreamingQuery) -> int:
    """Rows dropped as late by the stateful operators, summed over the
    progress reports the query still holds."""
    return sum(op.get("numRowsDroppedByWatermark", 0) or 0
               for p in query.recentProgress for op in p.get("stateOperators", []))
