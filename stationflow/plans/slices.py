"""The streaming job over a landing zone that fills up slice by slice, as it does in
operation: every micro-batch reads one event-time slice of the three feeds, so join and
aggregation state is purged between batches, and a report of a batch holds one slice.

Slices are ``SLICE_SECONDS`` long and begin half an hour past an hour, so that hours are
cut. With ``late`` the status messages of some stations (``is_late``) land ``DELAY``
slices after their own.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow.operators import normalize as N
from stationflow.session import _file_system, shared_path, stored_bytes
from stationflow.sources import events as E
from stationflow.sources.feeds import read_messages
from stationflow.streaming.journal import ProgressJournal, late_rows, read_journal
from stationflow.streaming.utilization import partitions_for, start_utilization_stream

SLICE_SECONDS = 259_200
SHIFT_SECONDS = 1_800
DELAY = 2
LATE_STATIONS = 7


def seconds(ts: str) -> Column:
    return F.expr(f"timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', CAST({ts} AS TIMESTAMP_NTZ))")


def slice_of(ts: str) -> Column:
    return F.floor((seconds(ts) + SHIFT_SECONDS) / SLICE_SECONDS)


def is_late(station: str, ts: str) -> Column:
    """Every 7th station, at full hours."""
    return (F.pmod(F.col(station).cast("long"), F.lit(LATE_STATIONS)) == 0) & (F.pmod(seconds(ts), F.lit(3600)) == 0)


def land_slices(spark: SparkSession, sf_dir: str, base: str, late: bool = False) -> dict[str, str]:
    """Land the feeds as keyed messages, a file for each feed and slice, in the order
    of the slices, and return the folder of each feed."""
    snaps = E.station_snapshots(E.read_table(spark, sf_dir, "events"))
    delayed = is_late("station_id", "ts") if late else F.lit(False)
    rows = None
    for feed in ("info", "status"):
        own = snaps.withColumn("slice", slice_of("ts") + F.when(delayed & F.lit(feed == "status"), F.lit(DELAY)).otherwise(0))
        value = {"info": F.struct("station_id", F.struct(F.col("stamp").alias("timestamp")).alias("metadata"), "capacity"),
                 "status": F.struct("station_id", F.col("stamp").alias("timestamp"), "num_bikes_available")}[feed]
        own = own.withColumn("stamp", E.iso_utc("ts"))
        msgs = own.select(F.lit(feed).alias("feed"), "slice", E.message_key("station_id", "stamp").alias("key"),
                          F.to_json(value, N._KEEP_NULLS).alias("value"))
        rows = msgs if rows is None else rows.unionByName(msgs)
    weather = E.weather_feed(snaps).withColumn("stamp", E.iso_utc("timestamp"))
    rows = rows.unionByName(weather.select(
        F.lit("weather").alias("feed"), slice_of("timestamp").alias("slice"),
        F.concat_ws("_", F.lit("weather"), "stamp").alias("key"),
        F.to_json(F.struct("temperature", F.col("wind_speed").alias("windspeed"), F.col("cloudiness").alias("clouds"),
                           F.struct(F.col("stamp").alias("timestamp")).alias("metadata"))).alias("value")))
    # Every feed has a file for every slice, so that a trigger takes one slice of each;
    # a slice without messages has an empty one.
    rows.repartition("feed", "slice").write.partitionBy("feed", "slice").json(base)
    found = sorted({int(r[0]) for r in spark.read.schema("feed string, slice long").json(base)
                    .select("slice").distinct().collect()})
    fs, _ = _file_system(spark, base)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for feed in ("info", "status", "weather"):
        for place, number in enumerate(found):
            folder = path(f"{base}/feed={feed}/slice={number}")
            if not fs.exists(folder):
                fs.mkdirs(folder)
                fs.create(path(f"{base}/feed={feed}/slice={number}/part-00000.json"), False).close()
            # The file source takes files in the order of their times.
            for f in fs.listStatus(folder):
                fs.setTimes(f.getPath(), 1_000_000_000_000 + 1000 * place, -1)
    return {feed: f"{base}/feed={feed}" for feed in ("info", "status", "weather")}


def largest_slice(spark: SparkSession, feeds: dict[str, str]) -> int:
    """Bytes of the largest slice, all feeds together."""
    size: Counter = Counter()
    for folder in feeds.values():
        fs, where = _file_system(spark, folder)
        for f in fs.listStatus(where):
            if f.isDirectory():
                size[f.getPath().getName()] += stored_bytes(spark, f.getPath().toString())
    return max(size.values(), default=0)


def run_slices(spark: SparkSession, sf_dir: str, mode: str, late: bool = False) -> dict[str, str]:
    """Run the job over the landed slices, one each micro-batch; the folders of the
    report, the journal and the feeds."""
    base = shared_path(spark, f"slices_{mode}")
    feeds = land_slices(spark, sf_dir, base, late=late)
    journal = ProgressJournal(spark, f"{base}_journal")
    spark.streams.addListener(journal)
    held = 2 * largest_slice(spark, feeds)         # a slice, and what is kept of the one before
    try:
        query = start_utilization_stream(
            *(read_messages(spark, path=feeds[f], max_files_per_trigger=1) for f in ("info", "status", "weather")),
            sink_path=f"{base}_report", checkpoint_path=f"{base}_checkpoint", mode=mode, trigger={"availableNow": True},
            state_partitions=partitions_for(spark, held))
        query.awaitTermination()
        # Events reach listeners after the query has ended.
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(60_000)
    finally:
        spark.streams.removeListener(journal)
    return {**feeds, "report": f"{base}_report", "journal": f"{base}_journal", "checkpoint": f"{base}_checkpoint"}


def late_status(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """The status messages that the job dropped as late: landed messages by the
    batch that read them, held against the watermarks in the journal."""
    landed = (spark.read.schema("key string, value string, slice long").option("basePath", paths["status"])
              .json(paths["status"]))
    order = landed.select("slice").distinct()
    # Batches are numbered in the order of the slices; slices are few (one a trigger).
    places = spark.createDataFrame(
        [(r[0], i) for i, r in enumerate(sorted(order.collect()))], "slice long, batch_id long")
    parsed = N.parse_status(landed.select("key", "value")).select("key", "station_id", "status_timestamp")
    keyed = landed.select("key", "slice").join(parsed, "key").join(F.broadcast(places), "slice")
    return late_rows(keyed, read_journal(spark, paths["journal"]), "status_timestamp").select(
        "station_id", "status_timestamp", "slice")
