"""Composed plans over the test tables: events -> three feeds -> joined feed
-> utilization report, and the same report from landed message files or from
the streaming job.

The batch plans return lazy DataFrames; their only eager step is the one-row
span aggregate that bounds the broadcast sides. ``land_feed_messages``,
``land_feed_backlog`` and ``stream_report_from_events`` write files (landed
messages, the stream's sink and checkpoint) under ``spark.checkpoint.dir``
before returning a reader."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow.functions import safe_timestamp
from stationflow.operators import join as J
from stationflow.operators import metrics as M
from stationflow.session import _file_system
from stationflow.sources import events as E

# Events that a slice of a landed backlog takes for each core; its messages, and what
# the join and de-duplication state keeps of them, must fit in the memory of a core.
SLICE_ROWS = 75_000
# Messages that a task writes when a backlog is landed.
FILE_MESSAGES = 200_000
# Micro-batches whose state a replayed backlog can go back to.
RETAINED_BATCHES = 2


@dataclass
class Feeds:
    info: DataFrame
    status: DataFrame
    weather: DataFrame
    events: DataFrame

    @cached_property
    def span_seconds(self) -> int | None:
        """Event-time span of the source, measured on first use (one global
        min/max aggregate over the ``ts`` column only)."""
        return J.time_span_seconds(self.events, "ts")

    @property
    def weather_bound(self) -> int:
        return J.buckets_in_span(self.span_seconds, E.SNAPSHOT_SECONDS)

    def windows_bound(self, window_duration: str = M.WINDOW_DURATION) -> int:
        return J.buckets_in_span(self.span_seconds, M.duration_seconds(window_duration))


def feeds_from_events(spark: SparkSession, sf_dir: str) -> Feeds:
    events = E.read_table(spark, sf_dir, "events")
    snaps = E.station_snapshots(events)
    return Feeds(E.info_feed(snaps), E.status_feed(snaps), E.weather_feed(snaps), events)


def joined_from_events(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Feeds]:
    feeds = feeds_from_events(spark, sf_dir)
    joined = J.join_feeds(feeds.info, feeds.status, feeds.weather,
                          weather_rows_bound=feeds.weather_bound)
    return joined, feeds


def joined_from_uneven(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Feeds]:
    """The joins over feeds with missing, repeated and NULL-keyed readings."""
    events = E.read_table(spark, sf_dir, "events")
    feeds = Feeds(*E.uneven_feeds(E.station_snapshots(events)), events)
    # At most two readings of an instant.
    return J.join_feeds(feeds.info, feeds.status, feeds.weather,
                        weather_rows_bound=2 * feeds.weather_bound), feeds


def report_from_events(spark: SparkSession, sf_dir: str,
                       window_duration: str = M.WINDOW_DURATION) -> DataFrame:
    """The flagship: hourly utilization report over the events-derived feeds."""
    joined, feeds = joined_from_events(spark, sf_dir)
    return M.utilization_report(joined, window_duration=window_duration,
                                windows_bound=feeds.windows_bound(window_duration))


def flatten_window(df: DataFrame, col: str = "window") -> DataFrame:
    """Replace a window struct by window_start / window_end columns."""
    rest = [c for c in df.columns if c != col]
    return df.select(*rest, F.col(f"{col}.start").alias("window_start"),
                     F.col(f"{col}.end").alias("window_end"))


def _feed_messages(snaps: DataFrame) -> dict[str, DataFrame]:
    """The keyed messages of each feed, as producers publish them."""
    from stationflow.operators import normalize as N

    frames = {v: N.flatten_station_payloads(E.station_payloads(snaps, v), v)
              for v in ("info", "status")}
    frames["weather"] = N.flatten_weather_payloads(E.weather_payloads(E.weather_feed(snaps)))
    return frames


def land_feed_messages(spark: SparkSession, sf_dir: str, base: str,
                       copies: int = 1) -> dict[str, str]:
    """Land the three events-derived feeds as keyed JSON messages under
    ``base`` (as producers would) and return the folder of each feed.
    ``copies`` > 1 lands every message that many times (repeated delivery).

    One write job: the three message frames are unioned with their feed name
    and written partitioned by it, so their stages run side by side.
    """
    frames = _feed_messages(E.station_snapshots(E.read_table(spark, sf_dir, "events")))
    union = None
    for feed, msgs in frames.items():
        tagged = msgs.select(F.lit(feed).alias("feed"), "key", "value")
        for _ in range(copies):
            union = tagged if union is None else union.unionByName(tagged)
    union.write.partitionBy("feed").json(base)
    return {f: f"{base}/feed={f}" for f in frames}


@dataclass
class Backlog:
    """Landed feeds that a stream reads in the order of their event times: a trigger
    takes ``files`` files of each feed, one slice of time."""
    paths: dict[str, str]
    files: int
    slices: int
    largest: int            # events of the largest slice


def _slice_number(slot: str, cuts: list[int]) -> Column:
    """How many cuts are not above the slot, by a tree of comparisons."""
    def between(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        mid = (low + high) // 2
        return F.when(F.col(slot) < cuts[mid], between(low, mid)).otherwise(between(mid + 1, high))
    return between(0, len(cuts))


def _order_files(spark: SparkSession, path: str, slices: int, files: int) -> None:
    """Give the files of a landed feed the order of their slices (the file source takes
    files in the order of their times), and every slice as many: empty ones are added."""
    fs, root = _file_system(spark, path)
    fs.mkdirs(root)
    missing = {(f"slice={number}", f"file={n}") for number in range(slices) for n in range(files)}
    ordered = []
    listed = fs.listFiles(root, True)
    while listed.hasNext():
        file = listed.next().getPath()
        folder = (file.getParent().getParent().getName(), file.getParent().getName())
        missing.remove(folder)                  # a second file would shift all slices after it
        ordered.append((folder[0], file))
    for one, n in missing:
        file = root.suffix(f"/{one}/{n}/part-00000.json")
        fs.create(file, False).close()
        ordered.append((one, file))
    for one, file in ordered:
        time = 1_000_000_000_000 + 1000 * int(one.split("=")[1])
        fs.setTimes(file, time, -1)
    # In another order the stream would drop rows as late.
    if fs.getFileStatus(file).getModificationTime() != time:
        raise OSError(f"the file system of {path} does not keep the times that its files are given")


def land_feed_backlog(spark: SparkSession, sf_dir: str, base: str, copies: int = 1) -> Backlog:
    """The messages of ``land_feed_messages`` in slices of event time, so that a stream
    that reads them slice by slice holds the state of one slice and not of them all.

    A slice takes about ``SLICE_ROWS`` events for each core, or one instant that has more;
    the cuts lie between instants. The copies of a message are in the same slice, in
    different files.
    """
    events = E.read_table(spark, sf_dir, "events").where("ts IS NOT NULL")
    slots = events.select(E._epoch_slot("ts").alias("slot"))
    total = slots.count()
    cores = spark.sparkContext.defaultParallelism
    count = -(-total // (SLICE_ROWS * cores))
    cuts, largest = [], total
    if count > 1:
        at = slots.agg(F.percentile_approx("slot", [i / count for i in range(1, count)],
                                           max(10_000, 100 * count))).first()[0]
        cuts = sorted({slot + 1 for slot in at})
        largest = slots.groupBy(_slice_number("slot", cuts).alias("slice")).count() \
            .agg(F.max("count")).first()[0]
    files = max(copies, cores, -(-largest * copies // SLICE_ROWS))

    union = None
    for feed, msgs in _feed_messages(E.station_snapshots(events)).items():
        # Keys end with the instant; messages without a readable one are used nowhere.
        tagged = msgs.select(F.lit(feed).alias("feed"), "key", "value",
                             safe_timestamp(F.substring_index("key", "_", -1)).alias("ts")) \
            .withColumn("slot", E._epoch_slot("ts"))
        union = tagged if union is None else union.unionByName(tagged)
    union = union.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies)))) \
        .withColumns({"slice": _slice_number("slot", cuts),
                      "file": F.pmod(F.xxhash64("key") + F.col("copy"), F.lit(files))})
    parts = -(-2 * total * copies // FILE_MESSAGES)
    (union.select("feed", "slice", "file", "key", "value")
     .repartition(max(files, parts), "feed", "slice", "file")
     .write.partitionBy("feed", "slice", "file").option("compression", "gzip").json(base))
    paths = {feed: f"{base}/feed={feed}" for feed in ("info", "status", "weather")}
    for path in paths.values():
        _order_files(spark, path, len(cuts) + 1, files)
    return Backlog(paths, files, len(cuts) + 1, largest)


def stream_report_from_events(spark: SparkSession, sf_dir: str, mode: str, *,
                              copies: int = 1, dedupe: bool = False) -> DataFrame:
    """Run the streaming job over the landed feeds until all landed data is
    processed (``availableNow``) and return what its sink holds.

    In event-time mode the backlog is read in slices of event time, a micro-batch each.
    A snapshot report is one of a micro-batch, so there all is read at once."""
    from stationflow.session import shared_path, stored_bytes
    from stationflow.sources.feeds import read_messages
    from stationflow.streaming.utilization import STATE_BYTES, partitions_for, start_utilization_stream

    base = shared_path(spark, f"stream_{mode}")
    if mode == "event_time":
        backlog = land_feed_backlog(spark, sf_dir, base, copies=copies)
        paths, files = backlog.paths, backlog.files
        held = -(-backlog.largest // SLICE_ROWS) * STATE_BYTES     # a partition for what a core takes
    else:
        paths, files = land_feed_messages(spark, sf_dir, base, copies=copies), None
        held = sum(stored_bytes(spark, p) for p in paths.values())
    query = start_utilization_stream(
        *(read_messages(spark, path=paths[f], max_files_per_trigger=files) for f in ("info", "status", "weather")),
        sink_path=f"{base}/report", checkpoint_path=f"{base}/checkpoint", mode=mode,
        trigger={"availableNow": True}, dedupe_messages=dedupe,
        state_partitions=partitions_for(spark, held),
        retain_batches=RETAINED_BATCHES if mode == "event_time" else None)
    query.awaitTermination()
    return spark.read.parquet(f"{base}/report")


def report_from_messages(spark: SparkSession, info_path: str, status_path: str,
                         weather_path: str, *,
                         window_duration: str = M.WINDOW_DURATION) -> DataFrame:
    """Batch report over landed message files (a backfill of the landing zone).

    The weather feed is small (one reading per poll), so its exact row count
    is the bound for its broadcast; the window bound comes from the span of
    the weather readings, whose instants are the only ones that can join.
    """
    from stationflow.operators import normalize as N
    from stationflow.sources.feeds import read_messages

    def parsed(path, parse):
        return parse(read_messages(spark, path=path, streaming=False))

    info, _ = N.quarantine_parsed(parsed(info_path, N.parse_info), "info_timestamp")
    status, _ = N.quarantine_parsed(parsed(status_path, N.parse_status), "status_timestamp")
    weather, _ = N.quarantine_parsed(parsed(weather_path, N.parse_weather), "timestamp",
                                     id_col=None)
    bounds = weather.agg(F.count("*").alias("n"), F.expr(
        "timestampdiff(SECOND, min(timestamp), max(timestamp))").alias("span")).first()
    joined = J.join_feeds(info, status, weather, weather_rows_bound=bounds["n"])
    return M.utilization_report(
        joined, window_duration=window_duration,
        windows_bound=J.buckets_in_span(bounds["span"], M.duration_seconds(window_duration)))
