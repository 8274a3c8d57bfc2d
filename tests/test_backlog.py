"""A landed backlog is streamed in slices of event time: state of a slice, same report."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stationflow.operators import join as J
from stationflow.plans import utilization as U
from stationflow.plans.queries import q_stream_dedupe, q_stream_event_time
from stationflow.session import _file_system
from stationflow.sources.feeds import read_messages
from stationflow.streaming.journal import ProgressJournal, read_journal

T0 = dt.datetime(2025, 3, 1, 9, 7)


@pytest.fixture
def events(spark, tmp_shared, monkeypatch):
    """Two days of a few stations, with an instant of far more rows than the others,
    repeated events, times and users that are NULL; slices of 80 events."""
    monkeypatch.setattr(U, "SLICE_ROWS", 20, raising=False)
    rows = [(T0 + dt.timedelta(minutes=13 * i), i % 9, "view", f'{{"k": {i % 100}}}') for i in range(220)]
    rows += [(T0 + dt.timedelta(hours=20, minutes=i % 7), 100 + i, "click", '{"k": 3}') for i in range(90)]
    rows += rows[:20] + [(None, 4, "view", '{"k": 1}')] * 5 + [(T0 + dt.timedelta(hours=30), None, "view", None)] * 5
    (spark.createDataFrame(rows, "ts timestamp_ntz, user_id long, event_type string, props string")
     .coalesce(1).write.parquet(f"{tmp_shared}/sf/events.parquet"))
    return f"{tmp_shared}/sf"


def _rows(df):
    times = {c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")}
    rates = {c: F.round(c, 6) for c in df.columns if "utili" in c}
    return sorted(tuple(map(str, r)) for r in df.withColumns({**times, **rates}).select(*sorted(df.columns)).collect())


@pytest.mark.parametrize("query", [q_stream_event_time, q_stream_dedupe])
def test_state_holds_slices_of_a_backlog_and_the_report_is_whole(spark, events, tmp_shared, query):
    retained = spark.conf.get("spark.sql.streaming.minBatchesToRetain")
    journal = ProgressJournal(spark, f"{tmp_shared}/journal")
    spark.streams.addListener(journal)
    try:
        got = _rows(query(spark, events))
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(60_000)
    finally:
        spark.streams.removeListener(journal)
    last = F.lit(T0 + dt.timedelta(minutes=13 * 219 - 20)).cast("timestamp_ntz")
    report = U.report_from_events(spark, events)
    assert got == _rows(report.where(F.col("window_end").cast("timestamp_ntz") <= last))
    assert len(got) > 250
    batches = read_journal(spark, f"{tmp_shared}/journal").collect()
    assert sum(b.input_rows > 0 for b in batches) >= 4 and all(b.dropped_rows == 0 for b in batches)
    # the weather join alone would keep the 220 readings once for each salt
    assert max(b.state_rows for b in batches) < J.SALT_BUCKETS * 220
    assert spark.conf.get("spark.sql.streaming.minBatchesToRetain") == retained


def test_backlog_holds_the_landed_messages_in_order(spark, events, tmp_shared):
    backlog = U.land_feed_backlog(spark, events, f"{tmp_shared}/backlog", copies=2)
    landed = U.land_feed_messages(spark, events, f"{tmp_shared}/landed", copies=2)
    assert backlog.slices >= 4 and backlog.largest >= 90
    for feed, path in backlog.paths.items():
        found = read_messages(spark, path=path, streaming=False)
        assert sorted(found.collect()) == sorted(read_messages(spark, path=landed[feed], streaming=False).collect())
        fs, where = _file_system(spark, path)
        listed, files = fs.listFiles(where, True), []
        while listed.hasNext():
            f = listed.next()
            files.append((f.getModificationTime(), f.getPath().getParent().getParent().getName().split("=")[1]))
        assert len(files) == backlog.slices * backlog.files
        # a trigger takes the files of one slice
        files.sort()
        taken = [{number for _, number in files[i:i + backlog.files]} for i in range(0, len(files), backlog.files)]
        assert taken == [{str(n)} for n in range(backlog.slices)]
        # the copies of a message are in one slice, in two files
        copies = found.withColumn("file", F.input_file_name()).groupBy("key", "value").agg(
            F.count_distinct("file").alias("files"),
            F.count_distinct(F.regexp_extract("file", "slice=([0-9]+)", 1)).alias("slices"))
        assert copies.where("files != 2 OR slices != 1").count() == 0
