"""Structured Streaming job: multi-batch event time, state, late data,
restart from checkpoint, snapshot partials, failures."""

import datetime as dt
import json

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from stationflow.operators import join as J
from stationflow.operators import metrics as M
from stationflow.operators import normalize as N
from stationflow.sources.feeds import read_messages
from stationflow.streaming.utilization import start_utilization_stream

T0 = dt.datetime(2025, 1, 5, 10, 0)
STATIONS = [("a", 10), ("b", 20)]


def _iso(ts):
    return ts.strftime("%Y-%m-%dT%H:%M:%SZ")


def land_poll(spark, base, ts, bikes=(3, 5), weather=None):
    """One poll: a message file per feed, all stamped with the same instant."""
    stamp = _iso(ts)
    info = [(f"{s}_{stamp}", json.dumps({"station_id": s, "metadata": {"timestamp": stamp},
                                         "capacity": cap})) for s, cap in STATIONS]
    status = [(f"{s}_{stamp}", json.dumps({"station_id": s, "timestamp": stamp,
                                           "num_bikes_available": b}))
              for (s, _), b in zip(STATIONS, bikes)]
    t, w, c = weather or (float(ts.minute), 1.0, 20.0)
    wx = [(f"7_{stamp}", json.dumps({"temperature": t, "windspeed": w, "clouds": c,
                                      "metadata": {"timestamp": stamp}}))]
    for feed, rows in (("info", info), ("status", status), ("weather", wx)):
        (spark.createDataFrame(rows, "key string, value string").coalesce(1)
         .write.mode("append").json(f"{base}/{feed}"))


def run(spark, base, mode, fmt="parquet"):
    q = start_utilization_stream(
        *(read_messages(spark, path=f"{base}/{f}", max_files_per_trigger=1)
          for f in ("info", "status", "weather")),
        sink_path=f"{base}/out", checkpoint_path=f"{base}/ckpt", mode=mode,
        trigger={"availableNow": True}, fmt=fmt)
    q.awaitTermination()
    return q


def batch_report(spark, base):
    msgs = {f: read_messages(spark, path=f"{base}/{f}", streaming=False)
            for f in ("info", "status", "weather")}
    joined = J.join_feeds(N.parse_info(msgs["info"]), N.parse_status(msgs["status"]),
                          N.parse_weather(msgs["weather"]))
    return M.utilization_report(joined)


def _rows(df):
    cols = ["station_id", "window_start", "temperature", "station_utilization_rate",
            "citywide_utilization_rate", "min_utilization", "max_utilization"]
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_event_time_multi_batch_equals_batch_and_state_drains(spark, tmp_shared):
    for i in range(6):  # 10:00 .. 11:15, one micro-batch per poll
        land_poll(spark, tmp_shared, T0 + dt.timedelta(minutes=15 * i), bikes=(i, 2 * i))
    q = run(spark, tmp_shared, "event_time")
    assert sum(p["numInputRows"] > 0 for p in q.recentProgress) >= 6
    out = spark.read.parquet(f"{tmp_shared}/out")
    # only the 10:00 hour is closed by the watermark (latest event 11:15 - 1 min)
    expected = batch_report(spark, tmp_shared).where(F.col("window_start") == T0)
    assert _rows(out) == _rows(expected) and out.count() == 8
    # join state is purged by the watermark: only the last poll is kept. J1
    # holds its info and status rows, J2 its joined rows and the weather
    # reading once per salt value.
    salts = J.SALT_BUCKETS
    last = q.recentProgress[-1]["stateOperators"]
    joins = [s["numRowsTotal"] for s in last if s["operatorName"] == "symmetricHashJoin"]
    assert sum(joins) <= 3 * len(STATIONS) + salts


def test_restart_resumes_and_late_rows_are_dropped(spark, tmp_shared):
    for i in range(6):
        land_poll(spark, tmp_shared, T0 + dt.timedelta(minutes=15 * i))
    run(spark, tmp_shared, "event_time")
    first = spark.read.parquet(f"{tmp_shared}/out").count()
    # a late poll (10:05, behind the watermark) and a poll that closes 11:00
    land_poll(spark, tmp_shared, T0 + dt.timedelta(minutes=5), bikes=(9, 9))
    land_poll(spark, tmp_shared, T0 + dt.timedelta(hours=2, minutes=5))
    q = run(spark, tmp_shared, "event_time")
    out = spark.read.parquet(f"{tmp_shared}/out")
    batches = [p["batchId"] for p in q.recentProgress]
    assert min(batches) > 0  # resumed from the checkpoint, old files not re-read
    assert out.where(F.col("window_start") == T0).count() == first == 8
    assert out.where(F.col("window_start") == T0 + dt.timedelta(hours=1)).count() == 4
    assert out.where(F.col("temperature") == 5.0).count() == 0  # the late poll


def test_snapshot_mode_reports_each_batch(spark, tmp_shared):
    for i in range(3):
        land_poll(spark, tmp_shared, T0 + dt.timedelta(minutes=15 * i))
    run(spark, tmp_shared, "snapshot")
    out = spark.read.parquet(f"{tmp_shared}/out")
    # one partial report per poll: hour 10 appears once per batch per station
    assert out.where("station_id = 'a'").count() == 3
    assert out.select("batch_id").distinct().count() == 3


def test_replayed_batch_overwrites_its_partition(spark, tmp_shared):
    from stationflow.sources.sinks import write_batch
    df = spark.createDataFrame([(1,)], "x int")
    write_batch(df, f"{tmp_shared}/sink", 3)
    write_batch(df, f"{tmp_shared}/sink", 3)
    write_batch(df, f"{tmp_shared}/sink", 4)
    assert spark.read.parquet(f"{tmp_shared}/sink").count() == 2


def test_failing_batch_fails_the_query(spark, tmp_shared):
    land_poll(spark, tmp_shared, T0)
    with pytest.raises(StreamingQueryException):
        run(spark, tmp_shared, "snapshot", fmt="bogus")


def test_late_rows_are_counted(spark, tmp_shared):
    from stationflow.streaming.utilization import dropped_by_watermark
    for i in range(3):
        land_poll(spark, tmp_shared, T0 + dt.timedelta(minutes=30 * i))
    land_poll(spark, tmp_shared, T0)  # the same instant again, now behind the watermark
    q = run(spark, tmp_shared, "event_time")
    assert dropped_by_watermark(q) > 0


def test_quarantine_stream_keeps_unusable_messages(spark, tmp_shared):
    from stationflow.streaming.utilization import start_quarantine_stream
    land_poll(spark, tmp_shared, T0)
    spark.createDataFrame([("x", "{broken"), ("y", json.dumps({"station_id": "a",
                                                                "timestamp": "never"}))],
                          "key string, value string").coalesce(1) \
        .write.mode("append").json(f"{tmp_shared}/status")
    q = start_quarantine_stream(
        *(read_messages(spark, path=f"{tmp_shared}/{f}") for f in ("info", "status", "weather")),
        path=f"{tmp_shared}/quarantine", checkpoint_path=f"{tmp_shared}/qckpt",
        trigger={"availableNow": True})
    q.awaitTermination()
    bad = spark.read.json(f"{tmp_shared}/quarantine").collect()
    assert sorted((r.feed, r.key) for r in bad) == [("status", "x"), ("status", "y")]


def test_typed_feed_streams(spark, tmp_shared):
    """The report runs on typed feed streams too (here: Parquet folders)."""
    from stationflow.streaming.utilization import start_feeds_stream
    for i in range(2):
        land_poll(spark, tmp_shared, T0 + dt.timedelta(minutes=45 * i))
    msgs = {f: read_messages(spark, path=f"{tmp_shared}/{f}", streaming=False)
            for f in ("info", "status", "weather")}
    N.parse_info(msgs["info"]).write.parquet(f"{tmp_shared}/t_info")
    N.parse_status(msgs["status"]).write.parquet(f"{tmp_shared}/t_status")
    N.parse_weather(msgs["weather"]).write.parquet(f"{tmp_shared}/t_weather")

    def typed(name, ts):
        schema = spark.read.parquet(f"{tmp_shared}/t_{name}").schema
        return spark.readStream.schema(schema).parquet(f"{tmp_shared}/t_{name}") \
            .withWatermark(ts, "1 minute")
    q = start_feeds_stream(typed("info", "info_timestamp"), typed("status", "status_timestamp"),
                           typed("weather", "timestamp"), sink_path=f"{tmp_shared}/out",
                           checkpoint_path=f"{tmp_shared}/ckpt", mode="snapshot",
                           trigger={"availableNow": True})
    q.awaitTermination()
    assert spark.read.parquet(f"{tmp_shared}/out").count() == 2 * len(STATIONS)


def test_console_preview(spark, tmp_shared, capfd):
    land_poll(spark, tmp_shared, T0)
    run(spark, tmp_shared, "snapshot", fmt="console")
    out = capfd.readouterr().out
    assert "--- batch 0 ---" in out and "station_utilization_rate" in out


def test_stream_query_restores_shuffle_partitions(spark):
    from stationflow.plans.utilization import stream_report_from_events
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, "37")
    try:
        out = stream_report_from_events(spark, "/root/testdata/sf0.001", "snapshot")
        assert out.count() > 0 and spark.conf.get(key) == "37"
    finally:
        spark.conf.set(key, before)


def test_backfill_from_landed_messages_ignores_unusable_ones(spark, tmp_shared):
    from stationflow.plans.utilization import report_from_messages
    for i in range(3):
        land_poll(spark, tmp_shared, T0 + dt.timedelta(minutes=15 * i))
    clean = report_from_messages(spark, *(f"{tmp_shared}/{f}" for f in
                                          ("info", "status", "weather")))
    expected = _rows(clean)
    junk = [("x", "{broken"), ("y", json.dumps({"station_id": None, "timestamp": "never"}))]
    for feed in ("info", "status", "weather"):
        spark.createDataFrame(junk, "key string, value string").coalesce(1) \
            .write.mode("append").json(f"{tmp_shared}/{feed}")
    got = report_from_messages(spark, *(f"{tmp_shared}/{f}" for f in
                                        ("info", "status", "weather")))
    assert _rows(got) == expected and len(expected) == 6
