"""Streaming ingest of landed payloads and in-watermark de-duplication."""

import datetime as dt
import json

import pytest

from stationflow.sources.feeds import read_messages
from stationflow.streaming.ingest import start_ingest_stream
from stationflow.streaming.utilization import watermarked_feeds

STAMP = "2025-01-05T10:00:00Z"


def _land(spark, path, docs):
    rows = [(STAMP, json.dumps(d)) for d in docs]
    spark.createDataFrame(rows, "stamp string, payload string").coalesce(1) \
        .write.mode("append").json(path)


def test_ingest_publishes_messages_and_quarantines(spark, tmp_shared):
    _land(spark, f"{tmp_shared}/raw", [
        {"data": {"stations": [{"station_id": "a", "capacity": 5},
                               {"station_id": "b", "capacity": 7}]}},
        {"unexpected": True}])
    q = start_ingest_stream(spark, f"{tmp_shared}/raw", "info",
                            checkpoint_path=f"{tmp_shared}/ckpt", path=f"{tmp_shared}/msgs",
                            quarantine_path=f"{tmp_shared}/bad",
                            trigger={"availableNow": True})
    q.awaitTermination()
    msgs = read_messages(spark, path=f"{tmp_shared}/msgs", streaming=False).collect()
    assert sorted(m.key for m in msgs) == [f"a_{STAMP}", f"b_{STAMP}"]
    assert spark.read.json(f"{tmp_shared}/bad").count() == 1


def test_replayed_batch_publishes_once(spark, tmp_shared, monkeypatch):
    from stationflow.streaming import ingest
    _land(spark, f"{tmp_shared}/raw", [{"data": {"stations": [{"station_id": "a", "capacity": 5}]}}])

    def start():
        q = start_ingest_stream(spark, f"{tmp_shared}/raw", "info",
                                checkpoint_path=f"{tmp_shared}/ckpt", path=f"{tmp_shared}/msgs",
                                quarantine_path=f"{tmp_shared}/bad", trigger={"availableNow": True})
        q.awaitTermination()

    whole = ingest.write_messages

    def fails_after_writing(*args, **kwargs):
        whole(*args, **kwargs)
        raise RuntimeError("lost after the write")

    monkeypatch.setattr(ingest, "write_messages", fails_after_writing)
    with pytest.raises(Exception):
        start()
    monkeypatch.setattr(ingest, "write_messages", whole)
    start()
    assert [m.key for m in read_messages(spark, path=f"{tmp_shared}/msgs", streaming=False).collect()] \
        == [f"a_{STAMP}"]


def test_dedupe_within_watermark_drops_repeated_messages(spark, tmp_shared):
    status = json.dumps({"station_id": "a", "timestamp": STAMP, "num_bikes_available": 1})
    for _ in range(2):  # the same message delivered twice
        spark.createDataFrame([(f"a_{STAMP}", status)], "key string, value string") \
            .coalesce(1).write.mode("append").json(f"{tmp_shared}/status")
    empty = f"{tmp_shared}/empty"
    spark.createDataFrame([], "key string, value string").write.json(empty)
    info_s = read_messages(spark, path=empty)
    weather_s = read_messages(spark, path=empty)
    status_s = read_messages(spark, path=f"{tmp_shared}/status")
    _, status, _ = watermarked_feeds(info_s, status_s, weather_s, dedupe_messages=True)
    q = (status.writeStream.format("memory").queryName("dedupe_status")
         .option("checkpointLocation", f"{tmp_shared}/ckpt")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.sql("SELECT * FROM dedupe_status").collect()
    assert len(got) == 1 and got[0].status_timestamp == dt.datetime(2025, 1, 5, 10, 0)


def test_batch_copies_are_collapsed_map_side(spark):
    from stationflow.streaming.utilization import drop_batch_copies
    rows = [("k", "v")] * 50 + [("k", "w"), ("j", "v")]
    df = spark.createDataFrame(rows, "key string, value string").coalesce(1)
    assert sorted(map(tuple, drop_batch_copies(df).collect())) == [("j", "v"), ("k", "v"),
                                                                    ("k", "w")]
