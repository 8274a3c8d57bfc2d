"""Sources and sinks: CSV read with inference, Parquet / CSV append, message
round trip through a landing folder, literal scoring rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stationflow.functions import ingest_stamp
from stationflow.operators import model as ML
from stationflow.operators import normalize as N
from stationflow.sources.feeds import read_messages
from stationflow.sources.history import read_csv
from stationflow.sources.sinks import append_csv, append_parquet, flatten_structs, write_messages

T0 = dt.datetime(2025, 1, 5, 10, 0)


def test_csv_append_flattens_structs_and_reads_back_with_inference(spark, tmp_shared):
    df = spark.createDataFrame([("a", 0.5, T0)], "station_id string, rate double, ts timestamp") \
        .select("station_id", "rate", F.window("ts", "1 hour").alias("window"))
    append_csv(df, tmp_shared)
    append_csv(df, tmp_shared)
    back = read_csv(spark, tmp_shared, infer=True)
    assert back.columns == ["station_id", "rate", "window_start", "window_end"]
    assert dict(back.dtypes)["rate"] == "double" and back.count() == 2


def test_parquet_append_partitioned(spark, tmp_shared):
    df = spark.createDataFrame([(1, "x"), (2, "y")], "v int, p string")
    append_parquet(df, tmp_shared, ["p"])
    append_parquet(df, tmp_shared, ["p"])
    back = spark.read.parquet(tmp_shared)
    assert back.count() == 4 and back.where("p = 'x'").count() == 2


def test_messages_round_trip_through_landing_folder(spark, tmp_shared):
    rows = spark.createDataFrame([("a", 20, "2025-01-05T10:00:00Z")],
                                 "station_id string, capacity int, ts string")
    msgs = N.to_messages(rows, F.concat_ws("_", "station_id", "ts"),
                         ["station_id", F.struct(F.col("ts").alias("timestamp")).alias("metadata"),
                          "capacity"])
    write_messages(msgs, path=tmp_shared)
    [r] = N.parse_info(read_messages(spark, path=tmp_shared, streaming=False)).collect()
    assert (r.key, r.station_id, r.capacity, r.info_timestamp) == (
        "a_2025-01-05T10:00:00Z", "a", 20, T0)


def test_kafka_source_requires_topic_and_servers(spark):
    with pytest.raises(ValueError):
        read_messages(spark, source="kafka", topic="t")


def test_flatten_structs_leaves_plain_columns(spark):
    df = spark.createDataFrame([(1,)], "x int")
    assert flatten_structs(df).columns == ["x"]


def test_scoring_rows_accept_ints(spark):
    df = ML.scoring_rows(spark, [(5, 2, 40), (None, 1.5, None)])
    assert df.dtypes == [("temperature", "double"), ("wind_speed", "double"),
                         ("cloudiness", "int")]
    assert df.first().temperature == 5.0


def test_ingest_stamp_is_iso_utc(spark):
    stamp = spark.range(1).select(ingest_stamp().alias("s")).first().s
    assert stamp.endswith("Z") and "T" in stamp


def test_replayed_batch_reaches_a_stream_once(spark, tmp_shared):
    """A file stream that follows the folder between two attempts of a batch."""
    msgs = spark.createDataFrame([("a", "1"), ("b", "2")], "key string, value string")

    def follow():
        q = (read_messages(spark, path=f"{tmp_shared}/msgs").writeStream.format("json")
             .option("path", f"{tmp_shared}/seen").option("checkpointLocation", f"{tmp_shared}/ckpt")
             .trigger(availableNow=True).start())
        q.awaitTermination()
        return sorted(r.key for r in spark.read.schema("key string, value string").json(f"{tmp_shared}/seen").collect())

    write_messages(msgs, path=f"{tmp_shared}/msgs", batch_id=7)
    assert follow() == ["a", "b"]
    write_messages(msgs, path=f"{tmp_shared}/msgs", batch_id=7)
    assert follow() == ["a", "b"]
    write_messages(msgs, path=f"{tmp_shared}/msgs", batch_id=8)
    assert follow() == ["a", "a", "b", "b"]
