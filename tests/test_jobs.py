"""The five spark-submit jobs, end to end on landed test feeds."""

import json

from stationflow import jobs
from stationflow.plans.utilization import land_feed_messages
from stationflow.sources import events as E

SF = "/root/testdata/sf0.001"


def test_stream_compact_train_score(spark, tmp_shared):
    paths = land_feed_messages(spark, SF, f"{tmp_shared}/land")
    jobs.main(["stream", "--info", paths["info"], "--status", paths["status"],
               "--weather", paths["weather"], "--out", f"{tmp_shared}/csv",
               "--checkpoint", f"{tmp_shared}/ckpt", "--mode", "snapshot",
               "--format", "csv", "--available-now",
               "--quarantine", f"{tmp_shared}/quarantine"], spark)
    jobs.main(["compact", "--parts", f"{tmp_shared}/csv/*/*.csv",
               "--out", f"{tmp_shared}/history",
               "--distinct", "citywide_utilization_rate"], spark)
    history = spark.read.parquet(f"{tmp_shared}/history")
    assert history.count() > 0
    distinct = spark.read.parquet(f"{tmp_shared}/history_distinct")
    assert distinct.count() == history.select("citywide_utilization_rate").distinct().count()
    result = jobs.main(["train", "--history", f"{tmp_shared}/history",
                        "--model", f"{tmp_shared}/model"], spark)
    assert result["rmse"] >= 0 and result["train_rows"] + result["test_rows"] > 0
    weather = E.weather_feed(E.station_snapshots(E.read_table(spark, SF, "events")))
    E.forecast_payloads(weather).select("payload").write.json(f"{tmp_shared}/fc")
    jobs.main(["score", "--forecasts", f"{tmp_shared}/fc", "--model", f"{tmp_shared}/model",
               "--out", f"{tmp_shared}/pred", "--horizons", "all"], spark)
    preds = spark.read.parquet(f"{tmp_shared}/pred")
    assert preds.count() > 0 and "prediction" in preds.columns


def test_ingest_job(spark, tmp_shared):
    doc = {"data": {"stations": [{"station_id": "a", "num_bikes_available": 2}]}}
    spark.createDataFrame([("2025-01-05T10:00:00Z", json.dumps(doc))],
                          "stamp string, payload string").write.json(f"{tmp_shared}/raw")
    jobs.main(["ingest", "--feed", "status", "--payloads", f"{tmp_shared}/raw",
               "--messages", f"{tmp_shared}/msgs", "--checkpoint", f"{tmp_shared}/ckpt",
               "--available-now"], spark)
    assert spark.read.json(f"{tmp_shared}/msgs").count() == 1


def test_stream_job_on_parsed_parquet_feeds(spark, tmp_shared):
    from stationflow.operators import normalize as N
    from stationflow.sources.feeds import read_messages
    paths = land_feed_messages(spark, SF, f"{tmp_shared}/land")
    parse = {"info": N.parse_info, "status": N.parse_status, "weather": N.parse_weather}
    for feed, fn in parse.items():
        fn(read_messages(spark, path=paths[feed], streaming=False)) \
            .write.parquet(f"{tmp_shared}/typed_{feed}")
    jobs.main(["stream", "--source", "parquet", "--info", f"{tmp_shared}/typed_info",
               "--status", f"{tmp_shared}/typed_status", "--weather", f"{tmp_shared}/typed_weather",
               "--out", f"{tmp_shared}/out", "--checkpoint", f"{tmp_shared}/ckpt",
               "--mode", "snapshot", "--available-now"], spark)
    assert spark.read.parquet(f"{tmp_shared}/out").count() == 987
