"""Plan-shape guards for the flagship: the properties the scale design relies on."""

import re

import pytest

from conftest import SF_SMALL
from stationflow.plans.utilization import report_from_events


@pytest.fixture
def no_auto_broadcast(spark):
    """As at scale: Spark would not broadcast a large feed by its size estimate."""
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k in keys:
        spark.conf.unset(k)


def _executed(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_flagship_plan_shape(spark, no_auto_broadcast):
    plan = _executed(report_from_events(spark, SF_SMALL))
    # no window function: the per-window totals are an aggregate joined back
    assert not re.search(r"\bWindow\b \[", plan)
    # J1 is a sort-merge join fed directly by the two snapshot aggregates'
    # (station_id, ts) exchanges: no shuffle is added for the join itself
    assert "SortMergeJoin" in plan
    shuffles = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    keys = [re.sub(r"#\d+L?", "", s).rsplit(",", 1)[0].strip() for s in shuffles]
    assert keys.count("station_id, ts") == 2
    assert not any(k.startswith("station_id, event_timestamp") for k in keys)
    # the totals branch reuses the hourly aggregate's shuffle
    assert "ReusedExchange" in plan
    # the small time-keyed sides are broadcast by our checked bound
    assert plan.count("BroadcastExchange") == 2
    # scans are pruned and carry the pushed null filter
    scans = re.findall(r"FileScan parquet \[([^\]]*)\].*?PushedFilters: \[([^\]]*)\]", plan)
    assert len(scans) >= 3  # info, status and weather sides of the events adapter
    for scan in scans:
        cols = {re.sub(r"#\d+L?", "", c) for c in scan[0].split(",")}
        assert cols <= {"ts", "user_id", "event_type", "props"}
        assert "IsNotNull(ts)" in scan[1]


def test_hot_keys_are_salted_beyond_the_bound(spark, no_auto_broadcast):
    spark.conf.set("stationflow.broadcast.maxRows", "0")
    try:
        plan = _executed(report_from_events(spark, SF_SMALL))
    finally:
        spark.conf.unset("stationflow.broadcast.maxRows")
    assert "BroadcastExchange" not in plan
    assert plan.count("xxhash64(station_id") >= 2  # weather join and totals join


def test_weather_payload_is_parsed_once(spark):
    from stationflow.operators import normalize as N
    rows = spark.createDataFrame([("t", "{}")], "stamp string, payload string")
    msgs, bad = N.flatten_weather_payloads(rows, with_quarantine=True)
    for df in (msgs, bad):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert len(re.findall(r"from_json\(", plan)) == 1


def test_days_are_pruned(spark, tmp_shared):
    import datetime as dt
    from stationflow.operators.history import append_daily, read_days
    append_daily(report_from_events(spark, SF_SMALL), tmp_shared)
    some = read_days(spark, tmp_shared, dt.date(2024, 1, 5), dt.date(2024, 1, 6))
    plan = _executed(some)
    assert re.search(r"PartitionFilters: \[.*window_date.*>=.*window_date.*<=", plan)
    assert {r.d for r in some.selectExpr("to_date(window_start) AS d").distinct().collect()} == \
        {dt.date(2024, 1, 5), dt.date(2024, 1, 6)}
