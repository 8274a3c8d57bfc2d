"""Edge cases of the utilization report on hand-made joined rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from stationflow.operators import join as J
from stationflow.operators import metrics as M

JOINED = ("key string, station_id string, capacity int, num_bikes_available int, "
          "timestamp timestamp, temperature float, wind_speed float, cloudiness float")
T0 = dt.datetime(2025, 1, 5, 10, 0, 0)


def _row(sid, cap, bikes, ts, w=(5.0, 2.0, 40.0)):
    return (f"{sid}_{ts.isoformat()}Z", sid, cap, bikes, ts, *w)


def _report(spark, rows):
    df = spark.createDataFrame(rows, JOINED)
    return {(r.station_id, r.window_start, r.temperature): r
            for r in M.utilization_report(df).collect()}


def test_null_bikes_count_as_zero(spark):
    out = _report(spark, [_row("a", 10, None, T0), _row("b", 10, 5, T0)])
    assert out[("a", T0, 5.0)].station_utilization_rate == 1.0
    assert out[("b", T0, 5.0)].citywide_utilization_rate == pytest.approx(15 / 20)


def test_zero_capacity_rate_is_null_citywide_defined(spark):
    out = _report(spark, [_row("a", 0, 0, T0), _row("b", 10, 4, T0)])
    assert out[("a", T0, 5.0)].station_utilization_rate is None
    assert out[("a", T0, 5.0)].citywide_utilization_rate == pytest.approx(0.6)
    # NULL rates are ignored by the statistics
    assert out[("b", T0, 5.0)].min_utilization == pytest.approx(0.6)


def test_more_bikes_than_docks_is_negative(spark):
    out = _report(spark, [_row("a", 10, 15, T0)])
    assert out[("a", T0, 5.0)].station_utilization_rate == pytest.approx(-0.5)


def test_single_station_window_has_null_stddev(spark):
    out = _report(spark, [_row("a", 10, 5, T0)])
    assert out[("a", T0, 5.0)].std_dev_docking_station_utilisation is None


def test_event_on_the_hour_opens_that_window(spark):
    on_hour = T0.replace(hour=11)
    out = _report(spark, [_row("a", 10, 5, on_hour)])
    r = out[("a", on_hour, 5.0)]
    assert (r.window_start, r.window_end) == (on_hour, on_hour + dt.timedelta(hours=1))


def test_capacity_change_within_hour_splits_row(spark):
    rows = [_row("a", 10, 5, T0), _row("a", 20, 5, T0 + dt.timedelta(minutes=15))]
    df = spark.createDataFrame(rows, JOINED)
    # same weather, same hour, two capacities -> two rows
    assert M.utilization_report(df).where("station_id = 'a'").count() == 2


def test_hourly_sums_over_snapshots(spark):
    rows = [_row("a", 10, 2, T0), _row("a", 10, 4, T0 + dt.timedelta(minutes=15))]
    df = spark.createDataFrame(rows, JOINED)
    [r] = M.station_utilization(M.station_hourly(M.clean_joined(df))).collect()
    assert (r.total_capacity_per_station, r.total_bikes_available_per_station) == (20, 6)
    assert r.station_utilization_rate == pytest.approx(14 / 20)


def test_two_weather_readings_double_the_rows(spark):
    info = spark.createDataFrame([("a_t", "a", 10, T0)],
                                 "key string, station_id string, capacity int, info_timestamp timestamp")
    status = spark.createDataFrame([("a_t", "a", 3, T0)],
                                   "key string, station_id string, num_bikes_available int, "
                                   "status_timestamp timestamp")
    weather = spark.createDataFrame([(T0, 1.0, 2.0, 3.0), (T0, 4.0, 5.0, 6.0)],
                                    "timestamp timestamp, temperature float, wind_speed float, "
                                    "cloudiness float")
    assert J.join_feeds(info, status, weather, weather_rows_bound=2).count() == 2


def test_null_time_or_station_never_joins(spark):
    info = spark.createDataFrame([("k1", "a", 10, None), ("k2", None, 10, T0)],
                                 "key string, station_id string, capacity int, info_timestamp timestamp")
    status = spark.createDataFrame([("k1", "a", 3, None), ("k2", None, 3, T0)],
                                   "key string, station_id string, num_bikes_available int, "
                                   "status_timestamp timestamp")
    assert J.join_info_status(info, status).count() == 0


def test_report_matches_brute_force_on_random_rows(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(400):
        ts = T0 + dt.timedelta(minutes=15 * rnd.randrange(12))
        cap = rnd.choice([0, 10, 20, 35])
        bikes = rnd.choice([None, 0, 3, 9, 40])
        rows.append(_row(f"s{rnd.randrange(30)}", cap, bikes, ts,
                         (float(ts.minute), 1.0, 10.0)))
    got = M.utilization_report(spark.createDataFrame(rows, JOINED)).collect()
    # brute force in Python
    groups = {}
    for _, sid, cap, bikes, ts, t, w, c in rows:
        hour = ts.replace(minute=0)
        g = groups.setdefault((hour, sid, cap, t, w, c), [0, 0])
        g[0] += cap
        g[1] += bikes or 0
    by_hour = {}
    for (hour, sid, cap, t, *_), (c_sum, b_sum) in groups.items():
        rate = None if c_sum == 0 else (c_sum - b_sum) / c_sum
        by_hour.setdefault(hour, []).append((c_sum, b_sum, rate))
    assert len(got) == len(groups)
    for r in got:
        stats = by_hour[r.window_start]
        caps = sum(s[0] for s in stats)
        bikes = sum(s[1] for s in stats)
        rates = [s[2] for s in stats if s[2] is not None]
        assert r.citywide_utilization_rate == pytest.approx((caps - bikes) / caps)
        assert r.min_utilization == pytest.approx(min(rates))
        assert r.max_utilization == pytest.approx(max(rates))
        assert r.avg_utilization == pytest.approx(sum(rates) / len(rates))
        assert r.min_utilization <= r.avg_utilization <= r.max_utilization


def test_time_buckets_bound(spark):
    df = spark.createDataFrame([(T0,), (T0 + dt.timedelta(hours=5, minutes=1),)], "ts timestamp")
    assert J.time_buckets_bound(df, "ts", 3600) >= 6
    assert J.time_buckets_bound(df.where(F.lit(False)), "ts", 3600) == 0


def test_window_totals_join_is_broadcast_within_bound(spark):
    df = spark.createDataFrame([_row("a", 10, 5, T0)], JOINED)
    plan = M.utilization_report(df, windows_bound=10)._jdf.queryExecution() \
        .executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Window " not in plan


def test_salted_weather_join_equals_broadcast_join(spark):
    info = spark.createDataFrame(
        [(f"s{i}_t", f"s{i}", 10, T0) for i in range(40)],
        "key string, station_id string, capacity int, info_timestamp timestamp")
    status = spark.createDataFrame(
        [(f"s{i}_t", f"s{i}", i % 7, T0) for i in range(40)],
        "key string, station_id string, num_bikes_available int, status_timestamp timestamp")
    weather = spark.createDataFrame([(T0, 1.0, 2.0, 3.0), (T0, 4.0, 5.0, 6.0)],
                                    "timestamp timestamp, temperature float, wind_speed float, "
                                    "cloudiness float")
    broadcast = J.join_feeds(info, status, weather, weather_rows_bound=2)
    salted = J.join_feeds(info, status, weather, salt_buckets=5)
    assert sorted(map(tuple, broadcast.collect())) == sorted(map(tuple, salted.collect()))
    assert salted.count() == 80
    plan = salted._jdf.queryExecution().executedPlan().toString()
    assert "xxhash64" in plan


def test_report_beyond_broadcast_limit_is_salted_and_equal(spark):
    rnd = random.Random(11)
    rows = [_row(f"s{rnd.randrange(25)}", rnd.choice([0, 10, 20]), rnd.choice([None, 2, 9]),
                 T0 + dt.timedelta(minutes=15 * rnd.randrange(8)), (1.0, 2.0, 3.0))
            for _ in range(150)]
    df = spark.createDataFrame(rows, JOINED)
    cols = ["station_id", "window_start", "station_utilization_rate",
            "citywide_utilization_rate", "min_utilization", "max_utilization"]
    expected = sorted(map(tuple, M.utilization_report(df, windows_bound=10)
                          .select(*cols).collect()), key=repr)
    spark.conf.set("stationflow.broadcast.maxRows", "0")
    try:
        salted = M.utilization_report(df, windows_bound=10)
        got = sorted(map(tuple, salted.select(*cols).collect()), key=repr)
        plan = salted._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("stationflow.broadcast.maxRows")
    assert got == expected and "xxhash64" in plan
