"""Raw payloads -> messages -> parsed feeds, with the quarantine edge cases."""

import datetime as dt
import json

from stationflow.operators import normalize as N

STAMP = "2025-01-05T10:00:00Z"


def _payloads(spark, docs, stamp=STAMP):
    return spark.createDataFrame([(stamp, d if isinstance(d, str) else json.dumps(d))
                                  for d in docs], "stamp string, payload string")


def test_station_info_payload_flattens_per_station(spark):
    p = _payloads(spark, [{"data": {"stations": [{"station_id": "s1", "capacity": 20},
                                                 {"station_id": "s2"}]}}])
    msgs = N.flatten_station_payloads(p, "info").collect()
    assert sorted(m.key for m in msgs) == [f"s1_{STAMP}", f"s2_{STAMP}"]
    parsed = {r.station_id: r for r in N.parse_info(
        spark.createDataFrame(msgs)).collect()}
    assert parsed["s1"].capacity == 20 and parsed["s2"].capacity is None
    assert parsed["s1"].info_timestamp == dt.datetime(2025, 1, 5, 10, 0)


def test_status_payload_keeps_null_bikes(spark):
    p = _payloads(spark, [{"data": {"stations": [{"station_id": "s1", "num_bikes_available": None}]}}])
    [m] = N.flatten_station_payloads(p, "status").collect()
    assert json.loads(m.value) == {"station_id": "s1", "timestamp": STAMP,
                                   "num_bikes_available": None}


def test_payload_without_stations_is_quarantined(spark):
    p = _payloads(spark, [{"data": {}}, {"other": 1}, "{broken",
                          {"data": {"stations": [{"capacity": 3}]}}])
    msgs, bad = N.flatten_station_payloads(p, "info", with_quarantine=True)
    assert msgs.count() == 0
    assert sorted(r.reason for r in bad.collect()) == [
        "no data.stations", "no data.stations", "no data.stations", "no station_id"]


def test_malformed_message_parses_to_nulls_and_is_quarantined(spark):
    msgs = spark.createDataFrame([("k", "{not json"), ("k2", None)], "key string, value string")
    parsed = N.parse_status(msgs)
    assert parsed.count() == 2
    good, bad = N.quarantine_parsed(parsed, "status_timestamp")
    assert good.count() == 0 and bad.count() == 2


def test_both_iso_forms_parse_and_bad_text_is_null(spark):
    msgs = spark.createDataFrame(
        [("a", json.dumps({"station_id": "a", "timestamp": "2025-01-05T10:00:00.123456Z"})),
         ("b", json.dumps({"station_id": "b", "timestamp": "2025-01-05T10:00:00Z"})),
         ("c", json.dumps({"station_id": "c", "timestamp": "yesterday"}))],
        "key string, value string")
    got = {r.station_id: r.status_timestamp for r in N.parse_status(msgs).collect()}
    assert got["a"] == dt.datetime(2025, 1, 5, 10, 0, 0, 123456)
    assert got["b"] == dt.datetime(2025, 1, 5, 10, 0, 0)
    assert got["c"] is None


def test_weather_key_fallback_and_renames(spark):
    p = _payloads(spark, [{"id": 7, "main": {"temp": 7.5}, "wind": {"speed": 3},
                           "clouds": {"all": 40}},
                          {"main": {"temp": 1.0}}])
    msgs = N.flatten_weather_payloads(p)
    keys = sorted(r.key for r in msgs.collect())
    assert keys == [f"7_{STAMP}", f"weather_{STAMP}"]
    rows = {r.key: r for r in N.parse_weather(msgs, keep_key=True).collect()}
    r = rows[f"7_{STAMP}"]
    assert (r.temperature, r.wind_speed, r.cloudiness) == (7.5, 3.0, 40.0)
    assert rows[f"weather_{STAMP}"].wind_speed is None


def test_forecast_first_defaults_missing_clouds(spark):
    doc = {"list": [{"dt": 1735725600, "main": {"temp": 5}, "wind": {"speed": 2.5}},
                    {"dt": 1735736400, "main": {"temp": 6}, "wind": {"speed": 1},
                     "clouds": {"all": 75}}]}
    p = spark.createDataFrame([(json.dumps(doc),), (json.dumps({"list": []}),)], "payload string")
    [first] = N.flatten_forecast(p, horizons="first").collect()
    assert (first.temperature, first.wind_speed, first.cloudiness) == (5.0, 2.5, 0)
    assert first.forecast_time == dt.datetime(2025, 1, 1, 10, 0)
    allh = N.flatten_forecast(p, horizons="all").collect()
    assert [r.horizon for r in allh] == [0, 1] and allh[1].cloudiness == 75


def test_to_messages_keeps_null_fields(spark):
    df = spark.createDataFrame([("a", None)], "station_id string, capacity int")
    [m] = N.to_messages(df, df.station_id, ["station_id", "capacity"]).collect()
    assert json.loads(m.value) == {"station_id": "a", "capacity": None}


def test_unreadable_weather_is_quarantined(spark):
    rows = spark.createDataFrame(
        [("t1", '{"main": {"temp": 1.5}}'), ("t1", '{"id": 7, "wind": {"speed": 2.5}, "clouds": {"all": 40}}'), ("t1", "{}"),
         ("t1", "not json"), ("t1", "[1]"), ("t1", '{"main": 5}'), ("t1", ""), ("t1", None)],
        "stamp string, payload string")
    good, bad = N.flatten_weather_payloads(rows, with_quarantine=True)
    values = sorted((m.key, json.loads(m.value)["temperature"], json.loads(m.value)["windspeed"]) for m in good.collect()
                    if m.key == "7_t1" or json.loads(m.value)["temperature"])
    assert values == [("7_t1", None, 2.5), ("weather_t1", 1.5, None)]
    assert good.count() == 3 and bad.count() == 5


def test_forecast_without_a_list_is_quarantined(spark):
    rows = spark.createDataFrame(
        [(1, '{"list": [{"dt": 0, "main": {"temp": 1.5}}]}'), (2, '{"list": []}'), (3, "{}"), (4, "no json"), (5, None)],
        "day int, payload string")
    for horizons in ("first", "all"):
        good, bad = N.flatten_forecast(rows, horizons=horizons, with_quarantine=True)
        assert [r.day for r in good.collect()] == [1]
        assert sorted(r.day for r in bad.collect()) == [2, 3, 4, 5] and bad.columns == ["reason", "day", "payload"]
