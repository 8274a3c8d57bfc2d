"""Raw payloads -> keyed messages -> parsed feeds.

Producers land one JSON payload per poll: the station feeds wrap a list of
stations, weather is one reading, a forecast is a list of readings. Each poll
carries one ingest stamp shared by all three feeds; that shared instant is what
the event-time joins match on.

Everything is ``from_json`` / ``explode`` / ``to_json`` on columns: payloads are
flattened where they land, in parallel, with no per-record Python.
Rows that cannot be used (no station list, no station id, unreadable time)
are routed to a quarantine frame instead of being dropped silently.
"""

from __future__ import annotations

import copy

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationflow import schemas as S
from stationflow.functions import epoch_to_timestamp, message_key, safe_timestamp

_KEEP_NULLS = {"ignoreNullFields": "false"}


def parsed_once(df: DataFrame, *cols: Column) -> DataFrame:
    """``df.select(*cols)`` through a one-element ``inline``. Filters on the
    resulting columns then stay above it: pushed below a plain projection,
    they would evaluate its JSON parsing a second time."""
    return df.select(F.inline(F.array(F.struct(*cols))))


def split(df: DataFrame, ok: Column) -> tuple[DataFrame, DataFrame]:
    """(rows where ``ok`` is true, the rest). The rest is the quarantine."""
    ok = F.coalesce(ok, F.lit(False))
    return df.where(ok), df.where(~ok)


# --- S4: station payloads ------------------------------------------------------

def _stations(payloads: DataFrame, payload_col: str, stamp_col: str) -> DataFrame:
    return parsed_once(
        payloads, F.col(stamp_col).alias("_stamp"), F.col(payload_col).alias("_payload"),
        F.from_json(payload_col, S.STATION_PAYLOAD).getField("data").getField("stations")
        .alias("_stations"))


def flatten_station_payloads(payloads: DataFrame, variant: str, *,
                             payload_col: str = "payload", stamp_col: str = "stamp",
                             with_quarantine: bool = False):
    """One keyed message per station of every payload.

    ``variant`` is ``"info"`` (station_id, metadata.timestamp, capacity) or
    ``"status"`` (station_id, timestamp, num_bikes_available). Payloads without
    ``data.stations`` give no message (F2) and stations without an id are not
    keyed; both go to the quarantine (reason, stamp, payload) when
    ``with_quarantine`` is set. Output: key, value (JSON text).
    """
    parsed = _stations(payloads, payload_col, stamp_col)
    has_list, no_list = split(parsed, F.col("_stations").isNotNull())
    st = has_list.select("_stamp", "_payload", F.explode("_stations").alias("s"))
    good, no_id = split(st, F.col("s.station_id").isNotNull())
    if variant == "info":
        value = F.struct(F.col("s.station_id").alias("station_id"),
                         F.struct(F.col("_stamp").alias("timestamp")).alias("metadata"),
                         F.col("s.capacity").alias("capacity"))
    elif variant == "status":
        value = F.struct(F.col("s.station_id").alias("station_id"),
                         F.col("_stamp").alias("timestamp"),
                         F.col("s.num_bikes_available").alias("num_bikes_available"))
    else:
        raise ValueError(f"unknown station payload variant {variant!r}")
    msgs = good.select(message_key("s.station_id", "_stamp").alias("key"),
                       F.to_json(value, _KEEP_NULLS).alias("value"))
    if not with_quarantine:
        return msgs
    def reason(df: DataFrame, text: str) -> DataFrame:
        return df.select(F.lit(text).alias("reason"), F.col("_stamp").alias("stamp"),
                         F.col("_payload").alias("payload"))
    bad = reason(no_list, "no data.stations").unionByName(reason(no_id, "no station_id"))
    return msgs, bad


# --- S5: weather payloads --------------------------------------------------------

_BAD = "_unreadable"


def _object(payload_col: str, schema) -> Column:
    """The parsed payload, with the text in ``_BAD`` if it is no JSON object of the
    schema's types."""
    fields = schema.add(_BAD, "string") if _BAD not in schema.names else schema
    return F.from_json(payload_col, fields, {"columnNameOfCorruptRecord": _BAD})


def flatten_weather_payloads(payloads: DataFrame, *, payload_col: str = "payload",
                             stamp_col: str = "stamp", with_quarantine: bool = False):
    """One keyed message per weather reading: ``{id}_{stamp}`` or, without an
    id, ``weather_{stamp}``. Missing fields, ``main`` included, become NULL values. A
    payload that is no JSON object, or holds a value of another type, gives no
    message; it goes to the quarantine (reason, stamp, payload) when
    ``with_quarantine`` is set. Output: key, value (JSON text)."""
    every = parsed_once(payloads, F.col(stamp_col).alias("_stamp"), F.col(payload_col).alias("_payload"),
                        _object(payload_col, copy.deepcopy(S.WEATHER_PAYLOAD)).alias("w"))
    p, unreadable = split(every, F.col("w").isNotNull() & F.col(f"w.{_BAD}").isNull())
    value = F.struct(F.col("w.main.temp").cast("float").alias("temperature"),
                     F.col("w.wind.speed").cast("float").alias("windspeed"),
                     F.col("w.clouds.all").cast("float").alias("clouds"),
                     F.struct(F.col("_stamp").alias("timestamp")).alias("metadata"))
    msgs = p.select(message_key("w.id", "_stamp", fallback="weather").alias("key"),
                    F.to_json(value, _KEEP_NULLS).alias("value"))
    if not with_quarantine:
        return msgs
    return msgs, unreadable.select(F.lit("no weather document").alias("reason"), F.col("_stamp").alias("stamp"),
                                   F.col("_payload").alias("payload"))


# --- S7: forecast payloads -------------------------------------------------------

def _forecast_cols(e: Column) -> list[Column]:
    return [e.getField("main").getField("temp").alias("temperature"),
            e.getField("wind").getField("speed").alias("wind_speed"),
            F.coalesce(e.getField("clouds").getField("all"), F.lit(0.0))
            .cast("int").alias("cloudiness"),
            epoch_to_timestamp(e.getField("dt")).alias("forecast_time")]


def flatten_forecast(payloads: DataFrame, *, horizons: str = "first",
                     payload_col: str = "payload", with_quarantine: bool = False):
    """Forecast payload -> scoring rows ``temperature double, wind_speed double,
    cloudiness int, forecast_time timestamp`` (+ ``horizon`` for ``"all"``).

    ``"first"`` keeps the first element of each list; ``"all"`` keeps every horizon.
    Missing cloudiness is 0. A payload without a list, or with an empty one, gives no
    row; it goes to the quarantine (reason, the other columns, payload) when
    ``with_quarantine`` is set.
    """
    keep = [c for c in payloads.columns if c != payload_col]
    every = parsed_once(payloads, *[F.col(c) for c in keep], F.col(payload_col).alias("_payload"),
                        F.from_json(payload_col, S.FORECAST_PAYLOAD).getField("list").alias("_list"))
    if horizons == "first":
        first = every.select(*keep, F.try_element_at("_list", F.lit(1)).alias("_f")).where(F.col("_f").isNotNull())
        rows = first.select(*keep, *_forecast_cols(F.col("_f")))
    elif horizons == "all":
        rows = (every.select(*keep, F.posexplode("_list").alias("horizon", "_f"))
                .select(*keep, "horizon", *_forecast_cols(F.col("_f"))))
    else:
        raise ValueError(f"horizons must be 'first' or 'all', not {horizons!r}")
    if not with_quarantine:
        return rows
    some = F.exists(F.col("_list"), lambda e: e.isNotNull()) if horizons == "all" else \
        F.try_element_at("_list", F.lit(1)).isNotNull()
    _, without = split(every, some)
    return rows, without.select(F.lit("no forecast list").alias("reason"), *keep, F.col("_payload").alias("payload"))


# --- P1-P4: parse messages ---------------------------------------------------------

def _value(messages: DataFrame, schema) -> DataFrame:
    """key, value and the parsed value ``d``, parsed once even under the
    quarantine filter and the joins' inferred not-null checks."""
    value = F.col("value").cast("string")
    return parsed_once(messages, F.col("key").cast("string").alias("key"),
                       value.alias("value"), F.from_json(value, schema).alias("d"))


def _raw(keep_value: bool) -> list[str]:
    return ["value"] if keep_value else []


def parse_info(messages: DataFrame, *, keep_value: bool = False) -> DataFrame:
    """key, station_id, capacity, info_timestamp (NULL when unreadable)."""
    return _value(messages, S.STATION_INFO_MESSAGE).select(
        "key", F.col("d.station_id").alias("station_id"),
        F.col("d.capacity").alias("capacity"),
        safe_timestamp(F.col("d.metadata.timestamp")).alias("info_timestamp"),
        *_raw(keep_value))


def parse_status(messages: DataFrame, *, keep_value: bool = False) -> DataFrame:
    """key, station_id, num_bikes_available, status_timestamp."""
    return _value(messages, S.STATION_STATUS_MESSAGE).select(
        "key", F.col("d.station_id").alias("station_id"),
        F.col("d.num_bikes_available").alias("num_bikes_available"),
        safe_timestamp(F.col("d.timestamp")).alias("status_timestamp"),
        *_raw(keep_value))


def parse_weather(messages: DataFrame, *, keep_key: bool = False,
                  keep_value: bool = False) -> DataFrame:
    """timestamp, temperature, wind_speed, cloudiness (renamed from the message);
    ``keep_key`` adds the message key in front."""
    return _value(messages, S.WEATHER_MESSAGE).select(
        *(["key"] if keep_key else []),
        safe_timestamp(F.col("d.metadata.timestamp")).alias("timestamp"),
        F.col("d.temperature").alias("temperature"),
        F.col("d.windspeed").alias("wind_speed"),
        F.col("d.clouds").alias("cloudiness"),
        *_raw(keep_value))


def quarantine_parsed(parsed: DataFrame, ts_col: str,
                      id_col: str | None = "station_id") -> tuple[DataFrame, DataFrame]:
    """Split parsed rows into usable and quarantined (NULL id or time: malformed
    JSON, bad timestamp text). Usable rows are exactly those the joins can match."""
    ok = F.col(ts_col).isNotNull()
    if id_col:
        ok = ok & F.col(id_col).isNotNull()
    return split(parsed, ok)


def unusable_messages(messages: DataFrame, feed: str) -> DataFrame:
    """feed, key, value of the messages of one feed that ``quarantine_parsed``
    rejects (the rows no join can match)."""
    if feed == "info":
        parsed, ts, ident = parse_info(messages, keep_value=True), "info_timestamp", "station_id"
    elif feed == "status":
        parsed, ts, ident = (parse_status(messages, keep_value=True), "status_timestamp",
                             "station_id")
    elif feed == "weather":
        parsed, ts, ident = (parse_weather(messages, keep_key=True, keep_value=True),
                             "timestamp", None)
    else:
        raise ValueError(f"unknown feed {feed!r}")
    _, bad = quarantine_parsed(parsed, ts, ident)
    return bad.select(F.lit(feed).alias("feed"), "key", "value")


# --- S6: keyed messages from typed rows ---------------------------------------------

def to_messages(df: DataFrame, key: Column, value_cols: list[str | Column]) -> DataFrame:
    """key + JSON value (NULL fields kept as ``null``), ready for a message sink."""
    return df.select(key.alias("key"),
                     F.to_json(F.struct(*value_cols), _KEEP_NULLS).alias("value"))
