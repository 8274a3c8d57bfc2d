"""Station and weather feeds derived from the driver's ``events`` table.

The test tables hold no station data, so the three feeds are derived from
``events`` by fixed rules (these are our test conventions, see FIXTURES.md):

* snapshot instant ``snap``  = ``ts`` floored to 15 minutes
* one station snapshot per (user_id, snap); ``station_id`` = user_id as text
* ``k``                     = max of ``props.k`` over non-error events (NULL if only errors)
* ``capacity``              = 0 when user_id % 50 = 0, else 15 + user_id % 45
* ``num_bikes_available``   = k % 16
* one weather reading per snap, with n = floor(epoch seconds of snap / 900):
  ``temperature`` = (n % 61) * 0.5 - 5, ``wind_speed`` = (n % 17) * 0.5,
  ``cloudiness`` = (n % 11) * 10

The snapshot aggregate is grouped by (station_id, snap) - exactly the J1 join
keys - so joining the info and status feeds back needs no further shuffle.
Partial aggregation runs before the shuffle, so one very active user adds at
most one row per snap per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow.functions import iso_utc, message_key

SNAPSHOT_STEP = "15 minutes"
SNAPSHOT_SECONDS = 900


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def station_snapshots(events: DataFrame) -> DataFrame:
    """station_id, ts, capacity, num_bikes_available - one row per station and snap."""
    # One field per event: get_json_object stays inside whole-stage codegen
    # (from_json is evaluated outside it in Spark 4.1).
    k = F.get_json_object("props", "$.k").try_cast("int")
    uid = F.col("user_id")
    capacity = F.when(uid % 50 == 0, F.lit(0)).otherwise(15 + uid % 45).cast("int")
    return (events
            .select(uid.cast("string").alias("station_id"),
                    F.window("ts", SNAPSHOT_STEP).start.alias("ts"),
                    capacity.alias("capacity"),
                    F.when(F.col("event_type") != "error", k).alias("k"))
            .groupBy("station_id", "ts")
            .agg(F.max("capacity").alias("capacity"),
                 (F.max("k") % 16).cast("int").alias("num_bikes_available")))

def info_feed(snapshots: DataFrame) -> DataFrame:
    """Parsed station-information feed: key, station_id, capacity, info_timestamp."""
    return snapshots.select(message_key("station_id", iso_utc("ts")).alias("key"),
                            "station_id", "capacity", F.col("ts").alias("info_timestamp"))


def status_feed(snapshots: DataFrame) -> DataFrame:
    """Parsed station-status feed: key, station_id, num_bikes_available, status_timestamp."""
    return snapshots.select(message_key("station_id", iso_utc("ts")).alias("key"),
                            "station_id", "num_bikes_available",
                            F.col("ts").alias("status_timestamp"))


def weather_feed(snapshots: DataFrame) -> DataFrame:
    """Parsed weather feed: timestamp, temperature, wind_speed, cloudiness (float)."""
    n = F.floor(F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', "
                       "CAST(ts AS TIMESTAMP_NTZ))") / SNAPSHOT_SECONDS)
    return (snapshots.select("ts").distinct()
            .select(F.col("ts").alias("timestamp"),
                    ((n % 61) * 0.5 - 5).cast("float").alias("temperature"),
                    ((n % 17) * 0.5).cast("float").alias("wind_speed"),
                    ((n % 11) * 10).cast("float").alias("cloudiness")))


def uneven_feeds(snapshots: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three feeds as deliveries that do not fit each other (uid = the station's
    number, n = the instant's 15-minute number): info lacks uid % 7 = 3, status
    lacks uid % 5 = 1; both have a NULL station for uid % 11 = 5 and a NULL time
    for uid % 17 = 6; stations of uid % 13 = 2 report a second status (one bike
    more). Weather lacks n % 6 = 1, has a second reading (one degree more) for
    n % 6 = 2 and one more without a time for n % 6 = 4."""
    uid = F.col("station_id").cast("bigint")

    def gaps(feed: DataFrame, time: str) -> DataFrame:
        return feed.withColumns({"station_id": F.when(uid % 11 != 5, F.col("station_id")),
                                 time: F.when(uid % 17 != 6, F.col(time))})

    bikes = F.col("num_bikes_available")
    twice = status_feed(snapshots).where(uid % 5 != 1).withColumn("num_bikes_available", F.explode(
        F.when(uid % 13 == 2, F.array(bikes, bikes + 1)).otherwise(F.array(bikes))))
    slot = _epoch_slot("timestamp") % 6
    at, warm = F.col("timestamp"), F.col("temperature")
    reading = lambda ts, t: F.struct(ts.alias("ts"), t.cast("float").alias("t"))
    readings = (F.when(slot == 2, F.array(reading(at, warm), reading(at, warm + 1)))
                .when(slot == 4, F.array(reading(at, warm), reading(F.when(slot != 4, at), warm)))
                .otherwise(F.array(reading(at, warm))))
    weather = (weather_feed(snapshots).where(slot != 1).withColumn("r", F.explode(readings))
               .select(F.col("r.ts").alias("timestamp"), F.col("r.t").alias("temperature"),
                       "wind_speed", "cloudiness"))
    return (gaps(info_feed(snapshots).where(uid % 7 != 3), "info_timestamp"),
            gaps(twice, "status_timestamp"), weather)


# --- landed raw payloads derived from the feeds (test conventions) -----------
# Station payloads list at most STATIONS_PER_PAYLOAD stations: stations are
# grouped per snap by floor(user_id / STATIONS_PER_PAYLOAD), so a payload's size
# is bounded however many stations a snap holds. Weather readings carry the id
# WEATHER_ID except when n % 5 = 0 (to exercise the ``weather_`` key fallback).
# Forecast payloads hold, per day, the readings at 00, 03, ... 21 h (at most 8),
# omitting ``clouds`` when it is 0.
STATIONS_PER_PAYLOAD = 100
WEATHER_ID = 42


def station_payloads(snapshots: DataFrame, variant: str) -> DataFrame:
    """stamp (ISO text), payload (JSON text) - one per snap and station group."""
    field = {"info": "capacity", "status": "num_bikes_available"}[variant]
    group = F.floor(F.col("station_id").cast("bigint") / STATIONS_PER_PAYLOAD)
    return (snapshots
            .groupBy("ts", group.alias("_grp"))
            .agg(F.collect_list(F.struct("station_id", field)).alias("stations"))
            .select(iso_utc("ts").alias("stamp"),
                    F.to_json(F.struct(F.struct("stations").alias("data"))).alias("payload")))


def _epoch_slot(ts: str) -> Column:
    return F.floor(F.expr(f"timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', "
                          f"CAST({ts} AS TIMESTAMP_NTZ))") / SNAPSHOT_SECONDS)


def weather_payloads(weather: DataFrame) -> DataFrame:
    """stamp, payload - one current-weather document per reading."""
    ident = F.when(_epoch_slot("timestamp") % 5 != 0, F.lit(WEATHER_ID))
    doc = F.struct(ident.alias("id"),
                   F.struct(F.col("temperature").alias("temp")).alias("main"),
                   F.struct(F.col("wind_speed").alias("speed")).alias("wind"),
                   F.struct(F.col("cloudiness").alias("all")).alias("clouds"))
    return weather.select(iso_utc("timestamp").alias("stamp"),
                          F.to_json(doc).alias("payload"))


def forecast_payloads(weather: DataFrame) -> DataFrame:
    """day, payload - one forecast document per day with up to 8 horizons."""
    ts = F.col("timestamp")
    at3h = (F.minute(ts) == 0) & (F.hour(ts) % 3 == 0)
    entry = F.struct(
        F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', "
               "CAST(timestamp AS TIMESTAMP_NTZ))").alias("dt"),
        F.struct(F.col("temperature").alias("temp")).alias("main"),
        F.struct(F.col("wind_speed").alias("speed")).alias("wind"),
        F.when(F.col("cloudiness") != 0, F.struct(F.col("cloudiness").alias("all")))
        .alias("clouds"))
    return (weather.where(at3h)
            .groupBy(F.to_date(ts).alias("day"))
            .agg(F.array_sort(F.collect_list(entry)).alias("list"))
            .select("day", F.to_json(F.struct("list")).alias("payload")))
