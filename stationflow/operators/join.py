"""Event-time joins of the three feeds, and size-checked small-side joins.

J1  info x status   on (station_id, event time)   - both sides large, shuffle join
J2  pair x weather  on event time                 - weather is one reading per poll;
                                                    broadcast, or salted when streaming
J3  rows x totals   on window                      - one totals row per window

A side is broadcast only when a row bound for it is known and below
``stationflow.broadcast.maxRows``. Both small sides here are keyed by time
(one weather reading per poll instant, one totals row per window), so their
bound is the number of time buckets in the data's span, which
``time_buckets_bound`` measures with one min/max aggregate. Beyond the limit,
and always in streams, the join is salted by station: every row of a time key
would otherwise meet in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.session import broadcast_max_rows

# Copies of a small side in a salted join, and so the tasks that share a hot key.
SALT_BUCKETS = 16


def time_span_seconds(df: DataFrame, ts_col: str) -> int | None:
    """Seconds between the first and last ``ts_col`` value (None when empty).
    One global aggregate with partial aggregation; one row comes back."""
    row = df.agg(
        F.expr(f"timestampdiff(SECOND, min(`{ts_col}`), max(`{ts_col}`))").alias("span")
    ).first()
    return None if row is None or row["span"] is None else int(row["span"])


def buckets_in_span(span_seconds: int | None, bucket_seconds: int) -> int:
    """Upper bound on distinct aligned buckets that a span can touch."""
    return 0 if span_seconds is None else span_seconds // bucket_seconds + 2


def time_buckets_bound(df: DataFrame, ts_col: str, bucket_seconds: int) -> int:
    """Upper bound on the number of distinct ``bucket_seconds`` buckets of
    ``ts_col`` in ``df`` (0 when empty)."""
    return buckets_in_span(time_span_seconds(df, ts_col), bucket_seconds)


def join_small(big: DataFrame, small: DataFrame, on, *, rows_bound: int | None,
               how: str = "inner", spread_by: str | None = None,
               salt_buckets: int | None = None) -> DataFrame:
    """Join ``big`` with ``small`` whose row count is at most ``rows_bound``.

    Broadcasts ``small`` when the bound is known and within the session limit
    (never for streams). Otherwise, when ``spread_by`` names a column of
    ``big`` that spreads a hot join key (the station of a row keyed by time),
    the join is salted: ``big`` rows get ``pmod(xxhash64(spread_by), n)``,
    ``small`` rows are repeated once per salt value, and the join runs on the
    keys plus the salt, so one hot key is shared by ``n`` tasks; ``n``
    defaults to ``SALT_BUCKETS``. It is part of a stream's state: rows that
    wait in the state carry their salt over a restart, so it must never
    depend on a session setting. Salting keeps inner and
    left joins exact (a ``big`` row meets one replica of each match). Without
    ``spread_by`` it is a plain shuffle join (AQE may still split skewed
    partitions).
    """
    keys = [on] if isinstance(on, str) else list(on)
    spark = big.sparkSession
    streaming = big.isStreaming or small.isStreaming
    if not streaming and rows_bound is not None and rows_bound <= broadcast_max_rows(spark):
        return big.join(F.broadcast(small), keys, how)
    if spread_by is None or how not in ("inner", "left"):
        return big.join(small, keys, how)
    n = salt_buckets or SALT_BUCKETS
    salted = big.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(n)))
    repeated = small.withColumn("_salt", F.explode(
        F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))))
    return salted.join(repeated, [*keys, "_salt"], how).drop("_salt")


def join_info_status(info: DataFrame, status: DataFrame) -> DataFrame:
    """One row per station and instant present in both feeds.

    Keyed on (station_id, event time) rather than on the text message key: the
    key is exactly ``{station_id}_{timestamp}`` for well-formed messages, and
    the event-time column in the key lets streaming state be purged by the
    watermark. Rows with a NULL station or time never match (inner join).
    Output: key, station_id, capacity, num_bikes_available, event_timestamp.
    """
    left = info.select("key", "station_id", "capacity",
                       F.col("info_timestamp").alias("event_timestamp"))
    right = status.select("station_id", "num_bikes_available",
                          F.col("status_timestamp").alias("event_timestamp"))
    return left.join(right, ["station_id", "event_timestamp"], "inner").select(
        "key", "station_id", "capacity", "num_bikes_available", "event_timestamp")


def join_weather(pair: DataFrame, weather: DataFrame, *,
                 weather_rows_bound: int | None = None,
                 salt_buckets: int | None = None) -> DataFrame:
    """Attach the weather reading taken at the same instant.

    Several readings at one instant fan the row out, as an equi-join does.
    Every station row of a poll shares its instant, so the instant alone is a
    hot key (a 5-minute micro-batch may hold a single instant). When weather
    is not broadcast (streams; batches beyond the bound) the join is salted by
    station (see ``join_small``). The instant stays in the key, so streaming
    state is still purged by the watermark.
    Output: key, station_id, capacity, num_bikes_available, timestamp,
    temperature, wind_speed, cloudiness.
    """
    w = weather.select(F.col("timestamp").alias("event_timestamp"),
                       "temperature", "wind_speed", "cloudiness")
    joined = join_small(pair, w, "event_timestamp", rows_bound=weather_rows_bound,
                        spread_by="station_id", salt_buckets=salt_buckets)
    return joined.select(
        "key", "station_id", "capacity", "num_bikes_available",
        F.col("event_timestamp").alias("timestamp"),
        "temperature", "wind_speed", "cloudiness")


def join_feeds(info: DataFrame, status: DataFrame, weather: DataFrame, *,
               weather_rows_bound: int | None = None,
               salt_buckets: int | None = None) -> DataFrame:
    """J1 then J2; the same code serves batch frames and streams."""
    return join_weather(join_info_status(info, status), weather,
                        weather_rows_bound=weather_rows_bound, salt_buckets=salt_buckets)
