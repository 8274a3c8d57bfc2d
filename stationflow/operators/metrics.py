"""Hourly station utilization, citywide utilization and per-window statistics.

The per-window quantities (citywide totals and min / max / avg / stddev of the
station rates) are computed by one ``groupBy(window)`` aggregate with partial
aggregation and joined back to the station rows, instead of window functions
partitioned by the window: those would send every station of an hour to one
task. The totals table has one row per window, so its size is bounded by the
time span of the data, not by the number of stations.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.functions import bikes_or_zero, utilization_rate
from stationflow.operators.join import join_small, time_buckets_bound
from stationflow.schemas import REPORT_COLUMNS

WINDOW_DURATION = "1 hour"
_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def duration_seconds(duration: str) -> int:
    """'1 hour' / '15 minutes' -> seconds."""
    amount, unit = duration.split()
    return int(amount) * _UNIT_SECONDS[unit.lower().rstrip("s")]


def clean_joined(joined: DataFrame) -> DataFrame:
    """The columns the metrics need; a missing bike count is 0."""
    return joined.select(
        "station_id",
        F.col("capacity").alias("station_capacity"),
        bikes_or_zero("num_bikes_available").alias("num_bikes_available"),
        F.col("timestamp").alias("event_timestamp"),
        "temperature", "wind_speed", "cloudiness",
    )


def station_hourly(clean: DataFrame, window_duration: str = WINDOW_DURATION) -> DataFrame:
    """A1: per tumbling window, station, capacity and weather: summed bikes and
    capacity. Rows with a NULL event time fall out (``window`` drops them)."""
    return clean.groupBy(
        F.window("event_timestamp", window_duration).alias("window"),
        "station_id", "station_capacity", "temperature", "wind_speed", "cloudiness",
    ).agg(
        F.sum("num_bikes_available").alias("total_bikes_available_per_station"),
        F.sum("station_capacity").alias("total_capacity_per_station"),
    )


def station_utilization(hourly: DataFrame) -> DataFrame:
    """station_utilization_rate = (capacity - bikes) / capacity."""
    return hourly.withColumn(
        "station_utilization_rate",
        utilization_rate("total_capacity_per_station", "total_bikes_available_per_station"),
    )


def window_totals(util: DataFrame, *, with_city: bool = True,
                  with_stats: bool = True) -> DataFrame:
    """One row per window: citywide totals and rate (W1, W2, P8) and/or the
    statistics of the station rates (A2; sample stddev, NULL rates ignored)."""
    aggs = []
    if with_city:
        aggs += [F.sum("total_capacity_per_station").alias("city_total_capacity"),
                 F.sum("total_bikes_available_per_station").alias("city_total_bikes_available")]
    if with_stats:
        rate = F.col("station_utilization_rate")
        aggs += [F.min(rate).alias("min_utilization"),
                 F.max(rate).alias("max_utilization"),
                 F.avg(rate).alias("avg_utilization"),
                 F.stddev_samp(rate).alias("std_dev_docking_station_utilisation")]
    totals = util.groupBy("window").agg(*aggs)
    if with_city:
        totals = totals.withColumn(
            "citywide_utilization_rate",
            utilization_rate("city_total_capacity", "city_total_bikes_available"))
    return totals


def window_stats(util: DataFrame) -> DataFrame:
    """A2 as its own table: window_start, window_end and the rate statistics."""
    return (window_totals(util, with_city=False)
            .select(F.col("window.start").alias("window_start"),
                    F.col("window.end").alias("window_end"),
                    "min_utilization", "max_utilization", "avg_utilization",
                    "std_dev_docking_station_utilisation"))


def citywide_utilization(util: DataFrame, *, windows_bound: int | None = None) -> DataFrame:
    """Every station row with its window's totals and citywide rate."""
    totals = window_totals(util, with_stats=False)
    return join_small(util, totals, "window", rows_bound=windows_bound,
                      spread_by="station_id")


def report_from_hourly(hourly: DataFrame, *, windows_bound: int | None) -> DataFrame:
    """Report columns from A1 output (station rates, window totals, join back)."""
    util = station_utilization(hourly)
    totals = window_totals(util)
    report = join_small(util, totals, "window", rows_bound=windows_bound,
                        spread_by="station_id")
    return report.select(
        *REPORT_COLUMNS[:4], "station_utilization_rate", "citywide_utilization_rate",
        "min_utilization", "max_utilization", "avg_utilization",
        "std_dev_docking_station_utilisation",
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
    )


def utilization_report(joined: DataFrame, *, window_duration: str = WINDOW_DURATION,
                       windows_bound: int | None = None) -> DataFrame:
    """The full report (A1, P7, W1, W2, P8, A2, J3, P10), one row per
    station / window / capacity / weather group, columns in ``REPORT_COLUMNS``.

    ``windows_bound`` caps the number of windows (for the broadcast of the
    totals); when omitted it is measured from the input's event times, which
    costs one extra pass over ``joined`` - pass it when it is known.
    """
    clean = clean_joined(joined)
    if windows_bound is None and not joined.isStreaming:
        windows_bound = time_buckets_bound(clean, "event_timestamp",
                                           duration_seconds(window_duration))
    return report_from_hourly(station_hourly(clean, window_duration),
                              windows_bound=windows_bound)
