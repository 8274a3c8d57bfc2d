"""Feeds that do not fit each other: only real partners may meet."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from stationflow.plans.utilization import joined_from_uneven


def test_uneven_feeds_bite(spark):
    """A left join, a null-safe join or one match per row would give other counts."""
    joined, feeds = joined_from_uneven(spark, SF_SMALL.replace("sf0.001", "sf0.01"))
    info, status, weather = (x.toPandas() for x in (
        feeds.info.select("station_id", F.col("info_timestamp").alias("ts")),
        feeds.status.select("station_id", F.col("status_timestamp").alias("ts"), F.lit(1).alias("s")),
        feeds.weather.select(F.col("timestamp").alias("ts"), F.lit(1).alias("w"))))
    assert [bool(x["ts"].isna().any()) for x in (info, status, weather)] == [True] * 3
    assert info["station_id"].isna().any() and status["station_id"].isna().any()
    left = info.merge(status.dropna(), "left", ["station_id", "ts"])
    pairs = left.dropna()
    with_weather = pairs.merge(weather.dropna(), "left", "ts")
    n = joined.count()
    assert n == with_weather["w"].notna().sum()
    assert n not in (len(left), len(pairs), len(with_weather), len(info))
    # Two readings of one instant, on both sides, fan rows out.
    assert joined.select("station_id", "timestamp").distinct().count() < n
    assert joined.where("station_id IS NULL OR timestamp IS NULL").count() == 0
