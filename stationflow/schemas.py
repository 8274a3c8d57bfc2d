"""Fixed schemas of every relation (no inference on the hot path).

Field names and types of the three messages are fixed values: they must equal
the producer's message layout for the messages to parse.
"""

from pyspark.sql.types import (
    ArrayType, DoubleType, FloatType, IntegerType, LongType, StringType,
    StructField, StructType, TimestampType,
)


def _s(*fields: StructField) -> StructType:
    return StructType(list(fields))


def _f(name: str, dtype) -> StructField:
    return StructField(name, dtype, True)


# --- fixed values: message layouts -------------------------------------------
# station_info:   {"station_id": str, "capacity": int, "metadata": {"timestamp": str}}
# station_status: {"station_id": str, "timestamp": str, "num_bikes_available": int}
# weather:        {"temperature": float, "windspeed": float, "clouds": float,
#                  "metadata": {"timestamp": str}}
STATION_INFO_MESSAGE = _s(
    _f("station_id", StringType()),
    _f("capacity", IntegerType()),
    _f("metadata", _s(_f("timestamp", StringType()))),
)
STATION_STATUS_MESSAGE = _s(
    _f("station_id", StringType()),
    _f("timestamp", StringType()),
    _f("num_bikes_available", IntegerType()),
)
WEATHER_MESSAGE = _s(
    _f("temperature", FloatType()),
    _f("windspeed", FloatType()),
    _f("clouds", FloatType()),
    _f("metadata", _s(_f("timestamp", StringType()))),
)

# --- raw payloads (landing zone, one JSON document per line) -----------------
# The station feeds wrap a list of stations; both variants are read with one
# schema, fields absent from a variant come back NULL.
STATION_PAYLOAD = _s(
    _f("data", _s(_f("stations", ArrayType(_s(
        _f("station_id", StringType()),
        _f("capacity", IntegerType()),
        _f("num_bikes_available", IntegerType()),
    )))))
)
WEATHER_PAYLOAD = _s(
    _f("id", LongType()),
    _f("main", _s(_f("temp", DoubleType()))),
    _f("wind", _s(_f("speed", DoubleType()))),
    _f("clouds", _s(_f("all", DoubleType()))),
)
FORECAST_PAYLOAD = _s(
    _f("list", ArrayType(_s(
        _f("dt", LongType()),
        _f("main", _s(_f("temp", DoubleType()))),
        _f("wind", _s(_f("speed", DoubleType()))),
        _f("clouds", _s(_f("all", DoubleType()))),
    )))
)

# --- keyed message envelope (Kafka record or landed file row) ----------------
MESSAGE = _s(_f("key", StringType()), _f("value", StringType()))

# --- parsed feeds -------------------------------------------------------------
# joined:  key, station_id, capacity, num_bikes_available, timestamp,
#          temperature, wind_speed, cloudiness
PARSED_INFO = _s(_f("key", StringType()), _f("station_id", StringType()),
                 _f("capacity", IntegerType()), _f("info_timestamp", TimestampType()))
PARSED_STATUS = _s(_f("key", StringType()), _f("station_id", StringType()),
                   _f("num_bikes_available", IntegerType()),
                   _f("status_timestamp", TimestampType()))
PARSED_WEATHER = _s(_f("timestamp", TimestampType()), _f("temperature", FloatType()),
                    _f("wind_speed", FloatType()), _f("cloudiness", FloatType()))

# --- scoring rows (forecast features) ----------------------------------------
SCORING_ROW = _s(
    _f("temperature", DoubleType()),
    _f("wind_speed", DoubleType()),
    _f("cloudiness", IntegerType()),
)

# --- utilization report, in output order --------------------------------------
REPORT_COLUMNS = [
    "station_id", "temperature", "wind_speed", "cloudiness",
    "station_utilization_rate", "citywide_utilization_rate",
    "min_utilization", "max_utilization", "avg_utilization",
    "std_dev_docking_station_utilisation", "window_start", "window_end",
]
FEATURE_COLUMNS = ["temperature", "wind_speed", "cloudiness"]
LABEL_COLUMN = "avg_utilization"
