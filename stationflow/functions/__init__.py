from stationflow.functions.columns import (  # noqa: F401
    bikes_or_zero, epoch_to_timestamp, ingest_stamp, iso_utc, message_key, safe_timestamp,
    utilization_rate,
)
