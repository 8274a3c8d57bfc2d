"""Column expressions shared by the operators. All are built-in Spark
expressions, so they stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(col: ColumnOrName) -> Column:
    return F.col(col) if isinstance(col, str) else col


def safe_timestamp(col: ColumnOrName) -> Column:
    """ISO-8601 text -> timestamp; NULL for unparsable text instead of an error.

    Accepts both ``2025-01-05T10:00:00Z`` and ``2025-01-05T10:00:00.123456Z``
    (the producer drops the fraction when it is zero).
    """
    return F.try_to_timestamp(_c(col))


def bikes_or_zero(col: ColumnOrName = "num_bikes_available") -> Column:
    """A missing bike count counts as zero bikes."""
    return F.coalesce(_c(col), F.lit(0))


def utilization_rate(capacity: ColumnOrName, bikes: ColumnOrName) -> Column:
    """(capacity - bikes) / capacity. NULL when capacity is 0 or NULL; not
    clamped, so more bikes than docks gives a negative rate."""
    cap = _c(capacity)
    return F.try_divide(cap - _c(bikes), cap)


def message_key(id_col: ColumnOrName, ts_col: ColumnOrName,
                fallback: str | None = None) -> Column:
    """``{id}_{timestamp}``; with ``fallback`` a NULL id becomes that prefix
    (weather readings without an id are keyed ``weather_{timestamp}``)."""
    ident = _c(id_col).cast("string")
    if fallback is not None:
        ident = F.coalesce(ident, F.lit(fallback))
    return F.concat(ident, F.lit("_"), _c(ts_col).cast("string"))


def iso_utc(ts: ColumnOrName) -> Column:
    """Timestamp -> ISO-8601 UTC text with a trailing ``Z``, dropping a zero
    fraction like the producer does."""
    col = _c(ts)
    whole = F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(col, "SSSSSS")
    return F.concat(whole, F.when(micros == "000000", F.lit("")).otherwise(
        F.concat(F.lit("."), micros)), F.lit("Z"))


def ingest_stamp() -> Column:
    """One ISO stamp per micro-batch / job (``current_timestamp`` is fixed
    for the whole query), for payloads landed without their own stamp."""
    return iso_utc(F.current_timestamp())


def epoch_to_timestamp(col: ColumnOrName) -> Column:
    """Unix seconds -> timestamp (zone independent)."""
    return F.timestamp_seconds(_c(col))
