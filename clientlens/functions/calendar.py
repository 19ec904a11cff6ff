"""Calendar parts of a purchase time (timestamp or timestamp_ntz)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DataType, DateType, IntegralType, TimestampNTZType, TimestampType


def _c(col):
    return F.col(col) if isinstance(col, str) else col


def weekday(col) -> Column:
    """Day of week, Sunday = 1 .. Saturday = 7."""
    return F.dayofweek(_c(col))


def hour_of_day(col) -> Column:
    """Hour 0..23; a ``date`` column gives 0 for every row, so pass a timestamp."""
    return F.hour(_c(col))


def year_of(col) -> Column:
    return F.year(_c(col))


def days_between(end, start) -> Column:
    """Whole days from ``start`` to ``end`` (calendar dates, int)."""
    return F.datediff(_c(end), _c(start))


def epoch_micros(kind: DataType, column: str) -> str | None:
    """SQL text (BIGINT) of microseconds since the epoch, monotone in the column
    whatever the session zone: a TIMESTAMP_NTZ is read without any zone, a DATE
    as its first instant, an integral column as it is. None for other types."""
    q = f"`{column}`"
    if isinstance(kind, TimestampType):
        return f"unix_micros({q})"
    if isinstance(kind, TimestampNTZType):
        return f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {q})"
    if isinstance(kind, DateType):
        return f"(unix_date({q}) * 86400000000L)"
    return f"CAST({q} AS BIGINT)" if isinstance(kind, IntegralType) else None
