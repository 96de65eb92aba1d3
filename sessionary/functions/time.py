"""Time expressions.  All assume the session time zone is UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_ms_to_timestamp(col: str | Column) -> Column:
    """Epoch milliseconds -> TIMESTAMP (an instant; shown in UTC)."""
    return F.timestamp_millis(F.col(col) if isinstance(col, str) else col)


def epoch_micros(col: str | Column) -> Column:
    """TIMESTAMP -> exact integer microseconds since the epoch."""
    return F.unix_micros(F.col(col) if isinstance(col, str) else col)


def floor_seconds(col: str | Column) -> Column:
    """Whole seconds since the epoch, fraction dropped (floor)."""
    micros = epoch_micros(col)
    return F.floor(micros / F.lit(1_000_000)).cast("bigint")


def hour_range(col: str | Column) -> Column:
    """0: [00,06) 1: [06,12) 2: [12,18) 3: [18,24) hours of the day."""
    c = F.col(col) if isinstance(col, str) else col
    return (F.hour(c) / F.lit(6)).cast("int")


def week_day(col: str | Column) -> Column:
    """0 = Sunday ... 6 = Saturday."""
    c = F.col(col) if isinstance(col, str) else col
    return (F.dayofweek(c) - F.lit(1)).cast("int")


def minute_bucket(col: str | Column, unit: str = "minute") -> Column:
    """Calendar bucket (minute or hour) of a timestamp."""
    c = F.col(col) if isinstance(col, str) else col
    return F.date_trunc(unit, c)
