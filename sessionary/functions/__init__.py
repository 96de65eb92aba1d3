"""Column expressions (JVM-side ``pyspark.sql.functions`` compositions)."""

from sessionary.functions.time import (
    epoch_ms_to_timestamp,
    floor_seconds,
    hour_range,
    minute_bucket,
    week_day,
    epoch_micros,
)
from sessionary.functions.columns import (
    fill_missing_id,
    implicit_rating,
    safe_div,
    count_when,
    numpy_round,
)

__all__ = [
    "epoch_ms_to_timestamp", "floor_seconds", "hour_range", "minute_bucket",
    "week_day", "epoch_micros", "fill_missing_id", "implicit_rating",
    "safe_div", "count_when", "numpy_round",
]
