"""Small scalar helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fill_missing_id(col: str | Column, missing: int = -1) -> Column:
    """Null id -> ``missing`` (default -1), as BIGINT."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.cast("bigint"), F.lit(missing).cast("bigint"))


def implicit_rating(event: str | Column) -> Column:
    """view -> 1, addtocart -> 2, anything else -> 3."""
    e = F.col(event) if isinstance(event, str) else event
    return (F.when(e == "view", F.lit(1))
            .when(e == "addtocart", F.lit(2))
            .otherwise(F.lit(3))).cast("int")


def safe_div(num: Column, den: Column) -> Column:
    """Division that yields NULL for a zero divisor (ANSI-safe)."""
    return F.try_divide(num, den)


def count_when(cond: Column) -> Column:
    """Number of rows where ``cond`` holds, as BIGINT."""
    return F.count_if(cond).cast("bigint")


def numpy_round(col: str | Column, digits: int = 2) -> Column:
    """Round as numpy/pandas do for floats: ``rint(x * 10^d) / 10^d`` with
    half-to-even on the scaled binary value (Spark's ``round`` is half-up on
    the decimal digits, which differs on ties such as 2.675)."""
    c = F.col(col) if isinstance(col, str) else col
    scale = float(10 ** digits)
    return F.bround(c.cast("double") * F.lit(scale), 0) / F.lit(scale)
