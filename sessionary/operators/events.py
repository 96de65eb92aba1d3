"""Event preparation: sessions (P3), category codes (P2), downcasting (P5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionary.functions.time import epoch_micros
from sessionary.operators.sequence import Scan, segmented_scan

SESSION_GAP_SECONDS = 1800  # fixed value: 30 minutes of inactivity ends a session
ORDER = ["timestamp", "event_id"]


def gap_break(gap_seconds: float) -> tuple[str, int]:
    """A new session starts when the gap to the visitor's previous event is
    strictly greater than ``gap_seconds``; the first event has no gap."""
    return "_us", int(round(gap_seconds * 1_000_000))


def sessionize(events: DataFrame, gap_seconds: float = SESSION_GAP_SECONDS, *,
               parts: int | None = None) -> DataFrame:
    """Canonical events + ``session_id`` (0-based per visitor).

    Events without a visitor have no session and go.  ``parts``: partitions of the scan.
    """
    own = events.where(F.col("visitorid").isNotNull()).withColumn("_us", epoch_micros("timestamp"))
    scan = Scan(breaks={"session": gap_break(gap_seconds)}, numbers={"session_id": "session"})
    return segmented_scan(own, ["visitorid"], ORDER, scan, parts).select(*events.columns, "session_id")


def event_codes(events: DataFrame, col: str = "event") -> DataFrame:
    """Category codes, 0-based in sorted order of the distinct values; NULL is -1.

    The distinct values get their places by a distributed ranking; the join with
    them is planned by Spark (a small code table is broadcast by its own size).
    """
    from sessionary.operators.graph import global_rank
    cats = events.select(col).where(F.col(col).isNotNull()).distinct()
    codes = global_rank(cats, [col], "_r").select(
        col, (F.col("_r") - 1).cast("int").alias(f"{col}_code"))
    return events.join(codes, on=col, how="left").withColumn(
        f"{col}_code", F.coalesce(F.col(f"{col}_code"), F.lit(-1).cast("int")))


_INT_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_INT_RANGES = [  # fixed values: signed integer widths, smallest first
    ("tinyint", -128, 127),
    ("smallint", -32768, 32767),
    ("int", -2147483648, 2147483647),
    ("bigint", -9223372036854775808, 9223372036854775807),
]


#: A double becomes a float when no value moves by more than this.
FLOAT_TOLERANCE = 5e-4


def downcast_table(df: DataFrame) -> DataFrame:
    """P5 as data: (column, min_value, max_value, type) per numeric column.

    One aggregate over the table.  Integer columns: the narrowest signed type
    that holds [min, max]; a column without values keeps no type (NULL).
    Double columns (min and max NULL): ``float`` when every value survives
    within ``FLOAT_TOLERANCE``, else ``double``; NULL and NaN always survive.
    """
    ints = [f.name for f in df.schema.fields if isinstance(f.dataType, _INT_TYPES)]
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    aggs, rows = [], []
    for c in ints:
        aggs += [F.min(c).cast("bigint").alias(f"min__{c}"),
                 F.max(c).cast("bigint").alias(f"max__{c}")]
        rows.append(F.struct(F.lit(c).alias("column"), F.col(f"min__{c}").alias("min_value"),
                             F.col(f"max__{c}").alias("max_value"),
                             F.lit(None).cast("double").alias("moved")))
    for c in doubles:
        own = F.when(F.isnan(c), 0.0).otherwise(F.abs(F.col(c).cast("float").cast("double") - F.col(c)))
        same = F.abs(F.col(c)) == F.lit(float("inf"))
        aggs.append(F.coalesce(F.max(F.when(same, 0.0).otherwise(own)), F.lit(0.0)).alias(f"moved__{c}"))
        none = F.lit(None).cast("bigint")
        rows.append(F.struct(F.lit(c).alias("column"), none.alias("min_value"),
                             none.alias("max_value"), F.col(f"moved__{c}").alias("moved")))
    long = df.agg(*aggs).select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    pick = F.when(F.col("moved") <= FLOAT_TOLERANCE, "float").when(F.col("moved").isNotNull(), "double")
    for name, lo, hi in _INT_RANGES:
        pick = pick.when((F.col("min_value") >= F.lit(lo)) & (F.col("max_value") <= F.lit(hi)), name)
    return long.select("column", "min_value", "max_value", pick.alias("type"))


def downcast_plan(df: DataFrame) -> dict[str, str]:
    """Column -> narrowest type (one row per column reaches the driver)."""
    return {r["column"]: r["type"] for r in downcast_table(df).collect() if r["type"] is not None}


def downcast(df: DataFrame) -> DataFrame:
    """P5: cast every numeric column to its narrowest type."""
    plan = downcast_plan(df)
    return df.select(*[F.col(c).cast(plan[c]).alias(c) if c in plan else F.col(c)
                       for c in df.columns])
