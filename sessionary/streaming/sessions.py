"""Incremental session counts (V9) and minute views (V4) on event streams.

The batch operators need LAG/LEAD, which streams reject; the counts that do
not depend on neighbouring rows are plain stateful aggregations:

* sessions: ``session_window(timestamp, gap)`` merges events whose distance
  is at most the gap - the same rule as the batch sessionizer (a new session
  only when the gap is strictly larger);
* minute views: a tumbling one-minute ``window``.

A watermark bounds the state: a session is emitted (append mode) once the
watermark passes its end, so late events older than the watermark delay are
dropped, as usual for Structured Streaming.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionary.sources.tables import _event_name, item_id, visitor_key


def canonical_event_stream(spark: SparkSession, folder: str, pattern: str = "events*.parquet",
                           mapping: str = "user") -> DataFrame:
    """Stream of canonical events from Parquet files of the test table's shape."""
    schema = ("event_id long, ts timestamp_ntz, user_id long, event_type string, "
              "value double, props string")
    raw = (spark.readStream.schema(schema).option("pathGlobFilter", pattern)
           .option("maxFilesPerTrigger", 1).parquet(folder))
    return (raw
            .select("event_id", F.col("ts").cast("timestamp").alias("timestamp"),
                    visitor_key(mapping).alias("visitorid"), _event_name().alias("event"),
                    item_id().alias("itemid"),
                    F.when(F.col("event_type") == "purchase", F.col("event_id"))
                    .otherwise(F.lit(-1)).cast("bigint").alias("transactionid")))


def session_counts_stream(events: DataFrame, gap_seconds: int = 1800,
                          watermark: str = "2 hours") -> DataFrame:
    """(visitorid, session_start, session_end, num_views, num_acart, num_purch)."""
    win = F.session_window("timestamp", f"{gap_seconds} seconds")
    ev = F.col("event")
    return (events.withWatermark("timestamp", watermark)
            .groupBy("visitorid", win.alias("session"))
            .agg(F.count_if(ev == "view").alias("num_views"),
                 F.count_if(ev == "addtocart").alias("num_acart"),
                 F.count_if(ev == "transaction").alias("num_purch"))
            .select("visitorid", F.col("session.start").alias("session_start"),
                    F.col("session.end").alias("session_end"),
                    "num_views", "num_acart", "num_purch"))


def minute_views_stream(events: DataFrame, watermark: str = "10 minutes") -> DataFrame:
    """(visitorid, minute, views): views per visitor and calendar minute."""
    return (events.withWatermark("timestamp", watermark)
            .groupBy("visitorid", F.window("timestamp", "1 minute").alias("w"))
            .agg(F.count_if(F.col("event") == "view").alias("views"))
            .select("visitorid", F.col("w.start").alias("minute"), "views"))
