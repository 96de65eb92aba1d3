"""Implicit (visitor, item, rating, timestamp) triples.

All steps are aggregations keyed by (visitor, [event,] item): map-side
combinable, so a visitor with a huge share of the events is pre-reduced in
every task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionary.functions.columns import implicit_rating


def eligible_events(events: DataFrame, features: DataFrame) -> DataFrame:
    """Events of visitors present in the feature table (left semi join)."""
    return (events.select("timestamp", "visitorid", "event", "itemid")
            .join(features.select("visitorid"), "visitorid", "left_semi"))


def latest_per_event(events: DataFrame) -> DataFrame:
    """R2: per (visitor, event, item) the latest timestamp."""
    return (events.groupBy("visitorid", "event", "itemid")
            .agg(F.max("timestamp").alias("timestamp")))


def with_rating(events: DataFrame) -> DataFrame:
    """View 1, addtocart 2, anything else 3."""
    return events.withColumn("rating", implicit_rating("event"))


def best_rating(rated: DataFrame) -> DataFrame:
    """Per (visitor, item) the highest rating and its latest timestamp."""
    best = (rated.groupBy("visitorid", "itemid")
            .agg(F.max(F.struct("rating", "timestamp")).alias("_best")))
    return best.select("visitorid", "itemid", F.col("_best.rating").alias("rating"),
                       F.col("_best.timestamp").alias("timestamp"))


def ratings(events: DataFrame, features: DataFrame | None = None) -> DataFrame:
    """Rating triples of the eligible visitors.

    The highest rating's latest time is the same with and without R2 before it
    (a rating stands for one set of events), so one aggregate does both."""
    ev = events if features is None else eligible_events(events, features)
    return best_rating(with_rating(ev))


def visitors_with_many_ratings(triples: DataFrame, minimum: int = 2) -> DataFrame:
    """Visitors with at least ``minimum`` rated items, with their count."""
    return (triples.groupBy("visitorid").agg(F.count(F.lit(1)).alias("size"))
            .where(F.col("size") >= minimum))
