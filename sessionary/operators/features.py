"""Per-visitor behaviour features.

``enhance_events`` adds the row-level columns (hour range, weekday, delta to the
previous event of the same type, next-event flags, session id).
``visitor_features`` aggregates them into one row per visitor:

    visitorid,
    num_views, num_acart, num_purch, num_evnts, num_txs,
    num_ev06h, num_ev12h, num_ev18h, num_ev00h,
    num_evsun, num_evmon, num_evtue, num_evwed, num_evthu, num_evfri, num_evsat,
    num_rep, num_repfv, num_repbv, num_funnl, max_vpmin,
    {min,avg,max}_dltvw, {min,avg,max}_dltac, {min,avg,max}_dltpr,
    {min,avg,max}_vwpse, {min,avg,max}_acpse, {min,avg,max}_prpse

Plan shape: one segmented scan (:mod:`sessionary.operators.sequence`) gives the
neighbours, sessions and running counts of every event, whatever the visitor's
share of the rows; sessions and minutes are runs of neighbouring events there, so
the table is a single map-side combined ``groupBy(visitorid)`` over the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionary.functions.time import (
    epoch_micros,
    floor_seconds,
    hour_range,
    minute_bucket,
    week_day,
)
from sessionary.operators.events import ORDER, SESSION_GAP_SECONDS, gap_break
from sessionary.operators.sequence import Scan, segmented_scan

VIEW, CART, BUY = "view", "addtocart", "transaction"

# Output names and the day of week (0 = Sunday) they count.
WEEKDAY_COLUMNS = ["num_evsun", "num_evmon", "num_evtue", "num_evwed",
                   "num_evthu", "num_evfri", "num_evsat"]
# Output names and the 6-hour range (0 = 00-06h) they count.
HOUR_COLUMNS = ["num_ev06h", "num_ev12h", "num_ev18h", "num_ev00h"]

FEATURE_COLUMNS = (
    ["num_views", "num_acart", "num_purch", "num_evnts", "num_txs"]
    + HOUR_COLUMNS + WEEKDAY_COLUMNS
    + ["num_rep", "num_repfv", "num_repbv", "num_funnl", "max_vpmin"]
    + [f"{s}_{t}" for t in ("dltvw", "dltac", "dltpr") for s in ("min", "avg", "max")]
    + [f"{s}_{t}" for t in ("vwpse", "acpse", "prpse") for s in ("min", "avg", "max")]
)


def _is(event: str) -> Column:
    return F.col("event") == F.lit(event)


def _flag(cond: Column) -> Column:
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


#: Running counts of the scan: events of a type so far in their session or minute.
_COUNTS = {"_s_views": (VIEW, "session"), "_s_acart": (CART, "session"), "_s_purch": (BUY, "session"),
           "_vpm": (VIEW, "minute")}


def _scan(events: DataFrame, gap_seconds: float, parts: int | None) -> DataFrame:
    """Events of known visitors with the V1-V8 columns and the running counts."""
    second = F.unix_seconds("timestamp")
    rows = events.where(F.col("visitorid").isNotNull()).select(
        "*", epoch_micros("timestamp").alias("_us"), floor_seconds("timestamp").alias("_sec"),
        F.floor(second / 60).alias("_minute"),
        *[_flag(_is(ev)).alias(f"_is_{ev}") for ev in (VIEW, CART, BUY)])
    scan = Scan(
        leads={"_next_item": ("itemid", 1), "_next_ev": ("event", 1), "_next_ev2": ("event", 2)},
        class_lags={"_prev_sec": ("_sec", "event")},
        breaks={"session": gap_break(gap_seconds), "minute": ("_minute", 0)},
        numbers={"session_id": "session"},
        sums={name: (f"_is_{ev}", run) for name, (ev, run) in _COUNTS.items()},
        ends={"_session_end": "session"})
    rows = segmented_scan(rows, ["visitorid"], ORDER, scan, parts)
    same_item = F.coalesce(F.col("itemid") == F.col("_next_item"), F.lit(False))
    return rows.select(
        *events.columns, "session_id",
        hour_range("timestamp").alias("hour_range"),
        week_day("timestamp").alias("week_day"),
        ((F.col("_sec") - F.col("_prev_sec")) / F.lit(60.0)).alias("deltat_2equal_events"),
        minute_bucket("timestamp", "minute").alias("minute"),
        _flag(same_item).alias("repitem"),
        _flag(same_item & _is(VIEW)).alias("repitem_fview"),
        _flag(same_item & _is(VIEW) & (F.col("_next_ev") == VIEW)).alias("repitem_bview"),
        _flag(_is(VIEW) & (F.col("_next_ev") == CART) & (F.col("_next_ev2") == BUY))
        .alias("funnel_flag"),
        *_COUNTS, "_session_end")


def enhance_events(events: DataFrame, gap_seconds: float = SESSION_GAP_SECONDS, *,
                   parts: int | None = None) -> DataFrame:
    """Canonical events -> events with session id and the V1-V8 row columns."""
    return _scan(events, gap_seconds, parts).drop(*_COUNTS, "_session_end")


def session_counts(enh: DataFrame) -> DataFrame:
    """V9: views / carts / purchases per (visitor, session)."""
    return enh.groupBy("visitorid", "session_id").agg(
        F.count_if(_is(VIEW)).alias("num_views"),
        F.count_if(_is(CART)).alias("num_acart"),
        F.count_if(_is(BUY)).alias("num_purch"),
    )


def session_stats(enh: DataFrame) -> DataFrame:
    """Min / avg / max of the per-session counts over all sessions."""
    per = session_counts(enh)
    aggs = []
    for src, tag in (("num_views", "vwpse"), ("num_acart", "acpse"), ("num_purch", "prpse")):
        aggs += [F.min(src).alias(f"min_{tag}"), F.avg(src).alias(f"avg_{tag}"),
                 F.max(src).alias(f"max_{tag}")]
    return per.groupBy("visitorid").agg(*aggs)


def views_per_bucket(enh: DataFrame, unit: str = "minute") -> DataFrame:
    """Max over the visitor's calendar buckets of views in the bucket.

    Every event's bucket is one group, so the max over events equals the max
    over groups; aggregating (visitor, bucket) first is map-side combinable.
    """
    name = "max_vpmin" if unit == "minute" else f"max_vp{unit}"
    bucket = F.col("minute") if unit == "minute" else minute_bucket("timestamp", unit)
    return (enh.groupBy("visitorid", bucket.alias("_bucket"))
            .agg(F.count_if(_is(VIEW)).alias("_views"))
            .groupBy("visitorid").agg(F.max("_views").alias(name)))


def event_count_aggs() -> list[Column]:
    """V11-V13."""
    return [
        F.count_if(_is(VIEW)).alias("num_views"),
        F.count_if(_is(CART)).alias("num_acart"),
        F.count_if(_is(BUY)).alias("num_purch"),
        F.count(F.lit(1)).alias("num_evnts"),
        F.count_distinct(F.when(F.col("transactionid") != -1, F.col("transactionid")))
        .alias("num_txs"),
    ]


def hour_count_aggs() -> list[Column]:
    """V14."""
    return [F.count_if(F.col("hour_range") == i).alias(n) for i, n in enumerate(HOUR_COLUMNS)]


def weekday_count_aggs(compat: bool = False) -> list[Column]:
    """V15.  ``compat=True`` reproduces the source's zeros (text vs integer)."""
    if compat:
        return [F.lit(0).cast("bigint").alias(n) for n in WEEKDAY_COLUMNS]
    return [F.count_if(F.col("week_day") == i).alias(n) for i, n in enumerate(WEEKDAY_COLUMNS)]


def rep_count_aggs() -> list[Column]:
    """V16."""
    return [F.sum("repitem").cast("bigint").alias("num_rep"),
            F.sum("repitem_fview").cast("bigint").alias("num_repfv"),
            F.sum("repitem_bview").cast("bigint").alias("num_repbv"),
            F.sum("funnel_flag").cast("bigint").alias("num_funnl")]


def delta_stat_aggs() -> list[Column]:
    """Stats of the same-type delta per type; no pair -> -1."""
    out = []
    for ev, tag in ((VIEW, "dltvw"), (CART, "dltac"), (BUY, "dltpr")):
        d = F.when(_is(ev), F.col("deltat_2equal_events"))
        for name, fn in (("min", F.min), ("avg", F.avg), ("max", F.max)):
            out.append(F.coalesce(fn(d).cast("double"), F.lit(-1.0)).alias(f"{name}_{tag}"))
    return out


def bouncer_filter() -> Column:
    """Keep unless (num_views <= 1 and no cart and no transaction)."""
    return ~((F.col("num_views") <= 1) & (F.col("num_acart") == 0) & (F.col("num_txs") == 0))


def _session_stat_aggs() -> list[Column]:
    """V10 from the running counts: a session's total stands in its last event.

    The mean over sessions is the visitor's total divided by the number of
    sessions (ids are 0..n-1).
    """
    n_sess = (F.max("session_id") + F.lit(1)).cast("double")
    out = []
    for src, tag, ev in (("_s_views", "vwpse", VIEW), ("_s_acart", "acpse", CART),
                         ("_s_purch", "prpse", BUY)):
        out += [F.min(F.when(F.col("_session_end"), F.col(src))).alias(f"min_{tag}"),
                F.try_divide(F.count_if(_is(ev)).cast("double"), n_sess).alias(f"avg_{tag}"),
                F.max(src).alias(f"max_{tag}")]
    return out


def visitor_features(events: DataFrame, gap_seconds: float = SESSION_GAP_SECONDS, *,
                     drop_bouncers: bool = True, weekday_compat: bool = False,
                     parts: int | None = None) -> DataFrame:
    """The 40-column visitor feature table from canonical events.

    ``parts``: partitions of the scan over the events.
    """
    out = _scan(events, gap_seconds, parts).groupBy("visitorid").agg(
        *event_count_aggs(), *hour_count_aggs(), *weekday_count_aggs(weekday_compat),
        *rep_count_aggs(), *delta_stat_aggs(), F.max("_vpm").alias("max_vpmin"),
        *_session_stat_aggs())
    if drop_bouncers:
        out = out.where(bouncer_filter())
    return out.select("visitorid", *FEATURE_COLUMNS)
