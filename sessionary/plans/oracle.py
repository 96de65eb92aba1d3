"""DuckDB SQL for the correctness check of each registered query.

Every string runs on the given parquet tables registered as views.  Computed
doubles are rounded to 6 decimals on both sides, integer sums are cast to
BIGINT (DuckDB sums are HUGEINT), epochs are floored before subtracting.
"""

from __future__ import annotations

# ---------------------------------------------------------------- shared CTEs

def events_cte(mapping: str = "user") -> str:
    visitor = ("CAST(user_id AS BIGINT)" if mapping == "user"
               else "CAST(user_id * 100 + day(ts) AS BIGINT)")
    return f"""ev AS (
    SELECT event_id,
           ts AS "timestamp",
           {visitor} AS visitorid,
           CASE event_type WHEN 'view' THEN 'view' WHEN 'click' THEN 'addtocart'
                           WHEN 'purchase' THEN 'transaction' ELSE event_type END AS event,
           CAST(json_extract_string(props, '$.k') AS INTEGER) AS itemid,
           CAST(CASE WHEN event_type = 'purchase' THEN event_id ELSE -1 END AS BIGINT)
               AS transactionid
    FROM events)"""


def sessions_cte(gap_seconds: int = 1800, src: str = "ev") -> str:
    gap_us = gap_seconds * 1_000_000
    return f"""gaps AS (
    SELECT *, CASE WHEN epoch_us("timestamp")
                        - epoch_us(LAG("timestamp") OVER (PARTITION BY visitorid
                                   ORDER BY "timestamp", event_id)) > {gap_us}
                   THEN 1 ELSE 0 END AS new_session
    FROM {src}),
sess AS (
    SELECT event_id, "timestamp", visitorid, event, itemid, transactionid,
           CAST(SUM(new_session) OVER (PARTITION BY visitorid ORDER BY "timestamp", event_id
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS session_id
    FROM gaps)"""


ENHANCED_CTE = """enh AS (
    SELECT *,
           CAST(floor(hour("timestamp") / 6) AS INTEGER) AS hour_range,
           CAST(dayofweek("timestamp") AS INTEGER) AS week_day,
           ((epoch_us("timestamp") // 1000000)
             - LAG(epoch_us("timestamp") // 1000000) OVER (PARTITION BY visitorid, event
                   ORDER BY "timestamp", event_id)) / 60.0 AS deltat_2equal_events,
           date_trunc('minute', "timestamp") AS minute,
           CASE WHEN itemid = LEAD(itemid, 1) OVER wv THEN 1 ELSE 0 END AS repitem,
           CASE WHEN itemid = LEAD(itemid, 1) OVER wv AND event = 'view'
                THEN 1 ELSE 0 END AS repitem_fview,
           CASE WHEN itemid = LEAD(itemid, 1) OVER wv AND event = 'view'
                     AND LEAD(event, 1) OVER wv = 'view' THEN 1 ELSE 0 END AS repitem_bview,
           CASE WHEN event = 'view' AND LEAD(event, 1) OVER wv = 'addtocart'
                     AND LEAD(event, 2) OVER wv = 'transaction' THEN 1 ELSE 0 END AS funnel_flag
    FROM sess
    WINDOW wv AS (PARTITION BY visitorid ORDER BY "timestamp", event_id))"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def enhanced_prefix(mapping: str = "user", gap_seconds: int = 1800) -> str:
    return with_ctes(events_cte(mapping), sessions_cte(gap_seconds), ENHANCED_CTE)


def _sum_if(cond: str, name: str) -> str:
    return f"CAST(SUM(CASE WHEN {cond} THEN 1 ELSE 0 END) AS BIGINT) AS {name}"


EVENT_COUNTS_SQL = ", ".join([
    _sum_if("event = 'view'", "num_views"),
    _sum_if("event = 'addtocart'", "num_acart"),
    _sum_if("event = 'transaction'", "num_purch"),
    "CAST(COUNT(1) AS BIGINT) AS num_evnts",
    "CAST(COUNT(DISTINCT CASE WHEN transactionid != -1 THEN transactionid END) AS BIGINT)"
    " AS num_txs",
])

HOUR_COUNTS_SQL = ", ".join(
    _sum_if(f"hour_range = {i}", n)
    for i, n in enumerate(["num_ev06h", "num_ev12h", "num_ev18h", "num_ev00h"]))

WEEKDAY_COUNTS_SQL = ", ".join(
    _sum_if(f"week_day = {i}", n)
    for i, n in enumerate(["num_evsun", "num_evmon", "num_evtue", "num_evwed",
                           "num_evthu", "num_evfri", "num_evsat"]))

REP_COUNTS_SQL = ", ".join([
    "CAST(SUM(repitem) AS BIGINT) AS num_rep",
    "CAST(SUM(repitem_fview) AS BIGINT) AS num_repfv",
    "CAST(SUM(repitem_bview) AS BIGINT) AS num_repbv",
    "CAST(SUM(funnel_flag) AS BIGINT) AS num_funnl",
])


def _rnd(expr: str, r: int | None) -> str:
    return expr if r is None else f"round({expr}, {r})"


def delta_stats_sql(r: int | None = 6) -> str:
    parts = []
    for ev, tag in (("view", "dltvw"), ("addtocart", "dltac"), ("transaction", "dltpr")):
        for fn in ("min", "avg", "max"):
            e = (f"COALESCE(CAST({fn.upper()}(CASE WHEN event = '{ev}' THEN "
                 f"deltat_2equal_events END) AS DOUBLE), -1.0)")
            parts.append(f"{_rnd(e, r)} AS {fn}_{tag}")
    return ", ".join(parts)


def session_stats_sql(r: int | None = 6) -> str:
    parts = []
    for src, tag in (("num_views", "vwpse"), ("num_acart", "acpse"), ("num_purch", "prpse")):
        parts += [f"CAST(MIN({src}) AS BIGINT) AS min_{tag}",
                  f"{_rnd(f'CAST(AVG({src}) AS DOUBLE)', r)} AS avg_{tag}",
                  f"CAST(MAX({src}) AS BIGINT) AS max_{tag}"]
    return ", ".join(parts)


SESSION_COUNTS_CTE = f"""sc AS (
    SELECT visitorid, session_id,
           {_sum_if("event = 'view'", "num_views")},
           {_sum_if("event = 'addtocart'", "num_acart")},
           {_sum_if("event = 'transaction'", "num_purch")}
    FROM enh GROUP BY visitorid, session_id)"""

BOUNCER_KEEP = "NOT (num_views <= 1 AND num_acart = 0 AND num_txs = 0)"


def visitor_features_sql(mapping: str = "user", gap_seconds: int = 1800,
                         drop_bouncers: bool = True, digits: int | None = 6) -> str:
    """The feature table; ``digits=None`` leaves doubles unrounded (for use
    as an input of further SQL)."""
    having = f"WHERE {BOUNCER_KEEP}" if drop_bouncers else ""
    return enhanced_prefix(mapping, gap_seconds) + f""",
{SESSION_COUNTS_CTE},
ss AS (SELECT visitorid, {session_stats_sql(digits)} FROM sc GROUP BY visitorid),
vpm AS (SELECT visitorid, CAST(MAX(v) AS BIGINT) AS max_vpmin FROM (
          SELECT visitorid, minute, SUM(CASE WHEN event = 'view' THEN 1 ELSE 0 END) AS v
          FROM enh GROUP BY visitorid, minute) GROUP BY visitorid),
main AS (
    SELECT visitorid, {EVENT_COUNTS_SQL}, {HOUR_COUNTS_SQL}, {WEEKDAY_COUNTS_SQL},
           {REP_COUNTS_SQL}, {delta_stats_sql(digits)}
    FROM enh GROUP BY visitorid)
SELECT main.visitorid,
       num_views, num_acart, num_purch, num_evnts, num_txs,
       num_ev06h, num_ev12h, num_ev18h, num_ev00h,
       num_evsun, num_evmon, num_evtue, num_evwed, num_evthu, num_evfri, num_evsat,
       num_rep, num_repfv, num_repbv, num_funnl, max_vpmin,
       min_dltvw, avg_dltvw, max_dltvw, min_dltac, avg_dltac, max_dltac,
       min_dltpr, avg_dltpr, max_dltpr,
       min_vwpse, avg_vwpse, max_vwpse, min_acpse, avg_acpse, max_acpse,
       min_prpse, avg_prpse, max_prpse
FROM main JOIN vpm USING (visitorid) JOIN ss USING (visitorid)
{having}"""
