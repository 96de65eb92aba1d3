-- Per-visitor behaviour features in Spark SQL over a view `events`
-- (event_id, timestamp, visitorid, event, itemid, transactionid, session_id).
-- Same output as sessionary.operators.features.visitor_features; the
-- DataFrame version adds the hot-visitor path.
WITH ordered AS (
  SELECT e.*,
         LEAD(itemid, 1) OVER (PARTITION BY visitorid ORDER BY `timestamp`, event_id) AS next_item,
         LEAD(event, 1)  OVER (PARTITION BY visitorid ORDER BY `timestamp`, event_id) AS next_event,
         LEAD(event, 2)  OVER (PARTITION BY visitorid ORDER BY `timestamp`, event_id) AS next_event2,
         (unix_seconds(`timestamp`) - LAG(unix_seconds(`timestamp`)) OVER (
             PARTITION BY visitorid, event ORDER BY `timestamp`, event_id)) / 60.0D AS gap_min,
         CAST(hour(`timestamp`) / 6 AS INT) AS hour_range,
         dayofweek(`timestamp`) - 1 AS week_day,
         date_trunc('minute', `timestamp`) AS minute
  FROM events e
  WHERE visitorid IS NOT NULL
),
flagged AS (
  SELECT *,
         CASE WHEN itemid = next_item THEN 1 ELSE 0 END AS rep,
         CASE WHEN itemid = next_item AND event = 'view' THEN 1 ELSE 0 END AS rep_fv,
         CASE WHEN itemid = next_item AND event = 'view' AND next_event = 'view'
              THEN 1 ELSE 0 END AS rep_bv,
         CASE WHEN event = 'view' AND next_event = 'addtocart' AND next_event2 = 'transaction'
              THEN 1 ELSE 0 END AS funnel,
         count_if(event = 'view') OVER (PARTITION BY visitorid, minute) AS vpm,
         count_if(event = 'view') OVER (PARTITION BY visitorid, session_id) AS s_views,
         count_if(event = 'addtocart') OVER (PARTITION BY visitorid, session_id) AS s_acart,
         count_if(event = 'transaction') OVER (PARTITION BY visitorid, session_id) AS s_purch
  FROM ordered
),
agg AS (
  SELECT visitorid,
         count_if(event = 'view') AS num_views,
         count_if(event = 'addtocart') AS num_acart,
         count_if(event = 'transaction') AS num_purch,
         count(1) AS num_evnts,
         count(DISTINCT CASE WHEN transactionid != -1 THEN transactionid END) AS num_txs,
         count_if(hour_range = 0) AS num_ev06h, count_if(hour_range = 1) AS num_ev12h,
         count_if(hour_range = 2) AS num_ev18h, count_if(hour_range = 3) AS num_ev00h,
         count_if(week_day = 0) AS num_evsun, count_if(week_day = 1) AS num_evmon,
         count_if(week_day = 2) AS num_evtue, count_if(week_day = 3) AS num_evwed,
         count_if(week_day = 4) AS num_evthu, count_if(week_day = 5) AS num_evfri,
         count_if(week_day = 6) AS num_evsat,
         CAST(sum(rep) AS BIGINT) AS num_rep, CAST(sum(rep_fv) AS BIGINT) AS num_repfv,
         CAST(sum(rep_bv) AS BIGINT) AS num_repbv, CAST(sum(funnel) AS BIGINT) AS num_funnl,
         max(vpm) AS max_vpmin,
         coalesce(min(CASE WHEN event = 'view' THEN gap_min END), -1.0D) AS min_dltvw,
         coalesce(avg(CASE WHEN event = 'view' THEN gap_min END), -1.0D) AS avg_dltvw,
         coalesce(max(CASE WHEN event = 'view' THEN gap_min END), -1.0D) AS max_dltvw,
         coalesce(min(CASE WHEN event = 'addtocart' THEN gap_min END), -1.0D) AS min_dltac,
         coalesce(avg(CASE WHEN event = 'addtocart' THEN gap_min END), -1.0D) AS avg_dltac,
         coalesce(max(CASE WHEN event = 'addtocart' THEN gap_min END), -1.0D) AS max_dltac,
         coalesce(min(CASE WHEN event = 'transaction' THEN gap_min END), -1.0D) AS min_dltpr,
         coalesce(avg(CASE WHEN event = 'transaction' THEN gap_min END), -1.0D) AS avg_dltpr,
         coalesce(max(CASE WHEN event = 'transaction' THEN gap_min END), -1.0D) AS max_dltpr,
         min(s_views) AS min_vwpse, count_if(event = 'view') / (max(session_id) + 1) AS avg_vwpse,
         max(s_views) AS max_vwpse,
         min(s_acart) AS min_acpse, count_if(event = 'addtocart') / (max(session_id) + 1) AS avg_acpse,
         max(s_acart) AS max_acpse,
         min(s_purch) AS min_prpse, count_if(event = 'transaction') / (max(session_id) + 1) AS avg_prpse,
         max(s_purch) AS max_prpse
  FROM flagged
  GROUP BY visitorid
)
SELECT * FROM agg
WHERE NOT (num_views <= 1 AND num_acart = 0 AND num_txs = 0)
