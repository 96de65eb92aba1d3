"""Oracle SQL per registered query name (see :mod:`sessionary.plans.oracle`)."""

from __future__ import annotations

from sessionary.plans import oracle as O

ORACLE: dict[str, str] = {}

ORACLE["visitor_features"] = O.visitor_features_sql("user")
ORACLE["visitor_features_user_day"] = O.visitor_features_sql("user_day")

ORACLE["sessionize"] = O.with_ctes(O.events_cte("user"), O.sessions_cte(1800)) + \
    "SELECT event_id, visitorid, session_id FROM sess"
ORACLE["sessionize_6h"] = O.with_ctes(O.events_cte("user"), O.sessions_cte(21600)) + \
    "SELECT event_id, visitorid, session_id FROM sess"
ORACLE["event_counts"] = O.enhanced_prefix("user") + \
    f"SELECT visitorid, {O.EVENT_COUNTS_SQL} FROM enh GROUP BY visitorid"

_ENH = O.enhanced_prefix("user")
_EV = O.with_ctes(O.events_cte("user"))

RAW_CTE = """raw AS (
    SELECT event_id, CAST(epoch_us(ts) // 1000 AS BIGINT) AS epoch_ms,
           CASE WHEN event_type = 'purchase' THEN CAST(event_id AS DOUBLE) END AS transactionid
    FROM events)"""

ORACLE["scan_events"] = _EV + \
    'SELECT event_id, "timestamp", visitorid, event, itemid, transactionid FROM ev'
ORACLE["epoch_ms"] = O.with_ctes(RAW_CTE) + \
    "SELECT event_id, epoch_ms, make_timestamp(epoch_ms * 1000) AS \"timestamp\" FROM raw"
ORACLE["event_codes"] = _EV + """SELECT event_id, event,
    CAST(DENSE_RANK() OVER (ORDER BY event) - 1 AS INTEGER) AS event_code FROM ev"""
ORACLE["fill_tx"] = O.with_ctes(RAW_CTE) + \
    "SELECT event_id, CAST(COALESCE(CAST(transactionid AS BIGINT), -1) AS BIGINT) " \
    "AS transactionid FROM raw"

_FEATURES_UD = O.visitor_features_sql("user_day", digits=None)
_INT_FEATURES = ["visitorid", "num_views", "num_acart", "num_purch", "num_evnts", "num_txs",
                 "num_ev06h", "num_ev12h", "num_ev18h", "num_ev00h",
                 "num_evsun", "num_evmon", "num_evtue", "num_evwed", "num_evthu",
                 "num_evfri", "num_evsat", "num_rep", "num_repfv", "num_repbv",
                 "num_funnl", "max_vpmin", "min_vwpse", "max_vwpse", "min_acpse",
                 "max_acpse", "min_prpse", "max_prpse"]
_unions = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(MIN({c}) AS BIGINT) AS min_value, "
    f"CAST(MAX({c}) AS BIGINT) AS max_value, CAST(NULL AS DOUBLE) AS moved FROM vf"
    for c in _INT_FEATURES)
_DOUBLE_FEATURES = [f"{s}_{t}" for t in ("dltvw", "dltac", "dltpr") for s in ("min", "avg", "max")] + [
    "avg_vwpse", "avg_acpse", "avg_prpse"]
_moved = " UNION ALL ".join(
    f"SELECT '{c}', NULL, NULL, COALESCE(MAX(ABS(CAST(CAST({c} AS FLOAT) AS DOUBLE) - {c})), 0) FROM vf"
    for c in _DOUBLE_FEATURES)
ORACLE["downcast"] = f"""WITH vf AS ({_FEATURES_UD}),
mm AS ({_unions} UNION ALL {_moved})
SELECT "column", min_value, max_value,
       CASE WHEN moved <= 5e-4 THEN 'float' WHEN moved IS NOT NULL THEN 'double'
            WHEN min_value >= -128 AND max_value <= 127 THEN 'tinyint'
            WHEN min_value >= -32768 AND max_value <= 32767 THEN 'smallint'
            WHEN min_value >= -2147483648 AND max_value <= 2147483647 THEN 'int'
            ELSE 'bigint' END AS type
FROM mm"""

ORACLE["hour_range"] = _ENH + "SELECT event_id, hour_range FROM enh"
ORACLE["week_day"] = _ENH + "SELECT event_id, week_day FROM enh"
ORACLE["delta_same_event"] = _ENH + \
    "SELECT event_id, round(deltat_2equal_events, 6) AS deltat_2equal_events FROM enh"
ORACLE["views_per_minute"] = _ENH + """SELECT event_id,
    CAST(SUM(CASE WHEN event = 'view' THEN 1 ELSE 0 END)
         OVER (PARTITION BY visitorid, minute) AS BIGINT) AS views_per_minute FROM enh"""
ORACLE["views_per_hour"] = _ENH + """SELECT visitorid, CAST(MAX(v) AS BIGINT) AS max_vphour
FROM (SELECT visitorid, date_trunc('hour', "timestamp") AS h,
             SUM(CASE WHEN event = 'view' THEN 1 ELSE 0 END) AS v
      FROM enh GROUP BY visitorid, h) GROUP BY visitorid"""
ORACLE["rep_flags"] = _ENH + \
    "SELECT event_id, repitem, repitem_fview, repitem_bview FROM enh"
ORACLE["funnel_flag"] = _ENH + "SELECT event_id, funnel_flag FROM enh"

ORACLE["session_counts"] = _ENH + f""", {O.SESSION_COUNTS_CTE}
SELECT * FROM sc"""
ORACLE["session_stats"] = _ENH + f""", {O.SESSION_COUNTS_CTE}
SELECT visitorid, {O.session_stats_sql()} FROM sc GROUP BY visitorid"""
ORACLE["hour_counts"] = _ENH + \
    f"SELECT visitorid, {O.HOUR_COUNTS_SQL} FROM enh GROUP BY visitorid"
ORACLE["weekday_counts"] = _ENH + \
    f"SELECT visitorid, {O.WEEKDAY_COUNTS_SQL} FROM enh GROUP BY visitorid"
ORACLE["rep_counts"] = _ENH + \
    f"SELECT visitorid, {O.REP_COUNTS_SQL} FROM enh GROUP BY visitorid"
ORACLE["max_vpmin"] = f"SELECT visitorid, max_vpmin FROM ({ORACLE['visitor_features']})"
ORACLE["delta_stats"] = _ENH + \
    f"SELECT visitorid, {O.delta_stats_sql()} FROM enh GROUP BY visitorid"
ORACLE["session_join"] = O.visitor_features_sql("user_day", drop_bouncers=False)
ORACLE["drop_bouncers"] = \
    f"SELECT visitorid, num_views, num_acart, num_txs FROM ({_FEATURES_UD})"

# ratings: eligible visitors = the feature table (user_day mapping)
_R_PREFIX = f"""WITH vf AS ({_FEATURES_UD}),
{O.events_cte("user_day")},
elig AS (SELECT "timestamp", visitorid, event, itemid FROM ev
         WHERE visitorid IN (SELECT visitorid FROM vf)),
latest AS (SELECT visitorid, event, itemid, MAX("timestamp") AS "timestamp"
           FROM elig GROUP BY visitorid, event, itemid),
rated AS (SELECT *, CAST(CASE WHEN event = 'view' THEN 1 WHEN event = 'addtocart' THEN 2
                              ELSE 3 END AS INTEGER) AS rating FROM latest),
best AS (SELECT visitorid, itemid, arg_max(rating, (rating, "timestamp")) AS rating,
                arg_max("timestamp", (rating, "timestamp")) AS "timestamp"
         FROM rated GROUP BY visitorid, itemid)
"""
ORACLE["ratings_semi"] = _R_PREFIX + 'SELECT "timestamp", visitorid, event, itemid FROM elig'
ORACLE["dedup_latest"] = _R_PREFIX + 'SELECT visitorid, event, itemid, "timestamp" FROM latest'
ORACLE["rating_map"] = O.with_ctes(O.events_cte("user_day")) + """SELECT event_id, event,
    CAST(CASE WHEN event = 'view' THEN 1 WHEN event = 'addtocart' THEN 2 ELSE 3 END AS INTEGER)
    AS rating FROM ev"""
ORACLE["ratings"] = _R_PREFIX + 'SELECT visitorid, itemid, rating, "timestamp" FROM best'
ORACLE["ratings_multi"] = _R_PREFIX + """SELECT visitorid, CAST(COUNT(*) AS BIGINT) AS size
FROM best GROUP BY visitorid HAVING COUNT(*) >= 2"""

# ------------------------------------------------------------ profiling F1-F7
from sessionary.operators.features import FEATURE_COLUMNS as _FC  # noqa: E402

_LONG = f"""WITH vf AS ({_FEATURES_UD}),
long AS (UNPIVOT (SELECT {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _FC)} FROM vf)
         ON {", ".join(_FC)} INTO NAME feature VALUE value),
mins AS (SELECT feature, MIN(value) AS min_value, COUNT(*) AS n FROM long GROUP BY feature),
prof AS (SELECT m.feature, m.min_value,
                CAST(SUM(CASE WHEN l.value = m.min_value THEN 1 ELSE 0 END) AS BIGINT) AS min_count,
                round_even(SUM(CASE WHEN l.value = m.min_value THEN 1 ELSE 0 END) / m.n * 100.0 * 100.0, 0) / 100.0
                    AS min_percentage
         FROM long l JOIN mins m USING (feature) GROUP BY m.feature, m.min_value, m.n)
"""
ORACLE["profile_min"] = _LONG + "SELECT * FROM prof"
ORACLE["profile_summary"] = _LONG + """, rest AS (
    SELECT l.feature, l.value FROM long l JOIN prof p USING (feature) WHERE l.value != p.min_value),
st AS (SELECT feature, MIN(value) AS "min", quantile_cont(value, 0.25) AS q1,
              quantile_cont(value, 0.5) AS median, AVG(value) AS mean,
              quantile_cont(value, 0.75) AS q3, MAX(value) AS "max",
              stddev_samp(value) AS std_dev, var_samp(value) AS variance
       FROM rest GROUP BY feature)
SELECT p.feature, round(p.min_value, 6) AS min_value, p.min_count,
       round(p.min_percentage, 6) AS min_percentage,
       round(st."min", 6) AS "min", round(q1, 6) AS q1, round(median, 6) AS median,
       round(mean, 6) AS mean, round(q3, 6) AS q3, round(st."max", 6) AS "max",
       round(std_dev, 6) AS std_dev, round(variance, 6) AS variance
FROM prof p LEFT JOIN st USING (feature)"""


def _corr_sql(features, where_pairs=""):
    sel = ", ".join(f'corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) AS "{a}|{b}"'
                    for a in features for b in features)
    cols = ", ".join(f'"{a}|{b}"' for a in features for b in features)
    return f"""cm AS (SELECT {sel} FROM vf),
cl AS (UNPIVOT cm ON {cols} INTO NAME pair VALUE r0),
corr AS (SELECT split_part(pair, '|', 1) AS feature_a, split_part(pair, '|', 2) AS feature_b,
                CASE WHEN isnan(r0) THEN NULL ELSE greatest(least(r0, 1.0), -1.0) END AS r
         FROM cl)"""


ORACLE["corr_matrix"] = f"WITH vf AS ({_FEATURES_UD}),\n{_corr_sql(_FC)}\n" + \
    "SELECT feature_a, feature_b, round(r, 6) AS r FROM corr"

_names_values = ", ".join(f"('{c}')" for c in _FC)
ORACLE["corr_counts"] = f"""WITH vf AS ({_FEATURES_UD}),
{_corr_sql(_FC)},
names AS (SELECT * FROM (VALUES {_names_values}) t(feature)),
hits AS (SELECT feature_a AS feature, COUNT(*) AS c FROM corr
         WHERE feature_a != feature_b AND abs(r) > 0.8 AND r < 1 - 1e-12 GROUP BY feature_a)
SELECT feature, CAST(COALESCE(c, 0) AS BIGINT) AS correlated_count
FROM names LEFT JOIN hits USING (feature)"""

ORACLE["feature_selection"] = _LONG + f""",
{_corr_sql(_FC)},
kept AS (SELECT feature FROM prof WHERE min_percentage < 95.0),
hits AS (SELECT feature_a AS feature, COUNT(*) AS c FROM corr
         WHERE feature_a IN (SELECT feature FROM kept) AND feature_b IN (SELECT feature FROM kept)
           AND feature_a != feature_b AND abs(r) > 0.8 AND r < 1 - 1e-12 GROUP BY feature_a),
cnt AS (SELECT k.feature, CAST(COALESCE(h.c, 0) AS BIGINT) AS correlated_count
        FROM kept k LEFT JOIN hits h USING (feature))
SELECT p.feature, p.min_percentage, cnt.correlated_count,
       COALESCE(cnt.correlated_count < (SELECT COUNT(*) // 2 FROM kept), FALSE) AS selected
FROM prof p LEFT JOIN cnt USING (feature)"""

ORACLE["norm_zscore"] = f"WITH vf AS ({_FEATURES_UD})\nSELECT visitorid, " + ", ".join(
    f"round((CAST({c} AS DOUBLE) - AVG(CAST({c} AS DOUBLE)) OVER ()) / "
    f"NULLIF(stddev_samp(CAST({c} AS DOUBLE)) OVER (), 0), 6) AS {c}" for c in _FC) + " FROM vf"
ORACLE["norm_minmax"] = f"WITH vf AS ({_FEATURES_UD})\nSELECT visitorid, " + ", ".join(
    f"round((CAST({c} AS DOUBLE) - MIN({c}) OVER ()) / "
    f"NULLIF(CAST(MAX({c}) OVER () AS DOUBLE) - MIN({c}) OVER (), 0), 6) AS {c}"
    for c in _FC) + " FROM vf"

# ------------------------------------------------------------ result stats A1-A3
def _np_round(expr: str, d: int = 2) -> str:
    """numpy rounding: rint(x * 10^d) / 10^d, half-even on the scaled value."""
    return f"(round_even(CAST({expr} AS DOUBLE) * {10 ** d}.0, 0) / {10 ** d}.0)"


ORACLE["describe_by_label"] = f"""SELECT l_returnflag,
    {_np_round("COUNT(l_extendedprice)")} AS count, {_np_round("AVG(l_extendedprice)")} AS mean,
    {_np_round("stddev_samp(l_extendedprice)")} AS std, {_np_round("MIN(l_extendedprice)")} AS "min",
    {_np_round("quantile_cont(l_extendedprice, 0.25)")} AS p25,
    {_np_round("quantile_cont(l_extendedprice, 0.5)")} AS p50,
    {_np_round("quantile_cont(l_extendedprice, 0.75)")} AS p75,
    {_np_round("MAX(l_extendedprice)")} AS "max"
FROM lineitem GROUP BY l_returnflag"""

_LF = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_stat_rows = []
for _c in _LF:
    for _s, _e in (("min", f"MIN({_c})"), ("median", f"quantile_cont({_c}, 0.5)"),
                   ("max", f"MAX({_c})"), ("std", f"stddev_samp({_c})")):
        _stat_rows.append(
            f"SELECT '{_c}' AS feature, '{_s}' AS stat, "
            + ", ".join(f"{_np_round(f'{_e} FILTER (WHERE l_returnflag = {chr(39)}{v}{chr(39)})')} "
                        f"AS label_{v}" for v in ("A", "N", "R"))
            + " FROM lineitem")
ORACLE["feature_stats_by_label"] = "\nUNION ALL\n".join(_stat_rows)


def _kde_sql(group_expr: str | None) -> str:
    parts = ["SELECT 'ALL' AS grp, CAST(l_extendedprice AS DOUBLE) AS x FROM lineitem"]
    if group_expr:
        parts.append(f"SELECT CAST({group_expr} AS VARCHAR) AS grp, "
                     "CAST(l_extendedprice AS DOUBLE) AS x FROM lineitem")
    data = " UNION ALL ".join(parts)
    return f"""WITH d AS ({data}),
p AS (SELECT grp, COUNT(*) AS n, stddev_samp(x) * pow(COUNT(*), -0.2) AS h,
             MIN(x) AS lo, MAX(x) AS hi FROM d WHERE x IS NOT NULL GROUP BY grp),
g AS (SELECT grp, n, h, CAST(k AS INTEGER) AS point,
             (lo - 3.0 * h) + k * ((hi - lo + 6.0 * h) / 199.0) AS gx
      FROM p, range(0, 200) t(k) WHERE h > 0)
SELECT g.grp AS "group", g.point, round(g.gx, 9) AS x,
       round(SUM(exp(-0.5 * ((g.gx - d.x) / g.h) * ((g.gx - d.x) / g.h)))
             / sqrt(2 * pi()) / (g.n * g.h), 9) AS density
FROM g JOIN d ON d.grp = g.grp GROUP BY g.grp, g.point, g.gx, g.n, g.h"""


ORACLE["kde_all"] = _kde_sql(None)
ORACLE["kde_group"] = _kde_sql("l_returnflag")

# ------------------------------------------------------------ samples / neighbours
_SPLITS, _FRAC = 3, 0.2
ORACLE["sample_stratified_counts"] = f"""WITH c AS (SELECT toxic, COUNT(*) AS n FROM labels GROUP BY toxic),
tot AS (SELECT SUM(n) AS nn, CAST(ceil({_FRAC} * SUM(n)) AS BIGINT) AS t FROM c),
r AS (SELECT toxic, n, t * n / nn AS raw, CAST(floor(t * n / nn) AS BIGINT) AS base FROM c, tot),
l AS (SELECT (SELECT t FROM tot) - SUM(base) AS lft FROM r),
rk AS (SELECT *, ROW_NUMBER() OVER (ORDER BY raw - base DESC, CAST(toxic AS VARCHAR)) AS k FROM r)
SELECT CAST(s.split AS INTEGER) AS split, toxic,
       CAST(base + CASE WHEN k <= lft THEN 1 ELSE 0 END AS BIGINT) AS n
FROM rk, l, range(0, {_SPLITS}) s(split)"""
ORACLE["sample_random_count"] = f"""SELECT CAST(s.split AS INTEGER) AS split,
       CAST(round({_FRAC} * COUNT(*)) AS BIGINT) AS n,
       CAST(round({_FRAC} * COUNT(*)) AS BIGINT) AS distinct_docs
FROM labels, range(0, {_SPLITS}) s(split) GROUP BY s.split"""

_EMB = """e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v,
                list_inner_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])) AS nn,
                label FROM embeddings),
pairs AS (SELECT a.vec_id AS id, b.vec_id AS other, a.label AS label, b.label AS olabel,
                 CASE WHEN a.vec_id = b.vec_id THEN 0.0
                      ELSE greatest(a.nn + b.nn - 2 * list_inner_product(a.v, b.v), 0.0) END AS d2
          FROM e a, e b)"""
_KD = f"""WITH {_EMB},
kd AS (SELECT id, d2 FROM (SELECT id, d2, ROW_NUMBER() OVER (PARTITION BY id ORDER BY d2) AS rn
                           FROM pairs) WHERE rn = 128),
curve AS (SELECT CAST(ROW_NUMBER() OVER (ORDER BY d2) AS INTEGER) AS rank, d2 FROM kd)
"""
ORACLE["k_distance"] = _KD + \
    "SELECT rank, round(d2, 6) AS distance_sq, round(sqrt(d2), 6) AS distance FROM curve"
ORACLE["k_distance_tail"] = _KD + """SELECT rank, round(d2, 6) AS distance_sq,
    round(sqrt(d2), 6) AS distance FROM curve WHERE rank > (SELECT COUNT(*) FROM curve) - 20"""
ORACLE["silhouette"] = f"""WITH {_EMB},
per AS (SELECT id, label, olabel, SUM(sqrt(d2)) AS s, COUNT(*) AS c FROM pairs
        GROUP BY id, label, olabel),
ab AS (SELECT id,
              MAX(CASE WHEN label = olabel THEN s / NULLIF(c - 1, 0) END) AS a,
              MAX(CASE WHEN label = olabel THEN c END) AS size,
              MIN(CASE WHEN label != olabel THEN s / c END) AS b
       FROM per GROUP BY id)
SELECT CAST(COUNT(*) AS BIGINT) AS n,
       round(AVG(CASE WHEN size <= 1 THEN 0.0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette
FROM ab"""

ORACLE["label_correction"] = f"""SELECT visitorid,
    CAST(CASE WHEN lab = -1 AND num_txs > 0 THEN 1 ELSE lab END AS INTEGER) AS anomaly_label
FROM (SELECT visitorid, num_txs, CASE WHEN num_evnts > 2 * num_views THEN -1 ELSE 1 END AS lab
      FROM ({_FEATURES_UD}))"""

ORACLE["dbscan_core"] = f"""WITH {_EMB}
SELECT id, CAST(COUNT(*) AS BIGINT) AS n_neighbors, COUNT(*) >= 38 AS core
FROM pairs WHERE d2 <= 1.2 * 1.2 GROUP BY id"""



def _dbscan_sql(eps: float, min_samples: int) -> str:
    return f"""WITH RECURSIVE {_EMB},
near AS (SELECT id, other FROM pairs WHERE d2 <= {eps} * {eps}),
cnt AS (SELECT id, CAST(COUNT(*) AS BIGINT) AS n_neighbors FROM near GROUP BY id),
core AS (SELECT id FROM cnt WHERE n_neighbors >= {min_samples}),
steps AS (SELECT near.id, near.other FROM near JOIN core a ON a.id = near.id
          JOIN core b ON b.id = near.other),
reach(root, id) AS (
    SELECT id, id FROM core
    UNION SELECT r.root, s.other FROM reach r JOIN steps s ON s.id = r.id),
comp AS (SELECT id, MIN(root) AS first FROM reach GROUP BY id),
numbered AS (SELECT id, CAST(DENSE_RANK() OVER (ORDER BY first) - 1 AS INTEGER) AS cluster FROM comp),
border AS (SELECT near.id, MIN(cluster) AS cluster FROM near
           JOIN numbered ON numbered.id = near.other GROUP BY near.id)
SELECT cnt.id, n_neighbors, n_neighbors >= {min_samples} AS core,
       COALESCE(numbered.cluster, border.cluster, -1) AS label
FROM cnt LEFT JOIN numbered USING (id) LEFT JOIN border USING (id)"""


ORACLE["dbscan"] = _dbscan_sql(1.2, 38)
ORACLE["dbscan_clusters"] = _dbscan_sql(1.15, 5)

# samples: the least MD5 keys of each split (and class)
_KEY60 = "CAST('0x' || substr(md5(concat_ws(':', {parts})), 1, 15) AS BIGINT)"
ORACLE["sample_random"] = f"""SELECT split, doc_id, quality FROM (
    SELECT CAST(s.split AS INTEGER) AS split, doc_id, quality,
           ROW_NUMBER() OVER (PARTITION BY s.split ORDER BY {_KEY60.format(parts="42 + s.split, doc_id")}, doc_id) AS k,
           round({_FRAC} * COUNT(*) OVER (PARTITION BY s.split)) AS n
    FROM labels, range(0, {_SPLITS}) s(split)) WHERE k <= n"""
ORACLE["sample_stratified"] = f"""WITH counts AS ({ORACLE["sample_stratified_counts"]}),
ranked AS (
    SELECT CAST(s.split AS INTEGER) AS split, doc_id, quality, toxic,
           ROW_NUMBER() OVER (PARTITION BY s.split, toxic
                              ORDER BY {_KEY60.format(parts="42, doc_id, s.split")}, doc_id) AS k
    FROM labels, range(0, {_SPLITS}) s(split))
SELECT split, doc_id, quality FROM ranked JOIN counts USING (split, toxic) WHERE k <= n"""

ORACLE["csv_tables"] = _EV + """SELECT make_timestamp((epoch_us("timestamp") // 1000) * 1000)
    AS "timestamp", visitorid, event, itemid, transactionid FROM ev"""

ORACLE["artifact_roundtrip"] = ORACLE["event_counts"]

ORACLE["visitor_features_sql"] = ORACLE["visitor_features"]

ORACLE["silhouette_sq"] = f"""WITH {_EMB},
per AS (SELECT id, label, olabel, SUM(d2) AS s, COUNT(*) AS c FROM pairs
        GROUP BY id, label, olabel),
ab AS (SELECT id,
              MAX(CASE WHEN label = olabel THEN s / NULLIF(c - 1, 0) END) AS a,
              MAX(CASE WHEN label = olabel THEN c END) AS size,
              MIN(CASE WHEN label != olabel THEN s / c END) AS b
       FROM per GROUP BY id)
SELECT CAST(COUNT(*) AS BIGINT) AS n,
       round(AVG(CASE WHEN size <= 1 THEN 0.0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette
FROM ab"""

# the hot-visitor path must give the same tables
ORACLE["visitor_features_hot"] = ORACLE["visitor_features"]
ORACLE["sessionize_hot"] = ORACLE["sessionize"]

# ------------------------------------------------------------ forest M2-M4, E1, E2, A1-A3
from sessionary.plans import forest_sql as FS  # noqa: E402

_SELECTED = f"""{_corr_sql(_FC)},
kept AS (SELECT feature FROM prof WHERE min_percentage < 95.0),
hits AS (SELECT feature_a AS feature, COUNT(*) AS c FROM corr
         WHERE feature_a IN (SELECT feature FROM kept) AND feature_b IN (SELECT feature FROM kept)
           AND feature_a != feature_b AND abs(r) > 0.8 AND r < 1 - 1e-12 GROUP BY feature_a)"""
_FOREST = f"""{_LONG}, {_SELECTED}, {FS.forest_ctes('''SELECT k.feature FROM kept k
    LEFT JOIN hits h USING (feature) WHERE COALESCE(h.c, 0) < (SELECT COUNT(*) // 2 FROM kept)''', _FC)}"""
_SCORED = f"{_FOREST}, {FS.score_ctes()}"

ORACLE["iforest_nodes"] = f"{_FOREST} SELECT {FS.NODE_COLUMNS} FROM nodes"
ORACLE["tree_nodes"] = f"""{_FOREST} SELECT {FS.NODE_COLUMNS},
    CASE WHEN feature IS NULL THEN 'leaf n=' || n || ' value=' || format('{{:,.4f}}', leaf_value)
         ELSE feature || ' <= ' || format('{{:,.4f}}', threshold) END AS rule
FROM nodes WHERE tree = 0"""
ORACLE["split_importance"] = f"{_FOREST}, {FS.IMPORTANCE} SELECT feature, round(weight, 6) AS weight FROM importance"
ORACLE["iforest_score"] = f"""{_SCORED} SELECT visitorid, round(path_length, 6) AS path_length,
    round(score_samples, 6) AS score_samples, round(anomaly_score, 6) AS anomaly_score FROM scored"""
ORACLE["iforest_label"] = f"{_SCORED} SELECT visitorid, anomaly_label FROM scored"
ORACLE["forest_roundtrip"] = f"{_SCORED} SELECT visitorid, round(anomaly_score, 6) AS anomaly_score FROM scored"
ORACLE["describe_by_anomaly"] = f"""{_SCORED} SELECT anomaly_label,
    {_np_round("COUNT(anomaly_score)")} AS count, {_np_round("AVG(anomaly_score)")} AS mean,
    {_np_round("stddev_samp(anomaly_score)")} AS std, {_np_round("MIN(anomaly_score)")} AS "min",
    {_np_round("quantile_cont(anomaly_score, 0.25)")} AS p25, {_np_round("quantile_cont(anomaly_score, 0.5)")} AS p50,
    {_np_round("quantile_cont(anomaly_score, 0.75)")} AS p75, {_np_round("MAX(anomaly_score)")} AS "max"
FROM scored GROUP BY anomaly_label"""
_BY_LABEL = "\n    UNION ALL ".join(
    f"SELECT feature, '{stat}' AS stat, " + ", ".join(
        f"{_np_round(f'{expr} FILTER (WHERE anomaly_label = {label})')} AS label_{name}"
        for label, name in ((-1, "m1"), (1, "1"))) + " FROM own GROUP BY feature"
    for stat, expr in (("min", "MIN(x)"), ("median", "quantile_cont(x, 0.5)"), ("max", "MAX(x)"),
                       ("std", "stddev_samp(x)")))
ORACLE["feature_stats_by_anomaly"] = f"""{_SCORED}, {FS.IMPORTANCE},
top AS (SELECT feature FROM importance ORDER BY weight DESC, feature LIMIT 10),
own AS (SELECT feature, x, anomaly_label FROM values_ JOIN top USING (feature) JOIN scored USING (visitorid))
{_BY_LABEL}"""
ORACLE["kde_anomaly"] = f"""{_SCORED},
d AS (SELECT 'ALL' AS grp, anomaly_score AS x FROM scored
      UNION ALL SELECT CAST(anomaly_label AS VARCHAR), anomaly_score FROM scored),
p AS (SELECT grp, COUNT(*) AS n, stddev_samp(x) * pow(COUNT(*), -0.2) AS h,
             MIN(x) AS lo, MAX(x) AS hi FROM d GROUP BY grp),
g AS (SELECT grp, n, h, CAST(k AS INTEGER) AS point,
             (lo - 3.0 * h) + k * ((hi - lo + 6.0 * h) / 199.0) AS gx
      FROM p, range(0, 200) t(k) WHERE h > 0)
SELECT g.grp AS "group", g.point, round(g.gx, 9) AS x,
       round(SUM(exp(-0.5 * ((g.gx - d.x) / g.h) * ((g.gx - d.x) / g.h)))
             / sqrt(2 * pi()) / (g.n * g.h), 9) AS density
FROM g JOIN d ON d.grp = g.grp GROUP BY g.grp, g.point, g.gx, g.n, g.h"""


# ------------------------------------------------------------ Shapley values E3-E7
_SHAP = f"{_FOREST}, {FS.shap_ctes()}"
_MEAN_SHAP = """weights AS (SELECT feature, AVG(abs(shap_value)) AS weight FROM phi GROUP BY feature)"""

ORACLE["shap_long"] = f"""{_SHAP} SELECT visitorid, feature, round(shap_value, 6) AS shap_value,
    round(base_value, 6) AS base_value FROM phi, base"""
ORACLE["shap_importance"] = f"{_SHAP}, {_MEAN_SHAP} SELECT feature, round(weight, 6) AS weight FROM weights"
ORACLE["shap_top20"] = f"""{_SHAP}, {_MEAN_SHAP} SELECT feature, round(weight, 6) AS weight FROM weights
ORDER BY weights.weight DESC, feature LIMIT 20"""
ORACLE["shap_dependence"] = f"""{_SHAP}, {_MEAN_SHAP},
own AS (SELECT feature FROM chosen WHERE pos = 1),
other AS (SELECT feature FROM (SELECT feature FROM weights ORDER BY weight DESC, feature LIMIT 2)
          WHERE feature NOT IN (SELECT feature FROM own) LIMIT 1)
SELECT a.visitorid, a.feature, round(a.x, 6) AS value, round(p.shap_value, 6) AS shap_value,
    b.feature AS interaction, round(b.x, 6) AS interaction_value
FROM values_ a JOIN own USING (feature) JOIN phi p USING (visitorid, feature)
    JOIN values_ b ON b.visitorid = a.visitorid AND b.feature IN (SELECT feature FROM other)"""
ORACLE["shap_instance"] = f"""{_FOREST}, {FS.shap_ctes("SELECT MIN(visitorid) FROM vf")}
SELECT visitorid, feature, round(x, 6) AS value, round(shap_value, 6) AS shap_value,
    round(base_value, 6) AS base_value
FROM phi JOIN values_ USING (visitorid, feature), base"""


# ------------------------------------------------------------ run log S4, M13, signature S5
ORACLE["run_log"] = _EV + """SELECT 'count' AS method, '"' || event || '"' AS event, key, value FROM (
    UNPIVOT (SELECT event, COUNT(*)::DOUBLE AS events, COUNT(DISTINCT visitorid)::DOUBLE AS visitors
             FROM ev WHERE visitorid IS NOT NULL AND event IN ('view', 'addtocart') GROUP BY event)
    ON events, visitors INTO NAME key VALUE value)"""
_GRID_VALUES = {
    "anomaly_share": "AVG(CASE WHEN s + 0.5 < 0 THEN 1.0::DOUBLE ELSE 0.0 END)", "mean_score": "AVG(s + 0.5)",
    "rows_scores_scored": "COUNT(*)::DOUBLE", "rows_scores_describe": "COUNT(DISTINCT s + 0.5 < 0)::DOUBLE",
    "rows_importance_splits": "(SELECT COUNT(*) FROM chosen)::DOUBLE",
    "rows_importance_shap": "(SELECT COUNT(*) FROM chosen)::DOUBLE",
    "rows_stats_top_features": "(SELECT 4 * least(10, COUNT(*)) FROM chosen)::DOUBLE",
    "trees_of_model": "trees::DOUBLE"}
ORACLE["grid_runs"] = f"""{_SCORED},
grid AS MATERIALIZED (
    SELECT trees, visitorid, -pow(2.0, -AVG(leaf_value) / {FS.average_path("any_value(psi)")}) AS s
    FROM walk{FS.LEVELS} w JOIN nodes n ON n.tree = w.tree AND n.node = w.node
        JOIN (VALUES (10), (50)) t(trees) ON w.tree < trees, psize
    GROUP BY trees, visitorid)
""" + "\nUNION ALL ".join(
    f"SELECT trees::VARCHAR AS n_estimators, '{key}' AS key, round({expr}, 6) AS value FROM grid GROUP BY trees"
    for key, expr in _GRID_VALUES.items())
ORACLE["forest_signature"] = f"""{_FOREST},
kinds AS (UNPIVOT (SELECT {", ".join(f"lower(typeof(MIN({c}))) AS {c}" for c in _FC)} FROM vf)
          ON {", ".join(_FC)} INTO NAME feature VALUE kind)
SELECT 'input' AS direction, feature AS "column", kind AS type FROM chosen JOIN kinds USING (feature)
UNION ALL SELECT 'output', * FROM (VALUES ('path_length', 'double'), ('score_samples', 'double'),
    ('anomaly_score', 'double'), ('anomaly_label', 'int'))"""
