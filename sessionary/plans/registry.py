"""Named queries over the given tables: ``(spark, sf_dir) -> DataFrame``.

Each entry reads the test tables through the adapters in
:mod:`sessionary.sources.tables` and runs one operator of the library on the
whole table.  Computed doubles are rounded to 6 decimals (the oracle SQL does
the same) so that both engines' last-bit differences do not count.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionary.operators import events as P
from sessionary.operators import features as V
from sessionary.sources.tables import canonical_events

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every DOUBLE/FLOAT column (comparison convention)."""
    return df.select(*[
        F.round(F.col(f.name), digits).cast("double").alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
        for f in df.schema.fields])


def _enh(spark, sf_dir, mapping="user"):
    return V.enhance_events(canonical_events(spark, sf_dir, mapping))


# ------------------------------------------------------------ flagship

@register("visitor_features")
def q_visitor_features(spark, sf_dir):
    return rounded(V.visitor_features(canonical_events(spark, sf_dir, "user")))


@register("visitor_features_user_day")
def q_visitor_features_user_day(spark, sf_dir):
    return rounded(V.visitor_features(canonical_events(spark, sf_dir, "user_day")))


# ------------------------------------------------------------ sessions

@register("sessionize")
def q_sessionize(spark, sf_dir):
    return P.sessionize(canonical_events(spark, sf_dir, "user")).select(
        "event_id", "visitorid", "session_id")


@register("sessionize_6h")
def q_sessionize_6h(spark, sf_dir):
    return P.sessionize(canonical_events(spark, sf_dir, "user"), 21600).select(
        "event_id", "visitorid", "session_id")


@register("event_counts")
def q_event_counts(spark, sf_dir):
    enh = _enh(spark, sf_dir)
    return enh.groupBy("visitorid").agg(*V.event_count_aggs())


# ------------------------------------------------------------ sources / prep

from sessionary.operators import ratings as R  # noqa: E402
from sessionary.sources.tables import raw_events  # noqa: E402
from sessionary.functions.time import epoch_ms_to_timestamp  # noqa: E402
from sessionary.functions.columns import fill_missing_id  # noqa: E402


def ntz(col: str):
    """Timestamps leave as TIMESTAMP_NTZ (UTC wall clock), zone-independent."""
    return F.col(col).cast("timestamp_ntz").alias(col)


@register("scan_events")
def q_scan_events(spark, sf_dir):
    ev = canonical_events(spark, sf_dir, "user")
    return ev.select("event_id", ntz("timestamp"), "visitorid", "event", "itemid",
                     "transactionid")


@register("epoch_ms")
def q_epoch_ms(spark, sf_dir):
    raw = raw_events(spark, sf_dir, "user")
    return raw.select("event_id", F.col("timestamp").alias("epoch_ms"),
                      epoch_ms_to_timestamp("timestamp").cast("timestamp_ntz")
                      .alias("timestamp"))


@register("event_codes")
def q_event_codes(spark, sf_dir):
    return P.event_codes(canonical_events(spark, sf_dir, "user")).select(
        "event_id", "event", "event_code")


@register("fill_tx")
def q_fill_tx(spark, sf_dir):
    raw = raw_events(spark, sf_dir, "user")
    return raw.select("event_id", fill_missing_id("transactionid").alias("transactionid"))


@register("downcast")
def q_downcast(spark, sf_dir):
    feats = V.visitor_features(canonical_events(spark, sf_dir, "user_day"))
    return P.downcast_table(feats)


@register("csv_tables")
def q_csv_tables(spark, sf_dir):
    """The events as the shop exports them (headered CSV), loaded back by name."""
    from sessionary.sources.tables import load_tables
    raw = raw_events(spark, sf_dir, "user")
    path = _scratch(spark, "export") + "/events.csv"
    (raw.select("timestamp", "visitorid", "event", "itemid", "transactionid")
     .write.option("header", True).csv(path))
    events = load_tables(spark, {"events": path}, register=False)["events"]
    return events.select(ntz("timestamp"), "visitorid", "event", "itemid", "transactionid")


# ------------------------------------------------------------ row columns V1-V8

@register("hour_range")
def q_hour_range(spark, sf_dir):
    return _enh(spark, sf_dir).select("event_id", "hour_range")


@register("week_day")
def q_week_day(spark, sf_dir):
    return _enh(spark, sf_dir).select("event_id", "week_day")


@register("delta_same_event")
def q_delta_same_event(spark, sf_dir):
    return rounded(_enh(spark, sf_dir).select("event_id", "deltat_2equal_events"))


@register("views_per_minute")
def q_views_per_minute(spark, sf_dir):
    """V4 per event: views of the visitor in the event's calendar minute."""
    enh = _enh(spark, sf_dir)
    w = Window.partitionBy("visitorid", "minute")
    return enh.select("event_id", F.count_if(F.col("event") == "view").over(w)
                      .alias("views_per_minute"))


@register("views_per_hour")
def q_views_per_hour(spark, sf_dir):
    return V.views_per_bucket(_enh(spark, sf_dir), "hour")


@register("rep_flags")
def q_rep_flags(spark, sf_dir):
    return _enh(spark, sf_dir).select("event_id", "repitem", "repitem_fview", "repitem_bview")


@register("funnel_flag")
def q_funnel_flag(spark, sf_dir):
    return _enh(spark, sf_dir).select("event_id", "funnel_flag")


# ------------------------------------------------------------ aggregates V9-V20

@register("session_counts")
def q_session_counts(spark, sf_dir):
    return V.session_counts(_enh(spark, sf_dir))


@register("session_stats")
def q_session_stats(spark, sf_dir):
    return rounded(V.session_stats(_enh(spark, sf_dir)))


@register("hour_counts")
def q_hour_counts(spark, sf_dir):
    return _enh(spark, sf_dir).groupBy("visitorid").agg(*V.hour_count_aggs())


@register("weekday_counts")
def q_weekday_counts(spark, sf_dir):
    return _enh(spark, sf_dir).groupBy("visitorid").agg(*V.weekday_count_aggs())


@register("rep_counts")
def q_rep_counts(spark, sf_dir):
    return _enh(spark, sf_dir).groupBy("visitorid").agg(*V.rep_count_aggs())


@register("max_vpmin")
def q_max_vpmin(spark, sf_dir):
    return V.visitor_features(canonical_events(spark, sf_dir, "user")).select(
        "visitorid", "max_vpmin")


@register("delta_stats")
def q_delta_stats(spark, sf_dir):
    return rounded(_enh(spark, sf_dir).groupBy("visitorid").agg(*V.delta_stat_aggs()))


@register("session_join")
def q_session_join(spark, sf_dir):
    """The feature table joined with the session statistics, no filter."""
    ev = canonical_events(spark, sf_dir, "user_day")
    return rounded(V.visitor_features(ev, drop_bouncers=False))


@register("drop_bouncers")
def q_drop_bouncers(spark, sf_dir):
    ev = canonical_events(spark, sf_dir, "user_day")
    return V.visitor_features(ev).select("visitorid", "num_views", "num_acart", "num_txs")


# ------------------------------------------------------------ ratings R1-R5

def _ratings_input(spark, sf_dir):
    ev = canonical_events(spark, sf_dir, "user_day")
    return ev, V.visitor_features(ev)


@register("ratings_semi")
def q_ratings_semi(spark, sf_dir):
    ev, feats = _ratings_input(spark, sf_dir)
    return R.eligible_events(ev, feats).select(
        ntz("timestamp"), "visitorid", "event", "itemid")


@register("dedup_latest")
def q_dedup_latest(spark, sf_dir):
    ev, feats = _ratings_input(spark, sf_dir)
    return R.latest_per_event(R.eligible_events(ev, feats)).select(
        "visitorid", "event", "itemid", ntz("timestamp"))


@register("rating_map")
def q_rating_map(spark, sf_dir):
    ev = canonical_events(spark, sf_dir, "user_day")
    return R.with_rating(ev).select("event_id", "event", "rating")


@register("ratings")
def q_ratings(spark, sf_dir):
    ev, feats = _ratings_input(spark, sf_dir)
    return R.ratings(ev, feats).select("visitorid", "itemid", "rating", ntz("timestamp"))


@register("ratings_multi")
def q_ratings_multi(spark, sf_dir):
    ev, feats = _ratings_input(spark, sf_dir)
    return R.visitors_with_many_ratings(R.ratings(ev, feats))


# ------------------------------------------------------------ profiling F1-F7

from sessionary.operators import profile as PR  # noqa: E402
from sessionary.operators import stats as ST  # noqa: E402


def _features(spark, sf_dir, mapping="user_day"):
    """The feature table, computed once (the profile operators read it often)."""
    from sessionary.session import materialize
    return materialize(V.visitor_features(canonical_events(spark, sf_dir, mapping)))


@register("profile_min")
def q_profile_min(spark, sf_dir):
    return PR.min_profile(_features(spark, sf_dir))


@register("profile_summary")
def q_profile_summary(spark, sf_dir):
    return rounded(PR.summary_without_min(_features(spark, sf_dir)))


@register("corr_matrix")
def q_corr_matrix(spark, sf_dir):
    return rounded(PR.correlation_long(_features(spark, sf_dir)))


@register("corr_counts")
def q_corr_counts(spark, sf_dir):
    return PR.correlated_counts(_features(spark, sf_dir))


@register("feature_selection")
def q_feature_selection(spark, sf_dir):
    return PR.feature_selection_table(_features(spark, sf_dir))


@register("norm_zscore")
def q_norm_zscore(spark, sf_dir):
    return rounded(PR.normalize(_features(spark, sf_dir), "z_score", keep=("visitorid",)))


@register("norm_minmax")
def q_norm_minmax(spark, sf_dir):
    return rounded(PR.normalize(_features(spark, sf_dir), "min_max", keep=("visitorid",)))


# ------------------------------------------------------------ result stats A1-A3
# lineitem price by return flag stands in for score by anomaly label

LINE_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _lineitem(spark, sf_dir):
    from sessionary.sources.tables import read_table
    return read_table(spark, sf_dir, "lineitem")


@register("describe_by_label")
def q_describe_by_label(spark, sf_dir):
    return ST.describe_by(_lineitem(spark, sf_dir), "l_returnflag", "l_extendedprice")


@register("feature_stats_by_label")
def q_feature_stats_by_label(spark, sf_dir):
    return ST.stats_by_label(_lineitem(spark, sf_dir), "l_returnflag", LINE_FEATURES,
                             ["A", "N", "R"])


@register("kde_all")
def q_kde_all(spark, sf_dir):
    return rounded(ST.density_curves(_lineitem(spark, sf_dir), "l_extendedprice"), 9)


@register("kde_group")
def q_kde_group(spark, sf_dir):
    return rounded(ST.density_curves(_lineitem(spark, sf_dir), "l_extendedprice",
                                     "l_returnflag"), 9)


# ------------------------------------------------------------ samples / neighbours

from sessionary.operators import neighbors as N  # noqa: E402
from sessionary.operators import sampling as SM  # noqa: E402
from sessionary.sources.tables import read_table as _read  # noqa: E402

SPLITS, SAMPLE = 3, 0.2


@register("sample_stratified")
def q_sample_stratified(spark, sf_dir):
    lab = _read(spark, sf_dir, "labels")
    return SM.stratified_samples(lab, "toxic", "doc_id", SPLITS, SAMPLE)


@register("sample_stratified_counts")
def q_sample_stratified_counts(spark, sf_dir):
    lab = _read(spark, sf_dir, "labels")
    s = SM.stratified_samples(lab, "toxic", "doc_id", SPLITS, SAMPLE, drop_label=False)
    return s.groupBy("split", "toxic").agg(F.count(F.lit(1)).alias("n"))


@register("sample_random")
def q_sample_random(spark, sf_dir):
    lab = _read(spark, sf_dir, "labels")
    return SM.random_samples(lab, "doc_id", SPLITS, SAMPLE, drop_last="toxic")


@register("sample_random_count")
def q_sample_random_count(spark, sf_dir):
    lab = _read(spark, sf_dir, "labels")
    s = SM.random_samples(lab, "doc_id", SPLITS, SAMPLE, drop_last="toxic")
    return s.groupBy("split").agg(F.count(F.lit(1)).alias("n"),
                                  F.count_distinct("doc_id").alias("distinct_docs"))


def _embedding_points(spark, sf_dir):
    return N.vectors(_read(spark, sf_dir, "embeddings"), "vec_id", "embedding")


@register("k_distance")
def q_k_distance(spark, sf_dir):
    pts = _embedding_points(spark, sf_dir)
    return rounded(N.k_distance_curve(pts, tail=None))


@register("k_distance_tail")
def q_k_distance_tail(spark, sf_dir):
    pts = _embedding_points(spark, sf_dir)
    return rounded(N.k_distance_curve(pts, tail=20))


@register("silhouette")
def q_silhouette(spark, sf_dir):
    emb = _read(spark, sf_dir, "embeddings")
    pts = N.vectors(emb, "vec_id", "embedding").join(
        emb.select(F.col("vec_id").alias("id"), "label"), "id")
    return rounded(N.silhouette_score(pts, noise_label=-1))


# ------------------------------------------------------------ forest M2-M4, M14, E1-E7, S5

from sessionary.operators import explain as EX  # noqa: E402
from sessionary.operators import iforest as IF  # noqa: E402

FOREST_TREES = 100   # the configured forest


def _forest(spark, sf_dir, trees=FOREST_TREES):
    feats = _features(spark, sf_dir)
    sel = PR.feature_selection(feats)
    model = IF.fit(feats, sel, n_estimators=trees, random_state=42)
    return feats, sel, model


@register("iforest_nodes")
def q_iforest_nodes(spark, sf_dir):
    _, _, model = _forest(spark, sf_dir)
    return rounded(model.nodes)


@register("iforest_score")
def q_iforest_score(spark, sf_dir):
    feats, _, model = _forest(spark, sf_dir)
    return rounded(model.transform(feats, keep=["visitorid"]).select(
        "visitorid", "path_length", "score_samples", "anomaly_score"))


@register("iforest_label")
def q_iforest_label(spark, sf_dir):
    feats, _, model = _forest(spark, sf_dir)
    return model.transform(feats, keep=["visitorid"]).select("visitorid", "anomaly_label")


@register("label_correction")
def q_label_correction(spark, sf_dir):
    """M14 on a rule label (-1 when the visitor has more events than views*2)."""
    feats = V.visitor_features(canonical_events(spark, sf_dir, "user_day"))
    lab = feats.select("visitorid", "num_txs",
                       F.when(F.col("num_evnts") > 2 * F.col("num_views"), -1).otherwise(1)
                       .alias("anomaly_label"))
    return IF.correct_labels(lab).select("visitorid", "anomaly_label")


@register("split_importance")
def q_split_importance(spark, sf_dir):
    _, _, model = _forest(spark, sf_dir)
    return rounded(IF.split_importance(model, spark))


@register("tree_nodes")
def q_tree_nodes(spark, sf_dir):
    _, _, model = _forest(spark, sf_dir)
    return rounded(IF.tree_rules(model, spark, 0))


@register("forest_roundtrip")
def q_forest_roundtrip(spark, sf_dir):
    """Save the forest, load it back, score with the loaded copy."""
    import os
    import uuid
    from sessionary.session import checkpoint_dir
    feats, _, model = _forest(spark, sf_dir)
    path = os.path.join(checkpoint_dir(spark), f"forest-{uuid.uuid4().hex}")
    model.save(spark, path)
    loaded = IF.IsolationForestModel.load(spark, path)
    return rounded(loaded.transform(feats, keep=["visitorid"]).select("visitorid", "anomaly_score"))


def _shap(spark, sf_dir):
    """Features, explainer and the SHAP table, written once (several queries read it twice)."""
    from sessionary.session import materialize
    feats, sel, model = _forest(spark, sf_dir)
    ex = EX.ForestExplainer(model)
    return feats, ex, materialize(ex.shap_values(feats))


@register("shap_values")
def q_shap_values(spark, sf_dir):
    return _shap(spark, sf_dir)[2]


@register("shap_long")
def q_shap_long(spark, sf_dir):
    """E3 with a row per visitor and feature."""
    _, ex, sv = _shap(spark, sf_dir)
    return rounded(sv.select("visitorid", "base_value", *[F.col(f"shap_{f}").alias(f) for f in ex.features])
                   .unpivot(["visitorid", "base_value"], ex.features, "feature", "shap_value"))


@register("shap_importance")
def q_shap_importance(spark, sf_dir):
    _, ex, sv = _shap(spark, sf_dir)
    return rounded(ex.importance(sv))


@register("shap_top20")
def q_shap_top20(spark, sf_dir):
    _, ex, sv = _shap(spark, sf_dir)
    return rounded(ex.top(sv, 20))


@register("shap_dependence")
def q_shap_dependence(spark, sf_dir):
    feats, ex, sv = _shap(spark, sf_dir)
    return rounded(ex.dependence(feats, sv, ex.features[0]))


@register("shap_instance")
def q_shap_instance(spark, sf_dir):
    feats, _, model = _forest(spark, sf_dir)
    first = feats.agg(F.min("visitorid")).first()[0]
    return rounded(EX.ForestExplainer(model).instance(feats, first))


@register("feature_stats_by_anomaly")
def q_feature_stats_by_anomaly(spark, sf_dir):
    """A2 on the forest: top-10 split features by anomaly label."""
    feats, _, model = _forest(spark, sf_dir)
    scored = model.transform(feats)
    top10 = [r["feature"] for r in IF.split_importance(model, spark).limit(10).collect()]
    return ST.stats_by_label(scored, "anomaly_label", top10, [-1, 1])


@register("describe_by_anomaly")
def q_describe_by_anomaly(spark, sf_dir):
    """A1 on the forest: anomaly score described per label."""
    feats, _, model = _forest(spark, sf_dir)
    return ST.describe_by(model.transform(feats, keep=["visitorid"]), "anomaly_label",
                          "anomaly_score")


@register("kde_anomaly")
def q_kde_anomaly(spark, sf_dir):
    feats, _, model = _forest(spark, sf_dir)
    return rounded(ST.density_curves(model.transform(feats, keep=["visitorid"]),
                                     "anomaly_score", "anomaly_label"), 9)


# ------------------------------------------------------------ density clustering M11

from sessionary.operators import density as DN  # noqa: E402

DBSCAN_EPS, DBSCAN_MIN_SAMPLES = 1.2, 38   # the configured DBSCAN parameters
DBSCAN_WIDE_EPS, DBSCAN_FEW_SAMPLES = 1.15, 5   # a setting that finds clusters


@register("dbscan_core")
def q_dbscan_core(spark, sf_dir):
    pts = _embedding_points(spark, sf_dir)
    counts = DN.neighbour_counts(pts, DBSCAN_EPS)
    return counts.select("id", "n_neighbors",
                         (F.col("n_neighbors") >= DBSCAN_MIN_SAMPLES).alias("core"))


@register("dbscan_clusters")
def q_dbscan_clusters(spark, sf_dir):
    """M11 with a setting that finds several clusters, border points and noise."""
    pts = _embedding_points(spark, sf_dir)
    return DN.dbscan(pts, DBSCAN_WIDE_EPS, DBSCAN_FEW_SAMPLES)


@register("dbscan")
def q_dbscan(spark, sf_dir):
    return DN.dbscan(_embedding_points(spark, sf_dir), DBSCAN_EPS, DBSCAN_MIN_SAMPLES)


# ------------------------------------------------------------ sinks / runs S3, S4, M13

from sessionary.sources import sinks as SK  # noqa: E402

GRID = {  # the evaluation grid of the forest notebook configuration
    "n_estimators": [10, 50], "max_samples": ["auto"], "contamination": ["auto"],
    "max_features": [1.0], "bootstrap": [False], "random_state": [42],
}


def _scratch(spark, name):
    import os
    import uuid
    from sessionary.session import checkpoint_dir
    return os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")


@register("artifact_roundtrip")
def q_artifact_roundtrip(spark, sf_dir):
    """S3: event counts written as a run artifact and read back."""
    enh = _enh(spark, sf_dir)
    counts = enh.groupBy("visitorid").agg(*V.event_count_aggs())
    base = _scratch(spark, "artifacts")
    path = SK.write_artifact(counts, base, "run0", "stats", "event_counts")
    return SK.read_artifact(spark, path, "run0").select(*counts.columns)


def _forest_artifacts(spark, model, feats, base, run):
    """S3 of one forest run: scored table, score description, both importances,
    top-10 feature statistics and the model; returns the scored table as read back.
    The number of rows read back from each is logged as a metric by the caller."""
    path = SK.write_artifact(model.transform(feats), base, run, "scores", "scored")
    scored = SK.read_artifact(spark, path, run)
    split = IF.split_importance(model, spark)
    shap = EX.ForestExplainer(model)
    top10 = [r["feature"] for r in split.limit(10).collect()]
    for folder, name, table in (
            ("scores", "describe", ST.describe_by(scored, "anomaly_label", "anomaly_score")),
            ("importance", "splits", split),
            ("importance", "shap", shap.importance(shap.shap_values(feats))),
            ("stats", "top_features", ST.stats_by_label(scored, "anomaly_label", top10, [-1, 1]))):
        SK.write_artifact(table, base, run, folder, name)
    model.save(spark, f"{base}/models/{run}")
    return scored


ARTIFACTS = (("scores", "scored"), ("scores", "describe"), ("importance", "splits"),
             ("importance", "shap"), ("stats", "top_features"))


def _artifact_rows(spark, base, run):
    """(key, value): rows of each artifact of a run and of its model, read back."""
    from functools import reduce
    parts = [SK.read_artifact(spark, f"{base}/{folder}/{name}", run).agg(
        F.lit(f"rows_{folder}_{name}").alias("key"), F.count(F.lit(1)).cast("double").alias("value"))
        for folder, name in ARTIFACTS]
    model = IF.IsolationForestModel.load(spark, f"{base}/models/{run}")
    parts.append(model.nodes.agg(F.lit("trees_of_model").alias("key"),
                                 F.count_distinct("tree_id").cast("double").alias("value")))
    return reduce(DataFrame.unionByName, parts)


@register("grid_runs")
def q_grid_runs(spark, sf_dir):
    """M13 + S4: fit the forest for every grid point, log params, metrics and artifacts."""
    from sessionary.operators.detection import AnomalyDetection
    feats = _features(spark, sf_dir)
    sel = PR.feature_selection(feats)
    base = _scratch(spark, "runs")
    log = SK.RunLog(spark, base, "anomaly_detection")
    parent = log.run_id("grid", GRID)
    grid = SK.param_grid(GRID)
    for params, prepared in zip(grid, IF.shared_samples(feats, sel, grid)):
        run = log.run_id("isolation_forest", params)
        det = AnomalyDetection("isolation_forest", **params).fit(feats, sel, **prepared)
        scored = _forest_artifacts(spark, det.model, feats, base, run)
        log.log_params(run, "isolation_forest", params, parent)
        log.log_config(run, {"features": sel, **params})
        log.log_metrics_df(run, scored.agg(
            F.avg((F.col("anomaly_label") == -1).cast("double")).alias("anomaly_share"),
            F.avg("anomaly_score").alias("mean_score"))
            .unpivot([], ["anomaly_share", "mean_score"], "key", "value"), "scores")
        log.log_metrics_df(run, _artifact_rows(spark, base, run), "artifacts")
        log.finish(run)
    runs = log.table("runs").where(F.col("param") == "n_estimators") \
        .select("run_id", F.col("value").alias("n_estimators"))
    return rounded(log.table("metrics").join(runs, "run_id").select("n_estimators", "key", "value"))


@register("run_log")
def q_run_log(spark, sf_dir):
    """Runs over the events, one of them repeated, one never finished: each row once."""
    ev = canonical_events(spark, sf_dir, "user").where(F.col("visitorid").isNotNull())
    log = SK.RunLog(spark, _scratch(spark, "runs"), "event_types")
    for kind, finished in (("view", True), ("addtocart", True), ("view", True), ("transaction", False)):
        params = {"event": kind}
        run = log.run_id("count", params)
        log.log_params(run, "count", params)
        own = ev.where(F.col("event") == kind)
        log.log_metrics_df(run, own.agg(F.count("*").cast("double").alias("events"),
                                        F.count_distinct("visitorid").cast("double").alias("visitors"))
                           .unpivot([], ["events", "visitors"], "key", "value"))
        if finished:
            log.finish(run)
    runs = log.table("runs").select("run_id", "method", F.col("value").alias("event"))
    return log.table("metrics").join(runs, "run_id").select("method", "event", "key", "value")


@register("forest_signature")
def q_forest_signature(spark, sf_dir):
    """Inputs and outputs of a saved forest, as its metadata holds them."""
    _, _, model = _forest(spark, sf_dir, trees=1)
    path = _scratch(spark, "forest")
    model.save(spark, path)
    return IF.IsolationForestModel.load(spark, path).signature(spark)


# ------------------------------------------------------------ HDBSCAN M5-M10, M12

from sessionary.operators import hierarchy as HD  # noqa: E402

HDBSCAN_MIN_CLUSTER_SIZE, HDBSCAN_MIN_SAMPLES = 1000, 38   # first point of the grid


def _hdbscan(spark, sf_dir):
    """The notebook flow: features -> selection -> min-max scaling -> HDBSCAN."""
    feats = _features(spark, sf_dir)
    sel = PR.feature_selection(feats)
    from sessionary.session import materialize
    scaled = materialize(PR.normalize(feats, "min_max", sel, keep=("visitorid",))
                         .fillna(0.0, sel))
    model = HD.fit(scaled, sel, "visitorid", min_cluster_size=HDBSCAN_MIN_CLUSTER_SIZE,
                   min_samples=HDBSCAN_MIN_SAMPLES)
    return scaled, sel, model


@register("hdbscan_labels")
def q_hdbscan_labels(spark, sf_dir):
    _, _, model = _hdbscan(spark, sf_dir)
    return model.transform(model.ids, ["visitorid"]).select("visitorid", "anomaly_label")


@register("hdbscan_prob")
def q_hdbscan_prob(spark, sf_dir):
    _, _, model = _hdbscan(spark, sf_dir)
    return model.transform(model.ids, ["visitorid"]).select("visitorid", "probability")


@register("hdbscan_outlier")
def q_hdbscan_outlier(spark, sf_dir):
    _, _, model = _hdbscan(spark, sf_dir)
    return model.transform(model.ids, ["visitorid"]).select("visitorid", "outlier_score")


@register("hdbscan_condensed")
def q_hdbscan_condensed(spark, sf_dir):
    return _hdbscan(spark, sf_dir)[2].result.condensed


@register("single_linkage")
def q_single_linkage(spark, sf_dir):
    return _hdbscan(spark, sf_dir)[2].result.linkage


@register("hdbscan_persistence")
def q_hdbscan_persistence(spark, sf_dir):
    return _hdbscan(spark, sf_dir)[2].result.persistence


@register("hdbscan_silhouette")
def q_hdbscan_silhouette(spark, sf_dir):
    """Silhouette of the non-noise visitors, all of them."""
    from sessionary.session import materialize
    scaled, sel, model = _hdbscan(spark, sf_dir)
    pts = (model.ids.join(model.result.labels.select("id", "label").where(F.col("label") != -1), "id")
           .join(scaled, "visitorid")
           .select("id", F.array(*[F.col(c).cast("double") for c in sel]).alias("v"), "label"))
    return N.silhouette_score(materialize(pts), noise_label=-1)


# ------------------------------------------------------------ S2: SQL text over views

@register("visitor_features_sql")
def q_visitor_features_sql(spark, sf_dir):
    """The feature table from the SQL file, run by Spark SQL over a view of
    the sessionized events (S2)."""
    import os
    from sessionary.sources.tables import SQL_DIR, load_queries
    events = P.sessionize(canonical_events(spark, sf_dir, "user"))
    out = load_queries(spark, {"visitor": os.path.join(SQL_DIR, "visitor_features.sql")},
                       {"events": events})["visitor"]
    return rounded(out.select("visitorid", *V.FEATURE_COLUMNS))


HDBSCAN_GRID = {"min_cluster_size": [1000, 2000, 4000], "min_samples": [38]}


@register("grid_runs_hdbscan")
def q_grid_runs_hdbscan(spark, sf_dir):
    """M13 + S4 + M12 for HDBSCAN: each grid point fitted and logged with its
    silhouette; the quadratic part is shared by grid points with the same
    min_samples."""
    from sessionary.operators.detection import AnomalyDetection
    from sessionary.session import materialize
    feats = _features(spark, sf_dir)
    sel = PR.feature_selection(feats)
    scaled = materialize(PR.normalize(feats, "min_max", sel, keep=("visitorid",))
                         .fillna(0.0, sel))
    ids, pts = HD.points_of(scaled, sel, "visitorid")
    log = SK.RunLog(spark, _scratch(spark, "runs"), "anomaly_detection")
    parent = log.run_id("grid", HDBSCAN_GRID)
    prepared = {}
    for params in SK.param_grid(HDBSCAN_GRID):
        ms = params["min_samples"]
        if ms not in prepared:
            prepared[ms] = HD.mst_edges_for(pts, ms)
        run = log.run_id("hdbscan", params)
        det = AnomalyDetection("hdbscan", **params).fit(scaled, sel, prepared=prepared[ms], ids=ids)
        log.log_params(run, "hdbscan", params, parent)
        log.log_config(run, {"features": sel, **params})
        labels = det.model.result.labels
        vecs = materialize(  # read for its size, its sample and the silhouette
            ids.join(labels.select("id", "label"), "id").join(scaled, "visitorid")
            .select("id", F.array(*[F.col(c).cast("double") for c in sel]).alias("v"), "label"))
        sil = N.silhouette_score(vecs, noise_label=-1, sample_size=100_000)
        log.log_metrics_df(run, sil.select(F.lit("silhouette_score_sample").alias("key"),
                                           F.col("silhouette").alias("value")), "silhouette")
        log.log_metrics_df(run, labels.agg(
            F.count_if(F.col("label") >= 0).cast("double").alias("value"))
            .select(F.lit("clustered_points").alias("key"), "value"), "clustered")
        log.finish(run)
    runs = log.table("runs").where(F.col("param") == "min_cluster_size") \
        .select("run_id", F.col("value").alias("min_cluster_size"))
    return log.table("metrics").join(runs, "run_id").select("min_cluster_size", "key", "value")


@register("silhouette_sq")
def q_silhouette_sq(spark, sf_dir):
    """M12, linear-cost variant: squared-Euclidean silhouette (Spark ML)."""
    emb = _read(spark, sf_dir, "embeddings")
    pts = N.vectors(emb, "vec_id", "embedding").join(
        emb.select(F.col("vec_id").alias("id"), "label"), "id")
    return rounded(N.silhouette_score(pts, noise_label=-1, distance="squaredEuclidean"))


# ------------------------------------------------- sequences over many partitions

SMALL_PARTS = 200   # scan partitions of a few visitors (or a part of one) each


@register("visitor_features_hot")
def q_visitor_features_hot(spark, sf_dir):
    """V21 with visitors spread over partitions: carry records matter everywhere."""
    ev = canonical_events(spark, sf_dir, "user")
    return rounded(V.visitor_features(ev, parts=SMALL_PARTS))


@register("sessionize_hot")
def q_sessionize_hot(spark, sf_dir):
    """P3 with visitors spread over partitions."""
    ev = canonical_events(spark, sf_dir, "user")
    return P.sessionize(ev, parts=SMALL_PARTS).select("event_id", "visitorid", "session_id")
