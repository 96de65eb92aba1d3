"""Property tests for sampling, neighbours, density clustering, forest, SHAP."""
import itertools
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sessionary.operators import density as DN
from sessionary.operators import explain as EX
from sessionary.operators import iforest as IF
from sessionary.operators import neighbors as N
from sessionary.operators import sampling as SM
from sessionary.operators.quantiles import quantile_columns


def _points(spark, X, labels=None):
    pdf = pd.DataFrame({"id": np.arange(len(X)), "v": [list(map(float, r)) for r in X]})
    schema = "id long, v array<double>"
    if labels is not None:
        pdf["label"] = labels
        schema += ", label int"
    return spark.createDataFrame(pdf, schema)


@pytest.fixture(scope="module")
def blobs():
    rng = np.random.default_rng(3)
    X = np.vstack([rng.normal(0, 0.3, (80, 4)), rng.normal(3, 0.3, (70, 4)),
                   rng.uniform(-6, 6, (12, 4))])
    lab = np.array([0] * 80 + [1] * 70 + [2] * 12)
    return X, lab


def test_knn_matches_brute_force(spark, blobs):
    X, _ = blobs
    k = 7
    got = N.k_distances(_points(spark, X), k, block_rows=40).orderBy("id").toPandas()
    d2 = ((X[:, None] - X[None]) ** 2).sum(-1)
    exp = np.sort(d2, axis=1)[:, k - 1]
    assert np.allclose(got["distance_sq"].to_numpy(), exp)


def _far_blobs(n, seed=2, dims=3):
    rng = np.random.default_rng(seed)
    centres = rng.uniform(-60, 60, size=(12, dims))
    return centres[rng.integers(0, 12, n)] + rng.normal(0, 1, size=(n, dims))


@pytest.mark.parametrize("k", [3, 40])
def test_knn_in_pivot_cells_equals_brute_force(spark, k):
    """Cells of very different sizes, some with fewer than k points, some over several blocks."""
    X = np.vstack([_far_blobs(260), np.full((60, 3), 5.0), [[500.0, 0, 0], [-900.0, 3, 1]]])
    got = N.knn_distances(_points(spark, X), k, block_rows=24, cell_rows=30)
    d = np.sort(((X[:, None] - X[None]) ** 2).sum(-1), axis=1)[:, :k]
    rows = {r["id"]: r["d"] for r in got.collect()}
    assert len(rows) == len(X)
    assert all(np.allclose(rows[i], d[i], atol=1e-7) for i in range(len(X)))


def test_knn_replication_grows_slower_than_the_cells(spark):
    factor = {}
    for n, cells in ((500, 20), (2000, 80)):
        X = np.random.default_rng(n).uniform(0, 1, size=(n, 2))
        r = N.knn_replication(_points(spark, X), 5, cell_rows=25).first()
        assert r["cells"] == cells
        factor[cells] = r["factor"]
    assert factor[80] < 2 * factor[20] and factor[80] < 80 / 5  # four times the cells


def test_grid_tiles_hold_each_near_pair_once(spark):
    from sessionary.operators.cells import dealt_grid, grid_rows
    X = np.vstack([np.random.default_rng(4).uniform(0, 9, size=(250, 4)), np.full((60, 4), 1.0),
                   np.arange(8)[:, None] * np.ones(4)])
    pts = _points(spark, X)
    met = {}
    dealt = dealt_grid(pts, 1.0, 16).toPandas()
    for _, own in dealt.assign(cell=dealt["cell"].map(tuple)).groupby(["cell", "first", "second"]):
        assert len(own) <= 60
        left, right = own[~own["late"]]["id"], own[own["late"]]["id"]
        whole = own["first"].iat[0] == own["second"].iat[0]
        for a in left:
            for b in (x for x in left if x > a) if whole else right:
                pair = (min(a, b), max(a, b))
                met[pair] = met.get(pair, 0) + 1
    d = np.sqrt(((X[:, None] - X[None]) ** 2).sum(-1))
    near = {(i, j) for i, j in zip(*np.nonzero(d <= 1.0)) if i < j}
    assert all(met.get(p) == 1 for p in near)
    sent = grid_rows(pts, 1.0).count() / len(X)
    assert sent < 5  # of the 14 cells


@pytest.mark.parametrize("eps", [0.5, 2.5, 40.0])
def test_dbscan_over_grid_cells(spark, eps):
    X = np.vstack([_far_blobs(150, seed=5), np.full((50, 3), 2.0), np.arange(6)[:, None] * [0.5, 0, 0]])
    got = DN.dbscan(_points(spark, X), eps=eps, min_samples=4, block_rows=20).orderBy("id").toPandas()
    assert (got["label"].to_numpy() == _brute_dbscan(X, eps, 4)).all()


def test_k_distance_curve_sorted_and_tail(spark, blobs):
    X, _ = blobs
    pts = _points(spark, X)
    full = N.k_distance_curve(pts, k=5, tail=None, block_rows=50).orderBy("rank").toPandas()
    assert list(full["rank"]) == list(range(1, len(X) + 1))
    assert (np.diff(full["distance_sq"]) >= 0).all()
    tail = N.k_distance_curve(pts, k=5, tail=20, block_rows=50).orderBy("rank").toPandas()
    assert np.allclose(tail["distance_sq"], full["distance_sq"].iloc[-20:])
    assert list(tail["rank"]) == list(range(len(X) - 19, len(X) + 1))


def test_silhouette_matches_numpy(spark, blobs):
    X, lab = blobs
    got = N.silhouette_score(_points(spark, X, lab), noise_label=2,
                             block_rows=30).first()
    keep = lab != 2
    Y, L = X[keep], lab[keep]
    d = np.sqrt(((Y[:, None] - Y[None]) ** 2).sum(-1))
    s = []
    for i in range(len(Y)):
        same = (L == L[i]); same[i] = False
        a = d[i, same].mean()
        b = min(d[i, L == o].mean() for o in set(L) if o != L[i])
        s.append((b - a) / max(a, b))
    assert got["n"] == keep.sum()
    assert math.isclose(got["silhouette"], float(np.mean(s)), rel_tol=1e-9)
    assert -1 <= got["silhouette"] <= 1


def _brute_dbscan(X, eps, ms):
    d = np.sqrt(((X[:, None] - X[None]) ** 2).sum(-1)); nbr = d <= eps
    core = nbr.sum(1) >= ms; lab = np.full(len(X), -1); c = 0
    for i in range(len(X)):
        if lab[i] != -1 or not core[i]:
            continue
        lab[i] = c; stack = [i]
        while stack:
            p = stack.pop()
            for q in np.flatnonzero(nbr[p]):
                if lab[q] == -1:
                    lab[q] = c
                    if core[q]:
                        stack.append(q)
        c += 1
    return lab


def test_dbscan_matches_brute_force(spark, blobs):
    X, _ = blobs
    got = DN.dbscan(_points(spark, X), eps=0.8, min_samples=8, block_rows=30) \
        .orderBy("id").toPandas()
    assert (got["label"].to_numpy() == _brute_dbscan(X, 0.8, 8)).all()


def test_stratified_samples_exact_and_disjoint_from_order(spark):
    pdf = pd.DataFrame({"key": np.arange(1000), "x": np.arange(1000) % 7,
                        "label": (np.arange(1000) % 10 == 0).astype(int)})
    df = spark.createDataFrame(pdf)
    s = SM.stratified_samples(df, "label", "key", 3, 0.2, drop_label=False).toPandas()
    counts = s.groupby(["split", "label"]).size().unstack()
    assert (counts[0] == 180).all() and (counts[1] == 20).all()
    # reproducible on another partitioning
    s2 = SM.stratified_samples(df.repartition(7), "label", "key", 3, 0.2,
                               drop_label=False).toPandas()
    assert sorted(map(tuple, s[["split", "key"]].values)) == \
        sorted(map(tuple, s2[["split", "key"]].values))
    r = SM.random_samples(df, "key", 2, 0.1).toPandas()
    assert (r.groupby("split").size() == 100).all()
    assert r.groupby("split")["key"].nunique().eq(100).all()


def test_bottom_k_sketch_path(spark):
    df = spark.range(20000).withColumnRenamed("id", "key").withColumn("g", F.col("key") % 3)
    h, u = SM.uniform_hash("key", seed=1)
    rows = df.withColumn(SM.H, h).withColumn(SM.U, u)
    tg = spark.createDataFrame([(g, 50, int(20000 / 3) + (1 if g < 20000 % 3 else 0))
                                for g in range(3)], "g long, _k long, _n long")
    got = SM.bottom_k(rows, ["g"], tg, ["key"]).toPandas()
    full = rows.toPandas().sort_values(["g", SM.U, SM.H, "key"]).groupby("g").head(50)
    assert sorted(got["key"]) == sorted(full["key"])


def test_exact_quantiles_both_paths(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"g": rng.integers(0, 3, 30000), "v": rng.normal(size=30000).round(2)})
    df = spark.createDataFrame(pdf)
    exp = pdf.groupby("g")["v"].quantile([.25, .5, .75]).unstack().to_numpy()
    for parts in (2, 9):
        got = quantile_columns(df, ["g"], "v", {"a": .25, "b": .5, "c": .75}, parts) \
            .orderBy("g").toPandas()[["a", "b", "c"]].to_numpy()
        assert np.allclose(got, exp)


@pytest.fixture(scope="module")
def forest(spark):
    rng = np.random.default_rng(5)
    X = rng.normal(size=(600, 3))
    X[:5] += 8.0                                   # planted outliers
    pdf = pd.DataFrame(X, columns=["a", "b", "c"])
    pdf["visitorid"] = np.arange(600)
    df = spark.createDataFrame(pdf)
    return df, IF.fit(df, ["a", "b", "c"], n_estimators=30, random_state=42)


def test_forest_scores_and_planted_outliers(spark, forest):
    df, model = forest
    s = model.transform(df, keep=["visitorid"]).orderBy("visitorid").toPandas()
    assert s["score_samples"].between(-1, 0).all()
    assert s["anomaly_score"].between(-0.5, 0.5).all()
    lowest = set(s.nsmallest(5, "anomaly_score")["visitorid"])
    assert lowest == {0, 1, 2, 3, 4}
    assert (s.loc[s.visitorid < 5, "anomaly_label"] == -1).all()
    rows = model.node_rows()
    sizes = rows[rows["depth"] == 0]["n"]
    assert (sizes == 256).all()


def test_forest_independent_of_partitioning(spark, forest):
    df, model = forest
    again = IF.fit(df.repartition(5), ["a", "b", "c"], n_estimators=30, random_state=42)
    pd.testing.assert_frame_equal(model.node_rows(), again.node_rows())


def test_forest_of_large_nodes_and_joined_scoring(spark, forest, monkeypatch):
    """Level-wise splits grow the same forest as whole groups, and joins score it alike."""
    df, _ = forest
    rows = df.withColumn("c", F.lit(1.0)).withColumn("d", F.col("a").cast("int").cast("double"))
    whole, level = (IF.fit(rows, ["a", "b", "c", "d"], n_estimators=6, max_samples=1.0, group_rows=size)
                    for size in (10_000, 40))
    pd.testing.assert_frame_equal(whole.node_rows(), level.node_rows())
    assert (whole.node_rows().query("depth == 0")["n"] == 600).all()
    part = IF.fit(rows, ["a", "b", "c", "d"], n_estimators=6, max_samples=1.0, max_features=0.5,
                  group_rows=100)
    pd.testing.assert_frame_equal(part.node_rows(), IF.fit(
        rows, ["a", "b", "c", "d"], n_estimators=6, max_samples=1.0, max_features=0.5).node_rows())
    shipped = whole.transform(rows, keep=["visitorid"]).orderBy("visitorid").toPandas()
    monkeypatch.setattr(IF, "SHIPPED_NODES", 10)
    assert not level.shipped()
    joined = level.transform(rows, keep=["visitorid"]).orderBy("visitorid").toPandas()
    pd.testing.assert_frame_equal(shipped, joined)


def test_forest_of_equal_rows(spark):
    df = spark.createDataFrame([(k, 1.0, 2.0) for k in range(90)], "visitorid long, a double, b double")
    for size in (1_000, 10):
        rows = IF.fit(df, ["a", "b"], n_estimators=2, max_samples=1.0, group_rows=size).node_rows()
        assert rows[["node_id", "n"]].values.tolist() == [[1, 90], [1, 90]]


def test_forest_roundtrip_and_importance(spark, forest, tmp_path):
    df, model = forest
    model.save(spark, str(tmp_path / "f"))
    loaded = IF.IsolationForestModel.load(spark, str(tmp_path / "f"))
    a = model.transform(df, keep=["visitorid"]).orderBy("visitorid").toPandas()
    b = loaded.transform(df, keep=["visitorid"]).orderBy("visitorid").toPandas()
    assert np.allclose(a["anomaly_score"], b["anomaly_score"])
    imp = IF.split_importance(model, spark).toPandas()
    assert math.isclose(imp["weight"].sum(), 1.0)
    assert (np.diff(imp["weight"]) <= 0).all()


def test_forest_signature_is_enforced(spark, forest, tmp_path):
    df, model = forest
    assert model.input_types == {"a": "double", "b": "double", "c": "double"}
    model.save(spark, str(tmp_path / "s"))
    loaded = IF.IsolationForestModel.load(spark, str(tmp_path / "s"))
    with pytest.raises(ValueError, match="b"):
        loaded.transform(df.withColumnRenamed("b", "other"))
    with pytest.raises(TypeError, match="decimal"):
        loaded.transform(df.withColumn("a", F.col("a").cast("decimal(30,10)")))
    with pytest.raises(TypeError, match="bigint"):
        loaded.transform(df.withColumn("a", F.col("a").cast("bigint")))
    narrow = df.withColumn("a", F.col("a").cast("int"))
    assert dict(loaded.transform(narrow).dtypes)["a"] == "double"
    assert loaded.signature(spark).where("direction = 'output'").count() == 4


def test_run_log_repeats_and_failures(spark, tmp_path):
    from sessionary.sources.sinks import RunLog
    log = RunLog(spark, str(tmp_path), "x")
    params = {"n": 10, "mode": "auto"}
    run = log.run_id("forest", params)
    assert run == RunLog(spark, "elsewhere", "x").run_id("forest", dict(reversed(params.items())))
    seen = []
    for value in (1.0, 2.0, 2.0):  # the last two attempts log the same
        log.log_params(run, "forest", params)
        log.log_metric(run, "score", value)
        log.log_metrics_df(run, spark.createDataFrame([("a", value)], "key string, value double"), "a")
        log.log_config(run, params)
        log.finish(run)
        seen.append({t: sorted(map(tuple, log.table(t).collect())) for t in ("runs", "metrics", "configs")})
    assert seen[1] == seen[2] and len(seen[2]["metrics"]) == 2 and len(seen[2]["runs"]) == 2
    assert {r["value"] for r in log.table("metrics").collect()} == {2.0}
    lost = log.new_run()
    log.log_metric(lost, "score", 9.0)  # never finished
    assert log.table("metrics").count() == 2 and log.table("metrics", finished=False).count() == 3


def test_label_correction(spark):
    df = spark.createDataFrame([(1, -1, 2), (2, -1, 0), (3, 1, 0)],
                               "visitorid long, anomaly_label int, num_txs long")
    out = IF.correct_labels(df).orderBy("visitorid").toPandas()
    assert list(out["anomaly_label"]) == [1, -1, 1]


def test_shap_local_accuracy_and_brute_force(spark, forest):
    df, model = forest
    ex = EX.ForestExplainer(model)
    sv = ex.shap_values(df).orderBy("visitorid").toPandas()
    h = model.transform(df, keep=["visitorid"]).orderBy("visitorid").toPandas()["path_length"]
    total = sv[[c for c in sv.columns if c.startswith("shap_")]].sum(1) + sv["base_value"]
    assert np.allclose(total, h)
    imp = ex.importance(ex.shap_values(df)).toPandas()
    assert (np.diff(imp["weight"]) <= 0).all() and len(imp) == 3


def test_detection_front_door(spark, forest):
    from sessionary.operators.detection import AnomalyDetection
    df, _ = forest
    with pytest.raises(ValueError):
        AnomalyDetection("nope")
    det = AnomalyDetection("Isolation_Forest", n_estimators=5).fit(df, ["a", "b", "c"])
    assert det.predict(df).count() == 600
    assert det.scoring(df).columns == ["visitorid", "anomaly_score"]


def test_normalize_rejects_unknown(spark):
    from sessionary.operators.profile import normalize
    df = spark.createDataFrame([(1, 2.0)], "visitorid long, x double")
    with pytest.raises(ValueError):
        normalize(df, "robust")


def test_corr_constant_and_perfect_pairs(spark):
    from sessionary.operators.profile import correlated_counts, correlation_long
    pdf = pd.DataFrame({"a": np.arange(10.0), "b": np.arange(10.0) * 2, "c": -np.arange(10.0),
                        "d": np.ones(10), "e": np.random.default_rng(0).normal(size=10)})
    df = spark.createDataFrame(pdf)
    r = correlation_long(df, list(pdf.columns)).toPandas().set_index(["feature_a", "feature_b"])
    assert math.isclose(r.loc[("a", "c"), "r"], -1.0)
    assert pd.isna(r.loc[("a", "d"), "r"])
    cnt = correlated_counts(df, list(pdf.columns)).toPandas().set_index("feature")
    # +1 pairs are not counted (r == 1.0), -1 pairs are
    assert cnt.loc["a", "correlated_count"] == 1 and cnt.loc["d", "correlated_count"] == 0


def test_silhouette_squared_euclidean_linear_variant(spark, blobs):
    X, lab = blobs
    got = N.silhouette_score(_points(spark, X, lab), noise_label=2,
                             distance="squaredEuclidean").first()
    keep = lab != 2
    Y, L = X[keep], lab[keep]
    d = ((Y[:, None] - Y[None]) ** 2).sum(-1)
    s = []
    for i in range(len(Y)):
        same = (L == L[i]); same[i] = False
        a = d[i, same].mean()
        b = min(d[i, L == o].mean() for o in set(L) if o != L[i])
        s.append((b - a) / max(a, b))
    assert got["n"] == keep.sum()
    assert math.isclose(got["silhouette"], float(np.mean(s)), rel_tol=1e-6)


def test_forest_bootstrap_samples(spark, forest):
    df, _ = forest
    s = IF.bootstrap_samples(df.select("visitorid", "a"), "visitorid", 4, 256, 600, 42).toPandas()
    assert (s.groupby("tree_id").size() == 256).all()
    assert s.duplicated(["tree_id", "visitorid"]).any()      # with replacement
    m = IF.fit(df, ["a", "b", "c"], n_estimators=10, bootstrap=True)
    rows = m.node_rows()
    assert (rows[rows["depth"] == 0]["n"] == 256).all()
    sc = m.transform(df, keep=["visitorid"]).toPandas()
    assert sc["anomaly_score"].between(-0.5, 0.5).all()


def test_samples_equal_brute_force_ranking(spark):
    from pyspark.sql import Window
    df = spark.range(3000).withColumnRenamed("id", "key") \
        .withColumn("label", (F.col("key") % 7 == 0).cast("int"))
    got = SM.random_samples(df, "key", 3, 0.1).select("split", "key").toPandas()
    rows = df.select("key", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("split"))
    key = lambda *parts: F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 15), 16, 10) \
        .cast("bigint")
    h = key((F.col("split") + 42).cast("string"), F.col("key").cast("string"))
    w = Window.partitionBy("split").orderBy(h, "key")
    exp = rows.withColumn("_r", F.row_number().over(w)).where("_r <= 300") \
        .select("split", "key").toPandas()
    assert sorted(map(tuple, got.values)) == sorted(map(tuple, exp.values))
    st = SM.stratified_samples(df, "label", "key", 2, 0.2, drop_label=False) \
        .select("split", "label", "key").toPandas()
    rows = df.select("key", "label", F.explode(F.sequence(F.lit(0), F.lit(1))).alias("split"))
    h2 = key(F.lit("42"), F.col("key").cast("string"), F.col("split").cast("string"))
    w2 = Window.partitionBy("split", "label").orderBy(h2, "key")
    ranked = rows.withColumn("_r", F.row_number().over(w2)).toPandas()
    quota = st.groupby(["split", "label"]).size().to_dict()
    exp2 = ranked[ranked.apply(lambda r: r["_r"] <= quota[(r["split"], r["label"])], axis=1)]
    assert sorted(map(tuple, st.values)) == \
        sorted(map(tuple, exp2[["split", "label", "key"]].values))


def _sent(monkeypatch, module, name, run):
    """Rows that each call of ``module.name`` hands to its tasks."""
    sent, whole = [], getattr(module, name)

    def counted(*args, **kw):
        out = whole(*args, **kw)
        sent.append(out.count())
        return out
    monkeypatch.setattr(module, name, counted)
    run()
    return sum(sent)


@pytest.mark.parametrize("what", ["knn", "silhouette", "dbscan"])
def test_rows_sent_to_tiles_grow_as_the_points(spark, monkeypatch, what):
    """In many dimensions without structure every point still goes to a fixed number of blocks."""
    rng = np.random.default_rng(4)
    sent = []
    for n in (400, 1_600):
        X = rng.normal(size=(n, 24))
        pts = _points(spark, X, np.arange(n) % 3)
        with monkeypatch.context() as m:
            sent.append({
                "knn": lambda: _sent(m, N, "block_pairs", lambda: N.knn_distances(
                    pts.select("id", "v"), 5, block_rows=20, cell_rows=20).collect()),
                "silhouette": lambda: _sent(m, N, "block_pairs", lambda: N.silhouette_score(
                    pts, block_rows=20).collect()),
                "dbscan": lambda: _sent(m, DN, "dealt_grid", lambda: DN.dbscan(
                    pts.select("id", "v"), eps=40.0, min_samples=4, block_rows=20).collect())}[what]())
    assert 0 < sent[1] <= 4.4 * sent[0]
