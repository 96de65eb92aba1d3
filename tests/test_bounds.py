"""No row is dropped, no size constant changes a result, no group grows with the data."""
import os
import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import ROOT, SF_SMALL, events_df

PLAIN = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false").getOrCreate())
import __spark_entry__ as entry
assert spark.conf.get("spark.sql.execution.arrow.pyspark.enabled") == "false"
for name in {names!r}:
    rows = entry.queries()[name](spark, {sf!r}).collect()
    print("RAN", name, len(rows))
"""

MODEL_QUERIES = ["iforest_nodes", "split_importance", "tree_nodes", "forest_roundtrip",
                 "feature_stats_by_anomaly", "shap_instance", "hdbscan_labels", "dbscan_clusters",
                 "sample_stratified", "profile_summary", "csv_tables"]


def test_model_queries_run_in_a_plain_session():
    code = PLAIN.format(root=ROOT, names=MODEL_QUERIES, sf=SF_SMALL)
    run = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=900)
    done = [line.split()[1] for line in run.stdout.splitlines() if line.startswith("RAN")]
    assert done == MODEL_QUERIES, run.stderr[-2000:]


def test_every_event_is_read(spark):
    from sessionary.sources.tables import canonical_events, raw_events
    given = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    own = canonical_events(spark, SF_SMALL)
    assert own.count() == raw_events(spark, SF_SMALL).count() == given.count()
    assert {"error", "signup"} <= {r["event"] for r in own.select("event").distinct().collect()}


def _null_visitor_events(spark):
    rows = [(k, f"2020-01-01 00:{k % 60:02d}:00", None if k % 3 == 0 else k % 2,
             ["view", "addtocart", "transaction", "other"][k // 2 % 4], k % 5,
             k if k // 2 % 4 == 2 else -1)
            for k in range(40)]
    return events_df(spark, rows)


def test_null_visitors_go_on_every_path(spark):
    from sessionary.operators import events as P
    from sessionary.operators import features as V
    from sessionary.sources.tables import SQL_DIR, load_queries
    ev = _null_visitor_events(spark)
    plain = V.visitor_features(ev, drop_bouncers=False)
    split = V.visitor_features(ev, drop_bouncers=False, parts=7)
    rows = lambda df: sorted(str(r) for r in df.collect())
    assert rows(plain) == rows(split) and {r["visitorid"] for r in plain.collect()} == {0, 1}
    assert P.sessionize(ev).where("visitorid is null").count() == 0
    sql = load_queries(spark, {"v": os.path.join(SQL_DIR, "visitor_features.sql")},
                       {"events": P.sessionize(ev)})["v"].select("visitorid", *V.FEATURE_COLUMNS)
    kept = {r["visitorid"] for r in V.visitor_features(ev).collect()}
    assert {r["visitorid"] for r in sql.collect()} == kept
    total = {r["visitorid"]: r for r in plain.collect()}
    assert all(r["num_evnts"] > r["num_views"] + r["num_acart"] + r["num_purch"] for r in total.values())


def test_merge_groups_hold_at_most_fan_in_lists(spark):
    from sessionary.operators import neighbors as N
    rng = np.random.default_rng(0)
    points = spark.createDataFrame([(k, rng.normal(size=2).tolist()) for k in range(80)],
                                   "id long, v array<double>")
    blocks, fan_in = 20, 4
    tiles = N.block_pairs(points, blocks).groupBy("bi", "bj").applyInPandas(
        N._tile_topk(3), "id long, d array<double>, bj int")
    most = (tiles.groupBy("id", F.floor(F.col("bj") / fan_in)).count().agg(F.max("count")).first()[0])
    assert most <= fan_in
    x = np.array([r["v"] for r in points.orderBy("id").collect()])
    d = np.sort(((x[:, None] - x[None]) ** 2).sum(2), axis=1)[:, :3]
    got = {r["id"]: r["d"] for r in N.merge_topk(tiles, 3, blocks, fan_in).collect()}
    assert all(np.allclose(got[k], d[k], atol=1e-9) for k in range(80))


def test_more_neighbours_than_points_gives_null(spark):
    from sessionary.operators import neighbors as N
    points = spark.createDataFrame([(k, [float(k)]) for k in range(5)], "id long, v array<double>")
    assert all(r["distance"] is None for r in N.k_distances(points, 6).collect())
    assert all(r["distance"] is not None for r in N.k_distances(points, 5).collect())


def test_hdbscan_with_clusters_larger_than_the_data(spark):
    from sessionary.operators import hierarchy as HD
    rng = np.random.default_rng(1)
    points = spark.createDataFrame([(k, rng.normal(size=2).tolist()) for k in range(60)],
                                   "id long, v array<double>")
    rows = HD.hdbscan(points, min_cluster_size=100, min_samples=5).labels.collect()
    assert sorted(r["id"] for r in rows) == list(range(60))
    assert {r["label"] for r in rows} == {-1}


def test_null_class_and_repeated_keys_are_sampled(spark):
    from sessionary.operators import sampling as SM
    rows = [(k, None if k % 4 == 0 else "a", 1) for k in range(400)]
    df = spark.createDataFrame(rows, "k long, cls string, x int")
    got = SM.stratified_samples(df, "cls", "k", 2, 0.25, drop_label=False)
    counts = {(r["split"], r["cls"]): r["count"] for r in got.groupBy("split", "cls").count().collect()}
    assert counts == {(s, c): n for s in (0, 1) for c, n in ((None, 25), ("a", 75))}
    same = df.withColumn("k", F.lit(7).cast("long"))  # all keys have one hash
    assert SM.random_samples(same, "k", 2, 0.25).count() == 200
    assert SM.stratified_samples(df.limit(0), "cls", "k", 2, 0.25).count() == 0


def test_a_repeated_run_replaces_its_artifact(spark, tmp_path):
    from sessionary.sources import sinks as SK
    df = spark.range(5)
    for _ in range(2):
        path = SK.write_artifact(df, str(tmp_path), "r1", "a", "t")
    SK.write_artifact(df, str(tmp_path), "r2", "a", "t")
    assert SK.read_artifact(spark, path, "r1").count() == 5 and SK.read_artifact(spark, path).count() == 10


def test_a_cluster_needs_a_shared_folder():
    from sessionary.session import checkpoint_dir

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default: default)
    with pytest.raises(RuntimeError):
        checkpoint_dir(Session())


def test_quantiles_over_partitions_and_null_groups(spark):
    from sessionary.operators.quantiles import quantile_columns
    rng = np.random.default_rng(2)
    values = {"a": rng.normal(size=3000), "b": rng.integers(0, 4, 2500).astype(float),
              None: rng.normal(size=30), "c": np.array([])}
    rows = [(g, float(v)) for g, own in values.items() for v in own] + [("c", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    for parts in (1, 30):  # groups over one and over several partitions
        got = {r["g"]: r for r in quantile_columns(df, ["g"], "v", {"p25": 0.25, "p90": 0.9},
                                                    parts).collect()}
        assert got["c"]["p25"] is None
        for g in ("a", "b", None):
            assert got[g]["p25"] == pytest.approx(np.quantile(values[g], 0.25))
            assert got[g]["p90"] == pytest.approx(np.quantile(values[g], 0.9))


def test_quantiles_of_many_groups(spark):
    """A hundred thousand groups, and one that holds a third of all rows."""
    from pyspark.sql import functions as F
    from sessionary.operators.quantiles import quantile_columns
    df = spark.range(450_000).select(
        F.when(F.col("id") < 150_000, F.lit(-1)).otherwise(F.col("id") % 100_000).alias("g"),
        F.col("id").cast("double").alias("v"))
    got = quantile_columns(df, ["g"], "v", {"p": 0.5})
    want = df.groupBy("g").agg(F.percentile("v", 0.5).alias("w"))
    assert got.count() == 100_001
    assert got.join(want, "g").where(F.abs(F.col("p") - F.col("w")) > 1e-9).count() == 0


def test_samples_of_many_classes(spark):
    """A hundred thousand classes, one of them null, one with a third of the rows."""
    from pyspark.sql import functions as F
    from sessionary.operators.sampling import stratified_samples
    df = spark.range(300_000).select("id", F.when(F.col("id") < 100_000, F.lit(0)).when(
        F.col("id") % 100_000 == 7, F.lit(None)).otherwise(F.col("id") % 100_000).alias("c"))
    got = stratified_samples(df, "c", "id", 1, 0.5, drop_label=False)
    assert got.count() == 150_000 and got.select("id").distinct().count() == 150_000
    sizes = {r["c"]: r["count"] for r in got.groupBy("c").count().collect()}
    assert sizes[None] == 1 and sizes[0] >= 50_000
    assert set(sizes.values()) - {sizes[0]} <= {1, 2}


def test_density_of_many_groups_and_a_group_called_all(spark):
    from pyspark.sql import functions as F
    from sessionary.operators.stats import density_curves
    df = spark.range(30_000).select((F.col("id") % 11_000).cast("string").alias("g"),
                                    F.col("id").cast("double").alias("v"))
    df = df.withColumn("g", F.when(F.col("g") == "5", F.lit("ALL")).otherwise(F.col("g")))
    curves = density_curves(df, "v", "g", grid_size=3)
    assert curves.count() == 3 * 11_001
    own = [(r["x"], r["density"]) for r in curves.where("group = 'ALL'").collect()]
    assert len(own) == 6 and len(set(own)) == 6


def test_float_downcast(spark):
    from sessionary.operators.events import downcast, downcast_table
    df = spark.createDataFrame([(0.5, 1e-9, 1234567.89, None), (float("nan"), 2.0, 1.0, None)],
                               "a double, b double, c double, d double")
    types = {r["column"]: r["type"] for r in downcast_table(df).collect()}
    assert types == {"a": "float", "b": "float", "c": "double", "d": "float"}
    assert dict(downcast(df).dtypes)["c"] == "double"
