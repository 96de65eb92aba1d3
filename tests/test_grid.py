"""Forest grids: shared samples and attributions looked up per part of a tree."""
import hashlib

import numpy as np
import pandas as pd

from sessionary.operators import explain, iforest

FEATURES = ["a", "b", "c", "d"]


def _data(n, seed=5):
    rng = np.random.default_rng(seed)
    return pd.DataFrame({"visitorid": range(n), **{f: rng.normal(size=n) for f in FEATURES}})


def test_grid_points_share_one_pass(spark, monkeypatch):
    """A grid hashes the table once, for its largest forest; every point grows as on its own."""
    df = spark.createDataFrame(_data(400))
    grid = [{"n_estimators": k, "max_samples": 32, "bootstrap": b, "random_state": 42}
            for k, b in ((2, False), (5, False), (3, True))]
    alone = [iforest.fit(df, FEATURES, **point).node_rows() for point in grid]
    passes, draw = [], iforest.tree_samples

    def counted(df, key, n_estimators, *rest, **more):
        passes.append(n_estimators)
        return draw(df, key, n_estimators, *rest, **more)
    monkeypatch.setattr(iforest, "tree_samples", counted)
    shared = iforest.shared_samples(df, FEATURES, grid)
    for point, prepared, want in zip(grid, shared, alone):
        pd.testing.assert_frame_equal(iforest.fit(df, FEATURES, **point, **prepared).node_rows(), want)
    assert passes == [5]


def test_tree_samples_are_the_smallest_hashes(spark):
    """Candidates found by hex text: exactly the smallest MD5 keys, a null key's among them."""
    keys = [None, *range(300)]
    df = spark.createDataFrame([(k,) for k in keys], "visitorid long")
    got = {(r["tree_id"], r["visitorid"])
           for r in iforest.tree_samples(df, "visitorid", 4, 20, len(keys), 42).collect()}

    def number(t, key):
        text = ":".join(["42", *([] if key is None else [str(key)]), str(t)])
        return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)
    assert got == {(t, key) for t in range(4) for key in sorted(keys, key=lambda k: number(t, k))[:20]}


def test_neighbouring_leaves_share_lookups(spark, monkeypatch):
    """Parts need far fewer lookups than leaves and give the same attributions, also for
    missing and infinite values."""
    model = iforest.fit(spark.createDataFrame(_data(300)), FEATURES, n_estimators=3, max_samples=64)
    whole = explain.ForestExplainer(model).trees
    monkeypatch.setattr(explain, "PART_STATES", 0)
    single = explain.ForestExplainer(model).trees
    x = _data(60, 6)[FEATURES].to_numpy(float)
    x[:8, 1], x[5:12, 0], x[10:14, 2], x[14] = np.nan, -np.inf, np.inf, np.nan
    assert np.allclose(explain.shap_matrix(x, whole, 4), explain.shap_matrix(x, single, 4), atol=1e-12)
    lookups = lambda trees: sum(len(features) for _, parts, _ in trees for _, features, _, _ in parts)
    assert 2 * lookups(whole) < lookups(single)
