"""Tree SHAP against Shapley values summed over every subset of features."""
from itertools import combinations
from math import factorial

import numpy as np
import pandas as pd
import pytest

from sessionary.operators import explain, iforest

FEATURES = ["a", "b", "c", "d"]


def _expected_leaf(tree, node, row, known):
    """Mean leaf value when only ``known`` features are followed, the others by cover."""
    n = tree[node]
    if not isinstance(n["feature"], str):
        return n["leaf_value"]
    left, right = int(n["left"]), int(n["right"])
    if n["feature"] in known:
        down = left if row[n["feature"]] <= n["threshold"] else right
        return _expected_leaf(tree, down, row, known)
    share = tree[left]["n"] / n["n"]
    return (share * _expected_leaf(tree, left, row, known)
            + (1 - share) * _expected_leaf(tree, right, row, known))


def test_shap_equals_all_subsets(spark):
    rng = np.random.default_rng(8)
    data = pd.DataFrame({"visitorid": range(120), "a": rng.normal(size=120), "b": rng.integers(0, 4, 120),
                         "c": rng.exponential(size=120), "d": rng.normal(size=120).round(1)})
    df = spark.createDataFrame(data)
    model = iforest.fit(df, FEATURES, n_estimators=4, max_samples=32)
    got = {r["visitorid"]: r for r in explain.ForestExplainer(model).shap_values(df.where("visitorid < 6"))
           .collect()}
    nodes = model.node_rows()
    trees = [{int(r["node_id"]): r for r in own.to_dict("records")} for _, own in nodes.groupby("tree_id")]
    for visitor, row in data.head(6).set_index("visitorid").iterrows():
        value = lambda known: np.mean([_expected_leaf(t, 1, row, known) for t in trees])
        for f in FEATURES:
            others = [g for g in FEATURES if g != f]
            phi = sum(factorial(k) * factorial(3 - k) / factorial(4)
                      * (value({*s, f}) - value(set(s)))
                      for k in range(4) for s in combinations(others, k))
            assert got[visitor][f"shap_{f}"] == pytest.approx(phi, abs=1e-9)
        assert got[visitor]["base_value"] == pytest.approx(value(set()))


@pytest.mark.parametrize("table_features", [explain.TABLE_FEATURES, 1])
def test_shap_is_computed_per_pattern_not_per_row(spark, monkeypatch, table_features):
    """Rows look their attributions up: many rows take no more evaluations than few."""
    rng = np.random.default_rng(3)
    data = pd.DataFrame({"visitorid": range(200), **{f: rng.normal(size=200) for f in FEATURES}})
    model = iforest.fit(spark.createDataFrame(data), FEATURES, n_estimators=3, max_samples=64)
    expected = explain.ForestExplainer(model).trees
    x = data[FEATURES].to_numpy(float)
    want = explain.shap_matrix(x, expected, len(FEATURES))
    monkeypatch.setattr(explain, "TABLE_FEATURES", table_features)
    trees = explain.ForestExplainer(model).trees
    evaluated, whole = [], explain._attributions

    def counted(o, z, v):
        evaluated.append(len(o) * len(z))
        return whole(o, z, v)
    monkeypatch.setattr(explain, "_attributions", counted)
    got = explain.shap_matrix(np.repeat(x, 50, axis=0), trees, len(FEATURES))
    assert np.allclose(got, np.repeat(want, 50, axis=0), atol=1e-12)
    leaves = sum(len(own) for _, own, _ in trees)
    assert sum(evaluated) <= (0 if table_features > 1 else leaves * 2 ** len(FEATURES))
