"""Silhouettes of many clusters: only clusters that can be near are compared, no visitor is left out."""
import math

import numpy as np
import pandas as pd

from sessionary.operators import neighbors as N
from sessionary.plans import registry


def _clusters(spark, n, many, digits, seed):
    rng = np.random.default_rng(seed)
    label = rng.integers(0, many, n)
    x = np.round(rng.uniform(0, 10, (many, 4))[label] + rng.normal(0, 0.4, (n, 4)), digits)
    rows = pd.DataFrame({"id": np.arange(n), "v": list(map(list, x)), "label": label})
    return spark.createDataFrame(rows, "id long, v array<double>, label int")


def test_bounds_and_copies_give_the_silhouette_of_all_pairs(spark, monkeypatch):
    """Few rows reach the tasks, and the mean is that over every point (copies included)."""
    monkeypatch.setattr(N, "block_pairs", None)  # all pairs of blocks are not needed here
    for digits in (1, 6):
        pts = _clusters(spark, 900, 30, digits, digits).cache()
        got = N.silhouette_score(pts, noise_label=0, block_rows=100).first()
        rows = pts.where("label != 0").toPandas()
        x, label = np.stack(rows["v"]), rows["label"].to_numpy()
        d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
        sums = np.stack([d[:, label == c].sum(1) for c in range(1, 30)], axis=1)
        size = np.array([(label == c).sum() for c in range(1, 30)])
        every, own = np.arange(len(x)), label - 1
        a = sums[every, own] / (size[own] - 1)
        others = sums / size
        others[every, own] = np.inf
        b = others.min(1)
        assert got["n"] == len(x)
        assert math.isclose(got["silhouette"], ((b - a) / np.maximum(a, b)).mean(), rel_tol=1e-9)


def test_one_cluster_and_points_alone(spark):
    one = spark.createDataFrame([(i, [float(i)], 0) for i in range(40)], "id long, v array<double>, label int")
    assert tuple(N.silhouette_score(one, block_rows=10).first()) == (40, None)
    alone = spark.createDataFrame([(i, [100.0 * (i // 2)], i // 2 if i < 38 else i) for i in range(40)],
                                  "id long, v array<double>, label int")
    assert N.silhouette_score(alone, block_rows=10).first()["silhouette"] == N.silhouette_samples(
        alone, 10).agg({"s": "avg"}).first()[0]


def test_hdbscan_silhouette_is_over_every_visitor(spark, monkeypatch):
    """No part of the visitors stands for the others."""
    rng = np.random.default_rng(2)
    label = np.arange(300) % 3
    x = rng.normal(label * 5.0, 1.0)
    ids = spark.createDataFrame([(1000 + i, i) for i in range(300)], "visitorid long, id long")
    scaled = spark.createDataFrame([(1000 + i, float(x[i])) for i in range(300)], "visitorid long, f double")
    labels = spark.createDataFrame([(i, int(label[i]) if i % 10 else -1) for i in range(300)], "id long, label int")
    model = type("Model", (), {"ids": ids, "result": type("Result", (), {"labels": labels})})
    monkeypatch.setattr(registry, "_hdbscan", lambda *_: (scaled, ["f"], model))
    whole, seen = N.silhouette_score, []

    def smaller(points, sample_size=None, **kw):  # the bound of a sample, at the size of this test
        seen.append(sample_size)
        return whole(points, sample_size=sample_size and 20, **kw)
    monkeypatch.setattr(N, "silhouette_score", smaller)
    assert registry.q_hdbscan_silhouette(spark, "").first()["n"] == 270
    assert seen == [None]
