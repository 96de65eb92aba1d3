"""What HDBSCAN's blocks send to the driver, and the merge of edges on arrays."""
import numpy as np
import pandas as pd

from sessionary.operators import hierarchy as HD
from sessionary.operators.neighbors import Nearest


def _points(spark, n, seed):
    rng = np.random.default_rng(seed)
    x = np.vstack([rng.normal(c, 0.5, (n // 4, 3)) for c in (0, 4, 8, 12)])
    return spark.createDataFrame(pd.DataFrame({"id": np.arange(n), "v": [list(r) for r in x]}),
                                 "id long, v array<double>")


def test_rows_of_blocks_on_the_driver(spark, monkeypatch):
    """A few forests over the blocks reach the driver, not a row for every two blocks."""
    pts = _points(spark, 1_200, 1)
    cores, seen, whole = HD.core_distances(pts, 4, 20), [], HD.spanning_forest
    monkeypatch.setattr(HD, "spanning_forest", lambda n, a, *keys: seen.append((n, len(a))) or whole(n, a, *keys))
    HD.mst_candidates(pts, cores, 20)
    blocks, rows = seen[0]  # the driver's own call; tasks have their own copy of the module
    assert blocks >= 40 and rows <= HD.JOIN_FORESTS * blocks and rows < blocks * (blocks - 1) / 4


def test_ways_are_the_minimax_closure():
    rng = np.random.default_rng(3)
    n = 30
    w = np.triu(rng.integers(1, 40, (n, n)).astype(float), 1)
    w += w.T
    p, q = np.triu_indices(n, 1)
    kept = HD.spanning_forest(n, p, q, w[p, q], p, q)
    tree = np.column_stack([p, q, w[p, q]])[kept]
    tree = tree[np.argsort(tree[:, 2], kind="stable")]
    best = w.copy()
    for k in range(n):
        best = np.minimum(best, np.maximum(best[:, k:k + 1], best[k]))
    np.fill_diagonal(best, 0)
    own = [3, 4, 9, 17, 28]
    assert (HD._ways_among(tree, own) == best[np.ix_(own, own)]).all()
    assert np.isinf(HD._ways_among(tree[:0], own)[0, 1])


def test_copies_of_neighbours_fill_the_list():
    """Columns that count several times give what as many columns would, a few entries at a time."""
    rng = np.random.default_rng(4)
    d, times = np.round(rng.uniform(0, 1, (20, 300)), 2), rng.integers(1, 40, 300)
    got, want = Nearest(20, 9), Nearest(20, 9)
    for at in (slice(0, 5), slice(5, 200), slice(200, 300)):
        got.add(slice(0, 20), d[:, at], times[at])
        want.add(slice(0, 20), np.repeat(d[:, at], times[at], axis=1))
    assert all((a == b).all() for a, b in zip(got.lists(), want.lists()))
