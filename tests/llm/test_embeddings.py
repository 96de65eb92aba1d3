"""Embedding near-dedup (operator 11)."""
import numpy as np
import pytest

from sessionary.llm import embeddings
from sessionary.llm.queries import QUERIES
from tests.conftest import SF_SMALL

SCHEMA = "vec_id long, embedding array<float>, label int, key string, links long, cell int, root string"


def plain(rows, threshold=0.9):
    """(vec_id, n_links, component_id, kept) of (vec_id, vector) rows, pair by pair."""
    good = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v)
            and any(x != 0 for x in v) for _, v in rows]
    unit = [np.array(v, np.float32).astype(float) if ok else None for (_, v), ok in zip(rows, good)]
    n, parent = [0] * len(rows), list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, x in enumerate(unit):
        for j, y in enumerate(unit[:i]):
            if x is None or y is None or len(x) != len(y):
                continue
            if x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= threshold:
                n[i], n[j] = n[i] + 1, n[j] + 1
                parent[root(i)] = root(j)
    out = []
    for k, (vec, _) in enumerate(rows):
        ids = [v for m, (v, _) in enumerate(rows) if root(m) == root(k) and v is not None]
        top = min(ids, default=None)
        out.append((vec, n[k], top, vec is not None and vec == top))
    return sorted(out, key=repr)


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", 1, 2, "y") for i, v in rows], SCHEMA)


def run(spark, rows, **sizes):
    return sorted(map(tuple, embeddings.near_duplicates(table(spark, rows), **sizes).collect()), key=repr)


def clusters(seed, groups, size, spread, dims=8):
    """Vectors around a few centres, so that links, chains and clean rows all occur."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dims))
    x = np.repeat(centres, size, axis=0) + rng.normal(size=(groups * size, dims)) * spread
    return [(k, v.astype(np.float32).tolist()) for k, v in enumerate(x)]


@pytest.mark.parametrize("sizes", [
    {}, {"cell_rows": 20, "block_rows": 7, "guest_rows": 9}, {"cell_rows": 5, "max_cells": 12}])
@pytest.mark.parametrize("spread", [0.15, 0.6])
def test_brute_force_in_cells_and_blocks(spark, sizes, spread):
    rows = clusters(3, 12, 15, spread)
    assert run(spark, rows, **sizes) == plain(rows)


def test_a_hot_vector_and_a_hot_group(spark):
    rows = clusters(5, 6, 10, 0.6)
    rows += [(1000 + k, rows[0][1]) for k in range(60)]                       # copies of one vector
    rows += [(2000 + k, v) for k, (_, v) in enumerate(clusters(9, 1, 60, 0.05))]  # one dense group
    assert run(spark, rows, cell_rows=16, block_rows=8, guest_rows=8) == plain(rows)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]),
            (7, [1.0, 0.0]), (7, [1.0, 0.0]), (8, [2.0, 0.1]), (None, [3.0, 0.2]), (None, [0.0, -1.0]),
            (9, [1.0, 0.0, 0.0]), (10, [1e30, 1e29]), (11, [1e-40, 0.0]), (None, None)]
    assert run(spark, rows) == plain(rows)
    assert run(spark, rows, cell_rows=2, block_rows=2, guest_rows=2) == plain(rows)
    assert run(spark, []) == []
    assert run(spark, [(1, None)]) == [(1, 0, 1, True)]
    with pytest.raises(ValueError):
        run(spark, rows, threshold=0.0)


def test_guests_hold_every_link_between_cells(spark):
    rows = clusters(11, 20, 20, 0.5, dims=4)
    import pyarrow as pa
    vectors = pa.array([v for _, v in rows], pa.list_(pa.float32()))
    pivots = embeddings.Pivots(vectors, 15, 0.9)
    cell, angle = pivots.own_cell(vectors)
    radius = np.array([angle[cell == c].max(initial=0) for c in range(pivots.cells)])
    sent = set(zip(*[x.tolist() for x in pivots.guests(vectors, cell, radius)]))
    x = embeddings.unit_rows(vectors, 4)
    some = 0
    for i, j in zip(*np.nonzero(x @ x.T >= 0.9)):
        if cell[i] < cell[j]:
            some += 1
            assert (j, cell[i]) in sent
    assert some and len(sent) < len(rows) * pivots.cells / 2  # and not everything is sent


def test_op11_on_the_table(spark):
    df = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    got = QUERIES["op11_embedding_dedup"](spark, SF_SMALL)
    assert sorted(map(tuple, got.collect()), key=repr) == plain(rows)
