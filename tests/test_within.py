"""Pairs within eps in single precision, and tiles that skip what is already linked."""
import numpy as np
import pandas as pd
import pytest

from sessionary.operators import density as DN


@pytest.mark.parametrize("shift,scale", [(0.0, 1.0), (1e4, 1.0), (0.0, 1e25)])
def test_pairs_equal_those_of_differences(shift, scale):
    rng = np.random.default_rng(1)
    x = (rng.integers(0, 6, (300, 3)) / 5.0 + shift) * scale  # many pairs lie at eps itself
    y = (rng.integers(0, 6, (200, 3)) / 5.0 + shift) * scale
    d2 = ((x[:, None] - y[None]) ** 2).sum(-1)
    eps2 = float(np.quantile(d2, 0.2)) * (1 + 1e-12)
    found = DN.Within(x, y, eps2)
    assert found.single == (shift == 0.0 and scale == 1.0)
    row, col = found.pairs(slice(0, 300), slice(0, 200))
    got = np.zeros(d2.shape, bool)
    got[row, col] = True
    sure = np.abs(d2 - eps2) > 1e-6 * eps2 if not found.single else np.ones(d2.shape, bool)
    assert (got == (d2 <= eps2))[sure].all()


def test_linked_pieces_are_not_compared(monkeypatch):
    """One component of core points costs a row of pieces, not all pairs of them."""
    rng = np.random.default_rng(2)
    n, rows, seen, whole = 2_000, 50, [], DN.Within.pairs
    x = rng.uniform(0, 1, (n, 2))
    pdf = pd.DataFrame({"id": rng.permutation(n), "first": 0, "second": 0, "late": False, "core": True})

    def counted(self, *args):
        seen.append(1)
        return whole(self, *args)
    monkeypatch.setattr(DN.Within, "pairs", counted)
    out = DN._tile_links(0.8 ** 2, rows)(pdf, x)
    assert len(out) == n - 1 and set(out["rep"]) == {0} and set(out["kind"]) == {0}
    assert len(seen) <= 2 * n // rows


def test_tiles_of_one_cell_are_many_tasks(spark, monkeypatch):
    """All points in one cell: its tiles do not end in one task, however the sizes are joined."""
    from pyspark.sql import functions as F
    from sessionary.operators import cells
    pts = spark.range(400).select("id", F.array(F.rand(1), F.rand(2)).alias("v"))
    for most in (cells.MOST_CELLS, 0):
        monkeypatch.setattr(cells, "MOST_CELLS", most)
        dealt = cells.dealt_grid(pts, 5.0, 40).withColumn("task", F.spark_partition_id())
        assert dealt.groupBy("cell", "first", "second").agg(F.count_distinct("task").alias("n")).where(
            "n > 1").count() == 0
        plan = dealt._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(cell#" in plan and ", first#" in plan


def test_vectors_of_other_lengths_are_refused():
    """Rows are not dealt out anew over the values of missing or longer vectors."""
    import pyarrow as pa
    rows = {"id": [1, 2], "cell": [[0], [0]], "first": [0, 0], "second": [0, 0], "late": [False, False]}
    run = DN._by_arrow(DN._tile_counts(1.0, 10), DN.COUNTS)
    kind = pa.list_(pa.float64())
    assert run(pa.table({**rows, "v": pa.array([[1.0, 2.0], [1.0, 2.5]], kind)})).to_pydict()["c"] == [2, 2]
    for bad in ([[1.0, 2.0], None], [[1.0, 2.0, 3.0], [1.0]]):
        with pytest.raises(ValueError):
            run(pa.table({**rows, "v": pa.array(bad, kind)}))
