"""Density-based clustering on Spark: DBSCAN.

DBSCAN(eps, min_samples), Euclidean, neighbourhoods include the point and use
``distance <= eps``.  Points lie in the cells of an eps grid
(:mod:`sessionary.operators.cells`): a point meets the points of its own cell and
of the neighbour cells within eps, and cells with many points are cut into block
pairs: about a dozen blocks for all points (:func:`block_rows_for`), which a task
takes in pieces of ``block_rows`` rows.

1. neighbour counts: tiles count, per point, the points within ``eps`` (summed
   per point) -> core flags;
2. tiles again, now with core flags: inside a tile the core points within
   ``eps`` of each other form local components (numpy; pieces that are already
   in one component are not compared); each core point emits
   one edge to its local component's smallest id, each non-core point one
   candidate per adjacent local component.  That is at most one row per core point
   and tile - never the neighbour pairs themselves;
3. global components of the star edges (:func:`connected_components`); a
   cluster is named by its smallest core id and numbered 0, 1, ... in that
   order; a border point joins the smallest-numbered adjacent cluster; the
   rest is noise (-1).

Two points within ``eps`` share a tile, so counts and components are exact.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionary.operators.cells import dealt_grid
from sessionary.operators.graph import connected_components, global_rank
from sessionary.operators.neighbors import (
    DEFAULT_BLOCK_ROWS,
    _sqdist,
    block_rows_for,
    pieces,
)
from sessionary.session import materialize


COUNTS, LINKS = "id long, c long", "id long, rep long, kind int"


def _by_arrow(fn, schema: str):
    """``fn`` (other columns, matrix of the vectors) as a function of Arrow tables."""
    kinds = {"long": pa.int64(), "int": pa.int32()}
    wanted = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in schema.split(", ")])

    def run(table):
        v = table["v"].combine_chunks()
        if v.null_count or pc.count_distinct(pc.list_value_length(v)).as_py() > 1:
            raise ValueError("a vector is missing or has another length than the others")
        x = v.flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, -1)
        return pa.Table.from_pandas(fn(table.drop_columns(["v", "cell"]).to_pandas(), x), wanted,
                                    preserve_index=False)
    return run


def _sides(pdf: pd.DataFrame):
    """(rows of the left side, rows of the right side, whether both sides are one block)."""
    every = np.arange(len(pdf))
    if pdf["first"].iat[0] == pdf["second"].iat[0]:
        return every, every, True
    late = pdf["late"].to_numpy().astype(bool)
    return every[~late], every[late], False


#: Share of eps squared up to which single precision may leave a pair undecided.
UNSURE = 0.01


class Within:
    """Which points of two sides lie within eps, piece by piece.

    Single precision decides but for pairs too near to eps, which are taken from
    differences; where that would be many, all are taken in double precision."""

    def __init__(self, left: np.ndarray, right: np.ndarray, eps2: float):
        self.left, self.right, self.eps2 = left, right, eps2
        na, nb = (left * left).sum(1), (right * right).sum(1)
        most = na.max(initial=0.0) + nb.max(initial=0.0)
        self.room = 2.0 * (left.shape[1] + 8) * float(np.finfo(np.float32).eps) * most
        self.single = self.room <= UNSURE * eps2 and most < 1e30 and eps2 < 1e30
        if self.single:
            self.a = np.column_stack([-2.0 * left, na, np.ones(len(left))]).astype(np.float32)
            self.b = np.column_stack([right, np.ones(len(right)), nb]).astype(np.float32)

    def pairs(self, i: slice, j: slice, same: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """(row, column) of the pairs within eps of two pieces; ``same``: of one piece with itself."""
        if not self.single:
            within = _sqdist(self.left[i], self.right[j]) <= self.eps2
            if same:
                np.fill_diagonal(within, True)
            return np.nonzero(within)
        d = self.a[i] @ self.b[j].T
        near = d <= np.float32(self.eps2 + self.room)
        if same:
            np.fill_diagonal(near, True)
        at = np.flatnonzero(near)
        row, col = np.divmod(at, near.shape[1])
        unsure = d.ravel()[at] > np.float32(self.eps2 - self.room)
        if same:
            unsure &= row != col
        if unsure.any():
            diff = self.left[i][row[unsure]] - self.right[j][col[unsure]]
            unsure[unsure] = ~((diff * diff).sum(1) <= self.eps2)
            row, col = row[~unsure], col[~unsure]
        return row, col


def _tile_counts(eps2: float, rows: int):
    def fn(pdf, x):
        left, right, whole = _sides(pdf)
        to_left = np.zeros(len(left), np.int64)
        to_right = to_left if whole else np.zeros(len(right), np.int64)
        within = Within(x[left], x[right], eps2)
        for i in pieces(len(left), rows):
            for j in pieces(len(right), rows):
                if whole and j.start < i.start:
                    continue
                row, col = within.pairs(i, j, whole and i == j)
                to_left[i] += np.bincount(row, minlength=i.stop - i.start)
                if not whole or i != j:
                    to_right[j] += np.bincount(col, minlength=j.stop - j.start)
        ids = pdf["id"].to_numpy()
        out = pd.DataFrame({"id": ids[left], "c": to_left})
        if not whole:
            out = pd.concat([out, pd.DataFrame({"id": ids[right], "c": to_right})], ignore_index=True)
        return out[out["c"] > 0]
    return fn


def _count_neighbours(points: DataFrame, eps: float, block_rows: int, n: int) -> DataFrame:
    tiles = dealt_grid(points, eps, block_rows_for(n, block_rows)).groupBy(
        "cell", "first", "second").applyInArrow(
            _by_arrow(_tile_counts(eps * eps, block_rows), COUNTS), COUNTS)
    return tiles.groupBy("id").agg(F.sum("c").alias("n_neighbors"))


def neighbour_counts(points: DataFrame, eps: float,
                     block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """(id, n_neighbors): points within ``eps``, the point itself included."""
    pts = materialize(points.select("id", "v"))
    return _count_neighbours(pts, eps, block_rows, pts.count())


def _linked(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest reachable index of each of n vertices with the edges (a, b)."""
    label = np.arange(n)
    while True:
        new = label.copy()
        np.minimum.at(new, a, label[b])
        np.minimum.at(new, b, label[a])
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def _tile_links(eps2: float, rows: int):
    def fn(pdf, x):
        left, right, whole = _sides(pdf)
        order = pdf["id"].to_numpy().argsort(kind="stable")  # small places for small ids
        x, ids, core = x[order], pdf["id"].to_numpy()[order], pdf["core"].to_numpy().astype(bool)[order]
        place = np.empty(len(pdf), np.int64)
        place[order] = np.arange(len(pdf))
        sides = []
        for at in [place] if whole else [place[left], place[right]]:
            cores, others = at[core[at]], at[~core[at]]
            sides.append((x[cores], cores, x[others], others))
        label = np.arange(len(ids))
        # core points: pieces that are already in one component need no distances
        (xl, al, *_), (xr, ar, *_) = sides[0], sides[-1]
        within = Within(xl, xr, eps2)
        for i in pieces(len(al), rows):
            for j in pieces(len(ar), rows):
                if whole and j.start < i.start:
                    continue
                a, b = label[al[i]], label[ar[j]]
                if (a == a[0]).all() and (b == a[0]).all():
                    continue
                row, col = within.pairs(i, j, whole and i == j)
                apart = a[row] != b[col]
                if apart.any():
                    ends = np.unique(np.stack([a[row[apart]], b[col[apart]]]), axis=1)
                    label = _linked(len(ids), *ends)[label]
        border = [np.zeros((2, 0), np.int64)]
        for one, other in {(0, 0)} if whole else {(0, 1), (1, 0)}:
            (_, _, xs, spots), (xc, cores, *_) = sides[one], sides[other]
            within = Within(xs, xc, eps2)
            for i in pieces(len(spots), rows):
                for j in pieces(len(cores), rows):
                    row, col = within.pairs(i, j)
                    border.append(np.unique(np.stack([spots[i][row], label[cores[j][col]]]), axis=1))
        linked = np.flatnonzero(core & (label != np.arange(len(ids))))
        pairs = np.unique(np.concatenate(border, axis=1), axis=1)
        return pd.concat([pd.DataFrame({"id": ids[linked], "rep": ids[label[linked]], "kind": 0}),
                          pd.DataFrame({"id": ids[pairs[0]], "rep": ids[pairs[1]], "kind": 1})],
                         ignore_index=True)
    return fn


def dbscan(points: DataFrame, eps: float = 1.2, min_samples: int = 38,
           block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """(id, n_neighbors, core, label); label -1 = noise."""
    pts = materialize(points.select("id", "v"))
    n = pts.count()
    flagged = materialize(pts.join(_count_neighbours(pts, eps, block_rows, n), "id")
                          .withColumn("core", F.col("n_neighbors") >= F.lit(min_samples)))
    links = materialize(
        dealt_grid(flagged.select("id", "v", "core"), eps, block_rows_for(n, block_rows))
        .groupBy("cell", "first", "second").applyInArrow(
            _by_arrow(_tile_links(eps * eps, block_rows), LINKS), LINKS))
    core_edges = links.where(F.col("kind") == 0).select(F.col("id").alias("src"),
                                                       F.col("rep").alias("dst"))
    comps = connected_components(
        core_edges, flagged.where("core").select(F.col("id").alias("node")))
    # clusters numbered 0.. in order of their smallest core id
    names = comps.select("component").distinct()
    numbered = (global_rank(names, ["component"], "rank")
                .select("component", (F.col("rank") - 1).cast("int").alias("cluster")))
    core_lab = comps.join(numbered, "component").select(F.col("node").alias("id"), "cluster")
    border = (links.where(F.col("kind") == 1)
              .join(comps.select(F.col("node").alias("rep"), "component"), "rep")
              .join(numbered, "component")
              .groupBy("id").agg(F.min("cluster").alias("bcluster")))
    return (flagged.select("id", "n_neighbors", "core")
            .join(core_lab, "id", "left").join(border, "id", "left")
            .select("id", "n_neighbors", "core",
                    F.when(F.col("core"), F.col("cluster"))
                    .otherwise(F.coalesce("bcluster", F.lit(-1))).cast("int").alias("label")))
