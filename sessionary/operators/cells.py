"""Cells for joins of near points: an eps grid or pivots, and tasks of bounded size.

A join of near points puts every point into one *own* cell and sends it as a
*guest* to those other cells in which it can have a partner.  ``deal`` cuts the
rows of each cell into blocks and sends a row to the block pairs that it takes
part in, so a cell with most of the points becomes many tasks, not a long one.

* ``grid_rows``: cells of width 2 eps along the (at most three) widest dimensions
  that are wider than a cell; a guest goes only to the smaller one of two cells and
  only where the cell's box lies within eps, so each pair within eps meets once and
  evenly spread points are sent to about four cells.
* ``Pivots``: farthest-first pivots of a bounded sample by hash; a point belongs to
  its nearest pivot, and the triangle inequality tells which cells can hold a
  neighbour within a given distance.

Points are (id, v array<double>) rows.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GRID_DIMS = 3
GRID_WIDTH = 2  # in eps
SAMPLE_ROWS = 4_096
#: Most cells whose sizes go to every task.
MOST_CELLS = 65_536
#: Room for rounding in distances that are compared with each other.
SLACK = 1e-9


def deal(rows: DataFrame, own_blocks: Column, guest_blocks: Column, inner: bool = True) -> DataFrame:
    """``rows`` (cell, guest, id, ...) for every block pair (cell, first, second).

    Own blocks come before the guests' ones; ``late`` marks the rows of the second
    block.  Pairs are own with own (if ``inner``) and own with guest.
    """
    guest, h = F.col("guest"), F.xxhash64("id", F.lit(7))
    own_blocks, guest_blocks = own_blocks.cast("int"), guest_blocks.cast("int")
    block = F.when(guest, own_blocks + F.pmod(h, F.greatest(guest_blocks, F.lit(1)))).otherwise(
        F.pmod(h, F.greatest(own_blocks, F.lit(1)))).cast("int")
    every = own_blocks + guest_blocks

    def span(low: Column, high: Column) -> Column:
        return F.when(high > low, F.sequence(low, high - 1)).otherwise(F.array().cast("array<int>"))
    others = F.when(guest, span(F.lit(0), own_blocks)).otherwise(
        span(F.lit(0) if inner else own_blocks, every))
    dealt = rows.withColumn("_block", block).withColumn("_other", F.explode(others))
    return (dealt.withColumn("first", F.least("_block", "_other"))
            .withColumn("second", F.greatest("_block", "_other"))
            .withColumn("late", F.col("_block") > F.col("_other")).drop("_block", "_other"))


def blocks(count: Column, block_rows: int) -> Column:
    return F.ceil(count / F.lit(block_rows))


def dealt_grid(points: DataFrame, eps: float, block_rows: int) -> DataFrame:
    """The points for every tile in which they have neighbours within ``eps``.

    ``points`` is read several times: a written table.  The cells' sizes (a row per
    occupied cell) are joined, not collected.  The rows lie by tile: without that, a join
    on the cell would leave all tiles of a cell to one task.
    """
    from sessionary.session import materialize
    rows = grid_rows(points, eps)
    sizes = materialize(rows.groupBy("cell").agg(F.count_if(~F.col("guest")).alias("_own"),
                                                 F.count_if("guest").alias("_guests")))
    if sizes.count() <= MOST_CELLS:
        sizes = F.broadcast(sizes)
    return deal(rows.join(sizes, "cell"), blocks(F.col("_own"), block_rows),
                blocks(F.col("_guests"), block_rows)).drop("_own", "_guests", "guest").repartition(
        "cell", "first", "second")


def grid_rows(points: DataFrame, eps: float) -> DataFrame:
    """``points`` with cell and guest: own rows, and guests in smaller neighbour cells."""
    width = GRID_WIDTH * eps * (1 + SLACK)
    # one row per dimension reaches the driver
    ranges = (points.select(F.posexplode("v").alias("k", "x")).groupBy("k")
              .agg(F.min("x").alias("low"), F.max("x").alias("high")).collect())
    wide = sorted(((r["high"] - r["low"], r["k"], r["low"]) for r in ranges
                   if r["high"] - r["low"] > width), reverse=True)[:GRID_DIMS]
    if not wide or eps <= 0:
        # one cell, 0; not a literal, which would turn joins on it into nested loops
        return points.withColumn("cell", F.array(F.pmod(F.xxhash64("id"), F.lit(1).cast("long")))).withColumn(
            "guest", F.lit(False))
    coords = [(F.element_at("v", k + 1) - F.lit(low)) / F.lit(width) for _, k, low in wide]
    home = [F.floor(c) for c in coords]
    parts = [c - F.floor(c) for c in coords]  # place inside the cell, in cell widths
    cells = [F.struct(F.array(*home).alias("cell"), F.lit(False).alias("guest"), F.lit(0.0).alias("far"))]
    for step in product((-1, 0, 1), repeat=len(wide)):
        if step < (0,) * len(wide):
            gaps = [p if s < 0 else 1 - p for p, s in zip(parts, step) if s]
            far = sum((g * g for g in gaps), F.lit(0.0))
            cells.append(F.struct(F.array(*[h + s for h, s in zip(home, step)]).alias("cell"),
                                  F.lit(True).alias("guest"), far.alias("far")))
    near = F.filter(F.array(*cells), lambda c: c["far"] <= (1 + SLACK) / GRID_WIDTH ** 2)
    return points.withColumn("_c", F.explode(near)).select(
        *points.columns, F.col("_c.cell").alias("cell"), F.col("_c.guest").alias("guest"))


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (a @ b.T)
    return np.sqrt(np.maximum(d, 0.0))


class Pivots:
    """Nearest-pivot cells of points."""

    def __init__(self, points: DataFrame, cells: int):
        sample = points.orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS).select("v").collect()
        x = np.array([r["v"] for r in sample], float)
        chosen, nearest = [0], distances(x, x[:1])[:, 0]
        while len(chosen) < min(cells, len(x)) and nearest.max() > 0:
            chosen.append(int(nearest.argmax()))
            nearest = np.minimum(nearest, distances(x, x[chosen[-1:]])[:, 0])
        self.pivots = x[chosen]
        self.apart = distances(self.pivots, self.pivots)

    def assign(self, points: DataFrame) -> DataFrame:
        """``points`` with cell and far: the nearest pivot and its distance."""
        def run(batches):
            for pdf in batches:
                d = distances(np.stack(pdf["v"].to_numpy()), self.pivots)
                cell = d.argmin(axis=1)
                yield pdf.assign(cell=cell.astype(np.int32), far=d[np.arange(len(d)), cell])
        own = ", ".join(f"{c} {t}" for c, t in points.dtypes)
        return points.mapInPandas(run, f"{own}, cell int, far double")

    def figures(self, assigned: DataFrame) -> tuple[np.ndarray, np.ndarray]:
        """Points and radius of every cell (a row per pivot reaches the driver)."""
        count, radius = np.zeros(len(self.pivots), np.int64), np.zeros(len(self.pivots))
        for r in assigned.groupBy("cell").agg(F.count("*").alias("n"), F.max("far").alias("r")).collect():
            count[r["cell"]], radius[r["cell"]] = r["n"], r["r"]
        return count, radius

    def reach(self, x: np.ndarray, k: int, count: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """A distance within which each point has k points: whole cells, nearest rim first."""
        rim = distances(x, self.pivots) + radius
        order = np.argsort(rim, axis=1)
        enough = np.cumsum(count[order], axis=1) >= k
        at = np.where(enough.any(axis=1), enough.argmax(axis=1), len(count) - 1)
        every = np.arange(len(x))
        return np.where(enough.any(axis=1), rim[every, order[every, at]], np.inf)

    def guests(self, x: np.ndarray, cell: np.ndarray, bound: np.ndarray, count: np.ndarray,
               radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, other cell) pairs where the cell can hold a point within the row's bound."""
        d = distances(x, self.pivots)
        own = d[np.arange(len(x)), cell]
        limit = (bound * (1 + SLACK) + SLACK)[:, None]
        with np.errstate(divide="ignore", invalid="ignore"):
            plane = (d ** 2 - own[:, None] ** 2) / (2 * self.apart[cell])  # to the plane between pivots
        near = (d - radius <= limit) & ~(plane > limit) & (count > 0)
        near[np.arange(len(x)), cell] = False
        return np.nonzero(near)


def visits(pivots: Pivots, bounded: DataFrame, count: np.ndarray, radius: np.ndarray) -> DataFrame:
    """(id, v, cell, bound) rows of guests from (id, v, cell, bound) points."""
    def run(batches):
        for pdf in batches:
            x = np.stack(pdf["v"].to_numpy()) if len(pdf) else np.zeros((0, pivots.pivots.shape[1]))
            for at in range(0, len(pdf), 1_024):
                cut = slice(at, at + 1_024)
                row, cell = pivots.guests(x[cut], pdf["cell"].to_numpy()[cut],
                                          pdf["bound"].to_numpy()[cut], count, radius)
                own = pdf.iloc[cut].iloc[row]
                yield pd.DataFrame({"id": own["id"], "v": own["v"], "cell": cell.astype(np.int32),
                                    "bound": own["bound"]})
    return bounded.mapInPandas(run, "id long, v array<double>, cell int, bound double")
