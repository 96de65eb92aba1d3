"""Exact nearest neighbours and silhouettes (N3, N4, M12; HDBSCAN).

Nearest neighbours: points lie in the cells of pivots
(:mod:`sessionary.operators.cells`).  A first pass finds the k nearest within each
cell; the k-th distance (or, where a cell is too small, the rim of enough whole
cells) bounds how far a neighbour can be, and a second pass sends a point only to
the cells that this bound reaches.  Tasks are pairs of blocks; they emit the ``k``
smallest distances per point, never pairs.  Per-point lists are merged by a fan-in
tournament (``groupBy`` levels of about ``fan_in`` lists), so no group holds much more
than ``fan_in * k`` values.  In many dimensions without structure the bound reaches
most cells; then all pairs of blocks are compared.

Points are cut into about ``BLOCKS`` blocks whatever their number, so a point goes to
as many tasks and what is shuffled grows with the points; a block has ``MOST_ROWS``
rows at most, and a task takes its pair of blocks in pieces of ``block_rows`` rows.

Silhouettes compare a point with the members of its own cluster and of those others
that can be its nearest by the clusters' centres and spreads; where that leaves out
little, all pairs of blocks (:func:`block_pairs`).
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionary.operators.cells import Pivots, blocks, deal, visits

DEFAULT_BLOCK_ROWS = 1024


def vectors(df: DataFrame, id_col: str, vec_col: str | None = None,
            features: list[str] | None = None) -> DataFrame:
    """(id, v array<double>) from an array column or from numeric columns."""
    if vec_col is not None:
        v = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    else:
        v = F.array(*[F.col(c).cast("double") for c in features])
    return df.select(F.col(id_col).alias("id"), v.alias("v"))


def block_pairs(points: DataFrame, n_blocks: int, extra: list[str] = ()) -> DataFrame:
    """Replicate each point to the groups (bi, bj) of its block's pairs."""
    b = F.pmod(F.xxhash64(F.col("id"), F.lit(7)), F.lit(n_blocks)).cast("int")
    j = F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("_j")
    return (points.select("id", "v", *extra, b.alias("blk"), j)
            .select("id", "v", *extra, "blk",
                    F.least("blk", "_j").alias("bi"), F.greatest("blk", "_j").alias("bj")))


#: Blocks of a point table, and the most rows of a block.
BLOCKS, MOST_ROWS = 12, 65_536


def block_rows_for(n: int, block_rows: int) -> int:
    """Rows of a block: ``block_rows`` or more, so that there are about ``BLOCKS``."""
    return max(block_rows, min(MOST_ROWS, math.ceil(n / BLOCKS)))


def n_blocks_for(n: int, block_rows: int) -> int:
    return max(1, math.ceil(n / block_rows_for(n, block_rows)))


def pieces(n: int, rows: int) -> list[slice]:
    """Slices of ``rows`` rows each that cover n rows."""
    return [slice(at, min(at + rows, n)) for at in range(0, n, rows)]


#: Squared distances below this share of the squared norms are taken from differences.
NEAR = 1e-6


def _sqdist(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    na, nb = (a * a).sum(1), (b * b).sum(1)
    d = a @ b.T
    d *= -2.0
    d += na[:, None]
    d += nb[None, :]
    if d.size:
        row, col = np.nonzero(d < NEAR * (na.max() + nb.max()))
        for at in pieces(len(row), 65_536):
            diff = a[row[at]] - b[col[at]]
            d[row[at], col[at]] = (diff * diff).sum(1)
    return d


def _repeated(d: np.ndarray, times: np.ndarray, limit: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` smallest of each row of ``d``, a column counting ``times`` times, as far as
    they lie below ``limit``; infinite where there are fewer."""
    near = d < limit
    if d.shape[1] > k:
        near &= d <= np.partition(d, k - 1, axis=1)[:, k - 1:k]
    row, col = np.nonzero(near)
    value = d[row, col]
    order = np.lexsort((value, row))
    row, value, many = row[order], value[order], times[col[order]]
    ends = np.cumsum(many)
    first = np.searchsorted(row, np.arange(len(d)))
    before = ends - many  # copies ahead of each, less those of other rows
    before -= np.append(before, 0)[first][row]
    many = np.clip(k - before, 0, many)
    out = np.full((len(d), k), np.inf)
    at, value, before = np.repeat(row, many), np.repeat(value, many), np.repeat(before, many)
    out[at, before + np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many)] = value
    return out


class Nearest:
    """The ``k`` smallest distances of each of ``rows`` points, fed piece by piece."""

    def __init__(self, rows: int, k: int):
        self.best = np.full((rows, k), np.inf)  # the k-th smallest is the last of a row

    def add(self, own: slice, d: np.ndarray, times: np.ndarray | None = None) -> None:
        """``d``: distances of the rows ``own`` to others, each there ``times`` times."""
        best = self.best[own]
        k = best.shape[1]
        if times is not None and (times > 1).any():
            d = _repeated(d, times, best[:, -1:], k)
        near = d < best[:, -1:]
        hits = near.sum(1)
        most = int(hits.max()) if hits.size else 0
        if not most:
            return
        if 4 * most < d.shape[1]:
            row, col = np.nonzero(near)
            few = np.full((len(d), most), np.inf)
            few[row, np.arange(len(row)) - np.repeat(np.cumsum(hits) - hits, hits)] = d[row, col]
            d = few
        self.best[own] = np.partition(np.concatenate([best, d], axis=1), k - 1, axis=1)[:, :k]

    def lists(self) -> list[np.ndarray]:
        """Ascending distances of each row, fewer than ``k`` where there are no more."""
        best = np.sort(self.best, axis=1)
        size = np.isfinite(best).sum(1)
        return [row[:n] for row, n in zip(best, size)]


def _matrix(v: pd.Series) -> np.ndarray:
    return np.stack(v.to_numpy()) if len(v) else np.zeros((0, 1))


def _times(pdf: pd.DataFrame, k: int) -> np.ndarray | None:
    """How often each point counts, as far as that matters for ``k`` neighbours."""
    return np.minimum(pdf["m"].to_numpy(np.int64), k) if "m" in pdf else None


def _cut(times: np.ndarray | None, at: slice) -> np.ndarray | None:
    return None if times is None else times[at]


def _tile_topk(k: int, rows: int = DEFAULT_BLOCK_ROWS):
    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        bi, bj = int(pdf["bi"].iloc[0]), int(pdf["bj"].iloc[0])
        left = pdf[pdf["blk"] == bi]
        right = left if bi == bj else pdf[pdf["blk"] == bj]
        if not len(left) or not len(right):
            return pd.DataFrame({"id": [], "d": [], "bj": []})
        xl, xr, ml, mr = _matrix(left["v"]), _matrix(right["v"]), _times(left, k), _times(right, k)
        to_right, to_left = Nearest(len(left), k), Nearest(len(right), k)
        for i in pieces(len(left), rows):
            for j in pieces(len(right), rows):
                if bi == bj and j.start < i.start:
                    continue
                d = _sqdist(xl[i], xr[j])
                if bi == bj and i == j:
                    np.fill_diagonal(d, 0.0)
                to_right.add(i, d, _cut(mr, j))
                if bi != bj:
                    to_left.add(j, np.ascontiguousarray(d.T), _cut(ml, i))
                elif i != j:
                    to_right.add(j, np.ascontiguousarray(d.T), _cut(ml, i))
        # other: the block that the distances go to
        out_ids, out_d, other = list(left["id"]), to_right.lists(), [bj] * len(left)
        if bi != bj:
            out_ids += list(right["id"]); out_d += to_left.lists(); other += [bi] * len(right)
        return pd.DataFrame({"id": out_ids, "d": out_d, "bj": other})
    return fn


def merge_topk(parts: DataFrame, k: int, span: int, fan_in: int = 32) -> DataFrame:
    """Merge per-point sorted lists ``d``, one for each block ``bj`` in 0..span-1;
    a group holds at most ``fan_in`` lists."""
    level = parts
    width = span
    bucket = F.col("bj")
    while True:
        if width <= fan_in:
            return (level.groupBy("id")
                    .agg(F.slice(F.array_sort(F.flatten(F.collect_list("d"))), 1, k)
                         .alias("d")))
        level = (level.groupBy("id", (bucket / F.lit(fan_in)).cast("int").alias("bj"))
                 .agg(F.slice(F.array_sort(F.flatten(F.collect_list("d"))), 1, k)
                      .alias("d")))
        width = math.ceil(width / fan_in)


def _tile_guest_topk(k: int, rows: int = DEFAULT_BLOCK_ROWS):
    """The k nearest own points of each guest, within its bound."""
    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        own, guests = pdf[~pdf["late"]], pdf[pdf["late"]]
        if not len(own) or not len(guests):
            return pd.DataFrame({"id": [], "d": [], "slot": []})
        xg, xo, times = _matrix(guests["v"]), _matrix(own["v"]), _times(own, k)
        nearest = Nearest(len(guests), k)
        for i in pieces(len(guests), rows):
            for j in pieces(len(own), rows):
                nearest.add(i, _sqdist(xg[i], xo[j]), _cut(times, j))
        limit = guests["bound"].to_numpy() ** 2 * (1 + 1e-6) + 1e-12
        lists = [row[:np.searchsorted(row, top, "right")] for row, top in zip(nearest.lists(), limit)]
        slot = hash((int(pdf["cell"].iat[0]), int(pdf["first"].iat[0]))) % SLOTS
        out = pd.DataFrame({"id": guests["id"].to_numpy(), "d": lists, "slot": slot})
        return out[out["d"].str.len() > 0]
    return fn


SLOTS = 4_096
#: Points of a cell, and the most cells.
CELL_ROWS, MAX_CELLS = 8_192, 1_024


def knn_distances(points: DataFrame, k: int, block_rows: int = DEFAULT_BLOCK_ROWS,
                  n: int | None = None, cell_rows: int = CELL_ROWS) -> DataFrame:
    """(id, d): the ``k`` smallest squared distances of each point, the point
    itself (distance 0) included, ascending.

    A column ``m``, if there is one, tells how many points each row stands for."""
    n = n if n is not None else points.count()
    points = points.select("id", "v", *[c for c in points.columns if c == "m"])
    times = points.columns[2:]
    cells = min(MAX_CELLS, math.ceil(n / cell_rows))
    rows = block_rows_for(n, block_rows)
    passes = _knn_passes(points, k, block_rows, cells, rows) if cells > 1 else None
    if passes is None:  # one cell, or bounds that reach most cells: all block pairs
        nb = n_blocks_for(n, block_rows)
        tiles = block_pairs(points, nb, times).groupBy("bi", "bj").applyInPandas(
            _tile_topk(k, block_rows), "id long, d array<double>, bj int")
        return merge_topk(tiles, k, nb)
    inner, bounded, guests, own_blocks = passes
    sizes = F.broadcast(guests.groupBy("cell").agg(F.count("*").alias("_guests")))  # MAX_CELLS rows
    both = (bounded.select("id", "v", *times, "cell", F.lit(None).cast("double").alias("bound"),
                           F.lit(False).alias("guest"))
            .unionByName(guests.withColumn("guest", F.lit(True)), allowMissingColumns=True)
            .join(sizes, "cell"))
    far = (deal(both, own_blocks, blocks(F.col("_guests"), rows), inner=False)
           .groupBy("cell", "first", "second")
           .applyInPandas(_tile_guest_topk(k, block_rows), "id long, d array<double>, slot int"))
    lists = inner.select("id", "d", F.lit(0).alias("bj")).unionByName(
        far.select("id", "d", F.col("slot").alias("bj")))
    return merge_topk(lists, k, SLOTS)


def _knn_passes(points: DataFrame, k: int, block_rows: int, cells: int, rows: int,
                always: bool = False):
    """(lists within cells, points with bounds, guests, blocks per cell as a column),
    or, unless ``always``, None where all block pairs would copy the points less often."""
    from sessionary.session import materialize
    pts = materialize(points)
    pivots = Pivots(pts, cells)
    assigned = materialize(pivots.assign(pts))
    count, radius = pivots.figures(assigned)
    per_cell = [math.ceil(c / rows) for c in count]
    own_blocks = F.element_at(F.array(*[F.lit(b) for b in per_cell]), F.col("cell") + 1)
    times = points.columns[2:]
    dealt = deal(assigned.select("id", "v", *times, "cell", F.lit(False).alias("guest")), own_blocks,
                 F.lit(0))
    tiles = (dealt.withColumn("blk", F.when(F.col("late"), F.col("second")).otherwise(F.col("first")))
             .withColumnRenamed("first", "bi").withColumnRenamed("second", "bj")
             .groupBy("cell", "bi", "bj").applyInPandas(_tile_topk(k, block_rows),
                                                        "id long, d array<double>, bj int"))
    inner = materialize(merge_topk(tiles, k, max(per_cell)))
    kth = inner.select("id", F.sqrt(F.get("d", F.lit(k - 1))).alias("kth"))
    kept = ["id", "v", *times, "cell", "bound"]

    def bound(batches):
        for pdf in batches:
            x = np.stack(pdf["v"].to_numpy()) if len(pdf) else np.zeros((0, pivots.pivots.shape[1]))
            rim = pivots.reach(x, k, count, radius)
            yield pdf.assign(bound=np.fmin(pdf["kth"].to_numpy(float), rim))[kept]
    bounded = materialize(assigned.join(kth, "id").select("id", "v", *times, "cell", "kth").mapInPandas(
        bound, f"id long, v array<double>, {''.join(f'{c} long, ' for c in times)}cell int, bound double"))
    found = visits(pivots, bounded.drop(*times), count, radius)
    if not always:  # a row per cell reaches the driver, before the guests are written
        sent = {r["cell"]: r["count"] for r in found.groupBy("cell").count().collect()}
        copies = sum(g * per_cell[c] + int(count[c]) * math.ceil(g / rows) for c, g in sent.items())
        if copies > sum(count) * n_blocks_for(sum(count), block_rows):
            return None
    return inner, bounded, materialize(found), own_blocks


def knn_replication(points: DataFrame, k: int, block_rows: int = DEFAULT_BLOCK_ROWS,
                    cell_rows: int = CELL_ROWS) -> DataFrame:
    """(points, cells, visits, factor): how many cells a point visits, its own included."""
    n = points.count()
    cells = min(MAX_CELLS, math.ceil(n / cell_rows))
    visited = _knn_passes(points.select("id", "v"), k, block_rows, cells,
                          block_rows_for(n, block_rows), True)[2].count() if cells > 1 else 0
    return points.sparkSession.createDataFrame(
        [(n, cells, n + visited, (n + visited) / max(1, n))],
        "points long, cells int, visits long, factor double")


def k_distances(points: DataFrame, k: int, block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Per point the distance to its k-th neighbour, the point itself
    counted (as a flat L2 index search does); NULL when there are fewer than k
    points.  Output (id, distance_sq, distance); :func:`k_distance_curve` gives
    the sorted curve."""
    kd = knn_distances(points, k, block_rows).select(
        "id", F.get("d", F.lit(k - 1)).alias("distance_sq"))
    return kd.select("id", "distance_sq", F.sqrt("distance_sq").alias("distance"))


def k_distance_curve(points: DataFrame, k: int | None = None, tail: int | None = 20,
                     block_rows: int = DEFAULT_BLOCK_ROWS, dims: int | None = None) -> DataFrame:
    """The k-distance curve with ``k = 2 * dims``; ``tail`` keeps the last
    points (the elbow), ``None`` the whole curve.  Output (rank, distance_sq,
    distance); ranks are 1-based positions of the ascending curve."""
    if k is None:
        dims = dims or len(points.select("v").first()["v"])
        k = 2 * dims
    from sessionary.session import materialize
    # the quadratic part runs once; the tail and the count read the table
    kd = materialize(knn_distances(points, k, block_rows).select(
        "id", F.get("d", F.lit(k - 1)).alias("distance_sq")))
    if tail is not None:
        top = kd.orderBy(F.desc("distance_sq"), F.desc("id")).limit(tail)
        n = kd.count()
        from pyspark.sql import Window
        w = Window.orderBy(F.desc("distance_sq"), F.desc("id"))
        # the tail holds ``tail`` rows: a single small window is fine here
        return top.select((F.lit(n + 1) - F.row_number().over(w)).alias("rank"),
                          "distance_sq", F.sqrt("distance_sq").alias("distance"))
    from sessionary.operators.graph import global_rank
    ranked = global_rank(kd, ["distance_sq", "id"], "rank")  # equal distances spread by id
    return ranked.select("rank", "distance_sq", F.sqrt("distance_sq").alias("distance"))


# ------------------------------------------------------------------ silhouette

def _tile_label_sums(rows: int = DEFAULT_BLOCK_ROWS):
    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        bi, bj = int(pdf["bi"].iloc[0]), int(pdf["bj"].iloc[0])
        left = pdf[pdf["blk"] == bi]
        right = left if bi == bj else pdf[pdf["blk"] == bj]
        if not len(left) or not len(right):
            return pd.DataFrame({"id": [], "label": [], "other": [], "s": [], "c": []})
        found = []
        sides = [(left, right)] if bi == bj else [(left, right), (right, left)]
        known = [np.unique(dst["label"].to_numpy(), return_inverse=True) for _, dst in sides]
        member = [(at[:, None] == np.arange(len(labels))).astype(float) for labels, at in known]
        sums = [np.zeros((len(src), len(labels))) for (src, _), (labels, _) in zip(sides, known)]
        xl, xr = _matrix(left["v"]), _matrix(right["v"])
        for i in pieces(len(left), rows):
            for j in pieces(len(right), rows):
                d = np.sqrt(_sqdist(xl[i], xr[j]))
                if bi == bj and i == j:
                    np.fill_diagonal(d, 0.0)
                sums[0][i] += d @ member[0][j]
                if bi != bj:
                    sums[1][j] += d.T @ member[1][i]
        for (src, _), (labels, _), of, s in zip(sides, known, member, sums):
            for at, lab in enumerate(labels):
                found.append(pd.DataFrame({"id": src["id"].to_numpy(), "label": src["label"].to_numpy(),
                                           "other": lab, "s": s[:, at], "c": int(of[:, at].sum())}))
        return pd.concat(found, ignore_index=True)
    return fn


def silhouette_samples(points: DataFrame, block_rows: int = DEFAULT_BLOCK_ROWS,
                       n: int | None = None) -> DataFrame:
    """Per point (id, label, a, b, s) with exact Euclidean distances.

    ``points``: (id, v, label).  a = mean distance to the other members of
    its cluster, b = smallest mean distance to another cluster, s = (b - a) /
    max(a, b); s = 0 for a point alone in its cluster.
    """
    n = n if n is not None else points.count()
    nb = n_blocks_for(n, block_rows)
    pairs = block_pairs(points, nb, extra=["label"])
    label_type = points.schema["label"].dataType.simpleString()
    tiles = pairs.groupBy("bi", "bj").applyInPandas(
        _tile_label_sums(block_rows),
        f"id long, label {label_type}, other {label_type}, s double, c long")
    per = tiles.groupBy("id", "label", "other").agg(F.sum("s").alias("s"),
                                                    F.sum("c").alias("c"))
    same = F.col("label") == F.col("other")
    agg = per.groupBy("id", "label").agg(
        F.max(F.when(same, F.try_divide(F.col("s"), F.col("c") - 1))).alias("a"),
        F.max(F.when(same, F.col("c"))).alias("size"),
        F.min(F.when(~same, F.col("s") / F.col("c"))).alias("b"))
    s = F.when(F.col("size") <= 1, F.lit(0.0)).otherwise(
        (F.col("b") - F.col("a")) / F.greatest("a", "b"))
    return agg.select("id", "label", "a", "b", s.alias("s"))


#: Most clusters whose centres a task holds.
MOST_CLUSTERS = 16_384


def _cluster_figures(groups: DataFrame, dims: int) -> pd.DataFrame:
    """(label, n, spread, c0, c1, ...): size, mean squared distance from the centre, centre
    of every cluster (a row per cluster reaches the driver)."""
    v = [F.get("v", F.lit(k)) for k in range(dims)]
    sums = groups.groupBy("label").agg(
        F.sum("m").alias("n"), F.sum(F.col("m") * F.aggregate("v", F.lit(0.0), lambda t, x: t + x * x)).alias("q"),
        *[F.sum(F.col("m") * x).alias(f"c{k}") for k, x in enumerate(v)]).orderBy("label").toPandas()
    centres = sums[[f"c{k}" for k in range(dims)]].to_numpy(float) / sums["n"].to_numpy(float)[:, None]
    spread = np.maximum(sums["q"].to_numpy(float) / sums["n"].to_numpy(float) - (centres ** 2).sum(1), 0.0)
    return pd.concat([sums[["label", "n"]], pd.DataFrame({"spread": spread}),
                      pd.DataFrame(centres, columns=[f"c{k}" for k in range(dims)])], axis=1)


def _cluster_visits(groups: DataFrame, figures: pd.DataFrame) -> DataFrame:
    """(id, v, m, home, cell, guest): each point in its own cluster and as a guest of those
    others that can have the smallest mean distance.

    A point's mean distance to a cluster is at least its distance to the centre and at
    most the root of that distance squared plus the spread."""
    labels = figures["label"].to_numpy()
    centres = figures.filter(regex=r"^c\d+$").to_numpy(float)
    spread = figures["spread"].to_numpy(float)
    room = 1e-7 * float(1.0 + (centres ** 2).sum(1).max(initial=0.0) + spread.max(initial=0.0)) ** 0.5

    def run(batches):
        for pdf in batches:
            for at in pieces(len(pdf), 1_024):
                own = pdf.iloc[at]
                x, home = _matrix(own["v"]), np.searchsorted(labels, own["label"].to_numpy())
                low2 = np.maximum(_sqdist(x, centres), 0.0)
                high = np.sqrt(low2 + spread)
                every = np.arange(len(x))
                high[every, home] = np.inf
                near = np.sqrt(low2) <= high.min(axis=1, keepdims=True) * (1 + 1e-7) + room
                near[every, home] = False
                row, cell = np.nonzero(near)
                row, cell = np.concatenate([every, row]), np.concatenate([home, cell])
                yield pd.DataFrame({"id": own["id"].to_numpy()[row], "v": own["v"].to_numpy()[row],
                                    "m": own["m"].to_numpy()[row], "home": home[row].astype(np.int32),
                                    "cell": cell.astype(np.int32), "guest": np.arange(len(row)) >= len(x)})
    return groups.mapInPandas(run, "id long, v array<double>, m long, home int, cell int, guest boolean")


def _tile_means(sizes: np.ndarray, rows: int = DEFAULT_BLOCK_ROWS):
    """Part that the block of a cluster has in the mean distances of its members (-1 for
    one alone in its cluster) and its guests."""
    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        whole = bool(pdf["first"].iat[0] == pdf["second"].iat[0])
        left, right = (pdf, pdf) if whole else (pdf[~pdf["late"]], pdf[pdf["late"]])
        xl, xr = _matrix(left["v"]), _matrix(right["v"])
        ml, mr = left["m"].to_numpy(float), right["m"].to_numpy(float)
        to_left = np.zeros(len(left))
        to_right = to_left if whole else np.zeros(len(right))
        both = len(right) > 0 and not right["guest"].iat[0]
        for i in pieces(len(left), rows):
            for j in pieces(len(right), rows):
                if whole and j.start < i.start:
                    continue
                d = np.sqrt(_sqdist(xl[i], xr[j]))
                if whole and i == j:
                    np.fill_diagonal(d, 0.0)
                if both:
                    to_left[i] += d @ mr[j]
                if not whole or i != j:
                    to_right[j] += ml[i] @ d
        out = [(left, to_left)] if both else []
        out += [] if whole else [(right, to_right)]
        found = []
        for side, s in out:
            n = sizes[side["cell"].to_numpy()] - (side["cell"] == side["home"]).to_numpy()
            found.append(side[["id", "m", "home", "cell"]].assign(
                d=np.where(n > 0, s / np.maximum(n, 1), -1.0)))
        return pd.concat(found, ignore_index=True) if found else pd.DataFrame(
            {"id": [], "m": [], "home": [], "cell": [], "d": []})
    return fn


def _silhouette_of_clusters(points: DataFrame, block_rows: int, n: int) -> DataFrame | None:
    """(m, s): silhouettes of the different points of each cluster and how many they stand
    for, or None where all pairs of blocks are less work."""
    from sessionary.session import materialize
    if n <= block_rows or points.select("label").distinct().limit(MOST_CLUSTERS + 1).count() > MOST_CLUSTERS:
        return None
    groups = materialize(points.groupBy("v", "label").agg(F.count("*").alias("m")).select(
        F.monotonically_increasing_id().alias("id"), "v", "m", "label"))
    figures = _cluster_figures(groups, len(groups.select("v").first()["v"]))
    found = materialize(_cluster_visits(groups, figures))
    met = found.groupBy("cell").agg(F.count_if(~F.col("guest")).alias("_own"),
                                    F.count_if("guest").alias("_guests"))
    counts = [(r["_own"], r["_guests"]) for r in met.collect()]  # a row per cluster
    if sum(own * (own / 2 + guests) for own, guests in counts) > n * n / 2:
        return None
    rows = block_rows_for(sum(own + guests for own, guests in counts), block_rows)
    tiles = (deal(found.join(F.broadcast(met), "cell"), blocks(F.col("_own"), rows),
                  blocks(F.col("_guests"), rows)).drop("_own", "_guests")
             .groupBy("cell", "first", "second")
             .applyInPandas(_tile_means(figures["n"].to_numpy(float), block_rows),
                            "id long, m long, home int, cell int, d double"))
    own = F.col("cell") == F.col("home")
    per = (tiles.groupBy("id", "m", "home", "cell").agg(F.sum("d").alias("d"))
           .groupBy("id", "m", "home").agg(F.max(F.when(own, F.col("d"))).alias("a"),
                                           F.min(F.when(~own, F.col("d"))).alias("b")))
    s = F.when(F.col("a") < 0, F.lit(0.0)).when(F.greatest("a", "b") == 0, F.lit(0.0)).otherwise(
        (F.col("b") - F.col("a")) / F.greatest("a", "b"))
    return per.select("m", s.alias("s"))


def silhouette_score(points: DataFrame, noise_label=-1, sample_size: int | None = None,
                     key_seed: int = 0, block_rows: int = DEFAULT_BLOCK_ROWS,
                     distance: str = "euclidean") -> DataFrame:
    """Mean silhouette over non-noise points (one row: n, silhouette).

    ``distance="euclidean"`` (the usual metric) is exact, over every point, and
    quadratic in the sizes of near clusters; a caller may ask for an exact-size hash sample by ``sample_size``.
    ``distance="squaredEuclidean"`` uses Spark ML's ``ClusteringEvaluator``:
    linear in n (per-cluster sums), exact for squared distances - a
    different number, for data too large for the quadratic form.
    """
    if distance == "squaredEuclidean":
        from pyspark.ml.evaluation import ClusteringEvaluator
        from pyspark.ml.functions import array_to_vector
        pts = points.where(F.col("label") != F.lit(noise_label)) if noise_label is not None \
            else points
        data = pts.select(array_to_vector("v").alias("features"),
                          F.col("label").cast("double").alias("prediction"))
        n = data.count()
        value = ClusteringEvaluator(distanceMeasure="squaredEuclidean",
                                    metricName="silhouette").evaluate(data) if n else None
        return points.sparkSession.createDataFrame([(n, value)], "n long, silhouette double")
    if distance != "euclidean":
        raise ValueError(f"unknown distance {distance!r}")
    from sessionary.operators.sampling import H, U, bottom_k, uniform_hash
    pts = points.where(F.col("label") != F.lit(noise_label)) if noise_label is not None \
        else points
    n = pts.count()
    if sample_size is not None and n > sample_size:
        h, u = uniform_hash("id", seed=key_seed)
        rows = pts.withColumn("_g", F.lit(0)).withColumn(H, h).withColumn(U, u)
        tgt = pts.sparkSession.createDataFrame([(0, sample_size, n)], "_g int, _k long, _n long")
        pts = bottom_k(rows, ["_g"], tgt, ["id"]).drop("_g", H, U)
        n = sample_size
    pts = pts.select("id", "v", "label")
    of_clusters = _silhouette_of_clusters(pts, block_rows, n)
    if of_clusters is not None:
        known = F.sum(F.when(F.col("s").isNotNull(), F.col("m")))
        return of_clusters.agg(F.sum("m").alias("n"),
                               F.try_divide(F.sum(F.col("m") * F.col("s")), known).alias("silhouette"))
    ss = silhouette_samples(pts, block_rows, n)
    return ss.agg(F.count(F.lit(1)).alias("n"), F.avg("s").alias("silhouette"))
