"""Embedding near-dedup: exact metric range join with pivots (operator 11).

Vectors link when their cosine reaches ``threshold``; on the unit sphere that is
an angle of at most r.  The join is exact:

* Equal vectors meet first in one weighted row (map-side combined), so a vector
  that a third of all rows share is one row from then on.
* Pivots: farthest-first choice from a bounded sample by hash.  A vector belongs
  to the cell of its nearest pivot.
* Boundary replication: a vector y of cell b is sent to cell a < b only if the
  triangle inequality leaves room for a link there: y lies within the chord of r
  of the hyperplane between the two pivots, and within r of the ball that holds
  all of cell a.  So every linked pair meets in exactly one cell.
* Vectors within r / 2 of their pivot are linked to each other by the triangle
  inequality: they are counted without any comparison, however many they are.
* Cells join independently; a large cell is dealt into blocks, and pairs of
  blocks are tasks of bounded size (matrix products in single precision find
  candidates, double precision decides).  A task returns link counts per vector
  and a spanning forest, never pairs; distributed connected components join the
  forests.

In many dimensions without structure the triangle inequality rules out little;
then most vectors visit most cells, and the work is that of all block pairs.
The driver sees the sample and one row per cell (at most ``max_cells``).

Defined results: vectors that are null, empty, zero or hold null or non-finite
components link with nothing (0 links, their own component); vectors of
different lengths never link; repeated rows are vectors of their own that link
with each other; a null vec_id links too but never names a component (a group
without ids has a null component and is not kept); an empty table gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionary.operators.graph import connected_components
from sessionary.session import materialize

THRESHOLD = 0.9
CELL_ROWS = 2_048
BLOCK_ROWS = 4_096
GUEST_ROWS = 16_384
MAX_CELLS = 1_024
SAMPLE_ROWS = 4_096
_ROWS_AT_ONCE = 512
#: Room for rounding: angles near 0 are good to about 1e-8, single-precision cosines to 1e-5.
_SLACK, _COARSE = 1e-6, 1e-4


def usable(vector: Column) -> Column:
    """Whether a vector has a direction: finite components, not all zero."""
    # comparisons, since NaN counts as larger than every number
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit_rows(column: pa.Array, length: int) -> np.ndarray:
    """Unit vectors (double precision) of an Arrow list column of one length."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, length)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow in the squares
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _lengths(column: pa.Array) -> np.ndarray:
    return column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)


def _angles(cosines: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosines, -1.0, 1.0))


class Pivots:
    """Pivots by vector length, numbered over all lengths."""

    def __init__(self, sample: pa.Array, cells: int, threshold: float):
        self.angle = float(np.arccos(threshold))
        self.chord = float(np.sqrt(2 - 2 * threshold))
        self.by_length: dict[int, tuple[int, np.ndarray]] = {}
        lengths, first = _lengths(sample), 0
        for length in np.unique(lengths).tolist():
            own = np.flatnonzero(lengths == length)
            x = unit_rows(sample.take(pa.array(own)), length)
            share = max(1, round(cells * len(own) / len(lengths)))
            chosen = self._farthest_first(x, min(share, max(1, cells - first)))
            self.by_length[length] = (first, x[chosen])
            first += len(chosen)
            if first >= cells:
                break
        self.cells = first

    @staticmethod
    def _farthest_first(x: np.ndarray, k: int) -> list[int]:
        chosen, nearest = [0], x @ x[0]
        while len(chosen) < min(k, len(x)):
            at = int(np.argmin(nearest))
            if nearest[at] > 1 - 1e-9:
                break
            chosen.append(at)
            nearest = np.maximum(nearest, x @ x[at])
        return chosen

    def own_cell(self, vectors: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(cell, angle to its pivot); -1 and 0 where no pivot has the vector's length."""
        cell, angle = np.full(len(vectors), -1, np.int32), np.zeros(len(vectors))
        lengths = _lengths(vectors)
        for length in np.unique(lengths).tolist():
            if length in self.by_length:
                at = np.flatnonzero(lengths == length)
                first, pivots = self.by_length[length]
                cosines = unit_rows(vectors.take(pa.array(at)), length) @ pivots.T
                best = cosines.argmax(axis=1)
                cell[at], angle[at] = first + best, _angles(cosines[np.arange(len(at)), best])
        return cell, angle

    def guests(self, vectors: pa.Array, cell: np.ndarray, radius: np.ndarray
               ) -> tuple[np.ndarray, np.ndarray]:
        """(row, cell) pairs: the lower cells in which a vector can have links."""
        rows, cells = [], []
        lengths = _lengths(vectors)
        for length, (first, pivots) in self.by_length.items():
            at = np.flatnonzero((lengths == length) & (cell >= 0))
            if not len(at):
                continue
            cosines = unit_rows(vectors.take(pa.array(at)), length) @ pivots.T
            own = cell[at] - first
            best = cosines[np.arange(len(at)), own]
            apart = np.sqrt(np.maximum(2 - 2 * (pivots @ pivots.T), 0))
            room = (best[:, None] - cosines <= self.chord * apart[own] + _SLACK) \
                & (_angles(cosines) <= radius[first:first + len(pivots)] + self.angle + _SLACK) \
                & (np.arange(len(pivots))[None, :] < own[:, None])
            x, y = np.nonzero(room)
            rows.append(at[x])
            cells.append(first + y)
        none = [np.empty(0, np.int64)]
        return np.concatenate(rows or none), np.concatenate(cells or none)


def _assigned(pivots: Pivots):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, angle = pivots.own_cell(batch.column("v"))
            core = (cell >= 0) & (angle <= pivots.angle / 2 - _SLACK)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell), pa.array(angle), pa.array(core)],
                names=[*batch.schema.names, "cell", "angle", "core"])
    return run


def _guest_counts(pivots: Pivots, radius: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        times = np.zeros(pivots.cells, np.int64)
        for batch in batches:
            _, cells = pivots.guests(batch.column("v"), batch.column("cell").to_numpy(), radius)
            times += np.bincount(cells, minlength=pivots.cells)
        at = np.flatnonzero(times)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(times[at])],
                                         names=["cell", "n"])
    return run


def _dealt(pivots: Pivots, radius: np.ndarray, core_blocks: np.ndarray, own_blocks: np.ndarray,
           guest_blocks: np.ndarray):
    """Rows for every block pair (cell, first, second) that a vector takes part in.

    Entry -1 of the arrays is the cell of lengths without a pivot.  Blocks count
    from the core ones over the other own ones to the guests' ones.
    """
    def tiles(batch: pa.RecordBatch) -> Iterator[tuple]:
        cell = batch.column("cell").to_numpy()
        core = batch.column("core").to_numpy(zero_copy_only=False)
        deal = batch.column("deal").to_numpy()
        inner, every = core_blocks[cell], own_blocks[cell]
        block = np.where(core, deal % np.maximum(inner, 1),
                         inner + deal % np.maximum(every - inner, 1))
        for other in range(int((own_blocks + guest_blocks).max(initial=0))):
            at = np.flatnonzero((other < every + guest_blocks[cell])
                                & ~((block < inner) & (other < inner)))
            yield (at, cell[at], np.minimum(block[at], other), np.maximum(block[at], other),
                   block[at] > other)
        rows, cells = pivots.guests(batch.column("v"), cell, radius)
        block = own_blocks[cells] + deal[rows] % np.maximum(guest_blocks[cells], 1)
        for other in range(int(own_blocks.max(initial=0))):
            at = np.flatnonzero(other < own_blocks[cells])
            yield (rows[at], cells[at], np.full(len(at), other), block[at],
                   np.ones(len(at), bool))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, cell, first, second, late in tiles(batch):
                for k in range(0, len(rows), _ROWS_AT_ONCE * 8):
                    cut = slice(k, k + _ROWS_AT_ONCE * 8)
                    own = batch.take(pa.array(rows[cut]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cell[cut], pa.int32()), pa.array(first[cut], pa.int32()),
                         pa.array(second[cut], pa.int32()), pa.array(late[cut]),
                         own.column("key"), own.column("v"), own.column("weight")],
                        names=["cell", "first", "second", "late", "key", "v", "weight"])
    return run


def _joined(label: np.ndarray, own: int, linked: np.ndarray) -> None:
    """Joins the components of ``own`` and ``linked`` under their smallest label."""
    roots = np.unique(np.append(label[linked], label[own]))
    if len(roots) > 1:
        label[np.isin(label, roots)] = roots[0]


def block_links(x: np.ndarray, y: np.ndarray | None, x_weight: np.ndarray,
                y_weight: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(linked weight, label) of the rows of ``x`` and then of ``y``.

    Without ``y`` the rows of ``x`` are compared with each other.  Rows with equal
    labels are in one component; a label is its smallest row.
    """
    within = y is None
    y = x if within else y
    shift = 0 if within else len(x)
    total = np.zeros(len(x) + (0 if within else len(y)))
    label = np.arange(len(total))
    coarse = y.astype(np.float32).T.copy()
    for at in range(0, len(x), _ROWS_AT_ONCE):
        part = x[at:at + _ROWS_AT_ONCE]
        near = part.astype(np.float32) @ coarse >= threshold - _COARSE
        if within:
            near[np.arange(len(part)), at + np.arange(len(part))] = False
        rows, cols = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
        if not len(rows):
            continue
        linked = part[rows] @ y[cols].T >= threshold
        if within:
            linked &= rows[:, None] + at != cols[None, :]
        total[at + rows] += linked @ y_weight[cols]
        if not within:
            total[shift + cols] += x_weight[at + rows] @ linked
        for k in np.flatnonzero(linked.any(axis=1)):
            _joined(label, at + int(rows[k]), shift + cols[linked[k]])
    return total, label


def _tile(threshold: float):
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        late = rows["late"].to_numpy()
        rows = rows.take(pa.array(np.argsort(late, kind="stable")))
        within = rows["first"][0] == rows["second"][0]
        late = np.sort(late)
        vectors = rows["v"].combine_chunks()
        lengths = _lengths(vectors)
        weight = rows["weight"].to_numpy().astype(np.float64)
        total, root = np.zeros(len(late)), np.arange(len(late))
        for length in np.unique(lengths).tolist():
            one, two = (np.flatnonzero((lengths == length) & (late == side)) for side in (False, True))
            if not len(one) or not (within or len(two)):
                continue
            both = np.concatenate([one, two])
            x = unit_rows(vectors.take(pa.array(both)), length)
            found, label = block_links(x[:len(one)], None if within else x[len(one):],
                                       weight[one], weight[two], threshold) if not within else \
                block_links(x, None, weight[both], weight[both], threshold)
            total[both], root[both] = found, both[label]
        at = np.flatnonzero(total > 0)
        keys = rows["key"].combine_chunks()
        return pa.table({"key": keys.take(pa.array(at)), "links": pa.array(total[at].astype(np.int64)),
                         "root": keys.take(pa.array(root[at]))})
    return run


def _cell_figures(assigned: DataFrame, cells: int) -> dict[str, np.ndarray]:
    """Rows, core rows and radius by cell; the last entry is the cell without a pivot."""
    out = {"rows": np.zeros(cells + 1, np.int64), "core": np.zeros(cells + 1, np.int64),
           "radius": np.zeros(cells + 1)}
    for r in assigned.groupBy("cell").agg(
            F.count("*").alias("rows"), F.sum(F.col("core").cast("int")).alias("core"),
            F.max("angle").alias("radius")).collect():
        for name in out:
            out[name][r["cell"]] = r[name]
    return out


def class_links(classes: DataFrame, threshold: float = THRESHOLD, cell_rows: int = CELL_ROWS,
                block_rows: int = BLOCK_ROWS, guest_rows: int = GUEST_ROWS,
                max_cells: int = MAX_CELLS) -> DataFrame:
    """(key, links, root) of different vectors (key, v, weight).

    A key can have several rows: linked weights to be added up, and roots that
    join its components.
    """
    spark = classes.sparkSession
    sample = classes.select("key", "v").orderBy("key").limit(SAMPLE_ROWS).toArrow()
    cells = min(max_cells, -(-classes.count() // cell_rows))
    pivots = Pivots(sample["v"].combine_chunks(), cells, threshold)
    kind = classes.schema["v"].dataType.simpleString()
    assigned = materialize(classes.mapInArrow(
        _assigned(pivots), f"key string, v {kind}, weight bigint, cell int, angle double, core boolean"))
    figures = _cell_figures(assigned, pivots.cells)
    radius = figures["radius"][:pivots.cells]
    guests = np.zeros(pivots.cells + 1, np.int64)
    for r in assigned.select("v", "cell").mapInArrow(
            _guest_counts(pivots, radius), "cell int, n bigint").groupBy("cell").agg(
            F.sum("n").alias("n")).collect():
        guests[r["cell"]] = r["n"]
    blocks = lambda rows, size: -(-rows // size)
    inner = blocks(figures["core"], block_rows)
    every = inner + blocks(figures["rows"] - figures["core"], block_rows)
    dealt = assigned.withColumn("deal", F.pmod(F.xxhash64("key"), F.lit(1 << 30))).mapInArrow(
        _dealt(pivots, radius, inner, every, blocks(guests, guest_rows)),
        f"cell int, first int, second int, late boolean, key string, v {kind}, weight bigint")
    met = dealt.groupBy("cell", "first", "second").applyInArrow(
        _tile(threshold), "key string, links bigint, root string")
    # within r / 2 of the pivot: all linked with each other, counted without comparing
    cores = assigned.where("core")
    hubs = cores.groupBy("cell").agg(F.sum("weight").alias("all"), F.min("key").alias("root"))
    return met.unionByName(cores.join(F.broadcast(hubs), "cell").select(
        "key", (F.col("all") - F.col("weight")).alias("links"), "root"))


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    threshold: float = THRESHOLD, **sizes) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of ``vectors``."""
    if not 0 < threshold <= 1:
        raise ValueError("the threshold must lie in (0, 1]")
    v = F.col(f"`{vector_col}`")
    if vectors.select(v).schema[0].dataType.simpleString() not in ("array<float>", "array<double>"):
        v = v.cast("array<double>")
    rows = vectors.select(F.col(f"`{id_col}`").cast("bigint").alias("vec_id"), v.alias("v"))
    rows = rows.select("vec_id", "v", F.when(usable(F.col("v")), F.md5(F.concat_ws(
        ",", F.col("v").cast("array<string>")))).alias("key"))
    classes = materialize(rows.where("key IS NOT NULL").groupBy("key").agg(
        F.first("v").alias("v"), F.count("*").alias("weight"), F.min("vec_id").alias("least")))
    met = materialize(class_links(classes.select("key", "v", "weight"), threshold, **sizes))
    joined = connected_components(met.where("key != root").select(
        F.col("key").alias("src"), F.col("root").alias("dst")))
    part = classes.select("key", "least").join(
        joined.withColumnRenamed("node", "key"), "key").select("key", "component", "least")
    part = part.join(part.groupBy("component").agg(F.min("least").alias("top")), "component")
    summed = (classes.select("key", "weight", "least")
              .join(met.groupBy("key").agg(F.sum("links").alias("links")), "key", "left")
              .join(part.select("key", "top"), "key", "left")
              .select("key", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                      F.coalesce("top", "least").alias("component_id")))
    out = rows.select("vec_id", "key").join(summed, "key", "left")
    own = F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
                      own.alias("component_id"),
                      F.coalesce(F.col("vec_id") == own, F.lit(False)).alias("kept"))
