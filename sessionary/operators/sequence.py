"""Ordered per-key sequences as one segmented prefix scan.

Sessionization and the visitor flags need, per key and in order, neighbouring
rows, running sums and counts of breaks.  A window per key puts all rows of a
key into one task, and a crawler may own a third of them.  The scan has one plan
for every key, hot or not:

1. **Sort.** Rows are range-partitioned and sorted on (key, order); Spark samples
   the bounds, so a hot key simply spans several partitions of equal size.
2. **Local scan.** Every partition computes its columns with vectorised Arrow and
   numpy code as if it were alone, and one *carry record*: its first and last
   rows, the sums and counts of its last key, and the last value of each class.
   Rows and records are written once as a table in the shared folder, so later
   reads see the same partitions.
3. **Carry scan.** The records (one per partition) are combined in order.
4. **Map.** Each row takes what the rows before (or after) its partition add:
   plain column expressions over a broadcast of one row per partition.

So all rows are shuffled once.  The order columns must form a total order within
a key (add a unique tie-breaker such as ``event_id``).
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionary.session import materialize

PART, CARRY = "_part", "_carry"
_AT, _LEFT, _FIRST, _LAST = "_at", "_left", "_in_first", "_in_last"


@dataclass(frozen=True)
class Scan:
    """Columns to compute along each key's rows.

    ``lags`` / ``leads``: {name: (column, rows)}.  ``class_lags``: {name: (column,
    class column)}: the value in the key's previous row of the same class.
    ``breaks``: {break: (column, limit)}: a row starts a new segment when the
    (integer) column exceeds its value in the row before by more than the limit;
    a null on either side is no break.
    ``numbers``: {name: break}: 0-based number of the row's segment.
    ``sums``: {name: (integer column, break or None)}: sum over the rows of the
    segment (or of the key) so far, the row included.
    ``ends``: {name: break}: whether the row is the last of its segment.
    """

    lags: dict[str, tuple[str, int]] = field(default_factory=dict)
    leads: dict[str, tuple[str, int]] = field(default_factory=dict)
    class_lags: dict[str, tuple[str, str]] = field(default_factory=dict)
    breaks: dict[str, tuple[str, float]] = field(default_factory=dict)
    numbers: dict[str, str] = field(default_factory=dict)
    sums: dict[str, tuple[str, str | None]] = field(default_factory=dict)
    ends: dict[str, str] = field(default_factory=dict)

    @property
    def behind(self) -> int:
        """Rows before a partition that its rows may look at."""
        return max([1, *(n for _, n in self.lags.values())])

    @property
    def ahead(self) -> int:
        return max([1, *(n for _, n in self.leads.values())])

    @property
    def looked_at(self) -> list[str]:
        """Columns whose values travel in carry records."""
        return sorted({c for c, _ in [*self.lags.values(), *self.leads.values(), *self.breaks.values()]})

    def fields(self, schema: T.StructType) -> list[T.StructField]:
        """The scan's own columns after the local pass."""
        kind = lambda c: schema[c].dataType
        return [*[T.StructField(n, kind(c)) for n, (c, _) in
                  [*self.lags.items(), *self.leads.items(), *self.class_lags.items()]],
                *[T.StructField(f"_new_{n}", T.BooleanType()) for n in self.class_lags],
                *[T.StructField(f"_number_{b}", T.LongType()) for b in self.breaks],
                *[T.StructField(n, T.LongType()) for n in self.sums],
                *[T.StructField(n, T.BooleanType()) for n in self.ends]]


def _running(amount: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Running sum of ``amount``; ``start`` holds the first row of each row's segment."""
    total = np.cumsum(amount)
    return total - (total - amount)[start]


def _starts(flag: np.ndarray) -> np.ndarray:
    return np.maximum.accumulate(np.where(flag, np.arange(len(flag)), 0))


class LocalScan:
    """A sorted partition scanned as if it were alone."""

    def __init__(self, rows: pa.Table, keys: list[str], scan: Scan):
        self.rows, self.keys, self.scan, n = rows, keys, scan, rows.num_rows
        place = np.arange(n)
        self.head = np.zeros(n, bool)
        self.head[0] = True
        for key in keys:
            column = rows[key].combine_chunks()
            self.head[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
        self.segment = np.cumsum(self.head) - 1
        self.begin = _starts(self.head)
        out: dict[str, pa.Array] = {}
        for name, (column, k) in scan.lags.items():
            out[name] = self._pick(column, place - k, place - k >= self.begin)
        for name, (column, k) in scan.leads.items():
            to = np.minimum(place + k, n - 1)
            out[name] = self._pick(column, to, (place + k < n) & (self.segment[to] == self.segment))
        for name, (column, of) in scan.class_lags.items():
            before = self._same_class(of)
            out[name] = self._pick(column, before, before >= 0)
            out[f"_new_{name}"] = pa.array(before < 0)
        flags = {}
        for name, (column, limit) in scan.breaks.items():
            x = self._numbers(column)
            known = pc.is_valid(rows[column].combine_chunks()).to_numpy(zero_copy_only=False)
            flags[name] = np.append(False, (x[1:] - x[:-1] > limit) & known[1:] & known[:-1]
                                    & ~self.head[1:])
            out[f"_number_{name}"] = pa.array(_running(flags[name].astype(np.int64), self.begin))
        for name, (column, of) in scan.sums.items():
            start = self.begin if of is None else _starts(self.head | flags[of])
            out[name] = pa.array(_running(self._numbers(column), start))
        for name, of in scan.ends.items():
            out[name] = pa.array(np.append((self.head | flags[of])[1:], True))
        out |= {_AT: pa.array(place), _LEFT: pa.array(n - 1 - place),
                _FIRST: pa.array(self.segment == 0), _LAST: pa.array(self.segment == self.segment[-1])}
        self.out = out

    def _numbers(self, column: str) -> np.ndarray:
        return pc.fill_null(self.rows[column].combine_chunks(), 0).to_numpy(zero_copy_only=False).astype(np.int64)

    def _pick(self, column: str, at: np.ndarray, good: np.ndarray) -> pa.Array:
        return self.rows[column].combine_chunks().take(pa.array(np.where(good, at, 0), mask=~good))

    def _same_class(self, of: str) -> np.ndarray:
        """The key's previous row of the same class, or -1."""
        codes = self.rows[of].combine_chunks().dictionary_encode("encode").indices.to_numpy(zero_copy_only=False)
        order = np.lexsort((codes, self.segment))  # stable: rows of a class stay in order
        same = (codes[order][1:] == codes[order][:-1]) & (self.segment[order][1:] == self.segment[order][:-1])
        before = np.full(len(order), -1)
        before[order[1:][same]] = order[:-1][same]
        return before

    def _values(self, columns: list[str], at: list[int]) -> list[tuple]:
        if not columns:
            return [()] * len(at)
        return list(zip(*[self.rows[c].take(pa.array(at, pa.int64())).to_pylist() for c in columns]))

    def record(self) -> dict:
        """What the partitions after (and before) this one need of it."""
        scan, n = self.scan, self.rows.num_rows
        last = range(int(self.begin[-1]), n)
        first = int((self.segment == 0).sum())
        classes = {}
        for name, (column, of) in scan.class_lags.items():
            classes[name] = dict(zip(self.rows[of].slice(last.start).to_pylist(),
                                     self.rows[column].slice(last.start).to_pylist()))
        return {
            "keys": (self._values(self.keys, [0])[0], self._values(self.keys, [n - 1])[0]),
            "whole": first == n,
            "begin": self._values(scan.looked_at, list(range(min(first, scan.ahead)))),
            "end": self._values(scan.looked_at, list(last)[::-1][:scan.behind]),
            "numbers": {b: self.out[f"_number_{b}"][n - 1].as_py() for b in scan.breaks},
            "sums": {s: self.out[s][n - 1].as_py() for s in scan.sums},
            "classes": classes}


def _scanned(keys: list[str], scan: Scan, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        rows = pa.Table.from_batches(held)
        local = LocalScan(rows, keys, scan)
        columns = {**dict(zip(rows.column_names, rows.columns)), **local.out}
        columns[CARRY] = pa.nulls(rows.num_rows, pa.binary())
        table = pa.table({name: columns[name] for name in names})
        yield from table.to_batches(65_536)
        columns = {PART: rows[PART].slice(0, 1).combine_chunks(),
                   CARRY: pa.array([pickle.dumps(local.record())], pa.binary())}
        yield pa.RecordBatch.from_arrays(
            [columns.get(f.name, pa.nulls(1, f.type)) for f in table.schema], schema=table.schema)
    return run


def carry_states(records: list[tuple[int, dict]], scan: Scan) -> list[dict]:
    """Per partition, in order: what its rows take from the partitions around it."""
    out, state, column = [], None, {c: k for k, c in enumerate(scan.looked_at)}

    def breaks(row: tuple, before: tuple) -> dict[str, bool]:
        return {b: None not in (row[column[c]], before[column[c]])
                and row[column[c]] - before[column[c]] > limit
                for b, (c, limit) in scan.breaks.items()}
    for k, (part, own) in enumerate(records):
        same = state is not None and state["key"] == own["keys"][0]
        broken = breaks(own["begin"][0], state["end"][0]) if same else dict.fromkeys(scan.breaks, False)
        ahead, at = [], k + 1
        while len(ahead) < scan.ahead and at < len(records):
            if records[at][1]["keys"][0] != own["keys"][1]:
                break
            ahead += records[at][1]["begin"]
            if not records[at][1]["whole"]:
                break
            at += 1
        broken_after = breaks(ahead[0], own["end"][0]) if ahead else dict.fromkeys(scan.breaks, True)
        out.append({"part": part, "same": same, "state": state if same else None, "broken": broken,
                    "ahead": ahead[:scan.ahead], "broken_after": broken_after})
        new = {"key": own["keys"][1], "end": own["end"], "numbers": own["numbers"], "sums": own["sums"],
               "classes": own["classes"]}
        if same and own["whole"]:
            new["end"] = [*own["end"], *state["end"]][:scan.behind]
            new["numbers"] = {b: n + state["numbers"][b] + broken[b] for b, n in own["numbers"].items()}
            new["sums"] = {s: n + (0 if of and (own["numbers"][of] or broken[of]) else state["sums"][s])
                           for (s, n), (_, of) in zip(own["sums"].items(), scan.sums.values())}
            new["classes"] = {c: {**state["classes"][c], **last} for c, last in own["classes"].items()}
        state = new
    return out


def _state_table(spark, states: list[dict], scan: Scan, schema: T.StructType) -> DataFrame:
    """One row per partition."""
    kind = lambda c: schema[c].dataType
    column = {c: k for k, c in enumerate(scan.looked_at)}
    fields = [T.StructField(PART, T.IntegerType()), T.StructField("_same", T.BooleanType())]
    fields += [T.StructField(f"{p}_{b}", t) for b in scan.breaks for p, t in (
        ("_before", T.LongType()), ("_broken", T.BooleanType()), ("_broken_after", T.BooleanType()))]
    fields += [T.StructField(f"_sum_{s}", T.LongType()) for s in scan.sums]
    fields += [T.StructField(f"_past_{c}", T.ArrayType(kind(c))) for c in scan.looked_at]
    fields += [T.StructField(f"_next_{c}", T.ArrayType(kind(c))) for c in scan.looked_at]
    fields += [T.StructField(f"_class_{n}", T.MapType(kind(of), kind(c)))
               for n, (c, of) in scan.class_lags.items()]
    rows = []
    for s in states:
        old = s["state"]
        row = [s["part"], s["same"]]
        for b in scan.breaks:
            row += [old["numbers"][b] if old else 0, s["broken"][b], s["broken_after"][b]]
        row += [old["sums"][n] if old else 0 for n in scan.sums]
        row += [[r[column[c]] for r in old["end"]] if old else [] for c in scan.looked_at]
        row += [[r[column[c]] for r in s["ahead"]] for c in scan.looked_at]
        row += [{k: v for k, v in old["classes"][n].items() if k is not None} if old else {}
                for n in scan.class_lags]
        rows.append(tuple(row))
    return spark.createDataFrame(rows, T.StructType(fields))


def segmented_scan(df: DataFrame, keys: list[str], order: list[str], scan: Scan,
                   parts: int | None = None) -> DataFrame:
    """``df`` with the columns of ``scan``.

    Rows with a null key belong to no sequence and must be filtered before.
    ``parts``: range partitions (default: ``spark.sql.shuffle.partitions``); a
    partition is held in memory by its task.
    """
    spark, schema = df.sparkSession, df.schema
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    full = T.StructType([
        *[T.StructField(f.name, f.dataType) for f in schema], *scan.fields(schema), T.StructField(PART, T.IntegerType()),
        *[T.StructField(c, T.LongType()) for c in (_AT, _LEFT)],
        *[T.StructField(c, T.BooleanType()) for c in (_FIRST, _LAST)],
        T.StructField(CARRY, T.BinaryType())])
    table = materialize(
        df.repartitionByRange(parts, *keys, *order).sortWithinPartitions(*keys, *order)
        .withColumn(PART, F.spark_partition_id()).mapInArrow(_scanned(keys, scan, full.names), full))
    records = sorted((r[PART], pickle.loads(r[CARRY])) for r in table.where(
        F.col(CARRY).isNotNull()).select(PART, CARRY).collect())
    states = _state_table(spark, carry_states(records, scan), scan, schema)
    # one row per partition
    rows = table.where(F.col(CARRY).isNull()).join(F.broadcast(states), PART, "left")
    return rows.select(*[F.col(f"`{c}`") for c in df.columns], *_completed(scan))


def _completed(scan: Scan) -> list:
    """The scan's columns with what the other partitions add."""
    col = F.col
    same = col(_FIRST) & col("_same")
    out = []
    for name, (c, n) in scan.lags.items():
        far = F.try_element_at(f"_past_{c}", (F.lit(n) - col(_AT)).cast("int"))
        out.append(F.when(same & (col(_AT) < n), far).otherwise(col(name)).alias(name))
    for name, (c, n) in scan.leads.items():
        far = F.try_element_at(f"_next_{c}", (F.lit(n) - col(_LEFT)).cast("int"))
        out.append(F.when(col(_LAST) & (col(_LEFT) < n), far).otherwise(col(name)).alias(name))
    for name, (_, of) in scan.class_lags.items():
        far = F.try_element_at(f"_class_{name}", col(of))
        out.append(F.when(same & col(f"_new_{name}"), far).otherwise(col(name)).alias(name))
    for name, b in scan.numbers.items():
        out.append((col(f"_number_{b}") + F.when(same, col(f"_before_{b}") + col(f"_broken_{b}").cast("long"))
                    .otherwise(F.lit(0))).alias(name))
    for name, (_, b) in scan.sums.items():
        goes_on = same if b is None else same & (col(f"_number_{b}") == 0) & ~col(f"_broken_{b}")
        out.append((col(name) + F.when(goes_on, col(f"_sum_{name}")).otherwise(F.lit(0))).alias(name))
    for name, b in scan.ends.items():
        out.append(F.when(col(_LEFT) == 0, col(f"_broken_after_{b}")).otherwise(col(name)).alias(name))
    return out
