"""Result statistics: grouped describe (A1), per-label feature stats (A2),
Gaussian density curves (A3)."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionary.functions.columns import numpy_round
from sessionary.operators.quantiles import quantile_columns

GRID_SIZE = 200   # fixed value: points of a density curve
CUT = 3.0         # fixed value: curve extends this many bandwidths past the data
HELD_GROUPS = 1_000   # groups whose sums a task holds before it returns them


def _kernel_sums(grid_size: int, at_once: int = 4096):
    """Sums of Gaussian kernels at each group's grid points over a task's rows."""
    names = ["_whole", "group", "_h", "_g0", "_step"]

    def rows_of(sums: dict) -> pd.DataFrame:
        parts = [pd.DataFrame({**dict(zip(names, key)), "point": np.arange(grid_size, dtype=np.int32),
                               "_k": total}) for key, total in sums.items()]
        return pd.concat(parts, ignore_index=True)

    def run(batches):
        sums = {}
        for pdf in batches:
            for (whole, group, h, g0, step), own in pdf.groupby(names)["_x"]:
                grid = g0 + step * np.arange(grid_size)
                total = sums.setdefault((whole, group, h, g0, step), np.zeros(grid_size))
                x = own.to_numpy(float)
                for k in range(0, len(x), at_once):
                    z = (grid[:, None] - x[None, k:k + at_once]) / h
                    total += np.exp(-0.5 * z * z).sum(axis=1)
            if len(sums) > HELD_GROUPS:
                yield rows_of(sums)
                sums = {}
        if sums:
            yield rows_of(sums)
    return run


def describe_by(df: DataFrame, group: str, measure: str, digits: int = 2) -> DataFrame:
    """A1: count, mean, std, min, 25%, 50%, 75%, max of ``measure`` per group."""
    m = F.col(measure).cast("double")
    moments = df.groupBy(group).agg(
        F.count(m).cast("double").alias("count"), F.avg(m).alias("mean"),
        F.stddev_samp(m).alias("std"), F.min(m).alias("min"), F.max(m).alias("max"))
    qs = quantile_columns(df, [group], measure, {"p25": 0.25, "p50": 0.5, "p75": 0.75})
    # a null group is a group
    out = moments.join(qs.withColumnRenamed(group, "_g"), F.col(group).eqNullSafe(F.col("_g")), "left")
    cols = ["count", "mean", "std", "min", "p25", "p50", "p75", "max"]
    return out.select(group, *[numpy_round(c, digits).alias(c) for c in cols])


def stats_by_label_long(df: DataFrame, label: str, features: list[str],
                        digits: int = 2) -> DataFrame:
    """A2 long form: (feature, stat, label, value) with min / median / max / std."""
    long = (df.select(F.col(label).alias("label"),
                      *[F.col(c).cast("double").alias(c) for c in features])
            .unpivot(["label"], features, "feature", "value"))
    mom = long.groupBy("feature", "label").agg(
        F.min("value").alias("min"), F.max("value").alias("max"),
        F.stddev_samp("value").alias("std"))
    med = quantile_columns(long, ["feature", "label"], "value", {"median": 0.5})
    wide = mom.join(med, ["feature", "label"], "left")
    return (wide.unpivot(["feature", "label"], ["min", "median", "max", "std"], "stat", "value")
            .select("feature", "stat", "label", numpy_round("value", digits).alias("value")))


def label_column_name(v) -> str:
    return "label_" + str(v).replace("-", "m")


def stats_by_label(df: DataFrame, label: str, features: list[str], labels: list,
                   digits: int = 2) -> DataFrame:
    """A2 transposed: rows (feature, stat), one column per label value."""
    long = stats_by_label_long(df, label, features, digits)
    piv = long.groupBy("feature", "stat").pivot("label", labels).agg(F.first("value"))
    return piv.select("feature", "stat", *[F.col(str(v)).alias(label_column_name(v))
                                           for v in labels])


def density_curves(df: DataFrame, measure: str, group: str | None = None,
                   all_label: str = "ALL", grid_size: int = GRID_SIZE,
                   cut: float = CUT) -> DataFrame:
    """A3: Gaussian KDE per group (and over all rows as ``ALL``).

    Scott's rule: bandwidth ``h = std(ddof=1) * n ** (-1/5)``; the grid spans
    ``[min - cut h, max + cut h]`` in ``grid_size`` points.  The per-group
    constants are a table that is joined with the rows; tasks sum the kernels of
    their rows batch by batch, so the shuffle holds ``groups x grid_size`` partial
    rows per task.  A group that is itself called ``all_label`` keeps its own curve.
    Output: (group, point, x, density).
    """
    from sessionary.session import materialize
    x = F.col(measure).cast("double")
    # true in every row, but no literal: on literals alone the joins would be nested loops
    whole = F.pmod(F.xxhash64(x), F.lit(1).cast("long")) == 0
    parts = [df.select(whole.alias("_whole"), F.lit(all_label).alias("group"), x.alias("_x"))]
    if group is not None:
        parts.append(df.select(F.lit(False).alias("_whole"), F.col(group).cast("string").alias("group"),
                               x.alias("_x")).where(F.col("group").isNotNull()))
    data = parts[0]
    for p in parts[1:]:
        data = data.unionByName(p)
    data = data.where(F.col("_x").isNotNull())
    params = materialize(data.groupBy("_whole", "group").agg(
        F.count(F.lit(1)).alias("_n"), F.stddev_samp("_x").alias("_sd"),
        F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
        .withColumn("_h", F.col("_sd") * F.pow(F.col("_n").cast("double"), F.lit(-0.2)))
        .where(F.col("_h") > 0)
        .withColumn("_g0", F.col("_lo") - F.lit(cut) * F.col("_h"))
        .withColumn("_step", (F.col("_hi") - F.col("_lo") + F.lit(2 * cut) * F.col("_h"))
                    / F.lit(grid_size - 1))
        .select("_whole", "group", "_n", "_h", "_g0", "_step"))
    rows = data.join(params.drop("_n"), ["_whole", "group"])
    partial = rows.select("_whole", "group", "_h", "_g0", "_step", "_x").mapInPandas(
        _kernel_sums(grid_size),
        "_whole boolean, group string, _h double, _g0 double, _step double, point int, _k double")
    # per task one row for each group and grid point
    sums = partial.groupBy("_whole", "group", "_h", "_g0", "_step", "point").agg(
        F.sum("_k").alias("_k")).join(params.select("_whole", "group", "_n"), ["_whole", "group"])
    norm = F.lit(1.0 / math.sqrt(2 * math.pi))
    return sums.select("group", "point", (F.col("_g0") + F.col("point") * F.col("_step"))
                       .alias("x"),
                       (F.col("_k") * norm / (F.col("_n") * F.col("_h"))).alias("density"))
