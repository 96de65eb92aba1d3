"""Exact quantiles (linear interpolation) of any number of groups.

``F.percentile`` is exact but keeps a value -> count map per group and merges it in
one task: for a continuous column of a billion rows that map is the whole column.
Here equal values of a group are counted first (combined map-side), and one
segmented scan (:mod:`sessionary.operators.sequence`) over the sorted (group, value)
rows gives cumulative counts, however many partitions a group spans; the values at
the two ranks next to each quantile are conditional minima.  Groups are rows of
tables throughout, so their number is not bounded.  Interpolation follows the usual
"linear" rule: position ``(n - 1) q``, weights on the two neighbouring ranks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionary.operators.sequence import Scan, segmented_scan


def exact_quantiles(df: DataFrame, keys: list[str], value: str, probs: list[float],
                    parts: int | None = None) -> DataFrame:
    """Rows ``keys + [q, quantile]``; NULL values are ignored, none left -> NULL."""
    if not keys:  # whole-table quantiles: one constant group
        out = exact_quantiles(df.withColumn("_all", F.lit(0)), ["_all"], value, probs, parts)
        return out.drop("_all")
    counts = df.select(*keys, F.col(value).cast("double").alias("_v")).groupBy(*keys, "_v").agg(
        F.count("_v").alias("_c"))
    return quantiles_of_counts(counts, keys, "_v", "_c", probs, parts)


def quantiles_of_counts(counts: DataFrame, keys: list[str], value: str, times: str,
                        probs: list[float], parts: int | None = None) -> DataFrame:
    """``exact_quantiles`` of rows (keys, value, how many times), one for each value."""
    keys, probs = list(keys), [float(p) for p in probs]
    # a group's keys as one text: a null key is a group like any other
    group = F.to_json(F.struct(*[F.col(k) for k in keys]))
    rows = counts.select(*keys, group.alias("_g"), F.col(value).alias("_v"), F.col(times).alias("_c"))
    totals = rows.groupBy(*keys, "_g").agg(
        F.coalesce(F.sum(F.when(F.col("_v").isNotNull(), F.col("_c"))), F.lit(0)).alias("_n"))
    cum = segmented_scan(rows.where(F.col("_v").isNotNull()).select("_g", "_v", "_c"), ["_g"], ["_v"],
                         Scan(sums={"_cum": ("_c", None)}), parts)

    def at_rank(rank):
        return F.min(F.when(F.col("_cum") > rank, F.col("_v")))
    ranks = [(F.col("_n") - 1) * F.lit(p) for p in probs]
    sides = [(at_rank(F.floor(r)), at_rank(F.ceil(r))) for r in ranks]
    found = cum.join(totals.select("_g", "_n"), "_g").groupBy("_g").agg(
        *[v.alias(f"_{side}{k}") for k, pair in enumerate(sides) for side, v in zip("ab", pair)])
    out = [F.struct(F.lit(p).alias("q"), (F.col(f"_a{k}") + (F.col(f"_b{k}") - F.col(f"_a{k}")) * (
        r - F.floor(r))).alias("quantile")) for k, (p, r) in enumerate(zip(probs, ranks))]
    return totals.join(found, "_g", "left").select(*keys, F.explode(F.array(*out)).alias("_q")).select(
        *keys, F.col("_q.q").alias("q"), F.col("_q.quantile").alias("quantile"))


def quantile_columns(df: DataFrame, keys: list[str], value: str,
                     named: dict[str, float], parts: int | None = None) -> DataFrame:
    """Wide form: ``keys + list(named)`` with one quantile per named column."""
    long = exact_quantiles(df, keys, value, list(named.values()), parts)
    cols = [F.max(F.when(F.col("q") == F.lit(float(p)), F.col("quantile"))).alias(n)
            for n, p in named.items()]
    if keys:
        return long.groupBy(*keys).agg(*cols)
    return long.agg(*cols)  # whole-table: keys x probs rows -> one row
