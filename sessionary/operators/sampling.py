"""Exact-size samples by hash order (N1, N2, forest tree samples).

A row's sampling key is the first 60 bits of the MD5 of "seed:key:split":
uniform, reproducible on any partitioning and in any engine, independent of
row order.  A sample of
``k`` rows out of a group of ``n`` is "the k smallest keys of the group".

Sorting a whole group would put a big class in one task, so the k-th key is
located statistically: keys are uniform, so the k-th smallest lies, with
overwhelming probability, within ``sigmas`` binomial standard deviations of
``k / n``.  Rows below the bracket are taken outright, rows inside it (about
``2 sigmas sqrt(k)`` per group) are ranked exactly, rows above are dropped.
The bracket is verified; a miss widens it and repeats, so the result is
always exact.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

U = "_u"       # uniform double in [0, 1)
H = "_h"       # the raw hash (tie-breaker)
TWO60 = float(2 ** 60)


class MissedBracket(RuntimeError):
    """The sampling bracket doesn't hold the k-th key of every group."""


def uniform_hash(*cols: Column | str, seed: int | Column = 42) -> tuple[Column, Column]:
    """(60-bit hash, the same mapped to a uniform double in [0, 1))."""
    parts = [seed if isinstance(seed, Column) else F.lit(seed),
             *[F.col(c) if isinstance(c, str) else c for c in cols]]
    text = F.concat_ws(":", *[p.cast("string") for p in parts])
    h = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")
    return h, h.cast("double") / F.lit(TWO60)


def _bracket(k: Column, n: Column, sigmas: float):
    p = k / n
    sd = F.sqrt(n * p * (F.lit(1.0) - p))
    lo = F.greatest(F.lit(0.0), (k - F.lit(sigmas) * sd - F.lit(2.0)) / n)
    hi = F.least(F.lit(1.0), (k + F.lit(sigmas) * sd + F.lit(2.0)) / n)
    return lo, hi


def bottom_k(rows: DataFrame, groups: list[str], targets: DataFrame,
             tie: list[str], sigmas: float = 8.0,
             widths: tuple | None = None) -> DataFrame:
    """Rows of ``rows`` (with ``_u``, ``_h`` columns) that are among the ``_k``
    smallest ``(_u, _h, tie...)`` of their group.

    ``targets``: one row per group with ``groups + ['_k', '_n']`` (``_n`` = group
    size), joined as a table.
    """
    widths = widths or (sigmas, sigmas * 4, math.inf)
    exact = False
    for width in widths:
        if math.isinf(width):
            t = targets.select(*groups, "_k", F.lit(0.0).alias("_lo"), F.lit(1.01).alias("_hi"))
        else:
            lo, hi = _bracket(F.col("_k").cast("double"), F.col("_n").cast("double"), width)
            t = targets.select(*groups, "_k", lo.alias("_lo"),
                               F.when(F.col("_k") >= F.col("_n"), F.lit(1.01))
                               .otherwise(hi).alias("_hi"))
        tagged = rows.join(t, groups, "inner").where(F.col(U) < F.col("_hi"))
        counts = tagged.groupBy(*groups, "_k").agg(
            F.count_if(F.col(U) < F.col("_lo")).alias("_below"),
            F.count(F.lit(1)).alias("_upto_hi"))
        # exact iff nothing is over-taken below the bracket and enough rows lie
        # below its top
        # (a group without any row below its top is missing from the counts)
        check = (targets.select(*groups, F.col("_k").alias("_want"), "_n")
                 .join(counts, groups, "left")
                 .where((F.coalesce("_below", F.lit(0)) > F.col("_want"))
                        | (F.coalesce("_upto_hi", F.lit(0)) < F.least("_want", "_n"))))
        if check.limit(1).count() == 0:
            exact = True
            break
    if not exact:
        raise MissedBracket("sampling bracket missed the k-th key")
    sure = tagged.where(F.col(U) < F.col("_lo"))
    edge = tagged.where(F.col(U) >= F.col("_lo"))
    below = counts.select(*groups, "_below")
    w = Window.partitionBy(*groups).orderBy(U, H, *tie)
    ranked = (edge.join(below, groups, "left")
              .withColumn("_r", F.row_number().over(w))
              .where(F.col("_r") <= F.col("_k") - F.col("_below"))
              .drop("_r", "_below"))
    return sure.unionByName(ranked).drop("_lo", "_hi", "_k")


def bracket_top(k: int, n: int, sigmas: float = 32.0) -> float:
    """Top of the widest sampling bracket (the value ``bottom_k`` uses)."""
    if k >= n or math.isinf(sigmas):
        return 1.01
    p = k / n
    return min(1.0, (k + sigmas * math.sqrt(n * p * (1 - p)) + 2.0) / n)


def _bracket_top(k: Column, n: Column, sigmas: float) -> Column:
    """``bracket_top`` of columns."""
    if math.isinf(sigmas):
        return F.lit(1.01)
    p = k / n
    top = (k + F.lit(sigmas) * F.sqrt(n * p * (1 - p)) + F.lit(2.0)) / n
    return F.when(k >= n, F.lit(1.01)).otherwise(F.least(F.lit(1.0), top))


def _widening(below, groups: list[str], targets: DataFrame, tie: list[str]) -> DataFrame:
    """``bottom_k`` of ``below(sigmas)``; a missed bracket is widened up to all rows
    (keys that repeat have equal hashes, so they can miss any bracket)."""
    for widths in ((8.0, 32.0), (math.inf,)):
        try:
            return bottom_k(below(widths[-1]), groups, targets, tie, widths=widths)
        except MissedBracket:
            continue
    raise MissedBracket("a group has fewer rows than its target")


def class_shares(counts: DataFrame, label: str, total: int, n: int) -> DataFrame:
    """``counts`` (label, n) with ``_k``: the classes' shares of ``total`` by largest remainder.

    What the whole parts leave over goes, one row each, to the classes of the
    largest fractions (equal ones by name), ranked over all partitions.
    """
    from sessionary.operators.graph import global_rank
    from sessionary.session import materialize
    raw = F.lit(float(total)) * F.col("n") / F.lit(float(n))
    table = materialize(counts.withColumn("_raw", raw).withColumn(
        "_k", F.least("n", F.floor("_raw"))).withColumn("_class", F.monotonically_increasing_id()))
    left = total - (table.agg(F.sum("_k")).first()[0] or 0)
    if left <= 0:
        return table.drop("_raw")
    open_ = table.where(F.col("_k") < F.col("n")).select(
        "_class", (F.col("_k") - F.col("_raw")).alias("_minus"),
        F.coalesce(F.col(label).cast("string"), F.lit("None")).alias("_name"))
    first = global_rank(open_, ["_minus", "_name", "_class"], "_rank").where(
        F.col("_rank") <= left).select("_class", F.lit(1).alias("_more"))
    return materialize(table.join(first, "_class", "left").withColumn(
        "_k", F.col("_k") + F.coalesce("_more", F.lit(0))).drop("_more", "_raw"))


def stratified_samples(df: DataFrame, label: str, key: str, n_splits: int,
                       sample_size: float, seed: int = 42,
                       drop_label: bool = True) -> DataFrame:
    """``n_splits`` stratified samples (column ``split``), class shares kept.

    Sample size ``ceil(sample_size * n)`` (a fraction) or ``sample_size`` rows
    (an int >= 1); classes (NULL is one) get their share by largest remainder.  The
    classes are a table that is joined with the rows, so their number is not bounded.
    """
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    n = df.count()
    if not n:
        out = df.limit(0).withColumn("split", F.lit(0))
        return out.drop(label) if drop_label else out
    total = (int(sample_size) if isinstance(sample_size, int) and sample_size >= 1
             else int(math.ceil(sample_size * n)))
    classes = class_shares(counts, label, total, n)
    splits = F.sequence(F.lit(0), F.lit(n_splits - 1))
    targets = classes.select(F.explode(splits).alias("split"), "_class", "_k", F.col("n").alias("_n"))

    def u_of(sp):
        return uniform_hash(key, sp, seed=seed)[1]

    def below(sigmas: float) -> DataFrame:
        # each row keeps only the splits whose hash is below its class's bracket
        # top, before exploding: the data is never replicated n_splits times
        tops = classes.select(F.col(label).alias("_label"), "_class",
                              _bracket_top(F.col("_k"), F.col("n"), sigmas).alias("_top"))
        rows = df.join(tops, F.col(label).eqNullSafe(F.col("_label"))).drop("_label")
        rows = rows.select("*", F.explode(F.filter(
            splits, lambda sp: u_of(sp) < F.col("_top"))).alias("split")).drop("_top")
        h, u = uniform_hash(key, "split", seed=seed)
        return rows.withColumn(H, h).withColumn(U, u)
    out = _widening(below, ["split", "_class"], targets, [key]).drop(U, H, "_class")
    return out.drop(label) if drop_label else out


def random_samples(df: DataFrame, key: str, n_splits: int, frac: float,
                   seed: int = 42, drop_last: str | None = None) -> DataFrame:
    """``n_splits`` samples of ``round(frac * n)`` rows without replacement.

    Split ``i`` uses seed ``seed + i``; column ``split`` tells them apart.
    """
    n = df.count()
    k = int(round(frac * n))
    spark = df.sparkSession
    targets = spark.createDataFrame([(s, k, n) for s in range(n_splits)],
                                    "split int, _k long, _n long")
    splits = F.sequence(F.lit(0), F.lit(n_splits - 1))

    def below(sigmas: float) -> DataFrame:
        top = F.lit(bracket_top(k, n, sigmas))
        keep = F.filter(splits, lambda sp: uniform_hash(key, seed=sp + F.lit(seed))[1] < top)
        rows = df.select("*", F.explode(keep).alias("split"))
        h, u = uniform_hash(key, seed=F.col("split") + F.lit(seed))
        return rows.withColumn(H, h).withColumn(U, u)
    out = _widening(below, ["split"], targets, [key]).drop(U, H)
    return out.drop(drop_last) if drop_last else out
