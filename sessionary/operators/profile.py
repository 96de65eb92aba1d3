"""Profiling, correlation, feature selection and normalisation (F1-F8).

Per-feature statistics are aggregates over the whole table (one partial row
per task) and, for the summary with its quantiles, of the counts of each
feature's values, which combine map-side.  The correlation matrix is built from
per-partition sufficient statistics (Arrow batches into numpy, one
``features^2`` block per task) summed by a ``groupBy``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionary.functions.columns import numpy_round

KEY_COLUMNS = ("visitorid",)
NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
           T.DoubleType, T.DecimalType)


def feature_names(df: DataFrame, exclude=KEY_COLUMNS) -> list[str]:
    """Numeric columns other than the keys."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NUMERIC) and f.name not in exclude]


def min_profile(df: DataFrame, features: list[str] | None = None) -> DataFrame:
    """per feature min_value, min_count and min_percentage.

    ``min_percentage = round(100 * min_count / rows, 2)`` (as numpy rounds),
    NULL rows counting in ``rows``.  Two aggregates of one row per task: the
    minima, then the rows that equal them.
    """
    features = features or feature_names(df)
    lows = df.agg(*[F.min(F.col(c).cast("double")).alias(c) for c in features]).first()
    low = {c: F.lit(lows[c]).cast("double") for c in features}
    one = df.agg(F.count(F.lit(1)).alias("_rows"),
                 *[F.count_if(F.col(c).cast("double") == low[c]).alias(c) for c in features])
    rows = one.select("_rows", F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), low[c].alias("min_value"),
                 F.col(c).alias("min_count")) for c in features])).alias("r")).select("_rows", "r.*")
    return rows.select("feature", "min_value", "min_count", numpy_round(
        F.try_divide("min_count", "_rows") * F.lit(100.0), 2).alias("min_percentage"))


def value_counts(df: DataFrame, features: list[str]) -> DataFrame:
    """(feature, value, n): how often each non-null value occurs."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in features]).unpivot(
        [], features, "feature", "value")
    return long.where(F.col("value").isNotNull()).groupBy("feature", "value").agg(
        F.count(F.lit(1)).alias("n"))


def summary_without_min(df: DataFrame, features: list[str] | None = None) -> DataFrame:
    """F1 plus statistics of the values other than the minimum.

    min, q1, median, mean, q3, max, std_dev, variance (n-1); exact linear
    quantiles; an empty remainder gives NULLs.  Ordered by ``min_count``.

    Plan: one pass over the table counts each feature's values (combined map-side)
    and is written once; everything else is aggregates of that table, with a row
    per feature, and one scan of it for the quantiles.
    """
    from sessionary.operators.quantiles import quantiles_of_counts
    from sessionary.session import materialize
    features = features or feature_names(df)
    counts = materialize(value_counts(df, features))
    total = df.count()
    least = counts.groupBy("feature").agg(F.min("value").alias("min_value"),
                                          F.min_by("n", "value").alias("min_count"))
    # a row per feature on the right side of each of these joins
    rest = counts.join(F.broadcast(least.select("feature", "min_value")), "feature").where(
        F.col("value") != F.col("min_value")).select("feature", "value", "n")
    sums = rest.groupBy("feature").agg(
        F.sum("n").alias("_n"), (F.sum(F.col("n") * F.col("value")) / F.sum("n")).alias("mean"),
        F.min("value").alias("min"), F.max("value").alias("max"))
    dev = F.col("value") - F.col("mean")
    squares = rest.join(F.broadcast(sums.select("feature", "mean")), "feature").groupBy("feature").agg(
        F.sum(F.col("n") * dev * dev).alias("_ss"))
    quartiles = quantiles_of_counts(rest, ["feature"], "value", "n", [0.25, 0.5, 0.75])
    quartiles = quartiles.groupBy("feature").agg(*[
        F.max(F.when(F.col("q") == F.lit(p), F.col("quantile"))).alias(n)
        for n, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))])
    out = df.sparkSession.createDataFrame([(c,) for c in features], "feature string")
    for part in (least, sums, squares, quartiles):
        out = out.join(part, "feature", "left")
    share = numpy_round(F.try_divide(F.coalesce("min_count", F.lit(0)), F.lit(total)) * F.lit(100.0), 2)
    var = F.try_divide(F.col("_ss"), F.col("_n") - 1)
    return out.select(
        "feature", "min_value", F.coalesce("min_count", F.lit(0)).alias("min_count"),
        share.alias("min_percentage"), "min", "q1", "median", "mean", "q3", "max",
        F.sqrt(var).alias("std_dev"), var.alias("variance")).orderBy("min_count", "feature")


def _partial_moments(features: list[str], shift: np.ndarray):
    k = len(features)

    def fn(batches):
        n = np.zeros((k, k)); sx = np.zeros((k, k)); sxx = np.zeros((k, k))
        sxy = np.zeros((k, k))
        for pdf in batches:
            x = pdf[features].to_numpy(dtype=float) - shift
            m = (~np.isnan(x)).astype(float)
            x0 = np.nan_to_num(x)
            n += m.T @ m
            sx += x0.T @ m          # sum of x_i over rows where x_j present
            sxx += (x0 * x0).T @ m
            sxy += x0.T @ x0
        ii, jj = np.meshgrid(np.arange(k), np.arange(k), indexing="ij")
        yield pd.DataFrame({
            "i": ii.ravel().astype("int32"), "j": jj.ravel().astype("int32"),
            "n": n.ravel(), "sx": sx.ravel(), "sy": sx.T.ravel(),
            "sxx": sxx.ravel(), "syy": sxx.T.ravel(), "sxy": sxy.ravel()})
    return fn


def correlation_long(df: DataFrame, features: list[str] | None = None,
                     shift: dict | None = None) -> DataFrame:
    """Pearson r for every ordered pair (feature_a, feature_b).

    Pairwise-complete rows; a constant column gives NULL (NaN in pandas).
    Values are shifted by the column means first (one small aggregate) so the
    one-pass sums do not cancel.
    """
    features = features or feature_names(df)
    if shift is None:
        means = df.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in features]).first()
        shift = {c: means[c] for c in features}
    shift = np.array([shift.get(c) if shift.get(c) is not None else 0.0 for c in features])
    schema = "i int, j int, n double, sx double, sy double, sxx double, syy double, sxy double"
    parts = (df.select(*[F.col(c).cast("double").alias(c) for c in features])
             .mapInPandas(_partial_moments(features, shift), schema))
    sums = parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in
                                          ("n", "sx", "sy", "sxx", "syy", "sxy")])
    cov = F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy")
    vx = F.col("n") * F.col("sxx") - F.col("sx") * F.col("sx")
    vy = F.col("n") * F.col("syy") - F.col("sy") * F.col("sy")
    den = F.sqrt(vx * vy)
    # clamp inside the branch: greatest/least skip NULLs
    r = F.when((vx > 0) & (vy > 0),
               F.least(F.greatest(cov / den, F.lit(-1.0)), F.lit(1.0)))
    names = F.array(*[F.lit(c) for c in features])
    return sums.select(F.element_at(names, F.col("i") + 1).alias("feature_a"),
                       F.element_at(names, F.col("j") + 1).alias("feature_b"),
                       r.alias("r"))


ONE = 1.0 - 1e-12  # |r| this close to 1.0 counts as exactly 1.0 (skipped)


def correlated_counts(df: DataFrame, features: list[str] | None = None,
                      threshold: float = 0.8, shift: dict | None = None) -> DataFrame:
    """per feature, how many other features have |r| > threshold (r != 1)."""
    features = features or feature_names(df)
    corr = correlation_long(df, features, shift)
    hits = (corr.where((F.col("feature_a") != F.col("feature_b"))
                       & (F.abs("r") > threshold) & (F.col("r") < ONE))
            .groupBy("feature_a").agg(F.count(F.lit(1)).alias("correlated_count")))
    names = df.sparkSession.createDataFrame([(c,) for c in features], "feature string")
    return (names.join(hits.withColumnRenamed("feature_a", "feature"), "feature", "left")
            .select("feature", F.coalesce("correlated_count", F.lit(0)).cast("bigint")
                    .alias("correlated_count"))
            .orderBy(F.desc("correlated_count"), "feature"))


def _selection_rows(df: DataFrame, min_percentage_threshold: float,
                    correlated_count_threshold: int | None, features: list[str],
                    corr_threshold: float) -> list[tuple]:
    """(feature, min_percentage, correlated_count, selected) per feature.

    One row per feature (its minimum share, its mean) and the correlation
    table of the kept features (kept^2 rows) reach the driver."""
    share = {r["feature"]: r["min_percentage"] for r in min_profile(df, features).collect()}
    means = df.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in features]).first().asDict()
    kept = [c for c in features if share.get(c) is not None
            and share[c] < min_percentage_threshold]
    t = len(kept) // 2 if correlated_count_threshold is None else correlated_count_threshold
    counts = {c: 0 for c in kept}
    if kept:
        # means shift the sums (well conditioned); kept^2 rows come back
        for r in correlation_long(df, kept, shift=means).collect():
            rv = r["r"]
            if (r["feature_a"] != r["feature_b"] and rv is not None
                    and abs(rv) > corr_threshold and rv < ONE):
                counts[r["feature_a"]] += 1
    return [(c, share.get(c), counts.get(c), c in counts and counts[c] < t)
            for c in features]


def feature_selection_table(df: DataFrame, min_percentage_threshold: float = 95.0,
                            correlated_count_threshold: int | None = None,
                            features: list[str] | None = None,
                            corr_threshold: float = 0.8) -> DataFrame:
    """F5 as a table: (feature, min_percentage, correlated_count, selected).

    Step 1 keeps ``min_percentage < min_percentage_threshold``; step 2 counts
    correlations among those and keeps ``correlated_count < t`` with
    ``t = kept // 2`` by default.  Only per-feature metadata reaches the driver.
    """
    features = features or feature_names(df)
    rows = _selection_rows(df, min_percentage_threshold, correlated_count_threshold,
                           features, corr_threshold)
    return df.sparkSession.createDataFrame(
        rows, "feature string, min_percentage double, correlated_count long, selected boolean")


def feature_selection(df: DataFrame, min_percentage_threshold: float = 95.0,
                      correlated_count_threshold: int | None = None,
                      features: list[str] | None = None) -> list[str]:
    """the selected feature names, in table column order."""
    features = features or feature_names(df)
    rows = _selection_rows(df, min_percentage_threshold, correlated_count_threshold,
                           features, 0.8)
    return [r[0] for r in rows if r[3]]


def normalize(df: DataFrame, method: str = "z_score", features: list[str] | None = None,
              keep: tuple[str, ...] = ()) -> DataFrame:
    """z-score (n-1) or min-max scaling of ``features``.

    Two numbers per column come from one aggregate and enter the projection as
    literals, so scaling is a map-only pass.  Zero spread gives NULL.
    Unknown methods raise ``ValueError`` (F8).
    """
    features = features or feature_names(df)
    if method not in ("z_score", "min_max"):
        raise ValueError(f"unknown normalisation {method!r}; use 'z_score' or 'min_max'")
    if method == "z_score":
        aggs = [F.avg(c).alias(f"a__{c}") for c in features] + \
               [F.stddev_samp(c).alias(f"b__{c}") for c in features]
    else:
        aggs = [F.min(c).cast("double").alias(f"a__{c}") for c in features] + \
               [F.max(c).cast("double").alias(f"b__{c}") for c in features]
    st = df.agg(*aggs).first().asDict()
    cols = [F.col(k) for k in keep]
    for c in features:
        a, b = st[f"a__{c}"], st[f"b__{c}"]
        x = F.col(c).cast("double")
        if a is None or b is None:
            cols.append(F.lit(None).cast("double").alias(c))
            continue
        if method == "z_score":
            cols.append(F.try_divide(x - F.lit(a), F.lit(b)).alias(c))
        else:
            cols.append(F.try_divide(x - F.lit(a), F.lit(b - a)).alias(c))
    return df.select(*cols)
