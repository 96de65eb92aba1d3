"""Isolation forest on Spark.

Fit
  1. ``psi = min(max_samples, n)`` rows per tree, without replacement: the
     ``psi`` smallest hashes of (row key, tree) - exact size, reproducible on any
     partitioning.  Each row first keeps only the trees whose hash falls in
     the sampling bracket, so rows are never replicated ``T`` times.
  2. Growth by counter-based draws: node i has the children 2i and 2i + 1 (the
     root is 1), and a node's feature (uniform among the non-constant ones) and
     threshold (uniform in [min, max)) come from the MD5 of (seed, tree, node),
     so the same forest grows in any order, in any engine; depth limit
     ``ceil(log2 psi)``.  Nodes of more than ``group_rows`` rows are split level
     by level (minima and maxima per node by a map-side combined ``groupBy``, the
     split joined back to the rows); every smaller node's subtree grows in one
     ``applyInPandas`` group.
  3. The forest is a node table ``(tree_id, node_id, depth, feature, threshold,
     left, right, n, leaf_value)`` of at most ``T (2 psi - 1)`` rows.

Score
  ``score_samples = -2 ** (-E[h(x)] / c(psi))`` with ``h`` = leaf depth +
  ``c(leaf size)``; ``decision = score_samples - offset`` (offset -0.5 for
  ``contamination='auto'``, else the contamination percentile of the training
  scores).  Labels: -1 when decision < 0.  Scoring is a map-only
  ``mapInPandas`` pass with the node table shipped to the tasks while that has at
  most ``SHIPPED_NODES`` rows; larger forests are joined with the rows level by
  level instead.
"""

from __future__ import annotations

import hashlib
import json
import math
import os
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sessionary.operators.sampling import H, TWO60, U, bottom_k, uniform_hash

EULER_GAMMA = 0.5772156649015329  # fixed value: Euler-Mascheroni constant

#: Columns that ``transform`` adds.
OUTPUT_TYPES = {"path_length": "double", "score_samples": "double", "anomaly_score": "double",
                "anomaly_label": "int"}

NODE_SCHEMA = ("tree_id int, node_id long, depth int, feature string, threshold double, "
               "left long, right long, n long, leaf_value double")
ROOT = 1
#: Nodes of more rows are split by distributed aggregates.
GROUP_ROWS = 65_536
#: Largest node table that is sent to the driver and every task.
SHIPPED_NODES = 2_000_000


def average_path_length(n):
    """c(n): average unsuccessful-search path length in a BST of n items."""
    n = np.asarray(n, dtype=float)
    out = np.zeros_like(n)
    big = n > 2
    out[n == 2] = 1.0
    out[big] = 2.0 * (np.log(n[big] - 1.0) + EULER_GAMMA) - 2.0 * (n[big] - 1.0) / n[big]
    return out


def mean_path(trees: list, x: np.ndarray) -> np.ndarray:
    """Mean over the trees' arrays of leaf depth + c(leaf size) for each row of ``x``."""
    total = np.zeros(len(x))
    every = np.arange(len(x))
    for feat, thr, left, right, val, depth in trees:
        idx = np.zeros(len(x), dtype=int)
        for _ in range(depth + 1):
            f = feat[idx]
            inner = f >= 0
            if not inner.any():
                break
            go_left = x[every, np.where(inner, f, 0)] <= thr[idx]
            idx = np.where(inner, np.where(go_left, left[idx], right[idx]), idx)
        total += val[idx]
    return total / max(1, len(trees))


#: Types that hold every value of a type.
_HOLDS = {"tinyint": ("smallint", "int", "bigint", "float", "double"),
          "smallint": ("int", "bigint", "float", "double"), "int": ("bigint", "double"),
          "bigint": (), "float": ("double",), "double": ()}


def enforce_signature(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """``df`` with the model's columns in the model's types.

    A missing column raises ``ValueError``; a column whose type holds values that the
    model's type doesn't raises ``TypeError``; a narrower one is cast.
    """
    given = dict(df.dtypes)
    missing = [c for c in types if c not in given]
    if missing:
        raise ValueError(f"the model needs the columns {missing}")
    casts = {}
    for c, want in types.items():
        if given[c] != want:
            if want not in _HOLDS.get(given[c], ()):
                raise TypeError(f"column {c!r} is {given[c]}; the model's signature has {want}")
            casts[c] = F.col(f"`{c}`").cast(want)
    return df.withColumns(casts) if casts else df


@dataclass
class IsolationForestModel:
    """``nodes`` is the node table in the shared folder; the driver and the
    tasks use arrays read from it (T (2 psi - 1) rows at most)."""

    nodes: DataFrame
    features: list[str]
    psi: int
    offset: float
    n_estimators: int
    params: dict = field(default_factory=dict)
    input_types: dict = field(default_factory=dict)

    def node_rows(self) -> pd.DataFrame:
        """The node table on the driver, in (tree, node) order."""
        rows = self.__dict__.get("_node_rows")
        if rows is None:
            rows = pd.DataFrame([r.asDict() for r in self.nodes.collect()],
                                columns=self.nodes.columns)
            rows = rows.sort_values(["tree_id", "node_id"]).reset_index(drop=True)
            self.__dict__["_node_rows"] = rows
        return rows

    # ------------------------------------------------------------ scoring
    def _arrays(self):
        cached = self.__dict__.get("_cached_arrays")
        if cached is not None:
            return cached
        fidx = {f: i for i, f in enumerate(self.features)}
        trees = []
        for t, g in self.node_rows().groupby("tree_id", sort=True):
            for c in ("threshold", "left", "right", "leaf_value"):
                g = g.assign(**{c: pd.to_numeric(g[c])})
            feat = np.array([fidx[f] if isinstance(f, str) else -1 for f in g["feature"]])
            node = g["node_id"].to_numpy(np.int64)  # ascending: the root comes first
            at = lambda side: np.searchsorted(node, g[side].fillna(ROOT).to_numpy(np.int64))  # noqa: B023, E731
            trees.append((feat, g["threshold"].fillna(0.0).to_numpy(float),
                          at("left"), at("right"), g["leaf_value"].fillna(0.0).to_numpy(float),
                          int(g["depth"].max())))
        self.__dict__["_cached_arrays"] = trees
        return trees

    def path_lengths(self, x: np.ndarray) -> np.ndarray:
        return mean_path(self._arrays(), x)

    def score_samples_np(self, x: np.ndarray) -> np.ndarray:
        c = float(average_path_length([self.psi])[0]) or 1.0
        return -np.power(2.0, -self.path_lengths(x) / c)

    def transform(self, df: DataFrame, keep: list[str] | None = None) -> DataFrame:
        """Add ``path_length``, ``score_samples``, ``anomaly_score`` (decision
        function) and ``anomaly_label`` (-1 / 1).  Map-only."""
        keep = keep if keep is not None else df.columns
        df = enforce_signature(df, self.input_types)
        if not self.shipped():
            return self._transform_joined(df, keep)
        held = df.sparkSession.sparkContext.broadcast(self._arrays())
        c = float(average_path_length([self.psi])[0]) or 1.0
        offset = self.offset
        feats = list(self.features)
        cols = list(dict.fromkeys(keep + feats))

        def fn(batches):
            for pdf in batches:
                x = pdf[feats].to_numpy(dtype=float)
                h = mean_path(held.value, x)
                s = -np.power(2.0, -h / c)
                d = s - offset
                out = pdf[keep].copy()
                out["path_length"] = h
                out["score_samples"] = s
                out["anomaly_score"] = d
                out["anomaly_label"] = np.where(d < 0, -1, 1).astype("int32")
                yield out

        base = df.select(*cols)
        added = ("path_length double, score_samples double, anomaly_score double, "
                 "anomaly_label int")
        kept = _ddl(base.select(*keep))
        return base.mapInPandas(fn, f"{kept}, {added}" if kept else added)

    def shipped(self) -> bool:
        """Whether the node table is small enough for the driver and every task."""
        if "_size" not in self.__dict__:
            self.__dict__["_size"] = self.nodes.limit(SHIPPED_NODES + 1).count()
        return self.__dict__["_size"] <= SHIPPED_NODES

    def _transform_joined(self, df: DataFrame, keep: list[str]) -> DataFrame:
        """``transform`` for a forest of any size: every row descends every tree by joins."""
        from sessionary.session import materialize
        rows = materialize(df.select("*", F.monotonically_increasing_id().alias("_row")))
        x = F.array(*[F.col(f"`{f}`").cast("double") for f in self.features])
        place = F.array_position(F.array(*[F.lit(f) for f in self.features]), F.col("feature"))
        nodes = self.nodes.select("tree_id", "node_id", place.cast("int").alias("_f"), "threshold",
                                  "leaf_value")
        walk = rows.select("_row", x.alias("_x"), F.explode(F.sequence(
            F.lit(0), F.lit(self.n_estimators - 1))).alias("tree_id"), F.lit(ROOT).cast("long").alias("node_id"))
        depth = self.nodes.agg(F.max("depth")).first()[0] or 0
        for _ in range(depth):
            go_right = F.element_at("_x", F.col("_f")) > F.col("threshold")
            step = F.when(F.col("_f").isNull(), F.col("node_id")).otherwise(
                2 * F.col("node_id") + go_right.cast("long"))
            walk = materialize(walk.join(nodes, ["tree_id", "node_id"]).select(
                "_row", "_x", "tree_id", step.alias("node_id")))
        h = walk.join(nodes, ["tree_id", "node_id"]).groupBy("_row").agg(
            F.avg("leaf_value").alias("path_length"))
        c = float(average_path_length([self.psi])[0]) or 1.0
        score = -F.pow(F.lit(2.0), -F.col("path_length") / F.lit(c))
        return rows.join(h, "_row").select(
            *[F.col(f"`{k}`") for k in keep], "path_length", score.alias("score_samples"),
            (score - F.lit(self.offset)).alias("anomaly_score"),
            F.when(score - F.lit(self.offset) < 0, -1).otherwise(1).cast("int").alias("anomaly_label"))

    # ------------------------------------------------------------ persistence
    def save(self, spark: SparkSession, path: str) -> None:
        """Node table as parquet plus a one-row metadata table: parameters and the
        signature (input columns with types, output columns with types)."""
        self.nodes.write.mode("overwrite").parquet(os.path.join(path, "nodes"))
        meta = {"features": self.features, "psi": self.psi, "offset": self.offset,
                "n_estimators": self.n_estimators, "params": self.params,
                "inputs": self.input_types, "outputs": OUTPUT_TYPES}
        spark.createDataFrame([(json.dumps(meta),)], "meta string").write.mode("overwrite") \
            .parquet(os.path.join(path, "meta"))

    def signature(self, spark: SparkSession) -> DataFrame:
        """(direction, column, type): what the model reads and adds."""
        rows = [("input", c, t) for c, t in self.input_types.items()]
        rows += [("output", c, t) for c, t in OUTPUT_TYPES.items()]
        return spark.createDataFrame(rows, "direction string, column string, type string")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "IsolationForestModel":
        nodes = spark.read.parquet(os.path.join(path, "nodes"))
        meta = json.loads(spark.read.parquet(os.path.join(path, "meta")).first()["meta"])
        return IsolationForestModel(nodes, meta["features"], meta["psi"], meta["offset"],
                                    meta["n_estimators"], meta["params"], meta["inputs"])


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def draw(seed: int, tree: int, node: int, what: str) -> float:
    """The uniform number in [0, 1) that belongs to a node: 52 bits of an MD5."""
    return int(hashlib.md5(f"{seed}:{tree}:{node}:{what}".encode()).hexdigest()[:13], 16) / 2 ** 52


def choose_split(seed: int, tree: int, node: int, lo: np.ndarray, hi: np.ndarray):
    """(feature number, threshold) of a node with these ranges, or None if all are constant."""
    varies = np.flatnonzero(hi > lo)
    if not len(varies):
        return None
    f = int(varies[int(draw(seed, tree, node, "feature") * len(varies))])
    cut = float(lo[f] + draw(seed, tree, node, "threshold") * (hi[f] - lo[f]))
    return f, float(lo[f]) if cut >= hi[f] else cut


def _node_row(tree: int, node: int, n: int, split, names: list[str]) -> tuple:
    depth = node.bit_length() - 1
    if split is None:
        return tree, node, depth, None, None, None, None, n, float(depth + average_path_length([n])[0])
    return tree, node, depth, names[split[0]], split[1], 2 * node, 2 * node + 1, n, None


_NODE_COLUMNS = [part.split()[0] for part in NODE_SCHEMA.split(", ")]


def _grow(features: list[str], seed: int, max_depth: int, tree_features: dict):
    """The subtree under one node from its rows."""
    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        t, top = int(pdf["tree_id"].iloc[0]), int(pdf["node_id"].iloc[0])
        feats = tree_features.get(t, features)
        x = pdf[feats].to_numpy(dtype=float)
        rows, stack = [], [(top, x)]
        while stack:
            node, own = stack.pop()
            split = None
            if node.bit_length() - 1 < max_depth and len(own) > 1:
                split = choose_split(seed, t, node, own.min(0), own.max(0))
            rows.append(_node_row(t, node, len(own), split, feats))
            if split is not None:
                left = own[:, split[0]] <= split[1]
                stack += [(2 * node, own[left]), (2 * node + 1, own[~left])]
        return pd.DataFrame(rows, columns=_NODE_COLUMNS)
    return grow


def _split_large(features: list[str], seed: int, tree_features: dict):
    """Node rows from the minima and maxima of large nodes (rows: tree, node, n, lows, highs)."""
    def run(batches):
        for pdf in batches:
            rows = []
            for t, node, n, low, high in zip(pdf["tree_id"], pdf["node_id"], pdf["n"], pdf["low"], pdf["high"]):
                feats = tree_features.get(t, features)
                at = [features.index(f) for f in feats]
                split = choose_split(seed, t, node, np.array(low, float)[at], np.array(high, float)[at])
                rows.append(_node_row(t, node, n, split, feats))
            yield pd.DataFrame(rows, columns=_NODE_COLUMNS)
    return run


def grow_forest(sample: DataFrame, features: list[str], psi: int, seed: int, max_depth: int,
                tree_features: dict, group_rows: int = GROUP_ROWS) -> DataFrame:
    """The node table from the trees' samples (tree_id, features ...)."""
    from sessionary.session import materialize
    rows = sample.withColumn("node_id", F.lit(ROOT).cast("long"))
    done = []
    for depth in range(max_depth if psi > group_rows else 0):
        rows = materialize(rows)  # read for the ranges, then for the descent
        sizes = rows.groupBy("tree_id", "node_id").agg(F.count(F.lit(1)).alias("n"), *[
            F.array(*[fn(F.col(f"`{f}`").cast("double")) for f in features]).alias(name)
            for fn, name in ((F.min, "low"), (F.max, "high"))])
        # the rows of a large node are at its level's depth: smaller ones wait for their group
        large = materialize(sizes.where((F.col("n") > group_rows)).mapInPandas(
            _split_large(features, seed, tree_features), NODE_SCHEMA))
        if large.limit(1).count() == 0:
            break
        done.append(large)
        place = F.array_position(F.array(*[F.lit(f) for f in features]), F.col("feature")).cast("int")
        x = F.element_at(F.array(*[F.col(f"`{f}`").cast("double") for f in features]), F.col("_f"))
        cuts = large.select("tree_id", "node_id", place.alias("_f"), "threshold", F.lit(True).alias("_large"))
        down = F.when(F.col("_large"), 2 * F.col("node_id") + (x > F.col("threshold")).cast("long"))
        # a large node without a split is a leaf already
        rows = (rows.join(cuts, ["tree_id", "node_id"], "left")
                .where(F.col("_large").isNull() | F.col("_f").isNotNull())
                .withColumn("node_id", F.coalesce(down, "node_id")).drop("_f", "threshold", "_large"))
    nodes = rows.groupBy("tree_id", "node_id").applyInPandas(
        _grow(features, seed, max_depth, tree_features), NODE_SCHEMA)
    for more in done:
        nodes = nodes.unionByName(more)
    return materialize(nodes)


def tree_samples(df: DataFrame, key: str, n_estimators: int, psi: int, n: int,
                 seed: int = 42) -> DataFrame:
    """Rows of every tree's sample, with ``tree_id`` (exactly ``psi`` per tree)."""
    spark = df.sparkSession
    # bracket top for the candidate filter: wider than any width bottom_k uses
    p = psi / n
    sd = math.sqrt(n * p * (1 - p))
    hi = 1.01 if psi >= n else min(1.0, (psi + 32 * sd + 2) / n)
    # every row's hash of every tree is compared as hex text, which needs no number made
    # of it; the bound is rounded up as the hash's double may be
    top = min(int(hi * TWO60) + 2 ** 8, 2 ** 60 - 1)
    ends = F.split(F.lit(" ".join(f":{t}" for t in range(n_estimators))), " ")
    cand = (df.withColumn("_start", F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
            .select("*", F.posexplode(ends).alias("tree_id", "_end"))
            .where(F.substring(F.md5(F.concat("_start", "_end")), 1, 15) <= F.lit(f"{top:015x}"))
            .drop("_start", "_end"))
    h, u = uniform_hash(key, "tree_id", seed=seed)
    cand = cand.withColumn(H, h).withColumn(U, u)
    # about psi + 32 sd + 2 candidates per tree: small, computed once
    from sessionary.session import materialize
    cand = materialize(cand)
    need = min(psi, n)
    short = (cand.groupBy("tree_id").count().where(F.col("count") < F.lit(need))
             .limit(1).count())
    if short == 0:
        # every tree has all rows below the bracket top, hence its psi smallest
        w = Window.partitionBy("tree_id").orderBy(U, H, key)
        return (cand.withColumn("_r", F.row_number().over(w))
                .where(F.col("_r") <= F.lit(psi)).drop("_r", U, H))
    targets = spark.createDataFrame([(t, psi, n) for t in range(n_estimators)],
                                    "tree_id int, _k long, _n long")
    return bottom_k(cand, ["tree_id"], targets, [key], widths=(8.0, 32.0)).drop(U, H)


def bootstrap_samples(df: DataFrame, key: str, n_estimators: int, psi: int, n: int,
                      seed: int = 42) -> DataFrame:
    """Samples with replacement: ``psi`` draws per tree, duplicates kept.

    Rows get dense positions 0..n-1 (distributed ranking); the draws are a
    ``T * psi`` table from a seeded generator (bounded: broadcast) and an
    equi-join on the position pulls the drawn rows, once per draw.
    """
    from sessionary.operators.graph import global_rank
    spark = df.sparkSession
    rng = np.random.default_rng([seed, 7])
    draws = pd.DataFrame({"tree_id": np.repeat(np.arange(n_estimators), psi).astype("int32"),
                          "_pos": rng.integers(0, n, size=n_estimators * psi)})
    picks = spark.createDataFrame(draws, "tree_id int, _pos long")
    ranked = global_rank(df, [key], "_pos").withColumn("_pos", F.col("_pos") - 1)
    return ranked.join(F.broadcast(picks), "_pos").drop("_pos")


def sample_size(max_samples, n: int) -> int:
    """psi, the rows of a tree, of ``n`` rows in all."""
    if max_samples == "auto":
        psi = min(256, n)
    elif isinstance(max_samples, float) and max_samples <= 1.0:
        psi = int(max_samples * n)
    else:
        psi = min(int(max_samples), n)
    return max(psi, 1)


def shared_samples(df: DataFrame, features: list[str], grid: list[dict],
                   key: str = "visitorid") -> list[dict]:
    """Per grid point what ``fit`` takes as prepared: the number of rows and the trees' rows.

    A tree's sample without replacement depends on its number, its size and the seed, not
    on how many trees there are: points that differ in other settings share one pass over the
    table, made for the largest of their forests.  Points with replacement draw for themselves."""
    from sessionary.session import materialize
    n = df.count()
    common = lambda point: (sample_size(point.get("max_samples", "auto"), n),
                            point.get("random_state", 42))
    trees: dict = {}
    for point in grid:
        if not point.get("bootstrap", False):
            trees[common(point)] = max(trees.get(common(point), 0), point.get("n_estimators", 100))
    samples = {which: materialize(tree_samples(df.select(key, *features), key, most, which[0], n, which[1]))
               for which, most in trees.items()}
    return [{"n": n} if point.get("bootstrap", False) else
            {"n": n, "sample": samples[common(point)].where(F.col("tree_id") < point.get("n_estimators", 100))}
            for point in grid]


def fit(df: DataFrame, features: list[str], key: str = "visitorid", n_estimators: int = 100,
        max_samples="auto", contamination="auto", max_features: float = 1.0,
        bootstrap: bool = False, random_state: int = 42, n: int | None = None,
        group_rows: int = GROUP_ROWS, sample: DataFrame | None = None,
        **_ignored) -> IsolationForestModel:
    """M2: fit an isolation forest on ``df[features]`` (``key`` must be unique).

    ``bootstrap=False`` draws each tree's ``psi`` rows without replacement
    (bottom-k by hash); ``bootstrap=True`` with replacement.  ``sample`` passes the
    trees' rows where a grid's runs share them (see ``shared_samples``)."""
    n = n if n is not None else df.count()
    psi = sample_size(max_samples, n)
    max_depth = int(math.ceil(math.log2(max(psi, 2))))
    n_feat = max(1, int(max_features * len(features))) if isinstance(max_features, float) \
        else int(max_features)
    tree_features = {}
    if n_feat < len(features):
        rng = np.random.default_rng(random_state)
        for t in range(n_estimators):
            pick = sorted(rng.choice(len(features), n_feat, replace=False))
            tree_features[t] = [features[i] for i in pick]
    if sample is None:
        sampled = bootstrap_samples if bootstrap else tree_samples
        sample = sampled(df.select(key, *features), key, n_estimators, psi, n, random_state)
    nodes = grow_forest(sample, features, psi, random_state, max_depth, tree_features, group_rows)
    model = IsolationForestModel(nodes, list(features), psi, -0.5, n_estimators,
                                 {"n_estimators": n_estimators, "max_samples": max_samples,
                                  "contamination": contamination,
                                  "max_features": max_features, "bootstrap": bootstrap,
                                  "random_state": random_state},
                                 {f: df.schema[f].dataType.simpleString() for f in features})
    if contamination != "auto":
        # exact percentile without a single-task merge (sketch bracket + counts)
        from sessionary.operators.quantiles import exact_quantiles
        scored = model.transform(df.select(key, *features), keep=[key])
        q = exact_quantiles(scored, [], "score_samples", [float(contamination)]).first()
        model.offset = float(q["quantile"])
    return model


def correct_labels(df: DataFrame, label: str = "anomaly_label",
                   purchases: str = "num_txs") -> DataFrame:
    """Visitors who bought are not anomalous (-1 -> 1 when purchases > 0)."""
    return df.withColumn(label, F.when((F.col(label) == -1) & (F.col(purchases) > 0), 1)
                         .otherwise(F.col(label)).cast("int"))


def split_importance(model: IsolationForestModel, spark: SparkSession) -> DataFrame:
    """Share of all splits that use each feature; unused features get 0.

    A forest without any split gives every feature NULL."""
    nodes = model.nodes.where(F.col("feature").isNotNull())
    # one row per feature: a whole-table window over a handful of rows
    total = F.sum("splits").over(Window.partitionBy())
    counts = nodes.groupBy("feature").agg(F.count(F.lit(1)).alias("splits"))
    names = spark.createDataFrame([(f,) for f in model.features], "feature string")
    allf = names.join(counts, "feature", "left").fillna(0, ["splits"])
    return (allf.select("feature", F.try_divide("splits", total).alias("weight"))
            .orderBy(F.desc("weight"), "feature"))


def tree_rules(model: IsolationForestModel, spark: SparkSession, tree: int = 0) -> DataFrame:
    """The nodes of one tree with a readable rule per node."""
    nodes = model.nodes.where(F.col("tree_id") == tree)
    rule = F.when(F.col("feature").isNull(),
                  F.concat(F.lit("leaf n="), F.col("n").cast("string"),
                           F.lit(" value="), F.format_number("leaf_value", 4))) \
        .otherwise(F.concat(F.col("feature"), F.lit(" <= "),
                            F.format_number("threshold", 4)))
    return nodes.select("tree_id", "node_id", "depth", "feature", "threshold", "left",
                        "right", "n", "leaf_value", rule.alias("rule"))
