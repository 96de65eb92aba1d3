"""Shapley explanations of the isolation forest.

The explained output is the expected path length ``E[h(x)]`` (mean over trees
of leaf depth + c(leaf size)).  Attributions are path-dependent tree SHAP: the
value of a coalition ``S`` at a leaf is the leaf value times, for every
feature on the leaf's path, either "x satisfies all its splits" (feature in
``S``) or "the share of training samples that took those branches" (feature
not in ``S``).  For a leaf whose path has ``m`` distinct features with
indicators ``o_j`` and cover shares ``z_j``, feature ``i`` receives

    v * (o_i - z_i) * sum_s w(s, m) * [t^s] prod_{j != i} (z_j + o_j t),
    w(s, m) = s! (m - s - 1)! / m!

which depends on the row only by its indicators: numpy evaluates it (polynomial
product, then one synthetic division per feature) for every pattern of a leaf's
indicators ahead.  Neighbouring leaves (all below one node) share a table of their
summed attributions for every combination of intervals, so a row looks up one number
per feature and part of a tree, not per feature and leaf.  Paths of more than
``TABLE_FEATURES`` features are evaluated for the patterns that the rows at hand have.  The node
table is bounded (``T (2 psi - 1)`` rows) and ships to the tasks; rows are
processed in Arrow batches by ``mapInPandas`` - nothing per row in Python.
Local accuracy holds: ``base_value + sum(shap) = E[h(x)]``.
"""

from __future__ import annotations

import math
from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionary.operators.iforest import ROOT, IsolationForestModel


#: Leaves whose paths have at most this many features get a table of every pattern.
TABLE_FEATURES = 10
#: Leaves below one node share a table while it has at most this many combinations of states.
PART_STATES = 1_024
ROWS_AT_ONCE = 16_384


def _attributions(o: np.ndarray, z: np.ndarray, v: np.ndarray) -> np.ndarray:
    """(leaves, m, patterns) attributions for indicators ``o`` (patterns, m), cover
    shares ``z`` (leaves, m) and leaf values ``v`` (leaves)."""
    P, m = o.shape
    L = len(z)
    w = np.array([factorial(s) * factorial(m - s - 1) / factorial(m) for s in range(m)])
    # P(t) = prod_j (z_j + o_j t), coefficients (L, P, m + 1)
    p = np.zeros((L, P, m + 1))
    p[..., 0] = 1.0
    for j in range(m):
        shifted = np.concatenate([np.zeros((L, P, 1)), p[..., :-1]], axis=2)
        p = z[:, j, None, None] * p + o[:, j, None] * shifted
    out = np.empty((L, m, P))
    for i in range(m):
        zi, oi = z[:, i, None], o[:, i]
        # divide by (z_i + o_i t): constant when o_i = 0, synthetic when 1
        c_const = p[..., :m] / zi[..., None]
        c_lin = np.zeros((L, P, m))
        c_lin[..., m - 1] = p[..., m]
        for s in range(m - 1, 0, -1):
            c_lin[..., s - 1] = p[..., s] - zi * c_lin[..., s]
        c = np.where(oi[:, None] > 0, c_lin, c_const)
        out[:, i] = v[:, None] * (oi - zi) * (c * w).sum(axis=2)
    return out


def _bits(codes: np.ndarray, m: int) -> np.ndarray:
    """(patterns, m) indicators of the codes' bits."""
    return ((codes[:, None] >> np.arange(m)) & 1).astype(float)


def _part_table(part: dict, leaves: list, features: list[int], sizes: list[int]) -> np.ndarray:
    """(features, combinations of states) attributions, summed over the leaves of a part."""
    table = np.zeros((len(features), *sizes))
    for bounds, own in leaves:
        order = sorted(bounds)
        code = np.zeros([1] * len(sizes), dtype=int)
        for bit, f in enumerate(order):
            k = features.index(f)
            (lo, hi), cuts = part[f]
            ends = np.array([lo, *cuts, hi])
            inside = np.append(False, (ends[:-1] >= bounds[f][0]) & (ends[1:] <= bounds[f][1]))
            code = code + (inside << bit).reshape([-1 if i == k else 1 for i in range(len(sizes))])
        for bit, f in enumerate(order):
            table[features.index(f)] += own[bit][code]
    return table.reshape(len(features), -1)


def _tree_paths(nodes: pd.DataFrame, fidx: dict, scale: float):
    """Per tree: conditions (feature, lo, hi), parts (conditions with their weights in a
    row's code, features, (cover shares, value) of a single leaf without a table, table of
    the attributions of every code or None), base value.

    A part is all leaves below one node.  Its attributions depend on a row by one state of
    each feature on its paths: 0 outside the node's bounds, else the number of the interval
    between the part's own thresholds.  Parts are as large as ``PART_STATES`` allows."""
    trees = []
    for _, g in nodes.groupby("tree_id", sort=True):
        rows = {r["node_id"]: r for r in g.to_dict("records")}
        leaves = []
        conditions: dict = {}
        found = []  # (bounds of the part's node, its thresholds, numbers of its leaves)

        def walk(nid, bounds, z):
            """The thresholds and leaves below a node if they are one part so far, else None."""
            row = rows[nid]  # noqa: B023
            if not isinstance(row["feature"], str):
                leaves.append((bounds, z, float(row["leaf_value"]) * scale))  # noqa: B023
                return {}, [len(leaves) - 1]  # noqa: B023
            f = fidx[row["feature"]]
            thr = float(row["threshold"])
            n = float(row["n"])
            below = []
            for child, is_left in ((int(row["left"]), True), (int(row["right"]), False)):
                lo, hi = bounds.get(f, (-np.inf, np.inf))
                nb = dict(bounds)
                nb[f] = (lo, min(hi, thr)) if is_left else (max(lo, thr), hi)
                nz = dict(z)
                nz[f] = nz.get(f, 1.0) * float(rows[child]["n"]) / n  # noqa: B023
                below.append((nb, walk(child, nb, nz)))
            if all(part is not None for _, part in below):
                cuts = {f: {thr}}
                for _, (more, _) in below:
                    for k, own in more.items():
                        cuts[k] = cuts.get(k, set()) | own
                own = below[0][1][1] + below[1][1][1]
                states = math.prod(len(cuts.get(k, ())) + 2 for k in {*bounds, *cuts})
                short = all(len(leaves[k][0]) <= TABLE_FEATURES for k in own)  # noqa: B023
                if short and states <= PART_STATES:
                    return cuts, own
            found.extend((nb, *part) for nb, part in below if part is not None)  # noqa: B023
            return None

        whole = walk(ROOT, {}, {})
        if whole is not None:
            found.append(({}, *whole))
        by_length: dict = {}
        for k, (bounds, _, _) in enumerate(leaves):
            by_length.setdefault(len(bounds), []).append(k)
        tables: dict = {}
        for m, own in by_length.items():
            if 0 < m <= TABLE_FEATURES:
                z = np.array([[leaves[k][1][f] for f in sorted(leaves[k][0])] for k in own])
                tables.update(zip(own, _attributions(_bits(np.arange(2 ** m), m), z,
                                                     np.array([leaves[k][2] for k in own]))))
        prepared = []
        for bounds, cuts, own in found:
            part = {f: (bounds.get(f, (-np.inf, np.inf)), sorted(cuts.get(f, ()))) for f in {*bounds, *cuts}}
            features = sorted(part)
            if not features:
                continue
            sizes = [len(part[f][1]) + 2 for f in features]
            codes, weight = [], 1
            for f, size in zip(features[::-1], sizes[::-1]):
                (lo, hi), inner = part[f]
                codes += [(conditions.setdefault((f, low, hi), len(conditions)), weight) for low in (lo, *inner)]
                weight *= size
            if own[0] in tables:
                table = _part_table(part, [(leaves[k][0], tables[k]) for k in own], features, sizes)
                prepared.append((codes, features, None, table))
            else:  # a single leaf: two states a feature
                _, z, v = leaves[own[0]]
                prepared.append((codes, features, ([z[f] for f in features[::-1]], v), None))
        base = sum(v * float(np.prod(list(z.values()))) for _, z, v in leaves)
        trees.append((list(conditions), prepared, float(base)))
    return trees


def shap_matrix(x: np.ndarray, trees, n_features: int) -> np.ndarray:
    """(rows, features) attributions for the prepared ``trees``.

    A row's states in a part make a code.  Equal codes have equal attributions, so they are
    computed once per code - ahead, as a table, for short paths - and looked up."""
    columns = np.ascontiguousarray(x.T)
    phi = np.zeros((n_features, len(x)))
    looked = np.empty(len(x))
    for conditions, parts, _ in trees:
        met = [(columns[f] > lo) & (columns[f] <= hi) for f, lo, hi in conditions]
        for codes, features, leaf, table in parts:
            # narrow codes are quicker to add up
            kind = np.int16 if table is not None and table.shape[1] <= 2 ** 15 else np.intp
            code = np.zeros(len(x), dtype=kind)
            for c, weight in codes:
                code += met[c] * kind(weight)
            if table is None:
                z, v = leaf
                codes, code = np.unique(code, return_inverse=True)
                table = _attributions(_bits(codes, len(z)), np.array([z]), np.array([v]))[0][::-1]
            code = code.astype(np.intp)
            for own, f in zip(table, features):
                own.take(code, out=looked, mode="clip")
                phi[f] += looked
    return phi.T


class ForestExplainer:
    """E3-E7 over a fitted :class:`IsolationForestModel`."""

    def __init__(self, model: IsolationForestModel):
        self.model = model
        self.features = list(model.features)
        fidx = {f: i for i, f in enumerate(self.features)}
        self.trees = _tree_paths(model.node_rows(), fidx, 1.0 / max(1, model.n_estimators))
        self.base_value = float(sum(t[-1] for t in self.trees))

    def shap_values(self, df: DataFrame, key: str = "visitorid") -> DataFrame:
        """One row per input row: key, ``shap_<feature>`` ..., base_value."""
        feats, base = self.features, self.base_value
        held = df.sparkSession.sparkContext.broadcast(self.trees)
        k = len(feats)

        def fn(batches):
            for pdf in batches:
                x = pdf[feats].to_numpy(dtype=float)
                # many rows at a time: numpy's cost per call is small beside them
                phi = np.concatenate([np.zeros((0, k))] + [
                    shap_matrix(x[at:at + ROWS_AT_ONCE], held.value, k)
                    for at in range(0, len(x), ROWS_AT_ONCE)])
                out = pd.DataFrame(phi, columns=[f"shap_{f}" for f in feats])
                out.insert(0, key, pdf[key].to_numpy())
                out["base_value"] = base
                yield out

        key_type = df.schema[key].dataType.simpleString()
        schema = ", ".join([f"`{key}` {key_type}"] + [f"`shap_{f}` double" for f in feats]
                           + ["base_value double"])
        return df.select(key, *feats).mapInPandas(fn, schema)

    def importance(self, shap: DataFrame) -> DataFrame:
        """Mean |SHAP| per feature, descending."""
        one = shap.agg(*[F.avg(F.abs(f"shap_{f}")).alias(f) for f in self.features])
        return (one.unpivot([], self.features, "feature", "weight")
                .orderBy(F.desc("weight"), "feature"))

    def top(self, shap: DataFrame, n: int = 20) -> DataFrame:
        """E5: the ``n`` most important features (data of the bar summary)."""
        return self.importance(shap).limit(n)

    def dependence(self, data: DataFrame, shap: DataFrame, feature: str,
                   interaction: str | None = None, key: str = "visitorid") -> DataFrame:
        """(feature value, its SHAP value, interaction feature value)."""
        if interaction is None:
            ranked = [r["feature"] for r in self.importance(shap).limit(2).collect()]
            interaction = next((f for f in ranked if f != feature), feature)
        return (data.select(key, F.col(feature).cast("double").alias("value"),
                            F.col(interaction).cast("double").alias("interaction_value"))
                .join(shap.select(key, F.col(f"shap_{feature}").alias("shap_value")), key)
                .select(key, F.lit(feature).alias("feature"), "value", "shap_value",
                        F.lit(interaction).alias("interaction"), "interaction_value"))

    def instance(self, data: DataFrame, key_value, key: str = "visitorid") -> DataFrame:
        """Base value and the per-feature contributions of one row.

        Only the wanted row is explained."""
        row = data.where(F.col(key) == F.lit(key_value))
        row_vals = (row.select(key, *[F.col(f).cast("double").alias(f) for f in self.features])
                    .unpivot([key], self.features, "feature", "value"))
        row_shap = (self.shap_values(row, key)
                    .select(key, "base_value", *[F.col(f"shap_{f}").alias(f)
                                                for f in self.features])
                    .unpivot([key, "base_value"], self.features, "feature", "shap_value"))
        return row_vals.join(row_shap, [key, "feature"]).select(
            key, "feature", "value", "shap_value", "base_value")
