"""DuckDB SQL that grows and scores the registered forest again.

Every draw of the forest is an MD5 of (seed, tree, node), so plain SQL can repeat
it: the trees' samples by MD5 rank, one group of CTEs per level (ranges of every
node's features, the split, the descent), then all visitors descend all trees.
Trees of at most 256 rows have at most 8 levels.
"""

from __future__ import annotations

LEVELS, TREES, SEED = 8, 100, 42

_KEY60 = "CAST('0x' || substr(md5(concat_ws(':', {parts})), 1, 15) AS BIGINT)"


def _draw(what: str) -> str:
    return (f"(CAST('0x' || substr(md5(concat_ws(':', {SEED}, tree, node, '{what}')), 1, 13) AS BIGINT)"
            "::DOUBLE / 4503599627370496::DOUBLE)")


def average_path(n: str) -> str:
    return (f"(CASE WHEN {n} > 2 THEN 2.0 * (ln({n} - 1.0) + 0.5772156649015329::DOUBLE) - 2.0 * ({n} - 1.0) / {n} "
            f"WHEN {n} = 2 THEN 1.0 ELSE 0.0 END)")


def _level(d: int) -> str:
    return f"""
st{d} AS MATERIALIZED (
    SELECT tree, node, feature, pos, MIN(x) AS lo, MAX(x) AS hi, COUNT(*) AS n
    FROM at{d} JOIN samplevalues USING (tree, visitorid) GROUP BY ALL),
cand{d} AS (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY tree, node ORDER BY pos) - 1 AS k,
        COUNT(*) OVER (PARTITION BY tree, node) AS many
    FROM st{d}, psize WHERE hi > lo AND n > 1 AND {d} < max_depth),
cut{d} AS MATERIALIZED (
    SELECT tree, node, feature, CASE WHEN t >= hi THEN lo ELSE t END AS threshold
    FROM (SELECT *, lo + {_draw("threshold")} * (hi - lo) AS t FROM cand{d}
          WHERE k = CAST(floor({_draw("feature")} * many) AS BIGINT))),
at{d + 1} AS MATERIALIZED (
    SELECT tree, visitorid, 2 * node + CASE WHEN x > threshold THEN 1 ELSE 0 END AS node
    FROM at{d} JOIN cut{d} USING (tree, node) JOIN samplevalues USING (tree, visitorid, feature))"""


def _nodes(d: int) -> str:
    cut = (f"LEFT JOIN cut{d} USING (tree, node)" if d < LEVELS else
           "LEFT JOIN (SELECT tree, node, feature, threshold FROM cut0 WHERE false) USING (tree, node)")
    return f"""SELECT tree, node, {d} AS depth, feature, threshold, n
    FROM (SELECT tree, node, COUNT(*) AS n FROM at{d} GROUP BY ALL) {cut}"""


def _walk(d: int) -> str:
    return f"""
walk{d + 1} AS MATERIALIZED (
    SELECT w.tree, w.visitorid, CASE WHEN c.feature IS NULL THEN w.node
        ELSE 2 * w.node + CASE WHEN v.x > c.threshold THEN 1 ELSE 0 END END AS node
    FROM walk{d} w LEFT JOIN cut{d} c ON c.tree = w.tree AND c.node = w.node
        LEFT JOIN values_ v ON v.visitorid = w.visitorid AND v.feature = c.feature)"""


def forest_ctes(selected: str, features: list[str]) -> str:
    """CTEs after ``vf`` (features) and ``selected`` (SQL of the chosen feature names)."""
    names = ", ".join(f"'{f}'" for f in features)
    casts = ", ".join(f"CAST({f} AS DOUBLE) AS {f}" for f in features)
    levels = ",".join(_level(d) for d in range(LEVELS))
    nodes = "\n    UNION ALL ".join(_nodes(d) for d in range(LEVELS + 1))
    return f"""
chosen AS MATERIALIZED (
    SELECT feature, ROW_NUMBER() OVER (ORDER BY list_position([{names}], feature)) AS pos FROM ({selected})),
values_ AS MATERIALIZED (
    SELECT visitorid, feature, pos, x FROM (UNPIVOT (SELECT visitorid, {casts} FROM vf)
        ON {", ".join(features)} INTO NAME feature VALUE x) JOIN chosen USING (feature)),
psize AS MATERIALIZED (
    SELECT least(256, COUNT(*)) AS psi, ceil(log2(greatest(least(256, COUNT(*)), 2))) AS max_depth FROM vf),
at0 AS MATERIALIZED (
    SELECT tree, visitorid, 1::BIGINT AS node FROM (
        SELECT tree, visitorid, ROW_NUMBER() OVER (PARTITION BY tree
            ORDER BY {_KEY60.format(parts=f"{SEED}, visitorid, tree")}, visitorid) AS k
        FROM vf, range(0, {TREES}) t(tree)), psize WHERE k <= psi),
samplevalues AS MATERIALIZED (SELECT tree, visitorid, feature, pos, x FROM at0 JOIN values_ USING (visitorid)),
{levels},
nodes AS MATERIALIZED (
    SELECT tree, node, depth, feature, threshold, n,
        CASE WHEN feature IS NULL THEN depth + {average_path("n")} END AS leaf_value
    FROM ({nodes}))"""


def score_ctes() -> str:
    """CTE ``scored`` (visitorid, path_length, score_samples, anomaly_score, anomaly_label)."""
    walks = ",".join(_walk(d) for d in range(LEVELS))
    return f"""
walk0 AS (SELECT tree, visitorid, 1::BIGINT AS node FROM vf, range(0, {TREES}) t(tree)),
{walks},
paths AS (
    SELECT visitorid, AVG(leaf_value) AS path_length
    FROM walk{LEVELS} w JOIN nodes n ON n.tree = w.tree AND n.node = w.node GROUP BY visitorid),
scored AS MATERIALIZED (
    SELECT visitorid, path_length, s AS score_samples, s + 0.5 AS anomaly_score,
        CAST(CASE WHEN s + 0.5 < 0 THEN -1 ELSE 1 END AS INTEGER) AS anomaly_label
    FROM (SELECT visitorid, path_length, -pow(2.0, -path_length / {average_path("psi")}) AS s
          FROM paths, psize))"""


NODE_COLUMNS = """CAST(tree AS INTEGER) AS tree_id, node AS node_id, CAST(depth AS INTEGER) AS depth, feature,
    round(threshold, 6) AS threshold, CASE WHEN feature IS NOT NULL THEN 2 * node END AS "left",
    CASE WHEN feature IS NOT NULL THEN 2 * node + 1 END AS "right", n, round(leaf_value, 6) AS leaf_value"""

IMPORTANCE = """importance AS (
    SELECT feature, coalesce(splits, 0) / SUM(splits) OVER () AS weight FROM chosen
        LEFT JOIN (SELECT feature, COUNT(*) AS splits FROM nodes WHERE feature IS NOT NULL GROUP BY feature)
        USING (feature))"""


def shap_ctes(visitors: str = "SELECT visitorid FROM vf") -> str:
    """CTEs ``phi`` (visitorid, feature, shap_value) and ``base`` after ``nodes``.

    A leaf's path has at most 8 different features.  Whether a visitor satisfies the
    splits of each is a bit pattern; a feature's share of a leaf's value follows
    from the pattern alone: the coefficients of prod_{j != i} (z_j + o_j t),
    weighted by s! (m - s - 1)! / m!.
    """
    k8 = range(LEVELS)

    def wide(expr: str, name: str, missing: str) -> str:
        return ", ".join(f"coalesce(MAX({expr}) FILTER (WHERE idx = {k}), {missing}) AS {name}{k}" for k in k8)
    bits = " + ".join(f"CASE WHEN xs[f{k}] > lo{k} AND xs[f{k}] <= hi{k} THEN {1 << k} ELSE 0 END" for k in k8)
    ones = ", ".join(f"(pattern >> {k}) & 1 AS o{k}" for k in k8)
    start = "1.0::DOUBLE AS c0, " + ", ".join(f"0.0::DOUBLE AS c{k}" for k in range(1, LEVELS))
    steps, source = [], "start"
    for j in k8:
        z, o = f"CASE WHEN i = {j} THEN 1.0 ELSE z{j} END", f"CASE WHEN i = {j} THEN 0 ELSE o{j} END"
        new = ", ".join([f"c0 * ({z}) AS c0"] + [f"c{k} * ({z}) + c{k - 1} * ({o}) AS c{k}" for k in range(1, LEVELS)])
        steps.append(f"poly{j} AS (SELECT * REPLACE ({new}) FROM {source})")
        source = f"poly{j}"
    weight = " + ".join(f"CASE WHEN {k} < m THEN c{k} * factorial({k}) * factorial(greatest(m - {k} - 1, 0)::INT) "
                        "/ factorial(m::INT) ELSE 0 END" for k in k8)
    pick = lambda name: "CASE i " + " ".join(f"WHEN {k} THEN {name}{k}" for k in k8) + " END"
    return f"""
leaves AS (SELECT * FROM nodes WHERE feature IS NULL AND depth > 0),
onpath AS (
    SELECT l.tree, l.node AS leaf, a.feature,
        MAX(CASE WHEN c.node % 2 = 1 THEN a.threshold END) AS lo,
        MIN(CASE WHEN c.node % 2 = 0 THEN a.threshold END) AS hi, product(c.n / a.n) AS z
    FROM leaves l JOIN range(0, {LEVELS}) t(j) ON j < l.depth
        JOIN nodes a ON a.tree = l.tree AND a.node = l.node >> (l.depth - j)::BIGINT
        JOIN nodes c ON c.tree = l.tree AND c.node = l.node >> (l.depth - j - 1)::BIGINT
    GROUP BY ALL),
numbered AS (
    SELECT o.*, pos, ROW_NUMBER() OVER (PARTITION BY tree, leaf ORDER BY pos) - 1 AS idx
    FROM onpath o JOIN chosen USING (feature)),
leafwide AS MATERIALIZED (
    SELECT tree, leaf, COUNT(*) AS m, {wide("pos", "f", "1")}, {wide("coalesce(lo, '-infinity'::DOUBLE)", "lo", "'infinity'::DOUBLE")},
        {wide("coalesce(hi, 'infinity'::DOUBLE)", "hi", "0.0")}, {wide("z", "z", "1.0")}
    FROM numbered GROUP BY tree, leaf),
points AS (SELECT visitorid, list(x ORDER BY pos) AS xs FROM values_
           WHERE visitorid IN ({visitors}) GROUP BY visitorid),
met AS MATERIALIZED (SELECT visitorid, tree, leaf, {bits} AS pattern FROM points, leafwide),
start AS (
    SELECT w.*, pattern, i, {ones}, {start}
    FROM (SELECT DISTINCT tree, leaf, pattern FROM met) JOIN leafwide w USING (tree, leaf), range(0, {LEVELS}) t(i)
    WHERE i < m),
{", ".join(steps)},
shares AS MATERIALIZED (
    SELECT p.tree, p.leaf, pattern, {pick("f")} AS pos,
        leaf_value / {TREES} * (({pick("o")}) - ({pick("z")})) * ({weight}) AS share
    FROM {source} p JOIN nodes n ON n.tree = p.tree AND n.node = p.leaf),
summed AS (SELECT visitorid, pos, SUM(share) AS v FROM met JOIN shares USING (tree, leaf, pattern) GROUP BY ALL),
phi AS MATERIALIZED (
    SELECT visitorid, feature, coalesce(v, 0.0) AS shap_value
    FROM (SELECT visitorid, feature, pos FROM points CROSS JOIN chosen) LEFT JOIN summed USING (visitorid, pos)),
base AS (
    SELECT SUM(n.leaf_value * n.n / r.n) / {TREES} AS base_value
    FROM nodes n JOIN nodes r ON r.tree = n.tree AND r.node = 1 WHERE n.feature IS NULL)"""
