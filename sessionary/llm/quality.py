"""Quality rules with an isolation forest on the rule statistics (operator 4).

Every document gets its rule statistics from its whole text.  Two base rules
reject outright; for the rest an isolation forest scores how few random splits
set the document's statistics apart, and documents beyond a threshold go.

Fit: all labelled documents, less those that the base rules reject, halved by a
hash of their ids.  The good rows of one half set each rule's limits (all but
their tails keep it, by exact quantiles); the forest's rows are the amounts by
which a document breaks the rules, and each tree grows from the ``tree_rows`` rows
of that half with the smallest hashes of (id, tree), as isolation trees do; these
rows alone reach the driver.  The other half sets the threshold, where losing a
share of its good rows counts ``good_cost`` times as much as keeping that share
of its bad ones: counts by score and running sums over the sorted scores.
Scoring is one map over all documents.

Defined results: null or empty text: no words, so the base rules reject it;
labels absent, empty or without good rows: no forest, the base rules decide
alone; no bad rows: the threshold lies above every good row; null ids, null
qualities and labels without a document are not used for the fit; repeated
documents get equal verdicts; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionary.operators.quantiles import quantile_columns
from sessionary.session import materialize

N_TREES = 100
TREE_ROWS = 128
GOOD_COST = 20.0
RULE_TAIL = 0.0005
SEED = 42

#: The symbols that the rules count.
SYMBOLS = b"#*$%&|<>"
_CONTINUATION = bytes(range(0x80, 0xC0))
_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_DIGITS = b"0123456789"
_ENDS = b".!?"

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = ("log_words", "word_length", "symbols", "dup_lines", "repeat_words", "distinct_words",
            "upper", "digits", "sentence_ends", "line_words", "top_word")
_SCHEMA = ", ".join([f"{c} bigint" for c in COUNTS] + [f"{c} double" for c in (*FEATURES, "score")])


def repeated_words(words: list[bytes], width: int = 5) -> int:
    """Words inside windows of ``width`` words that occur twice or more."""
    windows = list(zip(*(words[k:] for k in range(width))))
    if len(set(windows)) == len(windows):
        return 0
    times, covered = Counter(windows), bytearray(len(words))
    for k, window in enumerate(windows):
        if times[window] > 1:
            covered[k:k + width] = b"\x01" * width
    return sum(covered)


def statistics(text: str | None) -> tuple:
    """The counts of ``COUNTS`` and the ratios of ``FEATURES`` of one whole text."""
    raw = (text or "").encode("utf-8")
    words = raw.split()
    n = len(words)
    chars = len(b"".join(words).translate(None, _CONTINUATION))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    dup_lines = len(lines) - len(set(lines))
    repeat = repeated_words(words)
    times = Counter(words)
    per_word, size = max(n, 1), max(len(raw), 1)
    share = lambda signs: (len(raw) - len(raw.translate(None, signs))) / size
    return (n, chars, symbols, dup_lines, repeat,
            float(np.log1p(n)), chars / per_word, symbols / per_word, dup_lines / max(len(lines), 1),
            repeat / per_word, len(times) / per_word, share(_UPPER), share(_DIGITS),
            (len(raw) - len(raw.translate(None, _ENDS))) / per_word, n / max(len(lines), 1),
            max(times.values(), default=0) / per_word)


def rule_statistics(text: Column, held=None) -> Column:
    """Struct of ``COUNTS``, ``FEATURES`` and ``score`` for a text column.

    ``held``: a broadcast forest; without one the score is 0.
    """
    @F.pandas_udf(_SCHEMA)
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for own in texts:
            rows = pd.DataFrame([statistics(x) for x in own], columns=[*COUNTS, *FEATURES])
            rows["score"] = 0.0 if held is None else held.value.score(
                rows[list(FEATURES)].to_numpy(float))
            yield rows
    return run(text)


def _expected_path(n: np.ndarray | float) -> np.ndarray:
    """Mean path length of an unsuccessful search among n rows."""
    n = np.asarray(n, float)
    safe = np.maximum(n, 2)
    mean = 2 * (np.log(safe - 1) + 0.5772156649015329) - 2 * (safe - 1) / safe
    return np.where(n > 2, mean, np.where(n == 2, 1.0, 0.0))


@dataclass
class Forest:
    """Trees as heap-numbered arrays: split feature (-1: leaf), split value, path length."""
    feature: np.ndarray
    split: np.ndarray
    path: np.ndarray
    depth: int
    norm: float
    limits: tuple[np.ndarray, np.ndarray, np.ndarray]
    threshold: float = np.inf

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Anomaly score in (0, 1): the higher, the fewer splits set a row apart."""
        rows = excess(rows, self.limits)
        total, every = np.zeros(len(rows)), np.arange(len(rows))
        for feature, split, path in zip(self.feature, self.split, self.path):
            at = np.zeros(len(rows), np.int64)
            for _ in range(self.depth):
                own = feature[at]
                down = 2 * at + 1 + (rows[every, np.maximum(own, 0)] >= split[at])
                at = np.where(own >= 0, down, at)
            total += path[at]
        return np.exp2(-total / len(self.feature) / self.norm)


def rule_limits(good: DataFrame, tail: float = RULE_TAIL) -> tuple:
    """(low, high, scale) per statistic: the range of all but the tails of the good rows."""
    ends = {r["feature"]: (r["low"], r["high"]) for r in quantile_columns(
        good.unpivot([], list(FEATURES), "feature", "value"), ["feature"], "value",
        {"low": tail, "high": 1 - tail}).collect()}
    spread = np.array(good.agg(*[F.stddev_pop(c) for c in FEATURES]).first(), float)
    low, high = np.array([ends[c] for c in FEATURES], float).T
    return low, high, np.where(spread > 0, spread, 0.05)


def excess(rows: np.ndarray, limits: tuple) -> np.ndarray:
    """How far each statistic lies beyond its rule's limits: log(1 + spreads).

    Rows that keep every rule are all zeros, so splits fall between them and
    the rule breakers; slight excesses stay near zero and the tall tail of a
    gross breach counts less.
    """
    low, high, scale = limits
    return np.log1p(np.maximum(0, np.maximum(low - rows, rows - high)) / scale)


def tree_samples(rows: DataFrame, n: int, n_trees: int = N_TREES, tree_rows: int = TREE_ROWS,
                 seed: int = SEED) -> list[np.ndarray]:
    """For each tree the ``tree_rows`` of n rows with the smallest hashes of (doc_id, tree).

    A row goes only to the trees in whose bracket its hash falls; the bracket holds
    somewhat more than enough rows, and widens should it hold too few for a tree."""
    size = min(tree_rows, n)
    share = (size + 6 * size ** 0.5 + 6) / max(n, 1)
    while True:
        top = int(-2 ** 63 + min(share, 1.0) * (2 ** 64 - 1))
        hashes = F.transform(F.sequence(F.lit(0), F.lit(n_trees - 1)), lambda t: F.struct(
            t.alias("tree"), F.xxhash64("doc_id", F.lit(seed), t).alias("h")))
        chosen = (rows.select("doc_id", *FEATURES, F.explode(F.filter(
            hashes, lambda x: x["h"] <= F.lit(min(top, 2 ** 63 - 1)))).alias("_t"))
            .select("doc_id", "_t.tree", "_t.h", *FEATURES).toPandas().sort_values(["tree", "h", "doc_id"]))
        held = chosen.groupby("tree").head(size)
        if len(held) == n_trees * size or share >= 1:
            return [own[list(FEATURES)].to_numpy(float) for _, own in held.groupby("tree")]
        share *= 4


def grow(samples: list[np.ndarray], limits: tuple, seed: int = SEED) -> Forest:
    """A tree for each sample, by random splits between the smallest and the largest value
    of a random feature."""
    rng = np.random.default_rng(seed)
    n_trees, size = len(samples), max(len(x) for x in samples)
    depth = max(1, int(np.ceil(np.log2(max(size, 2)))))
    nodes = 2 ** (depth + 1) - 1
    feature = np.full((n_trees, nodes), -1, np.int64)
    split, path = np.zeros((n_trees, nodes)), np.zeros((n_trees, nodes))
    for tree in range(n_trees):
        todo = [(0, 0, excess(samples[tree], limits))]
        while todo:
            at, level, own = todo.pop()
            low, high = own.min(axis=0), own.max(axis=0)
            varied = np.flatnonzero(high > low)
            if level == depth or len(own) <= 1 or not len(varied):
                path[tree, at] = level + _expected_path(len(own))
                continue
            f = rng.choice(varied)
            value = rng.uniform(low[f], high[f])
            right = own[:, f] >= value
            if right.all() or not right.any():  # a draw at the very edge
                value = high[f]
                right = own[:, f] >= value
            feature[tree, at], split[tree, at] = f, value
            todo += [(2 * at + 1, level + 1, own[~right]), (2 * at + 2, level + 1, own[right])]
    return Forest(feature, split, path, depth, float(max(_expected_path(size), 1.0)), limits)


def calibrate(good: np.ndarray, bad: np.ndarray, good_cost: float = GOOD_COST) -> float:
    """Scores above the returned threshold are rejected.

    The threshold makes the share of bad rows rejected less ``good_cost`` times
    the share of good rows rejected greatest, and of equals the highest; it
    lies in the middle of the gap between rows there.
    """
    if not len(good) or not len(bad):
        return float(good.max()) if len(good) else np.inf
    good, bad = np.sort(good), np.sort(bad)
    cuts = np.unique(np.concatenate([good, bad]))  # rejecting what lies above a cut
    gain = ((len(bad) - np.searchsorted(bad, cuts, "right")) / len(bad)
            - good_cost * (len(good) - np.searchsorted(good, cuts, "right")) / len(good))
    best = len(cuts) - 1 - int(np.argmax(gain[::-1]))
    return float(cuts[best:best + 2].mean())


def calibrate_rows(scored: DataFrame, good_cost: float = GOOD_COST) -> float:
    """:func:`calibrate` of (score, quality) rows, which stay in Spark."""
    counts = scored.groupBy("score").agg(F.sum((F.col("quality") == 1).cast("long")).alias("good"),
                                         F.sum((F.col("quality") == 0).cast("long")).alias("bad"))
    cuts = materialize(counts.orderBy("score").withColumn("_p", F.spark_partition_id()))
    parts = cuts.groupBy("_p").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"),
                                   F.max(F.when(F.col("good") > 0, F.col("score"))).alias("top")).collect()
    n_good, n_bad = sum(r["good"] for r in parts), sum(r["bad"] for r in parts)
    if not n_good or not n_bad:
        return max(r["top"] for r in parts if r["top"] is not None) if n_good else np.inf
    # rows up to a score: those of the partitions before it, and in its own one up to it
    before, rows = (0, 0), []
    for r in sorted(parts, key=lambda r: r["_p"]):
        rows.append((r["_p"], *before))
        before = (before[0] + r["good"], before[1] + r["bad"])
    offsets = scored.sparkSession.createDataFrame(rows, "_p int, _good long, _bad long")
    run = Window.partitionBy("_p").orderBy("score").rowsBetween(Window.unboundedPreceding, 0)
    gain = ((F.lit(n_bad) - F.col("_bad") - F.sum("bad").over(run)) / F.lit(n_bad)
            - F.lit(good_cost) * (F.lit(n_good) - F.col("_good") - F.sum("good").over(run)) / F.lit(n_good))
    best = cuts.join(F.broadcast(offsets), "_p").select("score", gain.alias("gain")).agg(
        F.max(F.struct("gain", "score")).alias("b")).first()["b"]["score"]
    above = cuts.where(F.col("score") > F.lit(best)).agg(F.min("score")).first()[0]
    return float(best if above is None else (best + above) / 2)


def fit(docs: DataFrame, labels: DataFrame, good_cost: float = GOOD_COST, seed: int = SEED,
        **options) -> Forest | None:
    """Forest and threshold from all labelled documents."""
    marked = (labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), "quality")
              .where("doc_id is not null and quality in (0, 1)")
              .groupBy("doc_id").agg(F.min("quality").alias("quality")))
    rows = materialize(
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), rule_statistics(F.col("text")).alias("s"))
        .join(marked, "doc_id")
        .select("doc_id", "quality", "s.*").groupBy("doc_id")
        .agg(*[F.min(c).alias(c) for c in ("quality", *COUNTS, *FEATURES)])
        .where(~base_failed(""))
        .withColumn("half", F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(2)) == 0))
    grown, held_out = rows.where("half"), rows.where("not half")
    good = grown.where("quality = 1")
    if good.limit(2).count() < 2:
        return None
    forest = grow(tree_samples(grown, grown.count(), seed=seed, **options), rule_limits(good), seed)
    held = docs.sparkSession.sparkContext.broadcast(forest)

    @F.pandas_udf("double")
    def scores(own: pd.DataFrame) -> pd.Series:
        return pd.Series(held.value.score(own[list(FEATURES)].to_numpy(float)))
    forest.threshold = calibrate_rows(held_out.select(
        scores(F.struct(*FEATURES)).alias("score"), "quality"), good_cost)
    return forest


def base_failed(prefix: str) -> Column:
    """The two rules that reject outright, on counts named ``prefix`` + name."""
    n, repeat = F.col(f"{prefix}n_words"), F.col(f"{prefix}n_repeat_words")
    return (n < 10) | (100 * repeat > 20 * n)


def judge(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``docs`` with its columns, plus ``__rules``: the counts, score, base_failed, kept."""
    forest = fit(docs, labels, **options)
    threshold = forest.threshold if forest else 1.0
    held = docs.sparkSession.sparkContext.broadcast(forest) if forest else None  # bounded by fit
    judged = docs.withColumn("__stats", rule_statistics(F.col("text"), held))
    failed = base_failed("__stats.")
    return judged.withColumn("__rules", F.struct(
        *[F.col(f"__stats.{c}").alias(c) for c in COUNTS], F.col("__stats.score").alias("score"),
        failed.alias("base_failed"),
        (~failed & (F.col("__stats.score") <= threshold)).alias("kept"))).drop("__stats")


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their columns."""
    return judge(docs, labels, **options).where("__rules.kept").drop("__rules")
