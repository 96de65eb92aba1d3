"""Quality rules (operator 4)."""
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sessionary.llm import quality
from sessionary.llm.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.llm.cases import EDGES, small_documents, table


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[k:k + 5]) for k in range(len(words) - 4)]
    times, covered = Counter(windows), set()
    for k, window in enumerate(windows):
        if times[window] > 1:
            covered.update(range(k, k + 5))
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(covered))


def check(rows, docs):
    expected = Counter()
    for doc, text in docs:
        counts = plain_counts(text)
        failed = counts[0] < 10 or 100 * counts[4] > 20 * counts[0]
        expected[(doc, *counts, failed)] += 1
    assert Counter((r["doc_id"], *(r[c] for c in quality.COUNTS), r["base_failed"])
                   for r in rows) == expected
    assert not any(r["kept"] and r["base_failed"] for r in rows)


def test_op4_on_the_table(spark):
    check(QUERIES["op4_quality_rules"](spark, SF_SMALL).collect(), small_documents())


def test_edges_without_labels(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = quality.judge(table(spark, EDGES), none).select("doc_id", "__rules.*").collect()
    check(rows, EDGES)
    assert all(r["kept"] != r["base_failed"] for r in rows)
    assert quality.judge(table(spark, []), none).count() == 0


def made_corpus(n=1500, bad_share=0.15):
    rng = np.random.default_rng(3)
    words = [f"{a}{b}" for a in "brcdlm" for b in ("ain", "old", "une", "ast", "ering")]
    docs, labels = [], []
    for k in range(n):
        bad = rng.random() < bad_share
        own = [f"{w}{rng.choice(['##', '%%', '$$'])}" if bad and rng.random() < 0.6 else w
               for w in rng.choice(words, rng.integers(40, 200))]
        docs.append((k, " ".join(own) + "."))
        labels.append((k, int(not bad), 0))
    return docs, labels


def test_forest_rejects_junk_and_keeps_clean_rows(spark):
    docs, labels = made_corpus()
    known = spark.createDataFrame(labels[:700] + [(None, 1, 0), (3, None, 0), (10**6, 0, 0)],
                                  "doc_id long, quality int, toxic int")
    good = {k for k, q, _ in labels if q}
    kept = {r["doc_id"] for r in quality.keep_good(table(spark, docs), known).collect()}
    held = set(range(700, len(docs)))
    assert len(kept & good & held) >= 0.99 * len(good & held)
    assert len(kept & held - good) <= 0.03 * len(held - good)


def test_keep_good_returns_the_columns(spark):
    docs, labels = made_corpus(60)
    frame = table(spark, docs)
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert quality.keep_good(frame, known).columns == frame.columns


def test_calibration_weighs_good_rows_more():
    rng = np.random.default_rng(0)
    good, bad = rng.normal(0.4, 0.02, 2000), rng.normal(0.6, 0.02, 300)
    t = quality.calibrate(good, bad)
    assert (good > t).mean() == 0 and (bad > t).mean() > 0.99
    assert quality.calibrate(np.append(good, 0.9), bad) < 0.56  # one odd good row does not decide
    assert quality.calibrate(good, good) == good.max()
    assert quality.calibrate(good, bad[:0]) == good.max()
    assert quality.calibrate(good[:0], bad) == np.inf


def test_limits_and_threshold_come_from_all_labelled_documents(spark, monkeypatch):
    """More labelled documents than any bound on the fit: each of them counts."""
    n = 9_000
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.concat(
        F.lit("some plain words that follow each other in this text number "), F.col("id").cast("string"),
        F.when(F.col("id") % 9 == 0, F.lit(" ## || ## || ##")).otherwise(F.lit(" end."))).alias("text"))
    known = docs.select("doc_id", (F.col("doc_id") % 9 != 0).cast("int").alias("quality"))
    seen = []
    limits, threshold = quality.rule_limits, quality.calibrate_rows

    def counted(rows, *args):
        seen.append(rows.count())
        return (limits if len(seen) == 1 else threshold)(rows, *args)
    monkeypatch.setattr(quality, "rule_limits", counted)
    monkeypatch.setattr(quality, "calibrate_rows", counted)
    forest = quality.fit(docs, known)
    assert seen[1] > 4_000 and abs(seen[0] - (n - seen[1]) * 8 / 9) < 100 and np.isfinite(forest.threshold)


def test_threshold_of_rows_equals_that_of_arrays(spark):
    rng = np.random.default_rng(2)
    good, bad = rng.normal(0.4, 0.1, 300).round(2), rng.normal(0.6, 0.1, 200).round(2)
    for g, b in ((good, bad), (good, bad[:0]), (good[:0], bad), (good, good)):
        rows = [(float(x), 1) for x in g] + [(float(x), 0) for x in b]
        frame = spark.createDataFrame(rows, "score double, quality int").repartition(5)
        assert quality.calibrate_rows(frame) == pytest.approx(quality.calibrate(g, b))
