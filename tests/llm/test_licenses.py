"""License scans (operator 1)."""
import math
import re
from collections import Counter

import numpy as np

from sessionary.llm import licenses
from sessionary.llm.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.llm.cases import EDGES, small_documents, table

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def best_share(words, own, width):
    """The greatest share of ``own`` that any block of ``width`` words holds."""
    held, best = Counter(), 0
    for end, word in enumerate(words):
        held[word] += word in own
        if end >= width:
            held[words[end - width]] -= words[end - width] in own
        best = max(best, sum(held[w] > 0 for w in own)) if word in own else best
    return best / len(own)


def plain(text):
    """Every block (one from each word on) against every template, without any filter."""
    words = plain_words(text)
    places, base = [], set()
    for phrase, label in licenses.PHRASES:
        own = phrase.split()
        for k in range(len(words) - len(own) + 1):
            if words[k:k + len(own)] == own:
                places.append(k)
                base.add(label)
    labels, score = set(base), 1.0 if base else 0.0
    for template, label in licenses.TEMPLATES:
        own = plain_words(template)
        share = best_share(words, set(own), max(licenses.BLOCK_WORDS, 2 * len(own)))
        if share * len(set(own)) >= math.ceil(licenses.THRESHOLD * len(set(own)) - 1e-9) - 1e-9:
            labels.add(label)
            score = max(score, share)
    return (len(words), len(places), min(places, default=None), max(places, default=None),
            ",".join(sorted(base)), ",".join(sorted(labels)), round(score, 9))


def found(rows):
    return Counter((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"],
                    r["base_labels"], r["labels"], round(r["score"], 9)) for r in rows)


def test_op1_on_the_table(spark):
    rows = QUERIES["op1_license_scan"](spark, SF_SMALL).collect()
    assert found(rows) == Counter((d, *plain(t)) for d, t in small_documents())


def test_planted_notices_and_edges(spark):
    rng = np.random.default_rng(2)
    fill = [f"w{k}" for k in range(50)] + ["license", "the", "under", "mit", "of", "version"]
    docs = list(EDGES)
    for k in range(150):
        words = rng.choice(fill, rng.integers(0, 120)).tolist()
        template = licenses.TEMPLATES[k % len(licenses.TEMPLATES)][0].split()
        if k % 3 == 0:
            template.pop(rng.integers(len(template)))
        if k % 4 == 0:
            template.insert(rng.integers(len(template)), "oddword")
        at = rng.integers(0, len(words) + 1)
        docs.append((1000 + k, " ".join(words[:at] + template + words[at:])))
    docs.append((2000, "MIT\nLicense, mit--license; Mit licenses apache\xa0license general public. license"))
    frame = table(spark, docs)
    rows = licenses.summary(licenses.scan(frame)).collect()
    assert found(rows) == Counter((d, *plain(t)) for d, t in docs)
    assert sum(r["labels"] != "" for r in rows) > 100
    assert licenses.summary(licenses.scan(table(spark, []))).count() == 0


def test_spread_notices_at_any_start(spark):
    """13 different words of a notice, one in each 2.5 words, from word 8 on."""
    notice = dict.fromkeys(licenses.words_of(licenses.TEMPLATES[1][0]))
    words = [w.decode() for w in notice][:13]
    docs = []
    for begin in range(20):
        text = ["filler"] * begin
        for k, w in enumerate(words):
            text += [w, "x", "y"][:2 + k % 2]
        docs.append((begin, " ".join(text + ["filler"] * 30)))
    rows = licenses.summary(licenses.scan(table(spark, docs))).collect()
    assert found(rows) == Counter((d, *plain(t)) for d, t in docs)
    assert {r["labels"] for r in rows} == {"mit-notice"}


def test_whole_license_texts_are_templates():
    index = licenses.TemplateIndex(licenses.PHRASES, licenses.TEMPLATES, 0.8, 32)
    for text, label in licenses.TEMPLATES[-2:]:
        words = licenses.words_of("some words before it " * 9 + text.upper() + " and after" * 40)
        assert label in {m[0] for m in index.scan(words)}
        half = licenses.words_of(text)
        assert label not in {m[0] for m in index.scan(half[:len(half) // 2])}
    many = licenses.TemplateIndex((), [(" ".join(f"w{k}" for k in range(900)), "long")], 0.8, 32)
    assert [m[:3] for m in many.scan([f"w{k}".encode() for k in range(100, 900)])] == [("long", False, 0)]


def test_the_word_order_does_not_change_what_is_found():
    rng = np.random.default_rng(4)
    index = licenses.TemplateIndex(licenses.PHRASES, licenses.TEMPLATES, 0.8, 32)
    words = [w for t, _ in licenses.TEMPLATES for w in licenses.words_of(t)]
    text = [words[k] for k in rng.integers(0, len(words), 3000)]
    expected = index.scan(text)
    for _ in range(5):
        index.order({w: int(rng.integers(1000)) for w in index.vocabulary})
        assert sorted(index.scan(text)) == sorted(expected)
