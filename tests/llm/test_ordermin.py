"""Order MinHash fingerprints (operator 7)."""
import hashlib
import re

import numpy as np
import pytest
import xxhash

from sessionary.llm import ordermin
from sessionary.llm.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.llm.cases import EDGES, small_documents, table

MASK = (1 << 64) - 1


def chain(*parts):
    """Spark's xxhash64 of several values: each hash seeds the next."""
    seed = 42
    for p in parts:
        if isinstance(p, tuple):  # int
            data = (p[0] & 0xFFFFFFFF).to_bytes(4, "little")
            seed = xxhash.xxh64(data, seed=seed).intdigest()
        elif isinstance(p, int):
            seed = xxhash.xxh64((p & MASK).to_bytes(8, "little"), seed=seed).intdigest()
        else:
            seed = xxhash.xxh64(p.encode(), seed=seed).intdigest()
    return seed


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def plain_words(text):
    for w in re.split(r"[\x20\x09-\x0D]+", text or ""):
        if len(w) <= ordermin.LONG:
            yield from [w] if w else []
        else:
            yield from (w[k:k + ordermin.GRAM] for k in range(len(w)))


def plain_signature(text):
    words = list(plain_words(text))
    high = lambda h: signed(h) >> ordermin.PLACE_BITS
    kmers = [high(chain(w, words[k + 1] if k + 1 < len(words) else "")) for k, w in enumerate(words)]
    seen, ranked = {}, []
    for place, k in enumerate(kmers):
        n = seen[k] = seen.get(k, -1) + 1
        ranked.append((high(chain(k, (n,))), place))
    classes = {}
    for h, place in sorted(ranked):
        classes.setdefault((h << ordermin.PLACE_BITS & MASK) >> 59, []).append((h, place))
    out = [None] * ordermin.TUPLES
    for c, own in classes.items():
        # an array's hash chains its elements
        out[c] = chain(*[h for h, place in sorted(own[:ordermin.PICKED], key=lambda x: x[1])])
    return out


def form(sig):
    return ".".join("-" if v is None else f"{v:016x}"[8:] for v in sig)


def plain_likeness(a, b):
    present = [(x, y) for x, y in zip(a, b) if x is not None or y is not None]
    same = sum(x == y for x, y in present)
    return 1.0 if not present else (same / len(present)) ** (1 / ordermin.PICKED)


def expected(docs):
    docs = sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0), reverse=True)
    texts = [t or "" for _, t in docs]
    for k, (doc, _) in enumerate(docs):
        text, other = texts[k], texts[(k + 1) % len(texts)]
        half = len(text) // 2
        changed = text[:len(text) - half] + other[:half]
        a, b, c = map(plain_signature, (text, changed, other))
        yield (doc, len(text), hashlib.sha256(changed.encode()).hexdigest(), form(a), form(b),
               round(plain_likeness(a, b), 9), round(plain_likeness(a, c), 9))


def rows_of(frame):
    return sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"], r["fingerprint"],
                    r["edited_fingerprint"], round(r["near_edited"], 9), round(r["near_next"], 9))
                   for r in frame.collect()), key=str)


def test_op7_on_the_table(spark):
    got = rows_of(QUERIES["op7_order_minhash"](spark, SF_SMALL))
    assert got == sorted(expected(small_documents()), key=str)


def test_edges(spark):
    assert rows_of(ordermin.compare_edits(table(spark, EDGES))) == sorted(expected(EDGES), key=str)
    one = ordermin.compare_edits(table(spark, [(3, "the only document here")])).collect()
    assert one[0]["near_next"] == 1.0
    assert ordermin.compare_edits(table(spark, [])).count() == 0


@pytest.mark.parametrize("parts", ["1", "2", "7", "64"])
def test_the_next_document_at_any_number_of_ranges(spark, parts):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        rng = np.random.default_rng(1)
        ids = rng.choice(10**6, 300, replace=False).tolist()
        docs = [(i, f"text of {i} here") for i in ids]
        got = ordermin.with_next(ordermin.id_text(table(spark, docs)), ["text"]).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    order = sorted(ids, reverse=True)
    after = dict(zip(order, order[1:] + order[:1]))
    assert len(got) == len(ids)
    assert all(r["next_text"] == f"text of {after[r['doc_id']]} here" for r in got)


def test_likeness_follows_the_edit_distance(spark):
    rng = np.random.default_rng(7)
    words = [f"w{k}" for k in range(400)]
    base = rng.choice(words, 600).tolist()
    texts = {"same": base, "moved": base[300:] + base[:300], "shuffled": rng.permutation(base).tolist()}
    for share in (0.02, 0.1, 0.5):
        own = list(base)
        for k in rng.choice(600, int(600 * share), replace=False).tolist():
            own[k] = "new" + str(k)
        texts[share] = own
    from pyspark.sql import functions as F
    frame = spark.createDataFrame([(str(k), " ".join(v), " ".join(base)) for k, v in texts.items()],
                                  "name string, a string, b string")
    got = {r["name"]: r["x"] for r in frame.select("name", ordermin.likeness(
        ordermin.signature(F.col("a")), ordermin.signature(F.col("b"))).alias("x")).collect()}
    assert got["same"] == 1.0
    assert got["0.02"] > got["0.1"] > got["0.5"] > 0
    assert got["moved"] < 0.95 and got["shuffled"] < 0.2


def test_texts_without_spaces(spark):
    rng = np.random.default_rng(11)
    signs = [chr(k) for k in rng.integers(0x4E00, 0x9000, 800)]
    token = rng.choice(list("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/"), 6000)
    mixed = "word " * 30 + "x" * 24 + " " + "y" * 25 + " \U0001f600" * 3 + "\U0001f600" * 30 + "\n" + "z" * 70
    docs = [(4, "".join(signs)), (3, "".join(token)), (2, mixed), (1, "other words stand here"), (0, "q" * 3000)]
    frame = ordermin.compare_edits(table(spark, docs))
    assert rows_of(frame) == sorted(expected(docs), key=str)
    near = {r["doc_id"]: (r["near_edited"], r["near_next"]) for r in frame.collect()}
    for doc in (4, 3):  # half of the text stays
        assert 0.2 < near[doc][0] < 0.8 and near[doc][1] == 0.0


def test_no_python_in_the_plan(spark):
    plan = QUERIES["op7_order_minhash"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|ArrowEval", plan)
