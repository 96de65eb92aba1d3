"""The pipeline, stage by stage against brute force."""
import zlib

import numpy as np

import __spark_entry__ as entry
import corpus_pipeline
from sessionary.llm import packing, wordbpe
from sessionary.llm.queries import ORACLE, QUERIES
from sessionary.session import materialize
from tests.conftest import SF_SMALL
from tests.llm.cases import EDGES, table
from tests.llm.test_pii import plain_base
from tests.llm.test_simhash import plain_components, plain_fingerprint


def test_every_stage_and_the_whole(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, given = docs.columns, {r["doc_id"]: r for r in docs.collect()}
    stage = dict(corpus_pipeline.STAGES)
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules", "SimHash near-dedup", "PII", "best-fit packing"]

    good = materialize(stage["quality rules"](spark, docs, SF_SMALL))
    verdict = {r["doc_id"]: r["kept"] for r in QUERIES["op4_quality_rules"](spark, SF_SMALL).collect()}
    rows = sorted(good.collect(), key=lambda r: r["doc_id"])
    assert good.columns == columns
    assert [r["doc_id"] for r in rows] == sorted(i for i, kept in verdict.items() if kept)
    assert all(r == given[r["doc_id"]] for r in rows)

    single = materialize(stage["SimHash near-dedup"](spark, good, SF_SMALL))
    parts = plain_components([plain_fingerprint(r["text"]) for r in rows])
    firsts = {rows[k]["doc_id"] for k in parts}
    left = {r["doc_id"]: r for r in single.collect()}
    assert single.columns == columns
    assert set(left) == firsts and all(r == given[i] for i, r in left.items())

    clean = materialize(stage["PII"](spark, single, SF_SMALL))
    texts = {r["doc_id"]: r for r in clean.collect()}
    assert clean.columns == columns and set(texts) == firsts
    for i, r in texts.items():
        assert not plain_base(r["text"])
        assert r["n_chars"] == len(r["text"] or "")
        if not any(ch.isdigit() or ch == "@" for ch in left[i]["text"] or ""):
            assert r["text"] == left[i]["text"]

    packed = stage["best-fit packing"](spark, clean, SF_SMALL).collect()
    check_packed(packed, {i: r["text"] for i, r in texts.items()})

    whole = entry.queries()["pipeline"](spark, SF_SMALL).collect()
    key = lambda r: (r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])
    assert sorted(map(key, whole)) == sorted(map(key, packed))


def check_packed(rows, texts):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(wordbpe.default_path())
    ends = {}
    for r in rows:
        ends.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in ends.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    found = {(r["doc_id"], r["piece"]): r["ids_crc32"] for r in rows}
    expected = {}
    for i, text in texts.items():
        ids = np.array(tok.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        for n, at in enumerate(range(0, len(ids), packing.CAPACITY)):
            expected[i, n] = zlib.crc32(ids[at:at + packing.CAPACITY].tobytes())
    assert found == expected


def test_stages_cope_with_edges(spark):
    for rows in (EDGES, []):
        docs = table(spark, rows)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = materialize(stage(spark, docs, SF_SMALL))
        columns = docs.columns
        assert columns == table(spark, rows).columns
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL).count() >= 0


def test_registration():
    names = entry.queries()
    for n in range(1, 14):
        assert sum(q.startswith(f"op{n}_") for q in names) == 1
    assert "pipeline" in names and corpus_pipeline.ORACLE_SQL is None
    assert set(ORACLE) <= set(QUERIES)
