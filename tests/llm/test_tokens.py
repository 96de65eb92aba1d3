"""Token ids, their files and packing (operators 5, 9, 10)."""
import base64
import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sessionary.llm import bytebpe, packing, simple8b, wordbpe
from sessionary.llm.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.llm.cases import EDGES, small_documents, table

TEXTS = [t for _, t in EDGES] + [t for _, t in small_documents()[:80]] + [
    "x <|endoftext|> y", "x<|startoftext|>y<|endoftext|>.", "<|ENDOFTEXT|>", "it's<|endoftext|>'s É",
    "  lead", " one", "tail ", "a  b", "a\n b", "x　y z　", "\x85 x", "ǅ ß ẞ İstanbul ΑΣ."]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(wordbpe.default_path())
    return lambda text: tok.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def rank_library():
    import public_tokenizers as P
    import tiktoken
    with open(bytebpe.default_path(), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda text: own.encode_ordinary(text or "")


def test_word_ids_equal_the_library(library):
    got = wordbpe.encoder(wordbpe.default_path()).encode(pa.array(TEXTS))
    for text, ids in zip(TEXTS, got, strict=True):
        assert ids.tolist() == library(text)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("aAbéÉß'.,!? \n\t 　12中́x≠=|#\x1c"), max_size=30),
                max_size=4))
def test_word_and_byte_ids_of_any_text(library, rank_library, texts):
    column = pa.array(texts, pa.string())
    for text, ids in zip(texts, wordbpe.encoder(wordbpe.default_path()).encode(column), strict=True):
        assert ids.tolist() == library(text)
    own = bytebpe.encoder(bytebpe.default_path(), bytebpe.default_pattern())
    for text, ids in zip(texts, own.encode(column), strict=True):
        assert ids.tolist() == rank_library(text)
        assert own.decode(ids) == text.encode()


def test_quoted_special_tokens_are_the_tokens(library):
    assert library("x <|endoftext|> y") == [343, 49407, 344]


def test_byte_ids_equal_the_library(rank_library):
    own = bytebpe.encoder(bytebpe.default_path(), bytebpe.default_pattern())
    for text, ids in zip(TEXTS, own.encode(pa.array(TEXTS)), strict=True):
        assert ids.tolist() == rank_library(text)
        assert own.decode(ids) == (text or "").encode()


def test_replay_equals_merging_each_piece_alone():
    own = bytebpe.encoder(bytebpe.default_path(), bytebpe.default_pattern())
    rng = np.random.default_rng(0)
    pieces = [bytes(rng.choice(list(b"abeinrst\xc3\xa9 "), rng.integers(1, 15)).tolist())
              for _ in range(3000)] + [b"a" * n for n in range(1, 40)]
    assert [np.frombuffer(x, "<u4").tolist() for x in own.replay(pieces)] == [
        own.merge_alone(p) for p in pieces]


def test_op5_on_the_table(spark, rank_library):
    rows = {r["doc_id"]: r for r in QUERIES["op5_byte_bpe"](spark, SF_SMALL).collect()}
    docs = small_documents()
    assert len(rows) == len(docs)
    for doc, text in docs:
        ids = rank_library(text)
        assert rows[doc]["n_tokens"] == len(ids)
        assert rows[doc]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert rows[doc]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()


def test_op5_edges(spark):
    rows = bytebpe.encode_documents(table(spark, EDGES)).collect()
    assert sorted((r["doc_id"] or -1, bytes(r["decoded"])) for r in rows) == sorted(
        (i or -1, (t or "").encode()) for i, t in EDGES)
    assert bytebpe.encode_documents(table(spark, [])).count() == 0


NUMBERS = st.one_of(st.integers(0, 5), st.integers(0, 70_000), st.integers(0, (1 << 64) - 1),
                    st.sampled_from([(1 << k) - 1 for k in range(1, 65)]))


@settings(max_examples=150, deadline=None)
@given(st.lists(NUMBERS, max_size=300))
def test_segments_round_trip(values):
    ids = np.array(values, np.uint64)
    assert simple8b.decode_segment(simple8b.encode_segment(ids)).tolist() == values


def test_segments_of_many_blocks():
    rng = np.random.default_rng(1)
    for high in (2, 300, 49_408, 1 << 40):
        ids = rng.integers(0, high, 3 * simple8b.BLOCK_IDS + 77).astype(np.uint64)
        data = simple8b.encode_segment(ids)
        assert (simple8b.decode_segment(data) == ids).all()
    ids = np.where(rng.random(20_000) < 0.02, 49_000, rng.integers(0, 30_000, 20_000))
    assert len(simple8b.encode_segment(ids)) < 2.5 * 20_000  # escapes keep four ids to a word


def test_op9_on_the_table(spark, library):
    rows = QUERIES["op9_token_ids"](spark, SF_SMALL).collect()
    rows = {r["doc_id"]: r for r in rows}
    at = 0
    for doc, text in small_documents():
        ids = library(text) + [1]
        r = rows.pop(doc)
        assert (r["start"], r["n_tokens"]) == (at, len(ids))
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)
    assert not rows


def test_op9_edges(spark, library):
    rows = simple8b.token_ids(table(spark, EDGES)).collect()
    rows.sort(key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == sorted((i for i, _ in EDGES), key=lambda i: (i is not None, i))
    at = 0
    for r in rows:
        ids = np.frombuffer(bytes(r["ids"]), "<u4").tolist()
        assert r["start"] == at and r["n_tokens"] == len(ids) and ids[-1] == 1
        at += len(ids)
    texts = sorted((library(t) for _, t in EDGES), key=str)
    assert sorted((np.frombuffer(bytes(r["ids"]), "<u4").tolist()[:-1] for r in rows), key=str) == texts
    assert simple8b.token_ids(table(spark, [])).count() == 0


def _check_sequences(rows, capacity):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in by_sequence.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    return len(by_sequence)


def test_op10_on_the_table(spark, library):
    rows = QUERIES["op10_best_fit_packing"](spark, SF_SMALL).collect()
    n = _check_sequences(rows, packing.CAPACITY)
    total = sum(r["length"] for r in rows)
    assert n <= 1.01 * total / packing.CAPACITY + 1
    found = {(r["doc_id"], r["piece"]): r for r in rows}
    assert len(found) == len(rows)
    for doc, text in small_documents():
        ids = library(text) + [0]
        for piece, at in enumerate(range(0, len(ids), packing.CAPACITY)):
            part = ids[at:at + packing.CAPACITY]
            r = found.pop((doc, piece))
            assert (r["start"], r["length"]) == (at, len(part))
            assert r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
    assert not found


@pytest.mark.parametrize("sizes", [
    [1100] * 300, [1100] * 150 + [900] * 150, [2048] * 20, [1] * 500, [1025, 1023] * 100,
    list(range(1, 600))])
def test_rounds_place_every_item_once(spark, sizes):
    items = spark.createDataFrame([(1000 + k, n) for k, n in enumerate(sizes)], "item long, length long")
    rows = packing.pack(items, bucket_items=20, fan_in=4, hosts=4)
    rows = rows.join(items, "item").collect()
    assert sorted(r["item"] for r in rows) == [1000 + k for k in range(len(sizes))]
    n = _check_sequences(rows, packing.CAPACITY)
    _, _, whole = packing.best_fit(np.array(sizes), packing.CAPACITY)
    assert n <= 1.15 * len(whole) + 2


def test_best_fit_fills_the_tightest_bin():
    bins, offsets, fill = packing.best_fit(np.array([6, 5, 4, 5]), 10)
    assert (bins.tolist(), offsets.tolist(), fill.tolist()) == ([0, 1, 0, 1], [0, 0, 6, 5], [10, 10])


def test_op10_edges(spark):
    rows = packing.pack_documents(table(spark, EDGES), capacity=64).collect()
    _check_sequences(rows, 64)
    assert sum(r["piece"] == 0 for r in rows) == len(EDGES)
    assert [r["length"] for r in rows if r["doc_id"] in (5, 6, 7)] == [1, 1, 1]
    assert packing.pack_documents(table(spark, [])).count() == 0
