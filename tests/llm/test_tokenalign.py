"""Cross-tokenizer alignment (operator 12)."""
import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from sessionary.llm import tokenalign
from sessionary.llm.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.llm.cases import EDGES, small_documents, table

SIGNS = tokenalign.byte_of_sign()
MORE = [(20, "a▁b c"), (21, "x <|endoftext|> y <0x0A> <s> </s> <unk>"), (22, " lead  two   three "),
        (23, "ctl \x00 \x01 nul"), (24, "中文字没有空格的长句子" * 50), (25, "a b c　d"),
        (26, "a" * 6000), (27, "tab\t and\n line \n ends ")]


def bytes_of(tokens, side):
    if side == "a":
        return [bytes(SIGNS[c] for c in t) for t in tokens]
    return [bytes([int(t[3:5], 16)]) if len(t) == 6 and t.startswith("<0x") else
            t.replace("▁", " ").encode() for t in tokens]


def plain(rows):
    """The contract, one text after the other with the libraries on whole texts."""
    a_tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a_tok.encode_special_tokens = True
    b_tok = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    found, count = [], Counter()
    for doc, text in rows:
        a = a_tok.encode(" " + text, add_special_tokens=False) if text else None
        b = b_tok.encode(text) if text else None
        ends = []
        if text:
            for blobs in (bytes_of(a.tokens, "a"), bytes_of([b_tok.id_to_piece(i) for i in b], "b")):
                ends.append(np.cumsum([len(x) for x in blobs]).tolist()
                            if b"".join(blobs) == (" " + text).encode() else None)
        if not text or None in ends:
            found.append((doc, None))
            continue
        links, groups, i, j, own = [], [], 0, 0, a.ids
        for cut in sorted(set(ends[0]) & set(ends[1])):
            x, y = ends[0].index(cut, i) + 1, ends[1].index(cut, j) + 1
            groups.append(",".join(map(str, own[i:x])) + "|" + ",".join(map(str, b[j:y])))
            links.append((own[x - 1], b[y - 1]))
            i, j = x, y
        count.update(links)
        found.append((doc, (len(own), len(b), groups, links)))
    top = {}
    for (_, b), n in count.items():
        top[b] = max(top.get(b, 0), n)
    return sorted([(doc, 0, 0, 0, 0, 0, 0, "") if own is None else (
        doc, own[0], own[1], len(own[2]), len(own[3]), sum(count[p] == top[p[1]] for p in own[3]),
        sum(count[p] for p in own[3]), hashlib.sha256(";".join(own[2]).encode()).hexdigest())
        for doc, own in found], key=repr)


def run(spark, rows):
    return sorted(map(tuple, tokenalign.align_documents(table(spark, rows)).collect()), key=repr)


def test_edges(spark):
    rows = EDGES + MORE
    assert run(spark, rows) == plain(rows)
    assert run(spark, []) == []
    assert run(spark, [(1, None), (None, "")]) == plain([(1, None), (None, "")])


def test_counts_across_slices(spark):
    """Counts are of all texts, whatever the slices."""
    rows = [(k, f"word{k % 7} and more words here, twice {k % 3}") for k in range(200)]
    assert run(spark, rows) == plain(rows)
    enc = tokenalign.encoders(*tokenalign.default_paths())
    texts = [t for _, t in rows]
    whole = tokenalign.Aligned(texts, enc)
    parts = [tokenalign.Aligned(texts[a:a + 9], enc) for a in range(0, len(texts), 9)]
    total = Counter()
    for part in parts:
        total.update(dict(zip(part.pairs.tolist(), part.totals.tolist())))
    assert total == Counter(dict(zip(whole.pairs.tolist(), whole.totals.tolist())))


def test_slices_hold_whole_texts():
    texts = ["x" * 3_000_000, "y" * 2_000_000, None, "z" * 9_000_000, "", "q"]
    cuts = list(tokenalign._slices(texts))
    assert [k for a, b in cuts for k in range(a, b)] == list(range(6))
    assert cuts == [(0, 1), (1, 3), (3, 4), (4, 6)]


def test_pointer_jumping_reaches_the_terminal():
    rng = np.random.default_rng(7)
    for _ in range(200):
        size = int(rng.integers(1, 60))
        a, b = (np.append(np.flatnonzero(rng.random(size - 1) < 0.4) + 1, size) for _ in "ab")
        label = tokenalign.terminals(a, b)
        cuts = np.intersect1d(a, b)
        want = np.concatenate([np.searchsorted(cuts, a), np.searchsorted(cuts, b)])
        assert (np.searchsorted(cuts, b[label - len(a)]) == want).all()
        assert np.isin(b[label - len(a)], cuts).all()


def test_op12_on_the_table(spark):
    got = sorted(map(tuple, QUERIES["op12_token_alignment"](spark, SF_SMALL).collect()), key=repr)
    assert got == plain(small_documents())
