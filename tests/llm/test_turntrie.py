"""Conversation prefix trie (operator 13)."""
import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from sessionary.llm import turntrie
from sessionary.llm.queries import QUERIES
from tests.conftest import SF_SMALL

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
           "ends_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string, depth long, key string, path string, kind int"


def plain(rows):
    """Nodes by dictionaries of whole prefixes."""
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            by[conv].append((turn is not None, turn or 0, role or "", text or ""))
    for own in by.values():
        own.sort(key=lambda r: (r[:2], hashlib.md5(f"{len(r[2])}:{r[2]}{r[3]}".encode()).digest()))
    full = {}
    for conv, own in by.items():
        h = zlib.crc32(str(conv).encode()) % 4
        head = conv - (abs(conv) % 20 if conv >= 0 else -(abs(conv) % 20))
        full[conv] = tuple(r[2:] for r in by.get(head, [])[:h]) + tuple(r[2:] for r in own[h:])
    members = defaultdict(list)
    for conv in sorted(full):
        for depth in range(len(full[conv]) + 1):
            members[full[conv][:depth]].append(conv)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for path in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        saved[path] += (len(members[path]) - 1) * words
        leaves[path] += children[path] == 0
        if path:
            children[path[:-1]] += 1
            leaves[path[:-1]] += leaves[path]
            saved[path[:-1]] += saved[path]
    return sorted(((own[0], len(path), members[path[:-1]][0] if path else None, len(own), children[path],
                    leaves[path], saved[path], hashlib.sha256(",".join(
                        str(c) for c in own if len(full[c]) == len(path)).encode()).hexdigest())
                   for path, own in members.items()), key=repr)


def run(spark, rows, **sizes):
    df = spark.createDataFrame([(*r, 9, "k", "p", 7) for r in rows], SCHEMA)
    nodes = turntrie.trie(turntrie.shared_heads(turntrie.turn_lists(df)), **sizes)
    return sorted(map(tuple, nodes.select(COLUMNS).collect()), key=repr)


def made(seed, convs=120, longest=9):
    rng = random.Random(seed)
    return [(c, t, rng.choice(["user", "assistant"]), rng.choice(["a b", "c", " d  e\nf", ""]))
            for c in range(convs) for t in range(rng.randint(1, longest))]


@pytest.mark.parametrize("sizes", [{}, {"slice_rows": 8}, {"slice_rows": 20, "slice_turns": 60}])
@pytest.mark.parametrize("seed", [1, 2])
def test_brute_force_over_rounds(spark, sizes, seed):
    rows = made(seed)
    assert run(spark, rows, **sizes) == plain(rows)


def test_copies_and_long_conversations(spark):
    rows = [(c * 20, t, "user", f"turn {t}") for c in range(150) for t in range(4)]     # one hot path
    rows += [(7 + c * 20, t, "user", f"turn {t % 3}") for c in range(3) for t in range(120)]
    rows += [(100_001, t, "user", f"turn {t}") for t in range(300)]
    for sizes in ({}, {"slice_rows": 16}):
        assert run(spark, rows, **sizes) == plain(rows)


def test_edges(spark):
    rows = [(1, None, None, None), (1, 0, "user", "a"), (1, 0, "user", "b"), (1, 0, "user", "b"),
            (None, 0, "user", "lost"), (20, 5, "user", "head one"), (20, 7, "user", "head two"),
            (21, 0, "user", "x"), (25, 3, "", ""), (26, 3, None, None), (-7, 0, "user", "minus"),
            (45, 0, "user", "z"), (9_000_000_000, 1, "r", "big"), (30, 0, "user", "word " * 30_000)]
    rows += [(c, 0, "user", "one turn") for c in range(60, 80)]
    assert run(spark, rows) == plain(rows)
    assert run(spark, []) == []
    assert run(spark, [(None, 1, "a", "b")]) == []


def test_op13_on_the_table(spark):
    df = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    got = QUERIES["op13_conversation_trie"](spark, SF_SMALL).select(COLUMNS)
    assert sorted(map(tuple, got.collect()), key=repr) == plain(rows)
