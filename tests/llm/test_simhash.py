"""SimHash near-duplicates (operator 6)."""
import re

import numpy as np
import xxhash

from sessionary.llm import simhash
from sessionary.llm.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.llm.cases import EDGES, small_documents, table

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    shingles = [" ".join(words[k:k + 4]) for k in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, radius=4):
    """Component (smallest index) of each fingerprint."""
    parent = list(range(len(prints)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return [root(k) for k in range(len(prints))]


def test_op6_on_the_table(spark):
    docs = small_documents()
    prints = [plain_fingerprint(t) for _, t in docs]
    parts = plain_components(prints)
    rows = {r["doc_id"]: r for r in QUERIES["op6_simhash_dedup"](spark, SF_SMALL).collect()}
    assert len(rows) == len(docs)
    for k, (doc, _) in enumerate(docs):
        assert rows[doc]["fingerprint"] == f"{prints[k]:016x}"
        assert rows[doc]["component_id"] == docs[parts[k]][0]


def test_edges(spark):
    rows = simhash.near_duplicates(table(spark, EDGES)).collect()
    assert len(rows) == len(EDGES)
    for r in rows:
        texts = {t for i, t in EDGES if i == r["doc_id"]}
        assert r["fp"] & (1 << 64) - 1 in {plain_fingerprint(t) for t in texts}
    by = {r["doc_id"]: r["component_id"] for r in rows}
    assert by[5] == by[6] == by[7] == 5
    assert by[11] == by[12] == by[13] == 11
    assert simhash.near_duplicates(table(spark, [])).count() == 0


def test_links_over_many_tiles_match_brute_force(spark):
    rng = np.random.default_rng(5)
    seeds = rng.integers(0, 1 << 63, 120, dtype=np.uint64) * np.uint64(2)
    prints = set(seeds.tolist()) | {0, 1, 3, (1 << 64) - 1}
    for s in seeds[:40].tolist():  # chains of flips, some beyond the radius
        for n in (2, 4, 5, 7):
            s2 = s
            for b in rng.choice(64, n, replace=False).tolist():
                s2 ^= 1 << b
            prints.add(s2)
    prints = sorted(prints)
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    parts = plain_components(prints)
    frame = spark.createDataFrame(list(enumerate(signed)), "doc_id long, fp long")
    got = {r["fp"]: r["component_id"] for r in simhash.components(frame, tile_rows=16).collect()}
    assert [got[s] for s in signed] == parts


def test_spanning_forest_of_a_dense_group():
    base = np.uint64(0x0F0F_0F0F_0F0F_0F0F)
    tile = np.array([base ^ np.uint64(1 << k) for k in range(64)], np.uint64)
    node, root = simhash.tile_links(tile, None, 4)
    assert len(node) == 63 and set(root.tolist()) == {0}
    a, b = simhash.tile_links(tile[:32], tile[32:], 4)
    assert len(a) == 63 and set(b.tolist()) == {0}


def test_deduplicate_keeps_one_row_of_each_group(spark):
    docs = table(spark, EDGES + [(13, "another text under the same id"), (None, None)])
    kept = simhash.deduplicate(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    ids = [r["doc_id"] for r in rows]
    assert 5 in ids and 6 not in ids and 7 not in ids and 12 not in ids
    assert sorted(r["text"] for r in rows if r["doc_id"] == 13) == ["another text under the same id"]
    assert len({plain_fingerprint(r["text"]) for r in rows}) == len(rows)
    assert simhash.deduplicate(table(spark, [])).count() == 0
