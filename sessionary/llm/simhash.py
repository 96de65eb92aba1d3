"""SimHash fingerprints and exact near-duplicate groups (operator 6).

Fingerprint: the majority bits of the XXH64 hashes of a text's word shingles.
Two fingerprints link when at most ``radius`` of their 64 bits differ.

Linking is a tiled exact comparison.  Equal fingerprints meet in one row first
(map-side combined).  The different ones are dealt into tiles of about
``tile_rows`` by population count and hash; a pair of tiles is compared (numpy
exclusive-or and bit counts, every row against every row) only when their
population counts differ by no more than the radius, since each differing bit
moves the count by one.  A tile pair's task returns a spanning forest of its
links, never all pairs, and distributed connected components join the forests.
Tiles follow from a 65-row histogram, the only data that reaches the driver;
the work grows with the square of the number of different fingerprints.
Within a tile pair the same bound on the counts of halves and quarters skips
most of the comparisons.

Defined results: null, empty and blank texts have fingerprint zero and are
linked like any other; fewer words than a shingle: the whole sequence is one
shingle; a null doc_id links too but never names a group (a group without ids
has a null component); repeated rows each get a result row; an empty table
gives no rows; extra columns are ignored (``deduplicate`` keeps them).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionary.llm.common import id_text
from sessionary.operators.graph import connected_components
from sessionary.session import materialize

SHINGLE_WORDS = 4
RADIUS = 4
TILE_ROWS = 16_384
HASH_SEED = 42
_ROWS_AT_ONCE = 64
_BITS_AT_ONCE = 1 << 16


def shingle_hashes(text: str | None, width: int = SHINGLE_WORDS) -> np.ndarray:
    """XXH64 of every run of ``width`` lower-cased (A-Z) words, repeats included."""
    from xxhash import xxh64_intdigest
    words = (text or "").encode("utf-8").lower().split()  # bytes: only A-Z and ASCII space count
    if not words:
        return np.empty(0, np.uint64)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - width + 1)
    last = ends[width - 1:] if len(words) >= width else ends[-1:]
    return np.array([xxh64_intdigest(line[a:b], HASH_SEED)
                     for a, b in zip(starts[:n].tolist(), last.tolist())], np.uint64)


def fingerprint(text: str | None, width: int = SHINGLE_WORDS) -> int:
    """Bits set in more than half of the hashes, as a signed 64-bit number."""
    hashes = shingle_hashes(text, width)
    times = np.zeros(64, np.int64)
    for k in range(0, len(hashes), _BITS_AT_ONCE):
        part = hashes[k:k + _BITS_AT_ONCE].view(np.uint8).reshape(-1, 8)
        times += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * times > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.int64)[0])


def fingerprint_column(text: Column, width: int = SHINGLE_WORDS) -> Column:
    @F.pandas_udf("bigint")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(x, width) for x in texts], dtype="int64")
    return run(text)


def spanning_forest(left: np.ndarray, right: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its component) for the nodes that are not the smallest."""
    label = np.arange(n)
    while True:
        a, b = label[left], label[right]
        low = np.minimum(a, b)
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, label):
            moved = np.flatnonzero(label != np.arange(n))
            return moved, label[moved]
        label = new


def _cells(prints: np.ndarray) -> tuple[np.ndarray, list]:
    """(order, groups): rows by the counts of their parts, for skipping within tiles.

    A group (low count, high count, start, end, quarter counts) holds the rows
    whose lower and upper 32 bits have so many ones, sorted by the count of
    their lowest 16 bits.
    """
    low = np.bitwise_count(prints & np.uint64(0xFFFFFFFF)).astype(np.int64)
    high = np.bitwise_count(prints >> np.uint64(32)).astype(np.int64)
    quarter = np.bitwise_count(prints & np.uint64(0xFFFF)).astype(np.int64)
    order = np.lexsort((quarter, high, low))
    low, high, quarter = low[order], high[order], quarter[order]
    ends = np.flatnonzero(np.diff(low * 64 + high, append=-1)) + 1
    starts = np.concatenate([[0], ends[:-1]])
    return order, [(int(low[a]), int(high[a]), int(a), int(b), quarter[a:b])
                   for a, b in zip(starts, ends) if b > a]


def tile_links(first: np.ndarray, second: np.ndarray | None, radius: int) -> tuple:
    """Spanning forest of the links between two tiles, or within one (second None).

    Numbers 0 .. len(first) - 1 stand for ``first``, those after it for ``second``.
    Parts of the tiles are skipped like tile pairs: the counts of the halves
    differ by no more than the radius together, and the rest of the radius
    bounds how far the counts of the lowest quarters can be apart.
    """
    other, shift = (first, 0) if second is None else (second, len(first))
    n = len(first) + (0 if second is None else len(second))
    rows_at, row_groups = _cells(first)
    near_at, near_groups = (rows_at, row_groups) if second is None else _cells(other)
    rows, nears = first[rows_at], other[near_at]
    left, right, held = [], [], 0
    for low, high, start, end, quarter in row_groups:
        close = [(g, g[0] - low, g[1] - high) for g in near_groups
                 if abs(g[0] - low) + abs(g[1] - high) <= radius]
        cuts = [0, *(np.flatnonzero(np.diff(quarter)) + 1).tolist(), end - start]
        for a, b in zip(cuts, cuts[1:]):
            own = int(quarter[a])
            for (_, _, from_, _, quarters), by_low, by_high in close:
                # the two quarters of the lower half differ by by_low in sum
                room = radius - abs(by_high)
                c = int(np.searchsorted(quarters, own - (room - by_low) // 2))
                d = int(np.searchsorted(quarters, own + (room + by_low) // 2, "right"))
                if c >= d:
                    continue
                for at in range(start + a, start + b, _ROWS_AT_ONCE):
                    part = rows[at:min(at + _ROWS_AT_ONCE, start + b)]
                    x, y = np.nonzero(np.bitwise_count(
                        part[:, None] ^ nears[None, from_ + c:from_ + d]) <= radius)
                    if not len(x):
                        continue
                    x, y = rows_at[x + at], near_at[y + from_ + c] + shift
                    apart = x != y
                    left.append(x[apart])
                    right.append(y[apart])
                    held += len(left[-1])
                    if held > 1 << 20:  # dense groups: keep a forest, not the links
                        x, y = spanning_forest(np.concatenate(left), np.concatenate(right), n)
                        left, right, held = [x], [y], 0
    if not held and not left:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return spanning_forest(np.concatenate(left), np.concatenate(right), n)


def _pair_links(radius: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        prints = rows["fp"].to_numpy(np.int64)
        in_first = (rows["tile"] == rows["low"]).to_numpy()
        if rows["low"].iat[0] == rows["high"].iat[0]:
            a, b = tile_links(prints.view(np.uint64), None, radius)
        else:
            prints = np.concatenate([prints[in_first], prints[~in_first]])
            cut = int(in_first.sum())
            a, b = tile_links(prints[:cut].view(np.uint64), prints[cut:].view(np.uint64), radius)
        return pd.DataFrame({"src": prints[a], "dst": prints[b]})
    return run


def links(prints: DataFrame, radius: int = RADIUS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """(src, dst): forests that connect all of the different ``fp`` within the radius."""
    counts = dict(prints.groupBy(F.bit_count("fp").alias("bits")).count().collect())
    tiles = [-(-counts.get(bits, 0) // tile_rows) for bits in range(65)]
    before = np.concatenate([[0], np.cumsum(tiles)]).tolist()
    by_bits = lambda values: F.element_at(
        F.array(*[F.lit(int(x)) for x in values]), F.bit_count("fp") + 1)
    dealt = prints.select("fp", (by_bits(before) + F.pmod(
        F.xxhash64("fp"), by_bits(np.maximum(tiles, 1))).cast("int")).alias("tile"),
        by_bits([before[max(0, bits - radius)] for bits in range(65)]).alias("from"),
        by_bits([before[min(65, bits + radius + 1)] - 1 for bits in range(65)]).alias("to"))
    return (dealt.select("fp", "tile", F.explode(F.sequence("from", "to")).alias("other"))
            .select("fp", "tile", F.least("tile", "other").alias("low"),
                    F.greatest("tile", "other").alias("high"))
            .groupBy("low", "high").applyInPandas(_pair_links(radius), "src bigint, dst bigint"))


def components(prints: DataFrame, radius: int = RADIUS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """(fp, component_id) for every different ``fp`` of (doc_id, fp) rows.

    component_id is the smallest doc_id that links reach from the fingerprint.
    """
    different = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("first")))
    joined = connected_components(links(different, radius, tile_rows))
    linked = different.join(joined.withColumnRenamed("node", "fp"), "fp")
    groups = linked.groupBy("component").agg(F.min("first").alias("least"))
    linked = linked.join(groups, "component").select("fp", "least")
    return (different.join(linked, "fp", "left")
            .select("fp", F.coalesce("least", "first").alias("component_id")))


def near_duplicates(docs: DataFrame, width: int = SHINGLE_WORDS, radius: int = RADIUS,
                    tile_rows: int = TILE_ROWS) -> DataFrame:
    """doc_id, fp (signed 64 bits), component_id of every row of ``docs``."""
    prints = materialize(id_text(docs).select("doc_id", fingerprint_column(F.col("text"), width)
                                              .alias("fp")))
    return prints.join(components(prints, radius, tile_rows), "fp").select(
        "doc_id", "fp", "component_id")


def deduplicate(docs: DataFrame, width: int = SHINGLE_WORDS, radius: int = RADIUS,
                tile_rows: int = TILE_ROWS) -> DataFrame:
    """One row of ``docs`` for each group, with its columns.

    It is the row with the smallest id (null ids last) and then the smallest
    text hash; of rows equal in both, any one.
    """
    own = [F.col("doc_id").cast("bigint").alias("__id"),
           F.xxhash64(F.coalesce("text", F.lit(""))).alias("__hash")]
    prints = materialize(docs.select(*own, fingerprint_column(F.col("text"), width).alias("fp")))
    groups = components(prints.withColumnRenamed("__id", "doc_id"), radius, tile_rows)
    kept = (prints.join(groups, "fp").groupBy(F.coalesce("component_id", "fp"),
                                              F.col("component_id").isNull())
            .agg(F.min(F.struct(F.col("__id").isNull().alias("last"), F.col("__id"),
                                F.col("__hash"))).alias("row"))
            .select(F.col("row.__id").alias("__kid"), F.col("row.__hash").alias("__khash")))
    rows = docs.select("*", *own)
    rows = rows.join(kept, F.col("__id").eqNullSafe(F.col("__kid"))
                     & (F.col("__hash") == F.col("__khash")), "left_semi")
    one = Window.partitionBy("__id", "__hash").orderBy("__hash")
    return (rows.withColumn("__n", F.row_number().over(one)).where("__n = 1")
            .drop("__id", "__hash", "__n"))
