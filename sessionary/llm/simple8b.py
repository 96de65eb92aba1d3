"""Token-id files: Simple-8b word-aligned coding (operator 9).

File format.  A table of segments; each segment row holds whole documents in
ascending order and one binary ``data`` with

    magic ``S8B1`` | u32 blocks | u64 ids
    u32 word offset per block (+ end) | u32 escape offset per block (+ end)
    u8 escape bits per block, zero-padded to 8 bytes
    u64 words | u64 escapes

A word holds a 4-bit selector in its top bits and ``COUNTS[selector]`` ids of
``60 // count`` bits each, the first id lowest.  In a block with escape bits e
a value of 2**e - 1 stands for the next number of the block's escape list.
Blocks of ``BLOCK_IDS`` ids stand alone, so a reader decodes any of them, or
all of a segment at once, with whole-array operations.

Writing: documents are range-partitioned and sorted by id (one shuffle of the
texts), encoded in that order and written by Spark into the shared folder, so
a lost executor only repeats its own partitions.  One row per written
partition (its number of ids) reaches the driver, to number all ids.

Defined results: null or empty text: just the end id; null doc_id: sorted
first; repeated rows: one entry each, ties ordered by the text's hash; empty
table: no segments, no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionary.llm.common import id_text
from sessionary.llm.wordbpe import default_path, encoder
from sessionary.session import materialize

#: Fixed values of the coding: ids in a word by selector; each has 60 // count bits.
COUNTS = (60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
BLOCK_IDS = 4096
SEGMENT_IDS = 1 << 17
_MAGIC = b"S8B1"
_PAD = 64  # sign of "no id here" in the bit counts: wider than any word


def _bit_counts(ids: np.ndarray) -> np.ndarray:
    if len(ids) and int(ids.max()) < 1 << 32:  # exact in a double
        return np.frexp(ids.astype(np.float64))[1].astype(np.uint8)
    high = np.frexp((ids >> np.uint64(32)).astype(np.float64))[1]
    low = np.frexp((ids & np.uint64(0xFFFFFFFF)).astype(np.float64))[1]
    return np.where(high > 0, high + 32, low).astype(np.uint8)


def _escape(block: np.ndarray, bits: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """(escape bits, ids to pack, escapes): the few wide ids of a block leave it.

    Ids beyond 60 bits have to leave; else up to one id in sixteen does when
    the others then fit into one of the selectors' widths.
    """
    for e in (10, 12, 15, 20, 30):
        wide = block >= np.uint64((1 << e) - 1)
        n = int(wide.sum())
        if n == 0 and int(bits.max()) <= e:
            return 0, block, block[:0]
        if n <= len(block) // 16:
            return e, np.where(wide, np.uint64((1 << e) - 1), block), block[wide]
    if int(bits.max()) <= 60:
        return 0, block, block[:0]
    wide = block >= np.uint64((1 << 60) - 1)
    return 60, np.where(wide, np.uint64((1 << 60) - 1), block), block[wide]


def encode_segment(ids: np.ndarray) -> bytes:
    """Any array of unsigned integers -> bytes of one segment."""
    ids = np.ascontiguousarray(ids, np.uint64)
    n_blocks = -(-len(ids) // BLOCK_IDS)
    bits = _bit_counts(ids)
    kept, escapes, esc_bits = ids.copy(), [], np.zeros(n_blocks, np.uint8)
    for k in range(n_blocks):
        at = slice(k * BLOCK_IDS, (k + 1) * BLOCK_IDS)
        esc_bits[k], kept[at], out = _escape(ids[at], bits[at])
        escapes.append(out)
    bits = _bit_counts(kept)
    # widest id among the next c ids, from every place; a pad column ends blocks
    width = BLOCK_IDS + max(COUNTS)
    grid = np.full((n_blocks, width), _PAD, np.uint8)
    full = np.full(n_blocks * BLOCK_IDS, _PAD, np.uint8)
    full[:len(ids)] = bits
    grid[:, :BLOCK_IDS] = full.reshape(n_blocks, BLOCK_IDS)
    line = grid.reshape(-1)
    best = np.ones(len(line), np.uint8)
    widest, done = line.copy(), 1
    for c in sorted(COUNTS)[1:]:
        for step in range(done, c):
            np.maximum(widest[:-step], line[step:], out=widest[:-step])
        done = c
        best[widest <= 60 // c] = c
    # follow the chain of words, block by block
    take, starts, counts, word_at = best.tobytes(), [], [], np.zeros(n_blocks + 1, np.uint32)
    for k in range(n_blocks):
        i, end = k * width, k * width + min(BLOCK_IDS, len(ids) - k * BLOCK_IDS)
        shift = k * (width - BLOCK_IDS)
        while i < end:
            c = take[i]
            starts.append(i - shift)
            counts.append(c)
            i += c
        word_at[k + 1] = len(starts)
    starts, counts = np.array(starts, np.int64), np.array(counts, np.uint8)
    words = np.zeros(len(starts), np.uint64)
    for selector, c in enumerate(COUNTS):
        own = np.flatnonzero(counts == c)
        if len(own):
            word, first = np.full(len(own), selector << 60, np.uint64), starts[own]
            for k in range(c):
                word |= kept[first + k] << np.uint64(k * (60 // c))
            words[own] = word
    esc_at = np.cumsum([0, *map(len, escapes)]).astype(np.uint32)
    flags = esc_bits.tobytes()
    return b"".join([
        _MAGIC, np.uint32(n_blocks).tobytes(), np.uint64(len(ids)).tobytes(), word_at.tobytes(),
        esc_at.tobytes(), flags + bytes(-len(flags) % 8), words.tobytes(),
        *(x.tobytes() for x in escapes)])


def decode_segment(data: bytes) -> np.ndarray:
    """Bytes of one segment -> its ids (uint64)."""
    if data[:4] != _MAGIC:
        raise ValueError("not a Simple-8b segment")
    n_blocks = int(np.frombuffer(data, "<u4", 1, 4)[0])
    n_ids = int(np.frombuffer(data, "<u8", 1, 8)[0])
    at = 16
    word_at = np.frombuffer(data, "<u4", n_blocks + 1, at).astype(np.int64)
    at += 4 * (n_blocks + 1)
    esc_at = np.frombuffer(data, "<u4", n_blocks + 1, at)
    at += 4 * (n_blocks + 1)
    esc_bits = np.frombuffer(data, "u1", n_blocks, at)
    at += n_blocks + -n_blocks % 8
    words = np.frombuffer(data, "<u8", int(word_at[-1]), at)
    escapes = np.frombuffer(data, "<u8", int(esc_at[-1]), at + 8 * len(words))
    selectors = (words >> np.uint64(60)).astype(np.uint8)
    counts = np.array(COUNTS, np.int64)[selectors]
    first = np.cumsum(counts) - counts
    out = np.empty(n_ids, np.uint64)
    for selector, c in enumerate(COUNTS):
        own = np.flatnonzero(selectors == selector)
        if len(own):
            word, mask = words[own], np.uint64((1 << (60 // c)) - 1)
            for k in range(c):
                out[first[own] + k] = (word >> np.uint64(k * (60 // c))) & mask
    if len(escapes):
        for k in np.flatnonzero(esc_bits):
            block = out[k * BLOCK_IDS:(k + 1) * BLOCK_IDS]
            block[block == np.uint64((1 << int(esc_bits[k])) - 1)] = escapes[esc_at[k]:esc_at[k + 1]]
    return out


_SEGMENTS = ("part int, segment int, doc_ids array<bigint>, lengths array<bigint>, "
             "before bigint, n_ids bigint, data binary")


def _segments(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, ids, held, number, before, part = [], [], 0, 0, 0, 0

        def segment() -> pa.RecordBatch:
            flat = np.concatenate(ids)
            return pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([number], pa.int32()),
                pa.array([docs], pa.list_(pa.int64())),
                pa.array([[len(x) for x in ids]], pa.list_(pa.int64())),
                pa.array([before], pa.int64()), pa.array([len(flat)], pa.int64()),
                pa.array([encode_segment(flat)], pa.binary())],
                names=["part", "segment", "doc_ids", "lengths", "before", "n_ids", "data"])

        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch.column("part")[0].as_py()
            for doc, own in zip(batch.column("doc_id").to_pylist(),
                                encoder(path).encode(batch.column("text"))):
                docs.append(doc)
                ids.append(np.append(own, np.uint32(end_id)))
                held += len(own) + 1
                if held >= SEGMENT_IDS:
                    yield segment()
                    docs, ids, held, number, before = [], [], 0, number + 1, before + held
        if docs:
            yield segment()
    return run


def write_token_ids(docs: DataFrame, end_id: int = 1, path: str | None = None) -> DataFrame:
    """Segments of all documents, written into the shared folder and read back."""
    dealt = (id_text(docs).withColumn("tie", F.xxhash64("text"))
             .repartitionByRange(F.col("doc_id").asc_nulls_first(), "tie")
             .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "tie", "text")
             .select(F.spark_partition_id().alias("part"), "doc_id", "text"))
    return materialize(dealt.mapInArrow(_segments(path or default_path(), end_id), _SEGMENTS))


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            row = {name: batch.column(name)[k].as_py() for name in batch.schema.names}
            ids = decode_segment(row["data"]).astype("<u4")
            lengths = np.array(row["lengths"], np.int64)
            ends = np.cumsum(lengths)
            yield pa.RecordBatch.from_arrays([
                pa.array([row["part"]] * len(ends), pa.int32()),
                pa.array(row["doc_ids"], pa.int64()),
                pa.array(row["before"] + ends - lengths), pa.array(lengths),
                pa.array([x.tobytes() for x in np.split(ids, ends[:-1])], pa.binary())],
                names=["part", "doc_id", "own_start", "n_tokens", "ids"])


def read_token_ids(segments: DataFrame) -> DataFrame:
    """doc_id, start (ids before it), n_tokens, ids (little-endian uint32 bytes).

    A segment knows the ids before it in its written partition; those of the
    earlier partitions are summed on the driver, from one row per partition.
    """
    sizes = segments.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()
    starts, total = [], 0
    for row in sizes:
        starts.append((row["part"], total))
        total += row["n"]
    starts = segments.sparkSession.createDataFrame(starts, "part int, part_start bigint")
    rows = segments.select("part", "doc_ids", "lengths", "before", "data").mapInArrow(
        _documents, "part int, doc_id bigint, own_start bigint, n_tokens bigint, ids binary")
    return rows.join(F.broadcast(starts), "part").select(
        "doc_id", (F.col("part_start") + F.col("own_start")).alias("start"), "n_tokens", "ids")


def token_ids(docs: DataFrame, end_id: int = 1, path: str | None = None) -> DataFrame:
    """Write the files of all documents and read them back."""
    return read_token_ids(write_token_ids(docs, end_id, path))
