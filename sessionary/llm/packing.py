"""Best-fit packing of token ids into sequences (operator 10).

``token_pieces`` cuts documents into pieces of at most ``capacity`` ids;
``pack`` places items by their lengths alone:

1. Items are dealt by hash into buckets of about ``bucket_items`` and each
   bucket packs its own by best fit, longest first.  Full and nearly full bins
   are final.  Of the others, a bucket passes on every bin that is at most half
   full (best fit leaves at most one) and the ``hosts`` emptiest fuller bins.
   Two bins over half can't share a sequence, so no more than the half-empty
   ones could still find a place.
2. Passed bins are items of the next round, where ``fan_in`` buckets meet in
   one; rounds repeat until one bucket is left.  A round's group holds at most
   ``fan_in * (hosts + 1)`` rows, whatever the input.

Every round writes its places (child bin -> parent bin, offset) as a table; an
item's sequence and offset follow from one join per round with those small
tables.  Nothing but the count of items and of buckets reaches the driver.

Defined results: a null or empty text is one piece holding the end id; a null
doc_id is a document like any other; repeated rows are packed each on their
own; empty table: no rows; extra columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionary.llm.common import id_text
from sessionary.llm.wordbpe import default_path, encoder
from sessionary.session import materialize

CAPACITY = 2048
BUCKET_ITEMS = 100_000
FAN_IN = 32
HOSTS = 32


def _pieces(path: str, end_id: int, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, piece, start, length, ids = [], [], [], [], []

            def made() -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays([
                    pa.array(docs, pa.int64()), pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                    pa.array(ids, pa.binary())],
                    names=["doc_id", "piece", "start", "length", "ids"])

            for doc, own in zip(batch.column("doc_id").to_pylist(),
                                encoder(path).encode(batch.column("text"))):
                own = np.append(own, np.uint32(end_id))
                for n, at in enumerate(range(0, len(own), capacity)):
                    part = own[at:at + capacity]
                    docs.append(doc)
                    piece.append(n)
                    start.append(at)
                    length.append(len(part))
                    ids.append(part.tobytes())
                if len(ids) >= 2000:
                    yield made()
                    docs, piece, start, length, ids = [], [], [], [], []
            if docs:
                yield made()
    return run


def token_pieces(docs: DataFrame, capacity: int = CAPACITY, end_id: int = 0,
                 path: str | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids (little-endian uint32 bytes) of each piece."""
    return id_text(docs).mapInArrow(
        _pieces(path or default_path(), end_id, capacity),
        "doc_id bigint, piece int, start bigint, length bigint, ids binary")


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset) of each item and the fill of each bin: best fit, longest first.

    Open bins are kept by the room they have left, so an item finds the
    tightest bin by bisection over at most ``capacity`` different rooms.
    """
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    rooms, by_room, fill = [], defaultdict(list), []
    for item in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[item])
        k = bisect_left(rooms, need)
        if k < len(rooms):
            room = rooms[k]
            own = by_room[room].pop()
            if not by_room[room]:
                rooms.pop(k)
        else:
            room, own = capacity, len(fill)
            fill.append(0)
        bins[item], offsets[item] = own, capacity - room
        fill[own] += need
        room -= need
        if room:
            if not by_room[room]:
                insort(rooms, room)
            by_room[room].append(own)
    return bins, offsets, np.array(fill, np.int64)


def _round(capacity: int, hosts: int, last: bool):
    """One group of items -> their places, with the bins that go on marked."""
    def run(items: pd.DataFrame) -> pd.DataFrame:
        items = items.sort_values(["length", "item"], ascending=[False, True])
        lengths = items["length"].to_numpy(np.int64)
        bins, offsets, fill = best_fit(lengths, capacity)
        # a bin is named after its first item
        first = np.full(len(fill), -1, np.int64)
        first[bins[::-1]] = items["item"].to_numpy(np.int64)[::-1]
        goes_on = np.zeros(len(fill), bool)
        if not last:
            goes_on = 2 * fill <= capacity
            rest = np.flatnonzero(~goes_on & (fill < capacity))
            goes_on[rest[np.argsort(fill[rest], kind="stable")[:hosts]]] = True
        return pd.DataFrame({"item": items["item"].to_numpy(np.int64), "bin": first[bins],
                             "offset": offsets, "fill": fill[bins], "goes_on": goes_on[bins],
                             "bucket": items["bucket"].to_numpy(np.int64)})
    return run


def pack(items: DataFrame, capacity: int = CAPACITY, bucket_items: int = BUCKET_ITEMS,
         fan_in: int = FAN_IN, hosts: int = HOSTS) -> DataFrame:
    """(item, length) with unique bigint items -> item, sequence_id, offset."""
    n = items.count()
    buckets = max(1, -(-n // bucket_items))
    placed_schema = ("item bigint, bin bigint, offset bigint, fill bigint, goes_on boolean, "
                     "bucket bigint")
    todo = items.select("item", "length", F.pmod(F.xxhash64("item"), F.lit(buckets)).alias("bucket"))
    rounds = []
    while True:
        last = buckets == 1
        places = materialize(todo.groupBy("bucket").applyInPandas(
            _round(capacity, hosts, last), placed_schema))
        rounds.append(places)
        if last:
            break
        buckets = -(-buckets // fan_in)
        todo = (places.where("goes_on and item = bin")
                .select(F.col("bin").alias("item"), F.col("fill").alias("length"),
                        F.floor(F.col("bucket") / fan_in).alias("bucket")))
    out = rounds[0].select("item", F.col("bin").alias("sequence_id"), "offset")
    for places in rounds[1:]:
        moved = places.select(F.col("item").alias("sequence_id"), F.col("bin").alias("_bin"),
                              F.col("offset").alias("_by"))
        out = out.join(moved, "sequence_id", "left").select(
            "item", F.coalesce("_bin", "sequence_id").alias("sequence_id"),
            (F.col("offset") + F.coalesce("_by", F.lit(0))).alias("offset"))
    return out


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, end_id: int = 0,
                   path: str | None = None, **options) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece.

    The ids themselves are ``token_pieces``; only their checksums are kept
    beside the lengths while packing.
    """
    pieces = materialize(
        token_pieces(docs, capacity, end_id, path)
        .select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"),
                F.monotonically_increasing_id().alias("item")))
    return (pieces.join(pack(pieces, capacity, **options), "item")
            .select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"))
