"""Conversation prefix trie by truncation peeling (operator 13).

Every distinct sequence of first turns is a node.  Conversations are rows of node
keys (a chained MD5 of role and text per turn, 16 bytes each), sorted by that
path over a range partitioning, so that the conversations of a node are
neighbours; the conversation id is part of the range, so copies of one
conversation spread over many tasks.

A slice of ``slice_rows`` neighbours is peeled from its greatest depth down: the
conversations that end at a depth join the nodes that survive from below, the
last turn is stripped, equal keys regroup, and counts, leaves and savings are
summed on the way.  A node that holds neither the first nor the last row of its
slice is complete there.  The others lie on the paths of these two rows, which
carry their partial sums to the next round; a round keeps at most two rows a
slice, so a few rounds end in one slice.  Each round is one sorted job and its
result a table in the shared folder.

Texts never travel: what a row holds of a conversation is 16 bytes and a word
count per turn.  The ids that end at a node are hashed in order: within their
slice, or for a node over several slices as a stream of the slices' strings.

Defined results: null role or text: empty; null turn: first; turns with equal
numbers: by the MD5 of role and text; rows without conv_id: dropped; repeated
rows are turns of their own; an empty table gives no nodes; extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionary.llm.common import shuffle_parts
from sessionary.session import materialize

HEAD_TURNS, HEAD_STEP = 4, 20
SLICE_ROWS = 4_096
SLICE_TURNS = 1_000_000
LEAST_ROWS = 8

_ROOT = hashlib.md5(b"").digest()
_NONE = np.iinfo(np.int64).max
#: Numbers that a row carries for each node of its path.
_SUMS = ("words", "n", "least", "children", "leaves", "saved")
_PATH = "path array<binary>, sums array<bigint>"
_OUT = ("kind int, key binary, parent binary, depth bigint, conv_id bigint, parent_conv_id bigint, "
        "n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends string, " + _PATH)
NODE, ENDS, EDGE = range(3)


def word_count(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text."""
    return F.size(F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))


def turn_lists(conversations: DataFrame) -> DataFrame:
    """conv_id, turns: array of (digest, words) in the order of the turns."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)))
    turn = F.col("turn").cast("bigint")
    return (conversations.where("conv_id IS NOT NULL")
            .select(F.col("conv_id").cast("bigint").alias("conv_id"), F.struct(
                turn.isNotNull().alias("given"), turn.alias("turn"), digest.alias("digest"),
                word_count(text).alias("words")).alias("row"))
            .groupBy("conv_id").agg(F.array_sort(F.collect_list("row")).alias("rows"))
            .select("conv_id", F.transform("rows", lambda r: F.struct(
                r["digest"].alias("digest"), r["words"].alias("words"))).alias("turns")))


def shared_heads(lists: DataFrame) -> DataFrame:
    """Conversations rebuilt on the first turns of their group's conversation.

    The first h turns come from conversation c - c % 20, h = crc32(c) % 4.
    """
    c = F.col("conv_id")
    heads = lists.where(c % HEAD_STEP == 0).select(
        c.alias("head_id"), F.slice("turns", 1, HEAD_TURNS - 1).alias("head"))
    h = (F.crc32(c.cast("string").cast("binary")) % HEAD_TURNS).cast("int")
    none = F.slice("turns", 1, 0)
    return (lists.withColumn("head_id", c - c % HEAD_STEP).join(heads, "head_id", "left")
            .select("conv_id", F.concat(F.slice(F.coalesce("head", none), F.lit(1), h), F.slice(
                "turns", h + 1, F.size("turns"))).alias("turns")))


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (conv_id, path, sums): the keys of the nodes from the root to the end."""
    for batch in batches:
        paths, sums = [], []
        for conv, turns in zip(batch.column("conv_id").to_pylist(), batch.column("turns").to_pylist()):
            key, path = _ROOT, [_ROOT]
            for turn in turns:
                key = hashlib.md5(key + turn["digest"]).digest()
                path.append(key)
            own = np.zeros((len(path), len(_SUMS)), np.int64)
            own[1:, 0] = [turn["words"] for turn in turns]
            own[:, 2] = _NONE
            own[-1, 1:3] = 1, conv
            paths.append(path)
            sums.append(own.ravel())
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), pa.array(paths, pa.list_(pa.binary())),
             pa.array(sums, pa.list_(pa.int64()))], names=["conv_id", "path", "sums"])


class Slice:
    """Neighbouring rows in path order, peeled once."""

    def __init__(self, rows: pa.RecordBatch, first_round: bool, last_round: bool):
        paths = rows.column("path")
        self.length = paths.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.raw = paths.flatten()
        self.keys = np.array(self.raw.to_pylist(), dtype="S16")  # to compare; raw to return
        self.sums = rows.column("sums").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(_SUMS))
        self.convs = rows.column("conv_id").to_numpy() if first_round else None
        self.open_ended = not last_round
        self.edge = np.zeros_like(self.sums)
        self.edge[:, 0], self.edge[:, 2] = self.sums[:, 0], _NONE
        self.nodes: list[dict] = []
        self.ends: list[tuple] = []

    def _ended(self, at: np.ndarray, first: np.ndarray, depth: int, closed: np.ndarray,
               pos: np.ndarray) -> list[str | None]:
        """Digest of the ids that end at each closed node; an open node's ids are kept as text."""
        if self.convs is None:
            return [None] * len(first)
        ended = np.add.reduceat((self.length[at] == depth + 1).astype(np.int64), first)
        out = []
        for g, (a, n) in enumerate(zip(first.tolist(), ended.tolist())):
            ids = ",".join(map(str, self.convs[at[a:a + n]].tolist())) if n else ""
            out.append(hashlib.sha256(ids.encode()).hexdigest() if closed[g] else None)
            if n and not closed[g]:
                self.ends.append((self.raw[int(pos[a])].as_py(), int(self.convs[at[a]]), ids))
        return out

    def peel(self) -> "Slice":
        rows, below = len(self.length), None
        for depth in range(int(self.length.max(initial=0)) - 1, -1, -1):
            at = np.flatnonzero(self.length > depth)  # ended here, or survivors from below
            pos = self.start[at] + depth
            key = self.keys[pos]
            first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            n, children, leaves, saved = (np.add.reduceat(self.sums[pos, k], first) for k in (1, 3, 4, 5))
            least = np.minimum.reduceat(self.sums[pos, 2], first)
            closed = np.ones(len(first), bool)
            if self.open_ended:
                closed[0] &= at[0] != 0
                closed[-1] &= at[-1] != rows - 1
            if below is not None:  # strip the last turn: survivors regroup under their parents
                up = np.searchsorted(at[first], below["row"], "right") - 1
                own = below["closed"]
                for total, part in ((n, "n_convs"), (leaves, "n_leaves"), (saved, "saved_tokens")):
                    np.add.at(total, up[own], below[part][own])
                np.add.at(children, up[own], 1)
                np.minimum.at(least, up[own], below["conv_id"][own])
                below["parent_conv_id"] = np.where(closed[up], least[up], _NONE)
                self._emit(below)
            for g in np.flatnonzero(~closed):  # partial sums stay on the path of an edge row
                self.edge[pos[first[g]] if at[first[g]] == 0 else self.start[-1] + depth, 1:] = (
                    n[g], least[g], children[g], leaves[g], saved[g])
            leaves = np.where(closed & (children == 0), 1, leaves)
            saved = saved + np.where(closed, (n - 1) * self.sums[pos[first], 0], 0)
            below = {"row": at[first], "closed": closed, "pos": pos[first], "depth": depth,
                     "conv_id": least, "n_convs": n, "n_children": children, "n_leaves": leaves,
                     "saved_tokens": saved, "ends": self._ended(at, first, depth, closed, pos)}
        if below is not None:
            below["parent_conv_id"] = np.full(len(below["row"]), _NONE)
            self._emit(below)
        return self

    def _emit(self, level: dict) -> None:
        at = np.flatnonzero(level["closed"])
        if not len(at):
            return
        out = {name: level[name][at] for name in ("conv_id", "parent_conv_id", "n_convs", "n_children",
                                                  "n_leaves", "saved_tokens", "pos")}
        out["ends"] = [level["ends"][k] for k in at.tolist()]
        out["depth"] = level["depth"]
        self.nodes.append(out)

    def batches(self) -> Iterator[pa.RecordBatch]:
        for level in self.nodes:
            n, depth = len(level["pos"]), level["depth"]
            parent = self.raw.take(pa.array(level["pos"] - 1)) if depth else pa.nulls(n, pa.binary())
            known = pa.array(level["parent_conv_id"], mask=level["parent_conv_id"] == _NONE)
            yield _batch(n, kind=pa.array(np.full(n, NODE, np.int32)),
                         key=self.raw.take(pa.array(level["pos"])), parent=parent,
                         depth=pa.array(np.full(n, depth, np.int64)), parent_conv_id=known,
                         ends=pa.array(level["ends"], pa.string()),
                         **{name: pa.array(level[name]) for name in (
                             "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")})
        if self.ends:
            keys, ids, text = zip(*self.ends)
            yield _batch(len(keys), kind=pa.array([ENDS] * len(keys), pa.int32()),
                         key=pa.array(keys, pa.binary()), conv_id=pa.array(ids, pa.int64()),
                         ends=pa.array(text, pa.string()))
        if self.open_ended and len(self.length):
            edges = sorted({0, len(self.length) - 1})
            cut = [slice(self.start[k], self.start[k] + self.length[k]) for k in edges]
            yield _batch(len(edges), kind=pa.array([EDGE] * len(edges), pa.int32()),
                         path=pa.array([self.raw[c.start:c.stop].to_pylist() for c in cut],
                                       pa.list_(pa.binary())),
                         sums=pa.array([self.edge[c].ravel() for c in cut], pa.list_(pa.int64())))


_ARROW = pa.schema([
    ("kind", pa.int32()), ("key", pa.binary()), ("parent", pa.binary()),
    *[(name, pa.int64()) for name in ("depth", "conv_id", "parent_conv_id", "n_convs", "n_children",
                                      "n_leaves", "saved_tokens")],
    ("ends", pa.string()), ("path", pa.list_(pa.binary())), ("sums", pa.list_(pa.int64()))])


def _batch(n: int, **columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [columns.get(f.name, pa.nulls(n, f.type)) for f in _ARROW], schema=_ARROW)


def _peeled(first_round: bool, last_round: bool, slice_rows: int, slice_turns: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = turns = 0

        def flush() -> Iterator[pa.RecordBatch]:
            if rows:
                whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                yield from Slice(whole, first_round, last_round).peel().batches()
        for batch in batches:
            lengths = batch.column("path").value_lengths().to_numpy(zero_copy_only=False)
            at = 0
            for k, n in enumerate(lengths.tolist()):
                full = rows >= slice_rows or (rows >= LEAST_ROWS and turns + n > slice_turns)
                if full and not last_round:
                    held.append(batch.slice(at, k - at))
                    yield from flush()
                    held, rows, turns, at = [], 0, 0, k
                rows, turns = rows + 1, turns + n
            held.append(batch.slice(at))
        yield from flush()
    return run


def _rounds(paths: DataFrame, slice_rows: int, slice_turns: int) -> list[DataFrame]:
    """The tables of all rounds, the first on whole conversations."""
    spark, out, rows = paths.sparkSession, [], paths
    while True:
        size = rows.agg(F.count("*").alias("n"), F.sum(F.size("path")).alias("turns")).first()
        last = size["n"] <= LEAST_ROWS or (size["n"] <= slice_rows and size["turns"] <= slice_turns)
        order = ["path", "conv_id"] if not out else ["path"]
        parts = max(1, min(shuffle_parts(spark), size["n"] // 16))  # so that rounds always shrink
        peeled = (rows.repartitionByRange(parts, *order) if not last else rows.coalesce(1))
        out.append(materialize(peeled.sortWithinPartitions(*order).mapInArrow(
            _peeled(not out, last, slice_rows, slice_turns), _OUT)))
        if last:
            return out
        rows = out[-1].where(F.col("kind") == EDGE).select("path", "sums")


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of each key's strings in turn, joined by commas; rows come sorted by key."""
    key, digest = None, None

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([digest.hexdigest()])],
                                          names=["key", "ends_sha256"])
    for batch in batches:
        for own, ids in zip(batch.column("key").to_pylist(), batch.column("ends").to_pylist()):
            if own == key:
                digest.update(b",")
            else:
                if key is not None:
                    yield row()
                key, digest = own, hashlib.sha256()
            digest.update(ids.encode())
    if key is not None:
        yield row()


def trie(lists: DataFrame, slice_rows: int = SLICE_ROWS, slice_turns: int = SLICE_TURNS) -> DataFrame:
    """Nodes of the prefix trie of (conv_id, turns array<struct<digest, words>>) rows."""
    paths = materialize(lists.select("conv_id", "turns").mapInArrow(_keyed, "conv_id bigint, " + _PATH))
    rounds = _rounds(paths, slice_rows, slice_turns)
    late = [r.where(F.col("kind") == NODE) for r in rounds[1:]]
    fields = ["depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    nodes = rounds[0].where(F.col("kind") == NODE).select("key", "parent", *fields, "ends")
    if not late:
        return nodes.select(*fields, F.col("ends").alias("ends_sha256"))
    across = late[0]
    for more in late[1:]:
        across = across.unionByName(more)
    # ids that end at a node over several slices: the slices' strings in order
    ends = (rounds[0].where(F.col("kind") == ENDS).select("key", "conv_id", "ends")
            .repartition("key").sortWithinPartitions("key", "conv_id").select("key", "ends")
            .mapInArrow(_streamed, "key binary, ends_sha256 string"))
    across = across.join(ends, "key", "left").select("key", "parent", *fields, F.coalesce(
        "ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends"))
    whole = nodes.unionByName(across)
    lost = F.col("parent_conv_id").isNull() & (F.col("depth") > 0)
    parents = across.select(F.col("key").alias("parent"), F.col("conv_id").alias("top"))
    found = whole.where(lost).join(parents, "parent", "left").withColumn("parent_conv_id", F.col("top"))
    return whole.where(~lost).select(*fields, "ends").unionByName(
        found.select(*fields, "ends")).withColumnRenamed("ends", "ends_sha256")
