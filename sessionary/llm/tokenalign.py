"""Cross-tokenizer alignment by pointer jumping (operator 12).

A text is encoded by two tokenizers, A (byte-level BPE) and B (pieces with byte
fallback); both sets of tokens cover the same bytes.  Tokens that overlap belong
to one group, and a group ends where a token of A and one of B end together;
that pair of tokens is its link.

Grouping is vectorised over many texts at once: every token points to its
farthest-right overlapping token (the token of the other side that covers its
last byte, if that reaches beyond it), and successors are doubled until no
pointer moves; each token then holds the terminal token of its group.

Neither tokenizer's tokens reach across a single space between two other
characters, so a text is cut in front of these and every different piece of a
slice of texts is encoded and aligned once.  The corpus-wide count of an id pair
comes from one row per pair and slice (not per text): the counts are summed by
pair, joined back to the slices' pairs, and each slice's texts meet the counts of
their pairs in a group that is as large as the slice (``SLICE_CHARS`` characters
of whole texts, or one longer text).

Defined results: null or empty text, or a text whose tokens' joined bytes differ
from space + text on either side: no tokens, zeros and an empty digest; repeated
rows: one result each, all counted; an empty table gives no rows; extra columns
are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionary.llm.common import id_text
from sessionary.session import materialize

#: Characters of whole texts (or one longer text) and texts that are aligned together.
SLICE_CHARS = 4_000_000
SLICE_TEXTS = 4_000
#: Characters of parts that are encoded as one text.
RUN_CHARS = 20_000

#: In front of a single space between two characters that are not white space.
_CUT = re.compile(r"(?<=\S) (?=\S)")
_SPACE = "▁"


def default_paths() -> tuple[str, str]:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def byte_of_sign() -> dict[str, int]:
    """The byte that each printable stand-in of byte-level pieces means."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(256 + k): b for k, b in enumerate(rest)}}


class Encoders:
    """Both tokenizers, with the bytes of every id."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        signs = byte_of_sign()
        self.a_bytes = [bytes(signs[c] for c in self.a.id_to_token(k))
                        if all(c in signs for c in self.a.id_to_token(k)) else
                        self.a.id_to_token(k).encode() for k in range(self.a.get_vocab_size())]
        pieces = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(k) else
                        p.replace(_SPACE, " ").encode() for k, p in enumerate(pieces)]
        self.names = [str(k) for k in range(max(len(self.a_bytes), len(self.b_bytes)))]
        self.a_size = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_size = np.array([len(x) for x in self.b_bytes], np.int64)
        # cutting is safe only if no piece holds a space behind another character
        self.cuts = not any(_SPACE in p.lstrip(_SPACE) for p in pieces)

    def pieces(self, text: str) -> list[str]:
        """The text in parts that are encoded on their own (their leading space left out)."""
        return _CUT.split(text) if self.cuts and _SPACE not in text else [text]

    def _both(self, text: str) -> list[np.ndarray] | None:
        """Ids of A and B of space + text, or None if their bytes differ from it."""
        ids = (self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text))
        whole = b" " + text.encode()
        if any(b"".join([blobs[i] for i in own]) != whole
               for own, blobs in zip(ids, (self.a_bytes, self.b_bytes))):
            return None
        return [np.array(own, np.int64) for own in ids]

    def _joined(self, parts: list[str]) -> tuple[list, list] | None:
        """(ids, tokens per part) of A and of B for parts that are encoded as one text."""
        ids = self._both(" ".join(parts))
        if ids is None:
            return None
        ends = np.cumsum([len(p.encode()) + 1 for p in parts])
        counts = []
        for own, size in zip(ids, (self.a_size, self.b_size)):
            cuts = np.cumsum(size[own])
            at = np.searchsorted(cuts, ends)
            if not np.array_equal(cuts[at], ends):
                return None
            counts.append(np.diff(at + 1, prepend=0))
        return ids, counts

    def encode(self, parts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
        """Ids of all parts and tokens per part, of A and of B; whether a part has tokens.

        Runs of parts without white space at their ends are encoded as one text,
        joined by single spaces, which is where texts are cut; a run whose bytes
        come back otherwise is encoded part by part.
        """
        ids, counts, good = ([], []), ([], []), []

        def add(found: tuple | None, n: int) -> bool:
            if found is not None:
                for side in (0, 1):
                    ids[side].append(found[0][side])
                    counts[side].append(found[1][side])
                good.extend([True] * n)
            return found is not None

        def alone(part: str) -> None:
            own = self._both(part)
            if own is None:
                own = [np.empty(0, np.int64)] * 2
            add((own, [np.array([len(x)]) for x in own]), 1)
            good[-1] = len(own[0]) > 0

        def flush(run: list[str]) -> None:
            if run and not add(self._joined(run), len(run)):
                for part in run:
                    alone(part)
        run, held = [], 0
        for part in parts:
            if not self.cuts or _SPACE in part or part != part.strip():
                flush(run)
                alone(part)
                run, held = [], 0
                continue
            run.append(part)
            held += len(part)
            if held > RUN_CHARS:
                flush(run)
                run, held = [], 0
        flush(run)
        none = [np.empty(0, np.int64)]
        return ([np.concatenate(side or none) for side in ids],
                [np.concatenate(side or none) for side in counts], np.array(good, bool))


@functools.lru_cache(maxsize=2)
def encoders(a_path: str, b_path: str) -> Encoders:
    import os
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return Encoders(a_path, b_path)


def terminals(a_end: np.ndarray, b_end: np.ndarray) -> np.ndarray:
    """The terminal token of each token's group, by pointer jumping.

    ``a_end`` and ``b_end``: ascending ends of tokens that cover the same bytes.
    Tokens of A count from 0, those of B follow; a group's terminal is the token
    of B that ends together with one of A.
    """
    n = len(a_end)
    # the token of the other side that covers a token's last byte
    over_a = np.searchsorted(b_end, a_end)
    over_b = np.searchsorted(a_end, b_end)
    succ = np.concatenate([n + over_a, np.where(a_end[over_b] > b_end, over_b, n + np.arange(len(b_end)))])
    while True:
        far = succ[succ]
        if np.array_equal(far, succ):
            return succ
        succ = far


def align(a_ids: np.ndarray, b_ids: np.ndarray, a_size: np.ndarray, b_size: np.ndarray
          ) -> tuple[np.ndarray, np.ndarray]:
    """Group number (from 0, in order) of every token of A and of B."""
    label = terminals(np.cumsum(a_size[a_ids]), np.cumsum(b_size[b_ids]))
    _, group = np.unique(label, return_inverse=True)
    return group[:len(a_ids)], group[len(a_ids):]


def _gather(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The indices starts[k] .. starts[k] + counts[k] - 1, one run after another."""
    total = np.cumsum(counts)
    return np.repeat(starts - (total - counts), counts) + np.arange(total[-1] if len(total) else 0)


class Aligned:
    """The texts of one slice, aligned through their different parts."""

    def __init__(self, texts: list[str], enc: Encoders):
        split = [enc.pieces(t) if t else [] for t in texts]
        number = pa.array(itertools.chain.from_iterable(split), pa.large_string()).dictionary_encode()
        parts, place = number.dictionary.to_pylist(), number.indices.to_numpy()
        cut = np.cumsum([0, *map(len, split)])
        del split, number
        (a_ids, b_ids), (n_a, n_b), good = enc.encode(parts)
        del parts
        if len(a_ids):
            a_group, b_group = align(a_ids, b_ids, enc.a_size, enc.b_size)
            last_a, last_b = (np.flatnonzero(np.diff(g, append=-1)) for g in (a_group, b_group))
        else:
            a_group = b_group = last_a = last_b = np.empty(0, np.int64)
        links = a_ids[last_a] << 32 | b_ids[last_b]
        self.pairs, link_pair = np.unique(links, return_inverse=True)
        a_cut, n_groups = np.cumsum(n_a), np.zeros(len(n_a), np.int64)
        some = np.flatnonzero(n_a)
        n_groups[some] = a_group[a_cut[some] - 1] - a_group[a_cut[some] - n_a[some]] + 1
        shown = self._shown(enc.names, a_ids, b_ids, last_a, last_b, n_groups)
        first_group = np.cumsum(n_groups) - n_groups
        self.n_a, self.n_b, self.n_groups, self.digest = [], [], [], []
        self.pair_at, self.times = [], []
        self.totals = np.zeros(len(self.pairs), np.int64)
        for k in range(len(texts)):
            at = place[cut[k]:cut[k + 1]]
            if not good[at].all():
                at = at[:0]
            self.n_a.append(int(n_a[at].sum()))
            self.n_b.append(int(n_b[at].sum()))
            self.n_groups.append(int(n_groups[at].sum()))
            self.digest.append(hashlib.sha256(";".join([shown[k] for k in at.tolist()]).encode())
                               .hexdigest() if len(at) else "")
            used, times = np.unique(link_pair[_gather(first_group[at], n_groups[at])], return_counts=True)
            self.totals[used] += times
            self.pair_at.append(used.astype(np.int32))
            self.times.append(times)

    @staticmethod
    def _shown(names, a_ids, b_ids, last_a, last_b, n_groups) -> list[str]:
        """``a1,a2|b1;a3|b2`` of each part."""
        a_text, b_text = ([names[i] for i in ids.tolist()] for ids in (a_ids, b_ids))
        groups, a, b = [], 0, 0
        for x, y in zip((last_a + 1).tolist(), (last_b + 1).tolist()):
            groups.append(f"{a_text[a]}|{b_text[b]}" if x - a == 1 == y - b else
                          ",".join(a_text[a:x]) + "|" + ",".join(b_text[b:y]))
            a, b = x, y
        out, at = [], 0
        for n in n_groups.tolist():
            out.append(";".join(groups[at:at + n]))
            at += n
        return out


_FIELDS = ("slice string, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, "
           "pairs array<bigint>, times array<bigint>, pair_at array<int>")
_ARROW = pa.schema([("slice", pa.string()), *[(c, pa.int64()) for c in ("doc_id", "n_a", "n_b", "n_groups")],
                    ("groups_sha256", pa.string()), ("pairs", pa.list_(pa.int64())),
                    ("times", pa.list_(pa.int64())), ("pair_at", pa.list_(pa.int32()))])


def _slices(texts: list) -> Iterator[tuple[int, int]]:
    start = held = 0
    for k, text in enumerate(texts):
        size = len(text or "")
        if k > start and (held + size > SLICE_CHARS or k - start >= SLICE_TEXTS):
            yield start, k
            start, held = k, 0
        held += size
    if start < len(texts):
        yield start, len(texts)


def _aligned(a_path: str, b_path: str):
    """A row per text (its pairs by place in the slice's), and one of the slice's pairs and totals."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoders(a_path, b_path)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for start, stop in _slices(texts):
                done, name = Aligned(texts[start:stop], enc), uuid.uuid4().hex
                n = stop - start
                columns = {
                    "slice": pa.array([name] * n), "doc_id": batch.column("doc_id")[start:stop],
                    "n_a": pa.array(done.n_a, pa.int64()), "n_b": pa.array(done.n_b, pa.int64()),
                    "n_groups": pa.array(done.n_groups, pa.int64()),
                    "groups_sha256": pa.array(done.digest, pa.string()),
                    "times": pa.array(done.times, pa.list_(pa.int64())),
                    "pair_at": pa.array(done.pair_at, pa.list_(pa.int32()))}
                yield pa.RecordBatch.from_arrays(
                    [columns.get(f.name, pa.nulls(n, f.type)) for f in _ARROW], schema=_ARROW)
                columns = {"slice": pa.array([name]), "pairs": pa.array([done.pairs], pa.list_(pa.int64())),
                           "times": pa.array([done.totals], pa.list_(pa.int64()))}
                yield pa.RecordBatch.from_arrays(
                    [columns.get(f.name, pa.nulls(1, f.type)) for f in _ARROW], schema=_ARROW)
    return run


def _summed(texts: pa.Table, pairs: pa.Table) -> pa.Table:
    """The texts of a slice with the sums over their pairs' corpus-wide counts."""
    size = pairs.num_rows
    count, best = np.zeros(size, np.int64), np.zeros(size, np.int64)
    at = pairs["at"].to_numpy()
    count[at], best[at] = pairs["n"].to_numpy(), pairs["best"].to_numpy(zero_copy_only=False)
    own, times = texts["pair_at"].combine_chunks(), texts["times"].combine_chunks()
    flat, weight = own.flatten().to_numpy(), times.flatten().to_numpy()
    row = np.repeat(np.arange(len(own)), own.value_lengths().to_numpy(zero_copy_only=False))
    sums = np.zeros((2, len(own)), np.int64)
    np.add.at(sums[0], row, count[flat] * weight)
    np.add.at(sums[1], row, best[flat] * weight)
    return texts.select(["doc_id", "n_a", "n_b", "n_groups"]).append_column(
        "n_best", pa.array(sums[1])).append_column("count_sum", pa.array(sums[0])).append_column(
        "groups_sha256", texts["groups_sha256"])


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n, best): links of each id pair in all texts, and whether no pair of its B id has more."""
    counts = (aligned.where("pairs IS NOT NULL")
              .select(F.explode(F.arrays_zip("pairs", "times")).alias("p"))
              .groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.times").alias("n")))
    counts = materialize(counts.withColumn("b", F.col("pair").bitwiseAND((1 << 32) - 1)))
    top = counts.groupBy("b").agg(F.max("n").alias("top"))  # a row per id of B's vocabulary
    return counts.join(F.broadcast(top), "b").select(
        "pair", "n", (F.col("n") == F.col("top")).cast("int").alias("best"))


def align_documents(docs: DataFrame, paths: tuple[str, str] | None = None) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every text."""
    aligned = materialize(id_text(docs).mapInArrow(_aligned(*(paths or default_paths())), _FIELDS))
    pairs = (aligned.where("pairs IS NOT NULL")
             .select(F.col("slice").alias("of"), F.posexplode("pairs").alias("at", "pair"))
             .join(pair_counts(aligned), "pair").select("of", "at", "n", "best"))
    texts = aligned.where("pairs IS NULL").select(
        "slice", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "times", "pair_at")
    out = texts.groupBy("slice").cogroup(pairs.groupBy("of")).applyInArrow(_summed, (
        "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_best bigint, count_sum bigint, "
        "groups_sha256 string"))
    # a group ends in exactly one pair of tokens that end together
    return out.select("doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"),
                      "n_best", "count_sum", "groups_sha256")
