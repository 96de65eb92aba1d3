"""Byte-level BPE encoding and decoding by corpus-level merge replay (operator 5).

The different pieces of a slice of the corpus (an Arrow batch of whole texts)
are laid out as one row of tokens, one token a byte.  An inverted index leads
from a merge's rank to the places where its token pair stands.  The merges are
replayed in rank order over the whole slice: one merge takes all its places at
once, and only the pairs that its new tokens form with their neighbours are
looked up and indexed anew.  Texts are then gathered from their pieces, and
decoded again from the ids alone.

Pieces come from the published pattern.  It never joins a sign to a space that
follows it, so texts are cut before single spaces and every different cut goes
through the pattern once; texts with other runs of white space go whole.

Two details keep the ids equal to the tiktoken library's: a piece that is
itself a token is that token, and a word in which a merge makes a pair of
lower rank is replayed alone, leftmost lowest rank first.

Defined results: null or empty text: no ids, decoded as empty; repeated rows:
one result row each; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from sessionary.llm.common import id_text
from sessionary.llm.wordbpe import SLICE_WORDS

#: Most entries of the worker's memo of pieces; a full memo is dropped.
MEMO_PIECES = 400_000
_NONE = np.int64(1) << 40
_SHIFT = 20

#: Unicode white space, as in the pattern's \s.
_SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers
    return public_tokenizers.PATTERN


class RankEncoder:
    def __init__(self, path: str, pattern: str):
        import regex
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank)
                          for token, rank in (line.split() for line in lines if line.strip())}
        self.pattern = regex.compile(pattern)
        self.bytes_of = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.bytes_of[rank] = token
        self.byte_rank = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = {}
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                a, b = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if a is not None and b is not None:
                    pairs[(a << _SHIFT) | b] = rank
        keys = np.array(sorted(pairs), np.int64)
        self.pair_keys, self.pair_ranks = keys, np.array([pairs[k] for k in keys.tolist()], np.int64)
        self.token_len = np.array([len(x) for x in self.bytes_of], np.int64)
        self.token_off = np.cumsum(self.token_len) - self.token_len
        self.token_flat = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        self.memo: dict[str, bytes] = {}

    # ------------------------------------------------------------- merges

    def pair_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = (a << _SHIFT) | b
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], _NONE)

    def merge_alone(self, piece: bytes) -> list[int]:
        """Leftmost lowest rank first, on one piece."""
        parts = [bytes([b]) for b in piece]
        while len(parts) > 1:
            ranks = [self.ranks.get(parts[k] + parts[k + 1], _NONE) for k in range(len(parts) - 1)]
            low = min(ranks)
            if low == _NONE:
                break
            k = ranks.index(low)
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
        return [self.ranks[x] for x in parts]

    def replay(self, pieces: list[bytes]) -> list[bytes]:
        """Ids (little-endian uint32 bytes) of non-empty pieces, all merged together."""
        if not pieces:
            return []
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ends = np.cumsum(sizes)
        starts, n = ends - sizes, int(ends[-1])
        tok = self.byte_rank[np.frombuffer(b"".join(pieces), np.uint8)]
        nxt, prv, alive = np.arange(1, n + 1), np.arange(-1, n - 1), np.ones(n, bool)
        nxt[ends - 1], prv[starts] = -1, -1
        rank = np.full(n, _NONE)
        inner = np.flatnonzero(nxt >= 0)
        rank[inner] = self.pair_rank(tok[inner], tok[inner + 1])
        index: dict[int, list[np.ndarray]] = {}
        todo: list[int] = []
        odd: list[np.ndarray] = []

        def enter(places: np.ndarray) -> None:
            own = rank[places]
            places, own = places[own < _NONE], own[own < _NONE]
            if not len(own):
                return
            order = np.argsort(own, kind="stable")
            places, own = places[order], own[order]
            cuts = np.flatnonzero(own[1:] != own[:-1]) + 1
            firsts = own[np.concatenate([[0], cuts])].tolist()
            bounds = [0, *cuts.tolist(), len(own)]
            for k, r in enumerate(firsts):
                if r not in index:
                    index[r] = []
                    heappush(todo, r)
                index[r].append(places[bounds[k]:bounds[k + 1]])

        enter(inner)
        heapify(todo)
        while todo:
            r = heappop(todo)
            found = index.pop(r)
            at = found[0] if len(found) == 1 else np.unique(np.concatenate(found))
            at = at[rank[at] == r]
            if not len(at):
                continue
            after = nxt[at]
            joined = at[1:] == after[:-1]
            if joined.any():  # runs such as a-a-a: every second place, from the left
                every = np.arange(len(at))
                begin = np.maximum.accumulate(np.where(np.concatenate([[True], ~joined]), every, 0))
                keep = (every - begin) % 2 == 0
                at, after = at[keep], after[keep]
            tok[at] = r
            beyond = nxt[after]
            nxt[at] = beyond
            alive[after], rank[after], rank[at] = False, _NONE, _NONE
            inside = beyond >= 0
            prv[beyond[inside]] = at[inside]
            right, left = at[inside], prv[at]
            mid = left >= 0
            left = left[mid]
            rank[right] = self.pair_rank(tok[right], tok[nxt[right]])
            rank[left] = self.pair_rank(tok[left], tok[nxt[left]])
            touched = np.unique(np.concatenate([right, left]))
            lower = touched[rank[touched] < r]
            if len(lower):
                odd.append(lower)
            enter(touched)
        count = np.add.reduceat(alive, starts, dtype=np.int64)
        flat = tok[alive].astype("<u4").tobytes()
        upto = (4 * np.concatenate([[0], np.cumsum(count)])).tolist()
        out = [flat[upto[k]:upto[k + 1]] for k in range(len(pieces))]
        if odd:
            words = np.unique(np.searchsorted(ends, np.concatenate(odd), side="right"))
            for k in words.tolist():
                out[k] = np.array(self.merge_alone(pieces[k]), "<u4").tobytes()
        return out

    def encode_cuts(self, cuts: list[str]) -> list[bytes]:
        """Ids of strings, each cut into pieces by the pattern."""
        if len(self.memo) > MEMO_PIECES:
            self.memo.clear()
        memo, found = self.memo, [self.pattern.findall(x) for x in cuts]
        new = list({x for own in found for x in own if x not in memo})
        raw = [x.encode("utf-8") for x in new]
        known = [self.ranks.get(x) for x in raw]
        merged = iter(self.replay([x for x, rank in zip(raw, known) if rank is None]))
        for piece, rank in zip(new, known):
            memo[piece] = next(merged) if rank is None else rank.to_bytes(4, "little")
        return [memo[own[0]] if len(own) == 1 else b"".join([memo[x] for x in own])
                for own in found]

    # -------------------------------------------------------------- texts

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Ids (uint32) of each whole text in turn; null and empty texts have none."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        # texts in which white space stands before a space or at the end go whole
        whole = pc.match_substring_regex(texts, f"[{_SPACE}]( |$)|^ ").to_numpy(zero_copy_only=False)
        split = pc.split_pattern(pc.if_else(pa.array(whole), "", texts), " ")
        ends = split.offsets.to_numpy()
        parts = split.flatten()
        words = parts.dictionary_encode()
        first = parts.take(pa.array(ends[:-1] - ends[0])).to_pylist()
        rows = np.flatnonzero(whole)
        for row in rows.tolist():
            first[row] = texts[row].as_py()
        blobs = self.encode_cuts([f" {x}" for x in words.dictionary.to_pylist()])
        heads = self.encode_cuts(first)
        cnt = np.fromiter(map(len, blobs), np.int64, len(blobs)) // 4
        off = np.cumsum(cnt) - cnt
        flat = np.frombuffer(b"".join(blobs), "<u4")
        at, base, start, n = words.indices.to_numpy(), ends[0], 0, len(texts)
        while start < n:  # a slice of texts at a time bounds the index arrays
            last = int(np.searchsorted(ends, ends[start] + SLICE_WORDS)) - 1
            last = min(max(start + 1, last), n)
            part = at[ends[start] - base:ends[last] - base]
            lens = cnt[part]
            lens[ends[start:last] - ends[start]] = 0  # first parts stand without a space
            upto = np.concatenate([[0], np.cumsum(lens)])
            ids = flat[np.repeat(off[part] - upto[:-1], lens) + np.arange(upto[-1])]
            cuts = upto[ends[start:last + 1] - ends[start]]
            for k in range(last - start):
                yield np.concatenate([np.frombuffer(heads[start + k], "<u4"),
                                      ids[cuts[k]:cuts[k + 1]]])
            start = last

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of the ids."""
        ids = ids.astype(np.int64)
        lens = self.token_len[ids]
        upto = np.cumsum(lens)
        if not len(ids):
            return b""
        at = np.repeat(self.token_off[ids] - (upto - lens), lens) + np.arange(upto[-1])
        return self.token_flat[at].tobytes()


@functools.lru_cache(maxsize=4)
def encoder(path: str, pattern: str) -> RankEncoder:
    """The worker's encoder for a rank file."""
    return RankEncoder(path, pattern)


def _encoded(path: str, pattern: str, digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, pattern)
        names = ["doc_id", "n_tokens", *(("ids_sha256", "decoded_sha256") if digest else
                                         ("ids", "decoded"))]
        for batch in batches:
            count, first, second = [], [], []
            for ids in own.encode(batch.column("text")):
                raw, text = ids.astype("<u4").tobytes(), own.decode(ids)
                count.append(len(ids))
                first.append(hashlib.sha256(raw).hexdigest() if digest else raw)
                second.append(hashlib.sha256(text).hexdigest() if digest else text)
            kind = pa.string() if digest else pa.binary()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(count, pa.int64()), pa.array(first, kind),
                 pa.array(second, kind)], names=names)
    return run


def encode_documents(docs: DataFrame, path: str | None = None, pattern: str | None = None,
                     digest: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian uint32 bytes), decoded bytes of every text.

    With ``digest`` the two byte columns are replaced by their SHA-256, taken
    where they are made.
    """
    pair = ("ids_sha256 string, decoded_sha256 string" if digest else "ids binary, decoded binary")
    return id_text(docs).mapInArrow(
        _encoded(path or default_path(), pattern or default_pattern(), digest),
        f"doc_id bigint, n_tokens bigint, {pair}")
