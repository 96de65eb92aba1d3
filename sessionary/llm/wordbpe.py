"""Token ids of a ``tokenizers`` file for many whole texts.

The tokenizer is used as loaded: its special tokens, quoted in a text, are these
tokens (none holds white space).  Its rules (white space dropped, pieces cut at
every change between letters and other signs) never look across ASCII white
space, so a text is cut there and every different chunk of an Arrow batch goes
through the library once; the ids of a text are then gathered with numpy.  A
Python worker keeps the pieces of its last slice of texts for the next one.
``tests/llm/test_tokens.py`` compares the ids with the library's on whole texts.
"""

from __future__ import annotations

import functools
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts whose words are looked up together.
SLICE_TEXTS = 4_000
#: Words whose ids are gathered at once (or one text, if that has more).
SLICE_WORDS = 200_000

#: Signs that may end a chunk of letters: letters and signs are separate pieces.
_SIGNS = ".,!?;:|#$%&*"
#: The letters among the first 256 code points.
_LETTERS = "".join(c for c in map(chr, range(256)) if c.isalpha())


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def _byte_letters() -> dict[int, str]:
    """The printable stand-ins that byte-level pieces use for the 256 bytes."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {b: chr(b) for b in printable}
    out.update({b: chr(256 + n) for n, b in enumerate(b for b in range(256) if b not in out)})
    return out


class WordEncoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.bpe = self.tok.model.tokenize
        self.letters = _byte_letters()
        self.pieces: dict[str, bytes] = {}

    def _piece(self, piece: str) -> bytes:
        """Ids of a lower-case Latin-1 letter piece, or of any other chunk, as
        little-endian unsigned 32-bit integers."""
        if piece.isalpha() and (piece.isascii() or max(piece) <= "\xff"):
            return self._bpe_ids(piece)
        if not piece:
            return b""
        # digits, quotes, other alphabets, other white space, ...
        return array("I", self.tok.encode(piece, add_special_tokens=False).ids).tobytes()

    def _bpe_ids(self, piece: str) -> bytes:
        if not piece.isascii():
            piece = piece.encode("utf-8").decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.bpe(piece)]).tobytes() if piece else b""

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Ids (uint32) of each whole text in turn; null and empty texts have none."""
        for at in range(0, len(texts), SLICE_TEXTS):  # bounds the memory, not the texts
            yield from self._encode(texts.slice(at, SLICE_TEXTS))

    def _encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        split = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
        ends = split.offsets.to_numpy()
        words = split.flatten().dictionary_encode()
        # letters and the signs after them are separate pieces; other chunks stay whole
        chunks = words.dictionary
        stems = pc.utf8_rtrim(chunks, _SIGNS)
        plain = pc.and_(pc.utf8_is_alpha(stems),
                        pc.invert(pc.match_substring_regex(stems, r"[^\x00-\x{ff}]")))
        first = pc.if_else(plain, pc.utf8_lower(stems), chunks).dictionary_encode()
        after = pc.if_else(plain, pc.utf8_ltrim(chunks, _LETTERS), "").dictionary_encode()
        pieces, known = first.dictionary.to_pylist(), self.pieces.get
        blobs = [known(x) or self._piece(x) for x in pieces]
        self.pieces = dict(zip(pieces, blobs))
        del pieces
        signs_from = len(blobs)
        blobs += [self._bpe_ids(x) for x in after.dictionary.to_pylist()]
        cnt = np.fromiter(map(len, blobs), np.int64, len(blobs)) // 4
        off = np.cumsum(cnt) - cnt
        flat = np.frombuffer(b"".join(blobs), "<u4")
        del blobs
        first_of, after_of = first.indices.to_numpy(), after.indices.to_numpy() + signs_from
        at, base, start, n = words.indices.to_numpy(), ends[0], 0, len(texts)
        while start < n:  # a slice of texts at a time bounds the index arrays
            last = int(np.searchsorted(ends, ends[start] + SLICE_WORDS)) - 1
            last = min(max(start + 1, last), n)
            part = at[ends[start] - base:ends[last] - base]
            own = np.empty(2 * len(part), np.int64)
            own[0::2], own[1::2] = first_of[part], after_of[part]
            lens = cnt[own]
            upto = np.concatenate([[0], np.cumsum(lens)])
            ids = flat[np.repeat(off[own] - upto[:-1], lens) + np.arange(upto[-1])]
            cuts = upto[2 * (ends[start:last + 1] - ends[start])]
            for k in range(last - start):
                yield ids[cuts[k]:cuts[k + 1]]
            start = last


@functools.lru_cache(maxsize=4)
def encoder(path: str) -> WordEncoder:
    """The worker's encoder for a tokenizer file."""
    import os
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return WordEncoder(path)
