"""License scans: exact set-similarity join of text blocks with templates (operator 1).

A text's blocks are its runs of w words, one from every word on; w is
``BLOCK_WORDS``, or twice the length of a longer template.  A block meets a
template when it holds at least ``threshold`` of the template's different
words (containment).  The join is exact and filters in the usual order:

* words are ordered by their frequency in the whole corpus, rarest first; the
  counts come from one pass that returns a row per template word;
* prefix: a template whose m words need an overlap of a meets only blocks with
  one of its first m - a + 1 words, so only blocks around such words are made;
* length: the block must have at least a words of the templates' vocabulary;
* position: when the first common word stands at i of m and j of n, no more
  than 1 + min(m - i - 1, n - j - 1) words can be common.

A block that does not begin with a word of the templates holds no more of them
than the one that begins with the next such word, so only these are looked at;
sliding from one to the next updates the counts of the block's words.

Templates are a parameter of at most ``MAX_TEMPLATE_WORDS`` words in all
(checked), so their index goes to every task and the second pass is a map.
Phrases are templates that a block has to hold whole; an exact check then
finds the places where their words stand one after the other.

Defined results: null or empty text: no words, no labels, score 0; repeated
rows: one result each; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionary.llm.common import id_text

BLOCK_WORDS = 32
THRESHOLD = 0.8
MAX_TEMPLATE_WORDS = 100_000

#: Phrases (words, label): counted wherever their words stand consecutively.
PHRASES = (
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
)

#: Notices and license texts (text, label).
TEMPLATES = (
    ("Released under the MIT License", "mit-notice"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy",
     "mit-notice"),
    ("Licensed under the Apache License, Version 2.0", "apache-2.0"),
    ("This work is licensed under the GNU General Public License, version 3", "gpl-3.0"),
    ("you can redistribute it under the terms of the GNU General Public License",
     "gpl-notice"),
    ("under the terms of the GNU Lesser General Public License", "lgpl-notice"),
    ("subject to the terms of the Mozilla Public License, version 2.0", "mpl-2.0"),
    ("Redistribution and use in source and binary forms, with or without modification, "
     "are permitted", "bsd-notice"),
    ("Licensed under CC BY-NC 4.0", "cc-by-nc-4.0"),
    ("Licensed under a Creative Commons Attribution 4.0 International License", "cc-by-4.0"),
    ("All rights reserved", "all-rights-reserved"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this "
     "software and associated documentation files (the \"Software\"), to deal in the Software "
     "without restriction, including without limitation the rights to use, copy, modify, merge, "
     "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
     "to whom the Software is furnished to do so, subject to the following conditions: The above "
     "copyright notice and this permission notice shall be included in all copies or substantial "
     "portions of the Software.", "mit-text"),
    ("Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
     "except in compliance with the License. You may obtain a copy of the License at "
     "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
     "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
     "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
     "specific language governing permissions and limitations under the License.", "apache-header"),
)

#: A-Z become a-z; ASCII signs that are neither letters nor digits separate words.
_WORDS = bytes(b + 32 if 0x41 <= b <= 0x5A else
               b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
               for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words as UTF-8 bytes (every non-ASCII character is a word character)."""
    return (text or "").encode("utf-8").translate(_WORDS).split()


class TemplateIndex:
    """Templates and phrases as sets in the corpus order, with their prefixes by block width."""

    def __init__(self, phrases: Sequence, templates: Sequence, threshold: float,
                 block_words: int):
        if not 0 < threshold <= 1:
            raise ValueError("the threshold must lie in (0, 1]")
        self.entries = [(words_of(p), label, 1.0, True) for p, label in phrases]
        self.entries += [(words_of(t), label, threshold, False) for t, label in templates]
        for words, label, _, _ in self.entries:
            if not words:
                raise ValueError(f"template {label!r} has no words")
        if sum(len(words) for words, *_ in self.entries) > MAX_TEMPLATE_WORDS:
            raise ValueError(f"the templates have over {MAX_TEMPLATE_WORDS} words")
        self.width = [max(block_words, 2 * len(words)) for words, *_ in self.entries]
        self.vocabulary = {w for words, *_ in self.entries for w in words}
        self.order({})

    def order(self, frequency: dict[bytes, int]) -> "TemplateIndex":
        """Order all words by corpus frequency, rarest first, and index the prefixes."""
        ranked = sorted(self.vocabulary, key=lambda w: (frequency.get(w, 0), w))
        self.rank = {w: n for n, w in enumerate(ranked)}
        self.sorted, self.need = [], []
        #: block width -> rank -> (entry, place in the entry's order)
        self.prefix: dict[int, dict[int, list]] = {}
        for k, (words, _, threshold, _) in enumerate(self.entries):
            own = sorted({self.rank[w] for w in words})
            need = max(1, math.ceil(threshold * len(own) - 1e-9))
            self.sorted.append(own)
            self.need.append(need)
            prefix = self.prefix.setdefault(self.width[k], {})
            for i, r in enumerate(own[:len(own) - need + 1]):
                prefix.setdefault(r, []).append((k, i))
        return self

    def meets(self, block: list[int], prefix: dict[int, list]) -> Iterator[tuple[int, float]]:
        """(entry, containment) of the entries that a block's sorted ranks meet."""
        seen, n, own = set(), len(block), None
        for j, r in enumerate(block):
            for k, i in prefix.get(r, ()):
                if k in seen:
                    continue
                seen.add(k)
                need, m = self.need[k], len(self.sorted[k])
                if n < need or 1 + min(m - i - 1, n - j - 1) < need:
                    continue  # length and positional filters
                own = own or set(block)
                common = sum(x in own for x in self.sorted[k])
                if common >= need:
                    yield k, common / m

    def scan(self, words: list[bytes]) -> list[tuple]:
        """(label, is a phrase, block start, containment, places) of every match.

        Neighbouring blocks that meet a template are one match: the first of the
        best ones.  A phrase's places are in one match.
        """
        known = [(n, self.rank[w]) for n, w in enumerate(words) if w in self.rank]
        places: dict[int, list[int]] = {}
        found: list[tuple] = []
        for width, prefix in self.prefix.items():
            last: dict[int, tuple[int, int]] = {}  # entry -> (its open match, the last block's turn)
            for turn, start, block in _blocks(known, prefix, width):
                for k, share in self.meets(block, prefix):
                    phrase, label, _, exact = self.entries[k]
                    if exact:
                        if words[start:start + len(phrase)] == phrase:
                            places.setdefault(k, []).append(start)
                        continue
                    at, before = last.get(k, (-1, -2))
                    if before != turn - 1:
                        at = len(found)
                        found.append((label, False, start, share, []))
                    elif share > found[at][3]:
                        found[at] = (label, False, start, share, [])
                    last[k] = at, turn
        return [(self.entries[k][1], True, own[0], 1.0, own) for k, own in sorted(places.items())] + found


def _blocks(known: list[tuple[int, int]], prefix: dict[int, list], width: int
            ) -> Iterator[tuple[int, int, list[int]]]:
    """(turn, start, sorted different ranks) of the blocks of ``width`` words that
    begin with a known word and hold a word of a prefix; neighbours have
    neighbouring turns.  ``known``: (place, rank) of the templates' words."""
    held: Counter = Counter()
    rare, end = 0, 0
    for turn, (start, first) in enumerate(known):
        while end < len(known) and known[end][0] < start + width:
            held[known[end][1]] += 1
            rare += known[end][1] in prefix
            end += 1
        if rare:
            yield turn, start, sorted(held)
        held[first] -= 1
        if not held[first]:
            del held[first]
        rare -= first in prefix


def _count(vocabulary: set[bytes]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        times: Counter = Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                times.update(w for w in words_of(text) if w in vocabulary)
        yield pa.RecordBatch.from_arrays(
            [pa.array([w.decode("utf-8") for w in times], pa.string()),
             pa.array(list(times.values()), pa.int64())], names=["word", "n"])
    return run


def frequencies(docs: DataFrame, vocabulary: set[bytes]) -> dict[bytes, int]:
    """Occurrences of the templates' words in all texts (one row per word reaches the driver)."""
    counts = (id_text(docs).select("text").mapInArrow(_count(vocabulary), "word string, n bigint")
              .groupBy("word").agg(F.sum("n").alias("n")))
    return {row["word"].encode("utf-8"): row["n"] for row in counts.collect()}


_FOUND = pa.list_(pa.struct([("label", pa.string()), ("phrase", pa.bool_()),
                             ("block_start", pa.int64()), ("containment", pa.float64()),
                             ("places", pa.list_(pa.int64()))]))


def _scan(index: TemplateIndex):
    names = [field.name for field in _FOUND.value_type]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count, found = [], []
            for text in batch.column("text").to_pylist():
                words = words_of(text)
                count.append(len(words))
                found.append([dict(zip(names, match)) for match in index.scan(words)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(count, pa.int64()), pa.array(found, _FOUND)],
                names=["doc_id", "n_words", "matches"])
    return run


def scan(docs: DataFrame, phrases: Sequence = PHRASES, templates: Sequence = TEMPLATES,
         threshold: float = THRESHOLD, block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, n_words, matches of every document.

    A match is (label, phrase, block_start, containment, places): the block that
    meets a template, or holds a phrase, with the phrase's starting words.
    """
    index = TemplateIndex(phrases, templates, threshold, block_words)
    index.order(frequencies(docs, index.vocabulary))
    return id_text(docs).mapInArrow(_scan(index), (
        "doc_id bigint, n_words bigint, matches array<struct<label: string, phrase: boolean, "
        "block_start: bigint, containment: double, places: array<bigint>>>"))


def summary(scanned: DataFrame) -> DataFrame:
    """One row of labels, places and score per document of ``scan``."""
    places = F.flatten("matches.places")
    labels = lambda m: F.array_join(F.array_sort(F.array_distinct(m)), ",")
    base = F.filter("matches", lambda m: m["phrase"])
    return scanned.select(
        "doc_id", "n_words", F.size(places).cast("bigint").alias("n_base"),
        F.array_min(places).alias("first_word"), F.array_max(places).alias("last_word"),
        labels(base["label"]).alias("base_labels"), labels(F.col("matches.label")).alias("labels"),
        F.coalesce(F.array_max("matches.containment"), F.lit(0.0)).alias("score"))
