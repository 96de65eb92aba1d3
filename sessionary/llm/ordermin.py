"""Order MinHash fingerprints of documents (operator 7).

A text is its sequence of words; a word of more than ``LONG`` characters counts
as the overlapping runs of ``GRAM`` characters that begin at each of its
characters, so texts without spaces and long tokens are compared by characters.
Every run of ``width`` such words is a k-mer (the last ones are filled up with
the end).  Equal k-mers are numbered by their
occurrence, so repeats count.  The numbered k-mers are dealt into ``tuples``
classes by hash; in each class the ``picked`` ones with the least hashes are
selected, put back into text order and hashed together.  The tuple hashes are
the signature: a tuple survives an edit only if its k-mers and their order do,
so likeness (the share of equal tuples among those present in either) follows
edit distance, not just the set of words.  One ranking serves all tuples, which
costs two array sorts a text.

All of it is DataFrame expressions on arrays; a k-mer is one long (hash above,
place below), so sorting and comparing are on primitive arrays.  The number of
a k-mer's occurrence is its place in its run of the sorted array.

Each document meets the next one (by descending id, the last one meets the
first) through one shuffle: documents are dealt into ranges of ids cut at
approximate quantiles, a range also gets the first document of the range
below, and a window within the range reads the next row.  The cuts and the
ranges' largest ids, one number each per range, are all that reaches the driver.

Defined results: null or empty text: no k-mers, an empty signature, like
another empty one (1) and unlike the rest (0); equal texts have equal
fingerprints; null ids come last, repeated ids are ordered by text hash; the
only document meets itself; an empty table gives no rows; extra columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionary.llm.common import id_text, shuffle_parts

WIDTH = 2
TUPLES = 32
PICKED = 2
#: Words of more characters count as their runs of ``GRAM`` characters.
LONG, GRAM = 24, 5
#: Bits of a place in a text; the k-mer's hash has the bits above.
PLACE_BITS = 24
_PLACE = (1 << PLACE_BITS) - 1


def _let(value: Column, then) -> Column:
    """``then`` over ``value``, which is worked out once."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _high(value: Column) -> Column:
    return F.shiftright(value, PLACE_BITS)


def _packed(hash_: Column, place: Column) -> Column:
    return F.shiftleft(_high(hash_), PLACE_BITS).bitwiseOR(place.cast("bigint").bitwiseAND(
        F.lit(_PLACE)))


def _starts(sorted_: Column, group) -> Column:
    """Places (from 0) in a sorted array where a new group begins."""
    return F.filter(F.sequence(F.lit(0), F.size(sorted_) - 1), lambda i: (i == 0) | (
        group(F.get(sorted_, i)) != group(F.get(sorted_, i - 1))))


def kmers(words: Column, width: int = WIDTH) -> Column:
    """Sorted longs: hash of the k-mer above, place of its first word below."""
    def one(word: Column, at: Column) -> Column:
        parts = [word, *[F.coalesce(F.get(words, at + k), F.lit("")) for k in range(1, width)]]
        return _packed(F.xxhash64(*parts), at)
    return F.sort_array(F.transform(words, one))


def numbered(sorted_: Column) -> Column:
    """Sorted longs: hash of (k-mer, number of its occurrence) above, place below."""
    def run(starts: Column) -> Column:
        def own(start: Column, r: Column) -> Column:
            stop = F.coalesce(F.get(starts, r + 1), F.size(sorted_))
            return F.transform(F.sequence(start, stop - 1), lambda i: _packed(
                F.xxhash64(_high(F.get(sorted_, i)), i - start),
                F.get(sorted_, i).bitwiseAND(F.lit(_PLACE))))
        return F.sort_array(F.flatten(F.transform(starts, own)))
    return _let(_starts(sorted_, _high), run)


def selected(ranked: Column, tuples: int = TUPLES, picked: int = PICKED) -> Column:
    """The ``picked`` least of each class; the class is the top bits of the hash."""
    def cls(value: Column) -> Column:
        return F.shiftrightunsigned(value, 64 - (tuples - 1).bit_length())
    return F.filter(ranked, lambda value, i: (i < picked) | (
        cls(F.get(ranked, i - picked)) != cls(value)))


def words_of(text: Column) -> Column:
    """The words of a text, long ones as their overlapping runs of characters.

    The split serves texts without long words and gives the same as the pattern.
    """
    word = r"[^\x20\x09-\x0D]"
    whole = rf"(?<!{word}){word}{{1,{LONG}}}+(?!{word})"
    pattern = rf"(?=({whole}|{word}{{1,{GRAM}}}))(?:{whole}|{word})"
    return F.when(text.rlike(f"{word}{{{LONG + 1}}}"), F.regexp_extract_all(
        text, F.lit(pattern), F.lit(1))).otherwise(F.filter(
            F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != ""))


def signature(text: Column, width: int = WIDTH, tuples: int = TUPLES,
              picked: int = PICKED) -> Column:
    """``tuples`` hashes of a text, null for a class without k-mers."""
    if tuples & (tuples - 1):
        raise ValueError("tuples must be a power of two")
    shift = 64 - (tuples - 1).bit_length()
    words = _let(F.coalesce(text, F.lit("")), words_of)

    def hashed(own: Column) -> Column:
        """Tuple hash of a class: its k-mers' hashes in text order."""
        ordered = F.array_sort(F.transform(own, lambda v: F.struct(
            v.bitwiseAND(F.lit(_PLACE)).alias("place"), _high(v).alias("hash"))))
        return F.xxhash64(F.transform(ordered, lambda s: s["hash"]))

    def tuple_hashes(few: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(tuples - 1)), lambda c: _let(
            F.filter(few, lambda v: F.shiftrightunsigned(v, shift) == c),
            lambda own: F.when(F.size(own) > 0, hashed(own))))
    none = F.array_repeat(F.lit(None).cast("bigint"), tuples)
    return _let(words, lambda w: F.when(F.size(w) > 0, _let(kmers(w, width), lambda s: _let(
        numbered(s), lambda ranked: _let(selected(ranked, tuples, picked), tuple_hashes))))
        .otherwise(none))


def likeness(a: Column, b: Column, picked: int = PICKED) -> Column:
    """Share of equal tuples among those present in either signature; 1 if none is.

    A tuple needs all of its ``picked`` k-mers to survive, so the share's root
    of that degree estimates the share of the text that is alike.
    """
    pairs = F.arrays_zip(a.alias("a"), b.alias("b"))
    present = F.filter(pairs, lambda p: p["a"].isNotNull() | p["b"].isNotNull())
    same = F.filter(pairs, lambda p: p["a"] == p["b"])
    return F.when(F.size(present) == 0, 1.0).otherwise(
        F.pow(F.size(same) / F.size(present), F.lit(1.0 / picked)))


def text_form(sig: Column) -> Column:
    """A signature as a string: 8 hex digits a tuple, ``-`` where a class is empty."""
    return F.array_join(F.transform(sig, lambda v: F.coalesce(
        F.substring(F.lower(F.lpad(F.hex(v), 16, "0")), 9, 8), F.lit("-"))), ".")


def with_next(docs: DataFrame, value_cols: list[str]) -> DataFrame:
    """``docs`` (doc_id, text, ...) with ``next_<col>`` of the next document.

    Order: descending doc_id, ties by the text's hash, null ids last; after the
    last document comes the first.
    """
    spark = docs.sparkSession
    parts = shuffle_parts(spark)
    least = -(1 << 63)
    key = F.coalesce("doc_id", F.lit(least))
    probes = [k / parts for k in range(1, parts)] or [0.5]
    cuts = docs.select(F.percentile_approx(key, probes, 10_000).alias("c")).first()["c"] or []
    cuts = sorted(set(cuts))
    rank = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]).cast("array<bigint>"),
                           lambda c: c < key)) if cuts else F.lit(0)
    heads = {row["range"]: row["head"] for row in docs.select(key.alias("k"), rank.alias("range"))
             .groupBy("range").agg(F.max("k").alias("head")).collect()}
    order = sorted(heads)  # ranges that hold rows; the next of a range is the one below it
    above = {low: high for low, high in zip(order, order[1:])}
    if order:
        above[order[-1]] = order[0]  # the first document of all comes after the last one
    row = docs.withColumn("_range", rank).withColumn("_key", key)
    if order:
        head = F.element_at(F.create_map(*[F.lit(x) for r in order for x in (r, heads[r])]),
                            F.col("_range"))
        goes = F.element_at(F.create_map(*[F.lit(x) for r in order for x in (r, above[r])]),
                            F.col("_range"))
        row = row.withColumn("_in", F.when(F.col("_key") == head, F.array(
            F.struct(F.col("_range").alias("r"), F.lit(0).alias("guest")),
            F.struct(goes.alias("r"), F.lit(1).alias("guest"))))
            .otherwise(F.array(F.struct(F.col("_range").alias("r"), F.lit(0).alias("guest")))))
    else:
        row = row.withColumn("_in", F.array(F.struct(F.col("_range").alias("r"),
                                                     F.lit(0).alias("guest"))))
    row = row.withColumn("_in", F.explode("_in")).select("*", "_in.r", "_in.guest")
    own = Window.partitionBy("r").orderBy(F.col("guest"), F.col("_key").desc(), F.xxhash64("text"))
    return (row.select("*", *[F.lead(c).over(own).alias(f"next_{c}") for c in value_cols])
            .where("guest = 0").drop("_in", "_range", "_key", "r", "guest"))


def edited(text: Column, other: Column) -> Column:
    """``text`` with its last floor(n / 2) characters replaced by the first of ``other``."""
    n = F.char_length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - half), F.substring(other, F.lit(1), half))


def fingerprints(docs: DataFrame, width: int = WIDTH, tuples: int = TUPLES,
                 picked: int = PICKED) -> DataFrame:
    """doc_id, text, signature of every document."""
    return id_text(docs).withColumn("signature", signature(F.col("text"), width, tuples, picked))


def compare_edits(docs: DataFrame) -> DataFrame:
    """Each document with its edited text and next document, and their likeness."""
    rows = with_next(fingerprints(docs), ["text", "signature"])
    rows = rows.select("doc_id", F.char_length("text").cast("bigint").alias("n_chars"), "signature",
                       "next_signature", edited(F.col("text"), F.col("next_text")).alias("edited"))
    rows = rows.withColumn("edited_signature", signature(F.col("edited")))
    return rows.select(
        "doc_id", "n_chars", F.sha2(F.col("edited"), 256).alias("edited_sha256"),
        text_form(F.col("signature")).alias("fingerprint"),
        text_form(F.col("edited_signature")).alias("edited_fingerprint"),
        likeness(F.col("signature"), F.col("edited_signature")).alias("near_edited"),
        likeness(F.col("signature"), F.col("next_signature")).alias("near_next"))
