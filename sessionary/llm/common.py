"""Helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionary.sources.tables import read_table

#: Fixed value: the white space that separates words ([\x20\x09-\x0D]).
ASCII_SPACE = " \t\n\r\x0b\x0c"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id bigint, text string) of ``docs``; a null text counts as empty.

    Other columns are dropped here, so extra columns with clashing names never
    meet the operators' own columns.
    """
    return docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
                       F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))


def ascii_lower(col):
    """A-Z lower-cased, every other character as it is."""
    return F.translate(col, _UPPER, _LOWER)


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
