"""Small document tables that every corpus operator must cope with."""
import duckdb

from tests.conftest import SF_SMALL

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

LONG = " ".join(f"word{k % 700} and text{k % 31}" for k in range(12_000))

EDGES = [
    (5, None), (6, ""), (7, "   \n\t "), (8, "one"), (9, "One two THREE"), (10, "a  b\n\n c "),
    (11, "ties are equal texts here and there"), (12, "ties are equal texts here and there"),
    (13, "ties are equal texts here and there"), (13, "ties are equal texts here and there"),
    (14, LONG), (15, "É́ 中文字 ﬁ x̧. 😀😀 <|endoftext|> I'm don't \x1cfoo\x85bar  　z"),
    (16, "line one\nline two\nline one\n\nline two\n" * 6), (None, "no id but some text in it"),
    (17, "aaaaaaaaaaaaaaaaaaaaaaaa " * 40), (18, "#$ * & | < > %"),
]


def table(spark, rows, **extra):
    """Rows (doc_id, text) as a documents table, with extra columns of clashing names."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(i, t, "en", "src0", len(t or "")) for i, t in rows], DOC_SCHEMA)
    names = ["fingerprint", "component_id", "component", "fp", "item", "label", "ids", "words",
             "kind", "score", "kept", "part", "length", "signature", "node", "bin"]
    return df.select("*", *[F.lit(n).alias(n) for n in names])


def small_documents():
    """(doc_id, text) of the smallest test table."""
    return duckdb.sql(f"SELECT doc_id, text FROM '{SF_SMALL}/documents.parquet' ORDER BY doc_id").fetchall()
