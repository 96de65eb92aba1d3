"""URL rules with redirect equivalence (operator 8)."""
import duckdb
import pytest

from sessionary.llm import urlrules
from sessionary.llm.queries import ORACLE, QUERIES
from tests.conftest import SF_CHECK

CANON = '<html><head><link rel="canonical" href="{}"></head></html>'
MOVED = "<meta http-equiv=refresh content='0; url={}'>"
ROWS = [
    (1, "https://shop.example.com/en/a", ""),  # blocked by its rule
    (2, "https://a.example.org/x", CANON.format("https://shop.example.com/en/a")),
    (3, "https://b.example.org/y/z", MOVED.format("../x")),
    (4, "https://c.example.org/q", CANON.format("//a.example.org/x#part")),
    (5, "https://www.example.com/en/k", CANON.format("https://a.example.org/x")),  # allowed by rule
    (6, "https://d.example.org/", CANON.format("/other?a=1&amp;b=2")),
    (7, "https://d.example.org/other?a=1&b=2", MOVED.format("http://m.example.net/es/1")),
    (8, "https://d.example.org/other?a=1&b=2", None),
    (9, "https://alone.example.org", "<p>text</p>"), (10, None, CANON.format("https://x.org/")),
    (11, "no scheme", ""), (12, "HTTP://WWW.Example.COM?x", None), (13, "http://com/", ""),
    (14, "http://notexample.com/en/", ""), (15, "http://x.net/es", ""), (16, "http://net/fr/", ""),
    (17, "https://c.example.org/q#top", ""), (17, "https://c.example.org/q#top", ""),
    (18, "https://e.example.org/1", CANON.format("https://e.example.org/2")),
]
SCHEMA = "page_id long, url string, html string"


@pytest.fixture
def judged(spark):
    from pyspark.sql import functions as F
    frame = spark.createDataFrame(ROWS, SCHEMA).select("*", *[
        F.lit("x").alias(n) for n in ("host", "path", "rule", "verdict", "node", "component", "own")])
    return urlrules.judge(frame).select("page_id", "host", "path", "rule", "verdict").collect()


def test_aliases_share_a_block_and_rules_come_first(judged):
    verdict = {r["page_id"]: (r["rule"], r["verdict"]) for r in judged}
    assert verdict[1] == ("example.com/en/", "block")
    assert verdict[2] == verdict[4] == verdict[17] == (None, "block")
    assert verdict[5] == ("www.example.com/en/", "allow")
    assert verdict[6] == verdict[7] == verdict[8] == (None, "block")
    assert verdict[9] == verdict[10] == verdict[11] == verdict[18] == (None, "allow")
    assert verdict[12] == (None, "allow") and verdict[13] == ("com/", "allow")
    assert verdict[14] == ("com/", "allow") and verdict[15] == (None, "allow")
    assert verdict[16] == ("net/fr/", "block")
    parts = {r["page_id"]: (r["host"], r["path"]) for r in judged}
    assert parts[12] == ("www.example.com", "") and parts[10] == parts[11] == ("", "")
    assert len(judged) == len(ROWS)


def test_the_oracle_agrees(judged):
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", ROWS)
    expected = con.sql(ORACLE["op8_url_filter"]).fetchall()
    assert sorted(map(str, expected)) == sorted(str(tuple(r)) for r in judged)


def test_op8_on_the_table(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SF_CHECK}/pages.parquet'")
    expected = con.sql(ORACLE["op8_url_filter"]).fetchall()
    got = QUERIES["op8_url_filter"](spark, SF_CHECK).collect()
    assert sorted(map(str, expected)) == sorted(str(tuple(r)) for r in got)


def test_links_are_resolved(spark):
    rows = [("https://a.org/x/y?z#f", "q", "https://a.org/x/q"), ("https://a.org", "q", "https://a.org/q"),
            ("https://a.org/x", "/q", "https://a.org/q"), ("https://a.org/x", "//b.org/", "https://b.org/"),
            ("https://a.org/x", "http://c.org", "http://c.org")]
    from pyspark.sql import functions as F
    frame = spark.createDataFrame(rows, "base string, link string, whole string")
    got = frame.select(urlrules.resolved(F.col("link"), F.col("base")).alias("x"), "whole").collect()
    assert all(r["x"] == r["whole"] for r in got)


def test_nodes_of_links_by_the_usual_rules(spark):
    from urllib.parse import urljoin, urlsplit

    from pyspark.sql import functions as F
    bases = ["https://a.net/en/p", "https://a.net/en/p?q=/../1#f", "https://a.net/", "https://a.net/x/../y/."]
    links = ["../es/x", "./x", "..", ".", "../../../x", "a/./b/../c/", "?k=1/../2", "#part", "/a/../b",
             "//b.org/./c", "https://b.org/c/../d?e/../f", "x..y/.z", "HTTPS://B.org/C"]
    frame = spark.createDataFrame([(b, k) for b in bases for k in links], "base string, link string")
    for r in frame.select("*", urlrules.node(urlrules.resolved(F.col("link"), F.col("base"))).alias("x")).collect():
        whole = urlsplit(urljoin(r["base"], r["link"]))
        expected = urljoin(whole.geturl(), whole.path) + ("?" + whole.query if whole.query else "")
        assert r["x"] == expected.replace("//B.org", "//b.org"), r


def test_links_of_every_form_pass_on_a_block(spark):
    rows = [(1, "https://a.net/en/p", CANON.format("../es/x")),
            (2, "HTTPS://A.net/q", CANON.format("/es/y")), (3, "https://a.net/q", ""),
            (4, "https://b.net/r", '<link rel="nofollow canonical" href="/fr/z">'),
            (5, "https://c.net/s/t?u", MOVED.format("?v=1")),
            (6, "https://c.net/s/t?v=1", MOVED.format("../es/")),
            (7, "https://d.net/en/p", CANON.format("../it/x"))]
    judged = urlrules.judge(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r["page_id"]: r["verdict"] for r in judged} == {
        **dict.fromkeys(range(1, 7), "block"), 7: "allow"}


def test_no_pages(spark):
    assert urlrules.judge(spark.createDataFrame([], SCHEMA)).count() == 0


def test_too_many_rules():
    from pyspark.sql import functions as F
    with pytest.raises(ValueError):
        urlrules.longest_rule(F.lit(""), F.lit(""), [("block", f"h{k}", "/") for k in range(1001)])
