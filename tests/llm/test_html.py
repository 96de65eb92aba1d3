"""HTML main text (operator 3)."""
import html
import itertools
import random
import re

import duckdb
import numpy as np
import pytest

from sessionary.llm import htmltext
from sessionary.llm.queries import QUERIES
from tests.conftest import SF_CHECK

WEIGHTS = np.array(htmltext.DEFAULT_WEIGHTS)

PAGE = """<html><head><title>T</title><style>p{}</style></head><body class="home">
<header><h1>Site</h1><nav><a href=1>Home</a> <a>About us</a></nav></header>
<div class="cookie-notice">We use cookies. Accept them please, all of them.</div>
<div id="wrap"><div class="sidebar"><ul><li><a>One</a><li><a>Two</a></ul></div>
<div class="post-content"><h2>Title here</h2>
<p>First &eacute;&nbsp;paragraph   of the text, with <a href=x>a link</a>.<!-- <p>gone</p> --></p>
<p>Second one is long enough, too. It<br>has sentences.
<form><label>Mail</label><input></form><div class="ad">Buy now!</div>
<script>var x = "<p>no</p>";</script><p>Third &lt;b&gt; &am &amp it is.</div>
<div id="comments"><p>Nice article, thanks for it. I like it a lot.</p></div></div>
<footer>&copy; 2020</footer></body></html>"""


def test_a_page_with_every_kind_of_furniture():
    assert htmltext.main_text(PAGE, WEIGHTS).split("\n\n") == [
        "Title here", "First é paragraph of the text, with a link.",
        "Second one is long enough, too. It has sentences.", "Third <b> &am & it is."]


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("<p></p><div> \n</div>", ""), ("<article><p>Cut off he", "Cut off he"),
    ("<article><p>a<b>b</b> c<p>d</article><aside>x</aside>", "ab c\n\nd"),
    ("<main>loose text<p>and more</p>tail</main>", "loose text\n\nand more\n\ntail"),
    ("<<<<article><p>a < b</article", "a < b"),
    ("<article><p>kept</p><div hidden>no</div><aside><article>no</article></aside></article>", "kept"),
    ("<div class='page header'><article><p>inside all the same</p></article></div>",
     "inside all the same"),
])
def test_odd_pages(page, text):
    assert htmltext.main_text(page, WEIGHTS).replace("<<<", "").strip() == text


@pytest.mark.parametrize("page, text", [
    ('<article><p>one</p><svg class="i"/><p>two</p></article>', "one\n\ntwo"),
    ("<article><p>one</p><math/><p>two<svg class=i/>no</svg></p></article>", "one\n\ntwo"),
    ("<article><p>one<svg><path/>no</svg> <SVG />two</p></article>", "one two"),
    ('<article><p>one</p><svg-icon name="x"></svg-icon><p>two</p></article>', "one\n\ntwo"),
    ("<article><title-bar>one</title-bar><p>two<template-x></template-x></p></article>", "one\n\ntwo"),
    ('<article><p>one <img alt="x > y">two <b title=\'a <p> "b\'>three</b></p></article>',
     "one two three"),
    ('<article><p>one<script data-x="a > b">no</script> <i a="it\'s">two</i></p></article>', "one two"),
    ("<article><p>one <i a=it's>two</i> it's</p><p>three", "one two it's\n\nthree"),
    ('<article><p>one <b a="<i>" <i>two</i></p></article>', 'one <b a="" two'),
])
def test_elements_end_where_they_end(page, text):
    assert htmltext.main_text(page, WEIGHTS) == text


def test_long_broken_tags_are_read_in_linear_time():
    for part in ('="<a "', "<a ='", '<a b="c" <', "<svg/", "<svg =\"", "= "):
        for end in ("", "<", ">"):
            htmltext.main_text("<a " + part * 20_000 + end, WEIGHTS)


def test_long_broken_pages_are_read_in_linear_time():
    for part in ("<", "<a ", "<div>", "<p>x", "<!--", "<script>", "&", "</div>"):
        htmltext.main_text(part * 20_000, WEIGHTS)


def test_minimum_cut_against_every_labelling():
    rng = random.Random(1)
    for _ in range(300):
        n = rng.randint(1, 8)
        odds = [rng.choice([0.0, rng.uniform(-2, 2)]) for _ in range(n)]
        edges = {(a, b): rng.uniform(0, 1.5) for a, b in itertools.combinations(range(n), 2)
                 if rng.random() < 0.5}

        def cost(label):
            return (sum(max(o, 0) * (not x) + max(-o, 0) * x for o, x in zip(odds, label))
                    + sum(c for (a, b), c in edges.items() if label[a] != label[b]))
        best = min(map(cost, itertools.product([False, True], repeat=n)))
        assert cost(htmltext.max_flow_side(odds, edges)) == pytest.approx(best)


def plain_article(page):
    """Blocks of the table's pages: their article's headings and paragraphs."""
    own = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split())
             for x in re.split(r"</?(?:p|h1)>", own)]
    return "\n\n".join(x for x in parts if x)


def test_op3_on_the_table(spark):
    rows = {r["page_id"]: r for r in QUERIES["op3_html_text"](spark, SF_CHECK).collect()}
    pages = duckdb.sql(f"SELECT page_id, url, html FROM '{SF_CHECK}/pages.parquet'").fetchall()
    assert len(rows) == len(pages)
    for page, url, source in pages:
        text = plain_article(source)
        assert (rows[page]["url"], rows[page]["text"], rows[page]["n_chars"]) == (url, text, len(text))


def test_edges(spark):
    rows = [(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (2, None, None, "x"), (None, "v", "", "x")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = [(r["page_id"], r["url"], len(r["text"]) > 0) for r in htmltext.extract(frame).collect()]
    assert sorted(got, key=str) == sorted([(1, "u", True), (1, "u", True), (2, None, False),
                                           (None, "v", False)], key=str)
    assert htmltext.extract(frame.limit(0)).count() == 0


ARTICLE = "<h1>Title of it</h1>" + "".join(
    f"<p>This is a long paragraph number {k} of the article, with a sentence. And another one.</p>"
    for k in range(4))
COMMENTS = ('<div id="comments"><ol><li class="comment"><article class="comment-body"><p>What a fine text '
            "this is, dear author. I liked it a lot.</p></article></li></ol></div>")


def test_names_around_and_of_an_article():
    """Comments and promotions in article elements go, wherever they stand."""
    weights = np.array(htmltext.DEFAULT_WEIGHTS)
    promo = '<article class="related promo"><p>Buy this now, it is the best. You will like it.</p></article>'
    for page in (f"<article>{ARTICLE}</article>{COMMENTS}", f"<article>{ARTICLE}{COMMENTS}</article>",
                 f"<main>{ARTICLE}</main>{promo}{COMMENTS}"):
        text = htmltext.main_text(f"<html><body>{page}</body></html>", weights)
        assert text.startswith("Title of it\n\nThis is") and text.count("long paragraph") == 4
        assert "fine text" not in text and "Buy" not in text


def test_elements_that_wrap_the_page():
    """A form or a page "with sidebar" around everything is no furniture; others are."""
    weights = np.array(htmltext.DEFAULT_WEIGHTS)
    side = '<div class="sidebar"><p>See also our other pages about this, dear reader. They are fine.</p></div>'
    for page in (f'<div class="layout has-sidebar">{ARTICLE}</div>', f"<form action=x>{ARTICLE}<input></form>",
                 f'<div class="page-with-sidebar"><article>{ARTICLE}</article>{side}</div>',
                 f"<form><div class='popup'><article>{ARTICLE}</article></div>{side}</form>"):
        text = htmltext.main_text(f"<body>{page}</body>", weights)
        assert text.startswith("Title of it\n\nThis is") and text.count("long paragraph") == 4
        assert "See also" not in text
    long_comments = COMMENTS.replace("I liked it a lot.", "I liked it a lot. " * 200)
    text = htmltext.main_text(f"<body><article>{ARTICLE}</article>{long_comments}</body>", weights)
    assert "fine text" not in text and text.count("long paragraph") == 4
