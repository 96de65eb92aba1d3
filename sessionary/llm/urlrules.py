"""URL rules with redirect equivalence (operator 8).

A page's url gets the verdict of the longest rule that fits its host and path.
Urls without a rule are judged with their aliases: redirects (meta refresh) and
canonical links found in the pages are edges between urls, distributed
connected components make each set of aliases, and a set with a blocked member
is blocked, except for members that a rule allows.

Everything is a DataFrame expression or join.  Rules are a parameter of at most
``MAX_RULES`` (checked) and become one expression; only urls on an edge enter
the components, and pages without an edge take no part in them.

Defined results: null url or no ``://``: empty host and path, no rule; null or
empty html: no edges; an alias that is no page of its own still passes on its
rule's verdict; repeated rows get equal verdicts; an empty table gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionary.llm.common import ascii_lower
from sessionary.operators.graph import connected_components
from sessionary.session import materialize

MAX_RULES = 1000

#: (verdict, host, path): a rule fits the host and all of its subdomains.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_CANONICAL = (r"(?is)<link\b[^>]*\brel\s*=\s*(?:[\"']?|\"[^\">]*\s|'[^'>]*\s)"
              r"canonical\b[^>]*>")
_REFRESH = r"(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>"
_HREF = r"(?is)\bhref\s*=\s*[\"']?([^\"'\s>]+)"
_TARGET = r"(?is)\burl\s*=\s*[\"']?([^\"'\s>]+)"


def host(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), URL, 1))


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), URL, 2)


def longest_rule(host: Column, path: Column, rules: Sequence = RULES) -> Column:
    """Struct (rule, verdict) of the longest fitting rule; null if none fits."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"over {MAX_RULES} rules")
    best = [F.when(((host == F.lit(h)) | host.endswith(f".{h}")) & path.startswith(p),
                   F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict")))
            for verdict, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), -len(r[1]), r))]
    return F.coalesce(*best, F.lit(None).cast("struct<rule: string, verdict: string>"))


def without_dots(path: Column) -> Column:
    """A path from the root without its ``.`` and ``..`` segments."""
    parts = F.split(path, "/", -1)
    kept = F.aggregate(
        F.slice(parts, F.lit(2), F.size(parts)), F.array().cast("array<string>"),
        lambda acc, part: F.when(part == "..", F.slice(acc, F.lit(1), F.greatest(
            F.size(acc) - 1, F.lit(0)))).when(part == ".", acc).otherwise(F.concat(acc, F.array(part))))
    ended = F.when(path.rlike(r"/\.\.?\z"), F.concat(kept, F.array(F.lit("")))).otherwise(kept)
    return F.when(path.rlike(r"/\.\.?(?:/|\z)"), F.concat(F.lit("/"), F.array_join(ended, "/"))).otherwise(path)


def node(url: Column) -> Column:
    """What aliases are compared by: a url without its fragment and dot segments,
    scheme and host in lower case."""
    whole = F.regexp_replace(url, r"(?s)#.*", "")
    site = F.regexp_extract(whole, r"(?s)^([^/?]*://[^/?]*)", 1)
    return F.when(site == "", whole).otherwise(F.concat(
        ascii_lower(site), without_dots(F.regexp_extract(whole, r"(?s)^[^/?]*://[^/?]*([^?]*)", 1)),
        F.regexp_extract(whole, r"(?s)^[^?]*(\?.*)", 1)))


def resolved(link: Column, base: Column) -> Column:
    """A link of a page as a whole url (``node`` takes the dot segments out)."""
    scheme = F.regexp_extract(base, r"(?s)^(.*?):", 1)
    site = F.regexp_extract(base, r"(?s)^(.*?://[^/?#]*)", 1)
    folder = F.regexp_extract(base, r"(?s)^(.*?://[^/?#]*(?:[^?#]*/)?)", 1)
    return (F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), link)
            .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
            .when(link.startswith("/"), F.concat(site, link))
            .when(link.startswith("?"), F.concat(F.regexp_extract(base, r"(?s)^([^?#]*)", 1), link))
            .when(link.startswith("#"), F.concat(F.regexp_extract(base, r"(?s)^([^#]*)", 1), link))
            .otherwise(F.concat(folder, F.when(folder.endswith("/"), "").otherwise("/"), link)))


def alias_edges(pages: DataFrame) -> DataFrame:
    """(src, dst): a page's url and the whole url of its canonical link or redirect."""
    found = pages.where(F.col("url").contains("://")).select("url", F.concat(
        F.transform(F.regexp_extract_all("html", F.lit(_CANONICAL), F.lit(0)),
                    lambda tag: F.regexp_extract(tag, _HREF, 1)),
        F.transform(F.regexp_extract_all("html", F.lit(_REFRESH), F.lit(0)),
                    lambda tag: F.regexp_extract(tag, _TARGET, 1))).alias("links"))
    return (found.select("url", F.explode("links").alias("link")).where("link != ''")
            .select(node(F.col("url")).alias("src"),
                    node(resolved(F.regexp_replace("link", "&amp;", "&"), F.col("url"))).alias("dst"))
            .where("src != dst and dst like '%://%'"))


def judge(pages: DataFrame, rules: Sequence = RULES) -> DataFrame:
    """page_id, url, host, path, rule, verdict, component (its alias set, or null)."""
    pages = pages.select("page_id", F.col("url").cast("string").alias("url"), "html")
    aliases = materialize(connected_components(alias_edges(pages)))
    named = aliases.withColumn("verdict", longest_rule(
        host(F.col("node")), path(F.col("node")), rules)["verdict"])
    blocked = named.groupBy("component").agg(
        F.max(F.coalesce(F.col("verdict") == "block", F.lit(False))).alias("blocked"))
    sets = named.select("node", "component").join(blocked, "component")
    judged = pages.select("page_id", "url", host(F.col("url")).alias("host"),
                          path(F.col("url")).alias("path"), node(F.col("url")).alias("node"))
    judged = judged.withColumn("own", longest_rule(F.col("host"), F.col("path"), rules))
    return judged.join(sets, "node", "left").select(
        "page_id", "url", "host", "path", F.col("own.rule").alias("rule"),
        F.coalesce("own.verdict", F.when(F.col("blocked"), "block"), F.lit("allow"))
        .alias("verdict"), "component")
