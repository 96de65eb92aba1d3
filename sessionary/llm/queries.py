"""The registered queries of the corpus operators: ``opN_<name>`` over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionary.llm.common import documents
from sessionary.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


@register("op9_token_ids")
def op9_token_ids(spark, sf_dir):
    from sessionary.llm import simple8b
    return simple8b.token_ids(documents(spark, sf_dir)).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@register("op10_best_fit_packing")
def op10_best_fit_packing(spark, sf_dir):
    from sessionary.llm import packing
    return packing.pack_documents(documents(spark, sf_dir))


@register("op4_quality_rules")
def op4_quality_rules(spark, sf_dir):
    from sessionary.llm import quality
    judged = quality.judge(documents(spark, sf_dir).select("doc_id", "text"),
                           read_table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "__rules.*")


@register("op6_simhash_dedup")
def op6_simhash_dedup(spark, sf_dir):
    from sessionary.llm import simhash
    return simhash.near_duplicates(documents(spark, sf_dir)).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@register("op5_byte_bpe")
def op5_byte_bpe(spark, sf_dir):
    from sessionary.llm import bytebpe
    return bytebpe.encode_documents(documents(spark, sf_dir), digest=True)


@register("op1_license_scan")
def op1_license_scan(spark, sf_dir):
    from sessionary.llm import licenses
    return licenses.summary(licenses.scan(documents(spark, sf_dir)))


@register("op8_url_filter")
def op8_url_filter(spark, sf_dir):
    from sessionary.llm import urlrules
    return urlrules.judge(read_table(spark, sf_dir, "pages")).select(
        "page_id", "host", "path", "rule", "verdict")


#: Aliases are followed from each edge by a recursive query, as the components do.
ORACLE["op8_url_filter"] = r"""
WITH RECURSIVE rules(verdict, h, p) AS (VALUES
    ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
    ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
found AS (
    SELECT url, regexp_extract(tag, '(?is)\bhref\s*=\s*["'']?([^"''\s>]+)', 1) AS link
    FROM (SELECT url, unnest(regexp_extract_all(html,
        '(?is)<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>')) AS tag FROM pages)
    UNION ALL
    SELECT url, regexp_extract(tag, '(?is)\burl\s*=\s*["'']?([^"''\s>]+)', 1) AS link
    FROM (SELECT url, unnest(regexp_extract_all(html,
        '(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*>')) AS tag FROM pages)),
links AS (
    SELECT url, replace(link, '&amp;', '&') AS link,
        regexp_extract(url, '(?s)^(.*?://[^/?#]*(?:[^?#]*/)?)', 1) AS folder
    FROM found WHERE link != '' AND contains(url, '://')),
edges AS (
    SELECT regexp_replace(url, '(?s)#.*', '') AS src, regexp_replace(CASE
        WHEN regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN link
        WHEN starts_with(link, '//') THEN regexp_extract(url, '(?s)^(.*?):', 1) || ':' || link
        WHEN starts_with(link, '/') THEN regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1) || link
        ELSE folder || CASE WHEN ends_with(folder, '/') THEN '' ELSE '/' END || link END,
        '(?s)#.*', '') AS dst
    FROM links),
both_ways AS (
    SELECT src, dst FROM edges WHERE src != dst AND contains(dst, '://')
    UNION SELECT dst, src FROM edges WHERE src != dst AND contains(dst, '://')),
reach(node, alias) AS (
    SELECT src, src FROM both_ways
    UNION SELECT r.node, b.dst FROM reach r JOIN both_ways b ON b.src = r.alias),
urls AS (SELECT url FROM pages UNION SELECT node FROM reach),
parts AS (
    SELECT url, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
    FROM urls),
ruled AS (
    SELECT url, host, path, arg_max(h || p, length(h || p)) AS rule,
        arg_max(verdict, length(h || p)) AS verdict
    FROM parts LEFT JOIN rules
        ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
    GROUP BY url, host, path),
blocked AS (
    SELECT DISTINCT node FROM reach JOIN ruled ON ruled.url = reach.alias WHERE verdict = 'block')
SELECT page_id, host, path, rule, coalesce(verdict,
    CASE WHEN regexp_replace(pages.url, '(?s)#.*', '') IN (SELECT node FROM blocked)
        THEN 'block' ELSE 'allow' END) AS verdict
FROM pages JOIN ruled ON ruled.url IS NOT DISTINCT FROM pages.url
"""


@register("op3_html_text")
def op3_html_text(spark, sf_dir):
    from sessionary.llm import htmltext
    return htmltext.extract(read_table(spark, sf_dir, "pages")).withColumn(
        "n_chars", F.char_length("text").cast("bigint"))


@register("op2_pii")
def op2_pii(spark, sf_dir):
    from sessionary.llm import pii
    return pii.digest(pii.detect(documents(spark, sf_dir).select("doc_id", "text")))


@register("op7_order_minhash")
def op7_order_minhash(spark, sf_dir):
    from sessionary.llm import ordermin
    return ordermin.compare_edits(documents(spark, sf_dir))


@register("op11_embedding_dedup")
def op11_embedding_dedup(spark, sf_dir):
    from sessionary.llm import embeddings
    return embeddings.near_duplicates(read_table(spark, sf_dir, "embeddings"))


ORACLE["op11_embedding_dedup"] = """
WITH RECURSIVE vectors AS (
    SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
    WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x != 0)) > 0),
links AS (
    SELECT a.vec_id AS src, b.vec_id AS dst FROM vectors a JOIN vectors b ON a.vec_id != b.vec_id
    WHERE len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.9),
reach(node, other) AS (
    SELECT src, dst FROM links
    UNION SELECT r.node, l.dst FROM reach r JOIN links l ON l.src = r.other),
tops AS (SELECT node, least(node, min(other)) AS top FROM reach GROUP BY node),
counts AS (SELECT src, count(*) AS n FROM links GROUP BY src)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(top, vec_id) AS component_id,
    vec_id = coalesce(top, vec_id) AS kept
FROM embeddings LEFT JOIN tops ON node = vec_id LEFT JOIN counts ON src = vec_id
"""


@register("op12_token_alignment")
def op12_token_alignment(spark, sf_dir):
    from sessionary.llm import tokenalign
    return tokenalign.align_documents(documents(spark, sf_dir))


@register("op13_conversation_trie")
def op13_conversation_trie(spark, sf_dir):
    from sessionary.llm import turntrie
    turns = turntrie.turn_lists(read_table(spark, sf_dir, "conversations"))
    return turntrie.trie(turntrie.shared_heads(turns))


#: crc32 bit by bit; nodes are lists of turns, and a subtree is what starts with its top's list.
ORACLE["op13_conversation_trie"] = r"""
WITH given AS (
    SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
            md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS k
    FROM conversations WHERE conv_id IS NOT NULL),
ids AS (
    SELECT c, c - c % 20 AS head, xor(list_reduce(list_transform(
        list_concat([4294967295], list_transform(string_split(c::VARCHAR, ''), lambda s: ascii(s))),
        lambda x: x::UBIGINT), lambda crc, byte: list_reduce(list_concat([xor(crc, byte)],
            [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]), lambda x, step: CASE WHEN x % 2 = 1
            THEN xor(x // 2, 3988292384::UBIGINT) ELSE x // 2 END)), 4294967295::UBIGINT) % 4 AS h
    FROM (SELECT DISTINCT c FROM given)),
rebuilt AS (
    SELECT ids.c, k, 0 AS own, role, text FROM ids JOIN given ON given.c = head AND k <= h
    UNION ALL SELECT c, k, 1, role, text FROM ids JOIN given USING (c) WHERE k > h),
paths AS (
    SELECT c, len(path) AS depth, path, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words
    FROM (SELECT c, text, list({'role': role, 'text': text}) OVER (
        PARTITION BY c ORDER BY own, k) AS path FROM rebuilt)
    UNION ALL SELECT c, 0, [], 0 FROM ids),
lengths AS (SELECT c, max(depth) AS ended FROM paths GROUP BY c),
nodes AS (
    SELECT depth, path, min(c) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
        string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (depth = ended) AS ends
    FROM paths JOIN lengths USING (c) GROUP BY depth, path),
children AS (
    SELECT list_slice(path, 1, depth - 1) AS path, count(*) AS n_children
    FROM nodes WHERE depth > 0 GROUP BY 1),
shaped AS (
    SELECT nodes.*, coalesce(n_children, 0) AS n_children
    FROM nodes LEFT JOIN children ON nodes.path = children.path AND nodes.depth >= 0),
subtrees AS (
    SELECT top.path, count(*) FILTER (below.n_children = 0) AS n_leaves,
        sum((below.n_convs - 1) * below.words)::BIGINT AS saved_tokens
    FROM shaped top JOIN shaped below ON below.depth >= top.depth
        AND list_slice(below.path, 1, top.depth) = top.path
    GROUP BY top.path)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, n_leaves,
    saved_tokens, sha256(coalesce(n.ends, '')) AS ends_sha256
FROM shaped n JOIN subtrees USING (path)
    LEFT JOIN shaped p ON p.depth = n.depth - 1 AND p.path = list_slice(n.path, 1, n.depth - 1)
"""
