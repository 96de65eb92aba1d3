"""Main text of web pages by minimum-cut labelling (operator 3).

A page is read as text blocks in page order.  Each block is a node; a
classifier's cost of calling it boilerplate joins it to the source and the
cost of calling it content to the sink.  Smoothness edges join neighbours in
page order and, over one helper node per DOM parent, blocks under the same
parent.  The minimum cut is the labelling with the least total cost; blocks on
the source's side are the article.

The classifier adds two parts.  A logistic regression on a block's text
(length, link share, sentence marks, kind of element) is trained here: blocks
inside elements that name their purpose label themselves; ``fit_pages`` pages
with the smallest id hashes and at most ``fit_blocks`` of their blocks (the
documented bounds) reach the driver.  What the surrounding elements say
(article, nav, footer, class names ...) adds fixed log-odds.  An element that names
furniture but wraps the page (most of its text, its first h1 and every article in
it: a form or a "page with sidebar" around all) says nothing.

Nodes whose own cost outweighs all of their edges keep that label in every
minimum cut; they are settled first and maximum flow (Dinic) runs on the rest.
Pages are independent, so labelling is one map over all pages.

Defined results: null, empty or tag-only html: empty text; html cut short or
wrongly nested: read as far as it goes; a page without any article: empty text;
repeated rows: one result row each; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

import html as htmllib
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FIT_PAGES = 400
FIT_BLOCKS = 20_000
NEAR_SAME_PARENT, NEAR_OTHER_PARENT, TO_PARENT = 0.7, 0.2, 0.3
IN_ARTICLE, IN_FURNITURE, NAMED_FURNITURE, NAMED_CONTENT = 3.0, -7.0, -5.0, 1.0
TEXT_LIMIT = 2.0

#: Elements by the part they play.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav "
    "ol option p pre section summary table tbody td tfoot th thead tr ul".split())
ARTICLE_TAGS = frozenset("article main".split())
FURNITURE_TAGS = frozenset(
    "aside button dialog fieldset footer form header label legend menu nav option select".split())
VOID_TAGS = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split())
LEAF_TAGS = frozenset("p h1 h2 h3 h4 h5 h6 li dd dt td th".split())
#: Words of class, id and role that name furniture or content.
FURNITURE_NAMES = frozenset(
    "ad ads advert advertisement alert banner breadcrumb breadcrumbs comment comments "
    "complementary contentinfo consent cookie cookies copyright dialog disclaimer footer form "
    "header hidden login masthead menu modal nav navbar navigation newsletter notice pager "
    "pagination popup promo promotion recommended related reply respond search share sharing "
    "sidebar signup skip social sponsor sponsored subscribe toolbar warning widget".split())
CONTENT_NAMES = frozenset("article body content entry main post story text".split())
#: First parts of class names that tell of a state, not of a purpose.
STATE_NAMES = frozenset("has with without no is js hide show".split())
#: Share of a page's text beyond which an element can wrap the page.
WRAPS = 0.5

#: What a tag holds after its name: quoted values (with any sign in them), other
#: values, names.  A slash at the end is left over.
_ATTRIBUTES = r"""(?:=\s*+(?:"[^"]*"|'[^']*'|[^\s"'<>][^\s<>]*+)|/(?!>)|[^<>/])*+"""
_TAG = r"(?P<closing>/?)(?P<tag>[a-zA-Z][^\s/<>]*)"
_TOKEN = re.compile(
    r"<(?:!--.*?(?:-->|\Z)"
    rf"|(?:svg|math)(?=[\s/>]){_ATTRIBUTES}/>"
    r"|(script|style|noscript|template|textarea|title|svg|math|iframe|object|select)(?=[\s/>])"
    rf"{_ATTRIBUTES}/?>.*?(?:</\1\s*>|\Z)"
    rf"|{_TAG}(?P<attributes>{_ATTRIBUTES}/?)>"
    r"|[!?][^<>]*>"
    rf"|/?[a-zA-Z]{_ATTRIBUTES}\Z"
    rf"|(?P<broken>/?[a-zA-Z]{_ATTRIBUTES})(?=<))", re.S | re.I)
#: For a tag that runs into another one: its quotes mean nothing.
_PLAIN_TAG = re.compile(rf"<(?:{_TAG}(?P<attributes>[^<>]*)>|[!?][^<>]*>)", re.S | re.I)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[a-z]+")
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)


@dataclass
class Block:
    tag: str
    parent: int
    article: bool
    #: Enclosing elements whose tag, or whose names, say furniture; whether names say content.
    tagged_by: tuple
    named_by: tuple
    content_name: bool
    furniture: bool = False
    named: float = 0.0
    parts: list = field(default_factory=list)
    link_chars: int = 0
    text: str = ""

    def settle(self, wrappers: set[int]) -> None:
        """What the surroundings say, without the elements that wrap the page."""
        self.furniture = any(k not in wrappers for k in self.tagged_by)
        against = any(k not in wrappers for k in self.named_by)
        self.named = NAMED_FURNITURE if against else NAMED_CONTENT if self.content_name else 0.0
        self.article = self.article and not self.furniture and not against


def page_wrappers(blocks: list[Block]) -> set[int]:
    """Furniture elements that hold most text, the first h1 and every article."""
    total = sum(len(b.text) for b in blocks)
    held: dict[int, int] = {}
    for b in blocks:
        for k in {*b.tagged_by, *b.named_by}:
            held[k] = held.get(k, 0) + len(b.text)
    out = {k for k, n in held.items() if n > WRAPS * total}
    title = next((b for b in blocks if b.tag == "h1"), None)
    for b in blocks:
        if b is title or b.article:
            out &= {*b.tagged_by, *b.named_by}
    return out


def _purpose(name: str) -> list[str]:
    """The words of a class name or id, none if it tells of a state (has-sidebar)."""
    words = _WORD.findall(name)
    return [] if len(words) > 1 and words[0] in STATE_NAMES else words


def _names(attributes: str) -> float:
    """Log-odds that an element's names and hiding attributes add."""
    if not attributes or "=" not in attributes and "hidden" not in attributes:
        return 0.0
    if _HIDDEN.search(attributes):
        return NAMED_FURNITURE
    words = {w for found in _NAMES.findall(attributes) for name in "".join(found).lower().split()
             for w in _purpose(name)}
    if words & FURNITURE_NAMES:
        return NAMED_FURNITURE
    return NAMED_CONTENT if words & CONTENT_NAMES else 0.0


def _tokens(html: str) -> Iterator[re.Match]:
    """Tags, comments and skipped elements in page order; no part is read more than twice."""
    for token in _TOKEN.finditer(html):
        if token["broken"] is None:
            yield token
        else:
            yield from _PLAIN_TAG.finditer(html, *token.span())


def blocks_of(html: str | None) -> list[Block]:
    """Text blocks of a page, in page order, with what surrounds them."""
    html = html or ""
    out: list[Block] = []
    # open block elements: (tag, number, in an article, furniture by tag, by name, content by name)
    stack = [("", 0, False, (), (), False)]
    count, links, own = 0, 0, None

    def close() -> None:
        nonlocal own
        if own is not None:
            own.text = " ".join("".join(own.parts).split())
            if own.text:
                out.append(own)
            own = None

    def put(text: str) -> None:
        nonlocal own
        if own is None:
            if not text or text.isspace():
                return
            tag, number, *says = stack[-1]
            parent = stack[-2][1] if tag in LEAF_TAGS and len(stack) > 1 else number
            own = Block(tag, parent, *says)
        text = htmllib.unescape(text) if "&" in text else text
        own.parts.append(text)
        if links:
            own.link_chars += len(text.strip())

    at = 0
    for token in _tokens(html):
        if token.start() > at:
            put(html[at:token.start()])
        at = token.end()
        tag = token["tag"]
        if tag is None:
            continue
        tag, closing = tag.lower(), token["closing"]
        if tag == "a":
            links = max(0, links - 1) if closing else links + 1
        elif tag == "br":
            put("\n")
        if tag not in BLOCK_TAGS:
            continue
        close()
        links = 0
        if closing:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == tag:
                    del stack[depth:]
                    break
        elif tag not in VOID_TAGS:
            if len(stack) > 1 and stack[-1][0] in LEAF_TAGS and (
                    stack[-1][0] == tag or stack[-1][0] == "p"):
                stack.pop()  # its end tag was left out
            _, _, article, tagged, named, content = stack[-1]
            count += 1
            if tag in ARTICLE_TAGS:
                article, content = True, False
            if tag in FURNITURE_TAGS:
                tagged = (*tagged, count)
            if tag not in ("html", "body"):
                says = _names(token["attributes"])
                named = (*named, count) if says < 0 else named
                content = content or says > 0 and tag not in ARTICLE_TAGS
            stack.append((tag, count, article, tagged, named, content))
    if at < len(html):
        put(html[at:])
    close()
    wrappers = page_wrappers(out)
    for block in out:
        block.settle(wrappers)
    return out


def text_features(block: Block) -> list[float]:
    text = block.text
    n = len(text)
    return [1.0, np.log1p(n) / 5, min(1.0, block.link_chars / n), min(3, len(re.findall(
        r"[.!?](?:\s|$)", text))) / 3, float(text.count(" ") >= 8), float(block.tag[:1] == "h"),
        float(block.tag in ("li", "dd", "dt", "td", "th"))]


#: Used where the pages name no purposes to learn from.
DEFAULT_WEIGHTS = (-1.5, 1.0, -3.0, 1.0, 1.0, 1.0, -0.5)


def train(rows: np.ndarray, content: np.ndarray, steps: int = 300, ridge: float = 0.01) -> np.ndarray:
    """Logistic regression with both classes weighted alike (Newton steps)."""
    if min(content.sum(), (~content).sum()) < 20:
        return np.array(DEFAULT_WEIGHTS)
    weight = np.where(content, 0.5 / content.sum(), 0.5 / (~content).sum())
    w = np.zeros(rows.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(rows @ w, -30, 30)))
        step = np.linalg.solve((rows * (weight * p * (1 - p))[:, None]).T @ rows
                               + ridge * np.eye(len(w)),
                               rows.T @ (weight * (content - p)) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def log_odds(block: Block, weights: np.ndarray) -> float:
    """Log-odds that a block belongs to the article."""
    odds = float(np.clip(np.dot(text_features(block), weights), -TEXT_LIMIT, TEXT_LIMIT))
    return odds + block.named + IN_ARTICLE * block.article + IN_FURNITURE * block.furniture


def max_flow_side(odds: list[float], edges: dict[tuple[int, int], float]) -> list[bool]:
    """Labels of a minimum cut: True on the source's side.

    ``odds`` > 0 is a source capacity, < 0 a sink capacity; ``edges`` are
    undirected capacities.
    """
    n = len(odds)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for (a, b), c in edges.items():
        near[a][b] = near[a].get(b, 0.0) + c
        near[b][a] = near[b].get(a, 0.0) + c
    odds, label = list(odds), [None] * n
    todo = deque(range(n))
    while todo:  # a node that outweighs its edges is settled; its edges go to the neighbours
        a = todo.popleft()
        if label[a] is None and abs(odds[a]) > sum(near[a].values()):
            label[a] = odds[a] > 0
            for b, c in near[a].items():
                del near[b][a]
                odds[b] += c if label[a] else -c
                todo.append(b)
            near[a] = {}
    left = [a for a in range(n) if label[a] is None]
    if left:
        source, sink = n, n + 1
        cap: list[dict[int, float]] = [dict(x) for x in near] + [{}, {}]
        for a in left:
            if odds[a] > 0:
                cap[source][a], cap[a][source] = odds[a], 0.0
            elif odds[a] < 0:
                cap[a][sink], cap[sink][a] = -odds[a], 0.0
        while True:
            level = {source: 0}
            queue = deque([source])
            while queue:
                a = queue.popleft()
                for b, c in cap[a].items():
                    if c > 1e-9 and b not in level:
                        level[b] = level[a] + 1
                        queue.append(b)
            if sink not in level:
                break
            ways = {a: iter(list(cap[a])) for a in level}
            path = [source]
            while path:
                a = path[-1]
                if a == sink:
                    low = min(cap[x][y] for x, y in zip(path, path[1:]))
                    for x, y in zip(path, path[1:]):
                        cap[x][y] -= low
                        cap[y][x] = cap[y].get(x, 0.0) + low
                    cut = next(k for k, (x, y) in enumerate(zip(path, path[1:])) if cap[x][y] <= 1e-9)
                    del path[cut + 1:]
                    continue
                for b in ways[a]:
                    if cap[a][b] > 1e-9 and level.get(b) == level[a] + 1:
                        path.append(b)
                        break
                else:
                    path.pop()
                    if path:
                        level[a] = -1
        for a in left:
            label[a] = a in level
    return label


def content_blocks(blocks: list[Block], weights: np.ndarray) -> list[Block]:
    """The blocks that the minimum cut labels as article."""
    odds = [log_odds(b, weights) for b in blocks]
    edges, parents = {}, {}
    for k, block in enumerate(blocks):
        if k:
            edges[k - 1, k] = (NEAR_SAME_PARENT if blocks[k - 1].parent == block.parent
                               else NEAR_OTHER_PARENT)
        parents.setdefault(block.parent, []).append(k)
    for own in parents.values():
        if len(own) > 2:  # two are neighbours, or nearly
            for k in own:
                edges[k, len(odds)] = TO_PARENT
            odds.append(0.0)
    label = max_flow_side(odds, edges)
    return [b for b, content in zip(blocks, label) if content]


def main_text(html: str | None, weights: np.ndarray) -> str:
    return "\n\n".join(b.text for b in content_blocks(blocks_of(html), weights))


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Text features of blocks whose surroundings name their purpose."""
    for batch in batches:
        rows, content = [], []
        for html in batch.column("html").to_pylist():
            for block in blocks_of(html):
                inside = block.article and not block.furniture and block.named >= 0
                if inside or block.furniture or block.named <= NAMED_FURNITURE:
                    rows.append(text_features(block))
                    content.append(inside)
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())),
                                          pa.array(content, pa.bool_())],
                                         names=["features", "content"])


def fit(pages: DataFrame, fit_pages: int = FIT_PAGES, fit_blocks: int = FIT_BLOCKS) -> np.ndarray:
    """Text weights from a bounded sample of pages."""
    chosen = (pages.select(F.col("page_id").alias("_chosen")).where("_chosen is not null").distinct()
              .orderBy(F.xxhash64("_chosen"), "_chosen").limit(fit_pages))
    found = (pages.select("page_id", "html").join(F.broadcast(chosen), F.col("page_id")
                                                  == F.col("_chosen"), "left_semi")
             .select("html").mapInArrow(_examples, "features array<double>, content boolean")
             .orderBy(F.xxhash64("features"), "content").limit(fit_blocks).toPandas())
    if found.empty:
        return np.array(DEFAULT_WEIGHTS)
    return train(np.array(found["features"].tolist(), float), found["content"].to_numpy(bool))


def extract(pages: DataFrame, **options) -> DataFrame:
    """page_id, url, text of every page."""
    pages = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
    weights = fit(pages, **options)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x, weights) for x in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())],
                names=["page_id", "url", "text"])
    kinds = dict(pages.dtypes)
    return pages.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string")
