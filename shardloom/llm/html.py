"""Main text of web pages: boosted trees over DOM nodes, decoded along the tree.

Every element gets features of its subtree, its attributes' tokens, its depth and its
siblings. Gradient-boosted trees, trained here, give each element the log-odds that its
text belongs to the article. Decoding walks the tree from the leaves up: an element is
worth its own text times its log-odds plus what its children are worth, a child that is
worth less than nothing is dropped with all below it, and so no element is kept inside a
dropped one.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardloom.llm.tables import clear_name, least_hashed, quoted
from shardloom.session import attach

# The training sample: so many pages at most, by a hash of the url and page.
SAMPLE_PAGES = 200
SEED = 6
TREES, DEPTH, BINS, RATE = 40, 3, 24, 0.3
# Pages whose nodes are judged at once, and characters that end a lot early.
LOT, LOT_CHARS = 256, 4 << 20

# Fixed values of HTML: elements without content, without visible text, and blocks.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("head title script style template noscript iframe object svg math canvas".split())
RAW = frozenset("script style title textarea noscript iframe template".split())
FOREIGN = ("svg", "math")
FORMS = frozenset("form button select option textarea label fieldset input".split())
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt"
    " fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main"
    " menu nav ol option p pre section select summary table tbody td textarea tfoot th thead"
    " tr ul button".split()
)
# A start tag of the first kind ends an open element of the second.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
CONTAINERS = frozenset("ul ol dl table select div article section body html main td".split())

# Tokens of class, id and role that speak for and against an article.
GOOD = frozenset("article body content entry main maincontent page post story text".split())
BAD = frozenset(
    "ad ads advert advertisement alert banner bar breadcrumb button comment comments cookie"
    " consent disqus footer form header login masthead menu modal nav navbar navigation notice"
    " outbrain pagination pager popup promo promoted recommended related reply replies rss"
    " search share sharing sidebar signup social sponsor sponsored subscribe subscription"
    " newsletter tags toc toolbar widget".split()
)
BAD_TAGS = frozenset("nav footer aside header menu".split()) | FORMS

# Fixed rules of HTML: comments, declarations, tags and false end tags, else text. A quoted value
# may hold the sign that ends a tag. Nothing is tried twice, so time follows the page's length.
_TOKEN = re.compile(
    r"""<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*+>?"""
    r"""|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"'=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|["'=])*+)(>|\Z)"""
    r"""|</[^>]*+>?|[^<]++|<""",
    re.S,
)
# A name and its value, one pair after another; a quote that the tag's end cuts off is a value too.
_ATTRIBUTE = re.compile(r"""([^\s/>][^\s/>=]*)(?:\s*=\s*("[^"]*"?|'[^']*'?|[^\s>]*))?""")
_PART = re.compile(r"[a-z]+")
_BLANK = re.compile(r"[\s]+")
_STOPS = re.compile(r"[.,;:!?]")

FEATURES = (
    "depth", "chars", "own_chars", "link_share", "elements", "density", "paragraphs", "stops",
    "place", "siblings", "same_siblings", "share_of_parent", "share_of_page", "text_before",
    "good_tokens", "bad_tokens", "bad_tag", "bad_above", "good_above", "hidden", "is_list",
    "is_heading", "is_paragraph", "is_inline", "sibling_mean", "article_tag", "article_above",
)


@dataclass(slots=True)
class Node:
    tag: str
    parent: int
    depth: int
    good: int = 0
    bad: int = 0
    hidden: bool = False
    pieces: list = field(default_factory=list)  # texts and children's numbers, in order


class _Open:
    """The open elements, with their places by tag, so that no end tag has to search for its own."""

    def __init__(self) -> None:
        self.nodes = [Node("#root", -1, 0)]
        self.stack = [0]
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []

    def push(self, node: Node) -> None:
        place = len(self.stack)
        self.stack.append(len(self.nodes) - 1)
        self.places.setdefault(node.tag, []).append(place)
        if node.tag in BLOCKS:
            self.blocks.append(place)

    def cut(self, place: int) -> None:
        """Close the element at ``place`` and all within it."""
        while len(self.stack) > place:
            tag = self.nodes[self.stack.pop()].tag
            self.places[tag].pop()
            if tag in BLOCKS:
                self.blocks.pop()

    def last(self, tag: str) -> int:
        """Place of the innermost open element of a tag, 0 if there is none."""
        places = self.places.get(tag)
        return places[-1] if places else 0

    def close(self, tag: str) -> None:
        if self.last(tag):
            self.cut(self.last(tag))

    def end_paragraph(self) -> None:
        """A block ends an open paragraph, with the inline elements left open in it."""
        if self.blocks and self.blocks[-1] == self.last("p"):
            self.cut(self.blocks[-1])

    def end_item(self, ended: set[str]) -> None:
        """An item ends the one before it, unless a container has been opened since."""
        place = max(map(self.last, ended))
        if place and place >= max(map(self.last, CONTAINERS)):
            self.cut(place)


def parse(page: str) -> list[Node]:
    """The page's elements in order; 0 is the root. Broken markup is closed where it must be."""
    opened = _Open()
    nodes, stack = opened.nodes, opened.stack
    position = 0
    while position < len(page):
        match = _TOKEN.match(page, position)
        position = match.end()
        tag = match[2]
        if tag is None:
            text = match[0]
            if text[0] != "<" or len(text) == 1:
                nodes[stack[-1]].pieces.append(text)
            continue
        if not match[4]:
            break  # the page ends within a tag
        tag = tag.lower()
        if match[1]:
            opened.close(tag)
            continue
        if tag in BLOCKS and tag != "br":
            opened.end_paragraph()
        if tag in CLOSES:
            opened.end_item(CLOSES[tag])
        node = Node(tag, stack[-1], len(stack))
        _describe(node, match[3])
        nodes[stack[-1]].pieces.append(len(nodes))
        nodes.append(node)
        # A slash closes foreign elements only; elsewhere it says nothing.
        foreign = tag in FOREIGN or any(map(opened.last, FOREIGN))
        if tag in VOID or (foreign and match[3].endswith("/")):
            continue
        opened.push(node)
        if tag in RAW and not foreign:  # these end at their own end tag only
            end = _raw_end(tag).search(page, position)
            position = end.start() if end else len(page)
    return nodes


@lru_cache
def _raw_end(tag: str) -> re.Pattern:
    return re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I | re.A)


def _describe(node: Node, attributes: str) -> None:
    node.hidden = node.tag in HIDDEN
    if "=" not in attributes and "hidden" not in attributes.lower():
        return
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            node.hidden = True
        elif name == "style":
            node.hidden |= "display:none" in value.replace(" ", "")
        elif name in ("class", "id", "role"):
            for part in _PART.findall(value):
                node.good += part in GOOD
                node.bad += part in BAD


def features(nodes: list[Node]) -> np.ndarray:
    """A row of ``FEATURES`` per element."""
    n = len(nodes)
    chars, own, links, elements, paragraphs, stops, before = (np.zeros(n) for _ in range(7))
    children: list[list[int]] = [[] for _ in range(n)]
    seen = 0.0
    gone = [False] * n
    for i, node in enumerate(nodes):
        gone[i] = node.hidden or (node.parent >= 0 and gone[node.parent])
        before[i] = seen
        for piece in node.pieces:
            if isinstance(piece, int):
                children[i].append(piece)
            elif not gone[i]:
                size = len(piece.strip())
                own[i] += size
                seen += size
                stops[i] += len(_STOPS.findall(piece))
    for i in range(n - 1, -1, -1):
        node = nodes[i]
        chars[i] += own[i]
        elements[i] += 1
        if node.tag == "a":
            links[i] = chars[i]
        paragraphs[i] += node.tag == "p"
        if node.parent >= 0:
            for of in (chars, links, elements, paragraphs, stops):
                of[node.parent] += of[i]
    page = max(chars[0], 1.0)
    table = np.zeros((n, len(FEATURES)), np.float32)
    bad_above, good_above, article_above = [0] * n, [0] * n, [0] * n
    rank = [0] * n
    same = [0] * n
    mean = [0.0] * n
    for i, node in enumerate(nodes):
        up = node.parent
        if up >= 0:
            above = nodes[up]
            bad_above[i] = bad_above[up] + (above.bad > 0) + (above.tag in BAD_TAGS)
            good_above[i] = good_above[up] + (above.good > 0)
            article_above[i] = article_above[up] + (above.tag in ("article", "main"))
        group = children[i]
        if group:
            tags: dict[str, int] = {}
            for child in group:
                tags[nodes[child].tag] = tags.get(nodes[child].tag, 0) + 1
            average = float(chars[group].mean())
            for k, child in enumerate(group):
                rank[child], same[child], mean[child] = k, tags[nodes[child].tag], average
        parent_chars = chars[up] if up >= 0 else page
        table[i] = (
            node.depth, np.log1p(chars[i]), np.log1p(own[i]), links[i] / max(chars[i], 1.0),
            np.log1p(elements[i]), chars[i] / elements[i], np.log1p(paragraphs[i]),
            stops[i] / max(chars[i], 1.0) * 100, rank[i] / max(len(children[up]) if up >= 0 else 1, 1),
            len(children[up]) if up >= 0 else 1, same[i], chars[i] / max(parent_chars, 1.0),
            chars[i] / page, before[i] / page, node.good, node.bad, node.tag in BAD_TAGS,
            bad_above[i], good_above[i], gone[i], node.tag in ("ul", "ol", "li", "dl"),
            node.tag in ("h1", "h2", "h3", "h4", "h5", "h6"), node.tag == "p",
            node.tag not in BLOCKS, np.log1p(mean[i]), node.tag in ("article", "main"), article_above[i],
        )
    return table


@dataclass
class Boosted:
    """Trees of equal depth as arrays: a split's feature and bound, a leaf's log-odds."""

    bias: float
    columns: np.ndarray
    bounds: np.ndarray
    leaves: np.ndarray

    def predict(self, rows: np.ndarray) -> np.ndarray:
        total = np.full(len(rows), self.bias)
        every = np.arange(len(rows))
        for columns, bounds, leaves in zip(self.columns, self.bounds, self.leaves, strict=True):
            at = np.zeros(len(rows), np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (rows[every, columns[at]] > bounds[at])
            total += leaves[at - (2**DEPTH - 1)]
        return total


def boost(rows: np.ndarray, target: np.ndarray, weight: np.ndarray, trees: int = TREES) -> Boosted:
    """Newton boosting of the logistic loss over binned features."""
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in rows.T]
    binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, rows.T, strict=True)], 1)
    mean = np.clip(np.average(target, weights=weight), 0.02, 0.98)
    bias = float(np.log(mean / (1 - mean)))
    score = np.full(len(rows), bias)
    inner, leaf_count = 2**DEPTH - 1, 2**DEPTH
    all_columns, all_bounds, all_leaves = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        gradient, hessian = weight * (target - p), weight * p * (1 - p)
        at = np.zeros(len(rows), np.int64)
        columns, bounds = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for node in range(inner):
            here = np.flatnonzero(at == node)
            best = 1e-6
            for c in range(rows.shape[1] if len(here) else 0):
                size = len(edges[c]) + 1
                g = np.cumsum(np.bincount(binned[here, c], gradient[here], size))
                h = np.cumsum(np.bincount(binned[here, c], hessian[here], size))
                gain = g[:-1] ** 2 / (h[:-1] + 1) + (g[-1] - g[:-1]) ** 2 / (h[-1] - h[:-1] + 1)
                if len(gain) and gain.max() - g[-1] ** 2 / (h[-1] + 1) > best:
                    best = gain.max() - g[-1] ** 2 / (h[-1] + 1)
                    columns[node], bounds[node] = c, edges[c][gain.argmax()]
            at[here] = 2 * node + 1 + (rows[here, columns[node]] > bounds[node])
        leaf = at - inner
        g = np.bincount(leaf, gradient, leaf_count)
        h = np.bincount(leaf, hessian, leaf_count)
        leaves = RATE * g / (h + 1)
        score += leaves[leaf]
        all_columns.append(columns)
        all_bounds.append(bounds)
        all_leaves.append(leaves)
    return Boosted(bias, np.array(all_columns), np.array(all_bounds), np.array(all_leaves))


def decode(nodes: list[Node], odds: np.ndarray) -> list[bool]:
    """Which elements' own text is kept: the best choice in which every ancestor is kept too."""
    n = len(nodes)
    worth = [0.0] * n
    size = [0] * n
    for i in range(n - 1, -1, -1):
        node = nodes[i]
        size[i] = sum(len(p.strip()) for p in node.pieces if not isinstance(p, int))
        worth[i] += -1.0 if node.hidden else size[i] * float(odds[i])
        if node.hidden:
            worth[i] = -1.0
        if node.parent >= 0 and worth[i] > 0:
            worth[node.parent] += worth[i]
    keep = [False] * n
    for i, node in enumerate(nodes):
        keep[i] = (i == 0 or keep[node.parent]) and (worth[i] > 0 or i == 0)
    # An element may be on the way to kept text and yet own text that speaks against it.
    return [k and (size[i] == 0 or odds[i] > 0 or nodes[i].tag not in BLOCKS) for i, k in enumerate(keep)]


def rendered(nodes: list[Node], own: Sequence[bool]) -> str:
    """Kept text in page order: blocks joined by one space, white space inside them as one."""
    out: list[str] = []
    todo: list[tuple[int, int]] = [(0, 0)]
    while todo:
        i, k = todo.pop()
        node = nodes[i]
        if k == 0 and node.tag in BLOCKS:
            out.append(" ")
        while k < len(node.pieces):
            piece = node.pieces[k]
            k += 1
            if isinstance(piece, int):
                todo.append((i, k))
                todo.append((piece, 0))
                break
            if own[i]:
                out.append(references.unescape(piece))
        else:
            if node.tag in BLOCKS:
                out.append(" ")
    return _BLANK.sub(" ", "".join(out)).strip()


def _barred(nodes: list[Node], tags: frozenset = BAD_TAGS, tokens: bool = True, spared: Sequence[str] = ()) -> np.ndarray:
    """Hidden elements, those of ``tags`` or with bad tokens (elements of ``spared`` may have them), and all below."""
    barred = np.zeros(len(nodes), bool)
    for i, node in enumerate(nodes):
        own = node.hidden or node.tag in tags or (tokens and node.bad > 0 and node.tag not in spared)
        barred[i] = own or (node.parent >= 0 and barred[node.parent])
    return barred


def _weak_labels(nodes: list[Node]) -> np.ndarray:
    """Teacher: text below ``article`` or ``main``, outside of menus, forms and the like."""
    inside = np.zeros(len(nodes), bool)
    for i, node in enumerate(nodes):
        inside[i] = (node.parent >= 0 and inside[node.parent]) or node.tag in ("article", "main")
    return inside & ~_barred(nodes)


def _untaught(nodes: list[Node]) -> np.ndarray:
    """The rule without a model: the teacher's, where that leaves text, else all outside of barred elements.

    A page that lies in a form as a whole, or in an element named after its sidebar, is not
    lost: if no text is left, names and forms bar nothing.
    """
    labels = _weak_labels(nodes)
    if not rendered(nodes, labels):
        labels = ~_barred(nodes, spared=("html", "body"))
    if not rendered(nodes, labels):
        labels = ~_barred(nodes, BAD_TAGS - {"form", "fieldset"}, tokens=False)
    return labels


# Shapes that pages take elsewhere: what an article and what sits around it may look like.
_ARTICLES = (
    "<article>{}</article>", "<main>{}</main>", '<div class="content">{}</div>',
    '<div id="main-content">{}</div>', '<section class="post entry">{}</section>',
    '<div class="page"><div class="article-body">{}</div></div>', "<div><div>{}</div></div>",
)
_AROUND = (
    '<div class="sidebar"><h3>{}</h3><p>{}</p></div>', "<aside><p>{}</p><p>{}</p></aside>",
    '<div class="cookie-notice">{} {}</div>', '<div id="comments"><h2>{}</h2><div class="comment"><p>{}</p></div></div>',
    '<section class="comments"><p>{}</p><p>{}</p></section>', "<header><h2>{}</h2><p>{}</p></header>",
    '<form action="/s"><label>{}</label><input name="q"><button>{}</button></form>',
    '<div class="ad">{} {}</div>', '<div class="banner promo"><p>{}</p>{}</div>',
    '<ul class="menu"><li><a href="#">{}</a></li><li><a href="#">{}</a></li></ul>',
    '<div class="related"><ul><li><a href="#">{}</a></li><li><a href="#">{}</a></li></ul></div>',
    '<div class="share social"><a href="#">{}</a><a href="#">{}</a></div>',
    "<footer><p>{}</p><p>{}</p></footer>", '<nav><a href="#">{}</a> <a href="#">{}</a></nav>',
    '<div role="alert" class="notice"><p>{}</p><p>{}</p></div>',
)


def _variants(page: str, rng: np.random.Generator) -> Iterator[tuple[list[Node], np.ndarray]]:
    """The page under the teacher, and its paragraphs in other shapes with their true labels."""
    nodes = parse(page)
    truth = _weak_labels(nodes)
    if not truth.any():
        return
    yield nodes, truth
    text = rendered(nodes, truth)
    words = references.escape(text).split()
    if len(words) < 8:
        return
    for shape in rng.choice(len(_ARTICLES), 3, replace=False):
        cuts = np.sort(rng.integers(0, len(words), int(rng.integers(1, 8))))
        parts = [" ".join(w) for w in np.split(np.array(words, object), cuts) if len(w)]
        inner = "<h1>" + " ".join(words[:6]) + "</h1>" + "".join(f"<p>{p}</p>" for p in parts)

        def snippet() -> str:
            at = int(rng.integers(0, len(words)))
            return " ".join(words[at : at + int(rng.integers(2, 25))])

        around = [_AROUND[k].format(snippet(), snippet()) for k in rng.choice(len(_AROUND), 6, replace=False)]
        mark = "<wbr>"  # an empty element that nothing else here makes
        body = "".join(around[:3]) + mark + _ARTICLES[shape].format(inner) + mark + "".join(around[3:5])
        if rng.random() < 0.4:  # something foreign inside of the article's element
            body = body.replace("</h1>", "</h1>" + mark + around[5] + mark, 1)
        made = parse(f"<html><body>{body.replace(mark, '')}</body></html>")
        flags = _marked(parse(f"<html><body>{body}</body></html>"))
        yield made, flags


def _marked(nodes: list[Node]) -> np.ndarray:
    """Elements between the first and second mark, and so on; marks are not elements."""
    order: list[tuple[int, bool]] = []
    state = False
    todo = [0]
    flags: dict[int, bool] = {}
    while todo:
        i = todo.pop()
        if nodes[i].tag == "wbr":
            state = not state
        else:
            flags[i] = state
            order.append((i, state))
        todo.extend(reversed([p for p in nodes[i].pieces if isinstance(p, int)]))
    return np.array([state for _, state in order])


def train(pages: DataFrame, html_col: str = "html", url_col: str = "url", sample: int = SAMPLE_PAGES, seed: int = SEED) -> Boosted | None:
    """Trees fitted on at most ``sample`` pages that have an ``article`` or ``main`` element.

    The pages, the least by a hash, come to the driver. The teacher labels elements by these
    two tags; the article's text is set into other shapes as well, among sidebars, notices,
    forms, adverts and comments made of its words, so that class names, link shares and
    sizes are learnt and not the tags alone. None without such a page.
    """
    shaped = pages.filter(F.lower(quoted(html_col)).rlike(r"<(article|main)[\s/>]")).select(
        quoted(html_col).alias("html"), F.xxhash64(quoted(url_col), quoted(html_col), F.lit(seed)).alias("at")
    )
    rows = least_hashed(shaped, "at", sample).select("html").collect()
    rng = np.random.default_rng(seed)
    tables, targets = [], []
    for row in rows:
        for nodes, truth in _variants(row.html, rng):
            tables.append(features(nodes))
            targets.append(truth)
    if not tables:
        return None
    x, y = np.concatenate(tables), np.concatenate(targets).astype(float)
    weight = 1 + x[:, FEATURES.index("own_chars")]
    return boost(x, y, weight)


def main_text(page: Column, model: Broadcast) -> Column:
    """The main text of a page; null and pages without any give an empty string."""

    @F.arrow_udf("string")
    def extract(column: pa.Array) -> pa.Array:
        out: list[str] = []
        lot: list[list[Node]] = []
        size = 0
        for page in column.to_pylist():
            lot.append(parse(page or ""))
            size += len(page or "")
            if len(lot) >= LOT or size > LOT_CHARS:
                out.extend(_texts(lot, model.value))
                lot, size = [], 0
        out.extend(_texts(lot, model.value))
        return pa.array(out, pa.string())

    return extract(page)


def _texts(lot: list[list[Node]], model: Boosted | None) -> Iterator[str]:
    if not lot:
        return
    if model is None:
        odds = [np.where(_untaught(nodes), 1.0, -1.0) for nodes in lot]
    else:
        joined = model.predict(np.concatenate([features(nodes) for nodes in lot]))
        odds = np.split(joined, np.cumsum([len(nodes) for nodes in lot])[:-1])
    for nodes, of in zip(lot, odds, strict=True):
        yield rendered(nodes, decode(nodes, of))


def extract(pages: DataFrame, model: Boosted | None, html_col: str = "html") -> DataFrame:
    """All columns of ``pages`` and ``text, n_chars``; one pass without a shuffle.

    Null and empty pages, and those of markup alone, give an empty text. Without a model,
    because there was no page to learn from, it is the text below ``article`` or ``main``, or
    on pages without it all visible text outside of menus, forms and the like. Repeated pages
    give equal texts. Columns of ``pages`` named like a new one are replaced.
    """
    spark = attach(pages.sparkSession)
    shared = spark.sparkContext.broadcast(model)
    own = [quoted(c) for c in pages.columns if c.lower() not in {"text", "n_chars"}]
    hidden = clear_name(pages, "_text")
    found = pages.select(*own, main_text(quoted(html_col), shared).alias(hidden))
    return found.select(*own, F.col(hidden).alias("text"), F.length(hidden).cast("bigint").alias("n_chars"))
