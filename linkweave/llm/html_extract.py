"""Main text of web pages by gradient-boosted trees over DOM nodes and hierarchical decoding.

Each page is parsed into its block-level elements; inline markup is part of the block around it.  A node's features
are its tag, tokens of its class, id and role (and those around it), depth, place among its siblings and what its
siblings are like, and the density of text, links and sentences in its subtree.  Boosted trees give the probability
that the node belongs to the article.  Decoding then picks the most probable consistent labelling: below a
rejected node nothing is accepted, and once a node is rejected inside the article all below it is.

There are no labelled pages, so labels come from cues of three kinds, the first that a page has (``weak_labels``): elements that say
they are the article (``article``, ``main``), class tokens that do, and else the innermost container that holds nearly all prose;
less what is named as menu, header, advert, form, comment, ...  The trees learn from a bounded sample, each page in four guises: as
it is, with the article's element renamed, without that element, and without any telling tag or token.  So they don't depend on
the cues, and a page is read by its densities and depths where its markup says nothing.  Scripts, styles and heads never are text.

Parsing takes time in proportion to the page, whatever its markup: one forward scan, with the places of open elements by kind.

Defined results: a null or blank page has no text; text without any element around it belongs to the page's root; unclosed
and misnested elements are closed as browsers do it, roughly; a tag that never ends is text; repeated rows each get their row;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkweave.llm import trees
from linkweave.llm.common import unit_hash

#: Pages the trees are trained on, at most, the longest of them, and their nodes in all.
TRAIN_PAGES = 600
TRAIN_CHARS = 200_000
TRAIN_NODES = 200_000
#: Nodes whose features are held at once (the page with more is taken alone).
HELD_NODES = 20_000
#: Depth of the trees.
DEPTH = 4

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg object select option button head".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br img".split())
#: A start tag (key) ends an open element of these kinds.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
#: An element of these kinds bounds what the end or start of another closes.
SCOPE = frozenset("html body table ul ol dl article main section div td th form nav aside header footer".split())
TAGS = "article main section div p h1 h2 h3 h4 ul ol li table td nav header footer aside form blockquote pre figure figcaption dl dd address hr details".split()
#: Tokens of class, id and role by what they say.
GROUPS = {
    "article": "article main content post entry story body text".split(),
    "menu": "nav menu navbar breadcrumb breadcrumbs navigation toc pagination pager".split(),
    "frame": "header footer masthead banner contentinfo topbar copyright legal".split(),
    "side": "sidebar side aside related recommended widget complementary more trending".split(),
    "advert": "ad ads advert advertisement sponsor sponsored promo promotion".split(),
    "notice": "cookie cookies consent notice alert popup modal overlay newsletter subscribe subscription signup".split(),
    "comment": "comment comments reply replies discussion disqus respond".split(),
    "share": "share sharing social follow like tags meta byline author".split(),
    "form": "form search login register contact".split(),
}
_TOKEN = {t: n for n, tokens in enumerate(GROUPS.values()) for t in tokens}
_BAD = frozenset(n for n, g in enumerate(GROUPS) if g in ("menu", "frame", "side", "advert", "notice", "comment", "form"))
_BAD_TAGS = frozenset("nav footer aside form".split())
_ARTICLE = _TOKEN["article"]
_ARTICLE_TAGS = frozenset(("article", "main"))
#: Tags that say what they hold; without them all these are ``div``.
_TELLING = _BAD_TAGS | _ARTICLE_TAGS | frozenset(("header", "section"))
#: Elements that may hold a whole article.
_CONTAINERS = frozenset("html body div section article main center table tbody tr td".split())
#: Share of its parent's prose that a container has when it holds "nearly all".
_NEARLY_ALL = 0.8

_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
#: What comes before a tag's end; a quoted value may hold the sign that ends it.
_REST = re.compile(r"(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|))*+")
_DECIMAL = re.compile(r"&#0*+([0-9]*+)")
_ATTRIBUTE = re.compile(r"(?:^|[\s\"'/])(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_SPACE = re.compile(r"\s+")
_ENDS = re.compile(r"[.!?](?:\s|$)")


class Node:
    __slots__ = ("tag", "parent", "depth", "index", "tokens", "blocks", "children", "links", "chars", "sub")

    def __init__(self, tag: str, parent: "Node | None", tokens: frozenset[int]):
        self.tag, self.parent, self.tokens = tag, parent, tokens
        self.depth = parent.depth + 1 if parent else 0
        self.index = len(parent.children) if parent else 0
        self.blocks: list[tuple[int, str]] = []  # (order in the page, text)
        self.children: list[Node] = []
        self.links = 0
        if parent:
            parent.children.append(self)


def attribute_groups(attributes: str) -> frozenset[int]:
    found = set()
    if "=" in attributes:
        for m in _ATTRIBUTE.finditer(attributes):
            for t in re.split(r"[^a-z0-9]+", (m[2] or m[3] or m[4] or "").lower()):
                if t in _TOKEN:
                    found.add(_TOKEN[t])
    return frozenset(found)


def unescaped(text: str) -> str:
    """Character references decoded; numbers beyond all code points, however long, give the replacement character."""
    if "&" not in text:
        return text
    if "&#" in text:
        text = _DECIMAL.sub(lambda m: m[0] if len(m[0]) < 12 else "&#" + ((m[1] or "0") if len(m[1]) < 8 else "9999999"), text)
    return entities.unescape(text)


def parse(page: str) -> list[Node]:
    """Nodes of a page in order of their start; the first is the root.  Blocks hang on the node right around them."""
    root = Node("#root", None, frozenset())
    nodes, open_nodes, text, at, order, link = [root], [root], [], 0, 0, 0
    places: dict[str, list[int]] = {}  # of the open elements of a kind, in ``open_nodes``

    def flush() -> None:
        nonlocal order, text
        if text:
            block = _SPACE.sub(" ", "".join(text)).strip()
            if block:
                open_nodes[-1].blocks.append((order, block))
                order += 1
            text = []

    def innermost(kinds) -> int:
        return max((places[k][-1] for k in kinds if places.get(k)), default=0)

    def close(kinds, stop) -> None:
        """Ends the innermost open element of these kinds, and what it holds, unless ``stop`` is in between."""
        place = innermost(kinds)
        if place and place >= innermost(stop):
            flush()
            for x in open_nodes[place:]:
                places[x.tag].pop()
            del open_nodes[place:]

    last_end, quotes, unclosed, pos = page.rfind(">"), True, set(), 0
    while (pos := page.find("<", pos)) >= 0:
        ends, tag, attributes = False, "", ""
        if page.startswith("<!--", pos):
            end = page.find("-->", pos + 2)
            end = end + 3 if end >= 0 else len(page)
        elif pos > last_end:
            break
        elif page[pos + 1] in "!?":
            end = page.find(">", pos) + 1
        elif m := _NAME.match(page, pos):
            ends, tag = bool(m[1]), m[2].lower()
            end = _REST.match(page, m.end()).end() if quotes else page.find(">", m.end())
            if end == len(page):
                # Quotes hide the end of this tag, so they don't count from here on: no second scan reaches the page's end in vain.
                quotes, end = False, page.find(">", m.end())
            attributes = page[m.end() : end]
            end += 1
        else:
            pos += 1
            continue
        if pos > at:
            piece = unescaped(page[at:pos])
            text.append(piece)
            if link:
                open_nodes[-1].links += len(piece)
        at = pos = end
        if not tag:
            continue  # a comment, a declaration
        if tag in RAW:
            if not ends and not attributes.endswith("/"):
                stop = None if tag in unclosed else re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
                if stop:
                    at = pos = stop.end()
                else:
                    unclosed.add(tag)
                    at = pos = len(page) if tag in ("script", "style") else at
            if tag not in ("button", "option", "select"):
                flush()
            continue
        if tag in INLINE:
            if tag == "a":
                link = 0 if ends else 1
            elif tag == "br":
                text.append(" ")
            continue
        flush()
        if tag in VOID:
            continue
        if ends:
            close((tag,), SCOPE - {tag} if tag in ("p", "li", "dt", "dd") else ("html",))
            continue
        close(("p",), SCOPE)
        if tag in CLOSES:
            close(CLOSES[tag], ("ul", "ol", "dl", "table"))
        node = Node(tag, open_nodes[-1], attribute_groups(attributes) if attributes else frozenset())
        places.setdefault(tag, []).append(len(open_nodes))
        nodes.append(node)
        open_nodes.append(node)
    if at < len(page):
        text.append(unescaped(page[at:]))
    flush()
    return nodes


def _is_named_bad(x: Node) -> bool:
    return x.tag in _BAD_TAGS or (_ARTICLE not in x.tokens and bool(x.tokens & _BAD))


def features(nodes: list[Node]) -> np.ndarray:
    """One row a node."""
    n, groups = len(nodes), len(GROUPS)
    place = {id(x): i for i, x in enumerate(nodes)}
    parent = np.array([place[id(x.parent)] if x.parent else -1 for x in nodes])
    own = np.zeros((n, 6))  # chars, words, blocks, link chars, sentence ends, nodes
    flags, around = np.zeros((n, groups)), np.zeros((n, groups + 2))
    tags = np.zeros((n, len(TAGS)))
    said = np.zeros((n, 3))  # named as no part of the article: itself, something around it; the page says where its article is
    said[:, 2] = any(x.tag in _ARTICLE_TAGS or _ARTICLE in x.tokens for x in nodes)
    for i, x in enumerate(nodes):
        if x.blocks:
            joined = " ".join(b for _, b in x.blocks)
            own[i, :5] = len(joined), joined.count(" ") + 1, len(x.blocks), x.links, len(_ENDS.findall(joined))
        own[i, 5] = 1
        for g in x.tokens:
            flags[i, g] = 1
        if x.tag in TAGS:
            tags[i, TAGS.index(x.tag)] = 1
        said[i, 0] = _is_named_bad(x)
        if x.parent:
            p = parent[i]
            said[i, 1] = max(said[p, 0], said[p, 1])
            around[i] = around[p]
            around[i, :groups] = np.maximum(around[i, :groups], flags[p])
            around[i, groups] = max(around[i, groups], x.parent.tag in _BAD_TAGS)
            around[i, groups + 1] = max(around[i, groups + 1], x.parent.tag in _ARTICLE_TAGS)
    below = own.copy()
    for i in range(n - 1, 0, -1):
        below[parent[i]] += below[i]
    siblings = np.array([len(x.parent.children) if x.parent else 1 for x in nodes])
    index = np.array([x.index for x in nodes])
    alike = np.array([sum(c.tag == x.tag for c in x.parent.children[max(0, x.index - 3) : x.index + 4]) if x.parent else 1 for x in nodes])
    beside = np.where(parent >= 0, below[np.maximum(parent, 0), 0], below[0, 0])
    ratio = lambda a, b: a / np.maximum(b, 1)
    numeric = np.stack(
        [
            np.array([x.depth for x in nodes]), index, siblings, ratio(index, siblings), alike, np.log1p(below[:, 0]), np.log1p(own[:, 0]), ratio(below[:, 0], below[:, 5]),
            ratio(below[:, 3], below[:, 0]), ratio(below[:, 4], below[:, 1]) * 10, ratio(below[:, 1], below[:, 2]), np.log1p(below[:, 5]), ratio(below[:, 0], beside), ratio(below[:, 0], below[0, 0]),
        ],
        1,
    )
    return np.concatenate([said, numeric, flags, around, tags], 1)


def weak_labels(nodes: list[Node]) -> np.ndarray | None:
    """1 in the article, by the first cue that the page has, 0 outside; None for a page without any prose."""
    place = {id(x): i for i, x in enumerate(nodes)}
    parent = [place[id(x.parent)] if x.parent else -1 for x in nodes]
    bad = np.zeros(len(nodes), bool)
    prose = np.array([float(max(0, sum(len(b) for _, b in x.blocks) - x.links)) for x in nodes])
    marked = [i for i, x in enumerate(nodes) if x.tag in _ARTICLE_TAGS]
    for i, x in enumerate(nodes):
        bad[i] = _is_named_bad(x) or (i > 0 and bad[parent[i]])
    prose[bad] = 0
    for i in range(len(nodes) - 1, 0, -1):
        prose[parent[i]] += prose[i]
    named = [i for i, x in enumerate(nodes) if not bad[i] and _ARTICLE in x.tokens and prose[i] * 2 >= prose[0]]
    if not marked and not prose[0]:
        return None
    regions = set(marked or named[-1:] or [_densest(nodes, place, prose, bad)])
    out = np.zeros(len(nodes))
    inside = np.zeros(len(nodes), bool)
    for i, x in enumerate(nodes):
        inside[i] = i in regions or (i > 0 and inside[parent[i]])
        out[i] = inside[i] and not bad[i]
        if x.tag == "header" and not inside[i]:
            bad[i] = True
    return out


def _densest(nodes: list[Node], place: dict[int, int], prose: np.ndarray, bad: np.ndarray) -> int:
    """The innermost container on the way down that holds nearly all prose of the one around it."""
    at = 0
    while True:
        inner = [place[id(c)] for c in nodes[at].children if c.tag in _CONTAINERS]
        inner = [i for i in inner if not bad[i] and prose[i] >= _NEARLY_ALL * prose[at]]
        if not inner:
            return at
        at = inner[0]


def disguised(nodes: list[Node], labels: np.ndarray, unwrap: bool, plain: bool) -> tuple[list[Node], np.ndarray]:
    """The page with what says "article" taken out: its elements renamed or (``unwrap``) left out; ``plain``: without any
    telling tag or token."""
    new: dict[int, Node] = {}
    out, kept = [], []
    for i, x in enumerate(nodes):
        up = new[id(x.parent)] if x.parent else None
        if unwrap and up and (x.tag in _ARTICLE_TAGS or _ARTICLE in x.tokens) and labels[i]:
            new[id(x)] = up
            up.blocks += x.blocks
            up.links += x.links
            continue
        tag = "div" if x.tag in (_TELLING if plain else _ARTICLE_TAGS) else x.tag
        y = new[id(x)] = Node(tag, up, frozenset() if plain else x.tokens - {_ARTICLE})
        y.blocks, y.links = list(x.blocks), x.links
        out.append(y)
        kept.append(labels[i])
    return out, np.array(kept)


OUT, IN, REJECTED = 0, 1, 2


def decode(nodes: list[Node], probability: np.ndarray) -> np.ndarray:
    """Most probable labelling: each node is outside the article (its children are free), in it (children in it or rejected) or
    rejected (so are its children).  Nodes with text of their own count by it, others little."""
    p = np.clip(probability, 1e-6, 1 - 1e-6)
    weight = np.array([0.25 + np.log1p(sum(len(b) for _, b in x.blocks)) for x in nodes])
    yes, no = weight * np.log(p), weight * np.log(1 - p)
    place = {id(x): i for i, x in enumerate(nodes)}
    gain = np.stack([no, yes, no], 1)
    choice = np.zeros((len(nodes), 3), np.int64)
    for i in range(len(nodes) - 1, 0, -1):
        up = place[id(nodes[i].parent)]
        o, a, r = gain[i]
        free = (OUT, IN, REJECTED)[int(np.argmax((o, a, r)))]
        inner = IN if a >= r else REJECTED
        choice[i] = free, inner, REJECTED
        gain[up] += gain[i][choice[i]]
    out = np.zeros(len(nodes), np.int64)
    out[0] = IN if gain[0][IN] > gain[0][OUT] else OUT
    for i in range(1, len(nodes)):
        out[i] = choice[i, out[place[id(nodes[i].parent)]]]
    return out == IN


def texts(pages: list[list[Node]], model: trees.Boosted) -> list[str]:
    """Main texts of parsed pages; the trees see all their nodes at once."""
    rows = [features(nodes) for nodes in pages]
    if not rows:
        return []
    probability = model.probability(np.concatenate(rows))
    out, at = [], 0
    for nodes, x in zip(pages, rows, strict=True):
        kept = decode(nodes, probability[at : at + len(x)])
        at += len(x)
        blocks = sorted(b for node, keep in zip(nodes, kept, strict=True) if keep for b in node.blocks)
        out.append("\n".join(b for _, b in blocks))
    return out


def train(pages: DataFrame, html: str = "html", limit: int = TRAIN_PAGES, chars: int = TRAIN_CHARS) -> trees.Boosted:
    """Trees from at most ``limit`` pages of at most ``chars`` characters, taken by hash."""
    usable = pages.select(F.col(html).alias("html")).filter(F.length("html").between(1, chars))
    share = min(1.0, 2 * limit / max(1, usable.count()))
    # By hash: first a share that holds enough, then its smallest hashes.
    sample = usable.withColumn("u", unit_hash("html")).filter(F.col("u") <= share).orderBy("u", "html").limit(limit)
    xs, ys, held = [], [], 0
    for row in sample.select("html").collect():
        nodes = parse(row["html"])
        if (y := weak_labels(nodes)) is None or held + len(nodes) > TRAIN_NODES:
            continue
        held += len(nodes)
        for part, labels in ((nodes, y), disguised(nodes, y, False, False), disguised(nodes, y, True, False), disguised(nodes, y, False, True)):
            xs.append(features(part))
            ys.append(labels)
    if not xs:
        return trees.fit(np.empty((0, 1)), np.empty(0))
    return trees.fit(np.concatenate(xs), np.concatenate(ys), depth=DEPTH)


def _groups(pages: Iterator[list[Node]]) -> Iterator[list[list[Node]]]:
    """Pages in groups of about ``HELD_NODES`` nodes."""
    group, held = [], 0
    for nodes in pages:
        if group and held + len(nodes) > HELD_NODES:
            yield group
            group, held = [], 0
        group.append(nodes)
        held += len(nodes)
    yield group


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", model: trees.Boosted | None = None) -> DataFrame:
    """``(key, url, text)`` for every row."""
    model = model or train(pages, html)
    slim = pages.select(F.col(key), F.col(url), F.coalesce(F.col(html), F.lit("")).alias("_html"))
    told = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for group in _groups(parse(x.as_py()) for x in batch.column(2)):
                part = batch.slice(at, len(group))
                at += len(group)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts(group, told.value), pa.string())], [key, url, "text"])

    kinds = [f.dataType.simpleString() for f in slim.schema]
    return slim.mapInArrow(run, f"`{key}` {kinds[0]}, `{url}` {kinds[1]}, text string")
