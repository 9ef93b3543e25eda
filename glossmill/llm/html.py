"""Main text of web pages: boosted trees over DOM nodes, decoded from the root down.

Every element gets features of its tag, its class, id and role tokens, its depth, its
subtree (text, links, tags) and its siblings, and those of what stands above it. The
trees give the log-odds that an element belongs to the article; navigation, asides,
footers and forms never do, but for a form or an aside that holds most of the text. Decoding picks the set of elements with the largest sum of log-odds in which every chosen element's
parent is chosen too, so no element is kept inside one that is not.

The model is trained on pages written here from a seeded grammar whose elements are
labelled as they are written; it is small, and goes to the tasks as one value.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from glossmill.llm.boosting import Boosted, train
from glossmill.llm.common import map_rows

#: Element kinds of HTML.
VOID = set("area base br col embed hr img input link meta source track wbr".split())
RAW = set("script style textarea title xmp noembed noframes iframe".split())
UNSEEN = RAW | set("head template noscript svg math object select datalist button canvas audio video".split())
BLOCK = set(
    "html body article section main div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table caption thead tbody tfoot tr"
    " td th blockquote pre figure figcaption address header footer nav aside form fieldset details summary hr"
    " hgroup search center menu".split()
)
#: Elements that are never article by what HTML says they mean, and those of them that some pages put their text in.
NEVER = set("nav aside footer form dialog menu".split())
WRAPPERS = {"form", "aside"}
#: An open element of the key that a start tag of one of the values closes.
CLOSED_BY = {
    "p": BLOCK - set("html body td th caption tr thead tbody tfoot".split()),
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "thead", "tbody", "tfoot"},
    "td": {"td", "th", "tr", "thead", "tbody", "tfoot"},
    "th": {"td", "th", "tr", "thead", "tbody", "tfoot"},
    "option": {"option", "optgroup"},
    "head": {"body"},
}
#: Elements that a closing rule or a stray end tag does not reach out of.
FENCE = set("html body table ul ol td th article section aside nav main footer header form div blockquote".split())

TAGS = (
    "article main section div p h1 h2 h3 h4 h5 h6 ul ol li table td blockquote pre figure figcaption header footer"
    " nav aside form details a b em span body html address dl label input".split()
)
AWAY = (
    "ad ads advert advertisement banner sponsor sponsored promo promotion nav navigation navbar menu header masthead"
    " footer foot sidebar side aside rail widget comment comments reply replies respond discussion disqus cookie consent"
    " gdpr notice alert popup modal overlay share sharing social related recommended more subscribe newsletter signup"
    " login search breadcrumb breadcrumbs pagination pager tags copyright legal toolbar skip outbrain".split()
)
TOWARDS = "article content main post entry body story text page prose markdown hentry blog news".split()
AWAY_TAGS = set("nav aside footer form header".split())

#: Comments and the like; a tag whose quotes are balanced; any other tag. No part can backtrack.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>",
    re.S,
)
#: One attribute, its name and value; values are passed over, so no name is found in them.
ATTRIBUTE = re.compile(r"""([^\s=/>"']++)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>]*+))?|["'][^\s]*+""")
WORDED = set("class id role itemprop".split())
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
#: Elements nested deeper than this stay leaves, as in browsers; their texts stay too.
MAX_DEPTH = 512
PAGES_AT_ONCE = 256


@dataclass
class Node:
    tag: str
    parent: int
    depth: int
    index: int = 0
    words: list[str] = field(default_factory=list)
    hidden: bool = False
    unseen: bool = False
    chars: int = 0
    link_chars: int = 0
    tags: int = 0
    links: int = 0
    marks: int = 0
    children: list[int] = field(default_factory=list)


def parse(page: str) -> tuple[list[Node], list[tuple[int, str]]]:
    """Elements in page order, the root first, and texts with the element they stand in."""
    nodes, texts = [Node("html", -1, 0)], []
    stack = [0]
    at = 0

    def text(raw: str) -> None:
        if raw and not nodes[stack[-1]].unseen:
            texts.append((stack[-1], html.unescape(raw)))

    while True:
        match = TOKEN.search(page, at)
        if match is None:
            text(page[at:])
            break
        text(page[at : match.start()])
        at = match.end()
        slash, name, attributes = match.group(1, 2, 3) if match[2] else match.group(4, 5, 6)
        tag = (name or "").lower()
        if match[0].startswith("<![CDATA["):
            text(match[0][9:].removesuffix("]]>"))
            continue
        if not tag:
            continue
        if slash:
            _end(nodes, stack, tag)
            continue
        if tag in ("html", "body") and any(nodes[i].tag == tag for i in stack):
            continue
        _close_before(nodes, stack, tag)
        parent = stack[-1]
        node = Node(tag, parent, nodes[parent].depth + 1, len(nodes[parent].children))
        _read_attributes(node, attributes)
        node.unseen = tag in UNSEEN or nodes[parent].unseen
        nodes[parent].children.append(len(nodes))
        nodes.append(node)
        if tag == "br":
            texts.append((len(nodes) - 1, " "))
        if tag in VOID or (len(stack) > MAX_DEPTH and tag not in RAW):
            continue
        stack.append(len(nodes) - 1)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>|\Z", re.I).search(page, at)
            at = end.end()
            stack.pop()
    return nodes, texts


def _close_before(nodes: list[Node], stack: list[int], tag: str) -> None:
    i = len(stack) - 1
    while i:
        open_tag = nodes[stack[i]].tag
        if tag in CLOSED_BY.get(open_tag, ()):
            del stack[i:]
        elif open_tag in FENCE:
            return
        i -= 1


def _end(nodes: list[Node], stack: list[int], tag: str) -> None:
    for i in range(len(stack) - 1, 0, -1):
        open_tag = nodes[stack[i]].tag
        if open_tag == tag:
            del stack[i:]
            return
        if open_tag in FENCE and tag not in FENCE:
            return


def _read_attributes(node: Node, raw: str) -> None:
    for name, value in ATTRIBUTE.findall(raw):
        value = value.strip("\"'")
        name = name.lower()
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            node.hidden = True
        elif name in WORDED:
            node.words += [w.lower() for w in WORDS.findall(value)]


def _frames(node: Node, page_chars: int) -> bool:
    """Whether the node is a form or an aside around most of the page's text; the trees see it as a `div`."""
    return node.tag in WRAPPERS and 2 * node.chars > page_chars


def features(nodes: list[Node], texts: list[tuple[int, str]]) -> np.ndarray:
    """One row per element."""
    for i, t in texts:
        node = nodes[i]
        size = len(t.strip())
        node.chars += size
        node.marks += sum(map(t.count, ".,;:!?"))
    for i in range(len(nodes) - 1, 0, -1):
        node, parent = nodes[i], nodes[nodes[i].parent]
        node.tags += 1
        if node.tag == "a":
            node.link_chars, node.links = node.chars, node.links + 1
        parent.chars += node.chars
        parent.link_chars += node.link_chars
        parent.tags += node.tags
        parent.links += node.links
        parent.marks += node.marks
    page = max(1, nodes[0].chars)
    out = np.zeros((len(nodes), len(TAGS) + 22))
    away_above = np.zeros((len(nodes), 3))
    alike = Counter((node.parent, node.tag) for node in nodes[1:])
    for i, node in enumerate(nodes):
        parent = nodes[node.parent] if i else node
        row = out[i]
        tag = "div" if _frames(node, page) else node.tag
        if tag in TAGS:
            row[TAGS.index(tag)] = 1
        away = sum(w in AWAY for w in node.words)
        towards = sum(w in TOWARDS for w in node.words)
        if i:
            away_above[i] = away_above[node.parent]
        own = (away > 0, towards > 0, tag in AWAY_TAGS)
        row[len(TAGS) :] = (
            away,
            towards,
            tag in AWAY_TAGS,
            *away_above[i],
            node.depth,
            np.log1p(node.chars),
            node.chars / page,
            node.link_chars / max(1, node.chars),
            node.chars / (1 + node.tags),
            node.marks / max(1, node.chars),
            node.tags,
            node.links,
            node.index,
            node.index / max(1, len(parent.children) - 1),
            len(parent.children),
            alike[node.parent, node.tag],
            np.log1p(parent.chars / max(1, len(parent.children))),
            node.chars / max(1, parent.chars),
            parent.link_chars / max(1, parent.chars),
            float(parent.tag in ("article", "main")),
        )
        away_above[i] = np.maximum(away_above[i], own)
    return out


def decode(nodes: list[Node], log_odds: np.ndarray) -> np.ndarray:
    """The best set of elements that holds the parent of each of its members, the root included."""
    never = [n.tag in NEVER and not _frames(n, nodes[0].chars) for n in nodes]
    weight = np.where([n.unseen or n.hidden or no for n, no in zip(nodes, never)], -np.inf, log_odds)
    weight[0] = 0.0
    best = weight.copy()
    for i in range(len(nodes) - 1, 0, -1):
        if best[i] > 0:
            best[nodes[i].parent] += best[i]
    kept = np.zeros(len(nodes), bool)
    kept[0] = True
    for i in range(1, len(nodes)):
        kept[i] = kept[nodes[i].parent] and best[i] > 0
    return kept


def blocks(nodes: list[Node], texts: list[tuple[int, str]], kept: np.ndarray) -> Iterator[str]:
    """Texts of kept elements, joined inside a block; an element of a block kind ends one."""
    owner = list(range(len(nodes)))
    for i, node in enumerate(nodes):
        if i and node.tag not in BLOCK:
            owner[i] = owner[node.parent]
    held, last = [], None
    entered = -1
    for i, t in texts:
        # A block element between two texts of one block splits it.
        split = owner[i] != last or any(nodes[j].tag in BLOCK for j in range(entered + 1, i + 1) if nodes[j].tag != "html")
        if split and held:
            yield " ".join("".join(held).split())
            held = []
        last, entered = owner[i], max(entered, i)
        if kept[i]:
            held.append(t)
    if held:
        yield " ".join("".join(held).split())


def main_texts(pages: list[str | None], model: Boosted) -> Iterator[str]:
    """The article of each page; a null or empty page has none."""
    for at in range(0, len(pages), PAGES_AT_ONCE):
        parsed = [parse(p or "") for p in pages[at : at + PAGES_AT_ONCE]]
        log_odds = model.log_odds(np.concatenate([features(*p) for p in parsed]))
        ends = np.cumsum([len(nodes) for nodes, _ in parsed])
        for (nodes, texts), odds in zip(parsed, np.split(log_odds, ends[:-1])):
            yield "\n\n".join(b for b in blocks(nodes, texts, decode(nodes, odds)) if b)


def extract(pages: DataFrame, model: Boosted | None = None) -> DataFrame:
    """`page_id, url, text, n_chars` of every row of `pages(page_id, url, html)`.

    A null or empty html gives an empty text; ids and urls pass as they are, repeated
    rows stay, other columns are ignored.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model or page_model())

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = []
        for at in range(0, batch.num_rows, PAGES_AT_ONCE):
            found += main_texts(batch.column(2).slice(at, PAGES_AT_ONCE).to_pylist(), shared.value)
        return pa.record_batch(
            {
                "page_id": batch.column(0),
                "url": batch.column(1),
                "text": pa.array(found, pa.string()),
                "n_chars": pa.array([len(t) for t in found], pa.int64()),
            }
        )

    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return map_rows(rows, run, "page_id long, url string, text string, n_chars long")


class Grammar:
    """Writes pages of many layouts and tells for every element whether it is article."""

    SYLLABLES = "ba co de fi gu la me ni or pu ra se ti us ven wal xe yo zi qua the and of in".split()

    def __init__(self, seed: int):
        self.random = np.random.default_rng(seed)
        self.out: list[str] = []
        self.labels: list[int] = []

    def pick(self, *options):
        return options[self.random.integers(len(options))]

    def chance(self, p: float) -> bool:
        return self.random.random() < p

    def words(self, low: int, high: int) -> str:
        n = self.random.integers(low, high + 1)
        w = ["".join(self.random.choice(self.SYLLABLES, self.random.integers(1, 4))) for _ in range(n)]
        for i in range(self.random.integers(5, 14), n, 11):
            w[i - 1] += self.pick(",", ".", ".", ";")
        if self.chance(0.15):
            w = [x + self.pick("***", "###", "%%%", "!!", " |") for x in w]
        if self.chance(0.1):
            w = [x.upper() for x in w]
        return " ".join(w).capitalize() + self.pick(".", ".", "", "!")

    def element(self, tag: str, inside, label: int, names: str = "") -> None:
        kind = self.pick("class", "class", "id")
        self.out.append(f"<{tag}{f' {kind}=\"{names}\"' if names else ''}>")
        self.labels.append(label)
        if callable(inside):
            inside()
        else:
            self.out.append(inside)
        if tag not in VOID:
            self.out.append(f"</{tag}>")

    def page(self) -> tuple[str, list[int]]:
        """Labels follow the order of the elements; the root and unseen elements have none."""
        self.out, self.labels = [], []
        self.element("body", self._body, 1)
        return "<html><head><title>x</title></head>" + "".join(self.out) + "</html>", self.labels

    def _body(self) -> None:
        if self.chance(0.6):
            self._site_header()
        for _ in range(self.random.integers(0, 4)):
            self._away()
        wrap = self.chance(0.5)
        if wrap:
            self.element(self.pick("div", "main", "section"), self._middle, 1, self.pick("", "wrapper", "container", "content", "page", "site", "main"))
        else:
            self._middle()
        for _ in range(self.random.integers(0, 4)):
            self._away()
        if self.chance(0.8):
            self.element(self.pick("footer", "footer", "div"), self._footer, 0, self.pick("footer", "site-footer", "foot legal"))

    def _middle(self) -> None:
        if self.chance(0.3):
            self._away()
        tag = self.pick("article", "article", "main", "div", "section", "div")
        names = self.pick("", "post", "article", "entry-content", "story body", "main-content", "text") if tag in ("article", "main") else self.pick("post", "article-body", "entry-content", "story", "main-content", "content", "post-text")
        self.element(tag, self._article, 1, names)
        if self.chance(0.4):
            self._away()

    def _article(self) -> None:
        inner = lambda label=1: self._inline(self.words(4, 90), label)
        if self.chance(0.3):
            self.element("header", lambda: self.element("h1", self.words(2, 9), 1), 1, self.pick("", "entry-title", "article-header"))
        elif self.chance(0.85):
            self.element(self.pick("h1", "h1", "h2"), self.words(1, 10), 1, self.pick("", "", "title", "headline"))
        for _ in range(self.random.integers(1, 12)):
            what = self.random.random()
            if what < 0.68:
                self.element("p", inner, 1, self.pick("", "", "", "lead", "text"))
            elif what < 0.73:
                self.element("p", self.words(1, 3), 1)
            elif what < 0.79:
                self.element(self.pick("h2", "h3"), self.words(1, 7), 1)
            elif what < 0.85:
                self.element(self.pick("ul", "ol"), lambda: [self.element("li", self.words(2, 20), 1) for _ in range(self.random.integers(2, 6))], 1)
            elif what < 0.88:
                self.element("blockquote", lambda: self.element("p", inner, 1), 1)
            elif what < 0.90:
                self.element("pre", self.words(4, 20), 1)
            elif what < 0.93:
                self.element("figure", lambda: self.element("figcaption", self.words(2, 12), 1), 1)
            elif what < 0.935:
                self.element("table", lambda: [self.element("tr", lambda: [self.element("td", self.words(1, 4), 1) for _ in range(3)], 1) for _ in range(3)], 1)
            elif what < 0.94:
                self.element("div", lambda: self.element("p", inner, 1), 1, self.pick("", "section", "text", "paragraph"))
            else:
                self._away()

    def _inline(self, text: str, label: int) -> None:
        if self.chance(0.25):
            self.element(self.pick("b", "em", "a", "span", "a"), self.words(1, 4), label)
        self.out.append(text)
        if self.chance(0.1):
            self.element(self.pick("b", "a"), self.words(1, 4), label)

    def _links(self, label: int = 0) -> None:
        def items() -> None:
            for _ in range(self.random.integers(2, 9)):
                self.element("li", lambda: self.element("a", self.words(1, 2), label), label)

        if self.chance(0.7):
            self.element("ul", items, label)
        else:
            for _ in range(self.random.integers(2, 8)):
                self.element("a", self.words(1, 2), label)

    def _site_header(self) -> None:
        def inside() -> None:
            if self.chance(0.7):
                self.element(self.pick("h1", "div", "a", "p", "span"), self.words(1, 4), 0, self.pick("", "logo", "brand", "site-title"))
            if self.chance(0.6):
                self.element("nav", self._links, 0)

        self.element(self.pick("header", "header", "div"), inside, 0, self.pick("header", "masthead", "site-header", "top banner"))

    def _footer(self) -> None:
        if self.chance(0.4):
            self._links()
        self.element("p", "&copy; " + self.words(2, 25), 0) if self.chance(0.6) else self.out.append("&copy; " + self.words(2, 25))

    def _text_in(self, low: int, high: int) -> None:
        for _ in range(self.random.integers(1, 4)):
            if self.chance(0.7):
                self.element(self.pick("p", "p", "div", "h3", "span"), self.words(low, high), 0)
            else:
                self.out.append(self.words(low, high))

    def _away(self) -> None:
        kind = self.random.integers(8)
        if kind == 0:
            tag = self.pick("nav", "nav", "div")
            names = ("menu", "nav", "main-menu", "breadcrumbs")
            self.element(tag, self._links, 0, self.pick("", *names) if tag == "nav" else self.pick(*names))
        elif kind == 1:
            self.element(self.pick("div", "div", "aside", "section", "p"), lambda: self.out.append(self.words(2, 40)), 0, self.pick("ad", "ads", "advert", "banner", "sponsored", "promo box", "ad-slot"))
        elif kind == 2:
            self.element("aside", lambda: (self._text_in(2, 25), self._links()), 0, self.pick("", "sidebar", "widget", "related"))
        elif kind == 3:
            self.element(self.pick("div", "div", "section"), lambda: (self._text_in(2, 20), self._links()), 0, self.pick("sidebar", "side-rail", "widget", "related", "recommended", "share social"))
        elif kind == 4:
            def comments() -> None:
                if self.chance(0.6):
                    self.element("h3", self.words(1, 3), 0)
                for _ in range(self.random.integers(1, 6)):
                    self.element(self.pick("div", "li", "article"), lambda: self._text_in(3, 60), 0, self.pick("comment", "reply", "comment-body"))

            self.element(self.pick("div", "section", "ol", "div"), comments, 0, self.pick("comments", "comment-list", "discussion", "replies", "respond"))
        elif kind == 5:
            def fields() -> None:
                for _ in range(self.random.integers(0, 3)):
                    self.element("label", self.words(1, 3), 0)
                    self.element("input", "", 0)
                if self.chance(0.6):
                    self._text_in(1, 12)

            self.element("form", fields, 0, self.pick("", "search", "newsletter", "login", "subscribe"))
        elif kind == 6:
            self.element(self.pick("div", "div", "section", "p"), lambda: self.out.append(self.words(5, 50)), 0, self.pick("cookie-notice", "cookie consent", "notice", "alert", "gdpr banner", "popup", "newsletter-signup"))
        else:
            self.element(self.pick("div", "p"), lambda: self._links(), 0, self.pick("share", "social", "tags", "pagination", "breadcrumb", "toolbar"))


def labelled_pages(n: int, seed: int) -> Iterator[tuple[list[Node], np.ndarray, np.ndarray]]:
    """(elements, features, labels) of written pages; label -1 where an element has none."""
    grammar = Grammar(seed)
    for _ in range(n):
        page, labels = grammar.page()
        nodes, texts = parse(page)
        seen = [i for i, node in enumerate(nodes) if i and node.tag not in UNSEEN]
        if len(seen) != len(labels):
            continue  # the grammar wrote something that HTML closes early
        out = np.full(len(nodes), -1)
        out[seen] = labels
        yield nodes, features(nodes, texts), out


@lru_cache(maxsize=1)
def page_model(n_pages: int = 400, seed: int = 7) -> Boosted:
    """The model, trained on `n_pages` written pages."""
    pages = list(labelled_pages(n_pages, seed))
    x, y = np.concatenate([f for _, f, _ in pages]), np.concatenate([t for _, _, t in pages])
    return train(x[y >= 0], y[y >= 0].astype(float), n_trees=50)
