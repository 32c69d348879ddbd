"""Main text of web pages by gradient-boosted trees over DOM nodes, with hierarchical decoding.

Each element is described by subtree densities (text, links, tags, sentences), tokens of its tag and attributes, depth, and
statistics of its siblings. Boosted trees, trained here on pages built by `practice_pages` (articles of many layouts between
menus, notices, adverts, forms, sidebars, comments and footers, whose parts are known), give each element the log-odds of
being main content. Decoding goes through the tree once: the best set of kept subtrees is chosen from the leaves upwards, so
an element is kept or dropped as a whole wherever that scores best, and no kept element lies in a dropped one.
"""

from __future__ import annotations

import html as entities
import random
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.llm.common import base_columns, small_batches, table

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is no markup and never text.
RAW = frozenset("script style noscript template textarea title iframe svg math canvas object select".split())
BLOCKS = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
#: An open element of these ends when one of the second begins.
CLOSES = {
    "p": BLOCKS,
    "li": frozenset({"li"}),
    "dt": frozenset({"dt", "dd"}),
    "dd": frozenset({"dt", "dd"}),
    "tr": frozenset({"tr", "tbody", "tfoot"}),
    "td": frozenset({"td", "th", "tr"}),
    "th": frozenset({"td", "th", "tr"}),
    "option": frozenset({"option"}),
}
#: A tag's attributes. A quoted value ends at its quote only where a blank, a slash or the tag's end follows; else the quote is
#: part of a value without quotes.
_ATTRIBUTES = r"(?:[\s/]+|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:\"[^\"]*+\"(?=[\s/>])|'[^']*+'(?=[\s/>])|[^\s>]*+))?+)*+"
_TOKEN = re.compile(rf"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*+)({_ATTRIBUTES})(?:>|\Z)", re.S)
#: Of RAW, those that reach to the page's end where no end tag follows; the others nest and may be left open.
TO_THE_END = frozenset("script style textarea title iframe".split())
_ATTRIBUTE = re.compile(r"(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
#: What is not shown is not main text.
_HIDDEN = re.compile(r"(?:^|[\s\"'])hidden(?=[\s=/]|$)(?!\s*=\s*[\"']?until-found)|style\s*=\s*(?:\"[^\"]*|'[^']*|\S*)(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.I)
_CLOSED = re.compile(r"(?:^|[\s\"'])/\s*$")
_SPACE = re.compile(r"\s+")
_SPLIT = re.compile(r"[^a-z0-9]+")

#: Attribute and tag tokens by what they usually mark.
MAIN_TOKENS = frozenset("article main content post entry story body text articlebody maincontent".split())
REST_TOKENS = frozenset("nav navbar menu header footer sidebar aside ad ads advert advertisement promo sponsor sponsored banner cookie cookies notice consent popup modal comment comments reply replies disqus share social related recommended breadcrumb breadcrumbs widget newsletter subscribe signup login search form pager pagination tags copyright legal toolbar navigation complementary contentinfo".split())


class Node:
    __slots__ = ("tag", "attrs", "children", "parent", "depth", "chars", "link_chars", "tags", "stops", "paragraphs", "inline", "gone")

    def __init__(self, tag: str, attrs: str, parent: Node | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Node | str] = []
        self.depth = parent.depth + 1 if parent else 0
        self.inline = tag not in BLOCKS
        #: never text: by its tag, or because it is not shown
        self.gone = tag in RAW or bool(attrs and _HIDDEN.search(attrs))


def parse(html: str) -> Node:
    """The element tree, of any depth; unclosed and stray tags are taken as browsers mostly take them."""
    root = node = Node("html", "", None)
    at, n = 0, len(html)
    #: open elements by tag, so that stray end tags cost nothing
    opened: Counter[str] = Counter()
    ends: dict[str, dict[int, int]] = {}
    while at < n:
        m = _TOKEN.search(html, at)
        if m is None:
            node.children.append(html[at:])
            break
        if m.start() > at:
            node.children.append(html[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if opened[tag]:
                up = node
                while up.tag != tag:
                    up = up.parent
                if not (tag not in BLOCKS and _crosses(node, up)):
                    node = _closed(node, up, opened)
            continue
        if tag == "html":
            continue
        while node.parent is not None:
            closer = node
            while closer.parent is not None and closer.inline and tag in BLOCKS:
                closer = closer.parent
            if tag in CLOSES.get(closer.tag, ()):
                node = _closed(node, closer, opened)
            else:
                break
        new = Node(tag, m[3] or "", node)
        node.children.append(new)
        if tag in TO_THE_END:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(html, at)
            at = end.end() if end else n
        elif tag in RAW:
            if tag not in ends:
                ends[tag] = _ends(html, tag)
            at = ends[tag].get(m.start(), at)  # self-closed or left open: it holds nothing
        elif tag not in VOID and not _CLOSED.search(m[3] or ""):
            node = new
            opened[tag] += 1
    return root


def _closed(node: Node, up: Node, opened: Counter[str]) -> Node:
    """The element around `up`, once all from `node` to `up` are closed."""
    while node is not up.parent:
        opened[node.tag] -= 1
        node = node.parent
    return node


def _ends(html: str, tag: str) -> dict[int, int]:
    """Of all elements of a tag that are closed: where the start tag begins, and where the end tag of the same depth ends."""
    found, open_ = {}, []
    for m in re.finditer(rf"<(/?){tag}(?=[\s/>])({_ATTRIBUTES})(?:>|\Z)", html, re.I):
        if not m[1]:
            if not (tag in ("svg", "math") and _CLOSED.search(m[2])):
                open_.append(m.start())
        elif open_:
            found[open_.pop()] = m.end()
    return found


def _crosses(node: Node, up: Node) -> bool:
    """Whether a block lies open between an inline element and its end tag."""
    while node is not up:
        if node.tag in BLOCKS:
            return True
        node = node.parent
    return False


def nodes_of(root: Node) -> list[Node]:
    """All elements, parents first."""
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        out.append(node)
        stack += [c for c in reversed(node.children) if isinstance(c, Node)]
    return out


@lru_cache(1 << 14)
def _marks(tag: str, attrs: str) -> tuple[int, int]:
    """(tokens that mark main content, tokens that mark the rest)."""
    found = set()
    for m in _ATTRIBUTE.finditer(attrs):
        found.update(_SPLIT.split((m[2] or m[3] or m[4] or "").lower()))
    found.add(tag)
    return len(found & MAIN_TOKENS), len(found & REST_TOKENS)


KINDS = ("p", "h", "li", "div", "a", "article", "nav", "table", "form")
N_FEATURES = 20 + len(KINDS)


def features(nodes: list[Node]) -> np.ndarray:
    """One row for each element."""
    for node in reversed(nodes):
        text = [c for c in node.children if isinstance(c, str)]
        node.chars = sum(len(t.strip()) for t in text)
        node.stops = sum(t.count(". ") + t.count(".") + t.count("!") + t.count("?") + t.count(",") for t in text)
        node.link_chars = node.tags = node.paragraphs = 0
        for c in node.children:
            if isinstance(c, Node):
                node.chars += c.chars
                node.stops += c.stops
                node.link_chars += c.link_chars
                node.tags += c.tags + 1
                node.paragraphs += c.paragraphs
        node.paragraphs += node.tag == "p"
        if node.tag == "a":
            node.link_chars = node.chars
        if node.gone:
            node.chars = node.stops = node.link_chars = 0
    total = max(nodes[0].chars, 1)
    out = np.zeros((len(nodes), N_FEATURES))
    number = {id(x): i for i, x in enumerate(nodes)}
    inherited = np.zeros((len(nodes), 3))
    by_tag = {id(x): Counter(c.tag for c in x.children if isinstance(c, Node)) for x in nodes}
    for i, x in enumerate(nodes):
        main, rest = _marks(x.tag, x.attrs)
        up = number[id(x.parent)] if x.parent else -1
        above = inherited[up] if up >= 0 else np.zeros(3)
        inherited[i] = (above[0] + main, above[1] + rest, above[2] + (x.tag in ("a", "li")))
        siblings = by_tag[id(x.parent)].total() if x.parent else 0
        same = by_tag[id(x.parent)][x.tag] if x.parent else 0
        chars = x.chars
        out[i, :20] = (
            np.log1p(chars), chars / total, x.link_chars / (chars + 1), chars / (x.tags + 1), x.stops / (chars + 1) * 100, np.log1p(x.paragraphs),
            np.log1p(x.tags), x.depth, main, rest, above[0], above[1], above[2], siblings, same,
            chars / (x.parent.chars + 1) if x.parent else 1, x.parent.link_chars / (x.parent.chars + 1) if x.parent else 0,
            np.log1p(x.parent.chars) if x.parent else 0, np.log1p(x.stops), x.gone,
        )
        kind = "h" if re.fullmatch("h[1-6]", x.tag) else x.tag
        if kind in KINDS:
            out[i, 20 + KINDS.index(kind)] = 1
    return out


class Boosted:
    """Gradient-boosted regression trees of fixed depth on the logistic loss, over binned features."""

    def __init__(self, rounds: int = 40, depth: int = 4, rate: float = 0.3, bins: int = 32):
        self.rounds, self.depth, self.rate, self.bins = rounds, depth, rate, bins

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        self.edges = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins + 1)[1:-1])) for c in x.T]
        b = np.column_stack([np.searchsorted(e, c, "left") for e, c in zip(self.edges, x.T, strict=True)])
        self.bias = float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
        score, self.trees = np.full(len(y), self.bias), []
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-score))
            g, h = y - p, p * (1 - p)
            at, split = np.zeros(len(y), np.int64), []
            for level in range(self.depth):
                n = 1 << level
                feature, cut_ = np.zeros(n, np.int64), np.full(n, self.bins, np.int64)
                best = np.full(n, 1e-9)
                for f in range(x.shape[1]):
                    key = at * self.bins + b[:, f]
                    gs, hs = (np.bincount(key, v, n * self.bins).reshape(n, -1).cumsum(1) for v in (g, h))
                    ga, ha = gs[:, -1:], hs[:, -1:]
                    gain = gs**2 / (hs + 1) + (ga - gs) ** 2 / (ha - hs + 1) - ga**2 / (ha + 1)
                    c = gain[:, :-1].argmax(1)
                    top = gain[np.arange(n), c]
                    better = top > best
                    best[better], feature[better], cut_[better] = top[better], f, c[better]
                split.append((feature, cut_))
                at = at * 2 + (b[np.arange(len(y)), feature[at]] > cut_[at])
            n = 1 << self.depth
            leaf = self.rate * np.bincount(at, g, n) / (np.bincount(at, h, n) + 1)
            score += leaf[at]
            self.trees.append((split, leaf))
        return self

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Log-odds."""
        b = np.column_stack([np.searchsorted(e, c, "left") for e, c in zip(self.edges, x.T, strict=True)])
        out, row = np.full(len(x), self.bias), np.arange(len(x))
        for split, leaf in self.trees:
            at = np.zeros(len(x), np.int64)
            for feature, cut_ in split:
                at = at * 2 + (b[row, feature[at]] > cut_[at])
            out += leaf[at]
        return out


def practice_pages(n: int, seed: int = 7) -> Iterator[tuple[str, str]]:
    """(html, main text) of pages in many layouts, built from invented words."""
    r = random.Random(seed)
    syllables = "ta ren mo li sa ke vor un di pel ga no ri st el om ar ti en ba qu ze".split()
    word = lambda: "".join(r.choices(syllables, k=r.choice((1, 1, 2, 2, 3, 4))))

    def sentence(low: int = 3, high: int = 22) -> str:
        w = [word() + ("," if r.random() < 0.08 else "") for _ in range(r.randint(low, high))]
        return " ".join(w).capitalize().rstrip(",") + r.choice(("...", ".", ".", ".", "!", "?"))[-1:]

    def unstopped() -> str:
        """Words said again and again, and bits of text without a stop."""
        if r.random() < 0.4:
            return some((word(), f"{word()} |", f"{word()} {word()} |", " | ".join(word() for _ in range(6)))).capitalize()
        return " ".join(w for w in (word() for _ in range(r.randint(1, 6))) for _ in range(r.randint(5, 60))).capitalize()

    def prose() -> str:
        if r.random() < 0.08:
            return unstopped()
        t = " ".join(sentence(1) for _ in range(r.choice((1, 1, 1, 2, 3, 5, 8))))
        return t if r.random() < 0.9 else " ".join(w + r.choice(("&&&", "***", "$$$", "%%%")) for w in t.split())

    def inline(t: str) -> str:
        w = entities.escape(t, quote=False).split(" ")
        if len(w) > 4 and r.random() < 0.3:
            i = r.randrange(len(w) - 2)
            tag = r.choice(("b", "i", "em", "a href='/x'", "span", "strong"))
            w[i], w[i + 1] = f"<{tag}>{w[i]}", f"{w[i + 1]}</{tag.split()[0]}>"
        return " ".join(w)

    def links(k: int) -> str:
        return "<ul>" + "".join(f'<li><a href="/{word()}">{word()}</a></li>' for _ in range(k)) + "</ul>"

    def some(options: tuple[str, ...]) -> str:
        return r.choice(options)

    def clutter(kind: str) -> str:
        body = sentence()
        if kind == "nav":
            return some((f"<nav>{links(r.randint(3, 8))}</nav>", f'<div class="menu">{links(r.randint(3, 8))}</div>', f'<div id="nav-bar" role="navigation">{links(4)}</div>'))
        if kind == "head":
            return some((f"<header><h2>{word()}</h2>{links(3)}</header>", f'<div class="header"><a href="/">{word()}</a></div>', f"<header><p>{body}</p></header>"))
        if kind == "ad":
            tag, name = some(("div", "aside", "section")), some(("ad", "advert", "banner-ad", "promo", "sponsored"))
            return f'<{tag} class="{name}">{some((body, f"<p>{body}</p>", f"<a href=/b>{body}</a>"))}</{tag}>'
        if kind == "notice":
            return f'<div class="{some(("cookie-notice", "consent", "notice", "popup"))}"><p>{body}</p><button>{word()}</button></div>'
        if kind == "form":
            return f'<form action="/s"><label>{sentence(1, 4)}</label><input name=q><button>{word()}</button></form>'
        if kind == "side":
            return some((f'<aside><h3>{word()}</h3>{links(5)}<p>{body}</p></aside>', f'<div class="sidebar"><h3>{sentence(1, 4)}</h3><p>{prose()}</p></div>', f'<div class="related">{links(4)}</div>'))
        if kind == "comments":
            each = "".join(f'<div class="comment"><p class="by">{word()}</p><p>{prose()}</p></div>' for _ in range(r.randint(1, 4)))
            return some((f'<section id="comments"><h3>{word()}</h3>{each}</section>', f'<div class="comments">{each}</div>', f'<ol class="comment-list">{each.replace("div", "li")}</ol>'))
        return some((f"<footer>&copy; {word()} &middot; {body}</footer>", f'<div class="footer"><p>{body}</p>{links(3)}</div>', f"<footer><p>{body}</p></footer>"))

    for _ in range(n):
        blocks, parts = [], []
        title = sentence(2, 9) if r.random() < 0.95 else unstopped()
        if r.random() < 0.85:
            blocks.append(title)
            parts.append(f"<h1>{inline(title)}</h1>")
        for _ in range(r.choice((1, 1, 2, 4, 7, 12))):
            if r.random() < 0.1:
                t = sentence(1, 6)
                blocks.append(t)
                parts.append(f"<h2>{inline(t)}</h2>")
            if r.random() < 0.08:
                items = [sentence(1, 8) for _ in range(r.randint(2, 5))]
                blocks += items
                parts.append("<ul>" + "".join(f"<li>{inline(t)}</li>" for t in items) + "</ul>")
            if r.random() < 0.1:
                kind = some(("table", "table", "pre", "dl", "figure"))
                t, u = some((sentence(1, 5), f"{word()} = {r.randint(0, 9)}")), sentence(1, 9)
                if kind == "table":
                    short = lambda: some((sentence(1, 3), sentence(1, 4), word(), str(r.randint(0, 99)), r.choice("abcdxyz")))
                    rows = [(short(), short()) for _ in range(r.choice((1, 1, 2, 4)))]
                    blocks += [x for row in rows for x in row]
                    cell = some(("td", "th"))
                    parts.append("<table>" + some(("", "<tbody>")) + "".join(f"<tr><{cell}>{inline(a)}</{cell}><td>{inline(b)}</td></tr>" for a, b in rows) + "</table>")
                elif kind == "pre":
                    blocks.append(t)
                    parts.append(some((f"<pre>{inline(t)}</pre>", f"<pre><code>{inline(t)}</code></pre>")))
                elif kind == "dl":
                    blocks += [t, u]
                    parts.append(f"<dl><dt>{inline(t)}</dt><dd>{inline(u)}</dd></dl>")
                else:
                    blocks.append(t)
                    parts.append(f"<figure><img src=x.png><figcaption>{inline(t)}</figcaption></figure>")
            if r.random() < 0.05:
                parts.append(some((f'<div style="display:none">{sentence()}</div>', f"<p hidden>{sentence()}</p>")))
            t = prose()
            blocks.append(t)
            parts.append(some((f"<p>{inline(t)}</p>",) * 6 + (f"<p><b>{inline(t)}<br>", f"<div>{inline(t)}</div>", f"<blockquote>{inline(t)}</blockquote>")))
            if r.random() < 0.06:
                parts.append(clutter(some(("ad", "form"))))
        open_, close = some((("<article>", "</article>"),) * 4 + (("<main><article>", "</article></main>"), ("<main>", "</main>"), ('<div class="content">', "</div>"), ('<div id="main-content" class="post">', "</div>"), ('<div><div class="entry">', "</div></div>"), ("<section><div>", "</div></section>")))
        before = [clutter(k) for k in ("head", "nav", "ad", "notice", "form", "side") if r.random() < 0.45]
        after = [clutter(k) for k in ("comments", "side", "ad", "form", "foot", "nav") if r.random() < 0.45]
        yield f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{}}</style><script>var a='<p>';</script></head><body>{''.join(before)}{open_}{''.join(parts)}{close}{''.join(after)}</body></html>", "\n\n".join(blocks)


@lru_cache(1)
def trained(pages: int = 500) -> Boosted:
    """The trees, fitted in the driver on a fixed number of practice pages."""
    xs, ys = [], []
    for html, answer in practice_pages(pages):
        nodes = nodes_of(parse(html))
        wanted = set(answer.split("\n\n"))
        xs.append(features(nodes))
        share = {}
        for x in reversed(nodes):
            own = [_clean(t) for t in block_texts(x)] if x.tag in BLOCKS and x.tag not in ("html", "body") else []
            good = sum(len(t) for t in own if t in wanted)
            share[id(x)] = good / max(1, sum(map(len, own)))
        ys.append(np.array([float(share[id(x)] > 0.8) for x in nodes]))
    x, y = np.concatenate(xs), np.concatenate(ys)
    return Boosted().fit(x, y)


def _clean(text: str) -> str:
    return _SPACE.sub(" ", entities.unescape(text)).strip()


def block_texts(root: Node, dropped: frozenset[int] = frozenset()) -> list[str]:
    """Raw texts of the blocks below an element, in page order: runs of text and inline elements without a block between."""
    out, run = [], []
    stack: list[Node | str | None] = [root]
    while stack:
        x = stack.pop()
        if x is None:
            out.append("".join(run))
            run = []
        elif isinstance(x, str):
            run.append(x)
        elif id(x) in dropped or x.gone:
            continue
        elif x.tag == "br":
            run.append(" ")
        else:
            edge = [None] if x.tag in BLOCKS else []
            stack += edge + x.children[::-1] + edge
    out.append("".join(run))
    return [t for t in out if t.strip()]


def decode(nodes: list[Node], odds: np.ndarray) -> frozenset[int]:
    """Elements to drop with all below them. A block's own text is worth its log-odds times its length if kept, and nothing if
    dropped; each subtree is kept or dropped by the sum over what it keeps, decided from the leaves upwards."""
    value: dict[int, float] = {}
    drop = []
    # what surely is main content speaks for its parts
    odds = odds.copy()
    number = {id(x): i for i, x in enumerate(nodes)}
    for i, x in enumerate(nodes):
        if x.parent is not None:
            odds[i] += 0.5 * max(0.0, float(odds[number[id(x.parent)]]))
    for i in range(len(nodes) - 1, -1, -1):
        x = nodes[i]
        own = sum(len(c.strip()) for c in x.children if isinstance(c, str))
        holder = x
        worth = float(odds[i]) * own if holder.tag in BLOCKS else 0.0
        best = worth
        for c in x.children:
            if isinstance(c, Node):
                if c.inline and not c.gone:  # inline elements go with the block that holds them
                    best += float(odds[i]) * c.chars if not any(isinstance(k, Node) and not k.inline for k in c.children) else value[id(c)]
                else:
                    best += value[id(c)]
        value[id(x)] = max(best, 0.0)
        if best <= 0 and not x.inline:
            drop.append(id(x))
    return frozenset(drop)


def main_texts(pages: list[str], model: Boosted) -> list[str]:
    """For each page, the blocks of the main content, each with its white space collapsed, joined by empty lines."""
    trees = [nodes_of(parse(html)) for html in pages]
    if not trees:
        return []
    odds = model.predict(np.concatenate([features(nodes) for nodes in trees]))
    ends = np.cumsum([len(nodes) for nodes in trees])
    out = []
    for nodes, end in zip(trees, ends.tolist(), strict=True):
        kept = block_texts(nodes[0], decode(nodes, odds[end - len(nodes) : end]))
        out.append("\n\n".join(t for t in map(_clean, kept) if t))
    return out


def main_text(html: str, model: Boosted) -> str:
    return main_texts([html], model)[0]


def extract(pages: DataFrame) -> DataFrame:
    """pages (page_id, url, html) -> page_id, url, text, n_chars; one row for each page, equal pages and ids included.

    A null or empty page has no text. Elements that are not shown (hidden, display: none, visibility: hidden) are no main text.
    Extra columns play no part, whatever their names; an empty table gives no rows.
    """
    spark = pages.sparkSession
    small_batches(spark, 256)
    held = spark.sparkContext.broadcast(trained())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = main_texts([x or "" for x in b.column(2).to_pylist()], held.value)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return base_columns(pages, page_id=F.col("page_id").cast("long"), url="url", html="html").mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
