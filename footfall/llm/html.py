"""Main text of web pages: gradient-boosted trees judge the nodes of the page, a decoding over the tree decides.

Each element is measured: how dense its subtree is in text and in links, which words its name and attributes hold, how
deep it lies, how it compares with its siblings. Boosted trees turn that into the log-odds that its text belongs to the
article. Decoding looks for the choice of greatest sum in which nothing below a left-out element is taken.

No page is labelled. Training pages are made from a bounded sample of the paragraphs of real pages, put into layouts of
many kinds whose roles are known; the trees are fitted to their nodes.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from functools import lru_cache
from html import unescape

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import text_or_empty

#: Pages whose paragraphs are used to make training pages, and how many of those are made.
SAMPLE_PAGES, TRAINING_PAGES = 200, 600
TREES, DEPTH, BINS, RATE = 60, 4, 32, 0.2

# Names of HTML elements by how they are laid out.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template svg math iframe object canvas textarea select head title".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
CLOSED_BY_OWN_KIND = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("ul ol dl table tr tbody thead body html div section article aside main nav header footer form".split())
# Words in names, classes, ids and roles, by what they hint at.
HINTS = {
    "article": "article main content post entry story body text prose page blog news markdown hentry",
    "nav": "nav navigation menu menubar breadcrumb breadcrumbs toc tabs pagination pager skip links sitemap",
    "head": "header masthead banner logo branding topbar top hero",
    "foot": "footer foot colophon copyright legal bottom imprint credits",
    "side": "sidebar aside side rail widget related recommended recommendations more popular trending secondary complementary",
    "notice": "cookie cookies consent notice alert banner popup modal gdpr privacy overlay toast dialog warning",
    "advert": "ad ads advert adverts advertisement sponsor sponsored promo promotion advertorial adsbygoogle dfp",
    "form": "form newsletter subscribe subscription signup login search input button contact",
    "comment": "comment comments discussion reply replies responses disqus respond thread feedback",
    "share": "share social sharing follow tweet facebook byline author meta tags tag date",
    "hidden": "hidden none invisible sr visually",
}
_HINT = {word: i for i, words in enumerate(HINTS.values()) for word in words.split()}
_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>|</([a-zA-Z][^\s/>]*)[^>]*>|<([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)|\b(hidden)\b""")
_WORD = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")
_ROLES = ("class", "id", "role", "itemprop", "aria-label", "style", "hidden", "type")
_NAMES = ("p", "div", "span", "li", "ul", "ol", "a", "article", "main", "section", "nav", "header", "footer", "aside", "form", "h1", "h2", "h3", "blockquote", "pre", "table", "td", "figure", "figcaption", "button", "label")


class Node:
    __slots__ = ("name", "attributes", "parent", "children", "depth")

    def __init__(self, name: str, attributes: str, parent: Node | None):
        self.name, self.attributes, self.parent = name, attributes, parent
        self.children: list[Node | str] = []
        self.depth = parent.depth + 1 if parent else 0


def parse(html: str) -> Node:
    """The tree of elements. Unclosed elements end with what holds them; raw elements, comments and markup are left out."""
    root = current = Node("#page", "", None)
    at, n = 0, len(html)
    while at < n:
        found = _TOKEN.search(html, at)
        if not found:
            if html[at:].strip():
                current.children.append(html[at:])
            break
        if found.start() > at:
            current.children.append(html[at : found.start()])
        at = found.end()
        end, start = found.group(1), found.group(2)
        if end:
            name = end.lower()
            node = current
            while node.parent is not None and node.name != name:
                node = node.parent
            if node.parent is not None:
                current = node.parent
        elif start:
            name = start.lower()
            if name in RAW and name not in ("noscript", "head") or name in ("script", "style"):
                close = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(html, at)
                if not found.group(3).rstrip().endswith("/"):
                    at = close.end() if close else n
                continue
            if name in CLOSES_P or name in CLOSED_BY_OWN_KIND:
                closes = {"p"} if name in CLOSES_P else CLOSED_BY_OWN_KIND[name] | {"p"}
                node = current
                while node.parent is not None and node.name not in closes and (node.name not in SCOPES):
                    node = node.parent
                if node.name in closes and node.parent is not None:
                    current = node.parent
            node = Node(name, found.group(3), current)
            current.children.append(node)
            if name not in VOID and not found.group(3).endswith("/"):
                current = node
    return root


@lru_cache(maxsize=20_000)
def _hints(name: str, attributes: str) -> tuple[int, ...]:
    """Which kinds of hints an element's name and attributes give."""
    text = name
    if "=" in attributes or "hidden" in attributes:
        for key, value, flag in _ATTRIBUTE.findall(attributes):
            if flag or key.lower() in _ROLES:
                text += f" {value} {flag}"
    return tuple({_HINT[w] for w in _WORD.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", text).lower()) if w in _HINT})


FEATURES = 16 + 2 * len(HINTS) + len(_NAMES)


def measure(root: Node) -> tuple[list[Node], np.ndarray]:
    """The elements in page order with their features, and the hints of all that hold them."""
    nodes: list[Node] = []
    stack = [root]
    while stack:
        node = stack.pop()
        nodes.append(node)
        stack += [c for c in reversed(node.children) if isinstance(c, Node)]
    place = {id(node): i for i, node in enumerate(nodes)}
    n = len(nodes)
    parent = [place[id(x.parent)] if x.parent else 0 for x in nodes]
    own, stops = [0] * n, [0] * n
    for i, node in enumerate(nodes):
        for c in node.children:
            if isinstance(c, str):
                own[i] += len(c.strip())
                stops[i] += c.count(". ") + c.count(", ") + c.rstrip().endswith(".")
    text, link, tags, paragraphs = own.copy(), [0] * n, [1] * n, [int(x.name == "p") for x in nodes]
    siblings, longest = [0] * n, [0] * n
    for i in range(n - 1, 0, -1):  # children come after their parents
        p = parent[i]
        if nodes[i].name == "a":
            link[i] = text[i]
        text[p] += text[i]
        link[p] += link[i]
        tags[p] += tags[i]
        stops[p] += stops[i]
        paragraphs[p] += paragraphs[i]
        siblings[p] += 1
        longest[p] = max(longest[p], text[i])
    top, kinds = np.array(parent), len(HINTS)
    some = lambda x: np.maximum(1.0, np.array(x, float))
    t, o, l, g = (np.array(x, float) for x in (text, own, link, tags))
    depth = np.array([x.depth for x in nodes], float)
    x = np.zeros((n, FEATURES), np.float32)
    x[:, :16] = np.stack([
        np.log1p(t), t / some(t[0]), l / some(t), np.log1p(t / g), np.log1p(o), o / some(t), np.array(stops) / some(t) * 50, depth,
        depth / max(1.0, depth.max()), np.array(siblings)[top], t / some(t[top]), t / some(np.array(longest)[top]), np.arange(n) / n,
        np.log1p(np.array(paragraphs)), np.log1p(g), l[top] / some(t[top]),
    ], axis=1)
    above: list[frozenset[int]] = [frozenset()] * n
    for i, node in enumerate(nodes):
        hints = _hints(node.name, node.attributes)
        if i:
            above[i] = held = above[parent[i]]
            for h in held:
                x[i, 16 + kinds + h] = 1
        for h in hints:
            x[i, 16 + h] = 1
        if hints:
            above[i] = above[i] | frozenset(hints)
        name = _NAME.get(node.name)
        if name is not None:
            x[i, 16 + 2 * kinds + name] = 1
    return nodes, x


_NAME = {name: i for i, name in enumerate(_NAMES)}


class Trees:
    """Boosted regression trees on the log-odds; every tree is complete, of one depth, kept as arrays."""

    def __init__(self, start: float):
        self.start, self.features, self.cuts, self.leaves = start, [], [], []

    def odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for features, cuts, leaves in zip(self.features, self.cuts, self.leaves):
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (x[rows, features[at]] > cuts[at])
            out += leaves[at - (2**DEPTH - 1)]
        return out


def boost(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Trees:
    """Newton steps on the logistic loss over binned features."""
    share = float((weight * y).sum() / weight.sum())
    model = Trees(float(np.log(share / (1 - share))))
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    odds = np.full(len(x), model.start)
    inner = 2**DEPTH - 1
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-odds))
        grad, curve = weight * (y - p), weight * p * (1 - p)
        feature, cut, at = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(len(x), np.int64)
        for level in range(DEPTH):
            for node in range(2**level - 1, 2 ** (level + 1) - 1):
                rows = np.flatnonzero(at == node)
                if len(rows) > 1:
                    best = 1e-6
                    g, h = grad[rows].sum(), curve[rows].sum()
                    for f, c in enumerate(cuts):
                        if not len(c):
                            continue
                        gs = np.cumsum(np.bincount(binned[rows, f], grad[rows], len(c) + 1))[:-1]
                        hs = np.cumsum(np.bincount(binned[rows, f], curve[rows], len(c) + 1))[:-1]
                        gain = gs**2 / (hs + 1) + (g - gs) ** 2 / (h - hs + 1) - g**2 / (h + 1)
                        k = int(np.argmax(gain))
                        if gain[k] > best:
                            best, feature[node], cut[node] = float(gain[k]), f, c[k]
                at[rows] = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
        leaf = at - inner
        value = RATE * np.bincount(leaf, grad, 2**DEPTH) / (np.bincount(leaf, curve, 2**DEPTH) + 1)
        model.features.append(feature)
        model.cuts.append(cut)
        model.leaves.append(value)
        odds += value[leaf]
    return model


def decode(nodes: list[Node], odds: np.ndarray) -> list[bool]:
    """Which elements are taken, for the greatest sum of log-odds over taken and left-out elements.

    Left out, an element leaves out all below it; taken, each child may be either. Elements count by the text below them.
    """
    place = {id(node): i for i, node in enumerate(nodes)}
    size = [sum(len(c.strip()) for c in node.children if isinstance(c, str)) for node in nodes]
    for i in range(len(nodes) - 1, 0, -1):
        size[place[id(nodes[i].parent)]] += size[i]
    weight = 1 + np.sqrt(np.array(size, float))
    gain = weight * odds
    taken, out = gain.copy(), -gain  # best sums of the subtree with its top taken, and with all of it left out
    for i in range(len(nodes) - 1, 0, -1):
        p = place[id(nodes[i].parent)]
        taken[p] += max(taken[i], out[i])
        out[p] += out[i]
    chosen = [True] * len(nodes)  # the page itself always is
    for i in range(1, len(nodes)):
        chosen[i] = chosen[place[id(nodes[i].parent)]] and bool(taken[i] > out[i])
    return chosen


def blocks(nodes: list[Node], chosen: list[bool]) -> list[str]:
    """The taken text by blocks, in page order, with references decoded and white space turned into single spaces."""
    keep = {id(node) for node, c in zip(nodes, chosen) if c}
    out: list[str] = []
    run: list[str] = []

    def end() -> None:
        text = _SPACE.sub(" ", unescape("".join(run))).strip()
        if text:
            out.append(text)
        run.clear()

    stack: list[Node | str | None] = [nodes[0]] if nodes else []
    while stack:
        item = stack.pop()
        if item is None:
            end()
        elif isinstance(item, str):
            run.append(item)
        elif item.name == "br":
            run.append(" ")
        elif id(item) in keep:
            inline = item.name in INLINE
            if not inline:
                end()
                stack.append(None)
            stack += reversed(item.children)
        elif item.name not in INLINE:
            end()
        else:
            run.append(" ")
    end()
    return out


# ---- training pages


def _classes(deal: random.Random, kind: str) -> str:
    """An attribute that hints at ``kind``, or one that doesn't."""
    word = deal.choice(HINTS[kind].split()) if kind in HINTS and deal.random() < 0.75 else deal.choice(["box", "c1", "wrap", "block", "inner", "x7", "row", "col"])
    word = deal.choice([word, f"site-{word}", f"{word}-wrap", f"{word}s", f"page-{word}", f"{word}_1"])
    return f' {deal.choice(["class", "class", "id"])}="{word}"' if deal.random() < 0.9 else ""


def training_page(deal: random.Random, texts: list[str]) -> tuple[str, str]:
    """A page in some layout, with a mark ``data-y`` on every element that begins the article or something else."""
    some = lambda a, b: [deal.choice(texts) for _ in range(deal.randint(a, b))]
    short = lambda: " ".join(deal.choice(texts).split()[: deal.randint(1, 5)])
    piece = lambda: " ".join(deal.choice(texts).split()[: deal.randint(5, 40)])

    def links() -> str:
        items = [f'<a href="/{i}">{short()}</a>' for i in range(deal.randint(2, 9))]
        return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>" if deal.random() < 0.7 else " | ".join(items)

    def other(kind: str) -> str:
        names = {
            "nav": ["nav", "div", "ul"], "head": ["header", "div"], "foot": ["footer", "div"], "side": ["aside", "div", "section"],
            "notice": ["div", "section", "aside"], "advert": ["div", "aside", "ins"], "form": ["form", "div"], "comment": ["section", "div", "ol"], "share": ["div", "ul"],
        }
        name = deal.choice(names[kind])
        hint = _classes(deal, kind) if name in ("div", "section", "ul", "ol", "ins") or deal.random() < 0.5 else ""
        if name in ("div", "section", "ul", "ol", "ins") and not hint:
            hint = f' class="{deal.choice(HINTS[kind].split())}"'
        if kind in ("nav", "share"):
            inside = links()
        elif kind == "head":
            inside = f"<h1>{short()}</h1>" + (links() if deal.random() < 0.5 else f"<p>{piece()}</p>")
        elif kind == "foot":
            inside = f"&copy; {short()} &middot; {piece()}" if deal.random() < 0.6 else f"<p>&copy; {piece()}</p>" + links()
        elif kind == "side":
            inside = f"<h3>{short()}</h3>" + (links() if deal.random() < 0.6 else "".join(f"<p>{piece()}</p>" for _ in range(deal.randint(1, 3))))
        elif kind == "notice":
            inside = f"<p>{piece()}</p><button>{short()}</button>" if deal.random() < 0.5 else piece()
        elif kind == "advert":
            inside = piece() if deal.random() < 0.6 else f'<a href="#">{piece()}</a><p>{piece()}</p>'
        elif kind == "form":
            inside = f'<label>{short()}</label><input type="text"><button>{short()}</button>' + (f"<p>{piece()}</p>" if deal.random() < 0.5 else "")
        else:
            inside = f"<h2>{short()}</h2>" + "".join(f"<div{_classes(deal, kind)}><b>{short()}</b><p>{deal.choice(texts)[:600]}</p></div>" for _ in range(deal.randint(1, 6)))
        return f'<{name}{hint} data-y="0">{inside}</{name}>'

    def paragraph() -> str:
        text = deal.choice(texts)
        kind = deal.random()
        if kind < 0.04:
            return f"<p>{short()}.</p>"
        if kind < 0.1:
            return "<ul>" + "".join(f"<li>{piece()}</li>" for _ in range(deal.randint(2, 5))) + "</ul>"
        if kind < 0.13:
            return f"<blockquote>{piece()}</blockquote>"
        if kind < 0.2:
            return f"<h2>{short()}</h2><p>{text}</p>"
        if kind < 0.24:
            return f"<pre>{piece()}</pre>"
        if kind < 0.28:
            return "<table><tr>" + "".join(f"<td>{short()}</td>" for _ in range(4)) + "</tr></table>"
        if kind < 0.4:
            words = text.split()
            i = deal.randrange(len(words)) if words else 0
            return f'<p>{" ".join(words[:i])} <a href="#">{short()}</a> <em>{short()}</em> {" ".join(words[i:])}</p>'
        if kind < 0.5:
            return f"<div>{text}</div>"
        return deal.choice([f"<p>{text}</p>", f"<p>{text}</p>", f"<p>{text}", f"<p><b>{text}<br></p>"])

    body = [paragraph() for _ in range(deal.choice([1, 2, 3, 4, 6, 9, 14]))]
    if deal.random() < 0.3:
        body.append(f"<p>{short()}</p>")
    title = f"<h1>{short()}</h1>" if deal.random() < 0.8 else ""
    if deal.random() < 0.3:
        body.insert(deal.randrange(len(body) + 1), other(deal.choice(["advert", "side", "share", "form"])))
    name = deal.choice(["article", "article", "main", "div", "div", "section"])
    hint = _classes(deal, "article") if name in ("div", "section") or deal.random() < 0.4 else ""
    article = f'<{name}{hint} data-y="1">{title}{"".join(body)}</{name}>'
    before = [other(k) for k in deal.sample(["nav", "head", "notice", "advert", "side", "form"], deal.randint(0, 4))]
    after = [other(k) for k in deal.sample(["side", "foot", "comment", "form", "notice", "advert", "nav", "share"], deal.randint(0, 5))]
    page = "".join(before) + article + "".join(after)
    for _ in range(deal.choice([0, 0, 1, 2])):
        page = f"<div{_classes(deal, 'none')}>{page}</div>"
    return f"<html><head><title>{short()}</title></head><body>{page}</body></html>", ""


def _targets(nodes: list[Node]) -> np.ndarray:
    """1 for elements of the article, 0 for others; what only holds the article counts as taken, with no weight of its own."""
    y = np.full(len(nodes), 0.5)
    place = {id(node): i for i, node in enumerate(nodes)}
    for i, node in enumerate(nodes):
        mark = re.search(r'data-y="([01])"', node.attributes)
        p = place[id(node.parent)] if node.parent else -1
        y[i] = float(mark.group(1)) if mark else (y[p] if p >= 0 else 0.5)
        if p >= 0 and y[p] == 0:
            y[i] = 0
    for i in range(len(nodes) - 1, 0, -1):
        p = place[id(nodes[i].parent)]
        if y[i] >= 0.9 and y[p] == 0.5:
            y[p] = 0.9  # on the way to the article
    return y


def fit(paragraphs: list[str], pages: int = TRAINING_PAGES) -> Trees:
    """Trees for layouts of ``pages`` made pages; without paragraphs some plain words stand in."""
    deal = random.Random(42)
    texts = [p for p in paragraphs if p] or ["Plain words stand in for text, where there is none.", "More of them follow. They say nothing."]
    xs, ys = [], []
    for _ in range(pages):
        html, _mark = training_page(deal, texts)
        root = parse(html)
        nodes, _x = measure(root)
        y = _targets(nodes)
        for node in nodes:
            node.attributes = node.attributes.replace(' data-y="0"', "").replace(' data-y="1"', "")
        _, x = measure(root)
        xs.append(x)
        ys.append(y)
    x, y = np.vstack(xs), np.concatenate(ys)
    known = y != 0.5
    x, y = x[known], y[known]
    return boost(x, (y > 0.5).astype(float), np.where(y == 0.9, 2.0, 1.0))


@lru_cache(maxsize=2)
def _paragraph_words(html: str) -> tuple[str, ...]:
    nodes = measure(parse(html))[0]
    return tuple(t for t in blocks(nodes, [True] * len(nodes)) if len(t.split()) >= 5)


def train(pages: DataFrame, at_most: int = SAMPLE_PAGES) -> Trees:
    """Fits to layouts filled with paragraphs of at most ``at_most`` pages, chosen by a hash of their ids.

    The choice is made without the pages; only those chosen, each once if it is repeated, go to the driver. Null pages
    take no part. An empty table gives a model, too.
    """
    keyed = pages.where(F.col("html").isNotNull()).select(
        F.xxhash64("page_id").alias("place"), F.col("page_id").alias("own"), F.xxhash64("html").alias("digest"), "html"
    )
    order = ["place", "own", "digest"]
    chosen = keyed.select(*order).distinct().orderBy(*order).limit(at_most).withColumnsRenamed({c: f"chosen_{c}" for c in order})
    same = (F.col("own").eqNullSafe(F.col("chosen_own"))) & (F.col("digest") == F.col("chosen_digest"))
    rows = keyed.join(F.broadcast(chosen), same, "left_semi").dropDuplicates(order).orderBy(*order).collect()
    return fit([t[:2000] for r in rows for t in _paragraph_words(r.html)][: 50 * at_most])


def text_of(model: Trees, pages: list[str]) -> list[str]:
    """The main texts of ``pages``, whose elements are judged together."""
    measured = [measure(parse(html)) for html in pages]
    if not measured:
        return []
    odds = model.odds(np.vstack([x for _, x in measured]))
    out, at = [], 0
    for nodes, x in measured:
        own = odds[at : at + len(x)]
        at += len(x)
        out.append("\n".join(blocks(nodes, decode(nodes, own))))
    return out


def main_text(html: Column, model: Trees) -> Column:
    """The main text of a page; null and empty pages give the empty text."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages in batches:
            texts = [p if isinstance(p, str) else "" for p in pages]
            yield pd.Series([t for at in range(0, len(texts), 256) for t in text_of(model, texts[at : at + 256])], dtype=object)

    return run(html)


def extract(pages: DataFrame, model: Trees) -> DataFrame:
    """``page_id``, ``url``, ``text``, ``n_chars`` of every row of ``pages``. Nulls in other columns are passed on."""
    rows = pages.select("page_id", "url", main_text(text_or_empty("html"), model).alias("text"))
    return rows.withColumn("n_chars", F.length("text").cast("long"))
