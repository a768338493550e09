"""Main text of web pages: boosted trees over DOM nodes, decoded along the tree.

Pages are parsed into block elements. Each is described by its tag, the tokens of its attributes and of its ancestors', the
density of its subtree, its depth and its siblings. Boosted trees give the log-odds that a block belongs to the article. The
kept blocks are the set of greatest total log-odds in which every kept block's ancestors are kept too, so no block is chosen
against its ancestor.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.llm.boosting import Trees, fit_trees
from panelwright.llm.common import pick, put, python_tasks

#: Generated layouts and, at most, pages of the table itself that the trees are fitted on.
LAYOUTS, TRAIN_PAGES = 500, 200
#: Pages described together.
_AT_ONCE = 128

# Fixed values of the markup language: elements by role.
KINDS = {
    "p": 1, "h1": 2, "h2": 2, "h3": 2, "h4": 2, "h5": 2, "h6": 2, "div": 3, "section": 3, "center": 3, "article": 4, "main": 4,
    "nav": 5, "header": 6, "footer": 7, "aside": 8, "ul": 9, "ol": 9, "dl": 9, "menu": 5, "li": 10, "dt": 10, "dd": 10, "table": 11,
    "thead": 11, "tbody": 11, "tfoot": 11, "tr": 11, "td": 12, "th": 12, "caption": 12, "form": 13, "fieldset": 13, "dialog": 13,
    "blockquote": 14, "pre": 14, "figure": 15, "figcaption": 15, "details": 3, "summary": 3, "address": 7, "body": 16, "html": 16,
}
_UNREAD = frozenset("script style noscript template textarea select svg iframe object title button canvas audio video map".split())
_VOID = frozenset("br hr img input meta link wbr source area base col embed param track".split())
# a start of the first closes an open one of the second on top of the stack
_CLOSES = {"li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}}
# Words in attributes that tell what an element is for.
TOKENS = [
    "article content main post entry story body text blog prose".split(),
    "nav navbar navigation menu breadcrumb breadcrumbs header masthead top toolbar topbar pagination pager skip".split(),
    "footer foot bottom copyright legal imprint colophon".split(),
    "sidebar aside widget related recommended recommendations rail promo teaser trending popular side more".split(),
    "ad ads advert adverts advertisement advertising sponsor sponsored banner promoted promotion adslot".split(),
    "cookie cookies consent gdpr notice popup modal overlay newsletter subscribe alert privacy dialog paywall disclaimer".split(),
    "share sharing social follow tags tag meta byline buttons".split(),
    "comment comments reply replies discussion discuss disqus respond responses feedback reader".split(),
    "form login search signup register contact poll survey".split(),
]
_GROUP = {word: g for g, words in enumerate(TOKENS) for word in words}
_TAG = re.compile(
    r"<(?:!--.*?(?:-->|\Z)|[!?][^>]*+(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*+)((?:[^\"'>]++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)"
    r"|(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z))",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)")
_LABEL = re.compile(r'data-label="([01])"')
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_NAMED = ("class", "id", "role", "aria-label", "itemprop", "name")


@lru_cache(maxsize=20_000)
def _groups(attributes: str) -> int:
    """Bit set of the token groups in an element's attributes."""
    bits = 0
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name in _NAMED:
            for part in _PART.findall(value):
                group = _GROUP.get(part.lower())
                if group is not None:
                    bits |= 1 << group
        elif name == "hidden" or name == "style" and "display:none" in value.replace(" ", ""):
            bits |= 1 << 5
    return bits


@dataclass
class Dom:
    """Block elements of one page in page order, and the text runs between block boundaries."""

    kind: list[int] = field(default_factory=lambda: [16])
    parent: list[int] = field(default_factory=lambda: [0])
    bits: list[int] = field(default_factory=lambda: [0])
    label: list[int] = field(default_factory=lambda: [-1])
    runs: list[tuple[int, str, int]] = field(default_factory=list)  # node, text, characters in links


class LabelledPage(str):
    """A generated page. Its ``data-label`` attributes are training labels; in any other page that attribute means nothing."""


def parse(html: str) -> Dom:
    """Forgiving parse of a whole page. Character references are decoded; a blank stands for a line break element."""
    dom, labelled = Dom(), isinstance(html, LabelledPage)
    stack: list[tuple[str, int]] = [("html", 0)]
    open_ = Counter()  # elements of each name on the stack, so that an end without a start is not looked for
    pieces: list[str] = []
    linked = in_link = 0
    end = len(html)

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                dom.runs.append((stack[-1][1], text, min(linked, len(text))))
            pieces.clear()
        linked = 0

    def read(start: int, stop: int) -> None:
        nonlocal linked
        text = html[start:stop]
        if "&" in text:
            text = unescape(text)
        pieces.append(text)
        if in_link:
            linked += len(text)

    at = 0
    match = _TAG.search(html)
    while match:
        start, after = match.span()
        if start > at:
            read(at, start)
        close, tag, attributes = match.group(1, 2, 3) if match.group(2) else match.group(4, 5, 6)
        if tag:
            tag = tag.lower()
            if tag in KINDS:
                flush()
                if not close:
                    closes = _CLOSES.get(tag, ("p",))
                    while stack[-1][0] in closes and len(stack) > 1:
                        open_[stack.pop()[0]] -= 1
                    bits = _groups(attributes) if attributes else 0
                    mark = _LABEL.search(attributes) if labelled else None
                    if tag in ("html", "body"):
                        dom.bits[0] |= bits
                    else:
                        stack.append((tag, len(dom.kind)))
                        open_[tag] += 1
                        dom.kind.append(KINDS[tag])
                        dom.parent.append(stack[-2][1])
                        dom.bits.append(bits)
                        dom.label.append(int(mark[1]) if mark else -1)
                elif tag not in ("html", "body"):
                    if open_[tag]:
                        while (ended := stack.pop()[0]) != tag:
                            open_[ended] -= 1
                        open_[tag] -= 1
                    in_link = 0
            elif tag == "a":
                in_link = 0 if close else 1
            elif tag in _VOID:
                if tag in ("br", "hr"):
                    pieces.append(" ")
            elif tag in _UNREAD and not close and not attributes.endswith("/"):
                shut = re.compile(f"</{re.escape(tag)}[\\s/>]", re.I).search(html, after)
                after = html.find(">", shut.start()) + 1 or end if shut else end
        at = after
        match = _TAG.search(html, at)
    if at < end:
        read(at, end)
    flush()
    return dom


def _depths(dom: Dom) -> list[int]:
    """Depth of each node; parents come before their children."""
    found = [0]
    for up in dom.parent[1:]:
        found.append(found[up] + 1)
    return found


def _levels(depth: np.ndarray) -> list[np.ndarray]:
    """Nodes of each depth, in page order."""
    return np.split(np.argsort(depth, kind="stable"), np.cumsum(np.bincount(depth))[:-1]) if len(depth) else []


def describe(doms: list[Dom]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, parents and depths of the nodes of several pages, one after the other. A page's root is its own parent."""
    counts = np.array([len(d.kind) for d in doms])
    first = np.concatenate([[0], np.cumsum(counts)[:-1]])
    page = np.repeat(np.arange(len(doms)), counts)
    n = int(counts.sum())
    kind = np.concatenate([d.kind for d in doms])
    parent = np.concatenate([np.array(d.parent) + f for d, f in zip(doms, first)])
    bits = np.concatenate([d.bits for d in doms])
    runs = [(r[0] + f, r[1], r[2]) for d, f in zip(doms, first) for r in d.runs]
    node = np.array([r[0] for r in runs], np.int64)
    length = np.array([len(r[1]) for r in runs], float)
    own = np.bincount(node, length, n)
    own_link = np.bincount(node, np.array([r[2] for r in runs], float), n)
    stops = np.bincount(node, np.array([r[1].count(".") + r[1].count("!") + r[1].count("?") for r in runs], float), n)
    commas = np.bincount(node, np.array([r[1].count(",") for r in runs], float), n)
    signs = np.bincount(node, np.array([("©" in r[1]) + ("|" in r[1]) for r in runs], float), n)
    capital = np.bincount(node, np.array([r[1][:1].isupper() for r in runs], float), n)

    root = np.arange(n) == parent
    depth = np.concatenate([_depths(d) for d in doms])
    above = np.zeros(n, np.int64)  # token groups and roles of proper ancestors
    role = np.select([kind == 4, np.isin(kind, (5, 6, 7, 8, 13))], [1 << 20, 1 << 21], 0)
    text, link, tags, leaves = own.copy(), own_link.copy(), np.ones(n), stops.copy()
    by_level = _levels(depth)
    for nodes in by_level[1:]:
        above[nodes] = above[parent[nodes]] | bits[parent[nodes]] | role[parent[nodes]]
    for nodes in by_level[:0:-1]:
        for total in (text, link, tags, leaves):
            np.add.at(total, parent[nodes], total[nodes])
    # siblings: children of one parent in page order
    inner = ~root
    order = np.lexsort((np.arange(n), parent))
    order = order[inner[order]]
    group = parent[order]
    begin = np.flatnonzero(np.diff(group, prepend=-1)) if len(group) else np.empty(0, np.int64)
    sizes = np.diff(np.append(begin, len(group)))
    children = np.zeros(n)
    place, among, before, after, mean = np.zeros(n), np.ones(n), np.zeros(n), np.zeros(n), text.copy()
    if len(group):
        children[group[begin]] = sizes
        place[order] = (np.arange(len(group)) - np.repeat(begin, sizes)) / np.repeat(sizes, sizes)
        among[order] = np.repeat(sizes, sizes)
        sums = np.add.reduceat(text[order], begin)
        mean[order] = np.repeat(sums / sizes, sizes)
        same = group[1:] == group[:-1]
        before[order[1:][same]] = text[order[:-1][same]]
        after[order[:-1][same]] = text[order[1:][same]]
    whole = np.maximum(text[first][page], 1) if n else text
    passed = np.cumsum(own) - own
    passed = passed - passed[first][page] if n else passed

    def log(x: np.ndarray) -> np.ndarray:
        return np.log1p(x)

    columns = [
        *[(kind == k).astype(float) for k in range(1, 17)],
        *[((bits >> g) & 1).astype(float) for g in range(len(TOKENS))],
        *[((above >> g) & 1).astype(float) for g in (*range(len(TOKENS)), 20, 21)],
        depth, log(children), place, log(among), log(before), log(after), log(mean),
        log(own), log(text), own_link / np.maximum(own, 1), link / np.maximum(text, 1), text / tags, log(tags),
        leaves / np.maximum(text, 1) * 100, stops, commas / np.maximum(own, 1) * 100, signs, capital,
        text / whole, passed / whole, text[parent] / tags[parent], link[parent] / np.maximum(text[parent], 1),
        np.isin(kind[parent], (9, 10)).astype(float),
    ]
    return np.stack(columns, axis=1).astype(np.float32), parent, depth


def decode(odds: np.ndarray, parent: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """Nodes of the best set that is closed under ancestors; roots may always be passed through.

    From the leaves up, a subtree is worth its node's log-odds and the worth of the children that gain; from the root down,
    a child is kept if its parent is and its subtree gains. A root's own text is kept if its own log-odds are positive.
    """
    worth = odds.astype(float).copy()
    levels = _levels(depth)
    for nodes in levels[:0:-1]:
        np.add.at(worth, parent[nodes], np.maximum(worth[nodes], 0))
    open_ = depth == 0
    kept = open_ & (odds > 0)
    for nodes in levels[1:]:
        open_[nodes] = open_[parent[nodes]] & (worth[nodes] > 0)
        kept[nodes] = open_[nodes]
    return kept


def main_texts(pages: list[str], trees: Trees) -> list[str]:
    """Main text of each page."""
    doms = [parse(p) for p in pages]
    if not doms:
        return []
    x, parent, depth = describe(doms)
    kept = decode(trees.log_odds(x), parent, depth)
    texts, at = [], 0
    for dom in doms:
        texts.append(" ".join(text for node, text, _ in dom.runs if kept[at + node]))
        at += len(dom.kind)
    return texts


# --- training ---------------------------------------------------------------------------------------


class Layouts:
    """Seeded generator of labelled pages: many ways to mark up an article and what stands around it."""

    def __init__(self, seed: int = 11):
        self.rng = np.random.default_rng(seed)
        letters = list("aeioubcdfghklmnprstvw")
        self.words = ["".join(self.rng.choice(letters, self.rng.integers(2, 9))) for _ in range(800)]

    def chance(self, p: float) -> bool:
        return bool(self.rng.random() < p)

    def pick(self, *options: str) -> str:
        return options[self.rng.integers(len(options))]

    def prose(self, least: int, most: int) -> str:
        found, n = [], int(self.rng.integers(least, most + 1))
        while n > 0:
            k = min(n, int(self.rng.integers(3, 18)))
            part = [self.words[i] for i in self.rng.integers(0, len(self.words), k)]
            if k > 6 and self.chance(0.5):
                part[k // 2] += ","
            found.append(" ".join(part).capitalize() + ("." if self.chance(0.97) else "!"))
            n -= k
        return " ".join(found)

    def title(self) -> str:
        return self.prose(1, 9).rstrip(".!") + self.pick("", "", ".")

    def links(self, n: int, item: str = "li", most: int = 3) -> str:
        return "".join(f'<{item}><a href="#">{self.prose(1, most).rstrip(".!")}</a></{item}>' for _ in range(n))

    def named(self, tags: tuple[str, ...], names: tuple[str, ...], label: int) -> tuple[str, str]:
        """An element's start and end; the name is at times in another attribute or among others."""
        tag = self.pick(*tags)
        name = self.pick(*names)
        if tag in ("article", "main", "nav", "header", "footer", "aside", "form") and self.chance(0.6):
            name = ""  # the element says enough
        if name:
            name = self.pick(name, name, f"site-{name}", f"{name}-box", f"c{self.rng.integers(99)} {name}")
        extra = f' {self.pick("class", "class", "id")}="{name}"' if name else ""
        return f'<{tag}{extra} data-label="{label}">', f"</{tag}>"

    def around(self, kind: str) -> str:
        """A part of the page that is no main text."""
        if kind == "nav":
            a, b = self.named(("nav", "div", "ul", "header"), ("nav", "menu", "navbar", "breadcrumb", "header", ""), 0)
            return a + ("<ul>" + self.links(self.rng.integers(2, 12)) + "</ul>" if self.chance(0.7) else self.links(self.rng.integers(2, 8), "span")) + b
        if kind == "header":
            a, b = self.named(("header", "div"), ("header", "masthead", "topbar"), 0)
            return a + f"<{self.pick('h1', 'h2', 'p', 'div')}>{self.prose(1, 6)}</{self.pick('h1', 'p')}>" + (self.around("nav") if self.chance(0.5) else "") + b
        if kind == "footer":
            a, b = self.named(("footer", "div", "footer"), ("footer", "copyright", "legal", "colophon"), 0)
            text = self.pick("&copy; ", "", "© 2020 ") + self.prose(2, 40)
            return a + (f"<p>{text}</p>" if self.chance(0.5) else text) + (self.links(3, "span") if self.chance(0.4) else "") + b
        if kind == "side":
            a, b = self.named(("aside", "div", "section"), ("sidebar", "widget", "related", "popular", "rail", "recommended"), 0)
            body = f"<h3>{self.title()}</h3>" + ("<ul>" + self.links(self.rng.integers(2, 8), "li", 9) + "</ul>" if self.chance(0.6) else f"<p>{self.prose(5, 50)}</p>")
            return a + body + b
        if kind == "ad":
            a, b = self.named(("div", "aside", "div", "p", "section"), ("ad", "ads", "advert", "sponsored", "banner", "promo", "advertisement"), 0)
            text = self.prose(2, 45)
            return a + (f"<p>{text}</p>" if self.chance(0.4) else text) + b
        if kind == "notice":
            a, b = self.named(("div", "section", "dialog", "aside", "p"), ("cookie", "consent", "notice", "gdpr", "newsletter", "popup", "alert", "disclaimer"), 0)
            text = self.prose(5, 60)
            return a + (f"<p>{text}</p>" if self.chance(0.5) else text) + (f"<button>{self.title()}</button>" if self.chance(0.5) else "") + b
        if kind == "form":
            a, b = self.named(("form", "form", "div"), ("form", "search", "login", "signup", "contact"), 0)
            return a + "".join(f"<{self.pick('label', 'p', 'div')}>{self.prose(1, 8)}</label><input>" for _ in range(self.rng.integers(1, 5))) + b
        if kind == "share":
            a, b = self.named(("div", "ul", "p"), ("share", "social", "tags", "meta"), 0)
            return a + self.links(self.rng.integers(2, 6), "span") + b
        a, b = self.named(("section", "div", "ol", "ul"), ("comments", "comment", "discussion", "respond", "replies"), 0)
        posts = []
        for _ in range(self.rng.integers(1, 7)):
            tag = self.pick("div", "article", "li", "p")
            posts.append(f'<{tag}{self.pick("", " class=comment", " class=reply")}>{self.pick("", f"<b>{self.title()}</b>")}<p>{self.prose(3, 60)}</p></{tag}>')
        return a + f"<h3>{self.title()}</h3>" * self.chance(0.5) + "".join(posts) + b

    def article(self) -> str:
        short = self.chance(0.2)
        parts = [f"<h1>{self.title()}</h1>"] if self.chance(0.8) else []
        for _ in range(self.rng.integers(1, 4 if short else 16)):
            roll = self.rng.random()
            text = self.prose(1, 90) if self.chance(0.8) else self.prose(1, 5)
            if roll < 0.7:
                if self.chance(0.15):
                    text += f' <a href="#">{self.prose(1, 4)}</a> ' + self.prose(1, 20)
                parts.append(self.pick(f"<p>{text}</p>", f"<p>{text}</p>", f"<p>{text}", f"<p><b>{text}<br>", f"<div>{text}</div>", f"{text}<br>"))
            elif roll < 0.78:
                parts.append(f"<h2>{self.title()}</h2>")
            elif roll < 0.86:
                parts.append("<ul>" + "".join(f"<li>{self.prose(1, 25)}{self.pick('</li>', '')}" for _ in range(self.rng.integers(2, 7))) + "</ul>")
            elif roll < 0.92:
                parts.append(f"<blockquote>{text}</blockquote>" if self.chance(0.6) else f"<pre>{text}</pre>")
            elif roll < 0.96:
                rows = "".join(f"<tr><td>{self.prose(1, 4)}</td><td>{self.prose(1, 6)}</td></tr>" for _ in range(self.rng.integers(1, 5)))
                parts.append(f"<table>{rows}</table>")
            else:
                parts.append(f"<figure><img><figcaption>{self.prose(1, 15)}</figcaption></figure>")
            if self.chance(0.06):
                parts.append(self.around(self.pick("ad", "share", "side", "notice", "form")))
        return "".join(parts)

    def page(self) -> str:
        kinds = ("nav", "header", "footer", "side", "ad", "notice", "form", "share", "comments")
        likely = (0.8, 0.4, 0.0, 0.4, 0.5, 0.3, 0.2, 0.2, 0.0)
        top = [self.around(k) for k, p in zip(kinds, likely) if self.chance(p)]
        low = [self.around(k) for k, p in zip(kinds, (0.1, 0.0, 0.85, 0.4, 0.2, 0.2, 0.2, 0.2, 0.4)) if self.chance(p)]
        a, b = self.named(("article", "main", "div", "section", "article", "td"), ("content", "article", "post", "entry", "main", "story", "", "", "text"), 1)
        body = a + self.article() + b
        if self.chance(0.1):
            body = self.article()
        if self.chance(0.3):
            body = f'<div{self.pick("", " class=wrapper", " id=page")} data-label="1">' + "".join(top[1:]) + body + "".join(low[:1]) + "</div>"
            top, low = top[:1], low[1:]
        head = f"<head><title>{self.title()}</title><style>p{{margin:0}}</style></head>" if self.chance(0.7) else ""
        return LabelledPage(f"<!DOCTYPE html><html>{head}<body>{''.join(top)}{body}{''.join(low)}</body></html>")


def _labels(dom: Dom) -> np.ndarray:
    """Label of each node: its own, or its parent's; a page's root is kept."""
    labels = [1]
    for k in range(1, len(dom.kind)):
        labels.append(dom.label[k] if dom.label[k] >= 0 else labels[dom.parent[k]])
    return np.array(labels, float)


def _meant(dom: Dom) -> np.ndarray | None:
    """Labels that a page's own semantic elements give: what stands in an article or main element is kept unless it, or an
    element in between, says otherwise by tag or token. None for pages without such an element."""
    other = sum(1 << g for g in range(1, len(TOKENS)))
    inside, labels = [False], [1]
    for k in range(1, len(dom.kind)):
        up = dom.parent[k]
        against = dom.kind[k] in (5, 6, 7, 8, 13) or dom.bits[k] & other
        own = (dom.kind[k] == 4 or inside[up]) and not against
        inside.append(own)
        labels.append(int(own))
    return np.array(labels, float) if any(inside) else None


def train(pages: DataFrame | None = None, html: str = "html", layouts: int = LAYOUTS, sample: int = TRAIN_PAGES) -> Trees:
    """Fit the trees on ``layouts`` generated pages, and on up to ``sample`` rows of ``pages`` whose own semantic elements tell
    what is meant. Both numbers bound what the driver holds."""
    made = Layouts()
    doms = [parse(made.page()) for _ in range(layouts)]
    labels = [_labels(d) for d in doms]
    if pages is not None:
        for dom in map(parse, _chosen(pages, html, sample)):
            meant = _meant(dom)
            if meant is not None:
                doms.append(dom)
                labels.append(meant)
    x, _, _ = describe(doms)
    return fit_trees(x, np.concatenate(labels))


def _chosen(pages: DataFrame, html: str, sample: int) -> list[str]:
    """Different pages with the least hashes; the hashes are chosen first, so that no task sends pages that are not used."""
    hashed = pick(pages, html).where(F.length(html) < 1 << 18).withColumn("__h", F.xxhash64(html))
    least = [r[0] for r in hashed.select("__h").distinct().orderBy("__h").limit(sample).collect()]
    if not least:
        return []
    rows = hashed.where(F.col("__h") <= least[-1]).dropDuplicates(["__h"]).collect()
    return [r[html] for r in sorted(rows, key=lambda r: r["__h"])]


def extract(df: DataFrame, html: str = "html", output: str = "text", trees: Trees | None = None) -> DataFrame:
    """The frame with the main text of each page: decoded, white space in a block as one blank, blocks joined by a blank.

    Empty for a null or empty page and for a page without main text; repeated pages get equal texts. Other columns do not pass
    through Python; a column named like the output is replaced. One pass, no shuffle; whole pages are read.
    """
    python_tasks(df.sparkSession)
    sent = df.sparkSession.sparkContext.broadcast(trees or train(df, html))

    @F.arrow_udf("string")
    def extracted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            texts: list[str] = []
            for k in range(0, len(batch), _AT_ONCE):
                texts += main_texts([t or "" for t in batch.slice(k, _AT_ONCE).to_pylist()], sent.value)
            yield pa.array(texts, pa.string())

    return put(df, output, extracted(F.col(html)))
