"""Main text of web pages: boosted trees over DOM nodes, decoded along the tree.

A page is read into a tree of elements and text blocks.  Boosted trees rate
every element and block by subtree density, attribute tokens, depth and sibling
statistics.  Decoding picks the choice of elements with the highest likelihood
in which a chosen node never lies below one that is not chosen; the text blocks
chosen make up the main text.

No table holds labelled nodes.  The training pages are laid out anew from texts
of a bounded sample of the given pages, in many arrangements of article, menus,
sidebars, notices, adverts, forms and comments, so every node's kind is known.
"""

from __future__ import annotations

import html
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bounds of the training sample: so many pages of at most so many characters, and so many layouts.
SAMPLE_PAGES = 60
SAMPLE_CHARS = 200_000
LAYOUTS = 1000
TREES, DEPTH = 24, 4
_ROWS = 500

# Element names of the HTML standard.
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_RAW = set("script style noscript template textarea title svg math iframe object select option button".split())
_BLOCK = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead tr ul".split()
)
_ENDS_P = _BLOCK - {"html", "body", "td", "th", "tr", "tbody", "thead", "tfoot", "dd", "dt", "li", "legend", "summary", "figcaption"}
#: An opening tag closes the nearest of these, unless one of the barriers lies between.
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
}
#: Elements that a closing ``</p>`` does not reach through.
_KEEP_P = ("article", "aside", "body", "div", "footer", "header", "main", "nav", "section", "td", "th")
_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_STOP = re.compile(r"""[>"']""")
_ATTRIBUTE = re.compile(r"""\b(class|id|role|aria-label|itemprop|name|hidden|style)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
#: Longer than any character number; Python refuses to read thousands of digits.
_LONG_NUMBER = re.compile(r"&#([0-9]{20,})")


@dataclass(eq=False)
class Node:
    tag: str
    parent: Node | None = None
    tokens: tuple[str, ...] = ()
    text: str | None = None  # of a text block
    children: list[Node] = field(default_factory=list)
    linked: int = 0  # characters inside links, of a text block
    kind: bool = False  # training: has main text


def _attributes(source: str) -> tuple[str, ...]:
    out = []
    for m in _ATTRIBUTE.finditer(source):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "hidden":
            out.append("hidden")
        elif name == "style":
            if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                out.append("hidden")
        else:
            value = re.sub(r"(?<=[a-z])(?=[A-Z])", " ", _unescape(value))
            out += [t for t in re.split(r"[^a-z0-9]+", value.lower()) if t]
    return tuple(out)


def _unescape(text: str) -> str:
    """Character references decoded; a number of any length that is no character gives U+FFFD."""
    if "&" not in text:
        return text
    # Eight digits without leading zeros already lie beyond the last character.
    return html.unescape(_LONG_NUMBER.sub(lambda m: "&#" + (m[1].lstrip("0")[:8] or "0"), text))


def _tag_end(source: str, at: int, gt: int, dead: set[int]) -> int:
    """Place of the ``>`` that ends a tag whose name ends at ``at``.

    ``gt`` is the first ``>`` from there.  One inside quotes does not end a tag,
    unless the quotes leave no end at all; then it is the first.  ``dead``
    holds the quotes from which no end was found, so a page's quotes are
    followed once, however many tags begin before them.
    """
    inside = source[at:gt]
    if "'" not in inside and inside.count('"') % 2 == 0:
        return gt
    path = []
    while (m := _STOP.search(source, at)) and m.start() not in dead:
        if m[0] == ">":
            return m.start()
        path.append(m.start())
        at = source.find(m[0], m.end()) + 1
        if not at:
            break
    dead.update(path)
    return gt


class _Open:
    """Open elements from the root down, with the places of each name."""

    def __init__(self, root: Node):
        self.nodes = [root]
        self._places: dict[str, list[int]] = {}

    def push(self, node: Node) -> None:
        self.nodes[-1].children.append(node)
        self._places.setdefault(node.tag, []).append(len(self.nodes))
        self.nodes.append(node)

    def cut(self, to: int) -> None:
        for node in self.nodes[to:]:
            self._places[node.tag].pop()
        del self.nodes[to:]

    def nearest(self, tags) -> int:
        """Place of the innermost open element of these names, 0 if none is open."""
        return max((p[-1] for t in tags if (p := self._places.get(t))), default=0)


def parse(source: str) -> Node:
    """Elements that hold text, and text blocks, in page order.

    Inline elements belong to the block around them; ``<br>`` is white space.
    Character references are decoded and white space in a block becomes one space.
    Time grows with the length of the page, whatever it holds: nothing is
    searched for again that was not found, and open elements are kept by name.
    """
    root = Node("root")
    stack = _Open(root)
    inline: list[str] = []
    opened: dict[str, int] = {}  # inline elements by name
    parts: list[str] = []
    linked = 0
    at = 0
    dead: set[int] = set()
    cdata_ends = True

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                above = stack.nodes[-1]
                above.children.append(Node("#text", above, text=text, linked=min(linked, len(text))))
            parts.clear()
        linked = 0

    def add(raw: str) -> None:
        nonlocal linked
        if raw:
            text = _unescape(raw)
            parts.append(text)
            if opened.get("a"):
                linked += len(text.strip())

    def forget_inline() -> None:
        inline.clear()
        opened.clear()

    def close(to: int) -> None:
        flush()
        stack.cut(to)
        forget_inline()

    gt = source.find(">")
    while (lt := source.find("<", at)) >= 0:
        if 0 <= gt < lt:
            gt = source.find(">", lt)
        if source.startswith("<!--", lt):
            add(source[at:lt])
            stop = source.find("-->", lt + 4)
            at = stop + 3 if stop >= 0 else len(source)
            continue
        if gt < 0:
            # No tag ends from here on; a comment may still begin.
            lt = source.find("<!--", at)
            add(source[at:lt] if lt >= 0 else source[at:])
            at = len(source)
            break
        if source[lt + 1] in "!?":
            add(source[at:lt])
            at = gt + 1
            if cdata_ends and source.startswith("<![CDATA[", lt):
                stop = source.find("]]>", lt + 9)
                cdata_ends = stop >= 0
                at = stop + 3 if cdata_ends else at
            continue
        m = _NAME.match(source, lt)
        if m is None:
            add(source[at : lt + 1])
            at = lt + 1
            continue
        add(source[at:lt])
        tag = m[2].lower()
        if m[1]:
            at = gt + 1
            if tag in _BLOCK:
                i = stack.nearest((tag,))
                if i and not (tag == "p" and stack.nearest(_KEEP_P) > i):
                    close(i)
            elif opened.get(tag):
                while True:
                    last = inline.pop()
                    opened[last] -= 1
                    if last == tag:
                        break
            continue
        stop = _tag_end(source, m.end(), gt, dead)
        rest = source[m.end() : stop]
        at = stop + 1
        if tag in _RAW:
            if not rest.rstrip().endswith("/"):
                at = re.compile(rf"</{re.escape(tag)}\s*>|\Z", re.I).search(source, at).end()
            parts.append(" ")
        elif tag in _BLOCK:
            flush()
            forget_inline()
            if tag in _ENDS_P and stack.nodes[-1].tag == "p":
                close(len(stack.nodes) - 1)
            if tag in _CLOSES:
                own, barriers = _CLOSES[tag]
                while (i := stack.nearest(own)) > stack.nearest(barriers):
                    close(i)
                    if tag not in ("tr", "tbody", "thead", "tfoot"):
                        break
            if tag not in _VOID:
                stack.push(Node(tag, stack.nodes[-1], _attributes(rest)))
        elif tag == "br":
            parts.append(" ")
        elif tag not in _VOID and not rest.rstrip().endswith("/"):
            inline.append(tag)
            opened[tag] = opened.get(tag, 0) + 1
    add(source[at:])
    flush()
    return root


# Features

_TAGS = "#text p div section article main li ul ol nav aside header footer form td table h1 h2 h3 blockquote pre dd figure figcaption body".split()
_WORDS = {
    "menu": "nav navigation navbar menu menubar breadcrumb breadcrumbs toolbar tabs pagination pager toc sitemap dropdown",
    "edge": "header footer masthead colophon topbar banner copyright legal foot head bottom top branding logo",
    "side": "sidebar side aside rail widget related recommended recommendation recommendations more popular trending teaser complementary",
    "advert": "ad ads advert adverts advertisement sponsor sponsored promo promotion promoted banner dfp adsense outbrain taboola",
    "notice": "cookie cookies consent gdpr notice alert modal popup overlay dialog paywall privacy disclaimer hidden toast",
    "form": "form search login signup subscribe subscription newsletter register signin contact input",
    "comment": "comment comments commentlist reply replies respond disqus discussion thread feedback reader responses",
    "social": "share sharing social follow tweet facebook twitter",
    "main": "article content main post entry story body text maincontent articlebody postcontent entrycontent storybody",
}
_WORD_GROUPS = {w: i for i, group in enumerate(_WORDS.values()) for w in group.split()}
_N_GROUPS = len(_WORDS)
#: Attribute tokens that no word group knows share these places by hash.
_HASHED = 8
FEATURES = len(_TAGS) + 2 * _N_GROUPS + _HASHED + 20


def _groups(node: Node) -> list[float]:
    out = [0.0] * _N_GROUPS
    for t in node.tokens:
        i = _WORD_GROUPS.get(t)
        if i is not None:
            out[i] = 1.0
    i = {"nav": 0, "menu": 0, "header": 1, "footer": 1, "aside": 2, "dialog": 4, "form": 5, "fieldset": 5, "article": 8, "main": 8}.get(node.tag)
    if i is not None:
        out[i] = 1.0
    return out


def _hash(token: str) -> int:
    h = 0
    for c in token:
        h = (h * 31 + ord(c)) & 0xFFFF
    return h % _HASHED


def features(root: Node) -> tuple[list[Node], np.ndarray]:
    """All nodes below the root in page order, parents first, and a row of numbers for each."""
    nodes: list[Node] = []
    depth: list[int] = []
    parent: list[int] = []
    todo = [(c, 1, -1) for c in reversed(root.children)]
    while todo:
        node, d, p = todo.pop()
        i = len(nodes)
        nodes.append(node)
        depth.append(d)
        parent.append(p)
        todo += [(c, d + 1, i) for c in reversed(node.children)]
    n = len(nodes)
    if not n:
        return nodes, np.zeros((0, FEATURES), np.float32)
    chars, links, blocks, elements, stops = ([0] * n for _ in range(5))
    for i in range(n - 1, -1, -1):
        node = nodes[i]
        if node.text is not None:
            chars[i], links[i], blocks[i] = len(node.text), node.linked, 1
            stops[i] = node.text.count(".") + node.text.count("!") + node.text.count("?") + node.text.count(",")
        else:
            elements[i] += 1
        p = parent[i]
        if p >= 0:
            for x in (chars, links, blocks, elements, stops):
                x[p] += x[i]
    total = max(1, sum(chars[i] for i in range(n) if parent[i] < 0))
    before = [0] * n
    seen = 0
    for i, node in enumerate(nodes):
        before[i] = seen
        if node.text is not None:
            seen += len(node.text)
    family: dict[int, list[int]] = {}
    for i, p in enumerate(parent):
        family.setdefault(p, []).append(i)
    place, same, sib_chars, sib_links = [0.0] * n, [0.0] * n, [0.0] * n, [0.0] * n
    for members in family.values():
        tags: dict[str, int] = {}
        for i in members:
            tags[nodes[i].tag] = tags.get(nodes[i].tag, 0) + 1
        all_chars, all_links = sum(chars[i] for i in members), sum(links[i] for i in members)
        for k, i in enumerate(members):
            place[i] = k / len(members)
            same[i] = tags[nodes[i].tag] / len(members)
            sib_chars[i] = all_chars / len(members)
            sib_links[i] = all_links / max(1, all_chars)
    out = np.zeros((n, FEATURES), np.float32)
    tag_place = {t: k for k, t in enumerate(_TAGS)}
    nearest: list[list[float]] = []
    base = len(_TAGS)
    for i, node in enumerate(nodes):
        k = tag_place.get(node.tag)
        if k is not None:
            out[i, k] = 1
        own = _groups(node)
        p = parent[i]
        # The nearest ancestor that says something counts, with what lies further up fading.
        up = [0.0] * _N_GROUPS if p < 0 else [max(a, b * 0.7) for a, b in zip(_groups(nodes[p]), nearest[p])]
        nearest.append(up)
        out[i, base : base + _N_GROUPS] = own
        out[i, base + _N_GROUPS : base + 2 * _N_GROUPS] = up
        for t in node.tokens:
            if t not in _WORD_GROUPS:
                out[i, base + 2 * _N_GROUPS + _hash(t)] = 1
        c = chars[i]
        out[i, base + 2 * _N_GROUPS + _HASHED :] = (
            depth[i],
            np.log1p(c),
            c / total,
            links[i] / max(1, c),
            np.log1p(blocks[i]),
            np.log1p(elements[i]),
            c / (elements[i] + 1),
            c / max(1, blocks[i]),
            stops[i] / max(1, c),
            before[i] / total,
            (before[i] + c) / total,
            place[i],
            same[i],
            np.log1p(sib_chars[i]),
            c / max(1.0, sib_chars[i]),
            sib_links[i],
            len(family[p]),
            np.log1p(chars[p]) if p >= 0 else 0.0,
            links[p] / max(1, chars[p]) if p >= 0 else 0.0,
            len(node.tokens),
        )
    return nodes, out


# Model


@dataclass(frozen=True)
class Trees:
    """Boosted trees as arrays; a leaf has feature -1 and points to itself."""

    feature: np.ndarray  # trees x nodes
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    weights: np.ndarray

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        rows, trees = np.arange(len(x))[:, None], np.arange(len(self.weights))[None, :]
        at = np.zeros((len(x), len(self.weights)), np.int32)
        for _ in range(DEPTH + 1):
            f = self.feature[trees, at]
            go_left = x[rows, np.maximum(f, 0)] <= self.threshold[trees, at]
            at = np.where(f < 0, at, np.where(go_left, self.left[trees, at], self.right[trees, at]))
        # Spark's boosted classifier has probability 1 / (1 + exp(-2 m)).
        return 2 * (self.value[trees, at] * self.weights).sum(axis=1)


def trees_of(description: str, weights: list[float]) -> Trees:
    """Arrays from the text form of Spark's trees."""
    trees: list[list[list]] = []
    open_: list[tuple[int, int, str]] = []
    for line in description.splitlines():
        if re.match(r"\s*Tree \d+", line):
            trees.append([])
            open_ = []
            continue
        m = re.match(r"(\s*)(?:(If|Else) \(feature (\d+) (<=|>) (\S+)\)|Predict: (\S+))", line)
        if not m or not trees:
            continue
        nodes = trees[-1]
        depth = len(m[1])
        if m[2] == "Else":
            while open_[-1][0] > depth:
                open_.pop()
            open_[-1] = (depth, open_[-1][1], "right")
            continue
        new = len(nodes)
        if open_:
            nodes[open_[-1][1]][2 if open_[-1][2] == "left" else 3] = new
        if m[2] == "If":
            nodes.append([int(m[3]), float(m[5]), new, new, 0.0])
            open_.append((depth, new, "left"))
        else:
            nodes.append([-1, 0.0, new, new, float(m[6])])
    size = max(map(len, trees))
    table = np.array([t + [[-1, 0.0, 0, 0, 0.0]] * (size - len(t)) for t in trees], np.float64)
    return Trees(
        table[:, :, 0].astype(np.int32),
        table[:, :, 1].astype(np.float32),
        table[:, :, 2].astype(np.int32),
        table[:, :, 3].astype(np.int32),
        table[:, :, 4],
        np.array(weights),
    )


def decode(nodes: list[Node], log_odds: np.ndarray) -> list[str]:
    """Texts of the likeliest choice in which no chosen node lies below one that is not.

    What speaks for or against an element also counts for the text directly in it.
    """
    n = len(nodes)
    number = {id(node): i for i, node in enumerate(nodes)}
    own = log_odds.tolist()
    gain = [o + (own[number[id(x.parent)]] if x.text is not None and id(x.parent) in number else 0.0) for o, x in zip(own, nodes)]
    # From here on, gain of choosing a node and the best below it, against choosing nothing there.
    for i in range(n - 1, -1, -1):
        p = number.get(id(nodes[i].parent))
        if p is not None and gain[i] > 0:
            gain[p] += gain[i]
    chosen = [False] * n
    out = []
    for i, node in enumerate(nodes):
        p = number.get(id(node.parent))
        chosen[i] = gain[i] > 0 and (p is None or chosen[p])
        if chosen[i] and node.text is not None:
            out.append(node.text)
    return out


# Training pages


def _prose(rng: random.Random, pool: list[str]) -> str:
    words = rng.choice(pool).split()
    start = rng.randrange(max(1, len(words) - 5))
    return " ".join(words[start : start + rng.choice([4, 12, 30, 60, 120, 200])]) or "text"


#: Begins a main text block in a training page.
_MARK = "\ue000"


def layout(rng: random.Random, pool: list[str]) -> str:
    """A page in a random arrangement, its main text blocks marked."""
    esc = html.escape

    def short() -> str:
        return " ".join(_prose(rng, pool).split()[: rng.randint(1, 7)])

    def attr(*names: str) -> str:
        if not names or rng.random() < 0.15:
            return ""
        name = rng.choice(names)
        if rng.random() < 0.4:
            name += rng.choice(["-1", " box", "-wrap", " block", "-inner", " js-x", "_area", " col-4"])
        return f' {rng.choice(["class", "class", "class", "id"])}="{name}"'

    def links(n: int) -> str:
        return "".join(f'<li><a href="/{i}">{esc(short())}</a>{"</li>" if rng.random() < 0.8 else ""}' for i in range(n))

    def junk() -> str:
        kind = rng.randrange(13)
        text, n = esc(_prose(rng, pool)), rng.randint(2, 9)
        if kind == 0:
            return f'<nav{attr("nav", "menu")}><ul>{links(n)}</ul></nav>'
        if kind == 1:
            return f'<div{attr("menu", "navigation", "navbar", "breadcrumbs", "pagination")}><ul>{links(n)}</ul></div>'
        if kind == 2:
            return f'<div class="{rng.choice(["ad", "ads", "advert", "ad-slot", "sponsored", "promo", "advertisement"])}">{text}</div>'
        if kind == 3:
            inner = "".join(f"<p>{esc(_prose(rng, pool))}</p>" for _ in range(rng.randint(1, 3)))
            return f'<aside{attr("sidebar", "related", "widget")}><h3>{esc(short())}</h3>{inner}<ul>{links(n)}</ul></aside>'
        if kind == 4:
            inner = "".join(f"<p>{esc(_prose(rng, pool))}</p>" for _ in range(rng.randint(1, 3)))
            return f'<div class="{rng.choice(["sidebar", "side", "related", "widget", "right-rail", "popular"])}"><h4>{esc(short())}</h4>{inner}</div>'
        if kind == 5:
            return f'<div class="{rng.choice(["cookie-banner", "notice", "consent", "gdpr-notice", "alert", "modal", "popup", "disclaimer"])}"><p>{text}</p><button>OK</button></div>'
        if kind == 6:
            return f'<form action="/s"><label>{esc(short())}</label><input name="q"><p>{text}</p><button>Go</button></form>'
        if kind == 7:
            return f'<div class="{rng.choice(["newsletter", "subscribe", "login", "signup", "search"])}"><p>{text}</p></div>'
        if kind == 8:
            one = lambda: f'<{"li" if rng.random() < 0.5 else "div"}{attr("comment", "reply", "comment-body")}><p>{esc(_prose(rng, pool))}</p>'
            return f'<{(t := rng.choice(["div", "section", "ol"]))} class="{rng.choice(["comments", "comment-list", "discussion", "responses", "disqus"])}"><h3>{esc(short())}</h3>{"".join(one() for _ in range(rng.randint(1, 6)))}</{t}>'
        if kind == 9:
            return f'<div class="{rng.choice(["share", "social", "share-buttons", "follow"])}"><a href="#">{esc(short())}</a> <a href="#">{esc(short())}</a></div>'
        if kind == 10:
            return f'<header{attr("header", "site-header", "masthead")}><div>{esc(short())}</div><p>{esc(short())}</p></header>'
        if kind == 11:
            return f'<footer{attr("footer", "site-footer")}>&copy; {esc(short())} &middot; {text}</footer>'
        return f'<div class="{rng.choice(["footer", "copyright", "bottom", "legal"])}"><p>{text}</p></div>'

    def body() -> str:
        out = []
        if rng.random() < 0.8:
            out.append(f"<h1>{_MARK}{esc(short())}</h1>")
        for _ in range(rng.choice([0, 1, 1, 2, 3, 5, 9, 16])):
            kind = rng.random()
            text = _MARK + esc(short() if rng.random() < 0.25 else _prose(rng, pool))
            if kind < 0.6:
                out.append(f'<p>{text}{"</p>" if rng.random() < 0.85 else ""}')
            elif kind < 0.7:
                out.append(f"<p><b>{text}<br>")
            elif kind < 0.78:
                out.append(f"<h2>{text}</h2>")
            elif kind < 0.84:
                out.append(f"<blockquote>{text}</blockquote>")
            elif kind < 0.9:
                more = [f"<li>{_MARK}{esc(_prose(rng, pool))}</li>" for _ in range(rng.randint(1, 3))]
                out.append(f'<ul><li>{text}</li>{"".join(more)}</ul>')
            elif kind < 0.95:
                out.append(f'<p>{text} <a href="/x">{esc(short())}</a></p>')
            else:
                out.append(f"<div>{text}</div>")
        if rng.random() < 0.3:
            out.insert(rng.randint(0, len(out)), junk())
        return "".join(out)

    before = "".join(junk() for _ in range(rng.randint(0, 4)))
    wrap = rng.random()
    if wrap < 0.5:
        content = f'<article{attr("post", "article") if rng.random() < 0.5 else ""}>{body()}</article>'
    elif wrap < 0.65:
        content = f'<main{attr("main") if rng.random() < 0.5 else ""}>{body()}</main>'
    elif wrap < 0.9:
        content = f'<div class="{rng.choice(["content", "main", "article", "post-content", "entry", "story", "text"])}">{body()}</div>'
    else:
        content = f"<div>{body()}</div>"
    after = "".join(junk() for _ in range(rng.randint(0, 5)))
    page = before + content + after
    if rng.random() < 0.4:
        page = f'<div class="{rng.choice(["wrapper", "page", "container", "site"])}">{page}</div>'
    head = f"<!DOCTYPE html><html><head><title>{esc(short())}</title><style>p{{}}</style></head><body>"
    return head + page + ("</body></html>" if rng.random() < 0.8 else "")


def _label(root: Node) -> None:
    """Mark the blocks of the main text and all elements above them."""
    for node in list(_walk(root)):
        if node.text is not None and node.text.startswith(_MARK):
            node.text = node.text.replace(_MARK, "")
            up: Node | None = node
            while up is not None and not up.kind:
                up.kind = True
                up = up.parent


def _walk(root: Node) -> Iterator[Node]:
    todo = list(reversed(root.children))
    while todo:
        node = todo.pop()
        yield node
        todo += reversed(node.children)


def train(pages: DataFrame, seed: int = 11, sample: int = SAMPLE_PAGES, layouts: int = LAYOUTS) -> Trees:
    """Fit the trees on pages laid out anew from the texts of at most ``sample`` pages, the first by hash of their url.

    Pages of more than ``SAMPLE_CHARS`` characters lend no texts, so the sample is bounded; the others are read whole.
    """
    spark = pages.sparkSession
    rows = pages.where(F.length("html") <= SAMPLE_CHARS).select("html", F.xxhash64("url", "page_id").alias("h"), "page_id").orderBy("h", "page_id").limit(sample).collect()
    pool = [n.text for r in rows for n in _walk(parse(r["html"])) if n.text and len(n.text) > 40] or ["some words that stand for the text of a page"]
    rng = random.Random(seed)
    data, labels = [], []
    for _ in range(layouts):
        root = parse(layout(rng, pool))
        _label(root)
        nodes, x = features(root)
        data += x.astype(float).tolist()
        labels += [float(n.kind) for n in nodes]
    frame = spark.createDataFrame(pd.DataFrame({"label": labels, "x": data})).repartition(2)
    frame = frame.select("label", array_to_vector("x").alias("features")).cache()
    try:
        model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=seed, maxBins=48).fit(frame)
    finally:
        frame.unpersist()
    return trees_of(model.toDebugString, list(model.treeWeights))


def extract(pages: DataFrame, model: Trees, keep=(), source: str = "html") -> DataFrame:
    """``keep`` columns and ``text``, the main text of every page.

    Blocks are joined by one line feed in page order.  A null or empty page
    and one without main text give an empty text; a page is read whole,
    whatever its length; repeated rows give the same text; other columns are dropped.
    """
    schema = T.StructType([pages.schema[c] for c in keep]).add("text", T.StringType())

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(0, len(frame), _ROWS):
                part = frame.iloc[at : at + _ROWS]
                read = [features(parse(h or "")) for h in part["_source"]]
                odds = model.log_odds(np.concatenate([x for _, x in read]))
                cuts = np.cumsum([len(n) for n, _ in read])[:-1]
                texts = ["\n".join(decode(n, o)) for (n, _), o in zip(read, np.split(odds, cuts))]
                yield part.drop(columns="_source").assign(text=texts)

    return pages.select(*keep, F.col(source).alias("_source")).mapInPandas(run, schema)
