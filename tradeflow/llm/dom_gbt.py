"""Main text of HTML pages by gradient-boosted trees over DOM nodes.

A page becomes a tree of element nodes; text that stands loose between boxes
is a leaf of its own in each block, so that a notice in the body and a line in
the article are told apart. Each node gets features: its kind of
tag, tokens of its class, id and role, depth, place among its siblings, text
and link density of its subtree, its share of the page, and the tokens of its
ancestors. Boosted trees, trained here in numpy, give each node the odds of
belonging to (or holding) the main text. Decoding takes the most likely
labelling in which a dropped node has no kept descendant, by one pass up and
one down the tree, so choices never contradict each other.

Training takes a bounded, deterministic sample of the pages (``SAMPLE``) whose
markup names its article. Their nodes are labelled by that element, and each
page is also rewritten into other layouts (other tags and class names; lists,
tables, sections, headers, details, figures and loose lines in the article;
boilerplate, boxed and loose, around and inside it), so that the trees learn
from density and tokens and not from one template. All pages are then
extracted whole.

Cases: null, empty or text-free html has an empty text. Broken markup is
closed as browsers do in the common cases; a head ends where a body's tag or
text begins, and a dropped element (button, svg, ...) that lacks its end tag
ends with the element around it or before the next box; unknown tags count as boxes. If no
page of the sample names its article, the rewritten layouts of plain
paragraphs alone are learned from. Repeated rows get equal results. Only the
id, url and html columns are read. An empty table gives an empty result.
"""

from __future__ import annotations

import html as html_lib
import random
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pages that the trees are trained on, at most.
SAMPLE = 200
TREES, DEPTH, SHRINK, BINS = 60, 5, 0.25, 32

# Element names of HTML by what they do.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
RAW = {"script", "style", "textarea", "title", "noscript", "iframe"}  # no markup inside
DROPPED = {"head", "svg", "button", "select", "object", "template", "canvas"}  # with all below them
IN_HEAD = {"base", "link", "meta", "title", "noscript", "style", "script", "template"}  # other tags end a head
INLINE = {"a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark",
          "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "img"}
KINDS = (("article", "main"), ("p", "blockquote", "pre", "figure", "figcaption"), ("h1", "h2", "h3", "h4", "h5", "h6"),
         ("ul", "ol", "dl", "menu"), ("li", "dt", "dd"), ("nav",), ("aside",), ("footer",), ("header",), ("form", "fieldset"),
         ("table", "tbody", "tr", "td", "th"), ("section",), ("div", "center"), ("body", "html"), ("dialog", "details"))
#: The name of a leaf of loose text.
LEAF = "#text"
# Words that authors name boxes by.
GOOD_WORDS = ("article", "content", "post", "entry", "story", "main", "body", "text", "page")
BAD_WORDS = (
    ("nav", "menu", "breadcrumb", "breadcrumbs", "navbar", "topbar", "toolbar", "pager", "pagination", "toc"),
    ("footer", "foot", "copyright", "legal", "bottom"), ("header", "head", "masthead", "banner", "logo", "top"),
    ("sidebar", "side", "aside", "widget", "related", "recommended", "more", "trending", "popular", "tags"),
    ("ad", "ads", "advert", "adverts", "advertisement", "sponsor", "sponsored", "promo", "promotion"),
    ("comment", "comments", "reply", "replies", "discussion", "disqus", "respond"),
    ("cookie", "notice", "consent", "alert", "popup", "modal", "overlay", "gdpr", "warning", "subscribe", "newsletter", "signup"),
    ("share", "social", "form", "search", "login", "author", "meta", "byline"))
# Open elements that a start tag closes.
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}
WALLS = {"ul", "ol", "dl", "table", "body", "html", "div", "section", "article", "main", "aside", "nav", "td", "th", "blockquote"}
WORD = re.compile(r"[a-z]+")
SPACE = re.compile(r"[\x20\x09-\x0D]+")
ATTR = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][\w:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>", re.S)
#: A raw element's start, whose attributes may be in any disorder.
RAW_TAG = re.compile("<(" + "|".join(sorted(RAW)) + r")(?=[\s/>])([^>]*)>", re.I)
RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*>", re.I) for t in RAW}
EDGE = {t: re.compile(rf"<(/?){t}(?=[\s/>])[^>]*>", re.I) for t in DROPPED}


def closed_starts(text: str, name: str) -> set[int]:
    """Places of the start tags of a dropped element that have an end tag of their own."""
    out, waiting = set(), []
    for m in EDGE[name].finditer(text):
        if m.group(1):
            if waiting:
                out.add(waiting.pop())
        else:
            if name in ("button", "select"):  # a second start ends the first
                waiting.clear()
            waiting.append(m.start())
    return out


class Page:
    """Element nodes in page order, and the text pieces between tags."""

    def __init__(self, text: str):
        self.tag, self.parent, self.words = ["html"], [-1], [()]
        self.pieces: list[tuple[int, str]] = []  # node, text ("\n" text None: a block edge)
        self.open: Counter = Counter()  # open elements by name
        self._parse(text)
        self._leaves()

    def _leaves(self) -> None:
        """Loose text of a node that also holds boxes becomes a leaf, one a block."""
        holds = {self.parent[i] for i in range(1, len(self.tag)) if self.tag[i] not in INLINE}
        leaf: dict[int, int] = {}
        for i, (node, t) in enumerate(self.pieces):
            if t is None:
                leaf.clear()
            elif node in holds and t.strip(" \t\n\x0b\f\r"):
                if node not in leaf:
                    leaf[node] = len(self.tag)
                    self.tag.append(LEAF)
                    self.parent.append(node)
                    self.words.append(())
                self.pieces[i] = (leaf[node], t)

    def _shut(self, open_nodes: list[int], first: int) -> None:
        """End the open elements from a place on."""
        for i in open_nodes[first:]:
            self.open[self.tag[i]] -= 1
        del open_nodes[first:]

    def _parse(self, text: str) -> None:
        open_nodes, at = [0], 0
        hidden: list[str] = []  # open elements from a dropped one on; they make no nodes
        closed: dict[str, set[int]] = {}
        sure = False  # the dropped element has its own end tag
        while m := TAG.search(text, at):
            if m.start() > at:
                if hidden == ["head"] and text[at:m.start()].strip(" \t\n\x0b\f\r"):
                    hidden = []
                if not hidden:
                    self._text(open_nodes[-1], text[at:m.start()])
            raw = RAW_TAG.match(text, m.start())
            if raw and not ("svg" in hidden and raw.group(2).endswith("/")):
                if hidden == ["head"] and raw.group(1).lower() not in IN_HEAD:
                    hidden = []
                end = RAW_END[raw.group(1).lower()].search(text, raw.end())
                at = end.end() if end else len(text)
                continue
            at = m.end()
            name = m.group(2)
            if name is None:
                continue
            name = name.lower()
            ends_itself = m.group(3).rstrip().endswith("/")
            if hidden:
                if m.group(1):
                    if name in hidden:
                        del hidden[len(hidden) - 1 - hidden[::-1].index(name):]
                        continue
                    # The end of an element around it ends a dropped one that lacks its own end.
                    if sure or name in INLINE or not (name in ("body", "html") or self.open[name]):
                        continue
                    hidden = []
                elif hidden == ["head"] and name not in IN_HEAD or not sure and (
                        name in KIND_OF or name == hidden[0] and name in ("button", "select")):
                    hidden = []
                else:
                    if name not in VOID and name not in INLINE and not ("svg" in hidden and ends_itself):
                        hidden.append(name)
                    continue
            if name in DROPPED and not m.group(1):
                if name == "head" and any(t not in ("html", "head") for t in self.tag) or name == "svg" and ends_itself:
                    continue
                if name not in closed:
                    closed[name] = closed_starts(text, name)
                sure = name != "head" and m.start() in closed[name]
                hidden = [name]
                continue
            if m.group(1):
                if name in INLINE:
                    if self.tag[open_nodes[-1]] == name and len(open_nodes) > 1:
                        self._shut(open_nodes, len(open_nodes) - 1)
                    continue
                for i in range(len(open_nodes) - 1, 0, -1) if self.open[name] else ():
                    if self.tag[open_nodes[i]] == name:
                        self._shut(open_nodes, i)
                        self.pieces.append((open_nodes[-1], None))
                        break
                continue
            if name == "br":
                self.pieces.append((open_nodes[-1], " "))
                continue
            if name in VOID:
                if name == "hr":
                    self.pieces.append((open_nodes[-1], None))
                continue
            if name not in INLINE:
                # A box ends open inline elements and paragraphs; list items and cells end their like.
                ends = CLOSES.get(name, ()) or {"p"}
                for i in range(len(open_nodes) - 1, 0, -1) if any(self.open[t] for t in (*ends, "p")) else ():
                    tag = self.tag[open_nodes[i]]
                    if tag in ends or tag == "p":
                        self._shut(open_nodes, i)
                        break
                    if tag in WALLS:
                        break
                while len(open_nodes) > 1 and self.tag[open_nodes[-1]] in INLINE:
                    self._shut(open_nodes, len(open_nodes) - 1)
                self.pieces.append((open_nodes[-1], None))
            elif name != "a":
                continue  # inline marks neither part blocks nor make nodes; links count for density
            attrs = m.group(3)
            words = ()
            if attrs:
                words = tuple(w for a in ATTR.finditer(attrs) for w in WORD.findall((a.group(2) or a.group(3) or a.group(4) or "").lower()))
            self.tag.append(name)
            self.parent.append(open_nodes[-1])
            self.words.append(words)
            if not attrs.rstrip().endswith("/") or name in INLINE:
                open_nodes.append(len(self.tag) - 1)
                self.open[name] += 1
        if at < len(text) and (not hidden or hidden == ["head"] and text[at:].strip(" \t\n\x0b\f\r")):
            self._text(open_nodes[-1], text[at:])

    def _text(self, node: int, raw: str) -> None:
        if "&" in raw:
            raw = html_lib.unescape(raw)
        self.pieces.append((node, raw))

    def features(self) -> np.ndarray:
        n = len(self.tag)
        parent = np.array(self.parent)
        own, link, stops = np.zeros(n), np.zeros(n), np.zeros(n)
        for node, t in self.pieces:
            if t:
                size = len(t.strip(" \t\n\x0b\f\r"))
                own[node] += size
                stops[node] += t.count(".") + t.count(",")
                if self.tag[node] == "a":
                    link[node] += size
        kinds = np.array([len(KINDS) + 1 if t == LEAF else KIND_OF.get(t, len(KINDS)) for t in self.tag])
        marks = np.zeros((n, len(BAD_WORDS) + 1))
        for i, words in enumerate(self.words):
            for w in words:
                k = WORD_GROUP.get(w)
                if k is not None:
                    marks[i, k] = 1
        tree, links, commas = own.copy(), link.copy(), stops.copy()
        nodes, paras = np.ones(n), (kinds == 1).astype(float)
        depth, up = np.zeros(n), np.zeros((n, marks.shape[1] + 4))
        flags = np.concatenate([marks, (kinds == 0)[:, None], (kinds == 5)[:, None], ((kinds == 6) | (kinds == 7))[:, None],
                                (kinds == 9)[:, None]], axis=1).astype(float)
        for i in range(n - 1, 0, -1):  # children stand after their parents
            p = parent[i]
            tree[p] += tree[i]
            links[p] += links[i]
            commas[p] += commas[i]
            nodes[p] += nodes[i]
            paras[p] += paras[i]
        place, seen, last_size, before = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n)
        for i in range(1, n):
            p = parent[i]
            depth[i] = depth[p] + 1
            up[i] = np.maximum(up[p], flags[p])
            place[i] = seen[p]
            before[i] = last_size[p]
            last_size[p] = tree[i]
            seen[p] += 1
        siblings = seen[np.maximum(parent, 0)]
        total = max(tree[0], 1.0)
        one_hot = (kinds[:, None] == np.arange(len(KINDS) + 2)[None, :]).astype(float)
        numbers = np.stack([
            depth, place, siblings, place / np.maximum(siblings, 1), np.log1p(own), np.log1p(tree), tree / total,
            links / np.maximum(tree, 1), np.log1p(tree / nodes), np.log1p(nodes), np.log1p(paras), commas / np.maximum(tree, 1) * 100,
            np.log1p(before), tree[np.maximum(parent, 0)] / total, kinds[np.maximum(parent, 0)]], axis=1)
        return np.concatenate([numbers, one_hot, flags[:, :marks.shape[1]], up], axis=1).astype(np.float32)

    def decode(self, odds: np.ndarray) -> np.ndarray:
        """The most likely labels in which no dropped node has a kept descendant. odds: log-odds of keeping."""
        n = len(odds)
        best = odds.copy()  # gain of keeping the node over dropping it with all below
        for i in range(n - 1, 0, -1):
            if best[i] > 0:
                best[self.parent[i]] += best[i]
        keep = np.zeros(n, bool)
        keep[0] = best[0] > 0
        for i in range(1, n):
            keep[i] = keep[self.parent[i]] and best[i] > 0
        return keep

    def text(self, keep: np.ndarray) -> str:
        blocks, own = [], []
        for node, t in self.pieces:
            if t is None:
                if own:
                    blocks.append("".join(own))
                    own = []
            elif keep[node]:
                own.append(t)
        if own:
            blocks.append("".join(own))
        done = (SPACE.sub(" ", b).strip(" ") for b in blocks)
        return "\n\n".join(b for b in done if b)


KIND_OF = {t: i for i, tags in enumerate(KINDS) for t in tags}
WORD_GROUP = {w: i + 1 for i, words in enumerate(BAD_WORDS) for w in words} | {w: 0 for w in GOOD_WORDS}


# Training ------------------------------------------------------------------------

def labels(page: Page) -> np.ndarray | None:
    """1 for nodes of the named article and those around it, 0 for the rest; None if no article is named."""
    n = len(page.tag)
    mark = np.zeros(n, bool)
    tags = page.tag
    name = "article" if "article" in tags else "main"
    good = {i for i in range(n) if tags[i] == name or "goldarticle" in page.words[i]}
    if not good:
        return None
    bad = {5, 6, 7, 9}
    for i in range(n):
        p = page.parent[i]
        inside = i in good or (p >= 0 and mark[p])
        junk = KIND_OF.get(tags[i]) in bad or "goldjunk" in page.words[i]
        mark[i] = inside and not junk
    for i in range(n - 1, 0, -1):
        if mark[i]:
            p = page.parent[i]
            while p >= 0 and not mark[p]:
                mark[p] = True
                p = page.parent[p]
    return mark.astype(np.float64)


#: Lines that sites put anywhere, beside those that the sample's pages hold.
NOTICES = ("This site uses cookies.", "We use cookies to improve your visit. Accept", "\u00a9 2024 All rights reserved", "\u00a9 2019 Example",
           "Share this page", "Read more", "Advertisement", "Subscribe to our newsletter", "Skip to content", "Log in", "Privacy policy")


def layouts(blocks: list[str], junk: list[str], rng: random.Random) -> str:
    """A page with the blocks as its article, in some other layout, with junk around and inside."""
    def name(words) -> str:
        w = rng.choice(words)
        return rng.choice((f'class="{w}"', f'id="{w}"', f'class="{w} {rng.choice("abc")}{rng.randint(1, 9)}"', f'class="site-{w}"', f'class="{w}-box"'))

    def filler() -> str:
        return html_lib.escape(rng.choice(junk)) if junk and rng.random() < 0.7 else rng.choice(NOTICES)

    def box(kind: int, gold: bool) -> str:
        tag = rng.choice(({1: "nav", 2: "footer", 3: "header", 4: "aside"}.get(kind, "div"), "div", "section", "div"))
        if gold and tag == "header":
            tag = "div"
        attr = name(BAD_WORDS[kind - 1]) if tag in ("div", "section") or rng.random() < 0.5 else ""
        if gold:
            attr = re.sub(r'="', '="goldjunk ', attr) if attr else 'class="goldjunk"'
        if kind in (1, 4) and rng.random() < 0.7:
            inner = "<ul>" + "".join(f'<li><a href="#">{filler()[:20]}</a></li>' for _ in range(rng.randint(2, 9))) + "</ul>"
        elif kind == 6:
            inner = "".join(f'<div class="{rng.choice(("comment", "reply", "item"))}"><p>{filler()}</p></div>' for _ in range(rng.randint(1, 5)))
        elif kind == 8 and rng.random() < 0.5:
            inner = f"<form><p>{filler()}</p><label>{filler()[:12]}</label><input></form>"
        else:
            inner = "".join(rng.choice(("<p>{}</p>", "<div>{}</div>", "{}")).format(filler()) for _ in range(rng.randint(1, 3)))
        return f"<{tag} {attr}>{inner}</{tag}>"

    def loose() -> str:
        return rng.choice(("{}", "{}", "<br>{}<br>", "{}<hr>", '{} <a href="#">OK</a>')).format(filler()[:80])

    def some(b: str) -> list[str]:
        """A block as a few short entries."""
        words, out = b.split()[:40], []
        while words:
            n = rng.randint(1, 5)
            out.append(html_lib.escape(" ".join(words[:n])))
            words = words[n:]
        return out or ["x"]

    def part(b: str, first: bool) -> str:
        body, kind = html_lib.escape(b), rng.random()
        if first and kind < 0.7:
            return rng.choice(("<h1>{}</h1>", "<h1>{}</h1>", "<header><h1>{}</h1></header>", '<header class="entry-header"><h1>{}</h1></header>',
                               "<div><h1>{}</h1></div>")).format(body)
        if kind < 0.55:
            return f"<p>{body}</p>"
        few = some(b)
        if kind < 0.65:
            tag = rng.choice(("ul", "ol"))
            return f"<{tag}>" + "".join(f"<li>{x}</li>" for x in rng.choice((few, [body]))) + f"</{tag}>"
        if kind < 0.72:
            rows = [few[i:i + 3] for i in range(0, len(few), 3)]
            cell = rng.choice(("td", "td", "th"))
            return "<table>" + "".join("<tr>" + "".join(f"<{cell}>{x}</{cell}>" for x in r) + "</tr>" for r in rows) + "</table>"
        if kind < 0.77:
            return "<dl>" + "".join(f"<dt>{x}</dt><dd>{y}</dd>" for x, y in zip(few[::2], few[1::2] or few)) + "</dl>"
        if kind < 0.84:
            return f"<section><h2>{few[0]}</h2><p>{rng.choice((body, few[-1]))}</p></section>"
        if kind < 0.87:
            return f"<details><summary>{few[0]}</summary><p>{body}</p></details>"
        if kind < 0.91:
            return f"<div>{rng.choice((few[0], ' '.join(few[:3]), body))}</div>"
        if kind < 0.94:
            return f'<figure><img src="x"><figcaption>{few[0]}</figcaption></figure>'
        if kind < 0.97:
            return rng.choice((body, f"{few[0]}<br>{few[-1]}<br>"))
        return rng.choice(("<h2>{}</h2>", "<h3>{}</h3>", "<blockquote>{}</blockquote>", "<pre>{}</pre>")).format(rng.choice((body, few[0])))
    parts = []
    for i, b in enumerate(blocks):
        parts.append(part(b, i == 0))
        if rng.random() < 0.06:
            parts.append(box(rng.choice((4, 4, 5, 7, 8)), True))
    if rng.random() < 0.3:
        parts.append(box(6, True))
    tag = rng.choice(("article", "article", "main", "div", "section", "div"))
    attr = f'class="goldarticle {rng.choice(GOOD_WORDS + ("x", "c1"))}"' if rng.random() < 0.85 else 'class="goldarticle"'
    article = f"<{tag} {attr}>{''.join(parts)}</{tag}>"
    for _ in range(rng.randint(0, 2)):
        article = f"<div {name(GOOD_WORDS + ('wrap', 'container', 'row'))}>{article}</div>"
    first = [box(k, False) for k in rng.sample((1, 3, 5, 7, 8, 4), rng.randint(0, 4))]
    last = [box(k, False) for k in rng.sample((2, 4, 5, 6, 7, 1), rng.randint(0, 4))]
    for around in (first, last):
        if rng.random() < 0.4:
            around.insert(rng.randint(0, len(around)), loose())
    return f"<html><head><title>t</title></head><body>{''.join(first)}{article}{''.join(last)}</body></html>"


def training_set(pages: list[str], copies: int = 4) -> tuple[np.ndarray, np.ndarray]:
    rng = random.Random(5)
    x, y, texts, junk = [], [], [], []
    for h in pages:
        page = Page(h)
        own = labels(page)
        if own is None:
            continue
        x.append(page.features())
        y.append(own)
        texts.append(page.text(own > 0).split("\n\n"))
        junk += [t for t in page.text(own < 1).split("\n\n") if t]
    for blocks in texts:
        for _ in range(copies):
            page = Page(layouts(blocks[:40], junk, rng))
            own = labels(page)
            # The gold marks must not be seen by the trees: they are no words of any group.
            x.append(page.features())
            y.append(own)
    if not x:
        for k in range(50):
            page = Page(layouts([f"Some plain words, {i} of them. " * (2 + i % 5) for i in range(3 + k % 6)], ["link", "more words"], rng))
            x.append(page.features())
            y.append(labels(page))
    return np.concatenate(x), np.concatenate(y)


class Trees:
    """Gradient-boosted trees for the log-odds, on binned features."""

    def __init__(self, cuts: list[np.ndarray], trees: list, base: float):
        self.cuts, self.trees, self.base = cuts, trees, base

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray) -> "Trees":
        cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
        b = cls._bins(x, cuts)
        mean = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        base = float(np.log(mean / (1 - mean)))
        score, trees = np.full(len(y), base), []
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-score))
            tree, leaf = cls._grow(b, y - p, p * (1 - p))
            score += tree[2][leaf]
            trees.append(tree)
        return cls(cuts, trees, base)

    @staticmethod
    def _bins(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1).astype(np.int16)

    @staticmethod
    def _grow(b: np.ndarray, g: np.ndarray, h: np.ndarray) -> tuple[tuple, np.ndarray]:
        """A full binary tree: (feature, bin) of the inner nodes, value of all nodes; and each row's leaf."""
        size = (1 << (DEPTH + 1)) - 1
        feature, cut, value = np.zeros(size, np.int64), np.full(size, BINS + 1), np.zeros(size)
        at = np.zeros(len(g), np.int64)
        for level in range(DEPTH):
            first, width = (1 << level) - 1, 1 << level
            key = at - first
            best = np.full(width, 1e-6)
            for f in range(b.shape[1]):
                cell = key * (BINS + 1) + b[:, f]
                gs = np.bincount(cell, g, width * (BINS + 1)).reshape(width, -1).cumsum(1)
                hs = np.bincount(cell, h, width * (BINS + 1)).reshape(width, -1).cumsum(1)
                G, H = gs[:, -1:], hs[:, -1:]
                gain = gs ** 2 / (hs + 1) + (G - gs) ** 2 / (H - hs + 1) - G ** 2 / (H + 1)
                k = gain.argmax(1)
                top = gain[np.arange(width), k]
                new = top > best
                best[new] = top[new]
                feature[first:first + width][new], cut[first:first + width][new] = f, k[new]
            at = 2 * at + 1 + (b[np.arange(len(g)), feature[at]] > cut[at])
        gs, hs = np.bincount(at, g, size), np.bincount(at, h, size)
        value = SHRINK * gs / (hs + 1)
        return (feature, cut, value), at

    def odds(self, x: np.ndarray) -> np.ndarray:
        b, rows = self._bins(x, self.cuts), np.arange(len(x))
        out = np.full(len(x), self.base)
        for feature, cut, value in self.trees:
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (b[rows, feature[at]] > cut[at])
            out += value[at]
        return out


def train(pages: DataFrame, *, id_col: str = "page_id", html_col: str = "html", sample: int = SAMPLE) -> Trees:
    """Trees from a bounded sample of the pages, taken by hash order."""
    have = pages.where(F.col(html_col).isNotNull() & F.col(id_col).isNotNull())
    # The ids first: a sorted limit sends its rows from every task.
    ids = [r["id"] for r in have.select(F.col(id_col).alias("id")).distinct().orderBy(F.xxhash64("id"), "id").limit(sample).collect()]
    rows = (have.where(F.col(id_col).isin(ids)).groupBy(F.col(id_col).alias("id")).agg(F.min(html_col).alias("html"))
            .orderBy(F.xxhash64("id"), "id").collect() if ids else [])
    return Trees.fit(*training_set([r["html"] for r in rows]))


# Extraction ----------------------------------------------------------------------

def _extract(state: tuple):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = Trees(*state)
        for b in batches:
            done, start = [], 0
            group, nodes = [], 0
            for i, cell in enumerate(b.column(2)):
                group.append(Page(cell.as_py()))
                nodes += len(group[-1].tag)
                if nodes > 20_000 or i + 1 == b.num_rows:
                    odds = trees.odds(np.concatenate([p.features() for p in group]))
                    at = 0
                    for p in group:
                        n = len(p.tag)
                        done.append(p.text(p.decode(odds[at:at + n])))
                        at += n
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).slice(start, i + 1 - start), b.column(1).slice(start, i + 1 - start), pa.array(done, pa.string())],
                        names=["page_id", "url", "text"])
                    done, group, nodes, start = [], [], 0, i + 1
    return run


def main_text(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
              trees: Trees | None = None) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    trees = trees or train(pages, id_col=id_col, html_col=html_col)
    p = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                     F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    found = p.mapInArrow(_extract((trees.cuts, trees.trees, trees.base)), "page_id long, url string, text string")
    return found.withColumn("n_chars", F.length("text").cast("long"))
