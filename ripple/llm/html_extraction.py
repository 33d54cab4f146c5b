"""Main text of web pages: gradient-boosted trees over DOM nodes, decoded hierarchically.

**Nodes.** A tolerant parser turns a page into its block elements; inline elements belong to the block around them.
A run of text of one block without a block in between is a text block. Scripts, styles, comments of the
markup, and what browsers do not show as text are left out: scripts, styles, text areas and titles up to their
closing tag, other such elements (``UNSEEN``) up to theirs or, if they have none, to the end of their parent.

**Features.** Kind of tag; words of class, id, role and label of the node and of its ancestors, each hashed into one of
``NAMES`` places, so that the trees find out which words tell; whether it is hidden; text length, link density,
punctuation and characters per tag of the subtree; depth; place among siblings and on the page; how many
siblings look alike; share of the parent's text.

**Training.** No table has labels, so truth comes from layouts. The paragraphs of at most ``SAMPLE`` pages (those with
the smallest hash of their id among those with html, of any length) are laid out again at random as articles among menus, headers, sidebars,
notices, adverts, forms, comments and footers in many spellings; a node is positive if it holds article text. Some of the
names in a layout are words of the sampled pages' own attributes, given to any part, so that the trees do not
rest on names alone. The
trees minimise the log loss over these nodes (binned features, second-order gains). The fitting is bounded by the
sample, and the same at any table size: a page gives its first ``PARAGRAPHS`` paragraphs, the most that a layout
takes, in at most ``PAGE_CHARS`` characters.

**Decoding.** A kept node needs all its ancestors kept: of all such choices the one with the largest sum of log odds is
taken, by one pass up and one pass down the tree. So no menu entry survives in a dropped menu.

Null or empty html, and pages without kept text: empty text. Broken markup is parsed as far as it goes. Pages are
independent rows; repeated and null ids are kept. Empty table: empty result.
"""

from __future__ import annotations

import functools
import html
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE, LAYOUTS = 300, 1_500
PARAGRAPHS, PAGE_CHARS, PAGE_NAMES = 60, 50_000, 100
TREES, DEPTH, RATE, BINS = 120, 4, 0.25, 32
FREE_NAMES = 0.25

#: Elements of HTML by their role.
RAW = "script|style|textarea|title"
UNSEEN = set("noscript template svg math iframe object canvas audio video select button".split())
FOREIGN = {"svg", "math"}       # in these a tag that ends with "/" is closed, and there is no raw text
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
             "strike strong sub sup time tt u var wbr img input picture map output nobr".split())
KINDS = {name: i for i, group in enumerate((
    "nav menu", "header", "footer", "aside", "form fieldset dialog", "article main", "p", "h1 h2 h3 h4 h5 h6 hgroup",
    "ul ol dl", "li dt dd", "table thead tbody tfoot tr td th caption", "blockquote pre figure figcaption address",
    "section")) for name in group.split()}
N_KINDS = 14
AWAY_TAGS = {"nav", "menu", "header", "footer", "aside", "form", "dialog"}
#: Places that words of names are hashed into.
NAMES = 256

_TAGS = (r"<(/?)([a-zA-Z][\w:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][\w:-]*)([^>]*)>|<[!?/][^>]*>")
_COMMENT = r"<!--.*?(?:-->|\Z)|"
_TOKEN = re.compile(
    _COMMENT + rf"<({RAW})(?=[\s/>])(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1(?=[\s/>])[^>]*>|\Z)|" + _TAGS, re.S | re.I)
# the same groups where there is no raw text
_FOREIGN_TOKEN = re.compile(_COMMENT + r"((?!))|" + _TAGS, re.S | re.I)
_ATTRIBUTE = re.compile(r"([^\s=>\"'/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
NAMING = {"class", "id", "role", "aria-label", "itemprop"}
_UNSHOWN = re.compile(r"(?:^|[;\s])(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.I)
_HREF = re.compile(r"(?:^|[\s\"'])href\s*=", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_SPACE = re.compile(r"\s+")


@dataclass
class Node:
    parent: int
    tag: str
    names: tuple[int, ...] = ()     # places of the words of its attributes
    hidden: bool = False
    children: list[int] = field(default_factory=list)
    own: int = 0        # characters of its own text
    links: int = 0
    words: int = 0
    marks: int = 0
    tags: int = 1


@dataclass
class Page:
    nodes: list[Node]
    runs: list[tuple[int, str]]         # (node, text) in page order


@functools.lru_cache(1 << 16)
def place(word: str) -> int:
    return zlib.crc32(word.encode()) % NAMES


def attribute_words(attributes: str) -> tuple[set[str], bool]:
    """Words of the naming attributes, and whether the element is hidden: by an attribute of that name, or by its style."""
    words: set[str] = set()
    hidden = False
    for a in _ATTRIBUTE.finditer(attributes):
        name, value = a[1].lower(), a[2] or a[3] or a[4] or ""
        if name in NAMING:
            words.update(w.lower() for w in _WORD.findall(value))
            # the class that style sheets hide, not one that has the word in it
            hidden |= name == "class" and "hidden" in value.lower().split()
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and _UNSHOWN.search(value):
            hidden = True
    return words, hidden


def parse(source: str | None) -> Page:
    nodes = [Node(-1, "body")]
    runs: list[tuple[int, str]] = []
    stack = [0]
    pieces: list[str] = []
    in_link, at = 0, 0                  # in_link: the depth at which the open link began
    unseen: list[str] = []              # the open unseen element and the elements open in it
    inline: Counter[str] = Counter()    # open inline elements outside of it

    def flush() -> None:
        text = _SPACE.sub(" ", "".join(pieces)).strip()
        pieces.clear()
        if text:
            node = nodes[stack[-1]]
            node.own += len(text)
            node.words += text.count(" ") + 1
            node.marks += sum(map(text.count, ".,;:!?"))
            runs.append((stack[-1], text))

    def add(raw: str) -> None:
        if raw:
            text = html.unescape(raw) if "&" in raw else raw
            pieces.append(text)
            if in_link:
                nodes[stack[-1]].links += len(text.strip())

    def close(name: str, barrier: frozenset = frozenset()) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if nodes[stack[i]].tag == name:
                del stack[i:]
                return
            if nodes[stack[i]].tag in barrier:
                return

    def left() -> int:
        """A link ends with the element around it, too."""
        return in_link if len(stack) >= in_link else 0

    def ends_parent(name: str, ending: bool) -> bool:
        """Whether a tag that closes nothing in the unseen element ends the element around it."""
        if ending:
            return name in ("html", "body") or inline[name] > 0 or any(nodes[i].tag == name for i in stack[1:])
        tag = nodes[stack[-1]].tag
        return len(unseen) == 1 and any(name in group and tag in group for group in (("li",), ("dt", "dd"), ("td", "th", "tr")))

    source = source or ""
    while token := (_FOREIGN_TOKEN if FOREIGN.intersection(unseen) else _TOKEN).search(source, at):
        if not unseen:
            add(source[at:token.start()])
        at = token.end()
        name = token[3] or token[6]
        if not name:
            continue
        name, ending, attributes = name.lower(), token[2] or token[5], token[4] or token[7] or ""
        if unseen:
            if ending and name in unseen:
                while unseen.pop() != name:
                    pass
                continue
            if not ends_parent(name, bool(ending)):
                if not ending and name not in VOID and not (attributes.endswith("/") and FOREIGN.intersection((*unseen, name))):
                    unseen.append(name)
                continue
            unseen.clear()
        if name in ("html", "body", "head"):
            continue
        if name in UNSEEN:
            if not ending and not (name in FOREIGN and attributes.endswith("/")):
                unseen.append(name)
        elif name == "br":
            pieces.append(" ")
        elif name in INLINE:
            if name not in VOID:
                inline[name] = max(inline[name] + (-1 if ending else 1), 0)
            nodes[stack[-1]].tags += 1
            if name == "a":
                in_link = len(stack) if not ending and _HREF.search(attributes) else 0
        elif ending:
            flush()
            close(name)
            in_link = left()
        elif name in VOID:
            if name == "hr":
                flush()
        else:
            flush()
            if name == "li":
                close("li", frozenset(("ul", "ol")))
            elif name in ("dt", "dd"):
                close("dt", frozenset(("dl",)))
                close("dd", frozenset(("dl",)))
            elif name in ("td", "th", "tr"):
                for x in ("td", "th") + (("tr",) if name == "tr" else ()):
                    close(x, frozenset(("table",)))
            elif nodes[stack[-1]].tag == "p":
                stack.pop()
            in_link = left()
            node = Node(stack[-1], name)
            if attributes:
                found, node.hidden = attribute_words(attributes)
                node.names = tuple({place(w) for w in found})
            nodes[stack[-1]].children.append(len(nodes))
            stack.append(len(nodes))
            nodes.append(node)
            if attributes.endswith("/"):
                stack.pop()
    if not unseen:
        add(source[at:] if not source[at:].startswith("<") else "")
    flush()
    return Page(nodes, runs)


def features(page: Page) -> np.ndarray:
    """One row per node."""
    nodes, n = page.nodes, len(page.nodes)
    size, links, words, marks, tags, items = (np.zeros(n) for _ in range(6))
    before = np.zeros(n)
    seen = 0
    for node, text in page.runs:        # characters of the page before the node's first text
        if size[node] == 0:
            before[node] = seen
        size[node] = 1
        seen += len(text)
    first = np.where(size > 0, before, np.inf)
    size[:] = 0
    for i in range(n - 1, -1, -1):
        v = nodes[i]
        size[i] += v.own
        links[i] += v.links
        words[i] += v.words
        marks[i] += v.marks
        tags[i] += v.tags
        items[i] += v.tag == "li"
        if v.parent >= 0:
            p = v.parent
            for total in (size, links, words, marks, tags, items):
                total[p] += total[i]
            first[p] = min(first[p], first[i])
    whole = max(size[0], 1)
    out = np.zeros((n, N_KINDS + 22 + 2 * NAMES), np.float32)
    own_names, all_names = out[:, -2 * NAMES:-NAMES], out[:, -NAMES:]       # of the node, of its ancestors
    depth, hidden, away_tag, here_tag = (np.zeros(n) for _ in range(4))
    tags_of = [Counter(nodes[s].tag for s in v.children) for v in nodes]
    for i, v in enumerate(nodes):
        p = v.parent
        if p >= 0:
            depth[i] = depth[p] + 1
            hidden[i] = hidden[p] + nodes[p].hidden
            np.maximum(all_names[p], own_names[p], out=all_names[i])
            away_tag[i], here_tag[i] = away_tag[p] + (nodes[p].tag in AWAY_TAGS), here_tag[p] + (nodes[p].tag in ("article", "main"))
        sibs = nodes[p].children if p >= 0 else [0]
        alike = tags_of[p][v.tag] if p >= 0 else 1
        out[i, KINDS.get(v.tag, N_KINDS - 1)] = 1
        if v.names:
            own_names[i, list(v.names)] = 1
        out[i, N_KINDS:N_KINDS + 22] = (
            v.hidden, hidden[i], away_tag[i], here_tag[i], math.log1p(size[i]), math.log1p(v.own),
            min(links[i] / max(size[i], 1), 1), math.log1p(words[i]), marks[i] / max(words[i], 1), size[i] / max(tags[i], 1),
            depth[i], math.log1p(len(v.children)), math.log1p(len(sibs)), alike / len(sibs), size[i] / max(size[p] if p >= 0 else 1, 1),
            min(first[i], whole) / whole, size[i] / whole, items[i] / max(tags[i], 1), size[i] / max(words[i], 1),
            min(links[p] / max(size[p], 1), 1) if p >= 0 else 0, math.log1p(size[p]) if p >= 0 else 0, v.own / max(size[i], 1))
    return out


@dataclass
class Trees:
    """Boosted trees as arrays: feature, threshold and two children of each node, or a value."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    value: np.ndarray
    roots: list[int]
    base: float

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            for _ in range(DEPTH):
                inner = self.feature[at] >= 0
                right = x[rows, np.maximum(self.feature[at], 0)] > self.cut[at]
                at = np.where(inner, self.left[at] + right, at)
            total += self.value[at]
        return total


def boost(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE) -> Trees:
    """Trees for the log loss, with splits at quantiles and second-order gains."""
    n_plain = x.shape[1] - 2 * NAMES        # the others are 0 or 1
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(n_plain)]
    binned = np.stack([np.searchsorted(c, x[:, j], "left").astype(np.uint8) for j, c in enumerate(cuts)], axis=1)
    has, which = np.nonzero(x[:, n_plain:])
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    odds = np.full(len(y), base)
    feature, cut, left, value, roots = [], [], [], [], []

    def leaf() -> int:
        for a, v in ((feature, -1), (cut, 0.0), (left, -1), (value, 0.0)):
            a.append(v)
        return len(feature) - 1

    def grow(node: int, rows: np.ndarray, g: np.ndarray, h: np.ndarray, level: int) -> None:
        total_g, total_h = g[rows].sum(), h[rows].sum()
        value[node] = -rate * total_g / (total_h + 1)
        odds[rows] += value[node]
        if level == depth or len(rows) < 20:
            return
        best = (1e-3, -1, -1)
        for j in range(n_plain):
            if not len(cuts[j]):
                continue
            gs = np.cumsum(np.bincount(binned[rows, j], g[rows], len(cuts[j]) + 1))[:-1]
            hs = np.cumsum(np.bincount(binned[rows, j], h[rows], len(cuts[j]) + 1))[:-1]
            gain = gs ** 2 / (hs + 1) + (total_g - gs) ** 2 / (total_h - hs + 1) - total_g ** 2 / (total_h + 1)
            gain[(hs < 1) | (total_h - hs < 1)] = 0
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (gain[k], j, k)
        inside = np.zeros(len(y), bool)
        inside[rows] = True
        of, word = has[inside[has]], which[inside[has]]
        gs, hs = (total - np.bincount(word, v[of], 2 * NAMES) for total, v in ((total_g, g), (total_h, h)))     # of rows without each word
        gain = gs ** 2 / (hs + 1) + (total_g - gs) ** 2 / (total_h - hs + 1) - total_g ** 2 / (total_h + 1)
        gain[(hs < 1) | (total_h - hs < 1)] = 0
        if gain.max() > best[0]:
            best = (gain.max(), n_plain + int(gain.argmax()), 0)
        _, j, k = best
        if j < 0:
            return
        odds[rows] -= value[node]
        one, two = leaf(), leaf()
        feature[node], cut[node], left[node] = j, float(cuts[j][k]) if j < n_plain else 0.5, one
        right = binned[rows, j] > k if j < n_plain else x[rows, j] > 0.5
        grow(one, rows[~right], g, h, level + 1)
        grow(two, rows[right], g, h, level + 1)

    for _ in range(trees):
        p = 1 / (1 + np.exp(-odds))
        roots.append(leaf())
        grow(roots[-1], np.arange(len(y)), p - y, np.maximum(p * (1 - p), 1e-6), 0)
    return Trees(np.array(feature), np.array(cut), np.array(left), np.array(value), roots, base)


def decode(page: Page, odds: np.ndarray) -> np.ndarray:
    """Which nodes to keep: the best choice in which every kept node's ancestors are kept."""
    n = len(page.nodes)
    odds = np.clip(odds, -6, 6)
    kept = odds.copy()          # best sum of the subtree if the node is kept; a dropped subtree counts 0
    for i in range(n - 1, 0, -1):
        kept[page.nodes[i].parent] += max(kept[i], 0)
    keep = np.zeros(n, bool)
    keep[0] = True
    for i in range(1, n):
        keep[i] = keep[page.nodes[i].parent] and kept[i] > 0
    return keep


def main_text(page: Page, odds: np.ndarray) -> str:
    keep = decode(page, odds)
    return "\n\n".join(text for node, text in page.runs if keep[node])


# -- layouts with known truth ----------------------------------------------------

_NAMES = {
    "nav": "menu nav navbar main-menu navigation breadcrumb site-nav pagination", "header": "header site-header masthead topbar page-header",
    "footer": "footer site-footer copyright legal page-footer", "aside": "sidebar side widget related related-posts recommended trending rail",
    "notice": "notice cookie-notice alert cookie-banner announcement consent warning", "ad": "ad ads advert advertisement sponsored promo ad-banner banner",
    "form": "newsletter signup search login subscribe contact-form", "comments": "comments comment-list discussion replies disqus responses",
    "share": "share social sharing tags", "main": "content post entry article article-body story main main-content post-content text"}


# invisible characters at the end of each text of a layout: of the article, and of the rest
MINE, OTHER = "\u2063", "\u2064"


def layout(texts: list[str], other: list[str], g: np.random.Generator, names: list[str] = (), free: float = FREE_NAMES) -> str:
    """A page around paragraphs; ``names`` are given to parts of any kind, with the chance ``free``."""
    def pick(options):
        return options[int(g.integers(len(options)))]

    def words(k: int) -> str:
        w = pick(other).split()
        s = int(g.integers(max(1, len(w) - k)))
        return " ".join(w[s:s + k]) + OTHER

    def box(kind: str, tag: str, inside: str, bare: float = 0.0) -> str:
        chosen = pick(names) if len(names) and g.random() < free else pick(_NAMES[kind].split())
        name = f' class="{chosen}"' if g.random() < .7 else f' id="{chosen}"'
        if g.random() < .45 and tag != "div":
            return f"<{tag}{name if g.random() < .4 else ''}>{inside}</{tag}>"
        other_tag = pick(("div", "div", "section"))
        return f"<{other_tag}{'' if g.random() < bare else name}>{inside}</{other_tag}>"

    def menu(k: int) -> str:
        return "<ul>" + "".join(f'<li><a href="/x">{words(int(g.integers(1, 4)))}</a></li>' for _ in range(k)) + "</ul>"

    def prose(k: int, lo: int = 5, hi: int = 40) -> str:
        return "".join(f"<p>{words(int(g.integers(lo, hi)))}</p>" for _ in range(k))

    def mine(text: str) -> str:
        return text.rstrip(OTHER) + MINE

    def paragraph(t: str) -> str:
        u = g.random()
        if u < .08:
            return "<ul>" + "".join(f"<li>{mine(words(int(g.integers(2, 15))))}</li>" for _ in range(3)) + "</ul>"
        if u < .12:
            return f"<blockquote>{mine(t)}</blockquote>"
        if u < .15:
            return f"<table><tr><td>{mine(words(3))}</td><td>{mine(words(2))}</td></tr></table>"
        if u < .2:
            return f"<h2>{mine(words(5))}</h2><p>{mine(t)}</p>"
        if u < .26:
            first, _, rest = mine(t).partition(" ")
            return f'<p><a href="/y">{first}</a> {rest}</p>'
        if u < .32:
            return f"<div>{mine(t)}</div>"
        if u < .48:
            return f"<p>{mine(words(1))}</p>"
        return f"<p>{mine(t)}</p>"

    if g.random() < .25:        # a short article
        texts = [words(int(g.integers(1, 4))) for _ in texts[:6]]
    body = [paragraph(t) for t in texts]
    for kind, chance in (("ad", .25), ("share", .2), ("aside", .1), ("form", .08)):
        if g.random() < chance:
            piece = prose(1) if kind != "share" else pick((menu(3), f'<a href="/s">{words(1)}</a>', words(2)))
            body.insert(int(g.integers(len(body) + 1)), box(kind, "aside" if kind == "aside" else "div", piece))
    title = f"<h1>{mine(words(int(g.integers(1, 9))))}</h1>"
    if g.random() < .2:
        title = f"<header>{title}</header>"
    article = title + "".join(body)
    if g.random() < .3:
        article = f"<div>{article}</div>"
    article = box("main", pick(("article", "main", "article", "section", "div")), article, .3)
    parts: list[str] = []
    if g.random() < .5:
        parts.append(box("header", "header", (menu(3) if g.random() < .5 else "") + f"<p>{words(4)}</p>"))
    if g.random() < .8:
        parts.append(box("nav", "nav", menu(int(g.integers(3, 10))), .2))
    for kind, tag, chance in (("notice", "div", .35), ("ad", "div", .5), ("aside", "aside", .25)):
        if g.random() < chance:
            u = g.random()
            inside = words(int(g.integers(3, 25))) if u < .5 else prose(int(g.integers(1, 3))) if u < .8 else menu(4)
            parts.append(box(kind, tag, inside))
    parts.append(article)
    for kind, tag, chance in (("aside", "aside", .4), ("comments", "section", .4), ("form", "form", .3), ("ad", "div", .2), ("footer", "footer", .85)):
        if g.random() < chance:
            if kind == "comments":
                one = [f'<div class="{pick(("comment", "reply", "comment-body"))}"><b>{words(1)}</b>{prose(1, 3, 60)}</div>' for _ in range(int(g.integers(1, 6)))]
                inside = f"<h3>{words(1)}</h3>" + "".join(one)
            elif kind == "form":
                inside = f"<p>{words(6)}</p><label>{words(2)}</label><input>"
            else:
                u = g.random()
                inside = words(int(g.integers(2, 14))) if u < .4 else menu(5) if u < .6 else prose(int(g.integers(1, 4)))
            parts.append(box(kind, tag, inside))
    return "<body>" + "".join(parts) + "</body>"


def paragraphs_of(source: str) -> list[str]:
    page = parse(source)
    return [html.escape(t) for node, t in page.runs if page.nodes[node].tag == "p"]


def bounded(paragraphs: list[str], most: int = PARAGRAPHS, chars: int = PAGE_CHARS) -> list[str]:
    """The first paragraphs; the last one is cut where there are too many characters."""
    out = []
    for t in paragraphs[:most]:
        if chars <= 0:
            break
        out.append(t[:chars])
        chars -= len(t)
    return out


def pick_most(g: np.random.Generator) -> int:
    """Articles have from one to many paragraphs."""
    return int((4, 12, 60)[int(g.integers(3))])


def fit(pages: list[list[str]], layouts: int = LAYOUTS, seed: int = 7, names: list[str] = ()) -> Trees:
    """Trees from at least ``layouts`` layouts of these pages' paragraphs, as many of each; ``names`` as for :func:`layout`."""
    g = np.random.default_rng(seed)
    texts = [p for p in pages if p] or [["no text at all here"]]
    other = [t for p in texts for t in p if t.count(" ") > 4] or ["no text at all here"]
    xs, ys = [], []
    for paragraphs in texts:
        for _ in range(-(-layouts // len(texts))):
            k = int(g.integers(1, pick_most(g) + 1))
            page = parse(layout(paragraphs[:k], other, g, names))
            positive = np.zeros(len(page.nodes))
            for node, text in page.runs:
                if MINE in text:
                    positive[node] = 1
            for i in range(len(page.nodes) - 1, 0, -1):
                positive[page.nodes[i].parent] = max(positive[page.nodes[i].parent], positive[i])
            xs.append(features(page))
            ys.append(positive)
    return boost(np.concatenate(xs), np.concatenate(ys))


def names_of(source: str, most: int = PAGE_NAMES) -> list[str]:
    """Words of a page's naming attributes, the first ones in the order of their hashes."""
    words = {w for tag in _TOKEN.finditer(source) for w in attribute_words(tag[4] or tag[7] or "")[0]}
    return sorted((w for w in words if len(w) <= 40), key=lambda w: zlib.crc32(w.encode()))[:most]


def drawn(pages: DataFrame, sample: int = SAMPLE) -> tuple[list[list[str]], list[str]]:
    """Paragraphs of the pages with the smallest hash of their id, and the words that name their parts; at most ``sample`` pages'
    come to the driver.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strings = pa.list_(pa.string())
        for b in batches:
            sources = [s.as_py() for s in b.column("html")]
            yield pa.RecordBatch.from_arrays([
                b.column("key"), b.column("tie"), pa.array([bounded(paragraphs_of(s)) for s in sources], strings),
                pa.array([names_of(s) for s in sources], strings)], ["key", "tie", "paragraphs", "names"])

    key = F.xxhash64("page_id")
    usable = pages.filter(F.length("html") > 0).select(key.alias("key"), F.xxhash64("html").alias("tie"), "html")
    # the numbers come first, so that tasks send the driver no more pages than it takes
    keys = [r[0] for r in usable.select("key").orderBy("key").limit(sample).collect()]
    rows = usable.filter(F.col("key") <= F.lit(max(keys, default=0))) \
        .mapInArrow(run, "key long, tie long, paragraphs array<string>, names array<string>").orderBy("key", "tie").limit(sample).collect()
    return [r.paragraphs for r in rows], sorted({w for r in rows for w in r.names})


def train(pages: DataFrame, sample: int = SAMPLE) -> Trees:
    paragraphs, names = drawn(pages, sample)
    return fit(paragraphs, names=names)


def extract(pages: DataFrame, trees: Trees) -> DataFrame:
    """``page_id``, ``url``, ``text``, ``n_chars`` of every page."""
    shared = pages.sparkSession.sparkContext.broadcast(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 64):
                part = b.slice(lo, 64)
                parsed = [parse(s.as_py()) for s in part.column("html")]
                rows = [features(p) for p in parsed]
                odds = np.split(shared.value.log_odds(np.concatenate(rows)), np.cumsum([len(r) for r in rows])[:-1])
                texts = [main_text(p, o) for p, o in zip(parsed, odds)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
