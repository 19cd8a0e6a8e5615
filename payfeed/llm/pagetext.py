"""Main text of web pages by a tree-structured graphical model.

A page becomes a tree: its block elements, and as leaves the runs of inline content between
them. Each node is content or not. A node has a potential from its own features (tag, words
in class and id, and for leaves length, links and marks), a child has one with its parent. Sum-product
messages from the leaves up and from the root down give each node's exact marginal, and the
leaves above one half are the text. Where there is none, the page is taken to have some text: the likeliest leaf that
nothing around it names as beside the text is given, and the marginals are computed anew. Weights and potentials are learned from labelled
pages: HTML in which ``data-content="1"`` or ``"0"`` labels an element and what is in it.
``labelled_pages`` makes such pages from a seed; ``train`` takes any.

Nulls, broken and empty pages: null or empty html gives an empty text; unclosed and stray
tags are repaired as browsers do in the common cases; a page without tags is one leaf.
Rows are returned once each, whatever repeats; other columns are kept if asked for.
"""

from __future__ import annotations

import html
import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payfeed.llm.rows import with_fields

# A quote counts as one after an equals sign only, and only if it is closed, as far as browsers agree. No part gives back
# what it has taken, and a tag fails at the end of the page alone, so a page is read once.
_TAG = r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]++)?+)?+)*+)"""
_MARKUP = re.compile(rf"<!--(?:.*?-->|.*\Z)|<[!?][^>]*+>?+|{_TAG}(>?+)", re.DOTALL)
_ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
# Element kinds of HTML.
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_RAW = set("script style textarea title noscript iframe xmp noembed noframes template svg annotation annotation-xml select head object audio video canvas button".split())
_INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
_MATH = set("math maction menclose merror mfenced mfrac mi mlabeledtr mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover none semantics".split())
_INLINE |= _MATH
_CLOSES_P = set("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
_CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_SCOPE = set("ul ol dl table body html article section div".split())
# HTML tags that end an open svg or formula.
_BREAKS = _CLOSES_P | set("b big body br center code dd dt em embed html i img li listing meta nobr ruby s small span strong strike sub sup td th tr tt u var".split())
_FOREIGN = re.compile(rf"<!--(?:.*?-->|.*\Z)|{_TAG}>", re.DOTALL)
# Elements that HTML itself sets beside the text.
_BESIDE_TAGS = set("nav header footer aside form dialog address menu".split())
# Names of an element that together weigh less than this say that it stands beside the text.
_BESIDE_WORDS = -0.03
# Elements nested deeper than this become siblings, as in browsers.
_DEEPEST = 500
# After so many drawings of a page that no tag closes, the next ones end at their first block.
_UNCLOSED = 16
_LENGTHS = (1, 3, 6, 12, 25, 50, 100)
_TOTALS = (0, 5, 20, 60, 150, 400, 1000)


@dataclass
class Tree:
    """Nodes of a page in page order; a parent stands before its children."""

    parent: list[int] = field(default_factory=list)
    kind: list[str] = field(default_factory=list)
    features: list[list[str]] = field(default_factory=list)
    text: list[str | None] = field(default_factory=list)
    label: list[int] = field(default_factory=list)

    def add(self, parent: int, kind: str, features: list[str], text: str | None, label: int) -> int:
        for values, value in ((self.parent, parent), (self.kind, kind), (self.features, features), (self.text, text), (self.label, label)):
            values.append(value)
        return len(self.parent) - 1


def _after_foreign(page: str, at: int, name: str, look: bool = True) -> tuple[int, bool]:
    """Where the page goes on after an svg or annotation whose content begins at ``at``, and whether it was closed.

    After its end tag, or before an HTML tag that ends it as in browsers, or before the end of its formula.
    HTML within a foreignObject, title, desc or annotation-xml belongs to it, if that is closed; without ``look`` it ends there.
    """
    depth, inner, broken = 1, int(name == "annotation-xml"), -1
    for found in _FOREIGN.finditer(page, at):
        tag, ends = (found[2] or "").lower(), bool(found[1])
        if tag == name:
            depth += -1 if ends else not found[0].endswith("/>")
            if not depth:
                return found.end(), True
        elif tag in ("foreignobject", "title", "desc") and not found[0].endswith("/>"):
            inner = max(0, inner + (-1 if ends else 1))
            broken = broken if inner else -1
        elif tag == "math" and ends and name != "svg":
            return found.start(), True
        elif tag in _BREAKS:
            broken = found.start() if broken < 0 else broken
            if not inner or not look:
                return broken, False
    return broken if broken >= 0 else len(page), False


def parse(page: str | None) -> Tree:
    """Tree of a page. Labels are 1, 0, or -1 where no element says."""
    page = page or ""
    tree = Tree()
    tree.add(-1, "html", ["tag:html"], None, -1)
    stack: list[tuple[str, int]] = [("html", 0)]  # open elements and the block node they are in
    pieces: list[str] = []
    linked = [0, 0]  # open links, characters in links
    sizes: dict[int, tuple[int, int, int]] = {}  # words, characters, and those in links, of leaves
    opened: Counter[str] = Counter()
    depth_of = [0]
    endless: set[str] = set()  # raw elements without an end from here on
    unclosed = 0
    at = 0

    def leaf() -> None:
        text = " ".join(html.unescape("".join(pieces)).split())
        if text:
            block = stack[-1][1]
            tree.add(block, "#text", _leaf_features(text, linked[1], tree.kind[block]), text, tree.label[block])
            sizes[len(tree.parent) - 1] = (text.count(" ") + 1, len(text), min(linked[1], len(text)))
        pieces.clear()
        linked[1] = 0

    def close(depth: int) -> None:
        """Close open elements down to ``depth``."""
        if any(name not in _INLINE for name, _ in stack[depth:]):
            leaf()
        linked[0] = max(0, linked[0] - sum(name == "a" for name, _ in stack[depth:]))
        opened.subtract(name for name, _ in stack[depth:])
        del stack[depth:]

    while True:
        found = _MARKUP.search(page, at)
        text = page[at : found.start() if found else len(page)]
        if text:
            pieces.append(text)
            if linked[0]:
                linked[1] += len(text)
        if not found:
            break
        at = found.end()
        name = (found[2] or "").lower()
        if not name:
            continue
        if not found[4]:  # a tag without an end: what is left is text
            pieces.append(page[found.start() :])
            break
        if found[1]:
            if name in _VOID or not opened[name]:
                continue
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == name:
                    close(depth)
                    break
                if name in _INLINE and stack[depth][0] not in _INLINE:
                    break
            continue
        if name in _RAW:
            if name in ("svg", "annotation", "annotation-xml"):
                if not found[0].endswith("/>"):
                    at, closed = _after_foreign(page, at, name, unclosed < _UNCLOSED)
                    unclosed += not closed
                pieces.append(" ")
                continue
            end = None if name in endless else re.compile(rf"</{re.escape(name)}\s*>", re.IGNORECASE).search(page, at)
            if end is None:
                endless.add(name)
            if not found[0].endswith("/>"):
                if end:
                    at = end.end()
                elif name == "head":
                    body = None if "body" in endless else re.compile("<body", re.IGNORECASE).search(page, at)
                    at = body.start() if body else at
                    if body is None:
                        endless.add("body")
                elif name not in ("button", "object", "audio", "video", "canvas", "select"):
                    at = len(page)
            pieces.append(" ")
            continue
        if name in _INLINE:
            if name == "br":
                pieces.append(" ")
            elif name not in _VOID and not (name in _MATH and found[0].endswith("/>")):
                stack.append((name, stack[-1][1]))
                opened[name] += 1
                linked[0] += name == "a"
            continue
        if name in ("html", "body") and (opened[name] or name == "html"):
            continue
        if name in _CLOSES_P and opened["p"]:
            _close_open(stack, {"p"}, close)
        if name in _CLOSED_BY and any(opened[n] for n in _CLOSED_BY[name]):
            _close_open(stack, _CLOSED_BY[name], close)
        leaf()
        if name in _VOID:
            continue
        above = stack[-1][1]
        attributes = {k.lower(): v.strip("\"'") for k, v in _ATTRIBUTE.findall(found[3])} if found[3].strip() else {}
        label = int(attributes["data-content"]) if attributes.get("data-content") in ("0", "1") else tree.label[above]
        while depth_of[above] >= _DEEPEST:
            above = tree.parent[above]
        node = tree.add(above, name, _element_features(name, attributes), None, label)
        depth_of.extend([0] * (node + 1 - len(depth_of)))
        depth_of[node] = depth_of[above] + 1
        stack.append((name, node))
        opened[name] += 1
    leaf()
    _add_totals(tree, sizes)
    return tree


def _add_totals(tree: Tree, sizes: dict[int, tuple[int, int, int]]) -> None:
    """Elements get the amount and the linked share of all text below them as features."""
    words, chars, linked = ([0] * len(tree.parent) for _ in range(3))
    for i, (a, b, c) in sizes.items():
        words[i], chars[i], linked[i] = a, b, c
    for i in range(len(tree.parent) - 1, 0, -1):
        above = tree.parent[i]
        words[above] += words[i]
        chars[above] += chars[i]
        linked[above] += linked[i]
        if tree.text[i] is None:
            share = linked[i] / max(1, chars[i])
            tree.features[i] += [f"total:{sum(words[i] > n for n in _TOTALS)}", f"linked:{0 if share == 0 else 1 if share < 0.3 else 2}"]


def _close_open(stack: list[tuple[str, int]], names: set[str], close) -> None:
    for depth in range(len(stack) - 1, 0, -1):
        if stack[depth][0] in names:
            close(depth)
            return
        if stack[depth][0] in _SCOPE:
            return


def _element_features(name: str, attributes: dict[str, str]) -> list[str]:
    out = [f"tag:{name}"]
    for key in ("class", "id", "role"):
        out += [f"word:{w.lower()}" for w in _WORD.findall(html.unescape(attributes.get(key, "")))]
    if "hidden" in attributes or "display:none" in attributes.get("style", "").replace(" ", ""):
        out.append("hidden")
    return list(dict.fromkeys(out))


def _leaf_features(text: str, in_links: int, above: str) -> list[str]:
    words = text.count(" ") + 1
    share = min(1.0, in_links / max(1, len(text)))
    return [
        f"in:{above}",
        f"words:{sum(words > n for n in _LENGTHS)}",
        f"links:{0 if share == 0 else 1 if share < 0.5 else 2}",
        f"mark:{int(text[-1] in '.!?…')}",
    ]


@dataclass
class PageModel:
    """Weights of features, and potentials of (parent label, child label) by kind of child; all as logs."""

    weights: dict[str, float]
    pairs: dict[str, np.ndarray]

    def pair(self, kind: str) -> np.ndarray:
        return self.pairs.get(kind, self.pairs["*"])


class Forest:
    """Several trees as one set of nodes, by depth."""

    def __init__(self, trees: list[Tree]):
        sizes = np.array([len(t.parent) for t in trees])
        base = np.cumsum(sizes) - sizes
        self.parent = np.concatenate([np.where(np.array(t.parent) >= 0, np.array(t.parent) + b, -1) for t, b in zip(trees, base)])
        depth = [0] * len(self.parent)
        for i, above in enumerate(self.parent.tolist()):
            if above >= 0:
                depth[i] = depth[above] + 1
        order = np.argsort(depth, kind="stable")
        self.levels = np.split(order, np.flatnonzero(np.diff(np.array(depth)[order])) + 1)

    def beliefs(self, unary: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sum-product: what subtrees say, their messages to parents, and log beliefs of nodes."""
        inside, message = unary.copy(), np.zeros_like(unary)
        for nodes in self.levels[:0:-1]:  # upward: what a subtree says about its parent's label
            message[nodes] = np.logaddexp(pair[nodes, :, 0] + inside[nodes, None, 0], pair[nodes, :, 1] + inside[nodes, None, 1])
            np.add.at(inside, self.parent[nodes], message[nodes])
        belief = inside.copy()
        for nodes in self.levels[1:]:  # downward: what the rest of the tree says
            rest = belief[self.parent[nodes]] - message[nodes]
            belief[nodes] += np.logaddexp(pair[nodes, 0] + rest[:, :1], pair[nodes, 1] + rest[:, 1:])
        return inside, message, belief


def _content(belief: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -500, 500)))


def train(pages: list[str], steps: int = 120, rate: float = 2.0, decay: float = 1e-3) -> PageModel:
    """Learn weights and potentials from labelled pages by gradient ascent on their likelihood.

    The gradient is what the labels have less what the model's marginals expect, both for features
    of nodes and for pairs. An unlabelled element at the top counts as one that holds content.
    """
    trees = [parse(p) for p in pages]
    forest = Forest(trees)
    label = np.array([1 if y < 0 else y for t in trees for y in t.label])
    names: dict[str, int] = {}
    kinds: dict[str, int] = {"*": 0}
    node_of, slot_of = [], []
    for i, features in enumerate(f for t in trees for f in t.features):
        for f in features:
            node_of.append(i)
            slot_of.append(names.setdefault(f, len(names)))
    kind = np.array([kinds.setdefault(k, len(kinds)) for t in trees for k in t.kind])
    node, slot, n = np.array(node_of), np.array(slot_of), len(label)
    child = np.flatnonzero(forest.parent >= 0)
    above = forest.parent[child]
    seen = np.zeros((len(kinds), 2, 2))
    np.add.at(seen, (kind[child], label[above], label[child]), 1)
    weights, pairs = np.zeros(len(names)), np.zeros((len(kinds), 2, 2))
    speed_w, speed_p = np.zeros_like(weights), np.zeros_like(pairs)
    for _ in range(steps):
        unary = np.zeros((n, 2))
        unary[:, 1] = np.bincount(node, weights[slot], n)
        table = pairs[kind] + pairs[0]
        inside, message, belief = forest.beliefs(unary, table)
        slope_w = np.bincount(slot, (label - _content(belief))[node], len(names)) / n - decay * weights
        joint = (belief[above] - message[child])[:, :, None] + table[child] + inside[child][:, None, :]
        joint = np.exp(joint - joint.max((1, 2), keepdims=True))
        expected = np.zeros_like(pairs)
        np.add.at(expected, kind[child], joint / joint.sum((1, 2), keepdims=True))
        slope_p = (seen - expected) / n
        slope_p[0] = slope_p.sum(0)
        slope_p -= decay * pairs
        speed_w, speed_p = 0.9 * speed_w + slope_w, 0.9 * speed_p + slope_p
        weights, pairs = weights + rate * speed_w, pairs + rate * speed_p
    return PageModel(dict(zip(names, weights.tolist())), {k: pairs[i] + pairs[0] * (i > 0) for k, i in kinds.items()})


def _candidates(tree: Tree, model: PageModel) -> list[int]:
    """Leaves that no element around them names as something beside the text, by its tag or by its words."""
    out, named = [], [False] * len(tree.parent)
    for i, above in enumerate(tree.parent):
        if above >= 0:
            words = sum(model.weights.get(f, 0.0) for f in tree.features[i] if f.startswith("word:"))
            named[i] = named[above] or tree.kind[i] in _BESIDE_TAGS or words < _BESIDE_WORDS or "hidden" in tree.features[i]
            if tree.text[i] and not named[i] and "links:2" not in tree.features[i]:
                out.append(i)
    return out


def _given_some_content(tree: Tree, model: PageModel, found: np.ndarray) -> np.ndarray:
    """Content of a page of which no leaf is likelier content than not: given that its likeliest candidate is.

    Text that is short and says nothing of itself looks like what stands beside a text; if nothing else on
    the page can be the text, it is.
    """
    candidates = _candidates(tree, model)
    if not candidates:
        return np.zeros(len(found), bool)
    best = max(candidates, key=lambda i: found[i])
    given = marginals([tree], model, {best})
    keep = np.zeros(len(found), bool)
    keep[candidates] = given[candidates] > 0.5
    return keep


def marginals(trees: list[Tree], model: PageModel, given: set[int] = frozenset()) -> np.ndarray:
    """Probability of content for the nodes of several trees; the nodes ``given`` are content."""
    forest = Forest(trees)
    unary = np.zeros((len(forest.parent), 2))
    weights = model.weights
    unary[:, 1] = [sum(weights.get(f, 0.0) for f in fs) for t in trees for fs in t.features]
    unary[list(given), 1] += 500
    kinds: dict[str, int] = {}
    kind = np.array([kinds.setdefault(k, len(kinds)) for t in trees for k in t.kind])
    pair = np.array([model.pair(k) for k in kinds])[kind]
    return _content(forest.beliefs(unary, pair)[2])


def main_texts(pages: list[str | None], model: PageModel) -> list[str]:
    """Main text of each page: content leaves in page order, one line each."""
    trees = [parse(p) for p in pages]
    if not trees:
        return []
    found = marginals(trees, model)
    out, at = [], 0
    for tree in trees:
        mine = found[at : at + len(tree.text)]
        keep = mine > 0.5
        if not any(k and t for k, t in zip(keep, tree.text)):
            keep = _given_some_content(tree, model, mine)
        out.append("\n".join(t for t, k in zip(tree.text, keep) if k and t))
        at += len(tree.text)
    return out


def extract(pages: DataFrame, columns: list[str], model: PageModel) -> DataFrame:
    """``columns`` of ``pages`` with text (of ``html``) and n_chars."""
    known = pages.sparkSession.sparkContext.broadcast(model)
    rows = pages.select(*columns, F.col("html").cast("string").alias("_html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                some = batch.slice(at, 128)
                texts = main_texts(some.column("_html").to_pylist(), known.value)
                yield pa.RecordBatch.from_arrays([*(some.column(c) for c in columns), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], names=[*columns, "text", "n_chars"])

    return rows.mapInArrow(run, with_fields(rows.select(*columns).schema, "text string, n_chars long"))


# Names that labelled pages give to what is not content, and to what is.
_BESIDES = {
    "nav": ["nav", "menu", "navbar", "main-menu", "site-nav", "breadcrumb", "breadcrumbs", "toc", "pagination", "pager", "skip-links"],
    "header": ["header", "site-header", "page-header", "masthead", "top-bar", "branding", "logo", "banner"],
    "footer": ["footer", "site-footer", "page-footer", "bottom", "copyright", "colophon", "legal"],
    "aside": ["sidebar", "side-bar", "aside", "widget", "related", "related-posts", "recommended", "trending", "popular", "tags", "author-box", "rail"],
    "ad": ["ad", "ads", "advert", "advertisement", "ad-slot", "sponsor", "sponsored", "promo", "promotion", "banner-ad"],
    "notice": ["cookie", "cookie-notice", "cookie-banner", "consent", "gdpr", "notice", "alert", "popup", "modal", "overlay", "newsletter", "subscribe", "paywall", "message"],
    "comments": ["comments", "comment", "comment-list", "replies", "reply", "discussion", "disqus", "responses", "user-comments", "reader-comments"],
    "share": ["share", "social", "social-links", "follow", "tools", "meta-links"],
    "form": ["form", "search", "search-form", "login", "signup", "contact-form", "subscribe-form"],
}
_MAIN = ["content", "article", "post", "entry", "entry-content", "post-content", "article-body", "main", "main-content", "story", "story-body", "text", "body-text", "page-content", "article-content", "blog-post"]


def labelled_pages(count: int = 600, seed: int = 7) -> list[str]:
    """Pages of many layouts with their labels."""
    rng = random.Random(seed)

    def words(low: int, high: int) -> str:
        return " ".join("".join(rng.choice("aeinorstlu") for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(low, high)))

    def sentence(low: int = 4, high: int = 60) -> str:
        return words(low, high).capitalize() + rng.choice([".", ".", ".", "!", "?", "", ":"])

    def links(n: int, tag: str = "li") -> str:
        parts = "".join(f'<{tag}><a href="/x">{words(1, 4)}</a></{tag}>' for _ in range(n))
        return f"<ul>{parts}</ul>" if tag == "li" else parts

    def named(names: list[str]) -> str:
        name = rng.choice(names)
        return rng.choice([f' class="{name}"', f' id="{name}"', f' class="{name} {rng.choice(["box", "block", "wrap", "inner", "col", "clearfix"])}"'])

    def besides(kind: str) -> str:
        tag = {"nav": ["nav", "div", "ul"], "header": ["header", "div"], "footer": ["footer", "div"], "aside": ["aside", "div", "section"], "comments": ["section", "div", "ol"], "form": ["form", "div"]}.get(kind, ["div", "section", "aside", "p"])
        pick = rng.choice(tag)
        bare = pick in ("nav", "header", "footer", "aside", "form") and rng.random() < 0.5
        inner = {
            "nav": lambda: links(rng.randint(3, 9)) if pick != "ul" else "".join(f'<li><a href="/y">{words(1, 3)}</a></li>' for _ in range(5)),
            "header": lambda: rng.choice([f"<h1>{words(1, 4)}</h1>", f"<h2>{words(1, 4)}</h2>", f'<div class="logo"><a href="/">{words(1, 2)}</a></div>', ""]) + rng.choice(["", f"<p>{words(2, 8)}</p>", links(4)]) or words(1, 3),
            "footer": lambda: rng.choice([f"&copy; {words(1, 3)} &middot; {sentence(3, 20)}", f"<p>&copy; 2020 {words(2, 6)}</p>{links(3)}", f"<p>{sentence(4, 25)}</p>"]),
            "aside": lambda: f"<h3>{words(1, 4)}</h3>" + rng.choice([links(5), f"<p>{sentence(5, 40)}</p>", f"<ul><li>{sentence(3, 12)}</li><li>{sentence(3, 12)}</li></ul>"]),
            "comments": lambda: rng.choice([f"<h3>{words(1, 3)}</h3>", ""]) + "".join(rng.choice([f'<div class="comment"><p>{sentence(3, 60)}</p></div>', f"<li><b>{words(1, 2)}</b> {sentence(3, 50)}</li>", f"<p>{sentence(3, 60)}</p>", f"<article><p>{sentence(3, 60)}</p></article>"]) for _ in range(rng.randint(1, 6))),
            "form": lambda: f"<label>{words(1, 3)}</label><input><p>{sentence(2, 15)}</p>" + rng.choice(["", f"<div>{words(1, 5)}</div>"]),
        }.get(kind, lambda: rng.choice([sentence(3, 40), f"<p>{sentence(3, 40)}</p>", f"<p>{sentence(3, 25)}</p><a href='/'>{words(1, 3)}</a>", f"<div><p>{sentence(3, 30)}</p></div>"]))()
        return f'<{pick}{"" if bare else named(_BESIDES[kind])} data-content="0">{inner}</{pick}>'

    def block() -> str:
        kind = rng.random()
        if kind < 0.68:
            return f"<p>{sentence(1, rng.choice([30, 120, 120, 120, 500]))}</p>"
        if kind < 0.74:
            return f"<p>{sentence(3, 60)} <a href='/z'>{words(1, 4)}</a> {sentence(3, 40)}</p>"
        if kind < 0.8:
            return f"<h{(n := rng.randint(2, 4))}>{words(1, 8)}</h{n}>"
        if kind < 0.86:
            return f"<ul>{''.join(f'<li>{sentence(1, 25)}</li>' for _ in range(rng.randint(2, 6)))}</ul>"
        if kind < 0.9:
            return f"<blockquote><p>{sentence(5, 50)}</p></blockquote>"
        if kind < 0.93:
            return f"<table><tr><td>{words(1, 5)}</td><td>{words(1, 5)}</td></tr></table>"
        if kind < 0.95:
            return f"<pre>{words(3, 30)}</pre>"
        if kind < 0.97:
            return f"<figure><img src='i'><figcaption>{sentence(2, 15)}</figcaption></figure>"
        return f"<div>{sentence(3, 60)}</div>"

    def content() -> str:
        title = "" if rng.random() < 0.35 else rng.choice([f"<h1>{words(2, 12)}</h1>", f"<header><h1>{words(2, 12)}</h1></header>", f"<h1>{words(2, 12)}</h1><p><b>{sentence(3, 20)}<br>", f"<h2>{words(2, 10)}</h2>"])
        if rng.random() < 0.2:  # many short lines
            blocks = [f"<p>{sentence(1, 4)}</p>" for _ in range(rng.choice([4, 12, 30, 60]))]
        else:
            blocks = [block() for _ in range(rng.choice([1, 1, 2, 2, 4, 8, 16, 40]))]
        if rng.random() < 0.15:  # opened by the reader, or with a control in its midst
            blocks.insert(rng.randint(0, len(blocks)), rng.choice([f"<details><summary>{words(1, 8)}</summary><p>{sentence(5, 60)}</p></details>", f"<p>{words(1, 6)} <button>{words(1, 2)}</button> {sentence(1, 8)}</p>"]))
        if rng.random() < 0.4:
            blocks.insert(rng.randint(0, len(blocks)), besides(rng.choice(["ad", "share", "aside", "notice", "form"])))
        if rng.random() < 0.25:
            blocks.append(besides("comments"))
        tag = rng.choice(["article", "article", "main", "div", "div", "section"])
        bare = rng.random() < (0.6 if tag in ("article", "main") else 0.4)
        return f'<{tag}{"" if bare else named(_MAIN)} data-content="1">{title}{"".join(blocks)}</{tag}>'

    out = []
    for _ in range(count):
        before = [besides(k) for k in ("notice", "header", "nav", "ad") if rng.random() < 0.6]
        after = [besides(k) for k in ("share", "aside", "comments", "ad", "form", "footer", "notice") if rng.random() < 0.5]
        middle = content()
        if rng.random() < 0.3:
            middle = f'<div class="{rng.choice(["wrapper", "container", "page", "layout", "row", "site"])}">{middle}{after.pop() if after else ""}</div>'
        out.append(f'<html><head><title>{words(2, 8)}</title></head><body data-content="1">{"".join(before)}{middle}{"".join(after)}</body></html>')
    return out


_MODEL: PageModel | None = None


def default_model() -> PageModel:
    """The model of ``labelled_pages``; learned once a process."""
    global _MODEL
    if _MODEL is None:
        _MODEL = train(labelled_pages())
    return _MODEL
