"""Main text of web pages by a tree-structured graphical model.

A page is parsed into a tree of block elements with the text runs between block
boundaries as leaves. Every node has a hidden label, content or not. Node potentials
are log-linear in tag, class, id and role words, position and text statistics;
edge potentials join a node's label to its parent's. Sum-product messages go up and
down the tree once and give each run its exact marginal; runs at 0.5 and more
are the main text, in page order.

The potentials are trained by gradient ascent on the likelihood of labelled
pages: pages laid out here from common page parts with known labels, in
many arrangements, some without any telling tag or class, some in the cells of a
layout table. Lists of links and sections with a heading inside an article are
content, whatever the section's name; a cell beside a far larger one is told by what it holds.

Scripts, styles, templates, drawings (svg), frames, noscript, comments of the
markup and the head are never text. The head ends at its end tag, or at what it
can't hold; any other of these left open ends with its parent. Character
references are decoded; white space inside a block (and a line break element)
is one space; blocks are joined by an empty line. Null, empty and textless pages
give an empty text. Pages of any length are processed whole; trees of any depth
need no recursion.
"""

from __future__ import annotations

import math
import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TRAIN_PAGES = 1000
SEED = 5
PAGES_AT_ONCE = 256

# The parts of HTML that the tree needs.
SKIP = frozenset("script style noscript template svg iframe title".split())
#: What a head can hold besides SKIP.
IN_HEAD = frozenset("base basefont bgsound link meta noframes".split())
#: Start tags that end an svg, except below its places for other markup.
LEAVES_SVG = frozenset("""b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li
listing menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var""".split())
SVG_HOLDS = frozenset("foreignobject desc title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""html body article section main div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table caption thead tbody
tfoot tr td th blockquote pre nav header footer aside form fieldset legend figure figcaption address details summary
dialog menu button select option textarea label hr center""".split())
#: A start tag closes the open element of these (up to the given borders).
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
          "option": ({"option"}, {"select"})}
#: Words of class, id and role, by what they tell.
HINTS = {
    "main": "article content post entry story maincontent articlebody body text main page prose hentry richtext",
    "nav": "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toc tabs toolbar skip",
    "head": "header masthead banner topbar logo branding hero",
    "foot": "footer copyright legal colophon contentinfo bottom imprint",
    "side": "sidebar side rail aside complementary widget widgets related recommended popular trending more teaser",
    "ad": "ad ads advert adverts advertisement adsense sponsor sponsored promo promotion promoted dfp affiliate",
    "notice": "notice cookie cookies consent gdpr alert popup modal overlay dialog newsletter subscribe subscription signup paywall message warning",
    "comment": "comment comments commentlist disqus reply replies respond reader readers feedback reviews",
    "talk": "discussion",
    "share": "share sharing social follow tweet buttons",
    "form": "search searchbox form login signin contact poll survey",
    "meta": "meta byline author date timestamp tags tag category categories credits",
}
_HINT = {w: k for k, words in HINTS.items() for w in words.split()}
_SPLIT = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_LONG_REFERENCE = re.compile(r"&#(\d{1000,})")
_RIGHTS = re.compile(r"©|\bcopyright\b|\ball rights reserved\b", re.I)
#: A cell with this many characters and half of its table's makes it a layout table.
LAYOUT_CELL = 150
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


CELLS = frozenset(("e:td", "e:th"))


class Tree(HTMLParser):
    """Nodes of a page: parent, feature names and text of each; element nodes
    come before their children."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parent, self.features, self.text, self.label = [-1], [["root"]], [None], [0]
        self.size: dict[int, tuple[int, int]] = {}
        self.open: list[tuple[str, int]] = [("#root", 0)]
        self.skipping: str | None = None
        self.skipped: list[str] = []  # elements open inside the skipped one
        self.head = False
        self.run: list[str] = []
        self.links = 0
        self.linked = 0
        self.inside = {"article": 0, "main": 0}

    def add(self, features, text=None, label=0) -> int:
        self.parent.append(self.node())
        self.features.append(features)
        self.text.append(text)
        self.label.append(label)
        return len(self.parent) - 1

    def flush(self):
        words = "".join(self.run).split()
        if words:
            n, linked = len(words), self.linked
            text = " ".join(words)
            share = min(1.0, linked / max(1, len(text)))
            tag = self.open[self._block_at()][0]
            f = ["t:" + tag, "n%d" % min(7, int(math.log2(n))), "l%d" % min(4, int(share * 4.999)),
                 "end" if text[-1] in ".!?…\"”»" else "noend", "comma" if "," in text else "nocomma"]
            if share > 0.5 and n < 8:
                f.append("shortlink")
            if n < 40 and _RIGHTS.search(text):
                f.append("rights")
            # An inline element may stand on the stack: the run belongs to its block.
            at = self.open[self._block_at()][1]
            self.parent.append(at)
            self.size[len(self.text)] = (len(text), linked)
            self.features.append(f)
            self.text.append(text)
            self.label.append(self.label[at] if self.label[at] in (0, 1) else 0)
        self.run, self.linked = [], 0

    def _block_at(self) -> int:
        k = len(self.open) - 1
        while self.open[k][1] < 0:
            k -= 1
        return k

    def node(self) -> int:
        return self.open[self._block_at()][1]

    def parse_marked_section(self, i, report=1):
        try:
            return super().parse_marked_section(i, report)
        except AssertionError:  # malformed: a comment up to the next ">"
            return self.rawdata.find(">", i + 3) + 1 or -1

    def leaves(self, tag) -> bool:
        """Whether a start tag ends the skipped element that is open."""
        if self.skipping == "svg":
            return tag in LEAVES_SVG and not SVG_HOLDS.intersection(self.skipped)
        return (tag == "body" and self.skipping in ("title", "noscript") and "body" not in self.skipped
                and all(t != "body" for t, _ in self.open))

    def handle_starttag(self, tag, attrs):
        if self.skipping and not self.leaves(tag):
            if tag not in VOID:
                self.skipped.append(tag)
            return
        self.skipping, self.skipped = None, []
        if tag in SKIP:
            self.head = self.head and tag not in ("svg", "iframe")
            self.skipping = tag
            return
        if tag == "head":
            self.head = True
            return
        if self.head:
            if tag in IN_HEAD:
                return
            self.head = False
        if tag == "br":
            self.run.append(" ")
            return
        if tag not in BLOCK:
            if tag in VOID:
                return
            if tag == "a":
                self.links += 1
            self.open.append((tag, -1))
            return
        self.flush()
        if tag in ("html", "body") and any(t == tag for t, _ in self.open):
            return
        # A block start ends an open paragraph; list items and cells end their like.
        if tag not in ("button", "label", "select", "option"):
            self.close_to({"p"}, {"button", "td", "th", "li", "div", "section", "article", "form", "blockquote", "dialog"})
        if tag in CLOSES:
            self.close_to(*CLOSES[tag])
        at = {k: v or "" for k, v in attrs}
        hints = {_HINT[w] for w in (x.lower() for x in _SPLIT.findall(
            " ".join((at.get("class", ""), at.get("id", ""), at.get("role", ""))))) if w in _HINT}
        within = "+a" if self.inside["article"] or self.inside["main"] else ""
        f = ["e:" + tag, *("h:" + h for h in sorted(hints))]
        if within:
            f.append(f"e:{tag}{within}")
            f += [f"h:{h}{within}" for h in sorted(hints)]
        if "class" in at or "id" in at:
            f.append("named" if hints else "odd")
        if "hidden" in at or at.get("aria-hidden") == "true" or _HIDDEN.search(at.get("style", "")):
            f.append("hidden")
        label = at.get("data-y")
        i = self.add(f, None, int(label) if label in ("0", "1") else self.label[self.node()])
        if tag not in VOID:
            self.open.append((tag, i))
            if tag in self.inside:
                self.inside[tag] += 1

    def close_to(self, tags, borders):
        for k in range(len(self.open) - 1, 0, -1):
            t = self.open[k][0]
            if t in tags:
                self.pop(k)
                return
            if t in borders:
                return

    def pop(self, k):
        self.flush()
        for t, _ in self.open[k:]:
            if t in self.inside:
                self.inside[t] -= 1
            if t == "a":
                self.links -= 1
        del self.open[k:]

    def handle_endtag(self, tag):
        if self.skipping:
            if tag in self.skipped:
                while self.skipped.pop() != tag:
                    pass
                return
            own = tag == self.skipping
            if own or (tag == "head" and self.head) or any(t == tag for t, _ in self.open):
                self.skipping = None
                self.skipped = []
            if own or self.skipping:
                return
        if tag in ("head", "body", "html"):
            self.head = False
        if tag in BLOCK:
            for k in range(len(self.open) - 1, 0, -1):
                if self.open[k][0] == tag:
                    self.pop(k)
                    return
            self.flush()
            return
        for k in range(len(self.open) - 1, 0, -1):
            t, i = self.open[k]
            if i >= 0:
                return
            if t == tag:
                if tag == "a":
                    self.links -= 1
                del self.open[k]
                return

    def handle_startendtag(self, tag, attrs):
        if tag in SKIP or tag == "head" or (self.skipping and not self.leaves(tag)):
            return
        self.handle_starttag(tag, attrs)
        if tag not in VOID and not self.skipping:
            self.handle_endtag(tag)

    def handle_data(self, data):
        if self.skipping or (self.head and not data.strip()):
            return
        self.head = False
        self.run.append(data)
        if self.links:
            self.linked += len(data.strip())


def add_totals(tree: Tree) -> None:
    """Features of what is below each element: its share of the page's text,
    its amount, its share of links and its number of runs; and of the cells of
    layout tables, whether they are the largest."""
    n = len(tree.parent)
    chars, links, runs = [0] * n, [0] * n, [0] * n
    for i in range(n - 1, 0, -1):
        if tree.text[i] is not None:
            chars[i], links[i] = tree.size[i]
            runs[i] = 1
        p = tree.parent[i]
        chars[p] += chars[i]
        links[p] += links[i]
        runs[p] += runs[i]
    total = max(1, chars[0])
    for i in range(1, n):
        if tree.text[i] is None:
            c = chars[i]
            tree.features[i] += ["s%d" % (10 * c // total), "c%d" % min(6, c.bit_length() // 2),
                                 "d%d" % (min(4, 5 * links[i] // c) if c else 5), "r%d" % min(4, runs[i])]
    # The table of each element, and the largest cell of each table.
    table, largest = [0] * n, {}
    for i in range(1, n):
        up = tree.parent[i]
        table[i] = up if tree.features[up][0] == "e:table" else table[up]
        if tree.features[i][0] in CELLS and chars[i] > chars[largest.get(table[i], 0)] * (table[i] in largest):
            largest[table[i]] = i
    for i in range(1, n):
        if tree.features[i][0] in CELLS and table[i] in largest:
            top = largest[table[i]]
            if chars[top] >= max(LAYOUT_CELL, chars[table[i]] / 2):
                tree.features[i].append("cell" if i == top else "aside%d" % (min(4, 5 * links[i] // chars[i]) if chars[i] else 5))


def parse(html: str | None) -> Tree:
    tree = Tree()
    # The parser's int() refuses longer references; what is too large for a character stays so.
    tree.feed(_LONG_REFERENCE.sub(lambda m: "&#" + (m[1].lstrip("0")[:8] or "0"), html or ""))
    tree.close()
    if tree.skipping is None or tree.run:
        tree.flush()
    add_totals(tree)
    return tree


class Batch:
    """The trees of several pages as one forest of arrays."""

    def __init__(self, trees: list[Tree], index: dict[str, int], grow: bool = False):
        parent, depth, ids, owner, text = [], [], [], [], []
        self.label = []
        for t in trees:
            base = len(parent)
            for p, f in zip(t.parent, t.features):
                i = len(parent)
                parent.append(base + p if p >= 0 else -1)
                depth.append(depth[base + p] + 1 if p >= 0 else 0)
                for name in f:
                    k = index.setdefault(name, len(index)) if grow else index.get(name, -1)
                    if k >= 0:
                        ids.append(k)
                        owner.append(i)
            text += [x is not None for x in t.text]
            self.label += t.label
        self.parent = np.array(parent, np.int64)
        self.depth = np.array(depth, np.int64)
        self.ids, self.owner = np.array(ids, np.int64), np.array(owner, np.int64)
        self.kind = np.array(text, np.int64)
        order = np.argsort(self.depth, kind="stable")
        cuts = np.searchsorted(self.depth[order], np.arange(1, (self.depth.max() if len(order) else 0) + 2))
        self.levels = [x for x in np.split(order, cuts[:-1])]

    def run(self, model: dict) -> tuple[np.ndarray, np.ndarray]:
        """Marginal of content of each node, and of the four label pairs of each
        node with its parent."""
        n = len(self.parent)
        weight, edge = model["weight"], model["edge"]
        up = np.zeros((n, 2))
        up[:, 1] = np.bincount(self.owner, weight[self.ids], n) if n else 0
        message = np.zeros((n, 2))
        for level in reversed(self.levels[1:]):
            z = edge[self.kind[level]] + up[level][:, None, :]
            message[level] = np.logaddexp(z[:, :, 0], z[:, :, 1])
            np.add.at(up, self.parent[level], message[level])
        belief, pair = up.copy(), np.zeros((n, 2, 2))
        for level in self.levels[1:]:
            cavity = belief[self.parent[level]] - message[level]
            z = cavity[:, :, None] + edge[self.kind[level]]
            belief[level] = up[level] + np.logaddexp(z[:, 0], z[:, 1])
            pair[level] = z + up[level][:, None, :]
        top = np.logaddexp(belief[:, 0], belief[:, 1])
        flat = pair.reshape(n, 4)
        flat = np.exp(flat - flat.max(axis=1, keepdims=True))
        return np.exp(belief[:, 1] - top), (flat / flat.sum(axis=1, keepdims=True)).reshape(n, 2, 2)


def train(pages: list[str], steps: int = 300, rate: float = 0.08, ridge: float = 1e-5) -> dict:
    """Potentials that maximise the likelihood of pages whose blocks carry
    their label in a ``data-y`` attribute."""
    index: dict[str, int] = {}
    trees = [parse(p) for p in pages]
    for t in trees:  # an element is content if some run below it is
        has = [0] * len(t.parent)
        for i in range(len(t.parent) - 1, 0, -1):
            if t.text[i] is not None:
                has[i] = t.label[i]
            has[t.parent[i]] |= has[i]
        t.label = has
    b = Batch(trees, index, grow=True)
    y = np.array(b.label, np.int64)
    model = {"index": index, "weight": np.zeros(len(index)), "edge": np.zeros((2, 2, 2))}
    child = np.flatnonzero(b.parent >= 0)
    seen = np.zeros((2, 2, 2))
    np.add.at(seen, (b.kind[child], y[b.parent[child]], y[child]), 1.0)
    momentum = [np.zeros_like(model["weight"]), np.zeros_like(model["edge"])]
    square = [np.zeros_like(model["weight"]), np.zeros_like(model["edge"])]
    for step in range(1, steps + 1):
        p, pair = b.run(model)
        expected = np.zeros((2, 2, 2))
        np.add.at(expected, b.kind[child], pair[child])
        grads = [np.bincount(b.ids, (y - p)[b.owner], len(index)) / len(y) - ridge * model["weight"],
                 (seen - expected) / len(y) - ridge * model["edge"]]
        for k, (name, g) in enumerate(zip(("weight", "edge"), grads)):
            momentum[k] = 0.9 * momentum[k] + 0.1 * g
            square[k] = 0.99 * square[k] + 0.01 * g * g
            model[name] = model[name] + rate * (momentum[k] / (1 - 0.9 ** step)) / (np.sqrt(square[k] / (1 - 0.99 ** step)) + 1e-6)
    return model


def labelled_pages(n: int = TRAIN_PAGES, seed: int = SEED) -> list[str]:
    """Pages laid out from common parts; ``data-y`` marks content (1) and the
    rest (0)."""
    rng = np.random.default_rng(seed)
    syllables = "an the er on tion re in de la ou ver ung mente ch st ent al or is ed ti ar".split()
    r = lambda k: int(rng.integers(k))
    one = lambda xs: xs[r(len(xs))]
    chance = lambda p: rng.random() < p

    def word():
        return "".join(one(syllables) for _ in range(1 + r(3)))

    def sentence(least=3, most=18):
        w = [word() for _ in range(least + r(most - least + 1))]
        if len(w) > 6 and chance(0.6):
            w[len(w) // 2] += ","
        return " ".join(w).capitalize() + one([".", ".", ".", ".", "!", "?", ""])

    def prose(most=6):
        if chance(0.08):
            return word().capitalize() + one([".", ""])
        if chance(0.05):
            return " | ".join(word() for _ in range(4 + r(12)))
        return " ".join(sentence() for _ in range(1 + r(most)))

    def hint(kind, odd=0.3):
        if chance(odd):
            return one(["", f' class="{one("abcdefgh")}{r(99)}"', f' class="col-{r(12)}"', ' class="box"', ' class="wrap inner"'])
        w = one(HINTS[kind].split())
        return one([f' class="{w}"', f' id="{w}"', f' class="{w}-{word()}"', f' class="{word()} {w}"'])

    def bare(tag, kind, odd):  # elements that say what they are often have no class
        return "" if tag in ("nav", "header", "footer", "aside") and chance(0.5) else hint(kind, odd)

    link = lambda text=None: f'<a href="/{word()}">{text or word()}</a>'

    def items(k, linked=True):
        return "<ul>" + "".join(f"<li>{link(sentence(1, 4)) if linked else sentence(1, 8)}</li>" for _ in range(k)) + "</ul>"

    def menu():
        inner = one([items(3 + r(6)), " ".join(link() for _ in range(3 + r(6))), " | ".join(link() for _ in range(3 + r(5)))])
        tag = one(["nav", "nav", "div", "ul" if inner.startswith("<ul>") else "div"])
        return f'<{tag}{bare(tag, "nav", 0.1)} data-y="0">{inner}</{tag}>'

    def head():
        tag = one(["header", "header", "div"])
        return f'<{tag}{bare(tag, "head", 0.1)} data-y="0">{one([link(sentence(1, 3)), "<p>" + sentence(1, 4) + "</p>", "<h2>" + word() + "</h2>" + menu(), sentence(1, 6)])}</{tag}>'

    def foot():
        tag = one(["footer", "footer", "div"])
        return f'<{tag}{bare(tag, "foot", 0.1)} data-y="0">&copy; {r(30) + 1995} {word()}.example &middot; {one([sentence(), items(3), link() + " " + link(), "<p>" + sentence() + "</p>"])}</{tag}>'

    def side():
        tag = one(["aside", "aside", "div", "section"])
        return f'<{tag}{bare(tag, "side", 0)} data-y="0">{one(["", "<h3>" + sentence(1, 3) + "</h3>"])}{one([items(2 + r(6)), "<p>" + prose(2) + "</p>", "<p>" + link(sentence(3, 9)) + "</p>" * 1, "<div>" + sentence() + "</div>"])}</{tag}>'

    def advert():
        tag = one(["div", "div", "aside", "section", "p"])
        return f'<{tag}{hint("ad", 0)} data-y="0">{one([prose(3), sentence(), link(sentence(2, 8)), sentence() + link("more")])}</{tag}>'

    def notice():
        tag = one(["div", "section", "p", "dialog"])
        inner = prose(3) if tag == "p" else one([prose(2), "<p>" + prose(2) + "</p>", sentence() + "<button>OK</button>", "<p>" + sentence() + "</p><button>" + word() + "</button>"])
        return f'<{tag}{hint("notice", 0)} data-y="0">{inner}</{tag}>'

    def form():
        return f'<form{hint("form", 0.5)} data-y="0"><label>{sentence(1, 4)}</label><input name="q">{one(["", "<p>" + sentence() + "</p>"])}{one(["", "<select><option>" + word() + "<option>" + word() + "</select>"])}<button>{word()}</button></form>'

    def share():
        return f'<div{hint("share", 0)} data-y="0">{" ".join(link() for _ in range(2 + r(4)))}</div>'

    def comments(inside=False):
        talk = chance(0.15)
        def one_comment():
            t = one(["div", "li", "article"] + ["p"] * (not (talk and inside)))
            if t == "p":
                return f"<p>{prose(3)}</p>"
            return f'<{t}{hint("comment", 0) if talk and inside else one([hint("comment", 0), ""])}>{one(["", "<b>" + word() + "</b> ", "<h4>" + word() + "</h4>", link()])}<p>{prose(4)}</p></{t}>'
        tag = one(["section", "div", "div", "ol", "aside"])
        return f'<{tag}{hint("talk" if talk else "comment", 0)} data-y="0">{one(["", "<h3>" + sentence(1, 3) + "</h3>"]) if tag != "ol" else ""}{"".join(one_comment() for _ in range(1 + r(5)))}</{tag}>'

    def body_block():
        k = r(20)
        if k < 12:
            text = prose()
            if chance(0.2):
                text = f"<b>{text}<br>" if chance(0.5) else f"{text} {link(sentence(1, 3))} {sentence()}"
            return f"<p>{text}" + ("</p>" if chance(0.85) else "")
        if k < 14:
            return f"<h{2 + r(3)}>{sentence(1, 7)}</h{2}>"
        if k == 14:
            return items(2 + r(5), chance(0.5))
        if k == 15:
            return f"<blockquote><p>{prose(2)}</p></blockquote>"
        if k == 16:
            return "<table>" + "".join(f"<tr><td>{word()}</td><td>{r(99)}</td></tr>" for _ in range(2 + r(3))) + "</table>"
        if k == 17:
            return f"<pre>{sentence()}\n{sentence()}</pre>"
        if k == 18:
            return f"<figure><img src=x><figcaption>{sentence()}</figcaption></figure>"
        return f"<div>{prose(3)}</div>"

    def mark(html):  # the blocks of an article are content
        return re.sub(r"<(p|h\d|ul|ol|blockquote|table|pre|figure|div)>", r'<\1 data-y="1">', html)

    def part():  # a section of an article; its name tells nothing
        inner = "".join(mark(body_block()) for _ in range(1 + r(3)))
        name = one([f' id="{word()}"', ' id="discussion"', ' class="discussion"', ""])
        return f'<section{name} data-y="1"><h{2 + r(2)} data-y="1">{sentence(1, 4)}</h2>{inner}</section>'

    def layout(body):  # a page in the cells of a table
        bar = one([menu_cell, menu_cell, lambda: f"<td>{side()}</td>"])()
        main = f'<td data-y="1">{body}</td>'
        middle = one([bar + main, bar + main, main + bar, bar + main + f'<td data-y="0">{one([sentence(), menu_lines()])}</td>'])
        wide = lambda x: f'<tr><td colspan="{2 + r(2)}" data-y="0">{x}</td></tr>'
        top = wide(one([f"<b>{sentence(1, 3)}</b>", sentence(1, 3), link(sentence(1, 3)), menu_lines()])) if chance(0.6) else ""
        end = wide(one([f"Copyright {r(30) + 1990}", f"&copy; {word()} {r(30) + 1990}", sentence(2, 6), menu_lines()])) if chance(0.6) else ""
        return f"<table>{top}<tr>{middle}</tr>{end}</table>"

    def menu_lines():
        return one(["<br>", " ", " | "]).join(link() for _ in range(3 + r(6)))

    def menu_cell():
        return f'<td{one(["", " width=120"])} data-y="0">{one([menu_lines(), menu_lines(), items(3 + r(5))])}</td>'

    def article():
        short = chance(0.3)
        blocks = [mark(f"<p>{sentence(1, 5)}</p>" if short else body_block()) for _ in range(1 + r(2 if short else 10))]
        if chance(0.75):
            title = f'<h1 data-y="1">{sentence(1, 9)}</h1>'
            blocks.insert(0, f'<header data-y="1">{title}</header>' if chance(0.15) else title)
        if chance(0.15):
            blocks += [part() for _ in range(1 + r(3))]
        if chance(0.08):
            blocks.append(f'<h2 data-y="1">{sentence(1, 3)}</h2>' + mark(items(2 + r(5))))
        for other, p in ((advert, 0.12), (share, 0.1), (notice, 0.06), (side, 0.06), (form, 0.05), (menu, 0.04)):
            if chance(p):
                blocks.insert(r(len(blocks)) + 1, other())
        if chance(0.12):
            blocks.append(comments(True))
        if chance(0.06):
            blocks.append(foot())
        tag = one(["article", "article", "article", "main", "div", "div", "section"])
        named = hint("main", 0.3) if tag in ("div", "section") else one(["", "", hint("main", 0.3)])
        inner = "\n".join(blocks) if chance(0.5) else "".join(blocks)
        out = f'<{tag}{named} data-y="1">{inner}</{tag}>'
        if tag == "article" and chance(0.3):
            out = f'<main data-y="1">{out}{comments(True) if chance(0.3) else ""}</main>'
        return out

    pages = []
    for _ in range(n):
        before = [f() for f, p in ((head, 0.5), (menu, 0.7), (notice, 0.25), (advert, 0.5), (form, 0.15), (side, 0.2)) if chance(p)]
        after = [f() for f, p in ((comments, 0.3), (share, 0.2), (side, 0.4), (advert, 0.25), (form, 0.15), (notice, 0.15), (menu, 0.15), (foot, 0.8)) if chance(p)]
        if chance(0.08):
            title = f'<h1 data-y="1">{sentence(1, 9)}</h1>' if chance(0.7) else ""
            body = title + "".join(mark(body_block()) for _ in range(2 + r(6)))
            pages.append(f'<html><head><title>{sentence()}</title></head><body>{layout(body)}</body></html>')
            continue
        middle = article()
        if chance(0.25):
            middle = f'<div{one(["", hint("main", 0.5)])} data-y="1">{middle}{side() if chance(0.5) else ""}</div>'
        pages.append(f'<!DOCTYPE html><html><head><title>{sentence()}</title></head><body>{"".join(before)}{middle}{"".join(after)}</body></html>')
    return pages


def trained() -> dict:
    return train(labelled_pages())


def main_texts(pages: list[str | None], model: dict) -> list[str]:
    trees = [parse(p) for p in pages]
    p, _ = Batch(trees, model["index"]).run(model)
    out, at = [], 0
    for t in trees:
        keep = p[at:at + len(t.parent)] >= 0.5
        out.append("\n\n".join(x for x, k in zip(t.text, keep) if x is not None and k))
        at += len(t.parent)
    return out


def _extract(model: dict):
    def run(batches):
        for batch in batches:
            html, texts = batch.column("html"), []
            at = 0
            while at < batch.num_rows:  # several pages at once, up to a few MB of markup
                end, size = at, 0
                while end < batch.num_rows and end - at < PAGES_AT_ONCE and size < 1 << 22:
                    size += len(html[end].as_py() or "")
                    end += 1
                texts += main_texts([html[i].as_py() for i in range(at, end)], model)
                at = end
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(x) for x in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])
    return run


def extract(pages: DataFrame, model: dict | None = None) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(
        _extract(model or trained()), "page_id long, url string, text string, n_chars long")
