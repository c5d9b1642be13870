"""Main text of pages by a tree-structured graphical model over their elements.

Every block element is a node with a hidden label, content or not. A node has a potential
from its own features (tag, names in class and id, length, share of linked text) and each
parent and child share one that depends on the kind of the child; the joint distribution
is their product over the tree. Sum-product messages, up from the leaves and down from
the root, give each node's exact marginal, and the text of nodes that are content with a
probability of at least one half is the page's main text. Both potentials are learned from
labelled pages (``page_samples``, or any whose elements carry ``data-label``).

A narrow stage: pages are read where they are, parameters are a few hundred numbers.
Messages of many pages are computed together, one array operation per depth.

Defined cases: a null or empty page and one without content give an empty text; broken
markup is closed where a browser would close it; text that stands in no element counts to
the page's root; what is never shown (scripts, styles, head, templates, hidden elements)
is no text; line breaks and all white space inside a block become one space; pages of any depth are
read whole, as messages go level by level without recursion; rows are neither dropped nor
merged; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from homestrata.llm.page_samples import labelled_pages

ROUNDS = 150
RATE = 0.1
RIDGE = 0.1

_HIDDEN = frozenset("script style head title noscript template iframe svg object canvas audio video".split())
_RAW = frozenset("script style title noscript iframe".split())  # only their own end tag ends them
_WALLS = frozenset("template object".split())  # end tags inside do not reach what is outside
_IN_HEAD = frozenset("base basefont bgsound link meta title noscript noframes style script template html head".split())
# what ends an svg that was left open, unless it stands in one of the elements that hold HTML
_NOT_IN_SVG = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr "
    "ol p pre ruby s small span strong strike sub sup table tt u ul var".split()
)
_HTML_IN_SVG = frozenset("foreignobject desc title".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "html body article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption "
    "blockquote pre figure figcaption nav header footer aside form fieldset legend address details summary dialog hr "
    "menu center button select option textarea label".split()
)
# what an opening tag closes, if it is open above it and below the nearest of the stops
_P_CLOSERS = frozenset(
    "article main section div p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure figcaption nav header footer "
    "aside form fieldset address details dialog hr menu center".split()
)
_SAME = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table", "thead", "tbody", "tfoot")),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "tbody": (("thead", "tbody", "tfoot"), ("table",)),
    "tfoot": (("thead", "tbody", "tfoot"), ("table",)),
    "option": (("option",), ("select",)),
}
_SCOPE = frozenset("html body table td th caption button".split())

_TAGS = (
    "html body article main section div p h1 h2 h3 h4 h5 h6 ul ol li table tr td blockquote pre nav header footer "
    "aside form button label figure figcaption address"
).split()
_TAG_AT = {t: i for i, t in enumerate(_TAGS)}
# stems that class names and ids are looked through for
_STEMS = (
    "nav menu header masthead footer copyright sidebar widget related ad ads advert banner sponsor promo cookie consent "
    "notice alert popup modal disclaimer newsletter subscribe signup login search form share social comment comments reply "
    "discussion breadcrumb toolbar pagination tags content article post entry story main text body title wrapper container"
).split()
_STEM_AT = {s: i for i, s in enumerate(_STEMS)}
_NAME = re.compile(r"[a-z]+")
_FEATURES = len(_TAGS) + 1 + len(_STEMS) + 10
_EDGES = len(_TAGS) + 1


def _stem(word: str) -> int | None:
    at = _STEM_AT.get(word)
    if at is None and word.endswith("s"):
        at = _STEM_AT.get(word[:-1])
    if at is None:
        for prefix in ("comment", "advert", "sponsor", "sidebar", "cookie", "newsletter", "nav", "footer", "header", "related"):
            if word.startswith(prefix):
                return _STEM_AT[prefix]
    return at


class _Reader(HTMLParser):
    """Elements in page order, and the runs of text of each block."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parents, self.tags, self.names, self.depths, self.labels = [-1], ["body"], [""], [0], [None]
        self.texts: list[tuple[int, str, int]] = []  # node, text, linked characters
        # tag, the block node it is in, whether it hides, whether it is a block that is not inside a hidden element
        self._open: list[tuple[str, int, bool, bool]] = [("", 0, False, False)]
        self._opened: Counter[str] = Counter()
        self._run: list[str] = []
        self._linked = self._links = self._hidden = 0

    def _end_run(self) -> None:
        if self._run:
            text = " ".join("".join(self._run).split())
            if text:
                self.texts.append((self._open[-1][1], text, self._linked))
            self._run, self._linked = [], 0

    def _pop_to(self, at: int) -> None:
        if any(breaks for *_, breaks in self._open[at:]):
            self._end_run()
        for tag, _, hidden, _ in self._open[at:]:
            self._links -= tag == "a"
            self._hidden -= hidden
            self._opened[tag] -= 1
        del self._open[at:]

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if self._open[-1][0] in _RAW:
            return
        if self._opened["head"] and tag not in _IN_HEAD:
            self._close_open(("head",), ())
        if self._opened["svg"] and tag in _NOT_IN_SVG:
            self._close_open(("svg",), _HTML_IN_SVG)
        given = dict(attrs)
        if tag in _VOID:
            if self._hidden:
                pass
            elif tag in ("hr",):
                self._end_run()
            elif tag == "br":
                self._run.append(" ")
            return
        if tag in _P_CLOSERS:
            self._close_open(("p",), _SCOPE)
        elif tag in _SAME:
            self._close_open(*_SAME[tag])
        node = self._open[-1][1]
        style = (given.get("style") or "").replace(" ", "").lower()
        hidden = tag in _HIDDEN or "hidden" in given or "display:none" in style
        breaks = tag in _BLOCK and not self._hidden
        if breaks:
            self._end_run()
        if breaks and not hidden:
            self.parents.append(node)
            self.tags.append(tag)
            self.names.append(f"{given.get('class') or ''} {given.get('id') or ''} {given.get('role') or ''}".lower())
            self.depths.append(self.depths[node] + 1)
            # given pages have the attribute for their own ends, with other values
            own = given.get("data-label")
            self.labels.append(own if own in ("0", "1") else self.labels[node])
            node = len(self.parents) - 1
        self._links += tag == "a"
        self._hidden += hidden
        self._opened[tag] += 1
        self._open.append((tag, node, hidden, breaks))

    def _close_open(self, tags: tuple, stops) -> None:
        if not any(self._opened[tag] for tag in tags):
            return
        for at in range(len(self._open) - 1, 0, -1):
            if self._open[at][0] in tags:
                self._pop_to(at)
                return
            if self._open[at][0] in stops or self._open[at][0] in _WALLS:
                return

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        depth = len(self._open)
        self.handle_starttag(tag, attrs)
        # only in svg does the slash close; elsewhere a browser ignores it
        if self._opened["svg"] and len(self._open) > depth:
            self._pop_to(depth)

    def handle_endtag(self, tag: str) -> None:
        if self._open[-1][0] in _RAW and tag != self._open[-1][0]:
            return
        if tag in ("body", "html"):
            self._close_open(("head",), ())
        if not self._opened[tag]:
            return
        block = tag in _BLOCK or tag in _HIDDEN
        for at in range(len(self._open) - 1, 0, -1):
            if self._open[at][0] == tag:
                self._pop_to(at)
                return
            if not block and self._open[at][0] in _BLOCK:
                return  # an inline end tag does not reach past its block
            if tag == "p" and self._open[at][0] in _SCOPE or self._open[at][0] in _WALLS:
                return

    def handle_data(self, data: str) -> None:
        if self._open[-1][0] == "head" and not data.isspace():
            self._close_open(("head",), ())
        if not self._hidden:
            self._run.append(data)
            if self._links > 0:
                self._linked += len(data)

    def close(self) -> None:
        super().close()
        self._end_run()


@dataclass
class Forest:
    """Nodes of several pages: each page's own are consecutive, parents come first."""

    parent: np.ndarray
    depth: np.ndarray
    features: np.ndarray
    edge: np.ndarray  # kind of a node's tag
    label: np.ndarray  # 1, 0, or -1 where there is none
    texts: list[list[tuple[int, str]]]  # per page: node, text of a block


def read_pages(pages: list[str | None], labelled: bool = False) -> Forest:
    """Nodes and texts of pages; what labels say is read only where they are ``labelled``."""
    parent, depth, edge, label, texts = [], [], [], [], []
    stems: list[tuple[int, int]] = []
    chars, linked, runs = [], [], []
    for html in pages:
        base = len(parent)
        reader = _Reader()
        if html:
            reader.feed(html)
            reader.close()
        parent += [p + base if p >= 0 else -1 for p in reader.parents]
        depth += reader.depths
        edge += [_TAG_AT.get(t, len(_TAGS)) for t in reader.tags]
        label += [int(x) if labelled and x else -1 for x in reader.labels]
        for i, name in enumerate(reader.names):
            if name and not name.isspace():
                stems += [(base + i, at) for at in map(_stem, _NAME.findall(name)) if at is not None]
        chars += [0] * len(reader.parents)
        linked += [0] * len(reader.parents)
        runs += [0] * len(reader.parents)
        for node, text, inside in reader.texts:
            chars[base + node] += len(text)
            linked[base + node] += min(inside, len(text))
            runs[base + node] += 1
        texts.append([(base + node, text) for node, text, _ in reader.texts])
    parent, depth, edge = np.array(parent, np.int64), np.array(depth), np.array(edge)
    own = np.array([chars, linked, runs], np.float64).T
    below = own.copy()
    levels = _levels(depth)
    for at in levels[:0:-1]:
        np.add.at(below, parent[at], below[at])
    total = np.maximum(below[:, 0], 1)
    share = below[:, 1] / total
    x = np.zeros((len(parent), _FEATURES), np.float32)
    x[np.arange(len(parent)), edge] = 1
    for node, at in stems:
        x[node, len(_TAGS) + 1 + at] = 1
    tail = x[:, len(_TAGS) + 1 + len(_STEMS) :]
    tail[:, 0] = 1
    tail[:, 1] = np.log1p(np.minimum(own[:, 0], 300)) / 5
    tail[:, 2] = np.log1p(np.minimum(below[:, 0], 800)) / 7
    tail[:, 3] = share
    tail[:, 4] = (share > 0.5) & (below[:, 0] > 0)
    tail[:, 5] = own[:, 0] == 0
    tail[:, 6] = below[:, 0] < 25
    tail[:, 7] = below[:, 0] > 200
    tail[:, 8] = np.minimum(depth, 10) / 10
    tail[:, 9] = np.log1p(np.minimum(below[:, 2], 8))
    return Forest(parent, depth, x, edge, np.array(label), texts)


def _levels(depth: np.ndarray) -> list[np.ndarray]:
    order = np.argsort(depth, kind="stable")
    cuts = np.flatnonzero(np.diff(depth[order])) + 1
    return np.split(order, cuts)


@dataclass
class Potentials:
    """``unary``: log-odds weights; ``pair[e, a, b]``: log potential of parent a, child b, edge e."""

    unary: np.ndarray
    pair: np.ndarray


def _messages(forest: Forest, potentials: Potentials) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sum-product up and down each tree, in log-odds: what each node hears from itself and
    below, its belief, and what its parent believes without it."""
    pair = potentials.pair[forest.edge]
    levels = _levels(forest.depth)
    up = np.zeros(len(pair))
    below = forest.features @ potentials.unary
    for at in levels[:0:-1]:
        p, b = pair[at], below[at]
        up[at] = np.logaddexp(p[:, 1, 1] + b, p[:, 1, 0]) - np.logaddexp(p[:, 0, 1] + b, p[:, 0, 0])
        np.add.at(below, forest.parent[at], up[at])
    belief, rest = below.copy(), np.zeros(len(pair))
    for at in levels[1:]:
        p, r = pair[at], belief[forest.parent[at]] - up[at]
        rest[at] = r
        belief[at] = below[at] + np.logaddexp(p[:, 1, 1] + r, p[:, 0, 1]) - np.logaddexp(p[:, 1, 0] + r, p[:, 0, 0])
    return below, belief, rest


def _probability(log_odds: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(log_odds, -50, 50)))


def marginals(forest: Forest, potentials: Potentials) -> np.ndarray:
    """Probability of content per node."""
    return _probability(_messages(forest, potentials)[1])


def train(pages: list[str]) -> Potentials:
    """Weights of both potentials by maximum likelihood of the labels.

    The gradient is what the labels show less what the model expects, and the messages give
    the model's expectations exactly: of a node's label, and of a parent and child agreeing.
    """
    forest = read_pages(pages, labelled=True)
    label = np.where(forest.label >= 0, forest.label, 1)  # what holds the page is content
    child = np.flatnonzero(forest.parent >= 0)
    agree = np.where(label[child] == label[forest.parent[child]], 1.0, -1.0)
    w, moment, scale = (np.zeros(_FEATURES + _EDGES) for _ in range(3))
    for n in range(1, ROUNDS + 1):
        learned = _potentials(w)
        below, belief, rest = _messages(forest, learned)
        node = forest.features.T @ (label - _probability(belief))
        t, r, b = learned.pair[forest.edge[child]], rest[child], below[child]
        same = np.logaddexp(t[:, 1, 1] + r + b, t[:, 0, 0])
        other = np.logaddexp(t[:, 1, 0] + r, t[:, 0, 1] + b)
        edge = np.bincount(forest.edge[child], agree - np.tanh((same - other) / 2), _EDGES)
        gradient = np.append(node, edge) - RIDGE * w
        moment = 0.9 * moment + 0.1 * gradient
        scale = 0.99 * scale + 0.01 * gradient**2
        w += RATE * (moment / (1 - 0.9**n)) / (np.sqrt(scale / (1 - 0.99**n)) + 1e-8)
    return _potentials(w)


def _potentials(w: np.ndarray) -> Potentials:
    tie = w[_FEATURES:, None, None] / 2
    return Potentials(w[:_FEATURES], tie * np.array([[1.0, -1.0], [-1.0, 1.0]]))


@lru_cache(maxsize=1)
def default_potentials() -> Potentials:
    return train(labelled_pages())


def main_texts(pages: list[str | None], potentials: Potentials) -> list[str]:
    forest = read_pages(pages)
    content = marginals(forest, potentials) >= 0.5
    return ["\n".join(text for node, text in blocks if content[node]) for blocks in forest.texts]


def extract(
    pages: DataFrame, keys: list[str], html_col: str = "html", potentials: Potentials | None = None
) -> DataFrame:
    """(keys, text) per page."""
    learned = potentials or default_potentials()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            html = batch.column(len(keys)).to_pylist()
            for at in range(0, len(html), 128):
                texts = pa.array(main_texts(html[at : at + 128], learned), pa.string())
                columns = [batch.column(k).slice(at, len(texts)) for k in range(len(keys))]
                yield pa.record_batch([*columns, texts], names=[*keys, "text"])

    rows = pages.select(*keys, F.col(html_col).cast("string"))
    kinds = ", ".join(f"`{k}` {pages.schema[k].dataType.simpleString()}" for k in keys)
    return rows.mapInArrow(run, f"{kinds}, text string")
