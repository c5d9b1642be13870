"""The one vectorised Python stage: page HTML -> raw candidates.

Spark has no HTML parser, so pages go through ``mapInArrow`` once. The stage only
collects what is literally on the page (texts, tags, links); every rule about what
those mean is a Column expression applied afterwards.
"""

from __future__ import annotations

import html
import re
import sys
from collections.abc import Iterable, Iterator
from html.parser import HTMLParser
from itertools import accumulate

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from homestrata.schemas import struct

# The stage travels to the workers by value: they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CANDIDATES = struct(
    "text string, metas map<string,string>, ld_json array<string>, images nested, links nested",
    images=T.ArrayType(struct("kind string, url string")),
    links=T.ArrayType(struct("pos int, href string, price_text string, dollar_text string")),
)

_ARROW = {
    "text": pa.string(),
    "metas": pa.map_(pa.string(), pa.string()),
    "ld_json": pa.list_(pa.string()),
    "images": pa.list_(pa.struct([("kind", pa.string()), ("url", pa.string())])),
    "links": pa.list_(
        pa.struct(
            [
                ("pos", pa.int32()),
                ("href", pa.string()),
                ("price_text", pa.string()),
                ("dollar_text", pa.string()),
            ]
        )
    ),
}

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_HIDDEN = frozenset(["script", "style", "template"])
_CARD_CLASS = re.compile("home|card|listing", re.I)
_PRICE_CLASS = re.compile("price", re.I)
_DOLLAR = re.compile(r"\$[\d,]+")
_NONE_STARTED: list[list[str]] = []

# Text up to a tag, and a start tag whose attributes are quoted or bare names, or an end tag. Most tags
# are as plain as that; what this does not match is left to the library's own rules.
_PLAIN = re.compile(
    r"([^<]*+)<(?:([a-zA-Z][-.a-zA-Z0-9:_]*+)"
    r'((?:[ \t\n\r\f]++[a-zA-Z][-\w.:]*+(?:="[^"]*+")?+)*+)[ \t\n\r\f]*+(/?)>'
    r"|/([a-zA-Z][-.a-zA-Z0-9:_]*+)>)"
)
_ATTRIBUTE = re.compile(r'([a-zA-Z][-\w.:]*+)(?:="([^"]*+)")?+')


class _Card:
    """An open listing card: its first price element's text and first ``$`` text."""

    __slots__ = ("price", "dollar")

    def __init__(self) -> None:
        self.price: list[str] | None = None
        self.dollar: str | None = None


class _PageReader(HTMLParser):
    """One pass over a page; open elements are kept on a stack.

    ``read`` goes from tag to tag by one pattern and gives the same calls as ``feed`` and ``close``.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.words: list[str] = []
        self.metas: dict[str, str] = {}
        self.ld_json: list[str] = []
        self.images: list[tuple[str, str]] = []
        self.links: list[tuple[str, _Card | None]] = []
        self._open: list[tuple[str, _Card | None, list[list[str]]]] = []
        self._cards: list[_Card] = []
        self._collecting: list[list[str]] = []
        self._script: list[str] | None = None

    def updatepos(self, i, j):
        """Line numbers are not needed, and counting them takes a tenth of the time."""
        return j

    def read(self, page: str) -> None:
        self.rawdata = page
        i, n = 0, len(page)
        while i < n:
            plain = None if self.cdata_elem else _PLAIN.match(page, i)
            if plain is None:
                k = self._odd(page, i)
                if k < 0:
                    break
                i = k
                continue
            i = plain.end()
            text, tag, attrs, closed, ended = plain.groups()
            if text:
                self.handle_data(html.unescape(text))
            if ended:
                self.handle_endtag(ended.lower())
                continue
            tag = tag.lower()
            attr: dict[str, str] = {}
            if attrs:
                for name, value in _ATTRIBUTE.findall(attrs):
                    attr.setdefault(name.lower(), html.unescape(value))
            self._start(tag, attr)
            if closed:
                self.handle_endtag(tag)
            elif tag in self.CDATA_CONTENT_ELEMENTS:
                self.set_cdata_mode(tag)

    def _odd(self, page: str, i: int) -> int:
        """Text and one construct by the library's rules: where it ends, or -1 when all that is left is read."""
        if self.cdata_elem:
            found = self.interesting.search(page, i)
            at = found.start() if found else -1
        else:
            at = page.find("<", i)
        if at < 0:
            return self._rest(page, i)
        after = page[at + 1 : at + 2]
        if after == "/":
            parse = self.parse_endtag
        elif page.startswith("<!--", at):
            parse = self.parse_comment
        elif after.isascii() and after.isalpha():
            parse = self.parse_starttag
        elif page[at : at + 9].lower() == "<!doctype":
            parse = self.parse_html_declaration
        else:
            return self._rest(page, i)
        if i < at:
            text = page[i:at]
            self.handle_data(text if self.cdata_elem else html.unescape(text))
        k = parse(at)
        return k if k >= 0 else self._rest(page, at)

    def _rest(self, page: str, i: int) -> int:
        self.rawdata = ""
        self.feed(page[i:])
        self.close()
        return -1

    def handle_starttag(self, tag, attrs):
        # as browsers do, the first of repeated attributes counts
        attr: dict[str, str] = {}
        for name, value in attrs:
            attr.setdefault(name, value or "")
        self._start(tag, attr)

    def _start(self, tag: str, attr: dict[str, str]) -> None:
        if tag == "meta":
            self._meta(attr)
        elif tag == "link":
            self._preload(attr)
        elif tag == "img":
            src = attr.get("src") or attr.get("data-src")
            if src:
                self.images.append(("img", src))
        elif tag == "a" and attr.get("href"):
            self.links.append((attr["href"], self._cards[-1] if self._cards else None))
        elif tag == "script":
            is_data = attr.get("type") == "application/ld+json"
            self._script = [] if is_data else None
        if tag in _VOID:
            return
        css = attr.get("class")
        if not css:
            self._open.append((tag, None, _NONE_STARTED))
            return
        started = []
        if _PRICE_CLASS.search(css):
            for card in self._cards:
                if card.price is None:
                    card.price = []
                    started.append(card.price)
        self._collecting.extend(started)
        card = None
        if tag in ("div", "article") and _CARD_CLASS.search(css):
            card = _Card()
            self._cards.append(card)
        self._open.append((tag, card, started))

    def handle_endtag(self, tag):
        if tag == "script" and self._script is not None:
            self.ld_json.append("".join(self._script))
            self._script = None
        if not self._open or self._open[-1][0] != tag:
            if not any(name == tag for name, _, _ in self._open):
                return
        while self._open:
            name, card, started = self._open.pop()
            if card is not None:
                self._cards.pop()
            if started:
                del self._collecting[-len(started) :]
            if name == tag:
                return

    def handle_data(self, data):
        if self._open and self._open[-1][0] in _HIDDEN:
            if self._script is not None:
                self._script.append(data)
            return
        word = data.strip()
        if word:
            self.words.append(word)
        for texts in self._collecting:
            texts.append(data)
        if self._cards and "$" in data and _DOLLAR.search(data):
            for card in self._cards:
                if card.dollar is None:
                    card.dollar = data

    def _meta(self, attr):
        content = attr.get("content", "")
        if "name" in attr:
            self.metas.setdefault(attr["name"], content)
        label = attr.get("name") or attr.get("property") or ""
        if content and "image" in label.lower():
            self.images.append(("meta", content))

    def _preload(self, attr):
        is_preload = "preload" in attr.get("rel", "").split()
        if is_preload and attr.get("as") == "image" and attr.get("href"):
            self.images.append(("preload", attr["href"]))


def _read_page(page: str | None) -> _PageReader:
    reader = _PageReader()
    reader.read(page or "")
    return reader


def _lists(values: list[list], items: pa.Array) -> pa.ListArray:
    """Lists as long as ``values``, their elements one after the other in ``items``."""
    return pa.ListArray.from_arrays(pa.array([0, *accumulate(map(len, values))], pa.int32()), items)


def _structs(kind: pa.ListType, fields: list[Iterable]) -> pa.StructArray:
    kinds = list(kind.value_type)
    return pa.StructArray.from_arrays([pa.array(v, f.type) for v, f in zip(fields, kinds)], fields=kinds)


def _candidate(name: str, read: list[_PageReader]) -> pa.Array:
    """One candidate column of the pages read."""
    kind = _ARROW[name]
    if name == "text":
        return pa.array([" ".join(page.words) for page in read], kind)
    if name == "metas":
        return pa.array([list(page.metas.items()) for page in read], kind)
    if name == "ld_json":
        return pa.array([page.ld_json for page in read], kind)
    if name == "images":
        found = [page.images for page in read]
        kinds, urls = [i[0] for some in found for i in some], [i[1] for some in found for i in some]
        return _lists(found, _structs(kind, [kinds, urls]))
    found = [page.links for page in read]
    every = [link for some in found for link in some]
    places = [pos for some in found for pos in range(len(some))]
    prices = [None if card is None or card.price is None else "".join(card.price) for _, card in every]
    dollars = [None if card is None else card.dollar for _, card in every]
    return _lists(found, _structs(kind, [places, [href for href, _ in every], prices, dollars]))


# Pages that are held as Python objects at once.
PAGES_AT_ONCE = 128


def _read_batches(
    batches: Iterator[pa.RecordBatch], html_col: str, kept: list[str], wanted: list[str]
) -> Iterator[pa.RecordBatch]:
    """Pages of a batch a few at a time: what a worker holds follows neither the batch nor the table."""
    for batch in batches:
        for i in range(0, batch.num_rows, PAGES_AT_ONCE):
            some = batch.slice(i, PAGES_AT_ONCE)
            found = [_read_page(page) for page in some.column(html_col).to_pylist()]
            read = [_candidate(name, found) for name in wanted]
            # the other columns pass through untouched
            columns = [some.column(name) for name in kept] + read
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, *wanted])


def read_pages(pages: DataFrame, wanted: list[str] | None = None, html_col: str = "html") -> DataFrame:
    """Replace the HTML column by its candidate columns.

    ``wanted`` names the candidate columns to keep, so that a link job does not ship
    page texts back from the Python workers. A narrow stage: pages stay where they are.
    """
    wanted = wanted or CANDIDATES.fieldNames()
    kept = [f for f in pages.schema.fields if f.name != html_col]
    schema = T.StructType(kept + [CANDIDATES[name] for name in wanted])
    kept_names = [f.name for f in kept]
    return pages.mapInArrow(lambda batches: _read_batches(batches, html_col, kept_names, wanted), schema)


@F.pandas_udf(T.StringType())
def _unescape(texts: pd.Series) -> pd.Series:
    return texts.map(html.unescape, na_action="ignore")


def unescape_html(text: Column) -> Column:
    """Resolve character references that are still in a text after parsing."""
    return _unescape(text)
