"""Links, product records and store cards from a table of web pages.

Spark partitions the pages; only the ``html`` column goes to Python, one Arrow
batch at a time, and comes back as an array of structs that Spark unpacks. Pages
that cannot hold what is sought are answered before that, inside the JVM.
"""

from __future__ import annotations

import sys
from html.parser import HTMLParser
from typing import NamedTuple

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F, types as T

# Workers get the parser with the job and need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
_UNREAD = frozenset(("script", "style", "template"))


class Selector(NamedTuple):
    """An element by tag, by classes it must all have, and by id; ``None`` is any."""

    tag: str | None = None
    classes: tuple[str, ...] = ()
    id: str | None = None

    def marker(self) -> str:
        """Text that every page with such an element contains."""
        return self.id or (self.classes[-1] if self.classes else f"<{self.tag or ''}")


# Where the harvested shop keeps its data.
LISTING_BLOCK = Selector("div", ("item-category-des",))
DETAIL_SECTIONS = (
    Selector(None, ("col-sm-5", "mnv-product-details")),
    Selector(None, ("col-sm-6", "mnv-product-details")),
)
DETAIL_NAME = Selector("h1")
DETAIL_PRICE = Selector(None, ("price-new",))
DETAIL_CODE = Selector(None, (), "p_model")
DISTRICT_HEADING = Selector("div", ("shop-liststyles__TitleHeader-sc-w4fccm-4",))
STORE_CARD = Selector("div", ("shop-liststyles__ShopCard-sc-w4fccm-2",))
STORE_NAME = Selector("div", ("shop-liststyles__StoreHeader-sc-w4fccm-6",))


class Element:
    """An element with the elements and text below it, in document order."""

    __slots__ = ("tag", "attrs", "classes", "inner", "texts")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs = tag, attrs
        self.classes = frozenset(attrs.get("class", "").split())
        self.inner: list[Element] = []
        self.texts: list[str] = []

    def fits(self, wanted: Selector) -> bool:
        return (
            (wanted.tag is None or wanted.tag == self.tag)
            and self.classes.issuperset(wanted.classes)
            and (wanted.id is None or wanted.id == self.attrs.get("id"))
        )

    def every(self, wanted: Selector) -> list["Element"]:
        return [e for e in self.inner if e.fits(wanted)]

    def first(self, *wanted: Selector) -> "Element | None":
        return next((e for e in self.inner if any(e.fits(w) for w in wanted)), None)

    def text(self) -> str:
        return "".join(t for t in (s.strip() for s in self.texts) if t)


class _Reader(HTMLParser):
    """Collects elements; an end tag closes up to the nearest open tag of its name.

    Only elements that fit ``kept`` note what is below them.
    """

    def __init__(self, kept: tuple[Selector, ...]):
        super().__init__(convert_charrefs=True)
        self.kept = kept
        self.page = Element("", {})
        self.open: list[Element] = []
        self.collecting: list[Element] = []

    def handle_starttag(self, tag, attrs):
        element = Element(tag, {k: v or "" for k, v in attrs})
        self.page.inner.append(element)
        for outer in self.collecting:
            outer.inner.append(element)
        if tag not in _VOID:
            self.open.append(element)
            if any(element.fits(w) for w in self.kept):
                self.collecting.append(element)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if not any(e.tag == tag for e in self.open):
            return
        while True:
            closed = self.open.pop()
            if self.collecting and self.collecting[-1] is closed:
                self.collecting.pop()
            if closed.tag == tag:
                return

    def handle_data(self, data):
        if self.collecting and not (self.open and self.open[-1].tag in _UNREAD):
            for outer in self.collecting:
                outer.texts.append(data)


def read_page(html: str, *kept: Selector) -> Element:
    """All elements of a page; those that fit ``kept`` know their content."""
    reader = _Reader(kept)
    reader.feed(html)
    reader.close()
    return reader.page


def _parsed(html: Column, shape: T.DataType, read) -> Column:
    """``read(html)`` over Arrow batches, for the rows whose html is not null."""

    @F.pandas_udf(shape)
    def parse(batch: pd.Series) -> pd.Series:
        return pd.Series([None if h is None else read(h) for h in batch], dtype=object)

    return parse(html)


# A class or id written with character references may hide a marker.
_ESCAPED_NAME = r"""(?i)\b(class|id)\s*=\s*("[^"]*&|'[^']*&|[^\s"'>]*&)"""


def _having(pages: DataFrame, *wanted: Selector) -> DataFrame:
    """Pages that may hold one of the elements."""
    marked = F.col("html").rlike(_ESCAPED_NAME)
    for selector in wanted:
        marked = F.contains(F.lower("html"), F.lit(selector.marker().lower())) | marked
    return pages.where(marked)


def harvest_links(
    pages: DataFrame, block: Selector = LISTING_BLOCK, distinct: bool = False
) -> DataFrame:
    """The link of the first anchor in each listing block, as ``page_id, pos, link``.

    Blocks whose first anchor has no target are left out. ``distinct`` keeps each
    link once, at no fixed page.
    """
    shape = T.ArrayType(T.StructType().add("pos", T.IntegerType()).add("link", "string"))

    def read(html: str) -> list[dict]:
        anchors = [b.first(Selector("a")) for b in read_page(html, block).every(block)]
        return [
            {"pos": pos, "link": a.attrs["href"]}
            for pos, a in enumerate(anchors)
            if a is not None and a.attrs.get("href")
        ]

    links = _having(pages, block).select(
        "page_id", F.inline(_parsed(F.col("html"), shape, read))
    )
    return links.select("link").distinct() if distinct else links


def product_details(
    pages: DataFrame,
    sections: tuple[Selector, ...] = DETAIL_SECTIONS,
    name: Selector = DETAIL_NAME,
    price: Selector = DETAIL_PRICE,
    code: Selector = DETAIL_CODE,
) -> DataFrame:
    """Name, price and code of the product on each page that has a details section.

    The name is looked for inside the section, price and code on the whole page;
    a missing price or code is the empty string, a missing name is null.
    """
    shape = T.ArrayType(
        T.StructType().add("name", "string").add("price", "string").add("code", "string")
    )

    def content(element: Element | None, otherwise: str | None) -> str | None:
        return otherwise if element is None else element.text()

    def read(html: str) -> list[dict]:
        page = read_page(html, *sections, name, price, code)
        section = page.first(*sections)
        if section is None:
            return []
        record = {
            "name": content(section.first(name), None),
            "price": content(page.first(price), ""),
            "code": content(page.first(code), ""),
        }
        return [record]

    return _having(pages, *sections).select(
        "page_id", "url", F.inline(_parsed(F.col("html"), shape, read))
    )


def store_cards(
    pages: DataFrame,
    heading: Selector = DISTRICT_HEADING,
    card: Selector = STORE_CARD,
    name: Selector = STORE_NAME,
    address: Selector = Selector("div"),
) -> DataFrame:
    """The stores on each page with the district heading that comes before them.

    Python lists the headings of a page and, for each card, how many headings came
    before it. Carrying a heading forward is then a look into the row's own array,
    so pages need no window and are not shuffled. The address is the second
    ``address`` element of a card.
    """
    shape = (
        T.StructType()
        .add("headings", T.ArrayType(T.StringType()))
        .add(
            "cards",
            T.ArrayType(
                T.StructType()
                .add("pos", T.IntegerType())
                .add("seen", T.IntegerType())
                .add("shop_name", "string")
                .add("address", "string")
            ),
        )
    )

    def read(html: str) -> tuple[list[str], list[dict]]:
        headings, cards = [], []
        for element in read_page(html, heading, card, name, address).inner:
            if element.fits(heading):
                headings.append(element.text())
            if element.fits(card):
                named, placed = element.first(name), element.every(address)
                cards.append(
                    {
                        "pos": len(cards),
                        "seen": len(headings),
                        "shop_name": None if named is None else named.text(),
                        "address": placed[1].text() if len(placed) > 1 else None,
                    }
                )
        return headings, cards

    @F.pandas_udf(shape)
    def parse(batch: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([read(h) for h in batch], columns=shape.names)

    events = _having(pages, card).select("page_id", "url", parse("html").alias("e"))
    found = events.select("page_id", "url", "e.headings", F.inline("e.cards"))
    return found.select(
        "page_id",
        "url",
        "pos",
        F.get("headings", F.col("seen") - 1).alias("district"),
        "shop_name",
        "address",
    )
