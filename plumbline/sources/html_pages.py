"""Text, links, fields and tables out of HTML pages, one distributed pass per question.

Pages are not well-formed XML and hold end tags inside scripts, so neither regular
expressions nor Spark's XPath functions read them right. A page is parsed on its own by the
standard library's tokenizer inside a Pandas UDF; only the HTML column travels to Python.
"""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Iterator, Sequence
from html.parser import HTMLParser

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The page helpers travel inside the function, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Elements without content, and elements whose text is not page text.
VOID = frozenset({
    "area", "base", "br", "col", "embed", "hr", "img", "input", "keygen", "link", "menuitem",
    "meta", "param", "source", "track", "wbr", "basefont", "bgsound", "command", "frame", "image",
    "isindex", "nextid", "spacer",
})
HIDDEN = frozenset({"script", "style", "template"})
PRESERVED = frozenset({"pre", "textarea"})
# Elements whose start ends an open paragraph, and those that shield one outside.
ENDS_PARAGRAPH = frozenset({
    "address", "article", "aside", "blockquote", "center", "details", "dialog", "dir", "div", "dl",
    "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6",
    "header", "hgroup", "hr", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "ul",
})
SHIELDS = frozenset({"button", "caption", "marquee", "object", "table", "td", "template", "th"})
ASCII_BLANKS = " \n\t\f\r"

ERROR_TEXT = "Error retrieving article text."


class _Element:
    __slots__ = ("tag", "attrs", "start", "end")

    def __init__(self, tag: str, attrs: dict, start: tuple[int, int]) -> None:
        self.tag, self.attrs, self.start, self.end = tag, attrs, start, start

    @property
    def at(self) -> int:
        """Its own place in the page's list of elements."""
        return self.start[0] - 1

    @property
    def span(self) -> range:
        """The places of the elements inside it."""
        return range(self.start[0], self.end[0])

    def is_a(self, tag: str, cls: str | None) -> bool:
        return self.tag == tag and (not cls or cls in (self.attrs.get("class") or "").split())


class Page(HTMLParser):
    """Elements in document order, each with the span of text pieces it holds.

    An end tag closes the nearest open element of its name and all inside it; an end tag
    without one is ignored; a paragraph ends where a block starts; what stays open ends with the
    page.
    """

    def __init__(self, html: str) -> None:
        super().__init__(convert_charrefs=True)
        self.elements: list[_Element] = []
        self.pieces: list[str] = []
        self._open: list[_Element] = []
        self._depth: Counter[str] = Counter()
        self.feed(html)
        self.close()
        for e in self._open:
            e.end = (len(self.elements), len(self.pieces))

    def _end_paragraph(self) -> None:
        """End the open paragraph, unless something that shields it was opened inside it."""
        if self._depth["p"] and not self._inside(SHIELDS):
            self.handle_endtag("p")
        elif self._depth["p"]:
            for e in reversed(self._open):
                if e.tag == "p":
                    self.handle_endtag("p")
                    return
                if e.tag in SHIELDS:
                    return

    def handle_starttag(self, tag, attrs):
        if tag in ENDS_PARAGRAPH:
            self._end_paragraph()
        e = _Element(tag, dict(attrs), (len(self.elements) + 1, len(self.pieces)))
        self.elements.append(e)
        if tag in VOID:
            e.end = e.start
            return
        self._open.append(e)
        self._depth[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if not self._depth[tag]:
            return
        while True:
            e = self._open.pop()
            e.end = (len(self.elements), len(self.pieces))
            self._depth[e.tag] -= 1
            if e.tag == tag:
                return

    def _inside(self, tags: frozenset[str]) -> bool:
        return any(self._depth[t] for t in tags)

    def handle_data(self, data):
        if self._inside(HIDDEN):
            return
        if not data.strip(ASCII_BLANKS) and not self._inside(PRESERVED):
            data = "\n" if "\n" in data else " "  # blanks between elements shrink to one
        self.pieces.append(data)

    def text(self, e: _Element) -> str:
        return "".join(self.pieces[e.start[1]:e.end[1]])

    def find_all(self, tag: str, cls: str | None = None, inside: _Element | None = None):
        span = self.elements[inside.start[0]:inside.end[0]] if inside else self.elements
        return [e for e in span if e.is_a(tag, cls)]

    def find(self, tag: str, cls: str | None = None, inside: _Element | None = None):
        return next(iter(self.find_all(tag, cls, inside)), None)


def _spread(df: DataFrame) -> DataFrame:
    """The pages dealt over the shuffle partitions before they are parsed.

    Parsing costs by the page, not by the byte read: a table of short rows comes as a few large
    splits, which would leave all pages to a few tasks while the other cores wait.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _per_page(html: Column, return_type: str, ask) -> Column:
    """Ask every parsed page one question; a missing page gives null."""

    @F.pandas_udf(return_type)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages in batches:
            yield pd.Series([None if h is None else ask(h) for h in pages], dtype=object)

    return run(html)


def html_paragraphs(df: DataFrame, html: str, keep: Sequence[str], out: str = "text") -> DataFrame:
    """Text of all paragraphs, joined with a blank; a fixed error text where there is no page.

    A paragraph without an end tag ends where the next one starts, so no text counts twice.
    """
    def ask(h: str) -> str:
        page = Page(h)
        return " ".join(page.text(p) for p in page.find_all("p"))

    text = F.coalesce(_per_page(F.col(html), "string", ask), F.lit(ERROR_TEXT))
    return _spread(df).select(*keep, text.alias(out))


def html_main_text(
    df: DataFrame, html: str, keep: Sequence[str], tag: str = "article", cls: str | None = None
) -> DataFrame:
    """Text of the first container and of its first heading; nulls where it is absent."""
    def ask(h: str) -> list[str | None]:
        page = Page(h)
        box = page.find(tag, cls)
        head = page.find("h1", inside=box) if box else None
        return [page.text(box) if box else None, page.text(head) if head else None]

    got = _spread(df).select(*keep, _per_page(F.col(html), "array<string>", ask).alias("_g"))
    return got.select(*keep, F.get("_g", F.lit(0)).alias("main_text"),
                      F.get("_g", F.lit(1)).alias("heading"))


def html_next_link(
    df: DataFrame, html: str, keep: Sequence[str], tag: str = "nav", cls: str | None = None
) -> DataFrame:
    """Target of the first link inside the first container; null where there is none."""
    def ask(h: str) -> str | None:
        page = Page(h)
        box = page.find(tag, cls)
        link = page.find("a", inside=box) if box else None
        return link.attrs.get("href") if link else None

    return _spread(df).select(*keep, _per_page(F.col(html), "string", ask).alias("next_link"))


def html_class_fields(
    df: DataFrame,
    html: str,
    keep: Sequence[str],
    tag: str,
    cls: str | None,
    fields: Sequence[tuple[str, str, str | None]],
) -> DataFrame:
    """One row per element of a class, with the text of named elements inside it.

    ``fields`` holds (column name, tag, class). Rows are numbered per page from 1.
    """
    def ask(h: str) -> list[list[str | None]]:
        page = Page(h)
        rows = []
        for box in page.find_all(tag, cls):
            found = [page.find(t, c, inside=box) for _, t, c in fields]
            rows.append([page.text(e) if e else None for e in found])
        return rows

    got = _per_page(F.col(html), "array<array<string>>", ask)
    rows = _spread(df).select(*keep, F.posexplode(got).alias("_p", "_r"))
    return rows.select(*keep, (F.col("_p") + 1).alias("row_no"),
                       *[F.get("_r", F.lit(i)).alias(f[0]) for i, f in enumerate(fields)])


def html_tables(df: DataFrame, html: str, keep: Sequence[str], index: int) -> DataFrame:
    """Rows of the index-th table of each page: (keep, row_no, header array, cells array).

    The first row is the header. A page with fewer tables gives no rows. Cells of a table
    nested inside another belong to the inner table only.
    """
    def ask(h: str) -> list[list[str]]:
        page = Page(h)
        tables = page.find_all("table")
        if index >= len(tables):
            return []
        table = tables[index]
        inner = [t.span for t in page.find_all("table", inside=table)]
        own = lambda e: not any(e.at in t for t in inner)
        return [
            [page.text(c).strip() for c in page.elements[tr.start[0]:tr.end[0]]
             if c.tag in ("td", "th") and own(c)]
            for tr in page.find_all("tr", inside=table) if own(tr)
        ]

    got = _spread(df).select(
        *keep, _per_page(F.col(html), "array<array<string>>", ask).alias("_t"))
    return got.select(
        *keep, F.get("_t", F.lit(0)).alias("header"),
        F.posexplode(F.slice("_t", 2, F.greatest(F.size("_t") - 1, F.lit(0))))
        .alias("_p", "cells"),
    ).select(*keep, (F.col("_p") + 1).alias("row_no"), "header", "cells")


def table_columns(rows: DataFrame, names: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Cells by header name as columns; a page without a column gives null there."""
    return rows.select(*keep, "row_no", *[
        F.get("cells", F.array_position("header", n).cast("int") - 1).alias(n) for n in names
    ])
