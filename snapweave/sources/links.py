"""Links to data files in HTML pages."""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator, Mapping, Sequence
from html.parser import HTMLParser

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# executors need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_COMMENT = r"(?s)<!--.*?-->"
_HREF = (
    r"(?is)<a(?=\s)(?:[^>\"']|\"[^\"]*\"|'[^']*')*?\shref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))"
)


def _plain(text: Column) -> Column:
    """Text without tags, with entities resolved and spaces trimmed."""
    bare = F.regexp_replace(text, r"(?s)<[^>]*>", "")
    for entity, sign in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        bare = F.replace(bare, F.lit(entity), F.lit(sign))
    return F.regexp_replace(bare, r"^\s+|\s+$", "")


def hrefs(html: Column) -> Column:
    """All link targets of an HTML text, in order; comments are left out."""
    anchors = F.regexp_extract_all(F.regexp_replace(html, _COMMENT, ""), F.lit(_HREF), F.lit(0))
    return F.transform(
        anchors,
        lambda a: _plain(
            F.concat(*[F.regexp_extract(a, _HREF, group) for group in (1, 2, 3)])
        ),
    )


def extract_links(pages: DataFrame, html: str = "html", link: str = "link") -> DataFrame:
    """One row per link of each page."""
    return pages.withColumn(link, F.explode(hrefs(F.col(html)))).drop(html)


class _Rows(HTMLParser):
    """Rows of the first table of a class: the text and the link targets of each cell.

    What lies in a table within a cell belongs to that cell.
    """

    def __init__(self, table_class: str):
        super().__init__(convert_charrefs=True)
        self.rows: list[list[tuple[str, list[str]]]] = []
        self._class, self._depth, self._done = table_class, 0, False
        self._cell: tuple[list[str], list[str]] | None = None

    def _end_cell(self) -> None:
        if self._cell is not None:
            text, targets = self._cell
            self.rows[-1].append(("".join(text).strip(), targets))
            self._cell = None

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        values = dict(reversed(attrs))
        if tag == "table" and (self._depth or not self._done and self._class in (values.get("class") or "").split()):
            self._depth += 1
        elif self._depth == 1 and tag == "tr":
            self._end_cell()
            self.rows.append([])
        elif self._depth == 1 and tag in ("td", "th"):
            self._end_cell()
            if tag == "td" and self.rows:
                self._cell = [], []
        if self._depth and tag == "a" and self._cell is not None and values.get("href") is not None:
            self._cell[1].append(values["href"].strip())

    def handle_endtag(self, tag: str) -> None:
        if self._depth == 1 and tag in ("td", "th", "tr", "table"):
            self._end_cell()
        if tag == "table" and self._depth:
            self._depth -= 1
            self._done = self._depth == 0

    def handle_data(self, data: str) -> None:
        if self._cell is not None:
            self._cell[0].append(data)


def table_rows(html: str, table_class: str) -> list[tuple[int, str, list[str]]]:
    """``(number, title, links)`` of the rows with three cells of which the first is a number."""
    parser = _Rows(table_class)
    parser.feed(html)
    parser.close()
    return [
        (int(row[0][0]), row[1][0], row[2][1])
        for row in parser.rows
        if len(row) == 3 and re.fullmatch(r"[0-9]{1,9}", row[0][0])
    ]


def dataset_links(
    pages: DataFrame,
    expected: Mapping[int, str],
    html: str = "html",
    link: str = "link",
    table_class: str = "border_table",
    rows: Sequence[int] | None = None,
) -> DataFrame:
    """Links in certain numbered rows of a page's description table.

    The first table of the given class is read; its rows have three cells, of which the first is
    the row's number and the second its title.  Unless each number of ``expected`` carries the
    expected title, the page gives nothing.  Otherwise the links in the third cells of ``rows``
    (by default all expected ones) follow each other.  Only pages that mention the class are parsed.
    """
    listed = list(rows or expected)

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def targets(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            found = []
            for text in batch:
                by_number = {number: (title, links) for number, title, links in table_rows(text or "", table_class)}
                fits = all(by_number.get(n, ("",))[0] == title for n, title in expected.items())
                found.append([t for n in listed for t in by_number.get(n, ("", []))[1]] if fits else [])
            yield pd.Series(found, dtype=object)

    mentioned = pages.filter(F.contains(F.col(html), F.lit(table_class)))
    return mentioned.withColumn(link, F.explode(targets(F.col(html)))).drop(html)
