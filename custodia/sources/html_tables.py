"""Tables in stored HTML pages.

`table_cells` finds, in each page, the heading with a given id and reads the
next sibling table; `extract_tables` picks columns from it. `nav_links` covers markup regular enough for a pattern.
"""

import re
import sys
from html.parser import HTMLParser

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, MapType, StringType, StructField, StructType

from custodia.functions import names as naming
from custodia.functions.names import snake_name

# The parser travels with the function, so that executors need no copy of this package.
for _module in (sys.modules[__name__], naming):
    cloudpickle.register_pickle_by_value(_module)

# Elements without content; they never open a level. Fixed by the HTML standard.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())

# Start tags that end an open cell or row when its own end tag is left out.
_CLOSES = {
    "td": ("td", "th"),
    "th": ("td", "th"),
    "tr": ("td", "th", "tr"),
    "tbody": ("td", "th", "tr", "thead"),
    "tfoot": ("td", "th", "tr", "tbody"),
}


class _AnchoredTable(HTMLParser):
    """Collects the rows of the first table that follows the anchor as its sibling.

    ``rows`` holds, per table row, whether all its cells are headings or it lies
    in the table head, and its cells as (text, columns spanned, rows spanned).
    """

    def __init__(self, anchor_id):
        super().__init__(convert_charrefs=True)
        self.anchor_id = anchor_id
        self.rows = []
        self.done = False
        self._open = []
        self._level = None  # depth at which a sibling of the anchor opens
        self._table = None  # depth of the table itself
        self._cell = None

    def _in_table(self):
        return self._table is not None

    def _own(self):
        """Inside the wanted table, not inside one nested in a cell."""
        return self._in_table() and "table" not in self._open[self._table + 1 :]

    def handle_starttag(self, tag, attrs):
        if self.done:
            return
        attrs = dict(attrs)
        if self._own():
            self._end_implied(tag)
        depth = len(self._open)
        if self._level is None:
            if attrs.get("id") == self.anchor_id:
                self._level = depth
        elif not self._in_table() and depth == self._level and tag == "table":
            self._table = depth
        if self._own():
            if tag == "tr":
                self.rows.append(["thead" in self._open[self._table :], []])
            elif tag in ("td", "th") and self.rows:
                self._cell = []
                spans = [_span(attrs.get(name)) for name in ("colspan", "rowspan")]
                self.rows[-1][1].append([tag, self._cell, *spans])
            elif tag == "br" and self._cell is not None:
                self._cell.append(" ")
        if tag not in _VOID:
            self._open.append(tag)

    def handle_endtag(self, tag):
        if self.done or tag not in self._open:
            return
        while self._open.pop() != tag:
            pass
        depth = len(self._open)
        if self._in_table():
            if depth <= self._table:
                self.done = True
            elif tag in ("td", "th", "tr") and self._own():
                self._cell = None
        elif self._level is not None and depth < self._level:
            self.done = True  # the anchor's parent closed without a table

    def handle_data(self, data):
        if self._cell is not None and not self.done:
            self._cell.append(data)

    def _end_implied(self, tag):
        ended = _CLOSES.get(tag, ())
        while len(self._open) > self._table + 1 and self._open[-1] in ended:
            self._open.pop()
            self._cell = None


def _span(value):
    return int(value) if value and value.isdigit() and int(value) > 0 else 1


def _clean(parts):
    return re.sub(r"[\r\n]+|\s{2,}", " ", "".join(parts)).strip()


def _grid(rows):
    """Rows of (is heading, texts), with spanning cells repeated."""
    pending = {}  # column -> [text, rows still to fill]
    for in_head, cells in rows:
        texts, column, todo = [], 0, list(cells)
        while todo or pending.get(column, (None, 0))[1] > 0:
            if pending.get(column, (None, 0))[1] > 0:
                texts.append(pending[column][0])
                pending[column][1] -= 1
                column += 1
                continue
            _, parts, width, height = todo.pop(0)
            for _ in range(width):
                text = _clean(parts)
                texts.append(text)
                pending[column] = [text, height - 1]
                column += 1
        yield in_head or all(tag == "th" for tag, *_ in cells), texts


def _records(html, anchor_id):
    """(row number, {header in snake case: text}) for each body row; empty cells are null.

    Headers are put into snake case once for a table; of equal ones the last counts.
    """
    parser = _AnchoredTable(anchor_id)
    parser.feed(html)
    parser.close()
    header, number = None, 0
    for is_heading, texts in _grid([row for row in parser.rows if row[1]]):
        if is_heading and number == 0:
            header = header or [snake_name(name) for name in _distinct(texts)]
            continue
        names = header or [str(i) for i in range(len(texts))]
        yield number, {name: text or None for name, text in zip(names, texts)}
        number += 1


def _distinct(names):
    seen, result = {}, []
    for name in names:
        count = seen.get(name, 0)
        seen[name] = count + 1
        result.append(f"{name}.{count}" if count else name)
    return result


_ROW = StructType(
    [StructField("row_number", IntegerType()), StructField("cells", MapType(StringType(), StringType()))]
)


@F.udtf(returnType=_ROW, useArrow=True)
class _ReadTable:
    def eval(self, html: str, anchor_id: str):
        if html is not None:
            yield from _records(html, anchor_id)


def may_have_anchor(html: str, anchor_id: str) -> Column:
    """Whether a page may hold an element with the id; false only where none can.

    The id stands in the page as it is, unless a character reference in an attribute spells it.
    """
    spelled = F.col(html).rlike(r"""(?i)\bid\s*=\s*(?:"[^"]*&|'[^']*&|[^\s"'>]*&)""")
    return F.col(html).contains(anchor_id) | spelled


def table_cells(pages: DataFrame, anchor_id: str) -> DataFrame:
    """Rows of the table after the heading ``anchor_id`` in every page, as text by normalised header.

    The result has the page's columns other than ``html``, ``row_number`` and the
    map ``cells``, whose keys are the headers in order, in snake case. Pages without
    the table give no rows.
    """
    kept = [F.col(name) for name in pages.columns if name != "html"]
    rows = pages.lateralJoin(_ReadTable(F.col("html").outer(), F.lit(anchor_id)))
    return rows.select(*kept, "row_number", "cells")


def cell(name: str) -> Column:
    """A cell by its normalised header; a table without the header fails the query."""
    missing = F.raise_error(F.concat(F.lit(f"no column {name} in the table; it has "), F.to_json(F.map_keys("cells"))))
    return F.when(F.map_contains_key("cells", name), F.col("cells")[name]).otherwise(missing.cast("string"))


def extract_tables(pages: DataFrame, anchor_id: str, columns: dict[str, str]) -> DataFrame:
    """`table_cells` with a column for each of some headers.

    ``columns`` maps table headers to output names. Headers are matched in snake
    case; one that a table lacks fails the query.
    """
    rows = table_cells(pages, anchor_id)
    kept = [name for name in rows.columns if name != "cells"]
    return rows.select(*kept, *[cell(snake_name(head)).alias(name) for head, name in columns.items()])


def nav_links(pages: DataFrame) -> DataFrame:
    """Links of list items: page, position in the page, target and text."""
    item = '<li><a href="([^"]*)">([^<]*)</a></li>'
    # One pass over the page; the parts are taken from the short matches.
    found = F.regexp_extract_all("html", F.lit(item), F.lit(0))
    return pages.select("page_id", F.posexplode(found).alias("position", "item")).select(
        "page_id",
        "position",
        F.regexp_extract("item", item, 1).alias("href"),
        F.regexp_extract("item", item, 2).alias("text"),
    )
