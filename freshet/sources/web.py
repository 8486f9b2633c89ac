"""Links and tables in HTML text."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from html.parser import HTMLParser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: What is no markup of the page: comments, and the contents of scripts, styles and text areas.
_HIDDEN = r"(?is)<!--.*?(?:-->|\z)|<(script|style|textarea|title)\b[^>]*>.*?(?:</\1\s*>|\z)"
#: An anchor up to its first href, quoted in any way; other attributes, such as data-href, come before it as a whole.
_ANCHOR = (
    r"""(?is)<a(?:[\s/]+(?!href[\s=])[^\s=>/"']+(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s>"']+))?)*+"""
    r"""[\s/]+href\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)"""
)
_ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&apos;": "'", "&nbsp;": "\u00a0", "&amp;": "&"}


def _unescaped(col: Column) -> Column:
    """Common entities as their characters."""
    for name, char in _ENTITIES.items():
        col = F.replace(col, F.lit(name), F.lit(char))
    return col


def html_links(
    df: DataFrame,
    html_col: str,
    prefix: str | None = None,
    suffix: str | None = None,
    contains: str | None = None,
) -> DataFrame:
    """One row per matching link of an anchor, in document order.

    Names in any case and values in double, single or no quotes are read; links
    in comments and scripts are none.
    """
    shown = F.regexp_replace(html_col, _HIDDEN, "")
    found = F.regexp_extract_all(shown, F.lit(_ANCHOR), F.lit(1))
    quoted = F.transform(found, lambda v: F.when(v.rlike("^[\"']"), F.substring(v, F.lit(2), F.length(v) - 2)).otherwise(v))
    kept = [c for c in df.columns if c != html_col]
    link = F.col("link")
    df = df.select(*kept, F.posexplode(F.transform(quoted, lambda v: F.trim(_unescaped(v)))).alias("position", "link"))
    if prefix is not None:
        df = df.filter(link.startswith(prefix))
    if suffix is not None:
        df = df.filter(link.endswith(suffix))
    if contains is not None:
        df = df.filter(link.contains(contains))
    return df


def link_status(links: DataFrame, pages: DataFrame, key: str) -> DataFrame:
    """The only matching link of each page, or ``none``/``ambiguous``."""
    found = links.groupBy(key).agg(F.count_distinct("link").alias("n"), F.min("link").alias("link"))
    status = F.when(F.col("n").isNull(), "none").when(F.col("n") == 1, "found").otherwise("ambiguous")
    return (
        pages.select(key)
        .join(found, key, "left")
        .select(key, status.alias("status"), F.when(F.col("n") == 1, F.col("link")).alias("link"))
    )


def html_table_rows(
    df: DataFrame,
    html_col: str,
    names: Sequence[str],
    table_id: str | None = None,
    row_pattern: str = r"(?s)<tr[^>]*>(.*?)</tr>",
    cell_pattern: str = r"(?s)<t[dh][^>]*>(.*?)</t[dh]>",
    header_rows: int = 1,
) -> DataFrame:
    """Cell texts of the table with ``table_id``, heading rows left out.

    The patterns can be set for pages that lay rows out with other elements.
    """
    html = F.col(html_col)
    if table_id is not None:
        html = F.regexp_extract(html, rf'(?s)<table[^>]*id="{table_id}"[^>]*>(.*?)</table>', 1)
    kept = [c for c in df.columns if c != html_col]
    rows = F.posexplode(F.regexp_extract_all(html, F.lit(row_pattern), F.lit(1)))
    cells = F.regexp_extract_all("_row", F.lit(cell_pattern), F.lit(1))
    plain = F.transform(cells, lambda c: F.trim(F.regexp_replace(c, "<[^>]*>", "")))
    return (
        df.select(*kept, rows.alias("row_no", "_row"))
        .filter(F.col("row_no") >= header_rows)
        .withColumn("_cells", plain)
        .select(*kept, "row_no", *[F.get("_cells", F.lit(i)).alias(n) for i, n in enumerate(names)])
    )


#: Elements that part words.
_BREAKS = ("br", "p", "div", "li", "table", "tr", "td", "th")


class _TableParser(HTMLParser):
    """Rows of cell texts of the wanted table; tables inside it only add to the text of their cell."""

    def __init__(self, table_id: str | None):
        super().__init__(convert_charrefs=True)
        self.table_id, self.depth, self.number = table_id, 0, -1
        self.rows: list[tuple[int, int, list[str]]] = []
        self.row: list[str] | None = None
        self.cell: list[str] | None = None
        self.done = False

    def _end_cell(self) -> None:
        if self.cell is not None and self.row is not None:
            self.row.append(" ".join("".join(self.cell).split()))
        self.cell = None

    def _end_row(self) -> None:
        self._end_cell()
        if self.row is not None:
            before = sum(r[0] == self.number for r in self.rows)
            self.rows.append((self.number, before, self.row))
        self.row = None

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if self.done:
            return
        if tag == "table":
            if self.depth:
                self.depth += 1
            elif self.table_id is None or dict(attrs).get("id") == self.table_id:
                self.depth, self.number = 1, self.number + 1
        elif self.depth == 1 and tag == "tr":
            self._end_row()
            self.row = []
        elif self.depth == 1 and tag in ("td", "th"):
            self._end_cell()
            self.row = [] if self.row is None else self.row
            self.cell = []
        elif self.cell is not None and tag in _BREAKS:
            self.cell.append(" ")

    def handle_endtag(self, tag: str) -> None:
        if self.cell is not None and tag in _BREAKS:
            self.cell.append(" ")
        if tag == "table" and self.depth:
            self.depth -= 1
            if not self.depth:
                self._end_row()
                self.done = self.table_id is not None
        elif self.depth == 1 and tag in ("td", "th"):
            self._end_cell()
        elif self.depth == 1 and tag in ("tr", "thead", "tbody", "tfoot"):
            self._end_row()

    def handle_data(self, data: str) -> None:
        if self.cell is not None:
            self.cell.append(data)

    def finished(self, html: str) -> list[tuple[int, int, list[str]]]:
        self.feed(html)
        self.close()
        if self.depth:
            self._end_row()
        return self.rows


class TableRows:
    """Table function: the rows of a page's table with an id, or of all its outermost tables."""

    def eval(self, html: str, table_id: str) -> Iterator[tuple[int, int, list[str]]]:
        yield from _TableParser(table_id).finished(html or "")


def html_tables(df: DataFrame, html_col: str, table_id: str | None = None, header_rows: int = 0) -> DataFrame:
    """One row per table row: the other columns, ``table_no``, ``row_no`` and ``cells``.

    A tokeniser reads the page, so quotes, comments, scripts, entities, omitted end
    tags and nested tables are no matter: a table inside a cell is part of that
    cell's text.  White space in a cell is one blank.  ``table_id`` takes the
    first table with that id.  Null pages and pages without a table give no rows.
    """
    rows = F.udtf(TableRows, returnType="table_no int, row_no int, cells array<string>", useArrow=True)
    kept = [c for c in df.columns if c != html_col]
    found = df.lateralJoin(rows(F.col(html_col).outer(), F.lit(table_id).cast("string")))
    return found.filter(F.col("row_no") >= header_rows).select(*kept, "table_no", "row_no", "cells")
