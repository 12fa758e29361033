"""Tables inside HTML pages."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS_SCHEMA = "page_id bigint, table_no int, row_no int, is_header boolean, cells array<string>, error string"

# The bounds of the HTML standard for spans.
MOST_COLUMNS = 1000
MOST_ROWS = 65534


class _Found(Exception):
    """The first table is complete."""


class _TableReader(HTMLParser):
    """Collect the rows of the outermost tables of one page."""

    def __init__(self, first_only: bool) -> None:
        super().__init__(convert_charrefs=True)
        self.first_only = first_only
        self.tables: list[list[tuple[bool, list[str]]]] = []
        self.depth = 0
        self.in_head = False
        self.mute = 0
        self.cell: list[str] | None = None
        self.cell_tag = ""
        self.cell_span = (1, 1)
        self.row: list[tuple[str, str, int, int]] | None = None
        self.carried: dict[int, tuple[int, str]] = {}

    @staticmethod
    def _span(attrs: dict, name: str, most: int) -> int:
        """A span within its bounds; 0 rows are all that follow, other odd values are 1."""
        text = (attrs.get(name) or "").strip()
        if not (text.isascii() and text.isdecimal()):
            return 1
        # Longer numbers are above any bound.
        span = most if len(text) > 9 else min(int(text), most)
        return span or (most if name == "rowspan" else 1)

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style"):
            self.mute += 1
        if tag == "table":
            self.depth += 1
            if self.depth == 1:
                self.tables.append([])
                self.carried = {}
                self.in_head = False
        if self.depth != 1:
            return
        if tag == "thead":
            self.in_head = True
        elif tag in ("tbody", "tfoot"):
            self._end_row()
            self.in_head = False
        elif tag == "tr":
            self._end_row()
            self.row = []
        elif tag in ("td", "th"):
            self._end_cell()
            if self.row is None:
                self.row = []
            found = dict(attrs)
            self.cell, self.cell_tag = [], tag
            self.cell_span = (
                self._span(found, "colspan", MOST_COLUMNS),
                self._span(found, "rowspan", MOST_ROWS),
            )
        elif tag == "br" and self.cell is not None:
            self.cell.append(" ")

    def handle_endtag(self, tag):
        if tag in ("script", "style"):
            self.mute = max(self.mute - 1, 0)
        if self.depth == 1:
            if tag in ("td", "th"):
                self._end_cell()
            elif tag in ("tr", "table", "tbody", "thead", "tfoot"):
                self._end_row()
                if tag == "thead":
                    self.in_head = False
        if tag == "table" and self.depth:
            self.depth -= 1
            if self.depth == 0:
                self._end_table()

    def handle_data(self, data):
        if self.cell is not None and not self.mute:
            self.cell.append(data)

    def _end_table(self):
        if not any(text for _, cells in self.tables[-1] for text in cells):
            self.tables.pop()
        elif self.first_only:
            raise _Found

    def _end_cell(self):
        if self.cell is not None and self.row is not None:
            text = " ".join("".join(self.cell).split())
            self.row.append((self.cell_tag, text, *self.cell_span))
        self.cell = None

    def _end_row(self):
        self._end_cell()
        if self.row:
            header = self.in_head or all(tag == "th" for tag, *_ in self.row)
            self.tables[-1].append((header, self._spread(self.row)))
        self.row = None

    def _spread(self, row) -> list[str]:
        """Repeat cells over their column and row spans."""
        out: list[str] = []
        carried, self.carried = self.carried, {}

        def take_carried():
            while len(out) in carried:
                left, text = carried[len(out)]
                if left > 1:
                    self.carried[len(out)] = (left - 1, text)
                out.append(text)

        for _, text, columns, rows in row:
            take_carried()
            for _ in range(columns):
                if rows > 1:
                    self.carried[len(out)] = (rows - 1, text)
                out.append(text)
        take_carried()
        return out


def _read_tables(html: str, first_only: bool) -> list[list[tuple[bool, list[str]]]]:
    """The outermost tables that hold any text; a table left open ends with its page."""
    reader = _TableReader(first_only)
    try:
        reader.feed(html)
        reader.close()
        if reader.depth >= 1:
            reader.depth = 1
            reader._end_row()
            reader._end_table()
    except _Found:
        pass
    return reader.tables


def table_rows(pages: DataFrame, page_id: str = "page_id", html: str = "html", first_only: bool = True) -> DataFrame:
    """Rows of the first table with text (or of all such outermost tables) of each page.

    Only the two named columns reach Python; pages without a table give no row. A page that
    cannot be read gives one row with its ``error``, which is NULL otherwise.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for page, text in zip(batch["page_id"], batch["html"]):
                try:
                    tables = _read_tables(text, first_only) if text else []
                except (ValueError, AssertionError, RecursionError) as reason:
                    found.append((page, None, None, None, None, f"{type(reason).__name__}: {reason}"))
                    continue
                for table_no, rows in enumerate(tables):
                    for row_no, (header, cells) in enumerate(rows):
                        found.append((page, table_no, row_no, header, cells, None))
            out = pd.DataFrame(found, columns=["page_id", "table_no", "row_no", "is_header", "cells", "error"])
            yield out.astype({"table_no": "Int32", "row_no": "Int32", "is_header": "boolean"})

    # A page with no tag of the kind cannot hold a table, so it stays out of Python.
    narrow = pages.where(F.lower(html).contains("<table")).select(
        F.col(page_id).cast("bigint").alias("page_id"), F.col(html).alias("html")
    )
    return narrow.mapInPandas(read, ROWS_SCHEMA)


def positional(rows: DataFrame, names: Sequence[str], keep: Sequence[str] = ("page_id", "row_no")) -> DataFrame:
    """Body rows with their cells named by position; a missing cell is NULL."""
    cells = [F.get("cells", F.lit(i)).alias(name) for i, name in enumerate(names)]
    return rows.where(~F.col("is_header")).select(*keep, *cells)
