"""Security-list page scan (S6): HTML pages -> listing rows.

Pages are parsed on executors with ``mapInPandas`` (one Arrow batch of pages
at a time) and the standard-library HTML parser: the second <table> holds the
listing, its first row the header (<td> texts); rows whose cell count differs
from the header are dropped; cell text is stripped.
"""

from __future__ import annotations

import sys
from html.parser import HTMLParser

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame

# workers need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

OUT_SCHEMA = "page_id bigint, url string, row_no int, header array<string>, cells array<string>"


class _Tables(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tables: list[list[list[str]]] = []
        self._stack: list[list[list[str]]] = []
        self._row: list[str] | None = None
        self._cell: list[str] | None = None

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            t: list[list[str]] = []
            self.tables.append(t)
            self._stack.append(t)
        elif tag == "tr" and self._stack:
            self._row = []
            self._stack[-1].append(self._row)
        elif tag == "td" and self._row is not None:
            self._cell = []

    def handle_endtag(self, tag):
        if tag == "td" and self._cell is not None and self._row is not None:
            self._row.append("".join(s.strip() for s in self._cell))
            self._cell = None
        elif tag == "tr":
            self._row = None
        elif tag == "table" and self._stack:
            self._stack.pop()

    def handle_data(self, data):
        if self._cell is not None:
            self._cell.append(data)


def parse_listing(html: str, table_index: int = 1) -> list[list[str]] | None:
    """Header + equal-length rows of the ``table_index``-th table; None when absent."""
    p = _Tables()
    p.feed(html or "")
    p.close()
    if len(p.tables) <= table_index or not p.tables[table_index]:
        return None
    rows = p.tables[table_index]
    header = rows[0]
    return [header] + [r for r in rows[1:] if len(r) == len(header)]


def _scan(batches):
    for pdf in batches:
        out = {"page_id": [], "url": [], "row_no": [], "header": [], "cells": []}
        for pid, url, html in zip(pdf["page_id"], pdf["url"], pdf["html"]):
            rows = parse_listing(html)
            if rows is None:
                continue
            for i, r in enumerate(rows[1:], 1):
                out["page_id"].append(pid)
                out["url"].append(url)
                out["row_no"].append(i)
                out["header"].append(rows[0])
                out["cells"].append(r)
        if out["page_id"]:
            yield pd.DataFrame(out)


def scan_listing_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, html) -> one row per listing row: (page_id, url, row_no,
    header, cells); pages without a second table yield nothing."""
    return pages.select("page_id", "url", "html").mapInPandas(_scan, OUT_SCHEMA)
