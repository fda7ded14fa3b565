"""HTML scans: tables, list items, links. Regular expressions where markup is flat, a tokenizer where it nests."""

from __future__ import annotations

from html import unescape
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def inner_text(c: Column) -> Column:
    """Without tags, white space squashed."""
    return F.trim(F.regexp_replace(F.regexp_replace(c, "<[^>]*>", " "), r"\s+", " "))


def table_rows(df: DataFrame, html: str, keep: list[str]) -> DataFrame:
    """`keep..., row, cells` of flat tables."""
    rows = df.select(*keep, F.posexplode(F.regexp_extract_all(html, F.lit(r"(?si)<tr[^>]*>(.*?)</tr>"), 1)).alias("row", "_tr"))
    return rows.select(*keep, "row", F.transform(F.regexp_extract_all("_tr", F.lit(r"(?si)<t[dh][^>]*>(.*?)</t[dh]>"), 1), inner_text).alias("cells"))


def list_items(df: DataFrame, html: str, keep: list[str]) -> DataFrame:
    """`keep..., item, text` of <li> elements."""
    return df.select(*keep, F.posexplode(F.regexp_extract_all(html, F.lit(r"(?si)<li[^>]*>(.*?)</li>"), 1)).alias("item", "_li")).select(*keep, "item", inner_text(F.col("_li")).alias("text"))


def flat_links(df: DataFrame, html: str, keep: list[str]) -> DataFrame:
    """`keep..., place, href` of anchors."""
    return df.select(*keep, F.posexplode(F.regexp_extract_all(html, F.lit(r'(?i)<a href="([^"]*)"'), 1)).alias("place", "href"))


class _Tables(HTMLParser):
    """Cells of outer tables with depth; markup that isn't closed is an error."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows, self.depth, self.cell = [], 0, None

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.depth += 1
        elif self.depth == 1 and tag == "tr":
            self.rows.append([])
        elif self.depth == 1 and tag in ("td", "th"):
            if self.cell is not None or not self.rows:
                raise ValueError("a cell within a cell, or outside a row")
            self.cell = []

    def handle_endtag(self, tag):
        if tag == "table":
            self.depth -= 1
        elif self.depth == 1 and tag in ("td", "th") and self.cell is not None:
            self.rows[-1].append(" ".join("".join(self.cell).split()))
            self.cell = None

    def handle_data(self, data):
        if self.cell is not None:
            self.cell.append(data)


@F.pandas_udf(T.ArrayType(T.ArrayType(T.StringType())))
def nested_tables(html: pd.Series) -> pd.Series:
    """Rows of cells by a tokenizer that follows nesting and rejects unclosed tables and cells."""

    def rows(text):
        reader = _Tables()
        reader.feed(text or "")
        if reader.depth or reader.cell is not None:
            raise ValueError("markup ends within a table")
        return reader.rows

    return html.map(rows)


class _Links(HTMLParser):
    def __init__(self, base):
        super().__init__(convert_charrefs=True)
        self.base, self.found, self.heading, self.inside, self.text = base, [], "", None, []

    def handle_starttag(self, tag, attrs):
        if tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
            self.inside, self.text = "heading", []
        elif tag == "a" and dict(attrs).get("href"):
            self.inside, self.text, self.href = "link", [], urljoin(self.base, unescape(dict(attrs)["href"]))

    def handle_endtag(self, tag):
        text = " ".join("".join(self.text).split())
        if self.inside == "heading" and tag[:1] == "h":
            self.heading, self.inside = text, None
        elif self.inside == "link" and tag == "a":
            if self.href.startswith(("http://", "https://")):
                self.found.append((self.href, text, self.heading))
            self.inside = None

    def handle_data(self, data):
        if self.inside:
            self.text.append(data)


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in ("url", "label", "heading")])))
def links(html: pd.Series, base: pd.Series) -> pd.Series:
    """Absolute http links with their label and the nearest heading before them."""

    def scan(text, url):
        reader = _Links(url or "")
        reader.feed(text or "")
        return [dict(zip(("url", "label", "heading"), f, strict=True)) for f in reader.found]

    return pd.Series([scan(t, u) for t, u in zip(html, base, strict=True)])
