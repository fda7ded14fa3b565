"""Markup as rows of tokens with places and depths: tables that nest, links under headings, both as columns.

Tokens come from one pattern that covers the whole text, so their places are running sums of lengths; depth is a running sum of
opened and closed tables. Everything after that is windows over the tokens of one page, and character references
are the only thing that Python sees.
"""

from __future__ import annotations

import html
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

#: Comments, scripts and styles as a whole; tags, whose quoted values may hold `>`; text; a lone `<`.
_TOKEN = r"""(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>|</?[a-z](?:[^>"']++|"[^"]*+"|'[^']*+')*+>|<[!?][^>]*+>|[^<]++|<"""
_ATTRIBUTE = r"""([a-zA-Z_:][-a-zA-Z0-9_:.]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+))?"""


@F.pandas_udf(T.StringType())
def unescaped(s: pd.Series) -> pd.Series:
    """Character references as characters."""
    return s.map(lambda x: html.unescape(x) if x and "&" in x else x)


def squashed(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"(?U)[\s ]+", " "))


def tokens(df: DataFrame, markup: str, keep: Sequence[str]) -> DataFrame:
    """`keep..., _page, i, at, kind, name, raw`: kind is open, close, text or other; at is the token's place in the text.

    Null markup has no tokens. A page is a row of df, also among rows that repeat.
    """
    pages = df.select(*keep, F.monotonically_increasing_id().alias("_page"), F.regexp_extract_all(F.coalesce(F.col(markup), F.lit("")), F.lit(_TOKEN), 0).alias("_tokens"))
    rows = pages.select(*keep, "_page", F.posexplode("_tokens").alias("i", "raw"))
    whole = F.lower(F.substring("raw", 1, 8))
    kind = F.when(whole.rlike("^<(!|\\?|script\\b|style\\b)"), "other").when(F.col("raw").rlike("^</[a-zA-Z]"), "close").when(F.col("raw").rlike("^<[a-zA-Z]"), "open").otherwise("text")
    before = F.sum(F.char_length("raw")).over(Window.partitionBy("_page").orderBy("i")) - F.char_length("raw")
    rows = rows.withColumn("kind", kind).withColumn("at", before)
    return rows.select(*keep, "_page", "i", "at", "kind", F.when(F.col("kind").isin("open", "close"), F.lower(F.regexp_extract("raw", "^</?([a-zA-Z][a-zA-Z0-9:-]*)", 1))).alias("name"), "raw")


def attributes(tag: Column) -> Column:
    """A tag's attributes as a map of texts, names in small letters; the last of repeated names counts, one without a value has ''."""
    inside = F.regexp_replace(tag, "^<[a-zA-Z][^\\s>/]*|/?>$", "")
    names = F.transform(F.regexp_extract_all(inside, F.lit(_ATTRIBUTE), 1), F.lower)
    values = F.transform(F.regexp_extract_all(inside, F.lit(_ATTRIBUTE), 2), lambda v: F.regexp_replace(F.coalesce(v, F.lit("")), "^[\"']|[\"']$", ""))
    kept = F.array_distinct(names)
    place = lambda n: F.size(names) - F.array_position(F.reverse(names), n)
    return F.map_from_arrays(kept, F.transform(kept, lambda n: F.get(values, place(n).cast("int"))))


def table_cells(df: DataFrame, markup: str, keep: Sequence[str], strict: bool = True) -> DataFrame:
    """`keep..., table, depth, row, column, tag, attrs, text`: cells of all tables, inner ones too.

    Tables are numbered from 1 as they open on the page, rows and columns from 0 within their table and row. A cell's text is
    its own, without inner tables'; <br> is a space; white space is squashed. strict: a page whose tables, rows or cells aren't closed,
    or lie outside what should hold them, is an error; else it gives what can be read, see `table_problems`.
    """
    t = _placed(df, markup, keep)
    if strict:
        bad = _problem(t)
        t = t.withColumn("_bad", F.max(bad).over(Window.partitionBy("_page")))
        t = t.withColumn("name", F.when(F.col("_bad").isNotNull(), F.raise_error(F.concat(F.lit("markup: "), F.col("_bad"))).cast("string")).otherwise(F.col("name")))
    inside = t.filter("cell is not null and in_cell")
    cells = inside.groupBy(*keep, "_page", "table", "depth", "row", "cell").agg(
        F.max(F.when(F.col("starts"), F.struct("name", "raw"))).alias("_tag"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.when(F.col("kind") == "text", F.struct("i", F.col("raw").alias("x"))).when(F.col("name") == "br", F.struct("i", F.lit(" ").alias("x"))))), lambda p: p["x"]), "").alias("_text"),
    )
    return cells.select(*keep, "table", "depth", (F.col("row") - 1).alias("row"), (F.col("cell") - 1).alias("column"), F.col("_tag.name").alias("tag"), attributes(F.col("_tag.raw")).alias("attrs"), squashed(unescaped("_text")).alias("text"))


def table_problems(df: DataFrame, markup: str, keep: Sequence[str]) -> DataFrame:
    """`keep..., problem` of pages whose tables aren't well-formed; the greatest by name where there are several."""
    t = _placed(df, markup, keep)
    return t.groupBy(*keep, "_page").agg(F.max(_problem(t)).alias("problem")).filter("problem is not null").drop("_page")


def _placed(df: DataFrame, markup: str, keep: Sequence[str]) -> DataFrame:
    """Tokens with depth, table, row and cell numbers, whether they lie in a cell, and counts of what is open."""
    t = tokens(df, markup, keep)
    page = Window.partitionBy("_page").orderBy("i")
    opens, closes = (lambda n: F.coalesce((F.col("kind") == "open") & (F.col("name") == n), F.lit(False))), (lambda n: F.coalesce((F.col("kind") == "close") & (F.col("name") == n), F.lit(False)))
    count = lambda c, w: F.sum(c.cast("int")).over(w)
    closed = closes("table")
    t = t.withColumn("depth", count(opens("table"), page) - count(closed, page) + closed.cast("int"))
    t = t.withColumn("_table", count(opens("table"), page))
    level = Window.partitionBy("_page", "depth").orderBy("i")
    t = t.withColumn("table", F.last(F.when(opens("table"), F.col("_table")), ignorenulls=True).over(level))
    own = Window.partitionBy("_page", "depth", "table").orderBy("i")
    starts = opens("td") | opens("th")
    t = t.withColumn("row", count(opens("tr"), own))
    row = Window.partitionBy("_page", "depth", "table", "row").orderBy("i")
    ends = closes("td") | closes("th")
    t = t.withColumn("starts", starts & (F.col("depth") > 0)).withColumn("cell", F.when((F.col("depth") > 0) & (F.col("row") > 0), count(starts, row)))
    t = t.withColumn("in_cell", F.coalesce(F.last(F.when(starts, True).when(ends | closes("tr"), False), ignorenulls=True).over(row), F.lit(False)))
    t = t.withColumn("_cells_open", count(starts, row) - count(ends, row)).withColumn("_rows_open", count(opens("tr"), own) - count(closes("tr"), own))
    tail = Window.partitionBy("_page")
    t = t.withColumn("_left", F.sum(opens("table").cast("int") - closed.cast("int")).over(tail))
    return t.withColumn("_rows_left", F.sum(opens("tr").cast("int") - closes("tr").cast("int")).over(tail)).withColumn("_cells_left", F.sum(starts.cast("int") - ends.cast("int")).over(tail))


def _problem(t: DataFrame) -> Column:
    d, starts = F.col("depth"), F.col("starts")
    loose = F.coalesce((F.col("kind") == "open") & F.col("name").isin("td", "th") & ((d <= 0) | F.col("cell").isNull()), F.lit(False))
    return (
        F.when(F.coalesce((F.col("kind") == "close") & (F.col("name") == "table") & (d <= 0), F.lit(False)), "a table closed that isn't open")
        .when(loose, "a cell outside a row")
        .when(starts & (F.col("_cells_open") > 1), "a cell within a cell")
        .when(F.coalesce((F.col("kind") == "open") & (F.col("name") == "tr") & (F.col("_rows_open") > 1), F.lit(False)), "a row within a row")
        .when(F.col("_left") != 0, "tables not closed")
        .when(F.col("_rows_left") != 0, "rows not closed")
        .when(F.col("_cells_left") != 0, "cells not closed")
    )


def joined_url(base: Column, href: Column) -> Column:
    """The address that a reference means on a page of another address; dot segments are resolved."""
    scheme, host = F.regexp_extract(base, "^([a-zA-Z][a-zA-Z0-9+.-]*:)", 1), F.regexp_extract(base, "^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/?#]*)", 1)
    path = F.regexp_extract(base, "^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)
    query = F.regexp_extract(base, "^[^?#]*(\\?[^#]*)", 1)
    own, rest = F.regexp_extract(href, "^([^?#]*)", 1), F.regexp_replace(href, "^[^?#]*", "")
    merged = F.when(F.startswith(own, F.lit("/")), own).otherwise(F.concat(F.when(path == "", "/").otherwise(F.regexp_extract(path, "^(.*/)", 1)), own))
    parts = F.split(merged, "/", -1)
    n = F.size(parts)
    kept = F.aggregate(F.slice(parts, 2, F.greatest(F.lit(1), n)), F.array().cast("array<string>"), lambda acc, p: F.when(p == "..", F.slice(acc, 1, F.greatest(F.lit(0), F.size(acc) - 1))).when(p == ".", acc).otherwise(F.concat(acc, F.array(p))))
    kept = F.when(F.element_at(parts, -1).isin(".", ".."), F.concat(kept, F.array(F.lit("")))).otherwise(kept)
    resolved = F.concat(F.lit("/"), F.array_join(kept, "/"))
    same = F.concat(scheme, host, path, F.when(own != "", F.lit("")).when(F.startswith(rest, F.lit("?")), F.lit("")).otherwise(query), rest)
    return F.when(href.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*:"), href).when(F.startswith(href, F.lit("//")), F.concat(scheme, href)).when(own == "", same).otherwise(F.concat(scheme, host, resolved, rest))


def region_links(df: DataFrame, markup: str, base: str, keep: Sequence[str], start: str = "h1", stop: str = "footer", headings: Sequence[str] = ("h1", "h2", "h3")) -> DataFrame:
    """`keep..., at, href, url, label, heading` of links between a tag that starts the region and one that stops it.

    A heading or link ends at its own end tag; one that another begins in before that isn't read. heading is the last one read
    before the link. References to places of the page (`#`) and addresses other than http and https are left out.
    """
    t = tokens(df.select(*keep, F.col(markup).alias("_markup"), F.col(base).alias("_base")), "_markup", [*keep, "_base"])
    page = Window.partitionBy("_page").orderBy("i")
    opened = F.col("kind") == "open"
    t = t.withColumn("_on", F.coalesce(F.last(F.when(opened & (F.col("name") == start), True).when(opened & (F.col("name") == stop), False), ignorenulls=True).over(page), F.lit(False)))
    begins = F.coalesce(F.col("_on") & opened & F.col("name").isin("a", *headings), F.lit(False))
    t = t.withColumn("_read", F.sum(begins.cast("int")).over(page)).withColumn("_begins", begins)
    own = Window.partitionBy("_page", "_read").orderBy("i")
    t = t.filter("_read > 0").withColumn("_of", F.first(F.when(F.col("_begins"), F.col("name")), ignorenulls=True).over(own))
    t = t.withColumn("_ended", F.coalesce(F.max(((F.col("kind") == "close") & (F.col("name") == F.col("_of"))).cast("int")).over(own), F.lit(0)))
    text = F.when((F.col("kind") == "text") & (F.col("_ended") == 0) & F.col("_on"), F.struct("i", "raw"))
    read = t.groupBy(*keep, "_base", "_page", "_read", "_of").agg(
        F.max("_ended").alias("_whole"),
        F.min("at").alias("at"),
        F.max(F.when(F.col("_begins"), F.col("raw"))).alias("_tag"),
        F.array_join(F.transform(F.sort_array(F.collect_list(text)), lambda p: p["raw"]), " ").alias("_text"),
    )
    read = read.filter("_whole = 1").withColumn("label", squashed(unescaped("_text"))).withColumn("href", unescaped(attributes(F.col("_tag"))["href"]))
    order = Window.partitionBy("_page").orderBy("_read").rowsBetween(Window.unboundedPreceding, -1)
    read = read.withColumn("heading", F.coalesce(F.last(F.when(F.col("_of") != "a", F.col("label")), ignorenulls=True).over(order), F.lit("")))
    links = read.filter((F.col("_of") == "a") & (F.coalesce(F.col("href"), F.lit("")) != "") & ~F.startswith("href", F.lit("#"))).withColumn("url", joined_url(F.col("_base"), F.col("href")))
    return links.filter(F.col("url").rlike("(?i)^https?:")).select(*keep, "at", "href", "url", "label", "heading")


def listing(df: DataFrame, markup: str, base: str, keep: Sequence[str], suffix: str = ".pdf") -> DataFrame:
    """`keep..., row, name, cells, href, url` of listed files: table rows with a link that ends in suffix (any case).

    name is the first cell that isn't a number or blank; a row with several such links gives one record each. Rows of inner tables
    belong to the row around them.
    """
    rows = df.select(*keep, F.col(base).alias("_base"), F.posexplode(F.regexp_extract_all(F.coalesce(F.col(markup), F.lit("")), F.lit(r"(?is)<tr\b.*?</tr\s*>"), 0)).alias("row", "_row"))
    texts = F.transform(F.regexp_extract_all("_row", F.lit(r"(?is)<t[dh]\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>(.*?)(?=</?t[dhr]\b)"), 1), lambda c: squashed(F.regexp_replace(c, r"(?s)<[^>]*>", " ")))
    hrefs = F.transform(F.regexp_extract_all("_row", F.lit(r"(?is)<a\b[^>]*?\bhref\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)"), 1), lambda h: F.regexp_replace(h, "^[\"']|[\"']$", ""))
    rows = rows.withColumn("_cells", texts).withColumn("_href", F.explode(F.filter(hrefs, lambda h: F.endswith(F.lower(h), F.lit(suffix.lower())))))
    rows = rows.withColumn("cells", F.split(unescaped(F.array_join("_cells", "\x1f")), "\x1f", -1)).withColumn("href", unescaped("_href"))
    name = F.get(F.filter("cells", lambda c: ~F.regexp_like(c, F.lit(r"^[\d.,()\s-]*$"))), 0)
    return rows.select(*keep, "row", name.alias("name"), "cells", "href", joined_url(F.col("_base"), F.col("href")).alias("url"))
