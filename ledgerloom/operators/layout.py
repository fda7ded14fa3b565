"""Tables printed as fixed-width text: lines to rows by a state machine of levels, as windows over the lines of a file.

A heading opens a group, an item belongs to the group that is open, a total closes it, a grand total stands for all. A row is
a line that ends in exactly as many numbers as there are metrics; letters alone right after an item go on with its label.
Lines that fit nowhere are held with a reason, none is lost.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.sources.markup import squashed


@dataclass(frozen=True)
class Layout:
    """Patterns of a printed table, for whole trimmed lines (heading, skip, grand, more) or parts of them (number, serial)."""

    metrics: Sequence[str]
    heading: str
    skip: str = r"$^"
    total: str = r"(?i)TOTAL"
    grand: str = r"(?i).*\bGRAND\b.*"
    more: str = r"[A-Za-z][A-Za-z -]*"
    number: str = r"-+|\d+(?:\.\d+)?"
    serial: str = r"^\s*(\d+)[.)]?\s+"
    decimals: Sequence[str] = ()


def open_levels(rows: DataFrame, file: str, order: Sequence[str], level: str, value: str, levels: int) -> DataFrame:
    """rows with `open_1` to `open_<levels>`: the value of the last row of each level that is open at a row, itself included.

    level: 1 is the outermost; null rows open and close nothing. A row closes all deeper levels and its own. All windows
    share one sort of a file's rows.
    """
    w = Window.partitionBy(file).orderBy(*order)
    rows = rows.withColumn("_i", F.row_number().over(w))
    at = lambda cond: F.coalesce(F.last(F.when(cond, F.col("_i")), ignorenulls=True).over(w), F.lit(0))
    for k in range(1, levels + 1):
        own = F.last(F.when(F.col(level) == k, F.col(value)), ignorenulls=True).over(w)
        rows = rows.withColumn(f"open_{k}", F.when(at(F.col(level) == k) > at(F.col(level) < k), own))
    return rows.drop("_i")


def _cells(pieces: Column, n: Column, layout: Layout) -> Column:
    """The last pieces of a line as cells: raw, value, why a value is withheld, and columns from 1 (the end is behind it)."""
    first = F.size(pieces) - n

    def cell(name: str, k: int) -> Column:
        j = first + k
        piece, upto = F.get(pieces, j), F.aggregate(F.slice(pieces, 1, j + 1), F.lit(0), lambda s, p: s + F.char_length(p))
        raw = F.trim(F.regexp_replace(piece, r"\s+", ""))
        hold = F.when(raw.rlike(r"^-+$"), "dash").when(raw.rlike(r"^0[0-9]"), "leading_zero").when(raw.contains(".") & F.lit(name not in layout.decimals), "decimal_in_count")
        value = F.when(hold.isNull(), raw.try_cast("double"))
        return F.struct(F.lit(name).alias("metric"), raw.alias("raw"), value.alias("value"), hold.alias("hold"), (upto - F.char_length(raw) + 1).alias("start"), (upto + 1).alias("end"))

    return F.array(*[cell(m, k) for k, m in enumerate(layout.metrics)])


def _lines(texts: DataFrame, file: str, text: str, layout: Layout) -> DataFrame:
    """Non-blank lines of files with page and line from 1, what kind each is, and its group, row and pending state."""
    pages = texts.select(F.col(file).alias("file"), F.posexplode(F.split(F.coalesce(F.col(text), F.lit("")), "\f", -1)).alias("page", "_page"))
    lines = pages.select("file", (F.col("page") + 1).alias("page"), F.posexplode(F.split("_page", "\r?\n", -1)).alias("line", "raw")).withColumn("line", F.col("line") + 1)
    lines = lines.withColumn("_s", F.trim("raw")).filter("_s <> ''")
    pieces = F.regexp_extract_all("raw", F.lit(r"(\s*\S+)"), 1)
    lines = lines.withColumn("_pieces", pieces).withColumn("_numbers", F.transform("_pieces", lambda p: F.trim(p).rlike(f"^(?:{layout.number})$")))
    run = F.array_position(F.reverse("_numbers"), False)
    lines = lines.withColumn("_n", F.when(run == 0, F.size("_pieces")).otherwise(run - 1).cast("int"))
    full = lambda p: F.regexp_like("_s", F.lit(f"^(?:{p})$"))
    kind = F.when(full(layout.skip), "skip").when(full(layout.heading), "heading").when(F.col("_n") == len(layout.metrics), "row").when(full(layout.grand), "grand").when((F.col("_n") == 0) & full(layout.more), "more").otherwise("other")
    lines = lines.withColumn("kind", kind)
    w = Window.partitionBy("file").orderBy("page", "line")
    lines = lines.withColumn("_started", F.coalesce(F.max(F.col("kind") == "heading").over(w), F.lit(False)))
    lines = lines.withColumn("heading", F.last(F.when(F.col("kind") == "heading", F.col("_s")), ignorenulls=True).over(w))
    lines = lines.withColumn("_grand", F.coalesce(F.max(F.col("kind") == "grand").over(w), F.lit(False)))
    prefix = F.array_join(F.slice("_pieces", 1, F.size("_pieces") - F.col("_n")), "")
    lines = lines.withColumn("serial", F.regexp_extract(F.concat(prefix, F.lit(" ")), layout.serial, 1).try_cast("int")).withColumn("label", F.trim(F.regexp_replace(F.concat(prefix, F.lit(" ")), layout.serial, "")))
    whole = F.col("_grand") | F.regexp_like("label", F.lit(layout.grand))
    level = F.when(whole, "all").when(F.regexp_like("label", F.lit(f"^(?:{layout.total})$")), "group").when(F.col("serial").isNotNull(), "item")
    lines = lines.withColumn("level", F.when((F.col("kind") == "row") & F.col("_started"), level))
    page = Window.partitionBy("file", "page").orderBy("line")
    last = F.last(F.when(F.col("kind") != "more", F.struct("page", "line", "level")), ignorenulls=True).over(page)
    return lines.withColumn("_last", last).withColumn("_goes_on", F.coalesce((F.col("kind") == "more") & (F.col("_last.level") == "item") & ~F.col("_grand"), F.lit(False)))


def layout_rows(texts: DataFrame, file: str, text: str, layout: Layout) -> DataFrame:
    """`file, page, line, level, heading, serial, label, cells, flags, lines` of all rows: level is item, group or all.

    cells hold metric, raw, value, hold and columns; flags name withheld values; lines are the row's own lines. Null and empty
    texts have no rows. A heading is null for the level all.
    """
    lines = _lines(texts, file, text, layout)
    rows = lines.filter("level is not null").withColumn("cells", _cells(F.col("_pieces"), F.lit(len(layout.metrics)), layout))
    more = lines.filter("_goes_on").groupBy(F.col("file").alias("_f"), F.col("page").alias("_p"), F.col("_last.line").alias("_l")).agg(F.sort_array(F.collect_list(F.struct("line", "_s"))).alias("_more"))
    met = rows.join(more, F.col("file").eqNullSafe(F.col("_f")) & (F.col("page") == F.col("_p")) & (F.col("line") == F.col("_l")), "left")
    added = F.coalesce(F.col("_more"), F.array().cast("array<struct<line:int,_s:string>>"))
    label = squashed(F.array_join(F.concat(F.array("label"), F.transform(added, lambda m: m["_s"])), " "))
    flags = F.transform(F.filter("cells", lambda c: c["hold"].isNotNull()), lambda c: F.concat(c["metric"], F.lit(":"), c["hold"]))
    return met.select("file", "page", "line", "level", F.when(F.col("level") != "all", F.col("heading")).alias("heading"), "serial", label.alias("label"), "cells", flags.alias("flags"), F.concat(F.array("line"), F.transform(added, lambda m: m["line"])).alias("lines"))


def layout_holds(texts: DataFrame, file: str, text: str, layout: Layout) -> DataFrame:
    """`file, page, line, raw, reason` of body lines that are no row, heading, label or known header."""
    lines = _lines(texts, file, text, layout)
    reason = F.when((F.col("kind") == "row") & F.col("level").isNull(), "unresolved_row_level").when((F.col("kind") == "other") | (F.col("kind") == "more") & ~F.col("_goes_on") & ~F.col("_grand"), "unparsed_body_line")
    return lines.filter("_started").withColumn("reason", reason).filter("reason is not null").select("file", "page", "line", "raw", "reason")
