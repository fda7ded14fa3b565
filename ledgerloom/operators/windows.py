"""Ordered state in windows: carry-forward, counters, islands, units, serials, shuffles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .state import written


def ordered(by: Sequence[str], order: Sequence[str]):
    return Window.partitionBy(*by).orderBy(*order)


def carry_forward(df: DataFrame, by: Sequence[str], order: Sequence[str], value: str, name: str) -> DataFrame:
    """The last value that isn't null, at or before each row."""
    return df.withColumn(name, F.last(value, ignorenulls=True).over(ordered(by, order).rowsBetween(Window.unboundedPreceding, 0)))


def islands(df: DataFrame, by: Sequence[str], order: Sequence[str], opens: Column, name: str, start: int = 0) -> DataFrame:
    """Numbers the runs that begin where `opens` holds (null: doesn't); rows before the first have start."""
    w = ordered(by, order)
    return df.withColumn("_opens", F.coalesce(opens, F.lit(False)).cast("int")).withColumn(name, F.sum("_opens").over(w.rowsBetween(Window.unboundedPreceding, 0)) + start).drop("_opens")


def restarts(df: DataFrame, by: Sequence[str], order: Sequence[str], serial: str, name: str) -> DataFrame:
    """Counts restarts: a serial at or below the last one. Rows without a serial keep the count."""
    w = ordered(by, order)
    before = F.last(serial, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return islands(df.withColumn("_before", before), by, order, F.col(serial) <= F.col("_before"), name).drop("_before")


def units(df: DataFrame, by: Sequence[str], order: Sequence[str], tier: str, ward: str, page: str, name: str, head: str = "head") -> DataFrame:
    """Numbers units from 0: a head opens one, so does ward 1 after a ward, and the first row of a page that doesn't follow.

    A ward row follows a head if it is 1, and a ward row if it is one more. Leading rows that open nothing are in -1.
    """
    w = ordered(by, order)
    first = F.lag(page).over(w).isNull() & (F.row_number().over(w) == 1)
    d = df.withColumn("_pt", F.lag(tier).over(w)).withColumn("_pw", F.lag(ward).over(w)).withColumn("_first", first).withColumn("_start", first | ~F.col(page).eqNullSafe(F.lag(page).over(w)))
    is_head, was_head, was_ward = F.col(tier) == head, F.col("_pt") == head, F.col("_pt").isNotNull() & (F.col("_pt") != head)
    follows = F.coalesce((was_head & (F.col(ward) == 1)) | (was_ward & (F.col(ward) == F.col("_pw") + 1)), F.lit(False))
    opens = is_head | (~is_head & F.col("_start") & ~F.col("_first") & ~follows) | F.coalesce((F.col(ward) == 1) & was_ward, F.lit(False))
    return islands(d, by, order, opens, name, -1).drop("_pt", "_pw", "_first", "_start")


def office_step(previous: Column, current: Column, first: str = "Sarpanch") -> Column:
    """Whether a printed office follows another: ward 1 after the first office, else one more."""
    p, c = previous.try_cast("int"), current.try_cast("int")
    return F.coalesce(F.when(previous == first, c == 1).otherwise(c == p + 1), F.lit(False))


def complete_names(df: DataFrame, by: Sequence[str], island: str, name: str, out: str, order: str) -> DataFrame:
    """Names that begin the longest name of their island (by words, first among equals) take that name."""
    words = F.split(F.trim(name), r"\s+")
    w = Window.partitionBy(*by, island)
    longest = F.max_by(F.struct(F.col(name).alias("n"), words.alias("w")), F.struct(F.size(words), -F.col(order))).over(w)
    d = df.withColumn("_long", longest)
    begins = F.slice("_long.w", 1, F.size(words)) == words
    return d.withColumn(out, F.when(begins, F.col("_long.n")).otherwise(F.col(name))).drop("_long")


def number_within(df: DataFrame, by: Sequence[str], order: Sequence[str | Column], name: str) -> DataFrame:
    """df with `name`, 1 and up in order within each value of by (nulls are equal), however many rows a value has.

    Rows are dealt by ranges of (by, order) and written once; a range numbers its own rows, and the ranges of a value are
    placed by their counts, one row a range and value. Rows that are equal in order may swap numbers.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(n, *by, *order).sortWithinPartitions(*by, *order)
    rows = written(dealt.withColumn("_nw_range", F.spark_partition_id()).withColumn("_nw_pos", F.monotonically_increasing_id()))
    own = [f"_nw_b{i}" for i, _ in enumerate(by)]
    counts = rows.groupBy(F.col("_nw_range").alias("_nw_of"), *[F.col(b).alias(o) for b, o in zip(by, own, strict=True)]).agg(F.count("*").alias("_nw_n"), F.min("_nw_pos").alias("_nw_start"))
    counts = counts.withColumn("_nw_before", F.sum("_nw_n").over(Window.partitionBy(*own).orderBy("_nw_of")) - F.col("_nw_n"))
    same = F.col("_nw_range") == F.col("_nw_of")
    for b, o in zip(by, own, strict=True):
        same = same & F.col(b).eqNullSafe(F.col(o))
    return rows.join(counts, same).select(*df.columns, (F.col("_nw_before") + F.col("_nw_pos") - F.col("_nw_start") + 1).alias(name))


def appearance_serial(df: DataFrame, by: Sequence[str], key: str, position: str) -> DataFrame:
    """`by..., key, serial` by order of first appearance; groups of any size."""
    first = df.groupBy(*by, key).agg(F.min(position).alias("_p"))
    return number_within(first, by, ["_p", key], "serial").drop("_p")


def mark_repeats(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Whether a key occurs more than once; nulls are equal. Keys are counted before the join, so a hot one can be split."""
    own = [f"_mr_k{i}" for i, _ in enumerate(keys)]
    counts = df.groupBy(*[F.col(k).alias(o) for k, o in zip(keys, own, strict=True)]).agg((F.count("*") > 1).alias(name))
    same = [F.col(k).eqNullSafe(F.col(o)) for k, o in zip(keys, own, strict=True)]
    return df.join(counts, same).select(*df.columns, name)


def first_of(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return df.withColumn("_i", F.row_number().over(ordered(keys, order))).filter("_i = 1").drop("_i")


def neighbours(df: DataFrame, by: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """Adjacent pairs: `by..., value, next_<value>`, without the last row."""
    return df.withColumn(f"next_{value}", F.lead(value).over(ordered(by, order))).withColumn("_l", F.lead(F.lit(1)).over(ordered(by, order))).filter("_l = 1").drop("_l")


def carry_within_pages(df: DataFrame, by: Sequence[str], order: Sequence[str], page: str, value: str, name: str, ends: Column | None = None) -> DataFrame:
    """Carries a value forward, but not across a page that is not the next one, nor past a row where `ends` holds."""
    w = ordered(by, order)
    gap = F.coalesce((F.col(page) != F.lag(page).over(w)) & (F.col(page) != F.lag(page).over(w) + 1), F.lit(False))
    stop = gap if ends is None else gap | F.coalesce(ends, F.lit(False))
    d = islands(df.withColumn("_stop", stop), by, order, F.col("_stop"), "_island")
    return carry_forward(d, [*by, "_island"], order, value, name).drop("_stop", "_island")


def monotone(df: DataFrame, by: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """`by..., monotone`: whether the value never falls."""
    d = df.withColumn("_back", F.col(value) < F.lag(value).over(ordered(by, order)))
    return d.groupBy(*by).agg((~F.coalesce(F.bool_or("_back"), F.lit(False))).alias("monotone"))


def shuffled_within(df: DataFrame, by: Sequence[str], order: Sequence[str], value: str, name: str, seed: int = 1) -> DataFrame:
    """A column with the group's values in a hashed order: a chance baseline that is the same in every run."""
    a = number_within(df, by, order, "_i")
    keyed = df.select(*by, F.col(value).alias(name), F.xxhash64(*order, F.lit(seed)).alias("_h"), *[F.col(o).alias(f"_o{i}") for i, o in enumerate(order)])
    b = number_within(keyed, by, ["_h", *[f"_o{i}" for i, _ in enumerate(order)]], "_i").select(*by, name, "_i")
    return a.join(b, [*by, "_i"]).drop("_i")


def merge_stranded(df: DataFrame, by: Sequence[str], order: Sequence[str], number: str, kept: Sequence[str], body: Sequence[str]) -> DataFrame:
    """A row with a number but nothing in `body` goes, and lends number and `kept` to the next row if that lacks a number."""
    w = ordered(by, order)
    bare = F.col(number).isNotNull()
    for c in body:
        bare = bare & (F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) == "")
    d = df.withColumn("_bare", bare).withColumn("_lent", F.lag(F.when(F.col("_bare"), F.struct(number, *kept))).over(w)).withColumn("_next_lacks", F.lead(F.col(number).isNull() & ~F.col("_bare")).over(w))
    take = F.col(number).isNull() & ~F.col("_bare") & F.col("_lent").isNotNull()
    new = {c: F.when(take, F.coalesce(F.col(f"_lent.{c}"), F.col(c))).otherwise(F.col(c)) for c in (number, *kept)}
    gone = F.col("_bare") & F.coalesce("_next_lacks", F.lit(False))
    return d.select(*[new.get(c, F.col(c)).alias(c) for c in df.columns], gone.alias("_gone")).filter("not _gone").drop("_gone")


def join_tails(df: DataFrame, by: Sequence[str], order: Sequence[str], is_seat: Column, text: str) -> DataFrame:
    """Texts of rows that aren't seats are appended, in order, to the seat row before them; rows before the first seat go."""
    d = islands(df.withColumn("_seat", is_seat), by, order, F.col("_seat"), "_island").filter("_island > 0")
    w = Window.partitionBy(*by, "_island").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    whole = F.concat_ws(" ", F.collect_list(text).over(w))
    return d.withColumn("_whole", whole).filter("_seat").withColumn(text, F.col("_whole")).drop("_seat", "_island", "_whole")


def unread_headings(df: DataFrame, by: Sequence[str], order: Sequence[str], heading: str, fallbacks: Sequence[str], name: str) -> DataFrame:
    """`name` and `<name>_basis`: a heading equal to the raw one before it (or blank) is unread, and the first fallback that is there counts."""
    before = F.lag(heading).over(ordered(by, order))
    read = (F.trim(F.coalesce(heading, F.lit(""))) != "") & ~F.coalesce(F.col(heading) == before, F.lit(False))
    value, basis = F.when(read, F.col(heading)), F.when(read, F.lit("heading"))
    for f in fallbacks:
        value, basis = F.coalesce(value, F.col(f)), F.when(basis.isNotNull(), basis).when(F.col(f).isNotNull(), F.lit(f))
    return df.withColumn("_v", value).withColumn("_b", F.coalesce(basis, F.lit("unread"))).withColumnsRenamed({"_v": name, "_b": f"{name}_basis"})


def share_within(df: DataFrame, by: Sequence[str], condition: Column, name: str) -> DataFrame:
    """The share of a group's rows where a condition holds (null: doesn't), on every row."""
    return df.withColumn(name, F.avg(F.coalesce(condition, F.lit(False)).cast("double")).over(Window.partitionBy(*by)))


def numeric_order(*columns: str) -> list[Column]:
    """Sort keys that take texts for whole numbers, others for 0."""
    return [F.coalesce(F.expr(f"try_cast(`{c}` AS bigint)"), F.lit(0)) for c in columns]


def distinct_in_order(df: DataFrame, by: Sequence[str], key: str, position: str) -> DataFrame:
    """`by..., key, position`: distinct keys at their first position."""
    return df.groupBy(*by, key).agg(F.min(position).alias(position))


def page_candidates(df: DataFrame, by: Sequence[str], page: str, order: Sequence[str], value: str, name: str) -> DataFrame:
    """The last value of the page before as a candidate of its own column, if that page is adjacent; value itself is left alone."""
    last = df.groupBy(*by, page).agg(F.max_by(value, F.when(F.col(value).isNotNull(), F.struct(*order))).alias(name))
    return df.join(last.withColumn(page, F.col(page) + 1), [*by, page], "left")
