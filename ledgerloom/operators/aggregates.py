"""Aggregations: shares with gates, gaps, argmax, agreement, calibration, classifier metrics, identities."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.functions.text import percent


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def frequency(df: DataFrame, key: str) -> DataFrame:
    """`key, n, pct` of all rows; null is a value."""
    return count_by(df, key).withColumn("pct", F.round(percent(F.col("n").cast("double"), F.sum("n").over(Window.partitionBy())), 4))


def repeated_keys(df: DataFrame, *keys: str) -> DataFrame:
    return count_by(df, *keys).filter("n > 1")


def share_gate(df: DataFrame, groups: Sequence[str], condition: Column, tolerance: float) -> DataFrame:
    """Share of rows where condition holds by group and overall (one grouping-sets pass), with deviation and verdict.

    `groups..., level, n, share, deviation, outside`; level is `all` for the overall row. Null conditions don't count.
    """
    known = df.select(*groups, condition.alias("_c")).filter("_c is not null")
    g = known.groupingSets([list(groups), []], *groups).agg(F.count("*").alias("n"), F.avg(F.col("_c").cast("double")).alias("share"), F.grouping_id().alias("_g"))
    base = F.max(F.when(F.col("_g") > 0, F.col("share"))).over(Window.partitionBy())
    out = g.withColumn("deviation", 100 * (F.col("share") - base))
    return out.select(*groups, F.when(F.col("_g") > 0, "all").otherwise("group").alias("level"), "n", F.round(100 * F.col("share"), 4).alias("share"), F.round("deviation", 4).alias("deviation"), (F.abs("deviation") > tolerance).alias("outside"))


def rollup_counts(df: DataFrame, levels: Sequence[str], **sums: str) -> DataFrame:
    """Counts and sums at every level of a hierarchy; `depth` is the number of levels given."""
    out = df.rollup(*levels).agg(F.count("*").alias("n"), F.grouping_id().alias("_g"), *[F.sum(c).alias(n) for n, c in sums.items()])
    depth = len(levels) - F.bit_count("_g")
    return out.withColumn("depth", depth.cast("int")).drop("_g")


def sequence_gaps(df: DataFrame, groups: Sequence[str], number: str) -> DataFrame:
    """`groups..., last, missing (array), n_missing, n_repeated` against 1..max of the number; groups without gaps too."""
    g = df.filter(F.col(number) > 0).groupBy(*groups).agg(F.max(number).alias("last"), F.array_sort(F.collect_set(number)).alias("_seen"), F.count(number).alias("_n"))
    missing = F.array_except(F.sequence(F.lit(1).cast("int"), F.col("last").cast("int")), F.transform("_seen", lambda x: x.cast("int")))
    return g.withColumn("missing", missing).select(*groups, "last", "missing", F.size("missing").cast("long").alias("n_missing"), (F.col("_n") - F.size("_seen")).alias("n_repeated"))


def argmax(df: DataFrame, groups: Sequence[str], best: Sequence[Column], take: Sequence[str]) -> DataFrame:
    """The row of each group with the greatest key; keys must end in a unique column. One aggregate, no sort of groups."""
    return df.groupBy(*groups).agg(F.max_by(F.struct(*take), F.struct(*[c.alias(f"k{i}") for i, c in enumerate(best)])).alias("_t")).select(*groups, "_t.*")


def agreement(df: DataFrame, key: Sequence[str], witness: str, value: str) -> DataFrame:
    """Keys with several witnesses, and whether they agree: one value a witness (its greatest)."""
    one = df.groupBy(*key, witness).agg(F.max(value).alias("_v"))
    g = one.groupBy(*key).agg(F.count("*").alias("witnesses"), F.min("_v").alias("_a"), F.max("_v").alias("_b"), F.count("_v").alias("_s"))
    return g.filter("witnesses > 1").select(*key, "witnesses", F.coalesce((F.col("_a") == F.col("_b")) & (F.col("_s") == F.col("witnesses")), F.lit(False)).alias("agree"))


def calibration(df: DataFrame, p: Column, y: Column, edges: Sequence[float] = (0, 0.1, 0.3, 0.5, 0.7, 0.9, 1)) -> DataFrame:
    """Right-closed bins of p, the lowest closed on both sides: `bin, n, mean_p, mean_y`."""
    d = df.select(p.alias("_p"), y.cast("double").alias("_y")).filter("_p is not null and _y is not null")
    at = F.lit(None).cast("int")
    for i in range(len(edges) - 2, -1, -1):
        low = (F.col("_p") >= edges[i]) if i == 0 else (F.col("_p") > edges[i])
        at = F.when(low & (F.col("_p") <= edges[i + 1]), i).otherwise(at)
    return d.groupBy(at.alias("bin")).agg(F.count("*").alias("n"), F.round(F.avg("_p"), 6).alias("mean_p"), F.round(F.avg("_y"), 6).alias("mean_y"))


def classifier_metrics(df: DataFrame, p: Column, y: Column) -> DataFrame:
    """One row: `n, auc, log_loss, brier, accuracy`. The AUC is exact, from average ranks of tied scores.

    Distinct scores are ranked within cells of their logit; the window over all is one of at most 3841 cells.
    """
    d = df.select(p.alias("_p"), y.cast("int").alias("_y")).filter("_p is not null and _y is not null")
    clipped = lambda e: F.least(F.greatest(F.col("_p"), F.lit(e)), F.lit(1 - e))
    q = clipped(1e-6)
    d = d.withColumn("_ll", F.when(F.col("_y") == 1, -F.log(q)).otherwise(-F.log(1 - q))).withColumn("_br", F.pow(F.col("_p") - F.col("_y"), 2)).withColumn("_ok", ((F.col("_p") >= 0.5).cast("int") == F.col("_y")).cast("int"))
    levels = d.groupBy("_p").agg(F.count("*").alias("_c"), F.sum("_y").alias("_pos"), F.sum("_ll").alias("_ll"), F.sum("_br").alias("_br"), F.sum("_ok").alias("_ok"))
    wide = clipped(1e-13)
    levels = levels.withColumn("_cell", F.floor(F.log(wide / (1 - wide)) * 64))
    rank = F.sum("_c").over(Window.partitionBy("_cell").orderBy("_p")) - F.col("_c") + (F.col("_c") + 1) / 2
    cells = levels.withColumn("_rank", rank).groupBy("_cell").agg(F.sum("_c").alias("_c"), F.sum("_pos").alias("_pos"), F.sum(F.col("_pos") * F.col("_rank")).alias("_rs"), *[F.sum(c).alias(c) for c in ("_ll", "_br", "_ok")])
    below = F.sum("_c").over(Window.orderBy("_cell")) - F.col("_c")
    s = cells.withColumn("_below", below).agg(F.sum("_c").alias("n"), F.sum("_pos").alias("np"), F.sum(F.col("_rs") + F.col("_pos") * F.col("_below")).alias("rs"), F.sum("_ll").alias("ll"), F.sum("_br").alias("br"), F.sum("_ok").alias("ok"))
    auc = F.try_divide(F.col("rs") - F.col("np") * (F.col("np") + 1) / 2, F.col("np") * (F.col("n") - F.col("np")))
    return s.select("n", F.round(auc, 4).alias("auc"), F.round(F.col("ll") / F.col("n"), 4).alias("log_loss"), F.round(F.col("br") / F.col("n"), 4).alias("brier"), F.round(F.col("ok") / F.col("n"), 4).alias("accuracy"))


def flag_reconciliation(df: DataFrame, flags: Column, by: Column, values: Sequence[str]) -> DataFrame:
    """`flag, total` and one count for each value of `by`."""
    e = df.select(F.explode(flags).alias("flag"), by.alias("_b"))
    return e.groupBy("flag").agg(F.count("*").alias("total"), *[F.count_if(F.col("_b") == v).alias(v) for v in values])


def unknown_flags(df: DataFrame, flags: Column, known: DataFrame, name: str) -> DataFrame:
    """Flags outside the vocabulary: must be empty."""
    return df.select(F.explode(flags).alias(name)).distinct().join(known, name, "left_anti")


def identity_audit(df: DataFrame, total: str, parts: Sequence[str], tolerance: float = 0.0) -> DataFrame:
    """Rows whose reported total differs from the sum of its parts; rows with a null part are skipped."""
    s = sum((F.col(p) for p in parts[1:]), F.col(parts[0]))
    return df.withColumn("expected", s).filter(F.col("expected").isNotNull() & F.col(total).isNotNull() & (F.abs(F.col(total) - F.col("expected")) > tolerance))


def bad_pages(df: DataFrame, page: Sequence[str], missing: Column, reason: str = "%d of %d rows lack a number") -> DataFrame:
    """Pages on which more than half of the rows lack something, with a formatted reason."""
    g = df.groupBy(*page).agg(F.count_if(missing).alias("miss"), F.count("*").alias("n"))
    return g.filter("2 * miss > n").withColumn("why", F.format_string(reason, "miss", "n"))


def completeness(held: DataFrame, expected: DataFrame, group: Sequence[str], serial: str, size: str) -> DataFrame:
    """Held against expected numbers of a group with first and last serial, gaps inside and what lacks at the ends."""
    h = held.groupBy(*group).agg(F.count("*").alias("held"), F.min(serial).alias("first_serial"), F.max(serial).alias("last_serial"), F.countDistinct(serial).alias("_d"))
    j = expected.select(*group, F.col(size).alias("expected")).join(h, list(group), "left").withColumn("held", F.coalesce("held", F.lit(0)))
    inside = F.greatest(F.col("last_serial") - F.col("first_serial") + 1 - F.col("_d"), F.lit(0))
    j = j.withColumn("shortfall", F.col("expected") - F.col("held")).withColumn("missing_inside", F.coalesce(inside, F.lit(0)))
    j = j.withColumn("missing_at_ends", F.greatest(F.col("shortfall") - F.col("missing_inside"), F.lit(0)))
    return j.withColumn("status", F.when(F.col("shortfall") == 0, "complete").when(F.col("shortfall") > 0, "partial").otherwise("review")).drop("_d")


def cost_rollup(df: DataFrame, status: str, priced: str, reserved: str, cap: float) -> DataFrame:
    """Completed requests at their price, others at what is reserved; whether the sum is within the cap."""
    s = F.sum(F.when(F.col(status) == "completed", F.col(priced)).otherwise(F.col(reserved)))
    return df.agg(s.alias("cost"), (s <= cap).alias("within"))


def mean_where(df: DataFrame, groups: Sequence[str], means: Mapping[str, tuple[Column, Column]]) -> DataFrame:
    """Means of values over the rows where a condition holds: name -> (condition, value)."""
    return df.groupBy(*groups).agg(*[F.avg(F.when(c, v)).alias(n) for n, (c, v) in means.items()])


def top_deviations(df: DataFrame, deviation: str, tie: str, n: int = 5) -> DataFrame:
    return df.orderBy(F.desc(F.abs(F.col(deviation))), tie).limit(n)


def fewer_names(df: DataFrame, groups: Sequence[str], first: str, second: str) -> DataFrame:
    """Which of two readings of a column has fewer distinct values: `above` for the first if strictly fewer, else `below`."""
    g = df.groupBy(*groups).agg(F.countDistinct(first).alias("_a"), F.countDistinct(second).alias("_b"))
    return g.select(*groups, F.when(F.col("_a") < F.col("_b"), "above").otherwise("below").alias("reading"))


def contiguous(df: DataFrame, groups: Sequence[str], number: str) -> DataFrame:
    """Whether the numbers of a group are exactly first..last, each once."""
    g = df.groupBy(*groups).agg(F.min(number).alias("_a"), F.max(number).alias("_b"), F.count("*").alias("_n"), F.countDistinct(number).alias("_d"))
    return g.select(*groups, ((F.col("_n") == F.col("_d")) & (F.col("_n") == F.col("_b") - F.col("_a") + 1)).alias("contiguous"))


def repeat_classes(df: DataFrame, key: Sequence[str], values: Sequence[str], page: str) -> DataFrame:
    """Repeated keys: `key..., n, pages, kind`, identical if all rows have the same values (nulls equal), else conflict.

    `pages` are the distinct pages in order, joined by a semicolon.
    """
    seen = df.groupBy(*key, F.to_json(F.struct(*values), {"ignoreNullFields": "false"}).alias("_v"), F.col(page).alias("_p")).agg(F.count("*").alias("_n"))
    g = seen.groupBy(*key).agg(F.sum("_n").alias("n"), (F.min("_v") == F.max("_v")).alias("_same"), F.array_sort(F.collect_set("_p")).alias("_ps"))
    return g.filter("n > 1").select(*key, "n", F.array_join(F.transform("_ps", lambda p: p.cast("string")), ";").alias("pages"), F.when(F.col("_same"), "identical").otherwise("conflict").alias("kind"))


def printings_agree(df: DataFrame, key: Sequence[str], script: str, label: str, position: str) -> DataFrame:
    """`key..., scripts, agree` of keys printed in several scripts, by the last label of each script."""
    last = df.groupBy(*key, script).agg(F.max_by(label, position).alias("_l"))
    g = last.groupBy(*key).agg(F.count("*").alias("scripts"), F.size(F.collect_set("_l")).alias("_d"), F.count("_l").alias("_s"))
    return g.filter("scripts > 1").select(*key, "scripts", ((F.col("_d") == 1) & (F.col("_s") == F.col("scripts"))).alias("agree"))


def interior_steps(df: DataFrame, groups: Sequence[str], order: str, offset: str) -> DataFrame:
    """`groups..., missing_inside, repeated, steps`: rises and falls of an offset, and their text `before>after` in order."""
    w = Window.partitionBy(*groups).orderBy(order)
    d = df.withColumn("_b", F.lag(offset).over(w)).withColumn("_s", F.col(offset) - F.col("_b"))
    step = F.when(F.col("_s") != 0, F.struct(F.col(order).alias("o"), F.concat_ws(">", F.col("_b").cast("string"), F.col(offset).cast("string")).alias("t")))
    up, down = F.sum(F.greatest("_s", F.lit(0))), F.sum(F.greatest(-F.col("_s"), F.lit(0)))
    steps = F.array_join(F.transform(F.array_sort(F.collect_list(step)), lambda x: x["t"]), ";")
    return d.groupBy(*groups).agg(F.coalesce(up, F.lit(0)).cast("long").alias("missing_inside"), F.coalesce(down, F.lit(0)).cast("long").alias("repeated"), steps.alias("steps"))


def examples(df: DataFrame, groups: Sequence[str], value: str, n: int = 3) -> DataFrame:
    """`groups..., n, examples`: rows of a group and its first n distinct values, joined by a comma; at most n values are gathered."""
    counts = df.groupBy(*groups, value).agg(F.count("*").alias("_n"))
    i = F.row_number().over(Window.partitionBy(*groups).orderBy(F.asc_nulls_last(value)))
    g = counts.withColumn("_i", i).groupBy(*groups).agg(F.sum("_n").alias("n"), F.array_sort(F.collect_list(F.when(F.col("_i") <= n, F.col(value)))).alias("_e"))
    return g.select(*groups, "n", F.array_join(F.transform("_e", lambda x: x.cast("string")), ",").alias("examples"))
