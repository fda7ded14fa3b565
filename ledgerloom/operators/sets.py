"""Set operations and table comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(*frames: DataFrame) -> DataFrame:
    """By name; columns that a frame lacks are null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def key_differences(a: DataFrame, b: DataFrame, *keys: str) -> DataFrame:
    """`keys..., side` of distinct keys: both, left_only, right_only."""
    x = a.select(*keys).withColumn("_s", F.lit(1)).unionAll(b.select(*keys).withColumn("_s", F.lit(2)))
    return x.groupBy(*keys).agg(F.bit_or("_s").alias("_b")).select(*keys, F.when(F.col("_b") == 3, "both").when(F.col("_b") == 1, "left_only").otherwise("right_only").alias("side"))


def differing(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows whose number of copies differs, with both numbers: one shuffle instead of two exceptAll."""
    cols = a.columns
    x = a.select(*cols, F.lit(1).alias("_a"), F.lit(0).alias("_b")).unionAll(b.select(*cols, F.lit(0).alias("_a"), F.lit(1).alias("_b")))
    return x.groupBy(*cols).agg(F.sum("_a").alias("copies_a"), F.sum("_b").alias("copies_b")).filter("copies_a <> copies_b")


def changed_columns(a: DataFrame, b: DataFrame, key: Sequence[str]) -> DataFrame:
    """`column, changed` over keys in both tables, nulls being equal to nulls."""
    rest = [c for c in a.columns if c not in key]
    j = a.select(*key, F.struct(*rest).alias("_x")).join(b.select(*key, F.struct(*rest).alias("_y")), list(key))
    counts = j.agg(*[F.count_if(~F.col(f"_x.{c}").eqNullSafe(F.col(f"_y.{c}"))).alias(c) for c in rest])
    return counts.unpivot([], rest, "column", "changed")


def split_three(df: DataFrame, disposition: str, names: Sequence[str]) -> list[DataFrame]:
    return [df.filter(F.col(disposition) == n) for n in names]


def conserved(df: DataFrame, disposition: str) -> DataFrame:
    """Rows of each part and of the whole."""
    return df.groupBy(disposition).agg(F.count("*").alias("n")).unionAll(df.agg(F.lit("total").alias(disposition), F.count("*").alias("n")))


def lacking(part: DataFrame, whole: DataFrame, *keys: str) -> DataFrame:
    """Distinct keys of part that whole lacks: empty if part is a subset (nulls are equal)."""
    return key_differences(part, whole, *keys).filter("side = 'left_only'").drop("side")


def overridden(key: str, value: str, *sources: DataFrame) -> DataFrame:
    """`key, value, source` of all keys; a later source (from 0) overrides earlier ones where it has a value."""
    parts = [s.select(key, value, F.lit(i).alias("source")) for i, s in enumerate(sources)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    last = F.max_by(F.struct(value, "source"), F.when(F.col(value).isNotNull(), F.col("source")).otherwise(-1))
    return out.groupBy(key).agg(last.alias("_t")).select(key, f"_t.{value}", F.when(F.col(f"_t.{value}").isNotNull(), F.col("_t.source")).alias("source"))


def keep_origins(fresh: DataFrame, previous: DataFrame, key: str, origin: str) -> DataFrame:
    """A fresh inventory, with the origin of the previous one where that isn't blank."""
    old = previous.groupBy(key).agg(F.max(F.nullif(F.trim(origin), F.lit(""))).alias("_o"))
    return fresh.join(old, key, "left").withColumn(origin, F.coalesce("_o", origin)).drop("_o")
