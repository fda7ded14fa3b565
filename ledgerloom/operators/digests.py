"""Tables compared by digests of parts: only parts that differ are read, and a rebuilt table takes the old one's place at once.

A table is written in parts of its key's hash, with a small table of counts and order-free digests beside it. A rebuild is
digested in one aggregate; parts with equal digests are equal (two 64-bit sums over rows), and the others alone are read.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Parts of a table: rows of a part should fit into some tasks.
PARTS = 64


def _part(key: Sequence[str], parts: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(parts)).cast("int")


def part_digests(df: DataFrame, key: Sequence[str], parts: int = PARTS) -> DataFrame:
    """`part, rows, digest` of the parts that have rows; order doesn't matter, repeated rows do.

    Columns are taken by name in order, each with whether it is null, so renamed and moved values tell.
    """
    cells = [c for name in sorted(df.columns) for c in (F.lit(name), F.col(f"`{name}`").isNull(), F.to_json(F.struct(F.col(f"`{name}`").alias("v"))))]
    sums = [F.sum(F.xxhash64(F.lit(seed), *cells).cast("decimal(38,0)")) for seed in (1, 2)]
    return df.groupBy(_part(key, parts).alias("part")).agg(F.count("*").alias("rows"), F.concat_ws("/", *[s.cast("string") for s in sums]).alias("digest"))


def publish(df: DataFrame, path: str, key: Sequence[str], parts: int = PARTS) -> None:
    """Writes df to path with its digests, by way of a folder beside it: readers see the old table or the new one.

    The old table is moved aside before the new one takes its name, and deleted after; what fails before that leaves the old one.
    """
    spark, new = df.sparkSession, f"{path.rstrip('/')}.new-{uuid.uuid4().hex}"
    df.withColumn("_part", _part(key, parts)).repartition("_part").write.partitionBy("_part").parquet(f"{new}/rows")
    rows = spark.read.parquet(f"{new}/rows")
    part_digests(rows.select(*df.columns), key, parts).coalesce(1).write.parquet(f"{new}/digests")
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    fs, aside = hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration()), f"{path.rstrip('/')}.old-{uuid.uuid4().hex}"
    had = fs.exists(hadoop(path))
    if had and not fs.rename(hadoop(path), hadoop(aside)):
        raise OSError(f"{path} can't be moved aside")
    if not fs.rename(hadoop(new), hadoop(path)):
        if had:
            fs.rename(hadoop(aside), hadoop(path))
        raise OSError(f"{new} can't take the place of {path}")
    if had:
        fs.delete(hadoop(aside), True)


def published(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/rows").drop("_part")


def differing_parts(df: DataFrame, path: str, key: Sequence[str], parts: int = PARTS) -> DataFrame:
    """`part, rows, rows_before` of parts whose digests differ from the published ones; reads no published row."""
    was = df.sparkSession.read.parquet(f"{path}/digests").select("part", F.col("rows").alias("rows_before"), F.col("digest").alias("_was"))
    both = part_digests(df, key, parts).join(was, "part", "full")
    return both.filter(~F.col("digest").eqNullSafe(F.col("_was"))).select("part", F.coalesce("rows", F.lit(0)).alias("rows"), F.coalesce("rows_before", F.lit(0)).alias("rows_before"))


def changed_rows(df: DataFrame, path: str, key: Sequence[str], parts: int = PARTS) -> DataFrame:
    """df's columns with `change` (added or removed) and `copies`: the difference as bags of rows, from differing parts alone.

    The driver holds the numbers of differing parts, `parts` at most.
    """
    bad = [r["part"] for r in differing_parts(df, path, key, parts).select("part").collect()]
    old = df.sparkSession.read.parquet(f"{path}/rows").filter(F.col("_part").isin(bad)).select(*df.columns, F.lit(-1).alias("_d"))
    new = df.filter(_part(key, parts).isin(bad)).select(*df.columns, F.lit(1).alias("_d"))
    bags = new.unionAll(old).groupBy(*df.columns).agg(F.sum("_d").alias("_n")).filter("_n <> 0")
    return bags.select(*df.columns, F.when(F.col("_n") > 0, "added").otherwise("removed").alias("change"), F.abs("_n").alias("copies"))
