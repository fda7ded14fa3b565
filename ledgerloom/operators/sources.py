"""Sources that several listings name: identical content once, with a reviewed choice where listings disagree; slugs; scores by place."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.functions.text import slug


def canonical_sources(df: DataFrame, digest: str, identity: Sequence[str], order: str, reviews: DataFrame | None = None, on: Sequence[str] = ()) -> DataFrame:
    """df with `canonical` (the `order` of the listing that stands for its content), `is_canonical` and `problem`.

    Listings of one content and one identity: the first in order stands for them. Of several identities, the one
    listing that a review (`digest` and the columns `on`) names. problem: needs a review, or the review names no listing
    or several. order has to be unique. Only counts and firsts are gathered, no members.
    """
    d = df.withColumn("_id", F.to_json(F.struct(*identity), {"ignoreNullFields": "false"}))
    own = d.groupBy(digest).agg(F.min(order).alias("_first"), F.min("_id").alias("_a"), F.max("_id").alias("_b"))
    if reviews is None:
        named = own.select(digest, F.lit(0).cast("long").alias("_named"), F.lit(None).cast(d.schema[order].dataType).alias("_choice"), F.lit(False).alias("_reviewed")).limit(0)
    else:
        r = reviews.select(digest, *[F.col(c).alias(f"_r_{c}") for c in on])
        same = F.lit(True)
        for c in on:
            same = same & F.col(c).eqNullSafe(F.col(f"_r_{c}"))
        named = r.join(d.select(digest, order, *on), digest, "left").groupBy(digest).agg(F.count_if(same).alias("_named"), F.min(F.when(same, F.col(order))).alias("_choice"), F.lit(True).alias("_reviewed"))
    several = F.col("_a") != F.col("_b")
    problem = F.when(several & F.col("_reviewed").isNull(), "needs a review").when(several & (F.col("_named") != 1), "review names no single listing")
    met = d.join(own, digest).join(named, digest, "left").withColumn("problem", problem)
    canonical = F.when(F.col("problem").isNull(), F.when(several, F.col("_choice")).otherwise(F.col("_first")))
    return met.withColumn("canonical", canonical).select(*df.columns, "canonical", (F.col(order) == F.col("canonical")).alias("is_canonical"), "problem")


def unique_slugs(df: DataFrame, name: str, order: str) -> DataFrame:
    """df with `slug`: repeated slugs get `_2`, `_3`, ... in order.

    Only names whose slug repeats are numbered; one slug's rows are put in order by one task.
    """
    d = df.withColumn("_s", slug(F.col(name)))
    k = F.row_number().over(Window.partitionBy("_s").orderBy(order))
    return d.withColumn("slug", F.when(k == 1, F.col("_s")).otherwise(F.concat("_s", F.lit("_"), k))).drop("_s")


def positional_scores(predicted: DataFrame, labels: DataFrame, by: Sequence[str], order: Sequence[str], fields: Sequence[str], where: dict[str, Column] | None = None) -> DataFrame:
    """`by..., expected_rows, predicted_rows, status, correct_<field>..., correct_all` of rows compared in printed order.

    A unit whose numbers of rows differ isn't scored: its status says so and its scores are null. Null equals null.
    where: conditions on label columns (as `label_<column>`) under which a field is checked at all; then `checked_<field>` counts them.
    """
    where = where or {}
    number = lambda d: F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    p = predicted.withColumn("_i", number(predicted)).select(*by, "_i", *[F.col(f).alias(f"predicted_{f}") for f in fields], F.lit(1).alias("_p"))
    l = labels.withColumn("_i", number(labels)).select(*by, "_i", *[F.col(c).alias(f"label_{c}") for c in labels.columns if c not in by], F.lit(1).alias("_l"))
    met = p.join(l, [*by, "_i"], "full")
    right = {f: F.col(f"predicted_{f}").eqNullSafe(F.col(f"label_{f}")) & F.col("_p").isNotNull() & F.col("_l").isNotNull() for f in fields}
    every = F.lit(True)
    for f in fields:
        if f not in where:
            every = every & right[f]
    sums = [F.count_if(right[f] & F.coalesce(where.get(f, F.lit(True)), F.lit(False))).alias(f"correct_{f}") for f in fields] + [F.count_if(every).alias("correct_all")]
    sums += [F.count_if(F.coalesce(c, F.lit(False))).alias(f"checked_{f}") for f, c in where.items()]
    out = met.groupBy(*by).agg(F.count("_l").alias("expected_rows"), F.count("_p").alias("predicted_rows"), *sums)
    same = F.col("expected_rows") == F.col("predicted_rows")
    scores = [c for c in out.columns if c.startswith(("correct_", "checked_"))]
    return out.select(*by, "expected_rows", "predicted_rows", F.when(same, "scored").otherwise("row_count_mismatch").alias("status"), *[F.when(same, F.col(c)).alias(c) for c in scores])


def typed_agreement(cells: DataFrame, printed: str, typed: dict[str, Column], missing: str = "reason") -> DataFrame:
    """cells with `problem`: typed values that aren't what the printed text says, a blank without a reason, or a reason without a blank."""
    blank, given = F.trim(F.coalesce(F.col(printed), F.lit(""))) == "", F.trim(F.coalesce(F.col(missing), F.lit(""))) != ""
    same = F.lit(True)
    for c, said in typed.items():
        same = same & F.col(c).eqNullSafe(said)
    problem = F.when(blank & ~given, "blank without a reason").when(~blank & given, "reason without a blank").when(~blank & ~same, "typed values differ")
    return cells.withColumn("problem", problem)
