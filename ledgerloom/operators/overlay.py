"""Guarded review overlays: reviewed values replace printed ones where the printed cells are what the reviewer saw."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.text import flags_changed


def violations(df: DataFrame, reviews: DataFrame, key: Sequence[str], guards: Sequence[str]) -> DataFrame:
    """`key..., reasons`: reviews without a row, with several, twice for one row, or with a guard that doesn't match.

    guards name columns of df; reviews hold what was seen as `seen_<guard>`. Comparison is null-safe.
    """
    rows = df.groupBy(*key).agg(F.count("*").alias("_rows"), *[F.first(g).alias(f"_g_{g}") for g in guards])
    r = reviews.groupBy(*key).agg(F.count("*").alias("_reviews"), *[F.first(f"seen_{g}").alias(f"seen_{g}") for g in guards])
    j = r.join(rows, list(key), "left")
    found = F.col("_rows").isNotNull()
    reasons = F.filter(F.array(F.when(~found, "no row"), F.when(F.col("_rows") > 1, "several rows"), F.when(F.col("_reviews") > 1, "several reviews"), *[F.when(found & ~F.col(f"_g_{g}").eqNullSafe(F.col(f"seen_{g}")), f"{g} differs") for g in guards]), lambda x: x.isNotNull())
    return j.select(*key, reasons.alias("reasons")).filter(F.size("reasons") > 0)


def apply_overlay(df: DataFrame, reviews: DataFrame, key: Sequence[str], guards: Sequence[str], sets: Mapping[str, Column], flags: str | None = None, add: Sequence[str] = (), remove: Sequence[str] = (), fatal: bool = False) -> DataFrame:
    """df with `review_status` (applied, precondition_failed or null) and, where applied, new values and `<column>_before`.

    sets: column -> value, which may use the review's columns. fatal: a failed guard is an error instead of a status.
    """
    known = [c for c in reviews.columns if c not in key]
    r = reviews.select(*key, F.struct(*known).alias("_review"))
    j = df.join(r, list(key), "left")
    ok = F.lit(True)
    for g in guards:
        ok = ok & F.col(g).eqNullSafe(F.col(f"_review.seen_{g}"))
    status = F.when(F.col("_review").isNull(), None).when(ok, "applied").otherwise(F.raise_error("a review's guard doesn't match").cast("string") if fatal else F.lit("precondition_failed"))
    j = j.withColumn("review_status", status)
    hit = F.coalesce(F.col("review_status") == "applied", F.lit(False))
    wide = j.select("*", *[F.col(f"_review.{c}").alias(c) for c in known if c not in df.columns])
    new = {c: F.when(hit, v).otherwise(F.col(c)) for c, v in sets.items()}
    out = wide.select(*[new.get(c, F.col(c)).alias(c) for c in df.columns], "review_status", *[F.when(hit, F.col(c)).alias(f"{c}_before") for c in sets], hit.alias("_hit"))
    if flags:
        out = out.withColumn(flags, F.when(F.col("_hit"), flags_changed(F.col(flags), list(add), list(remove))).otherwise(F.col(flags)))
    return out.drop("_hit")


def reasons(*tests: tuple[Column, str]) -> Column:
    """Texts of the conditions that hold (null: doesn't), in order, joined by `;`."""
    return F.array_join(F.filter(F.array(*[F.when(c, F.lit(t)) for c, t in tests]), lambda x: x.isNotNull()), ";")


def disposition(*steps: tuple[Column, str], default: str) -> Column:
    """A state from conditions in order, where a later one that holds wins."""
    out = F.lit(default)
    for cond, name in steps:
        out = F.when(F.coalesce(cond, F.lit(False)), name).otherwise(out)
    return out
