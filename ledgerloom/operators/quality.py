"""Quality gates: checks as rows, hard ones failing a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class GateError(RuntimeError):
    """Hard checks failed."""


def report(df: DataFrame, checks: list[tuple[str, bool, Column, Column]]) -> DataFrame:
    """`check, hard, ok, detail` from aggregates of one pass over df: (name, hard, aggregate verdict, aggregate detail)."""
    row = df.agg(*[F.struct(F.lit(n).alias("check"), F.lit(hard).alias("hard"), F.coalesce(ok, F.lit(False)).alias("ok"), detail.cast("string").alias("detail")).alias(f"c{i}") for i, (n, hard, ok, detail) in enumerate(checks)])
    return row.select(F.explode(F.array(*row.columns)).alias("c")).select("c.*")


def enforce(checks: DataFrame) -> None:
    """Raises if a hard check failed. Collects the report: as many rows as there are checks."""
    bad = checks.filter("hard and not ok").collect()
    if bad:
        raise GateError("; ".join(f"{r['check']}: {r['detail']}" for r in bad))


def covers_frame(cells: DataFrame, frame: DataFrame, *key: str) -> DataFrame:
    """Keys of an expected frame against cells: missing, unexpected or duplicate; empty if they cover it exactly."""
    c = cells.groupBy(*key).agg(F.count("*").alias("_n"))
    j = frame.select(*key, F.lit(True).alias("_x")).distinct().join(c, list(key), "full")
    bad = F.when(F.col("_n").isNull(), "missing").when(F.col("_x").isNull(), "unexpected").when(F.col("_n") > 1, "duplicate")
    return j.select(*key, bad.alias("problem")).filter("problem is not null")


def receipts_agree(receipts: DataFrame, files: DataFrame) -> DataFrame:
    """Receipts (`path, sha256, bytes`) that files (`path, sha, bytes`) don't bear out."""
    j = receipts.join(files.select("path", F.col("sha").alias("_s"), F.col("bytes").alias("_b")), "path", "left")
    return j.filter(~(F.col("sha256").eqNullSafe(F.col("_s")) & F.col("bytes").eqNullSafe(F.col("_b")))).select(*receipts.columns)


def cardinalities(frames: dict[str, tuple[DataFrame, int]]) -> DataFrame:
    """Hard checks (as report's rows) that each frame has its fixed number of rows."""
    parts = [report(df, [(n, True, F.count("*") == rows, F.concat(F.count("*").cast("string"), F.lit(f" of {rows}")))]) for n, (df, rows) in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out


def at_least(name: str, part: Column, whole: Column, share: float, hard: bool = False) -> tuple[str, bool, Column, Column]:
    """A check that part is at least so large a share of whole (aggregates); without a whole it fails."""
    found = F.try_divide(part, whole)
    return name, hard, found >= share, F.concat(part.cast("string"), F.lit(" of "), whole.cast("string"))
