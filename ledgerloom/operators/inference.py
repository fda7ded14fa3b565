"""Probability models: grouped folds, L2 logistic regression by Newton steps on aggregates, out-of-fold scores."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


#: Cells of groups of one size; the only window over all is one over (size, cell).
CELLS = 64


def _number_by_size(df: DataFrame, group: str) -> DataFrame:
    """`group, _n, _i`: groups with their size, numbered from 0 within it; a task orders counts of (size, cell), or one cell."""
    sizes = df.groupBy(group).agg(F.count("*").alias("_n")).withColumn("_c", F.pmod(F.xxhash64(group), F.lit(CELLS)))
    cells = sizes.groupBy("_n", "_c").agg(F.count("*").alias("_g"))
    before = cells.select(F.col("_n").alias("_m"), F.col("_c").alias("_d"), (F.sum("_g").over(Window.partitionBy("_n").orderBy("_c")) - F.col("_g")).alias("_before"))
    numbered = sizes.withColumn("_k", F.row_number().over(Window.partitionBy("_n", "_c").orderBy(group)) - 1)
    return numbered.join(before, (F.col("_n") == F.col("_m")) & (F.col("_c") == F.col("_d"))).select(group, "_n", (F.col("_before") + F.col("_k")).alias("_i"))


def lightest_first(sizes: Mapping[int, int], folds: int) -> list[tuple[int, int, int, int]]:
    """`size, first, last, fold`: runs of groups of one size, largest sizes first, each group to the lightest fold (ties: the first).

    Groups of one size in a row to one fold are one run, and whole turns over all folds are dealt at once, so the work
    grows with distinct sizes and folds, not with groups. In a run of turns every folds-th group from first to last is meant.
    """
    loads, out = [0] * folds, []
    for size in sorted(sizes, reverse=True):
        left, at = sizes[size], 0
        while left:
            low = min(loads)
            if max(loads) - low < size and left >= folds:  # each fold is next in turn, in order of load
                order = sorted(range(folds), key=lambda f: (loads[f], f))
                turns = left // folds
                out += [(size, at + k, at + k + (turns - 1) * folds, f) for k, f in enumerate(order)]
                loads = [x + turns * size for x in loads]
                at, left = at + turns * folds, left - turns * folds
                continue
            f = loads.index(low)
            out.append((size, at, at, f))
            loads[f] += size
            at, left = at + 1, left - 1
    return out


def greedy_folds(df: DataFrame, group: str, folds: int = 10) -> DataFrame:
    """`group, fold`: the largest group first, each to the fold with the least rows so far; no group on two sides.

    The driver deals the histogram of group sizes (one number a distinct size); groups of one size are alike and take their
    places by number.
    """
    numbered = _number_by_size(df, group)
    histogram = {r["_n"]: r["c"] for r in numbered.groupBy("_n").agg(F.count("*").alias("c")).collect()}
    runs = lightest_first(histogram, folds)
    spark = df.sparkSession
    table = spark.createDataFrame([(n, a, b, f, folds if b > a else 1) for n, a, b, f in runs], "_s long, _a long, _b long, fold int, _step int")
    met = (F.col("_n") == F.col("_s")) & (F.col("_i") >= F.col("_a")) & (F.col("_i") <= F.col("_b")) & ((F.col("_i") - F.col("_a")) % F.col("_step") == 0)
    return numbered.join(table, met).select(group, "fold")


def group_folds(df: DataFrame, group: str, folds: int = 10) -> DataFrame:
    """`group, fold`: no group on two sides; a serpentine over groups by size balances the folds, as greedy dealing would.

    Groups are numbered by size, then within cells of a hash, so one task orders only counts of (size, cell).
    """
    sizes = df.groupBy(group).agg(F.count("*").alias("_n")).withColumn("_c", F.pmod(F.xxhash64(group), F.lit(CELLS)))
    cells = sizes.groupBy("_n", "_c").agg(F.count("*").alias("_g"))
    cells = cells.select(F.col("_n").alias("_m"), F.col("_c").alias("_d"), (F.sum("_g").over(Window.orderBy(F.desc("_n"), "_c")) - F.col("_g")).alias("_before"))
    numbered = sizes.withColumn("_i", F.row_number().over(Window.partitionBy("_n", "_c").orderBy(group)) - 1)
    i = F.col("_before") + F.col("_i")
    turn, place = F.floor(i / folds), i % folds
    fold = F.when(turn % 2 == 0, place).otherwise(folds - 1 - place).cast("int")
    return numbered.join(cells, (F.col("_n") == F.col("_m")) & (F.col("_c") == F.col("_d"))).select(group, fold.alias("fold"))


def smoothed_rates(df: DataFrame, group: str, fold: str, hit: Column, prior_rows: float = 20.0, least: int = 3) -> DataFrame:
    """`group, fold, n, rate`: a group's share of hits in all other folds, drawn to the overall share of those folds.

    The overall share weighs as much as prior_rows rows. Groups with fewer than `least` rows outside the fold abstain: their
    rate is null. Null hits aren't counted. One aggregate by (group, fold); the rest are sums of it.
    """
    h = hit.cast("double")
    cells = df.groupBy(group, fold).agg(F.count(h).alias("_n"), F.coalesce(F.sum(h), F.lit(0.0)).alias("_h"))
    whole = cells.groupBy(group).agg(F.sum("_n").alias("_gn"), F.sum("_h").alias("_gh"))
    by_fold = cells.groupBy(fold).agg(F.sum("_n").alias("_fn"), F.sum("_h").alias("_fh"))
    every = Window.partitionBy(F.lit(0))  # a row for each fold
    prior = by_fold.select(fold, F.try_divide(F.sum("_fh").over(every) - F.col("_fh"), F.sum("_fn").over(every) - F.col("_fn")).alias("_prior"))
    n, hits = F.col("_gn") - F.col("_n"), F.col("_gh") - F.col("_h")
    rate = F.when(n >= least, (hits + prior_rows * F.col("_prior")) / (n + prior_rows))
    return cells.join(whole, group).join(prior, fold).select(group, fold, n.alias("n"), rate.alias("rate"))


def fit_logits(df: DataFrame, features: Sequence[str], label: str, parts: Sequence[Column], c: float = 1.0, steps: int = 12) -> list[np.ndarray]:
    """For each part (a condition on rows) intercept and weights of L2-penalised logistic regression on its rows.

    The penalty is 1 / (2c) on weights, none on the intercept. Newton's method; a step is one aggregate for all parts
    of (features + 1)^2 sums each, so only that many numbers leave the executors. A part without rows: zeros.
    """
    x = [F.lit(1.0), *[F.col(f).cast("double") for f in features]]
    d = len(x)
    weights, open_ = [np.zeros(d) for _ in parts], set(range(len(parts)))
    penalty = np.diag([0.0] + [1.0 / c] * len(features))
    for _ in range(steps):
        aggs = []
        for k in sorted(open_):
            w = weights[k]
            p = 1 / (1 + F.exp(-sum((xi * float(wi) for xi, wi in zip(x[1:], w[1:], strict=True)), F.lit(float(w[0])))))
            terms = [(p - F.col(label)) * xi for xi in x] + [p * (1 - p) * x[i] * x[j] for i in range(d) for j in range(i, d)]
            aggs.append(F.struct(*[F.sum(F.when(parts[k], t)).alias(f"s{n}") for n, t in enumerate(terms)]).alias(f"part{k}"))
        if not aggs:
            break
        row = df.agg(*aggs).head()
        for k in sorted(open_):
            sums = list(row[f"part{k}"])
            if sums[0] is None:
                open_.discard(k)
                continue
            h = np.zeros((d, d))
            h[np.triu_indices(d)] = sums[d:]
            h = h + np.triu(h, 1).T + penalty
            step = np.linalg.solve(h + 1e-9 * np.eye(d), np.array(sums[:d]) + penalty @ weights[k])
            weights[k] = weights[k] - step
            if np.abs(step).max() < 1e-8:
                open_.discard(k)
    return weights


def fit_logit(df: DataFrame, features: Sequence[str], label: str, c: float = 1.0, steps: int = 12) -> np.ndarray:
    """fit_logits on all rows."""
    return fit_logits(df, features, label, [F.lit(True)], c, steps)[0]


def probability(weights: np.ndarray, features: Sequence[str]) -> Column:
    z = sum((F.col(f).cast("double") * float(wi) for f, wi in zip(features, weights[1:], strict=True)), F.lit(float(weights[0])))
    return 1 / (1 + F.exp(-z))


def cross_validated(df: DataFrame, features: Sequence[str], label: str, group: str, folds: int = 10) -> DataFrame:
    """df with `fold` and `p`, each row scored by a model that saw none of its group; nulls in features give a null p.

    All folds are fitted together, one aggregate a step. Groups without a label have no fold, and their rows go.
    """
    d = df.join(greedy_folds(df.filter(F.col(label).isNotNull()), group, folds), group)
    known = d.filter(F.col(label).isNotNull()).select(*features, label, "fold")
    for f in features:
        known = known.filter(F.col(f).isNotNull())
    known = known.persist()
    try:
        models = fit_logits(known, features, label, [F.col("fold") != k for k in range(folds)])
    finally:
        known.unpersist()
    p = F.lit(None).cast("double")
    for k, w in enumerate(models):
        p = F.when(F.col("fold") == k, probability(w, features)).otherwise(p)
    return d.withColumn("p", p)
