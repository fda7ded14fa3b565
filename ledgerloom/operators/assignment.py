"""Optimal one-to-one assignment of scored pairs: small components in a task each, large ones by an auction in rounds.

The auction runs over written tables, so no component has to fit into a task. Every left and right record is there twice,
with an edge of no gain between its two selves for staying unmatched; then a complete matching always exists, and prices
may carry over from a coarse step of bids to a finer one. With gains in whole units times the number of persons and
a last step of one, the matching that ends is the best.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .state import dropped, written

#: Pairs of a block, or of a component of a larger block, that one task may solve.
LOCAL = 50_000
#: Units of a score of 1: scores count to six decimals in the auction.
UNITS = 1_000_000
#: Cells of a component's matrix up to which it is solved as a matrix; sparser or larger ones along their pairs.
DENSE = 1_000_000
#: Units of a score of 1 along pairs.
FINE = 1 << 40
#: The step of bids is divided by this from one phase to the next.
FINER = 6


def assign(cost: np.ndarray) -> np.ndarray:
    """Column of each row for the least total cost (rows <= columns), by shortest augmenting paths with potentials."""
    n, m = cost.shape
    u, v, match, way = np.zeros(n + 1), np.zeros(m + 1), np.zeros(m + 1, dtype=int), np.zeros(m + 1, dtype=int)
    for i in range(1, n + 1):
        match[0], j0 = i, 0
        low, seen = np.full(m + 1, np.inf), np.zeros(m + 1, dtype=bool)
        while True:
            seen[j0] = True
            i0 = match[j0]
            step = cost[i0 - 1] - u[i0] - v[1:]
            better = ~seen[1:] & (step < low[1:])
            low[1:][better], way[1:][better] = step[better], j0
            j1 = int(np.where(seen, np.inf, low).argmin())
            d = low[j1]
            u[match[seen]] += d
            v[seen] -= d
            low[~seen] -= d
            j0 = j1
            if match[j0] == 0:
                break
        while j0:
            match[j0] = match[way[j0]]
            j0 = way[j0]
    out = np.full(n, -1)
    for j in range(1, m + 1):
        if match[j]:
            out[match[j] - 1] = j - 1
    return out


def transport(gains: Sequence[dict[int, int]], supply: Sequence[int], room: Sequence[int]) -> dict[tuple[int, int], int]:
    """`(row, column): n` of the greatest total gain, with at most supply[row] and room[column] in all; gains are above 0.

    Shortest augmenting paths over the given pairs alone, with prices of columns and profits of rows. A path carries as
    much as it can, so the number of paths grows with rows and columns, not with supplies.
    """
    price, profit, free = [0] * len(room), [0] * len(gains), list(room)
    held: list[dict[int, int]] = [{} for _ in room]
    for start, left in enumerate(supply):
        profit[start] = max([0, *[g - price[j] for j, g in gains[start].items()]])
        while left:
            rows, cols, into, back, done, queue = {start: 0}, {}, {}, {}, [], []
            end, last, column, fresh, d = profit[start], start, None, [start], 0
            while True:
                for i in fresh:
                    if d + profit[i] < end:  # i leaves one of its own unmatched
                        end, last = d + profit[i], i
                    for j, g in gains[i].items():
                        far = d + profit[i] + price[j] - g
                        if far <= end and far < cols.get(j, end + 1):
                            cols[j], into[j] = far, i
                            heapq.heappush(queue, (far, j))
                while queue and queue[0][0] > cols[queue[0][1]]:
                    heapq.heappop(queue)
                if not queue or queue[0][0] > end:
                    break
                d, j = heapq.heappop(queue)
                if free[j]:
                    end, column = d, j
                    break
                done.append(j)
                fresh = [i for i in held[j] if i not in rows]
                for i in fresh:
                    rows[i], back[i] = d, j
            for i, d in rows.items():
                profit[i] -= end - d
            for j in done:
                price[j] += end - cols[j]
            path, i = [], last if column is None else into[column]
            while i != start:
                path.append((back[i], i))
                i = into[back[i]]
            n = min([left, *([] if column is None else [free[column]]), *[held[j][i] for j, i in path]])
            if column is not None:
                free[column] -= n
                held[column][into[column]] = held[column].get(into[column], 0) + n
            for j, i in path:
                held[j][i] -= n
                if not held[j][i]:
                    del held[j][i]
                held[j][into[j]] = held[j].get(into[j], 0) + n
            left -= n
    return {(i, j): n for j, own in enumerate(held) for i, n in own.items()}


def _parts(pairs: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """The connected components of `left, right`."""
    top: dict = {}

    def root(x):
        while top.setdefault(x, x) != x:
            top[x] = top[top[x]]
            x = top[x]
        return x

    for a, b in pairs[["left", "right"]].itertuples(index=False):
        top[root((1, b))] = root((0, a))
    own = [root((0, a)) for a in pairs["left"]]
    for _, part in pairs.groupby(pd.Series(pd.factorize(pd.Series(own, dtype=object))[0], index=pairs.index), sort=False):
        yield part


def best_pairs(pairs: pd.DataFrame) -> pd.DataFrame:
    """One-to-one pairs of the greatest total score among `left, right, score`; ties go to the lesser keys.

    Each connected component of the pairs is solved on its own, small ones as a matrix, others along their pairs. With
    `n_left, n_right` left and right are classes of so many records, and `n` tells how many of them a pair takes.
    """
    pairs, keep, counted = pairs.sort_values(["left", "right"]), [], "n_left" in pairs
    for part in _parts(pairs):
        rows, cols = part["left"].drop_duplicates().tolist(), part["right"].drop_duplicates().sort_values().tolist()
        at_r, at_c = {k: i for i, k in enumerate(rows)}, {k: i for i, k in enumerate(cols)}
        if len(rows) * (len(rows) + len(cols)) > DENSE or (counted and max(part["n_left"].max(), part["n_right"].max()) > 1):
            gains: list[dict[int, int]] = [{} for _ in rows]
            supply, room, score = [1] * len(rows), [1] * len(cols), {}
            for a, b, s in part[["left", "right", "score"]].itertuples(index=False):
                if round(s * FINE) > 0:
                    gains[at_r[a]][at_c[b]], score[at_r[a], at_c[b]] = round(s * FINE), s
            if counted:
                for a, b, k, m in part[["left", "right", "n_left", "n_right"]].itertuples(index=False):
                    supply[at_r[a]], room[at_c[b]] = int(k), int(m)
            keep += [(rows[i], cols[j], score[i, j], n) for (i, j), n in transport(gains, supply, room).items()]
            continue
        gain = np.zeros((len(rows), len(cols) + len(rows)))  # a column of its own for each row: unmatched
        for a, b, s in part[["left", "right", "score"]].itertuples(index=False):
            gain[at_r[a], at_c[b]] = s
        keep += [(rows[i], cols[j], gain[i, j], 1) for i, j in enumerate(assign(-gain)) if j < len(cols) and gain[i, j] > 0]
    return pd.DataFrame(keep, columns=["left", "right", "score", "n"])[["left", "right", "score", *(["n"] if counted else [])]]


def components(edges: DataFrame) -> DataFrame:
    """`node, component` of undirected edges `a, b`: the least node that is connected with it.

    Each round takes the least label among neighbours, then that label's own label, so long chains halve.
    """
    both = written(edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("component")))
    while True:
        seen = both.join(labels, F.col("b") == F.col("node")).select(F.col("a").alias("node"), "component").unionAll(labels)
        least = written(seen.groupBy("node").agg(F.min("component").alias("component")))
        up = least.select(F.col("node").alias("component"), F.col("component").alias("_up"))
        after = written(least.join(up, "component").select("node", F.least("component", "_up").alias("component")))
        moved = not after.join(labels.withColumnRenamed("component", "_was"), "node").filter("component <> _was").isEmpty()
        dropped(least, labels)
        labels = after
        if not moved:
            dropped(both)
            return labels


def _solved(pairs: DataFrame, by: Sequence[str]) -> DataFrame:
    """The optimum of each group of `by`, one task's work each; `n` besides, if classes are counted."""
    key, counts = pairs.schema["left"].dataType.simpleString(), [c for c in ("n_left", "n_right") if c in pairs.columns]
    kinds = ", ".join(f"`{b}` {pairs.schema[b].dataType.simpleString()}" for b in by)

    def solve(k, pdf: pd.DataFrame) -> pd.DataFrame:
        out = best_pairs(pdf)
        for name, value in zip(by, k, strict=True):
            out[name] = value
        return out

    return pairs.select(*by, "left", "right", "score", *counts).groupBy(*by).applyInPandas(solve, f"`left` {key}, `right` {key}, score double, {'n long, ' if counts else ''}{kinds}")


def auction(pairs: DataFrame, units: int = UNITS) -> DataFrame:
    """The rows of `left, right, score` (scores above 0, distinct pairs, keys of strings) of a best assignment, by bids in rounds.

    All persons without an object bid at once: for the best object at its price, by as much as it is better than the second
    best, and a step. An object goes to its highest bidder. A round reads the written edges once; the last phase
    has step 1. Scores count in units.
    """
    gain = F.round(F.col("score") * units).cast("long")
    l, r = F.concat(F.lit("l"), F.col("left")), F.concat(F.lit("r"), F.col("right"))
    kinds = [(l, r, gain), (r, l, F.lit(0).cast("long"))]
    own = [pairs.select(x.alias("person"), x.alias("object"), F.lit(0).cast("long").alias("gain")).distinct() for x in (l, r)]
    edges = own[0].unionAll(own[1])
    for person, thing, value in kinds:
        edges = edges.unionAll(pairs.select(person.alias("person"), thing.alias("object"), value.alias("gain")))
    persons = pairs.select(F.count_distinct("left") + F.count_distinct("right")).first()[0]
    edges = written(edges.withColumn("gain", F.col("gain") * (persons + 1)))
    spark, step = pairs.sparkSession, max(1, units * (persons + 1) // 4)
    state = written(spark.createDataFrame([], "object string, price long, person string"))
    while True:
        fresh = written(state.withColumn("person", F.lit(None).cast("string")))
        dropped(state)
        state = fresh
        while True:
            held = state.filter("person is not null").select("person")
            idle = edges.join(held, "person", "left_anti")
            worth = idle.join(state.select("object", "price"), "object", "left").withColumn("price", F.coalesce("price", F.lit(0).cast("long"))).withColumn("worth", F.col("gain") - F.col("price"))
            two = worth.withColumn("_k", F.row_number().over(Window.partitionBy("person").orderBy(F.desc("worth"), "object"))).filter("_k <= 2")
            first, second = F.max(F.when(F.col("_k") == 1, F.struct("object", "price", "worth"))), F.max(F.when(F.col("_k") == 2, F.col("worth")))
            bids = two.groupBy("person").agg(first.alias("b"), second.alias("s")).select(F.col("b.object").alias("object"), "person", (F.col("b.price") + F.col("b.worth") - F.col("s") + step).alias("price"))
            won = bids.groupBy("object").agg(F.max(F.struct("price", "person")).alias("w")).select("object", "w.price", "w.person")
            after = written(state.join(won.select("object"), "object", "left_anti").unionByName(won))
            ended = after.filter("person is not null").count() == persons
            dropped(state)
            state = after
            if ended:
                break
        if step == 1:
            break
        step = max(1, step // FINER)
    taken = state.select(F.substring("person", 2, 1 << 30).alias("left"), F.substring("object", 2, 1 << 30).alias("right")).filter(F.startswith("person", F.lit("l")) & F.startswith("object", F.lit("r")))
    out = written(pairs.join(taken, ["left", "right"]))
    dropped(edges, state)
    return out


def one_to_one(pairs: DataFrame, block: Sequence[str], local: int = LOCAL, units: int = UNITS) -> DataFrame:
    """`block..., left, right, score`: pairs of the greatest total score in each block, each record in one of them at most.

    Blocks of at most `local` pairs are a task's work each, components of larger blocks likewise; a larger component is
    solved by auction. Scores are above 0; repeated pairs count once with their best score. With `n_left, n_right` a pair
    is one of two classes of so many records that are alike, and `n` tells how many pairs of records it stands for.
    """
    keys, counts = [F.col(b) for b in block], [c for c in ("n_left", "n_right") if c in pairs.columns]
    found = ["left", "right", "score", *(["n"] if counts else [])]
    best = written(pairs.groupBy(*block, "left", "right").agg(F.max("score").alias("score"), *[F.max(c).alias(c) for c in counts]))
    own = [f"_b{i}" for i, _ in enumerate(block)]
    sizes = best.groupBy(*[F.col(b).alias(o) for b, o in zip(block, own, strict=True)]).agg((F.count("*") > local).alias("_large"))
    known = best.join(sizes, [F.col(b).eqNullSafe(F.col(o)) for b, o in zip(block, own, strict=True)]).drop(*own)
    out = _solved(known.filter("not _large"), block).select(*block, *found)
    if sizes.filter("_large").isEmpty():
        return out
    name = lambda side: F.to_json(F.struct(*keys, F.col(side).alias("_k")))  # noqa: E731  distinct over blocks
    wide = written(known.filter("_large").drop("_large").withColumns({"_l": name("left"), "_r": name("right")}))
    label = components(wide.select(F.concat(F.lit("l"), F.col("_l")).alias("a"), F.concat(F.lit("r"), F.col("_r")).alias("b")))
    owned = wide.join(label.select(F.expr("substring(node, 2)").alias("_l"), "component", "node").filter(F.startswith("node", F.lit("l"))).drop("node"), "_l")
    size = owned.groupBy("component").agg((F.count("*") > local).alias("_large"))
    known = written(owned.join(size, "component"))
    small = _solved(known.filter("not _large"), [*block, "component"]).select(*block, *found)
    large = known.filter("_large")
    if large.isEmpty():
        return out.unionAll(small)
    bids = large.select(F.col("_l").alias("left"), F.col("_r").alias("right"), "score", *counts)
    for side, c in zip(("left", "right"), counts):  # each record bids for itself
        bids = bids.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("long"), F.col(c)))).withColumn(side, F.concat(F.col("_i").cast("string"), F.lit(":"), F.col(side))).drop("_i", c)
    won = auction(bids, units).select(F.col("left").alias("_l"), F.col("right").alias("_r"))
    if counts:
        plain = lambda c: F.regexp_replace(c, "^[0-9]+:", "")
        won = won.groupBy(plain("_l").alias("_l"), plain("_r").alias("_r")).agg(F.count("*").alias("n"))
    rest = large.join(won, ["_l", "_r"]).select(*block, *found)
    return out.unionAll(small).unionAll(rest)
