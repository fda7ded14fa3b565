"""Many gates over one table as data, compiled to one pass: partial counts by group, then sums and verdicts by run.

A run (a year, say) is a value of `by`; a group (a block) lies within one. Everything a gate needs is a count in a group, so
rows are read once and shuffled as one row a group and task. Official figures and excused groups are joined as tables.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Gate:
    """name and whether it is hard. `counts` are conditions counted in each group, `flags` marks of a group from those counts.

    `verdict` says from sums of counts (c0, c1, ...), numbers of flagged groups (g0, ...), `groups` and the official
    figures what was found, what was wanted, and whether that is well; nulls count as a failure.
    """

    name: str
    hard: bool = True

    def counts(self) -> list[Column]:
        return []

    def flags(self, c: Sequence[Column]) -> list[Column]:
        return []

    def verdict(self, c: Sequence[Column], g: Sequence[Column]) -> tuple[Column, Column, Column]:
        raise NotImplementedError


@dataclass(frozen=True)
class Coverage(Gate):
    """Rows of a kind are at least a share of an official figure. basis: which official counts leave out `vacant` rows."""

    rows: Column = None
    official: str = ""
    share: float = 0.97
    basis: str | None = None
    vacant: Column = None

    def counts(self):
        return [self.rows, self.rows & F.coalesce(self.vacant, F.lit(False)) if self.vacant is not None else F.lit(False)]

    def verdict(self, c, g):
        elected = F.coalesce(F.col(self.basis) == "elected", F.lit(False)) if self.basis else F.lit(False)
        found = c[0] - F.when(elected, c[1]).otherwise(0)
        return found, F.col(self.official), found >= self.share * F.col(self.official)


@dataclass(frozen=True)
class GroupCount(Gate):
    """The number of groups is within a tolerance of an official figure; nothing is asked where that is null."""

    official: str = ""
    tolerance: int = 2

    def verdict(self, c, g):
        return F.col("groups"), F.col(self.official), F.coalesce(F.abs(F.col("groups") - F.col(self.official)) <= self.tolerance, F.lit(True))


@dataclass(frozen=True)
class AtMost(Gate):
    """No more rows than a limit (a number, or an official figure) meet a condition."""

    rows: Column = None
    limit: int | str = 0

    def counts(self):
        return [self.rows]

    def verdict(self, c, g):
        limit = F.coalesce(F.col(self.limit), F.lit(0)) if isinstance(self.limit, str) else F.lit(self.limit)
        return c[0], limit, c[0] <= limit


@dataclass(frozen=True)
class Share(Gate):
    """The percentage of `rows` among `among` is within points of a figure, at least it or below it; none among none fails `near` and `least`."""

    rows: Column = None
    among: Column = None
    percent: float = 0.0
    kind: str = "near"
    points: float = 3.0

    def counts(self):
        return [self.among & self.rows, self.among]

    def verdict(self, c, g):
        found = F.coalesce(F.try_divide(100.0 * c[0], c[1]), F.lit(0.0))
        well = {"near": F.abs(found - self.percent) <= self.points, "least": found >= self.percent, "below": found < self.percent}[self.kind]
        return F.round(found, 4), F.lit(self.percent), well


@dataclass(frozen=True)
class GroupsOff(Gate):
    """At most a share of all groups have a percentage further than points from a figure; excused groups don't count."""

    rows: Column = None
    among: Column = None
    percent: float = 0.0
    points: float = 6.0
    share: float = 0.05

    def counts(self):
        return [self.among & self.rows, self.among]

    def flags(self, c):
        off = F.abs(F.coalesce(F.try_divide(100.0 * c[0], c[1]), F.lit(0.0)) - self.percent) > self.points
        return [off & ~F.col("excused"), off]

    def verdict(self, c, g):
        return g[0], F.round(self.share * F.col("groups"), 4), g[0] <= self.share * F.col("groups")


@dataclass(frozen=True)
class Numbered(Gate):
    """Whole numbers of a column run from 1 without gaps (and without repeats) in every group; nulls aren't numbers."""

    number: str = ""

    def counts(self):
        return [F.col(self.number).isNotNull()]

    def flags(self, c):
        distinct, top = F.col(f"_distinct_{self.number}"), F.col(f"_max_{self.number}")
        return [F.coalesce((distinct != top) | (c[0] != distinct), F.lit(False))]

    def verdict(self, c, g):
        return g[0], F.lit(0), g[0] == 0


def evaluate(rows: DataFrame, gates: Sequence[Gate], by: Sequence[str], group: Sequence[str], official: DataFrame | None = None, excused: DataFrame | None = None) -> DataFrame:
    """`by..., check, hard, ok, found, wanted`: each gate of each run, from one pass over rows.

    official: figures of a run, one row each; excused: groups (`by..., group...`) that a review has accounted for. Conditions
    that are null don't hold. A run without rows has no verdicts: `quality.covers_frame` tells which are missing.
    """
    counts, flags, aggs = [], [], {}
    for gate in gates:
        own = gate.counts()
        counts.append([f"_c{len(aggs) + i}" for i in range(len(own))])
        aggs |= {name: F.count_if(F.coalesce(c, F.lit(False))) for name, c in zip(counts[-1], own, strict=True)}
    extra = {}
    for gate in gates:
        if isinstance(gate, Numbered):
            extra |= {f"_distinct_{gate.number}": F.count_distinct(gate.number), f"_max_{gate.number}": F.max(gate.number)}
    parts = rows.groupBy(*by, *group).agg(F.lit(True).alias("_group"), *[v.alias(k) for k, v in (aggs | extra).items()])
    if excused is not None:
        parts = parts.join(excused.select(*by, *group).distinct().withColumn("excused", F.lit(True)), [*by, *group], "left")
    parts = parts.withColumn("excused", F.coalesce("excused", F.lit(False)) if excused is not None else F.lit(False))
    marks = {}
    for gate, own in zip(gates, counts, strict=True):
        found = gate.flags([F.col(c) for c in own])
        flags.append([f"_g{len(marks) + i}" for i in range(len(found))])
        marks |= dict(zip(flags[-1], found, strict=True))
    sums = parts.groupBy(*by).agg(F.count("*").alias("groups"), *[F.sum(k).alias(k) for k in aggs], *[F.count_if(v).alias(k) for k, v in marks.items()])
    if official is not None:
        sums = sums.join(official, list(by), "left")
    verdicts = []
    for gate, c, g in zip(gates, counts, flags, strict=True):
        found, wanted, ok = gate.verdict([F.col(x) for x in c], [F.col(x) for x in g])
        verdicts.append(F.struct(F.lit(gate.name).alias("check"), F.lit(gate.hard).alias("hard"), F.coalesce(ok, F.lit(False)).alias("ok"), found.cast("double").alias("found"), wanted.cast("double").alias("wanted")))
    return sums.select(*by, F.explode(F.array(*verdicts)).alias("v")).select(*by, "v.*")
