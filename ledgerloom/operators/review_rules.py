"""Reviews checked by rules as data, and applied only if all of them are well.

Rules compile to one array of violations over reviews joined to the rows they are about. A review's columns are named as they
are, the row's with `row_` before. Applying is one call: the violations are counted first, and nothing changes if there are any.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .overlay import apply_overlay
from .state import dropped, written


class ReviewError(ValueError):
    """Reviews that break rules."""


@dataclass(frozen=True)
class Rule:
    """reason: what a violation is called. when: the reviews it is for (all of them if None)."""

    reason: str
    when: Column | None = field(default=None, kw_only=True)

    def broken(self) -> Column:
        raise NotImplementedError


@dataclass(frozen=True)
class Stated(Rule):
    """Columns that may not be null or blank."""

    columns: Sequence[str] = ()

    def broken(self):
        blank = lambda c: F.coalesce(F.trim(F.col(c).cast("string")) == "", F.lit(True))
        return F.exists(F.array(*[blank(c) for c in self.columns]), lambda x: x)


@dataclass(frozen=True)
class Pattern(Rule):
    """A column that has to be of a form in full (coordinates, hashes); null isn't."""

    column: str = ""
    form: str = ""

    def broken(self):
        return ~F.coalesce(F.regexp_like(F.col(self.column).cast("string"), F.lit(f"^(?:{self.form})$")), F.lit(False))


@dataclass(frozen=True)
class OneOf(Rule):
    """A column whose value is one of a list."""

    column: str = ""
    values: Sequence[object] = ()

    def broken(self):
        return ~F.coalesce(F.col(self.column).isin(list(self.values)), F.lit(False))


@dataclass(frozen=True)
class Agrees(Rule):
    """What the review saw (`seen_<guard>`) is what the row has, null for null; a review without a row breaks it."""

    guards: Sequence[str] = ()

    def broken(self):
        return ~F.forall(F.array(*[F.col(f"seen_{g}").eqNullSafe(F.col(f"row_{g}")) for g in self.guards]), lambda x: x) | ~F.col("_found")


@dataclass(frozen=True)
class Literal(Rule):
    """A printed literal and the typed values it stands for: a literal that isn't known, or other values, break it."""

    column: str = ""
    means: Mapping[str, Mapping[str, object]] = field(default_factory=dict)

    def broken(self):
        out = F.lit(True)
        for text, typed in self.means.items():
            well = F.forall(F.array(*[F.col(c).eqNullSafe(F.lit(v)) for c, v in typed.items()]), lambda x: x)
            out = F.when(F.col(self.column) == text, ~well).otherwise(out)
        return out


@dataclass(frozen=True)
class Digest(Rule):
    """A column holds the SHA-256 of another."""

    column: str = ""
    of: str = ""

    def broken(self):
        return ~F.coalesce(F.lower(F.col(self.column)) == F.sha2(F.col(self.of).cast("string"), 256), F.lit(False))


@dataclass(frozen=True)
class Holds(Rule):
    """Any condition over the review and its row; null breaks it."""

    condition: Column = None

    def broken(self):
        return ~F.coalesce(self.condition, F.lit(False))


def check_reviews(rows: DataFrame, reviews: DataFrame, key: Sequence[str], rules: Sequence[Rule]) -> DataFrame:
    """reviews with `violations`: reasons in the order of rules, after `no row`, `several rows` and `several reviews`.

    Rows of a key are counted before the join, so a hot key is a number, not a group.
    """
    rest = [c for c in rows.columns if c not in key]
    one = rows.groupBy(*key).agg(F.count("*").alias("_rows"), F.first(F.struct(*rest)).alias("_row"))
    twice = reviews.groupBy(*key).agg(F.count("*").alias("_reviews"))
    met = reviews.join(twice, list(key), "left").join(one, list(key), "left").withColumn("_found", F.col("_rows").isNotNull())
    met = met.select("*", *[F.col(f"_row.{c}").alias(f"row_{c}") for c in rest])
    own = [F.when(~F.col("_found"), "no row"), F.when(F.col("_rows") > 1, "several rows"), F.when(F.coalesce(F.col("_reviews"), F.lit(1)) > 1, "several reviews")]
    for r in rules:
        for_it = F.lit(True) if r.when is None else F.coalesce(r.when, F.lit(False))
        own.append(F.when(for_it & F.coalesce(r.broken(), F.lit(True)), r.reason))
    return met.select(*reviews.columns, F.filter(F.array(*own), lambda x: x.isNotNull()).alias("violations"))


def apply_reviews(rows: DataFrame, reviews: DataFrame, key: Sequence[str], rules: Sequence[Rule], guards: Sequence[str], sets: Mapping[str, Column], flags: str | None = None, add: Sequence[str] = (), remove: Sequence[str] = (), shown: int = 5) -> DataFrame:
    """rows with all reviews applied, or ReviewError with the number of bad ones and the first of them; nothing in between."""
    checked = written(check_reviews(rows, reviews, key, [*rules, Agrees("guard differs", guards)]))
    bad = checked.filter(F.size("violations") > 0)
    n = bad.count()
    if n:
        first = [(*[r[k] for k in key], list(r["violations"])) for r in bad.orderBy(*key).limit(shown).collect()]
        dropped(checked)
        raise ReviewError(f"{n} reviews break rules: {first}")
    return apply_overlay(rows, checked.drop("violations"), key, guards, sets, flags, add, remove, fatal=True)
