"""Row filters with names: seats that were won, domains, vocabularies, confirmed exclusions, blanked text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.text import control_characters

from .windows import number_within


def having(df: DataFrame, **values: object) -> DataFrame:
    """Rows whose columns have these values; None asks for null."""
    for name, v in values.items():
        df = df.filter(F.col(name).eqNullSafe(F.lit(v)))
    return df


def won(df: DataFrame, winner: str, vacant: str) -> DataFrame:
    """Rows with a winner that aren't vacant; an unknown vacancy is none."""
    return df.filter(F.col(winner).isNotNull() & ~F.coalesce(vacant, F.lit(False)))


def counted_on(df: DataFrame, basis: Column, people: str, vacant: Column) -> DataFrame:
    """Rows that an official figure counts: where its basis is `people`, vacant ones don't count."""
    return df.filter(~F.coalesce((basis == people) & vacant, F.lit(False)))


def outside_domains(df: DataFrame, domains: Mapping[str, Sequence[str]]) -> DataFrame:
    """`column, value, n` of values outside a column's domain, in one pass; null isn't outside."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.when(~F.col(c).isin(list(d)), F.col(c).cast("string")).alias("value")) for c, d in domains.items()])
    return df.select(F.explode(cells).alias("_c")).select("_c.*").filter("value is not null").groupBy("column", "value").agg(F.count("*").alias("n"))


def only_words_of(c: Column, vocabulary: Sequence[str]) -> Column:
    """Whether a text has words and all of them are in the vocabulary (null: no)."""
    words = F.filter(F.split(F.coalesce(c, F.lit("")), r"\s+"), lambda w: w != "")
    return (F.size(words) > 0) & F.forall(words, lambda w: w.isin(list(vocabulary)))


def without(df: DataFrame, confirmed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows that aren't confirmed as excluded; identity is exact, nulls being equal to nulls."""
    named = confirmed.select(*[F.col(k).alias(f"_x{i}") for i, k in enumerate(keys)]).distinct()
    cond = F.lit(True)
    for i, k in enumerate(keys):
        cond = cond & F.col(k).eqNullSafe(F.col(f"_x{i}"))
    return df.join(named, cond, "left_anti")


def without_bare_labels(df: DataFrame, by: Sequence[str], order: Sequence[str], label: str, rest: Sequence[str]) -> DataFrame:
    """Rows but those with a label and nothing else, with the `ordinal` (from 1) they had before."""
    d = number_within(df, by, order, "ordinal")
    return d.filter(F.col(label).isNull() | F.coalesce(*[F.col(c).cast("string") for c in rest]).isNotNull())


def blanked(df: DataFrame, key: Sequence[str], columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The rows with unreadable cells (control characters) null, and a row of evidence for each: `key..., column, escaped`."""
    bad = {c: F.coalesce(control_characters(F.col(c)), F.lit(False)) for c in columns}
    clean = df.withColumns({c: F.when(~b, F.col(c)) for c, b in bad.items()})
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.when(b, F.to_json(F.struct(F.col(c).alias("v")))).alias("_j")) for c, b in bad.items()])
    found = df.select(*key, F.explode(cells).alias("_e")).select(*key, "_e.*").filter("_j is not null")
    return clean, found.select(*key, "column", F.expr("substring(_j, 7, length(_j) - 8)").alias("escaped"))
