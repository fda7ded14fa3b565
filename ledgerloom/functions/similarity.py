"""String similarities and Unicode forms that Spark has no built-in for, as Arrow-batched UDFs over distinct pairs."""

from __future__ import annotations

import difflib
import re
import unicodedata

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def indel_ratio(a: str, b: str) -> float:
    """2 * LCS / (|a| + |b|), by bit-parallel dynamic programming; two empty texts are equal."""
    if not a or not b:
        return float(a == b)
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & where.get(c, 0)
        row = (row + hit | row - hit) & full
    return 2 * (len(a) - row.bit_count()) / (len(a) + len(b))


def name_similarity(a: str | None, b: str | None) -> float:
    """The larger of the indel ratio and, five points less, that of the names without vowels; 0 if a name is empty.

    Two names of vowels alone have equal skeletons (empty), which count .95.
    """
    if not a or not b:
        return 0.0
    bare = [re.sub("[aeiou]", "", x) for x in (a, b)]
    return max(indel_ratio(a, b), indel_ratio(*bare) - 0.05)


@F.pandas_udf(T.DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([name_similarity(x, y) for x, y in zip(a, b, strict=True)])


@F.pandas_udf(T.DoubleType())
def block_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp ratio of the letters of two texts."""
    only = lambda s: re.sub("[^a-z]", "", (s or "").lower())
    return pd.Series([difflib.SequenceMatcher(None, only(x), only(y), autojunk=False).ratio() for x, y in zip(a, b, strict=True)])


@F.pandas_udf(T.StringType())
def nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x))


@F.pandas_udf(T.StringType())
def composed(s: pd.Series) -> pd.Series:
    """NFC."""
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFC", x))


@F.pandas_udf(T.StringType())
def name_anchor(s: pd.Series) -> pd.Series:
    """NFC, case-folded and squashed; null for texts with control characters."""

    def anchor(x):
        if x is None or any(unicodedata.category(c) == "Cc" for c in x):
            return None
        return " ".join(unicodedata.normalize("NFC", x).casefold().split()) or None

    return s.map(anchor)
