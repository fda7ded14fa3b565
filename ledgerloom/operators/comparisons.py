"""Weighted comparisons of two records, compiled to candidates, bounds and scores.

A comparison gives a score of 0 to 1 with a weight; a pair's score is the weighted mean. From the threshold follows what
each comparison has to reach at least, even if all others were perfect. One that has to reach something and has an
index drives: it proposes the pairs. The others are bounded first and scored last, on the pairs that can still pass.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.functions.similarity import similarity
from ledgerloom.functions.text import name_key, vetoed

#: Room for rounding in bounds.
EPS = 1e-9


@dataclass(frozen=True)
class Comparison:
    """column: of both sides. Subclasses say what is kept of a value, what vetoes a pair, the most it can score and its score."""

    column: str
    weight: float = 1.0

    def keep(self, c: Column) -> Column:
        return c

    def veto(self, l: Column, r: Column) -> Column:
        return F.lit(False)

    def most(self, l: Column, r: Column) -> Column:
        return F.lit(1.0)

    def score(self, l: Column, r: Column) -> Column:
        raise NotImplementedError

    def propose(self, l: DataFrame, r: DataFrame, on: Sequence[str], least: float) -> DataFrame | None:
        """`on..., l, r, score` of distinct pairs of kept values that can reach least (above 0); None without an index."""
        return None


@dataclass(frozen=True)
class Equal(Comparison):
    """1 for equal values, 0 for different ones and nulls."""

    def most(self, l, r):
        return self.score(l, r)

    def score(self, l, r):
        return F.coalesce(l == r, F.lit(False)).cast("double")

    def propose(self, l, r, on, least):
        same = r.select(*on, F.col("r").alias("l")).distinct()
        return l.select(*on, "l").distinct().join(same, [*on, "l"]).select(*on, "l", F.col("l").alias("r"), F.lit(1.0).alias("score"))


@dataclass(frozen=True)
class Close(Comparison):
    """1 for equal numbers, falling to 0 at a difference of width; 0 for nulls."""

    width: float = 1.0

    def most(self, l, r):
        return self.score(l, r)

    def score(self, l, r):
        return F.coalesce(F.greatest(F.lit(0.0), 1 - F.abs(l - r) / F.lit(float(self.width))), F.lit(0.0))

    def propose(self, l, r, on, least):
        """Numbers meet in cells of the width that least allows, and in the cells beside."""
        reach = max((1 - least) * self.width, EPS)
        cell = lambda c: F.floor(c / reach)
        left = l.select(*on, "l").distinct().withColumn("_cell", F.explode(F.sequence(cell(F.col("l")) - 1, cell(F.col("l")) + 1)))
        right = r.select(*on, "r").distinct().withColumn("_cell", cell(F.col("r")))
        s = self.score(F.col("l"), F.col("r"))
        return left.join(right, [*on, "_cell"]).select(*on, "l", "r", s.alias("score")).filter(F.col("score") >= least - EPS)


@dataclass(frozen=True)
class Name(Comparison):
    """Similarity of folded names; contradicting numbers or qualifiers veto a pair, an empty name scores 0."""

    def keep(self, c):
        key = name_key(c)
        return F.struct(key["folded"].alias("folded"), key["numbers"].alias("numbers"), key["directions"].alias("directions"))

    def veto(self, l, r):
        return vetoed(l, r)

    def most(self, l, r):
        return letters_allow(l["folded"], r["folded"])

    def score(self, l, r):
        return similarity(l["folded"], r["folded"])

    def propose(self, l, r, on, least):
        side = lambda d, a: d.select(*on, F.col(f"{a}.folded").alias("name")).distinct()
        pairs = name_candidates(side(l, "l"), side(r, "r"), on, least)
        scored = pairs.withColumn("score", similarity("l_name", "r_name")).filter(F.col("score") >= least - EPS)
        left = l.select(*on, "l").distinct().withColumn("l_name", F.col("l.folded")).join(scored, "l_name")
        right = r.select(*on, "r").distinct().withColumn("r_name", F.col("r.folded"))
        return left.join(right, [*on, "r_name"]).select(*on, "l", "r", "score")


def _bag(s: Column) -> Column:
    """How often each letter is in a folded name: 26 numbers."""
    return F.transform(F.array(*[F.lit(c) for c in "abcdefghijklmnopqrstuvwxyz"]), lambda c: F.char_length(s) - F.char_length(F.replace(s, c, F.lit(""))))


def letters_allow(a: Column, b: Column) -> Column:
    """What the similarity of two folded names can be at most: no common subsequence is longer than the letters they share."""
    x, y = _bag(a), _bag(b)
    shared = F.zip_with(x, y, lambda m, n: F.least(m, n))
    total = lambda v: F.aggregate(v, F.lit(0), lambda s, n: s + n)
    bare = lambda v: F.filter(v, lambda _, i: ~i.isin(0, 4, 8, 14, 20))  # noqa: E731  without a, e, i, o, u
    ratio = lambda v, n: F.coalesce(F.try_divide(2.0 * total(v), n), F.lit(1.0))
    whole = ratio(shared, F.char_length(a) + F.char_length(b))
    return F.when((a == "") | (b == ""), 0.0).otherwise(F.greatest(whole, ratio(bare(shared), total(bare(x)) + total(bare(y))) - 0.05))


def gram_length(least: float) -> int:
    """The longest grams (5 at most) of which two texts with a ratio of least always share one.

    A common subsequence of at least least / 2 of both lengths leaves out few letters; one left out of the first text costs
    q of its grams at most, one left out of the second q - 1. Both extremes of the other's length are within these bounds.
    """
    return max([1, *[q for q in range(2, 6) if q * (2 - 2 * least) <= 2 - least + EPS and (q - 1) * (2 - 2 * least) <= least + EPS]])


def _postings(names: DataFrame, least: float, q: int, order: DataFrame | None) -> DataFrame:
    """`name, n, gram, at` of the grams (with a frame of q - 1 marks) of a text that a partner has to share one of.

    order: gram counts; the rarest grams are posted, as many as can be lost, and one more. None: all grams.
    """
    n, text = F.char_length("text"), F.concat(F.lit("^" * (q - 1)), F.col("text"), F.lit("$" * (q - 1)))
    grams = F.when(n == 0, F.array(F.lit(""))).otherwise(F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), n + q - 1)), lambda i: F.substring(text, i, q)))
    rows = names.select("name", n.alias("n"), F.posexplode(grams).alias("at", "gram"))
    if order is None:
        return rows
    n = F.col("n")
    short, long = n * (least / (2 - least)), n * ((2 - least) / least)
    lost = F.greatest(q * (n - short), (q - 1) * (long - n))
    share = F.greatest(F.lit(1), n + q - 1 - F.floor(lost + EPS))
    place = F.rank().over(Window.partitionBy("name").orderBy("count", "gram"))  # equal grams share a place: all or none is posted
    return rows.join(order, "gram").withColumn("_place", place).filter(F.col("_place") <= F.greatest(F.lit(1), n + q - share)).drop("_place", "count")


def name_candidates(left: DataFrame, right: DataFrame, on: Sequence[str], least: float) -> DataFrame:
    """`l_name, r_name`: distinct pairs of folded names of one block whose similarity can be least (above 0) or more.

    left, right: `on..., name`. Whole names, and names without vowels at five points more, are looked up in an inverted
    index of grams: prefixes of the rarest grams, bounds on lengths and on shifts of position. Then letters are counted.
    """
    found = None
    for text, t in ((F.col("name"), least), (F.regexp_replace("name", "[aeiou]", ""), least + 0.05)):
        if t > 1 + EPS:
            continue
        q = gram_length(t)
        side = lambda d, text=text: d.filter("name <> ''").select("name").distinct().withColumn("text", text)
        ls, rs = side(left), side(right)
        order = _postings(ls, t, q, None).unionAll(_postings(rs, t, q, None)).groupBy("gram").agg(F.count("*").alias("count"))
        posted = lambda d, s, a, q=q, t=t, order=order: d.select(*on, "name").distinct().join(_postings(s, t, q, order), "name").withColumnsRenamed({"name": f"{a}_name", "n": f"{a}_n", "at": f"{a}_at"})
        a, b = F.col("l_n"), F.col("r_n")
        near = (F.least(a, b) >= F.greatest(a, b) * (t / (2 - t)) - EPS) & (F.abs(F.col("l_at") - F.col("r_at")) <= F.greatest(a, b) - (a + b) * (t / 2) + EPS)
        pairs = posted(left, ls, "l").join(posted(right, rs, "r"), [*on, "gram"]).filter(near).select("l_name", "r_name")
        found = pairs if found is None else found.unionAll(pairs)
    if found is None:
        return left.join(right, list(on), "left_semi").limit(0).select(F.col("name").alias("l_name"), F.col("name").alias("r_name"))
    return found.distinct().filter(letters_allow(F.col("l_name"), F.col("r_name")) >= least - EPS)


def least_scores(comparisons: Sequence[Comparison], threshold: float) -> list[float]:
    """What each comparison has to score in a pair that passes, if all others score 1."""
    total = sum(c.weight for c in comparisons)
    return [(threshold * total - (total - c.weight)) / c.weight for c in comparisons]


def compare(left: DataFrame, right: DataFrame, block: Sequence[str], key: str, comparisons: Sequence[Comparison], threshold: float, allowed: DataFrame | None = None) -> DataFrame:
    """`block..., left, right, <column>_score..., score` of the pairs of a block without a veto that reach the threshold.

    allowed: pairs of blocks to compare, `block...` of the left and `right_<block>...` of the right side; the result has
    the left's. Without it a block meets its equal. Null blocks meet nothing. It is an error if no comparison narrows the
    pairs: every pair of a block would have to be scored.
    """
    needs = least_scores(comparisons, threshold)
    side = lambda d, a: d.select(*block, F.col(key).alias(f"_{a}"), *[c.keep(F.col(c.column)).alias(f"{a}{i}") for i, c in enumerate(comparisons)])
    l, r, on = side(left, "l"), side(right, "r"), list(block)
    if allowed is not None:
        l = l.join(allowed.select(*block, *[f"right_{b}" for b in block]).distinct(), list(block))
        r = r.withColumnsRenamed({b: f"right_{b}" for b in block})
        on = [f"right_{b}" for b in block]
    for d, c in enumerate(comparisons):
        if needs[d] > EPS and (pairs := c.propose(l.withColumnRenamed(f"l{d}", "l"), r.withColumnRenamed(f"r{d}", "r"), on, needs[d])) is not None:
            break
    else:
        raise ValueError("no comparison narrows the pairs of a block: raise the threshold or a weight")
    pairs = pairs.withColumnsRenamed({"l": f"l{d}", "r": f"r{d}", "score": f"_s{d}"})
    met = l.join(pairs, [*on, f"l{d}"]).join(r, [*on, f"r{d}"])
    of = lambda f, i: f(F.col(f"l{i}"), F.col(f"r{i}"))
    total = sum(c.weight for c in comparisons)
    for i, c in enumerate(comparisons):
        met = met.filter(~of(c.veto, i))
    can = sum((F.col(f"_s{i}") if i == d else of(c.most, i)) * c.weight for i, c in enumerate(comparisons)) / total
    met = met.filter(can >= threshold - EPS)
    for i, c in enumerate(comparisons):
        if i != d:
            met = met.withColumn(f"_s{i}", of(c.score, i))
    score = sum(F.col(f"_s{i}") * c.weight for i, c in enumerate(comparisons)) / total
    names = [F.col(f"_s{i}").alias(f"{c.column}_score") for i, c in enumerate(comparisons)]
    return met.withColumn("score", score).filter(F.col("score") >= threshold - EPS).select(*block, F.col("_l").alias("left"), F.col("_r").alias("right"), *names, "score")
