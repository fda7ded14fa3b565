"""Comparisons, candidates and assignments against brute force."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions.similarity import name_similarity
from ledgerloom.operators import assignment, comparisons
from ledgerloom.operators.assignment import auction, best_pairs, components, one_to_one
from ledgerloom.operators.comparisons import Close, Equal, Name, compare, name_candidates
from ledgerloom.operators.linkage import link_in_passes
from ledgerloom.operators.state import shared_folder


def names(n, seed, least=0, most=14):
    rnd = random.Random(seed)
    out = set()
    while len(out) < n:
        w = "".join(rnd.choice("abdeiklmnorstu") for _ in range(rnd.randint(least, most)))
        out |= {w, w[1:], w.replace("a", "e", 1), w[:3] + rnd.choice("aknr") + w[3:]}
    return sorted(out)


@pytest.mark.parametrize("least", [0.85, 0.7, 0.6, 0.2])
def test_candidates_against_brute_force(spark, least):
    left, right = names(80, 1), names(80, 2) + ["a", "io", "aeiou", "", "rst"]
    frame = lambda v: spark.createDataFrame([(1, x) for x in v], "b int, name string")
    got = {(r.l_name, r.r_name) for r in name_candidates(frame(left), frame(right), ["b"], least).collect()}
    want = {(a, b) for a in left for b in right if a and b and name_similarity(a, b) >= least}
    assert want <= got and len(want) > 0


def test_candidates_are_few(spark):
    """Names like places' names: the index proposes few of all pairs, and lengths and letters drop most of those."""
    rnd = random.Random(4)
    parts = ["".join(rnd.choice("bcdghjklmnprstv") + rnd.choice("aeiou") for _ in range(rnd.randint(2, 4))) for _ in range(200)]
    words = sorted({rnd.choice(parts) + rnd.choice(["", "pur", "garh", "nagar"]) + rnd.choice(parts)[:4] for _ in range(500)})
    frame = spark.createDataFrame([(1, w) for w in words], "b int, name string")
    got = name_candidates(frame, frame, ["b"], 0.8).count()
    assert got < 0.05 * len(words) ** 2


def test_gram_length():
    assert [comparisons.gram_length(t) for t in (0.95, 0.85, 0.8, 0.7, 0.6, 0.1)] == [5, 3, 3, 2, 1, 1]


def test_bounds_hold(spark):
    rows = [(a, b) for a in names(40, 7) for b in names(40, 8)]
    d = spark.createDataFrame(rows, "a string, b string").select("a", "b", comparisons.letters_allow(F.col("a"), F.col("b")).alias("most"))
    assert all(name_similarity(r.a, r.b) <= r.most + 1e-9 for r in d.collect())


KINDS = "id int, b string, name string, size int, height double"


def people(n, seed):
    rnd = random.Random(seed)
    words = ["rampur", "kalan", "bahu", "bhau", "rampura", "kheri", "kheda", "nagar", "nagla", "io"]
    return [(i, rnd.choice(["x", "y", None]), " ".join(rnd.sample(words, rnd.randint(1, 2))), rnd.choice([1, 2, None]), rnd.choice([1.0, 1.5, 3.0])) for i in range(n)]


@pytest.mark.parametrize("kind", ["name", "three", "equal drives", "close drives"])
def test_compare_against_brute_force(spark, kind):
    left, right = people(25, 1), people(25, 2)
    chosen, threshold = {"name": ([Name("name")], 0.8), "three": ([Name("name", 2.0), Equal("size"), Close("height", 1.0, 2.0)], 0.8), "equal drives": ([Equal("size", 3.0), Close("height", 1.0, 1.0)], 0.9), "close drives": ([Close("height", 1.0, 2.0)], 0.7)}[kind]
    fold = {r.name: r.k for r in spark.createDataFrame(left + right, KINDS).select("name", Name("name").keep(F.col("name")).alias("k")).collect()}

    def score(a, b):
        total = 0.0
        for c in chosen:
            if isinstance(c, Name):
                total += c.weight * name_similarity(fold[a[2]].folded, fold[b[2]].folded)
            elif isinstance(c, Equal):
                total += c.weight * (a[3] is not None and a[3] == b[3])
            else:
                total += c.weight * max(0.0, 1 - abs(a[4] - b[4]) / c.width)
        return total / sum(c.weight for c in chosen)

    want = {(a[0], b[0]): s for a in left for b in right if a[1] is not None and a[1] == b[1] and (s := score(a, b)) >= threshold - 1e-9}
    got = compare(spark.createDataFrame(left, KINDS), spark.createDataFrame(right, KINDS), ["b"], "id", chosen, threshold)
    assert {(r.left, r.right): r.score for r in got.collect()} == pytest.approx(want) and want


def test_compare_needs_an_index(spark):
    d = spark.createDataFrame(people(3, 1), KINDS)
    with pytest.raises(ValueError, match="narrows"):
        compare(d, d, ["b"], "id", [Name("name"), Equal("size")], 0.5)


def optimum(pairs):
    """The greatest total over all assignments."""
    by = {}
    for a, b, s in pairs:
        by.setdefault(a, []).append((b, s))
    order = sorted(by)

    def best(i, used):
        if i == len(order):
            return 0.0
        return max([best(i + 1, used), *[s + best(i + 1, used | {b}) for b, s in by[order[i]] if b not in used]])

    return best(0, frozenset())


def test_auction_against_brute_force(spark):
    """Ties, rivals for few objects, chains and records that stay alone."""
    rnd = random.Random(2)
    pairs = [(f"a{i}", f"b{j}", rnd.choice([0.8, 0.8, 0.9, 1.0])) for i, j in itertools.product(range(6), range(4)) if rnd.random() < 0.5]
    got = [tuple(r) for r in auction(spark.createDataFrame(pairs, "left string, right string, score double"), 20).collect()]
    assert len({a for a, _, _ in got}) == len({b for _, b, _ in got}) == len(got) and set(got) <= set(pairs)
    assert sum(s for _, _, s in got) == pytest.approx(optimum(pairs))


def test_components(spark):
    edges = [(f"n{i:03}", f"n{i + 1:03}") for i in range(40) if i % 10] + [("z", "a"), ("a", "z"), ("q", "q")]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert got == {f"n{i:03}": f"n{(i - 1) // 10 * 10 + 1:03}" for i in range(1, 41)} | {"a": "a", "z": "a", "q": "q"}


def test_one_to_one_sizes(spark):
    """The same totals whether blocks, components or bids decide; repeated pairs count once."""
    rnd = random.Random(6)
    rows = [(b, i, j, rnd.choice([0.8, 0.85, 0.9, 1.0])) for b in ("x", "y", None) for i in range(6) for j in range(6) if rnd.random() < 0.35]
    rows += [("x", 100 + i, 100 + i, 0.9) for i in range(3)]
    pairs = spark.createDataFrame([*rows, rows[0]], "b string, left int, right int, score double")
    want = sum(optimum([r[1:] for r in rows if r[0] == b]) for b in ("x", "y", None))
    for local, units in ((1000, 1), (8, 20)):
        got = one_to_one(pairs, ["b"], local, units).collect()
        assert sum(r.score for r in got) == pytest.approx(want)
        assert len({(r.b, r.left) for r in got}) == len({(r.b, r.right) for r in got}) == len(got)
    assert one_to_one(pairs.limit(0), ["b"]).count() == 0


def test_one_to_one_by_auction(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(assignment, "auction", lambda p, u: asked.append(p.count()) or auction(p, u))
    pairs = spark.createDataFrame([("x", i, j, 1.0 if i == j else 0.8) for i in range(3) for j in range(3)], "b string, left int, right int, score double")
    assert {(r.left, r.right) for r in one_to_one(pairs, ["b"], 4, 5).collect()} == {(i, i) for i in range(3)} and asked == [9]


def test_link_in_passes(spark):
    a = spark.createDataFrame([(1, "x", "Rampur Kalan", 5, 1.0), (2, "x", "Bahu", 9, 1.0), (3, "x", "Kheri", 4, 1.0)], KINDS)
    b = spark.createDataFrame([(11, "x", "Rampur Kalan", 5, 1.0), (12, "x", "Kherda", 4, 9.0), (13, "x", "zzz", 9, 1.1)], KINDS)
    got = link_in_passes(a, b, ["b"], "id", [("name", [Name("name")], 0.95), ("size", [Name("name"), Equal("size")], 0.85), ("rest", [Equal("size", 3.0), Close("height", 1.0, 2.0)], 0.9)])
    assert {(r["left"], r["right"], r["pass"]) for r in got.collect()} == {(1, 11, "name"), (3, 12, "size"), (2, 13, "rest")}


def test_classes_against_single_records():
    """Classes of many records: as good as the matrix of all their records, and the matrix gives what the pairs give."""
    import numpy as np
    import pandas as pd

    rnd = random.Random(12)
    for most in (1, 4, 4, 7) * 10:
        k, m = [rnd.randint(1, most) for _ in range(4)], [rnd.randint(1, most) for _ in range(5)]
        pairs = [(i, j, rnd.choice([0.8, 0.85, 0.9, 1.0]), k[i], m[j]) for i in range(4) for j in range(5) if rnd.random() < 0.6]
        got = best_pairs(pd.DataFrame(pairs, columns=["left", "right", "score", "n_left", "n_right"]))
        for side, own in (("left", k), ("right", m)):
            assert all(n <= own[i] for i, n in got.groupby(side)["n"].sum().items())
        gain = np.zeros((sum(k), sum(m) + sum(k)))
        for i, j, s, _, _ in pairs:
            gain[sum(k[:i]) : sum(k[: i + 1]), sum(m[:j]) : sum(m[: j + 1])] = s
        assert (got["score"] * got["n"]).sum() == pytest.approx(sum(gain[i, j] for i, j in enumerate(assignment.assign(-gain))))


def test_equal_records_are_compared_once(spark, monkeypatch):
    """Many records of few names: pairs of names are assigned, all records that can be are linked, and each once."""
    from ledgerloom.operators import linkage

    asked = []
    monkeypatch.setattr(linkage, "one_to_one", lambda p, b: asked.append(p.count()) or one_to_one(p, b))
    monkeypatch.setattr(linkage, "RUN", 7)
    a = spark.createDataFrame([(2 * i, "x", "Rampur" if i < 60 else "Kheri", i % 3 or None) for i in range(80)], "id int, b string, name string, size int")
    b = spark.createDataFrame([(2 * i + 1, "x", "Rampura" if i < 30 else "Rampur" if i < 50 else "Kheri", i % 3 or None) for i in range(90)], "id int, b string, name string, size int")
    got = link_in_passes(a, b, ["b"], "id", [("name", [Name("name")], 0.85), ("size", [Name("name"), Equal("size")], 0.85)]).collect()
    assert asked[0] == 3 and max(asked) <= 9
    assert len({r["left"] for r in got}) == len({r["right"] for r in got}) == len(got) == 70
    assert sorted(r["left"] for r in got if r["score"] == 1) == [*range(60, 100, 2), *range(120, 160, 2)]
    assert {(r["b"], r["pass"]) for r in got} == {("x", "name")}


@pytest.mark.parametrize("local", [1000, 1])
def test_counted_classes_in_blocks(spark, local):
    """The same totals whether blocks or bids of single records decide."""
    rows = [("x", 1, 11, 0.8, 3, 2), ("x", 1, 12, 0.9, 3, 2), ("x", 2, 12, 1.0, 1, 2), ("y", 1, 11, 0.9, 2, 5)]
    got = one_to_one(spark.createDataFrame(rows, "b string, left int, right int, score double, n_left long, n_right long"), ["b"], local, 10).collect()
    assert {(r["b"], r["left"], r["right"]): r["n"] for r in got} == {("x", 1, 11): 2, ("x", 1, 12): 1, ("x", 2, 12): 1, ("y", 1, 11): 2}


def test_solver_ties():
    import pandas as pd

    out = best_pairs(pd.DataFrame([(1, 1, 0.9), (1, 2, 0.9), (2, 1, 0.9)], columns=["left", "right", "score"]))
    assert sorted(zip(out["left"], out["right"], strict=True)) == [(1, 2), (2, 1)]


def test_shared_folder(spark):
    assert shared_folder(spark).startswith("file:")
