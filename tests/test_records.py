"""Markup by depth, printed layouts, gates, review rules, rates and folds, and streams of attempts, on exact fixtures."""

import hashlib
import random
import shutil
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import gates as G
from ledgerloom.operators import inference
from ledgerloom.operators import review_rules as R
from ledgerloom.operators.layout import Layout, layout_holds, layout_rows, open_levels
from ledgerloom.sources import markup as M
from ledgerloom.streaming import attempts as S

NESTED = """<p>before</p><TABLE id="a"><tr class=x><th colspan="2" Title='A > B'>Head &amp; more</th></tr>
<tr><td data-x data-x="2">one<br>two<table><tr><td>inner</td></tr><tr><td>inner2</td><td></td></tr></table> three</td><td>  b  </td></tr></TABLE>
<!-- <table> --><script>var t = "<table>";</script><table><tr><td>z</td></tr></table>"""


def test_nested_tables(spark):
    d = spark.createDataFrame([(1, NESTED), (2, None), (3, "no table")], "id int, html string")
    got = sorted((r.table, r.depth, r.row, r.column, r.tag, tuple(sorted(r.attrs.items())), r.text) for r in M.table_cells(d, "html", ["id"]).collect())
    assert got == [
        (1, 1, 0, 0, "th", (("colspan", "2"), ("title", "A > B")), "Head & more"),
        (1, 1, 1, 0, "td", (("data-x", "2"),), "one two three"),
        (1, 1, 1, 1, "td", (), "b"),
        (2, 2, 0, 0, "td", (), "inner"),
        (2, 2, 1, 0, "td", (), "inner2"),
        (2, 2, 1, 1, "td", (), ""),
        (3, 1, 0, 0, "td", (), "z"),
    ]


BROKEN = {
    "<table><tr><td>a</td></tr>": "tables not closed",
    "</table>": "a table closed that isn't open",
    "<table><td>a</td></table>": "a cell outside a row",
    "<table><tr><td>a<td>b</td></td></tr></table>": "a cell within a cell",
    "<table><tr><td>a</td></table>": "rows not closed",
    "<table><tr><td>a</tr></table>": "cells not closed",
    "<table><tr><tr><td>a</td></tr></tr></table>": "a row within a row",
}


def test_broken_tables(spark):
    d = spark.createDataFrame([(h,) for h in [*BROKEN, NESTED, ""]], "html string").withColumn("id", F.col("html"))
    assert {r.id: r.problem for r in M.table_problems(d, "html", ["id"]).collect()} == BROKEN
    with pytest.raises(Exception, match="markup: tables not closed"):
        M.table_cells(d.filter("id = '<table><tr><td>a</td></tr>'"), "html", ["id"]).collect()
    assert M.table_cells(d, "html", ["id"], strict=False).filter("text = 'a'").count() >= 5


HREFS = ["x", "./x", "../x", "../../../x/", "/r/./s/../t", "//other/p", "?q=2", "http://h/p/../q", "a/b/..", "x?y=../z", "sub/x#f", "mailto:a@b"]


@pytest.mark.parametrize("base", ["http://h.org/a/b/c.html?q=1", "https://h.org", "http://h.org/a/"])
def test_joined_url(spark, base):
    d = spark.createDataFrame([(base, h) for h in HREFS], "base string, href string")
    assert {r.href: r.url for r in d.select("href", M.joined_url(F.col("base"), F.col("href")).alias("url")).collect()} == {h: urljoin(base, h) for h in HREFS}


def test_region_links(spark):
    page = """<a href="early">no</a><h1>First</h1><a href="one">One <b>bold</b></a><a href="#top">no</a><a href='mailto:x@y'>no</a>
    <h2>Second &amp; last</h2><a class="k" href="/two?a=1&amp;b=2">Two</a><h4>not one</h4><a href="three"></a><a>none</a><h2><a href="in">in heading</a></h2><a href="four">4<footer><a href="late">no</a>"""
    d = spark.createDataFrame([(1, page, "http://h/d/p"), (2, None, "http://h")], "id int, html string, url string")
    got = [tuple(r) for r in M.region_links(d, "html", "url", ["id"]).orderBy("at").select("href", "url", "label", "heading").collect()]
    assert got == [("one", "http://h/d/one", "One bold", "First"), ("/two?a=1&b=2", "http://h/two?a=1&b=2", "Two", "Second & last"), ("three", "http://h/d/three", "", "Second & last"), ("in", "http://h/d/in", "in heading", "Second & last"), ("four", "http://h/d/four", "4", "Second & last")]


TEXT = """TITLE OF THE TABLE
  NAME      A    B
AMBALA
 1 Barara        10   5.5
   East
   Side
 2. Naraingarh   07   -
junk 12
   TOTAL         17   5.5
\f
KARNAL
 1 Gharaunda     3    1
   lost 4 5
  no serial      9    9

 GRAND
 TOTAL OF
 THE STATE      20   6
"""


def test_layout(spark):
    layout = Layout(["a", "b"], heading="AMBALA|KARNAL", skip=r"NAME\s+A\s+B", decimals=["b"])
    d = spark.createDataFrame([("f", TEXT), ("none", None), ("empty", "")], "file string, text string")
    rows = layout_rows(d, "file", "text", layout).orderBy("page", "line").collect()
    assert [(r.page, r.line, r.level, r.heading, r.serial, r.label) for r in rows] == [(1, 4, "item", "AMBALA", 1, "Barara East Side"), (1, 7, "item", "AMBALA", 2, "Naraingarh"), (1, 9, "group", "AMBALA", None, "TOTAL"), (2, 3, "item", "KARNAL", 1, "Gharaunda"), (2, 9, "all", None, None, "THE STATE")]
    assert [(c.metric, c.raw, c.value, c.hold) for c in rows[1].cells] == [("a", "07", None, "leading_zero"), ("b", "-", None, "dash")] and rows[1].flags == ["a:leading_zero", "b:dash"]
    assert [(c.value, c.start, c.end) for c in rows[0].cells] == [(10.0, 18, 20), (5.5, 23, 26)] and rows[0].lines == [4, 5, 6]
    holds = [(r.page, r.line, r.reason) for r in layout_holds(d, "file", "text", layout).orderBy("page", "line").collect()]
    assert holds == [(1, 8, "unparsed_body_line"), (2, 4, "unresolved_row_level"), (2, 5, "unresolved_row_level")]


def test_open_levels(spark):
    rows = [(1, 1, "A"), (2, 2, "a"), (3, 3, "x"), (4, 3, "y"), (5, 2, "b"), (6, None, None), (7, 1, "B"), (8, 3, "z"), (9, 2, "c")]
    d = spark.createDataFrame([("f", *r) for r in rows], "f string, i int, level int, v string")
    got = [(r.i, r.open_1, r.open_2, r.open_3) for r in open_levels(d, "f", ["i"], "level", "v", 3).orderBy("i").collect()]
    want, stack = [], {}
    for i, level, v in rows:
        if level:
            stack = {k: x for k, x in stack.items() if k < level} | {level: v}
        want.append((i, stack.get(1), stack.get(2), stack.get(3)))
    assert got == want


def test_gates(spark):
    rows = [(y, b, i, p, w) for y in (1, 2) for b in "pqr" for i, p, w in [(1, "x", True), (2, "x", False), (3, None, None)]] + [(2, "p", 5, "x", True), (2, "s", 1, "x", True)]
    d = spark.createDataFrame(rows, "year int, block string, no int, place string, woman boolean")
    official = spark.createDataFrame([(1, 9, "seats", None), (2, 12, "elected", 7)], "year int, seats int, basis string, blocks int")
    gates = [
        G.Coverage("seats", False, F.lit(True), "seats", 0.97, "basis", F.col("place").isNull()),
        G.GroupCount("blocks", False, "blocks", 2),
        G.AtMost("blank places", True, F.col("place").isNull(), 3),
        G.Share("women", True, F.col("woman"), F.col("woman").isNotNull(), 50.0, "near", 3.0),
        G.Share("few", True, F.col("no") > 4, F.lit(True), 5.0, "below"),
        G.GroupsOff("by block", True, F.col("woman"), F.col("woman").isNotNull(), 50.0, 6.0, 0.3),
        G.Numbered("numbers", False, "no"),
    ]
    excused = spark.createDataFrame([(2, "s")], "year int, block string")
    got = {(r.year, r.check): (r.ok, r.found, r.wanted, r.hard) for r in G.evaluate(d, gates, ["year"], ["block"], official, excused).collect()}
    assert got[1, "seats"] == (True, 9.0, 9.0, False) and got[2, "seats"] == (False, 8.0, 12.0, False)
    assert got[1, "blocks"][0] and got[2, "blocks"] == (False, 4.0, 7.0, False)
    assert got[1, "blank places"] == got[2, "blank places"] == (True, 3.0, 3.0, True)
    assert got[1, "women"][:2] == (True, 50.0) and got[2, "women"][:2] == (False, 62.5)
    assert got[1, "few"][0] and not got[2, "few"][0]
    assert got[1, "by block"][:2] == (True, 0.0) and got[2, "by block"] == (True, 1.0, 1.2, True)  # p is off; s is excused
    assert got[1, "numbers"][0] and got[2, "numbers"][:2] == (False, 1.0)
    assert G.evaluate(d.limit(0), gates, ["year"], ["block"], official).count() == 0


def test_review_rules(spark):
    rows = spark.createDataFrame([(1, "a", None, 5), (2, "b", "o", 6), (3, "c", "o", 7), (3, "c2", "o", 7)], "k int, cell string, office string, page int").withColumn("flags", F.array(F.lit("held")))
    sha = hashlib.sha256(b"proof").hexdigest()
    good = [(1, "a", "new", "12,3", "WOMEN", True, "proof", sha, 5), (2, "b", "new", "1,2", "MEN", False, "proof", sha.upper(), 6)]
    bad = [(9, "a", "new", "1,2", "MEN", False, "proof", sha, 5), (3, "c", "", "x", "MEN", True, "other", sha, 9), (2, "zz", "new", "1,2", "ELSE", False, "proof", None, 6), (2, "b", "old", "1,2", "MEN", False, "proof", sha, 6)]
    kinds = "k int, seen_cell string, value string, at string, literal string, woman boolean, evidence string, sha string, seen_page int"
    rules = [
        R.Stated("blank", ["value"]),
        R.Pattern("coordinates", "at", r"\d+,\d+"),
        R.OneOf("value unknown", "value", ["new", "newer"], when=F.col("value") != ""),
        R.Literal("category", "literal", {"WOMEN": {"woman": True}, "MEN": {"woman": False}}),
        R.Digest("evidence", "sha", "evidence"),
        R.Holds("other page", F.col("seen_page") == F.col("row_page")),
    ]
    got = {}
    for r in R.check_reviews(rows, spark.createDataFrame(bad, kinds), ["k"], rules).collect():
        got.setdefault(r.k, []).append(list(r.violations))
    assert got == {9: [["no row", "other page"]], 3: [["several rows", "blank", "coordinates", "category", "evidence", "other page"]], 2: got[2]}
    assert sorted(got[2]) == [["several reviews", "category", "evidence"], ["several reviews", "value unknown"]]
    with pytest.raises(R.ReviewError, match="4 reviews break rules"):
        R.apply_reviews(rows, spark.createDataFrame(good[:1] + bad, kinds), ["k"], rules, ["cell"], {"office": F.col("value")})
    out = R.apply_reviews(rows, spark.createDataFrame(good, kinds), ["k"], rules, ["cell"], {"office": F.col("value")}, "flags", ["reviewed"], ["held"])
    assert {(r.k, r.cell, r.office, r.office_before, tuple(r.flags)) for r in out.collect()} == {(1, "a", "new", None, ("reviewed",)), (2, "b", "new", "o", ("reviewed",)), (3, "c", "o", None, ("held",)), (3, "c2", "o", None, ("held",))}
    with pytest.raises(R.ReviewError, match="guard differs"):
        R.apply_reviews(rows, spark.createDataFrame([(1, "zz", *good[0][2:])], kinds), ["k"], rules, ["cell"], {"office": F.col("value")})


def test_smoothed_rates(spark):
    rnd = random.Random(1)
    rows = [(rnd.choice("abcd"), rnd.randrange(3), rnd.choice([0, 1, 1, None])) for _ in range(60)] + [("e", 0, 1), ("e", 0, 0)]
    d = spark.createDataFrame(rows, "g string, fold int, hit int")
    got = {(r.g, r.fold): (r.n, r.rate) for r in inference.smoothed_rates(d, "g", "fold", F.col("hit"), 5.0, 3).collect()}
    for (g, fold), (n, rate) in got.items():
        own = [h for x, f, h in rows if x == g and f != fold and h is not None]
        others = [h for _, f, h in rows if f != fold and h is not None]
        assert n == len(own)
        assert rate == (pytest.approx((sum(own) + 5 * sum(others) / len(others)) / (len(own) + 5)) if n >= 3 else None)
    assert got["e", 0] == (0, None)


@pytest.mark.parametrize("seed", [1, 2])
def test_greedy_folds(spark, seed):
    rnd = random.Random(seed)
    sizes = {f"g{i}": rnd.choice([1, 1, 1, 1, 2, 3, 5, 9, 40]) for i in range(120)}
    d = spark.createDataFrame([(g,) for g, n in sizes.items() for _ in range(n)], "g string")
    got = {r.g: r.fold for r in inference.greedy_folds(d, "g", 7).collect()}
    assert set(got) == set(sizes)
    loads = [0] * 7
    for n in sorted(sizes.values(), reverse=True):
        loads[loads.index(min(loads))] += n
    assert sorted(sum(sizes[g] for g, f in got.items() if f == k) for k in range(7)) == sorted(loads)
    runs = inference.lightest_first({1: 10**9, 7: 3}, 5)
    assert len(runs) < 50


def test_attempts(spark, tmp_path):
    """Restarts and re-read pages give one row a page; a late reading of an older attempt changes nothing."""
    source, out, check = f"{tmp_path}/in", f"file://{tmp_path}/out", f"file://{tmp_path}/check"
    schema = spark.createDataFrame([], "page int, attempt int, status string, text string").schema
    put = lambda rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
    put([(1, 1, "ok", "a"), (2, 1, "failed", None)])
    assert S.run_attempts(spark, source, schema, ["page"], ["attempt"], check, out) == 1
    assert S.run_attempts(spark, source, schema, ["page"], ["attempt"], check, out) == 0
    put([(2, 2, "ok", "b"), (3, 1, "ok", "c")])
    put([(1, 0, "ok", "old")])
    S.run_attempts(spark, source, schema, ["page"], ["attempt"], check, out, files=1)
    want = {(1, 1, "ok", "a", 2), (2, 2, "ok", "b", 2), (3, 1, "ok", "c", 1)}
    assert {tuple(r) for r in S.current(spark, out, ["page"]).collect()} == want
    assert S.in_progress(spark, out) == []
    shutil.copytree(next(tmp_path.glob("out/batch=0")), tmp_path / "out" / "batch=99")  # a run that died before its receipt
    assert S.in_progress(spark, out) == ["batch=99"] and {tuple(r) for r in S.current(spark, out, ["page"]).collect()} == want


def test_lease(spark, tmp_path):
    root, clock = f"file://{tmp_path}/held", [100.0]
    with S.Lease(spark, root, 10, lambda: clock[0]):
        with pytest.raises(S.LeaseHeld):
            S.Lease(spark, root, 10, lambda: clock[0]).__enter__()
        clock[0] = 111.0
        with S.Lease(spark, root, 10, lambda: clock[0]):  # the first is past its end
            pass
    with S.Lease(spark, root, 10, lambda: clock[0]):
        pass
    with pytest.raises(ValueError, match="no finished batch"):
        S.current(spark, root, ["k"])


def test_accepted(spark):
    asked = spark.createDataFrame([(1, "m", "d1"), (2, None, "d2"), (3, "m", "d3")], "page int, model string, sha string")
    rows = [(1, "m", "d1", "ok"), (2, None, "d2", "ok"), (3, "other", "d3", "ok"), (3, "m", "old", "ok"), (3, "m", "d3", "failed"), (3, "m", None, "ok"), (4, "m", "d1", "ok"), (1, "m", "d1", None)]
    got = S.accepted(spark.createDataFrame(rows, "page int, model string, sha string, status string"), asked, ["page"], ["model"], "sha").collect()
    assert {tuple(r)[:4] for r in got if r.accepted} == set(rows[:2]) and len(got) == len(rows)


def test_digests(spark, tmp_path):
    """One changed row: one part differs, and only that part's files are read."""
    from ledgerloom.operators import digests as D

    path = f"file://{tmp_path}/table"
    rows = [(i, f"v{i % 7}" if i % 5 else None) for i in range(200)] + [(3, "v3")]
    d = spark.createDataFrame(rows, "k int, v string")
    D.publish(d, path, ["k"], 16)
    assert D.differing_parts(d.orderBy(F.desc("k")), path, ["k"], 16).count() == 0 and D.changed_rows(d, path, ["k"], 16).count() == 0
    new = spark.createDataFrame([(k, "new" if k == 11 else v) for k, v in rows if k != 3] + [(3, "v3")], "k int, v string")
    assert {(r.k, r.v, r.change, r.copies) for r in D.changed_rows(new, path, ["k"], 16).collect()} == {(11, "v4", "removed", 1), (11, "new", "added", 1), (3, "v3", "removed", 1)}
    one = spark.createDataFrame([(k, "new" if k == 11 else v) for k, v in rows], "k int, v string")
    bad = [r.part for r in D.differing_parts(one, path, ["k"], 16).collect()]
    old = spark.read.parquet(f"{path}/rows").filter(F.col("_part").isin(bad))
    read = {r[0] for r in old.select(F.input_file_name()).distinct().collect()}
    assert len(bad) == 1 and all(f"_part={bad[0]}/" in f for f in read)
    assert "PartitionFilters: [isnotnull(_part" in old._jdf.queryExecution().toString()
    D.publish(one, path, ["k"], 16)  # takes the old one's place
    assert D.differing_parts(one, path, ["k"], 16).count() == 0 and D.published(spark, path).count() == 201
    assert [p.name for p in tmp_path.iterdir()] == ["table"]
    none = spark.createDataFrame([(None, None), (None, "null")], "k int, v string")
    assert D.part_digests(none, ["k"], 4).first().digest != D.part_digests(none.fillna("null"), ["k"], 4).first().digest


def test_observed_write(spark, tmp_path, capsys, monkeypatch):
    import json

    from ledgerloom.plans import runlog

    monkeypatch.setenv("LEDGERLOOM_LOG", "on")
    d = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    out = runlog.observed_write(d, f"{tmp_path}/t", "pairs", blank=F.count_if(F.col("v").isNull()))
    line = next(json.loads(x) for x in capsys.readouterr().err.splitlines() if "frame_written" in x)
    assert out["rows"] == line["rows"] == 2 and line["blank"] == 1 and line["bytes"] > 0 and line["frame"] == "pairs" and spark.read.parquet(f"{tmp_path}/t").count() == 2


def test_canonical_sources(spark):
    from ledgerloom.operators.sources import canonical_sources, unique_slugs

    rows = [(1, "x", "h1", "u1"), (2, "x", "h1", "u2"), (3, "y", "h1", "u3"), (4, "y", "h2", "u4"), (5, "z", "h1", "u5"), (6, "z", "h2", "u5"), (7, "w", "h1", "u7"), (8, "w", None, "u8")]
    d = spark.createDataFrame(rows, "i int, sha string, heading string, url string")
    reviews = spark.createDataFrame([("y", "u4"), ("z", "u5"), ("gone", "u1")], "sha string, url string")
    got = {r.i: (r.canonical, r.is_canonical, r.problem) for r in canonical_sources(d, "sha", ["heading"], "i", reviews, ["url"]).collect()}
    bad, none = (None, None, "review names no single listing"), (None, None, "needs a review")
    assert got == {1: (1, True, None), 2: (1, False, None), 3: (4, False, None), 4: (4, True, None), 5: bad, 6: bad, 7: none, 8: none}
    assert {r.i for r in canonical_sources(d, "sha", ["heading"], "i").filter("problem is null").collect()} == {1, 2}
    s = spark.createDataFrame([(1, "A b"), (2, "a-B!"), (3, "c")], "i int, name string")
    assert {r.i: r.slug for r in unique_slugs(s, "name", "i").collect()} == {1: "a_b", 2: "a_b_2", 3: "c"}


def test_positional_scores(spark):
    from ledgerloom.operators.sources import positional_scores, typed_agreement

    p = spark.createDataFrame([(1, 1, "3", "SC"), (1, 2, "4", None), (2, 1, "1", "BC")], "page int, i int, ward string, caste string")
    l = spark.createDataFrame([(1, 5, "3", "SC", True), (1, 9, "5", None, False), (2, 1, "1", "BC", True), (2, 2, "2", "SC", True), (3, 1, "1", "SC", True)], "page int, i int, ward string, caste string, here boolean")
    got = {r.page: (r.expected_rows, r.predicted_rows, r.status, r.correct_ward, r.correct_caste, r.correct_all, r.checked_caste) for r in positional_scores(p, l, ["page"], ["i"], ["ward", "caste"], {"caste": F.col("label_here")}).collect()}
    assert got == {1: (2, 2, "scored", 1, 1, 1, 1), 2: (2, 1, "row_count_mismatch", None, None, None, None), 3: (1, 0, "row_count_mismatch", None, None, None, None)}
    c = spark.createDataFrame([("SC", "SC", None), ("", None, "torn"), (None, None, None), ("SC", "BC", None), ("BC", "BC", "why")], "raw string, caste string, reason string")
    assert [r.problem for r in typed_agreement(c, "raw", {"caste": F.col("raw")}).collect()] == [None, None, "blank without a reason", "typed values differ", "reason without a blank"]


def test_notices_and_offices(spark):
    from ledgerloom.functions import text as X

    one = lambda f, v: spark.createDataFrame([(v,)], "v string").select(f(F.col("v")).alias("r")).head()["r"]
    assert tuple(one(X.notice_place, "elections in Block- Narnaul, District-Mahendergarh during General")) == ("Narnaul", "Mahendergarh", "latin")
    assert tuple(one(X.notice_place, "[k.M&ukjukSy] ftyk&egsUnzx<+ esa")) == ("ukjukSy", "egsUnzx<+", "krutidev") and one(X.notice_place, "nothing") is None
    number = lambda v: one(lambda c: X.notice_number(c, 2022), v)
    assert number("No. SEC/4E-II/2022/7385.- In pursuance of") == "7385" and number("2022/7385 Dated: 10.02.2022 In pursuance") == "7385" and number("see No. 2022/7385.") is None
    assert [one(X.normalized_office, v) for v in (" *Panch. ", "parich", "Sarpancn", None, "• Clerk")] == ["PANCH", "PANCH", "SARPANCH", "", "CLERK"]
    tier = lambda o, f: spark.createDataFrame([(o, f)], "o string, f string").select(X.office_tier(F.col("o"), F.col("f"))).head()[0]
    assert [tier("पंच", "gp"), tier("Ponch", "x"), tier(None, "block_member"), tier(None, "gp"), tier("Clerk", "block_member")] == ["gp_ward", "gp_ward", "block_member", None, None]
    assert [tuple(one(X.page_category, v)) for v in ("SC Women", "General Woman", "अनुसूचित जाति (महिला)", "महिला", "सामान्य", "x", "")] == [("SC", True), ("NONE", True), ("SC", True), ("NONE", True), ("NONE", False), (None, None), (None, None)]
    assert [one(X.anchored_ward, v) for v in ("Ward No. 3*", "१२ †", "123", "x")] == [3, 12, None, None]
    flags = spark.createDataFrame([(True,), (False,), (None,)], "b boolean").select(X.flag_text(F.col("b")).alias("t")).collect()
    assert [r.t for r in flags] == ["1", "0", ""]
    assert spark.range(1).select(X.cell_json(F.lit("a").alias("x"), F.lit(None).cast("string").alias("y"))).head()[0] == '{"x":"a","y":null}'


def test_listing(spark):
    page = """<table><tr><th>No</th><th>Name</th></tr><tr class=a><td>1.</td><td> A &amp; B </td><td><a href="x/one.PDF">pdf</a> <a href='two.html'>t</a></td></tr>
    <tr><td>2</td><td></td><td>C<br>D</td><td><a href=/three.pdf>p</a><a href="four.pdf">q</a></td></tr></table>"""
    d = spark.createDataFrame([(1, page, "http://h/d/i"), (2, None, "http://h")], "id int, html string, url string")
    got = [(r.row, r.name, r.href, r.url) for r in M.listing(d, "html", "url", ["id"]).orderBy("row", F.desc("href")).collect()]
    assert got == [(1, "A & B", "x/one.PDF", "http://h/d/x/one.PDF"), (2, "C D", "four.pdf", "http://h/d/four.pdf"), (2, "C D", "/three.pdf", "http://h/three.pdf")]


def test_packets_and_receipts(spark, tmp_path):
    import gzip
    import json

    from pyspark.sql import types as T

    from ledgerloom.sources.sinks import write_receipt
    from ledgerloom.sources.tables import json_packets, named_by_manifest

    raw = gzip.compress(json.dumps({"id": 7, "rows": ["a", "b"]}, indent=1).encode(), mtime=0)
    (tmp_path / "p").mkdir()
    (tmp_path / "p" / "one.json.gz").write_bytes(raw)
    schema = T._parse_datatype_string("id int, rows array<string>")
    row = json_packets(spark, f"{tmp_path}/p", schema).first()
    assert (row.sha, row.packet.id, row.packet.rows) == (hashlib.sha256(raw).hexdigest(), 7, ["a", "b"])
    files = spark.createDataFrame([("file:/a/b/one.pdf",), ("two.pdf",)], "path string")
    manifest = spark.createDataFrame([("one.pdf", "D", "B")], "saved_as string, district string, block string")
    assert {tuple(r) for r in named_by_manifest(files, manifest, "path", "saved_as", ["district", "block"]).collect()} == {("file:/a/b/one.pdf", "D", "B"), ("two.pdf", None, None)}
    text = write_receipt(spark.range(3).agg(F.count("*").alias("rows"), F.max("id").alias("a")), f"{tmp_path}/r.json")
    assert (tmp_path / "r.json").read_text() == text == '{\n  "a": 2,\n  "rows": 3\n}\n'
    with pytest.raises(ValueError):
        write_receipt(spark.range(2), f"{tmp_path}/r.json")


def test_small_functions(spark):
    from ledgerloom.functions import similarity
    from ledgerloom.functions import text as X
    from ledgerloom.operators.linkage import unique_rows
    from ledgerloom.sources import html as H

    one = lambda f, v, kind="string": spark.createDataFrame([(v,)], f"v {kind}").select(f(F.col("v")).alias("r")).head()["r"]
    assert one(X.squash, "  a  b\n‘c’ ") == "a b 'c'" and one(lambda c: similarity.nfkc(c), "ﬁ①") == "fi1"
    assert [one(X.is_dash, v) for v in ("-", " – ", "a", "-.")] == [True, True, False, True]
    label = spark.createDataFrame([("BC_A", True), ("NONE", False), ("SC", True)], "c string, w boolean").select(X.category_label(F.col("c"), F.col("w")).alias("l")).collect()
    assert [r.l for r in label] == ["BC-A Woman", "Other than Woman", "SC Woman"]
    split = lambda v: tuple(one(X.place_and_person, v, "array<string>"))
    assert split(["Ram", "pur", "-", "Sita", "Devi"]) == ("Ram pur", "Sita Devi") and split(["Rampur", "Sita"]) == ("Rampur", "Sita") and split(["Sita"]) == (None, "Sita") and split([]) == (None, None)
    rows = spark.createDataFrame([(1, "a", "x"), (1, "a", "y"), (2, None, "z"), (2, "b", " "), (3, "c", "w")], "k int, b string, name string")
    assert {tuple(r) for r in unique_rows(rows, ["k", "b"], "name").collect()} == {(2, None, "z"), (3, "c", "w")}
    flat = spark.createDataFrame([("<table><TR a=1><td>x <b>y</b></td><th>z</th></TR></table>",)], "h string")
    assert [(r.row, r.cells) for r in H.table_rows(flat, "h", []).collect()] == [(0, ["x y", "z"])]


@pytest.mark.parametrize("parts", ["4"])
def test_numbers_within_hot_groups(spark, parts):
    from ledgerloom.operators import windows as W

    rows = [("hot" if i % 10 else None, (i * 7919) % 1000) for i in range(1000)]
    d = spark.createDataFrame(rows, "g string, v int").repartition(7)
    got = {(r.g, r.v): r.n for r in W.number_within(d, ["g"], ["v"], "n").collect()}
    for g in ("hot", None):
        own = sorted(v for x, v in rows if x == g)
        assert [got[g, v] for v in own] == list(range(1, len(own) + 1))
    marked = W.mark_repeats(spark.createDataFrame([(1, None), (1, None), (2, "a"), (None, "b"), (None, "b")], "k int, v string"), ["k", "v"], "again")
    assert sorted((str(r.k), r.again) for r in marked.collect()) == [("1", True), ("1", True), ("2", False), ("None", True), ("None", True)]
