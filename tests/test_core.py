"""Fixtures with exact expected values, and the operators' behaviour at edges."""

import collections
import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import text as X
from ledgerloom.functions.similarity import indel_ratio, name_similarity
from ledgerloom.functions.text import name_key
from ledgerloom.operators import aggregates as A
from ledgerloom.operators import joins as J
from ledgerloom.operators import overlay as O
from ledgerloom.operators import predicates as P
from ledgerloom.operators import quality as Q
from ledgerloom.operators import sets as U
from ledgerloom.operators import windows as W
from ledgerloom.operators.linkage import assign, link, one_to_one, scored_pairs
from ledgerloom.operators.sequences import assign_serials, matched_reads, segments, serial_steps
from ledgerloom.plans import catalogue


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column(F.col("v")).alias("r")).head()["r"]


def test_units(spark):
    rows = [(i, *r) for i, r in enumerate([("head", None, 9), ("ward", 1.0, 9), ("ward", 9.0, 9), ("ward", 6.0, 10), ("ward", 7.0, 10), ("head", None, 10)])]
    d = spark.createDataFrame(rows, "pos int, tier string, ward double, page int").withColumn("file", F.lit(1))
    got = [r["unit"] for r in W.units(d, ["file"], ["pos"], "tier", "ward", "page", "unit").orderBy("pos").collect()]
    assert got == [0, 0, 0, 1, 1, 2]


def test_serials(spark):
    files = {
        "misread": [(k, k + 1) for k in range(10)] + [(k, k - 9) for k in range(10, 13)] + [(k, k + 1) for k in range(13, 20)],
        "step": [(k, k + 1) for k in range(10)] + [(k, k + 5) for k in range(10, 20)],
        "digits": [(49, 50), (50, 51), (51, 2), (52, 3), (53, 7), (54, 55)],  # last digits agree, 7 doesn't
        "lone": [(1, 2), (2, 9), (3, 4), (4, 5)],
        "none": [(1, 5)],
        "twice": [(k, k + d) for k, d in enumerate([1, 1, 11, 11, 1, 1, 11, 11, 1, 1])],
    }
    d = spark.createDataFrame([(f, *r) for f, rows in files.items() for r in [*rows, (99, None)]], "file string, k int, serial int")
    got = {}
    for r in segments(d.unionAll(d), "file", "k", "serial").orderBy("first_k").collect():
        got.setdefault(r["file"], []).append((r["first_k"], r["last_k"], r["offset"]))
    assert got == {"misread": [(0, 19, 1)], "step": [(0, 9, 1), (10, 19, 5)], "digits": [(49, 54, 1)], "lone": [(3, 4, 1)], "twice": [(0, 1, 1), (2, 8, 11)]}


def test_serial_assignment(spark):
    rows = [("f", k, k + 1) for k in range(5)] + [("f", k, k + 7) for k in range(8, 12)]
    d = spark.createDataFrame(rows, "file string, k int, serial int")
    ks = spark.createDataFrame([("f", 2), ("f", 6), ("g", 1)], "file string, k int")
    got = {(r["file"], r["k"]): (r["assigned"], r["basis"]) for r in assign_serials(ks, segments(d, "file", "k", "serial"), "file", "k").collect()}
    assert got == {("f", 2): (3, "inside"), ("f", 6): (None, "outside_confirmed_serials"), ("g", 1): (None, "no_serial_read")}


@pytest.mark.parametrize(("p", "c", "ok"), [("Sarpanch", "1", True), ("19", "20", True), ("7", "1", False), ("Sarpanch", "2", False)])
def test_office_step(spark, p, c, ok):
    d = spark.createDataFrame([(p, c)], "p string, c string")
    assert d.select(W.office_step(F.col("p"), F.col("c")).alias("r")).head()["r"] is ok


def test_name_parts(spark):
    parts = lambda n: one(spark, X.name_parts, n)
    assert (parts("Smt. Sunita")["first_name"], parts("Smt. Sunita")["woman_title"]) == ("sunita", 1)
    assert parts("Jasbir Kaur")["woman_marker"] == 1 and parts("Parveen Kumar")["man_marker"] == 1
    assert parts("....")["first_name"] is None and parts(None)["first_name"] is None


def test_name_key(spark):
    a, b = one(spark, X.name_key, "Surpura Kalan"), one(spark, X.name_key, "Surpura Khurd")
    assert a["folded"] == b["folded"] and a["directions"] == ["kalan"] and b["directions"] == ["khurd"]
    assert one(spark, X.name_key, "Ambala-II")["numbers"] == [2] and one(spark, X.name_key, "Mohammadpur Rohi 1")["numbers"] == [1]
    assert one(spark, X.name_key, "Sanha Purvi")["directions"] == ["east"]


@pytest.mark.parametrize(("a", "b", "veto"), [(["kalan"], ["khurd"], True), (["khurd", "north"], ["khurd"], False), (["east"], ["west"], True), ([], ["west"], False)])
def test_qualifiers(spark, a, b, veto):
    d = spark.createDataFrame([(a, b)], "a array<string>, b array<string>")
    assert d.select(X.qualifiers_conflict(F.col("a"), F.col("b")).alias("r")).head()["r"] is veto


@pytest.mark.parametrize(
    ("raw", "want"),
    [("Scheduled Cast e Women", ("SC", 1, "latin")), ("BC (A) Other than Women", ("BC_A", 0, "latin")), ("Unresreved", ("NONE", 0, "latin")), ("अनुसूचित जनजाति महिला", ("ST", 1, "devanagari")), ("efgyk ds flok;", ("NONE", 0, "krutidev")), ("nothing", None), ("", None), (None, None)],
)
def test_category_ladder(spark, raw, want):
    got = one(spark, X.category_ladder, raw)
    assert (tuple(got) if got else None) == want


def test_text_functions(spark):
    assert one(spark, X.exact_category, "S.C. (Women)") == ("SC", True) and one(spark, X.exact_category, "?")["caste"] is None
    assert one(spark, X.ward_number, "Ward No. 3") == 3 and one(spark, X.ward_number, "१२") == 12 and one(spark, X.ward_number, "1234") is None
    assert one(spark, X.is_vacant, "  ") is True and one(spark, X.is_vacant, "Vacant seat") is True and one(spark, X.is_vacant, "Ram") is False
    assert tuple(one(spark, X.numeric_token, "007")) == (None, "leading_zero") and tuple(one(spark, X.numeric_token, "12")) == (12, None)
    assert one(spark, X.flags_of, "b; a;;b") == ["a", "b"]
    assert one(spark, lambda c: X.trailing_run(c, lambda x: x > 2), [1, 5, 2, 3, 4], "array<int>") == [3, 4]
    assert one(spark, X.collapse_repeats, [1, 1, None, None, 2], "array<int>") == [1, None, 2]
    assert tuple(one(spark, X.strip_unopposed, "**Ram")) == ("Ram", True)


def test_similarity():
    rnd = random.Random(5)
    for _ in range(300):
        a, b = ("".join(rnd.choice("abc") for _ in range(rnd.randint(1, 9))) for _ in range(2))
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
            row = new
        assert indel_ratio(a, b) == pytest.approx(2 * row[-1] / (len(a) + len(b)))
    assert name_similarity("", "a") == 0 and name_similarity("ramu", "rami") == pytest.approx(0.95)


def test_assignment_is_optimal():
    rng = np.random.default_rng(1)
    for _ in range(60):
        n, m = rng.integers(1, 5), 5
        c = rng.random((n, m))
        got = assign(c)
        assert sum(c[i, got[i]] for i in range(n)) == pytest.approx(min(sum(c[i, p[i]] for i in range(n)) for p in itertools.permutations(range(m), int(n))))


def test_link(spark):
    a = spark.createDataFrame([(1, "x", "Rampur Kalan", 5), (2, "x", "Rampur Khurd", 7), (3, "x", "Bahu", 9)], "id int, b string, name string, wards int")
    b = spark.createDataFrame([(11, "x", "Rampur Khurd", 7), (12, "x", "Ramapur Kalan", 5), (13, "y", "Bahu", 9)], "id int, b string, name string, wards int")
    got = {(r["left"], r["right"]) for r in link(a, b, ["b"], "name", "id", "wards").collect()}
    assert got == {(1, 12), (2, 11)}
    allowed = spark.createDataFrame([("x", "x"), ("x", "y")], "b string, right_b string")
    assert {(r["left"], r["right"], r["b"]) for r in link(a, b, ["b"], "name", "id", "wards", allowed=allowed).collect()} == {(1, 12, "x"), (2, 11, "x"), (3, 13, "x")}


def test_link_against_brute_force(spark):
    """Scores and the optimum of every block, over all assignments."""
    rnd = random.Random(8)
    words = ["rampur", "kalan", "bahu", "bhau", "rampura", "kheri", "kheda", "nagar", "nagla", "a", "io"]
    rows = lambda n: [(i, rnd.choice("xyz"), " ".join(rnd.sample(words, rnd.randint(1, 2))), rnd.randint(1, 2)) for i in range(n)]
    left, right = rows(14), rows(14)
    kinds = "id int, b string, name string, wards int"
    a, b = spark.createDataFrame(left, kinds), spark.createDataFrame(right, kinds)
    scored = {(r["left"], r["right"]): r["score"] for r in scored_pairs(a, b, ["b"], "name", "id", 0.8).collect()}
    keys = {(r["name"]): r["k"] for r in a.unionAll(b).select("name", name_key(F.col("name")).alias("k")).collect()}
    want = {}
    for i, x, n, _ in left:
        for j, y, m, _ in right:
            if x == y and not (keys[n]["numbers"] and keys[m]["numbers"]) and (s := name_similarity(keys[n]["folded"], keys[m]["folded"])) >= 0.8:
                want[i, j] = s
    assert scored == pytest.approx(want) and len(want) > 5
    got = {(r["left"], r["right"]): r["score"] for r in one_to_one(scored_pairs(a, b, ["b"], "name", "id", 0.8), ["b"]).collect()}
    assert len({i for i, _ in got}) == len({j for _, j in got}) == len(got)

    def best(rest, used):
        if not rest:
            return 0.0
        i, *rest = rest
        return max([best(rest, used), *[s + best(rest, used | {j}) for (k, j), s in want.items() if k == i and j not in used]])

    assert sum(got.values()) == pytest.approx(best(sorted({i for i, _ in want}), frozenset()))


def test_joins_at_edges(spark):
    dim = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(Exception, match="repeated key"):
        J.lookup(spark.createDataFrame([(1,)], "k int"), dim, ["k"], unique=True).collect()
    with pytest.raises(Exception, match="no match"):
        J.lookup(spark.createDataFrame([(2,)], "k int"), dim, ["k"], required=True).collect()
    left = spark.createDataFrame([(1, 5), (1, None), (2, 1)], "g int, at int")
    right = spark.createDataFrame([(1, 5, "x"), (1, 3, "y")], "g int, t int, v string")
    assert {(r["g"], r["at"], r["v"]) for r in J.asof_join(left, right, ["g"], "at", "t", ["v"], "v").collect()} == {(1, 5, "x"), (1, None, None), (2, 1, None)}
    assert {r["v"] for r in J.asof_join(left.filter("at = 5"), right, ["g"], "at", "t", ["v"], "v", strict=True).collect()} == {"y"}


def test_overlay(spark):
    d = spark.createDataFrame([(1, "a", "x"), (2, "b", None)], "k int, cell string, office string").withColumn("flags", F.array(F.lit("held")))
    r = spark.createDataFrame([(1, "a", "new"), (2, "zz", "new"), (3, "a", "new")], "k int, seen_cell string, value string")
    got = {x["k"]: (x["office"], x["office_before"], x["review_status"], x["flags"]) for x in O.apply_overlay(d, r, ["k"], ["cell"], {"office": F.col("value")}, "flags", ["reviewed"], ["held"]).collect()}
    assert got == {1: ("new", "x", "applied", ["reviewed"]), 2: (None, None, "precondition_failed", ["held"])}
    assert {x["k"]: x["reasons"] for x in O.violations(d, r, ["k"], ["cell"]).collect()} == {2: ["cell differs"], 3: ["no row"]}


def test_gates_and_sets(spark):
    d = spark.createDataFrame([(1,), (2,), (None,)], "v int")
    checks = Q.report(d, [("rows", True, F.count("*") == 3, F.count("*")), ("known", True, F.count("v") == 3, F.count("v"))])
    with pytest.raises(Q.GateError, match="known: 2"):
        Q.enforce(checks)
    e = spark.createDataFrame([(2,), (2,), (None,)], "v int")
    assert {(r["v"], r["copies_a"], r["copies_b"]) for r in U.differing(d, e).collect()} == {(1, 1, 0), (2, 1, 2)}
    cal = A.calibration(spark.createDataFrame([(0.0, 0), (0.1, 1), (1.0, 1)], "p double, y int"), F.col("p"), F.col("y")).collect()
    assert {(r["bin"], r["n"]) for r in cal} == {(0, 2), (5, 1)}


def test_sinks(spark, tmp_path):
    from ledgerloom.sources.sinks import replace_block, write_checked, write_json_lines
    from ledgerloom.sources.tables import file_inventory, pinned, read_snapshot

    d = spark.createDataFrame([("01", True, None), ("01", None, "x")], "id string, flag boolean, t string")
    assert write_checked(d, str(tmp_path / "p")) == 2
    assert write_json_lines(d, str(tmp_path / "j")) == write_json_lines(d.repartition(3), str(tmp_path / "j"))
    f = tmp_path / "s.csv"
    f.write_text("id,flag,t\n01,1,\n01,,x\n")
    assert sorted(map(tuple, read_snapshot(spark, str(f), d.schema).collect()), key=str) == [("01", None, "x"), ("01", True, None)]
    f.write_text("id,flag,t\n01,7,\n")
    with pytest.raises(Exception, match="bad flag"):
        read_snapshot(spark, str(f), d.schema).collect()
    sha = file_inventory(spark, [str(f)]).head()["sha"]
    pinned(spark, {str(f): sha})
    with pytest.raises(ValueError, match="pinned"):
        pinned(spark, {str(f): "0" * 64})
    (tmp_path / "r.md").write_text("a<b>old</b>c")
    replace_block(str(tmp_path / "r.md"), "<b>", "</b>", "new")
    assert (tmp_path / "r.md").read_text() == "a<b>\nnew\n</b>c"


def test_resumable_stream(spark, sf, tmp_path):
    from ledgerloom.streaming.resumable import run_available

    events = spark.read.parquet(f"{sf}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    events.limit(500).write.parquet(str(tmp_path / "in"))
    go = lambda: run_available(spark, str(tmp_path / "in"), events.schema, str(tmp_path / "c"), str(tmp_path / "out"), lambda b: b.groupBy("event_type").count())
    assert go() == 1 and go() == 0
    events.limit(20).write.mode("append").parquet(str(tmp_path / "in"))
    assert go() == 1
    assert spark.read.parquet(str(tmp_path / "out")).agg(F.sum("count")).head()[0] == 520


def test_group_folds(spark, sf):
    from ledgerloom.operators.inference import cross_validated

    d = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "source", (F.col("n_chars") / 1000).alias("x")).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    out = cross_validated(d, ["x"], "quality", "source", 3)
    assert out.groupBy("source").agg(F.countDistinct("fold").alias("n")).filter("n > 1").isEmpty()
    assert out.filter("p is null or p < 0 or p > 1").isEmpty()


def test_empty_text_has_no_probability(spark, tmp_path):
    """An empty text has no share of symbols: its row stays without p, all others have one."""
    docs = [(i, "#" * (i % 7) + "ab " * (1 + i % 11), f"s{i % 5}") for i in range(60)]
    for name, texts in (("some", docs), ("all", [*docs, (60, "", "s1")])):
        spark.createDataFrame([(i, x, g, len(x)) for i, x, g in texts], "doc_id long, text string, source string, n_chars long").write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.createDataFrame([(i, i * 7 // 3 % 2 if i < 60 else 1, 0) for i, _, _ in texts], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/{name}/labels.parquet")
    some, all_ = ({r.doc_id: r.p for r in catalogue.QUERIES["q_logit_groupcv"](spark, f"{tmp_path}/{name}").collect()} for name in ("some", "all"))
    assert len(some) == 60 and None not in some.values() and len(all_) == 61 and all_[60] is None
    assert all(0 < all_[i] < 1 for i in some)


def test_rows_that_belong_together(spark):
    d = spark.createDataFrame([(1, 1, "SC", "x"), (2, 2, "BC", None), (3, None, None, "y"), (4, 4, "SC", "z")], "pos int, ward int, cat string, name string").withColumn("f", F.lit(1))
    got = [(r["pos"], r["ward"], r["cat"], r["name"]) for r in W.merge_stranded(d, ["f"], ["pos"], "ward", ["cat"], ["name"]).orderBy("pos").collect()]
    assert got == [(1, 1, "SC", "x"), (3, 2, "BC", "y"), (4, 4, "SC", "z")]
    t = spark.createDataFrame([(0, "lost"), (1, "Ram"), (2, "Lal"), (3, "Sita")], "pos int, v string").withColumn("f", F.lit(1))
    assert [r["v"] for r in W.join_tails(t, ["f"], ["pos"], F.col("pos").isin(1, 3), "v").orderBy("pos").collect()] == ["Ram Lal", "Sita"]
    h = spark.createDataFrame([(1, "A", None), (2, "A", "x"), (3, "", None)], "pos int, h string, g string").withColumn("f", F.lit(1))
    assert [(r["n"], r["n_basis"]) for r in W.unread_headings(h, ["f"], ["pos"], "h", ["g"], "n").orderBy("pos").collect()] == [("A", "heading"), ("x", "g"), (None, "unread")]


def test_more_text(spark):
    assert one(spark, X.place_case, "ward ii RAM pur") == "Ward II Ram Pur"
    assert tuple(one(spark, X.trailing_numbers, "Total of block   12 - 3.5")) == ("Total of block", ["12", "-", "3.5"])
    assert tuple(one(spark, X.trailing_numbers, "no numbers"))[1] == []
    got = one(spark, lambda c: X.split_at_anchor(c, lambda x: x == "Panch"), ["a", "Panch", "b", "c"], "array<string>")
    assert (got["before"], got["anchor"], got["after"]) == (["a"], "Panch", ["b", "c"])
    from ledgerloom.functions.similarity import composed

    assert one(spark, lambda c: composed(X.font_text(c, [("d", "क"), ("e", "म")], {"f": "ि"}, {"Z": "र्"})), "fd eZ") == "कि र्म"


def test_tar_scan(spark, tmp_path):
    import hashlib
    import io
    import tarfile

    from ledgerloom.sources.tables import tar_members

    with tarfile.open(tmp_path / "a.tar.gz", "w:gz") as t:
        info = tarfile.TarInfo("m.json")
        info.size = 2
        t.addfile(info, io.BytesIO(b"{}"))
    r = tar_members(spark, str(tmp_path / "a.tar.gz")).head()
    assert (r["member"], r["bytes"], r["sha"]) == ("m.json", 2, hashlib.sha256(b"{}").hexdigest())


def test_unique_windows_of_whole_texts(spark):
    """Passages anywhere in a text are found; windows seen twice on a side don't count; matches out of order are discarded."""
    words = [f"w{i}" for i in range(60)]
    item, tail, twice, swapped = words[:12], words[12:24], words[24:36], words[36:52]
    opening = "the same opening of more than forty characters in every text here "
    docs = [(1, f"{opening} one {' '.join(item)} end"), (2, f"{opening} two\n{' '.join(twice)}"), (3, f"{opening} three {' '.join(twice)}"), (4, " ".join([*swapped[8:], "x", *swapped[:8]])), (5, " ".join([*["z"] * 9, *tail]))]
    items = [(10, " ".join(item)), (11, " ".join(twice)), (12, " ".join(swapped)), (13, f"{opening} {' '.join(tail)}")]
    got = J.unique_window_join(spark.createDataFrame(docs, "d int, t string"), spark.createDataFrame(items, "i int, t string"), "d", "i", "t", 8)

    def windows(rows):
        return [(" ".join(t.split()[p : p + 8]), k, p + 1) for k, t in rows for p in range(max(len(t.split()) - 7, 1))]

    once = lambda rows: {w: (k, p) for w, k, p in rows if [r[0] for r in rows].count(w) == 1}
    a, b = once(windows(docs)), once(windows(items))
    want = {}
    for w in a.keys() & b.keys():
        want.setdefault((a[w][0], b[w][0]), []).append((a[w][1], b[w][1]))
    want = {(*k, *m) for k, v in want.items() if [y for _, y in sorted(v)] == sorted(y for _, y in v) for m in v}
    assert {tuple(r) for r in got.select("d", "i", "left_place", "right_place").collect()} == want
    assert {r[:2] for r in want} == {(1, 10), (5, 13)}


def test_serial_queries_read_every_order(spark, tmp_path):
    """Keys that agree modulo 10 and 500, and a file longer than 500: brute force over every order."""
    rnd = random.Random(7)
    sizes = {3: 1200, 13: 40, 23: 2, 33: 1}
    files = [c for c, n in sizes.items() for _ in range(n)]
    rnd.shuffle(files)
    orders = [(500 * i, c, "1-URGENT" if rnd.random() < 0.1 else "5-LOW") for i, c in enumerate(files)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    segs, assigned = set(), set()
    for c in sizes:
        urgent = [p == "1-URGENT" for _, f, p in sorted(orders) if f == c]
        offsets = [sum(urgent[: i + 1]) for i in range(len(urgent))]
        own = [(offsets.index(o) + 1, offsets.index(o) + n, o) for o, n in collections.Counter(offsets).items() if n > 1]  # they only grow
        segs |= {(c, *s) for s in own}
        for k in range(1, len(urgent) + 1):
            inside = [o for a, b, o in own if a <= k <= b]
            before, after = [o for _, b, o in own if b < k], [o for a, _, o in own if a > k]
            o = inside[0] if inside else before[-1] if before and after and before[-1] == after[0] else None
            assigned.add((c, k, None if o is None else k + o))
    run = lambda n, *cols: [tuple(r) for r in catalogue.QUERIES[n](spark, str(tmp_path)).select(*cols).collect()]
    assert sorted(run("q_serial_segments", "file", "first_k", "last_k", "offset")) == sorted(segs)
    got = run("q_serial_assignment", "file", "k", "assigned")
    assert len(got) == len(orders) and set(got) == assigned


@pytest.mark.parametrize("across", [False, True])
def test_first_containing(spark, across):
    """Brute force by the reference's two rules; a last page reprinted at the head of the next file is found across files."""
    rnd = random.Random(5)
    pages = {(g, o): set(rnd.sample(range(14), rnd.randint(1, 7))) for g in "abcd" for o in range(12)}
    pages |= {("a", 20): set(range(100, 110)), ("b", -1): set(range(100, 109)), ("c", 30): {1, 2, 3}, ("c", 31): {1, 2, 3}, ("c", 32): {1, 2, 3, 4}}
    d = spark.createDataFrame([(g, o, e) for (g, o), v in pages.items() for e in v], "g string, o int, e int")
    want = set()
    for (g, o), v in pages.items():
        head = across and o == min(p for f, p in pages if f == g)
        hits = [k for k in sorted(pages) if ((k[0] == g and k[1] < o) or (head and k[0] != g)) and len(v & pages[k]) >= 0.8 * len(v)]
        if len(v) >= 2 and hits:
            want.add((g, o, len(v), *hits[0][0 if across else 1 :], len(v & pages[hits[0]])))
    got = [tuple(r) for r in J.first_containing(d, ["g"], "o", "e", 0.8, 2, across).collect()]
    assert len(got) == len(want) and set(got) == want
    assert (("b", -1, 9, "a", 20, 9) in want) is across
    if not across:
        assert {tuple(r) for r in J.contained_earlier(d, ["g"], "o", "e", 0.8, 2).select("g", "o", "size", "repeats", "shared").collect()} == want


def test_short_lines_count(spark, tmp_path):
    """A document whose shared lines are all short is contained; one is not that only shares its long line."""
    docs = [(1, "a\nb\nc\nd\n" + "x" * 30), (2, "a\nb\nc\nd"), (3, "p\nq\nr\n" + "x" * 30), (4, "\n \n")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert [tuple(r) for r in catalogue.QUERIES["q_contained_documents"](spark, str(tmp_path)).collect()] == [(2, 4, 1, 4)]


def shuffled(spark) -> int:
    """Rows written to shuffles so far."""
    jvm, store = spark._jvm, spark._jsc.sc().statusStore()
    spark._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    stages = store.stageList(None, False, False, spark.sparkContext._gateway.new_array(jvm.double, 0), jvm.java.util.ArrayList())
    return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))


def test_common_line_makes_no_pairs(spark, tmp_path):
    """A line of all documents: contained ones are found, but not every two documents meet in it."""
    line = "a line that every document has"
    docs = [(i, "\n".join([line, *[f"{k}: a line of document {i} alone" for k in range(4)]])) for i in range(600)]
    docs += [(600, docs[3][1] + "\nshort"), (601, "\n".join(docs[7][1].split("\n")[1:])), (602, line)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    before = shuffled(spark)
    assert {tuple(r) for r in catalogue.QUERIES["q_near_dup_documents"](spark, str(tmp_path)).collect()} == {(600, 5, 3, 5), (601, 4, 7, 4), (602, 1, 0, 1)}
    assert shuffled(spark) - before < 100_000


def test_part_sets_are_whole_keys(spark, tmp_path):
    """Parts 200 apart differ; repeats within a customer and of a customer's first order in another's are found."""
    lines = {(1, 10): [1, 2, 3], (1, 11): [201, 202, 203], (1, 12): [1, 2, 3], (2, 20): [201, 202], (2, 21): [1, 2], (3, 30): [7, 8, 9]}
    spark.createDataFrame([(o, c) for c, o in lines], "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(o, e) for (_, o), v in lines.items() for e in v], "l_orderkey long, l_partkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    got = {tuple(r) for r in catalogue.QUERIES["q_repeated_part_sets"](spark, str(tmp_path)).collect()}
    assert got == {(1, 12, 3, 1, 10, 3), (2, 20, 2, 1, 11, 2)}


def test_common_parts_make_few_pairs(spark, tmp_path):
    """First orders of any two of 40 parts: each part is in many orders, but only those with both are compared whole."""
    sets = {(c, 10 * c): p for c, p in enumerate(itertools.combinations(range(40), 2))} | {(5000, 50000): (5, 6)}
    spark.createDataFrame([(o, c) for c, o in sets], "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(o, e) for (_, o), v in sets.items() for e in v], "l_orderkey long, l_partkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    c = next(c for (c, _), v in sets.items() if v == (5, 6))
    before = shuffled(spark)
    assert {tuple(r) for r in catalogue.QUERIES["q_repeated_part_sets"](spark, str(tmp_path)).collect()} == {(c, 10 * c, 2, 5000, 50000, 2), (5000, 50000, 2, c, 10 * c, 2)}
    assert shuffled(spark) - before < 20_000


def test_reads_to_steps(spark):
    heads = [("f", 1, k, n) for k, n in enumerate(["Rampur Kalan", "Sonepat", "Rampur-Kalan", "Dabwali"])] + [("f", 2, k, f"Village {chr(97 + k) * 8}") for k in range(4, 8)]
    reads = [("f", 1, 9, "rampur kalam"), ("f", 1, 3, "zzzz"), ("f", 2, 5, "Dabwali")] + [("f", 2, k + (1 if k < 6 else 4), f"Village {chr(97 + k) * 8}") for k in range(4, 8)]
    got = matched_reads(spark.createDataFrame(reads, "file string, page int, serial int, name string"), spark.createDataFrame(heads, "file string, page int, k int, name string"), ["file", "page"], "k", "serial", "name")
    assert {(r["k"], r["serial"]) for r in got.collect()} == {(2, 9), (4, 5), (5, 6), (6, 10), (7, 11)}
    steps = serial_steps(segments(got.filter("page = 2"), "file", "k", "serial"), "file")
    assert [tuple(r) for r in steps.collect()] == [("f", 5, 6, 1, 4, 3)]


def test_band_join_against_brute_force(spark):
    rnd = random.Random(5)
    for n in (0, 1, 40, 150):
        bands = [(i, float(a := rnd.randint(-20, 40)), float(a + rnd.choice([0, 1, 7, 30])), f"b{i}") for i in range(n)] + [(n, None, 5.0, "open")]
        values = [(i, v) for i, v in enumerate([None, -20.0, 70.0, 1e9, -1e9, *[rnd.uniform(-25, 75) for _ in range(80)], *[float(k) for k in range(-21, 72)]])]
        want = {i: max(((o, t) for o, a, b, t in bands if v is not None and a is not None and a <= v < b), default=(0, None))[1] for i, v in values}
        df, b = spark.createDataFrame(values, "i int, v double"), spark.createDataFrame(bands, "o int, lo double, hi double, t string")
        out = J.band_join(df, b, "v", "lo", "hi", "o", ["t"])
        assert {r["i"]: r["t"] for r in out.collect()} == want
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_metrics_against_ranks(spark):
    rnd = np.random.default_rng(3)
    p = np.r_[0.0, 1.0, 1e-15, np.round(rnd.random(300), 2), rnd.random(300)]
    y = (rnd.random(len(p)) < p).astype(int)
    pos, neg = p[y == 1], p[y == 0]
    want = ((pos[:, None] > neg).mean() + (pos[:, None] == neg).mean() / 2).round(4)
    d = spark.createDataFrame([*zip(p.tolist(), y.tolist()), (None, 1), (0.5, None)], "p double, y int")
    got = A.classifier_metrics(d, F.col("p"), F.col("y")).head()
    assert got["n"] == len(p) and abs(got["auc"] - want) < 1e-9


def test_fits_against_newton_on_arrays(spark):
    from ledgerloom.operators.inference import fit_logits, group_folds

    rnd = np.random.default_rng(4)
    x = rnd.normal(size=(200, 2))
    y = (rnd.random(200) < 1 / (1 + np.exp(-x[:, 0]))).astype(int)
    d = spark.createDataFrame([(float(a), float(b), int(c), i % 3) for i, ((a, b), c) in enumerate(zip(x, y))], "a double, b double, y int, k int")
    got = fit_logits(d, ["a", "b"], "y", [F.col("k") != 0, F.lit(True), F.col("k") > 5])
    for rows, w in ((np.arange(200) % 3 != 0, got[0]), (np.full(200, True), got[1])):
        m = np.c_[np.ones(rows.sum()), x[rows]]
        gradient = m.T @ (1 / (1 + np.exp(-m @ w)) - y[rows]) + np.r_[0, w[1:]]
        assert np.abs(gradient).max() < 1e-6  # the penalised loss is convex, so this is its minimum
    assert got[2].tolist() == [0, 0, 0]
    g = spark.createDataFrame([(f"g{i}",) for i in range(500) for _ in range(1 + i % 4)], "g string")
    folds = g.join(group_folds(g, "g", 5), "g").groupBy("fold").count().collect()
    assert len(folds) == 5 and max(r["count"] for r in folds) - min(r["count"] for r in folds) <= 4


def test_names_of_islands(spark):
    rows = [(1, 1, "Ram"), (1, 2, "Ram Kumar Singh"), (1, 3, "Ram Kumar"), (1, 4, "Ramesh"), (2, 5, "Ram"), (2, 6, None)]
    d = W.complete_names(spark.createDataFrame([(0, *r) for r in rows], "f int, i int, o int, n string"), ["f"], "i", "n", "full", "o")
    assert [r["full"] for r in d.orderBy("o").collect()] == ["Ram Kumar Singh"] * 3 + ["Ramesh", "Ram", None]


def test_ratio_anchor_and_log_odds(spark):
    from ledgerloom.functions.similarity import block_ratio, name_anchor

    d = spark.createDataFrame([("Ab-c d", "abcd"), ("abcd", "bcde"), (None, "x"), ("ﬁ  Straße", "a\x07b")], "a string, b string")
    got = d.select(block_ratio("a", "b").alias("r"), name_anchor("a").alias("x"), name_anchor("b").alias("y")).collect()
    assert [r["r"] for r in got[:3]] == [1.0, 0.75, 0.0]
    assert [r["x"] for r in got] == ["ab-c d", "abcd", None, "ﬁ strasse"] or got[3]["x"] == "fi strasse"
    assert got[3]["y"] is None
    z = spark.range(1).select(X.logit(F.lit(None).cast("double")).alias("a"), X.logit(F.lit(2.0)).alias("b"), X.logit(F.lit(0.9), F.lit(True)).alias("c")).head()
    assert (z["a"], round(z["b"], 4), z["c"]) == (0.0, 9.2102, 0.0)


def test_blanked_cells(spark):
    d = spark.createDataFrame([(1, "a\x07\"b", "ok"), (2, None, "t\tab"), (3, "x", "\x1f")], "k int, a string, b string")
    clean, evidence = P.blanked(d, ["k"], ["a", "b"])
    assert [tuple(r) for r in clean.orderBy("k").collect()] == [(1, None, "ok"), (2, None, "t\tab"), (3, "x", None)]
    assert [tuple(r) for r in evidence.orderBy("k").collect()] == [(1, "a", 'a\\u0007\\"b'), (3, "b", "\\u001F")]


def test_files_and_receipts(spark, tmp_path):
    import gzip
    import hashlib
    import json

    from ledgerloom.sources import sinks as K
    from ledgerloom.sources import tables as T

    (tmp_path / "j").mkdir()
    (tmp_path / "j" / "a.json").write_text('{\n"n": 1}')
    (tmp_path / "j" / "b.json").write_text('{"n": 2}')
    from pyspark.sql.types import StructType

    docs = T.json_documents(spark, str(tmp_path / "j"), StructType().add("n", "integer"))
    want = {p.name: hashlib.sha256(p.read_bytes()).hexdigest() for p in (tmp_path / "j").iterdir()}
    assert {(r["path"].split("/")[-1], r["doc"]["n"], r["sha"]) for r in docs.collect()} == {("a.json", 1, want["a.json"]), ("b.json", 2, want["b.json"])}
    files = T.file_inventory(spark, [str(tmp_path / "j")])
    assert {r["line"] for r in K.checksums(files).collect()} == {f"{s}  {n}" for n, s in want.items()}
    receipts = files.select("path", F.when(F.col("path").endswith("a.json"), F.lit("0")).otherwise(F.col("sha")).alias("sha256"), "bytes")
    assert [r["path"].split("/")[-1] for r in Q.receipts_agree(receipts, files).collect()] == ["a.json"]

    with gzip.open(tmp_path / "w.tsv.gz", "wt") as f:
        f.write('level\tline\tleft\ttop\ttext\n4\t1\t0\t0\t\n5\t1\t30\t9\t"two\n5\t1\t10\t8\tone\n5\t2\t5\t3\tfirst\n')
    schema = StructType().add("level", "integer").add("line", "integer").add("left", "integer").add("top", "integer").add("text", "string")
    lines = T.word_lines(T.read_words(spark, str(tmp_path / "w.tsv.gz"), schema, 5), [], "line", "left", "top", "text")
    assert [(r["top"], r["text"]) for r in lines.orderBy("top").collect()] == [(3, "first"), (8, 'one "two')]

    (tmp_path / "t.csv").write_text('a,b\n01,\n"x\ny",2\n')
    assert [tuple(r) for r in T.read_texts(spark, str(tmp_path / "t.csv")).orderBy("a").collect()] == [("01", None), ("x\ny", "2")]

    d = spark.createDataFrame([(1, None, "x"), (2, "b", "y")], "k int, s string, extra string")
    K.write_csv(d, str(tmp_path / "c"), ["s", "k"])
    assert next((tmp_path / "c").glob("*.csv")).read_bytes() == b"s,k\n,1\nb,2\n"
    K.write_parquet(d, str(tmp_path / "p"))
    m = json.loads(K.manifest(spark, {"d": str(tmp_path / "p")}))["d"]
    assert m["rows"] == 2 and m["schema"] == {"k": "int", "s": "string", "extra": "string"}
    assert {n: f["sha256"] for n, f in m["files"].items()} == {p.name: hashlib.sha256(p.read_bytes()).hexdigest() for p in (tmp_path / "p").glob("*.parquet")}
    assert K.dictionary(d)[0] == {"column": "k", "type": "int", "comment": ""}


def test_record_lookups_at_edges(spark):
    left = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "k int, n string")
    right = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "n string, o int")
    assert {tuple(r) for r in J.last_lookup(left, right.withColumn("d", F.col("o") * 10), ["n"], "o").select("k", "d").collect()} == {(1, 20), (2, None), (3, None)}
    with pytest.raises(Exception, match="repeated key"):
        J.one_to_one(left, right, ["n"]).collect()
    aliases = spark.createDataFrame([("c", "b")], "n string, spelling string")
    got = {r["k"]: (r["match_o"], r["status"]) for r in J.reviewed_join(left, right, aliases, "n", "o").collect()}
    assert got == {1: (None, "ambiguous_name"), 2: (None, "unmatched"), 3: (3, "reviewed_spelling_variant")}
    assert {r["k"]: r["reused"] for r in J.used_once(left.withColumn("m", F.when(F.col("k") != 2, 7)), "m").collect()} == {1: True, 2: False, 3: True}
    empty = left.limit(0)
    assert A.repeat_classes(empty.withColumnRenamed("n", "name"), ["name"], ["k"], "k").isEmpty() and P.outside_domains(empty, {"n": ["a"]}).isEmpty()
