"""Importance resampling, main text of pages and hard negatives against brute force, on tables with odd rows."""

import collections
import hashlib
import html
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import hard_negatives, importance
from ledgerloom.llm.main_text import extract, main_text

ODD = [None, "", "   ", "a", "A b! É-é 日本 x9\x00y", "word " * 30, "The same text, the same text. " * 9, "tail"]


def features(text, grams):
    words = re.findall("[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return words, [" ".join(words[i : i + m]) for m in range(1, grams + 1) for i in range(len(words) - m + 1)]


def brute_resample(docs, target, grams, buckets, num, den, least):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = collections.Counter(), collections.Counter()
    for _, text in docs:
        s.update(map(bucket, features(text, grams)[1]))
    for text in target:
        t.update(map(bucket, features(text, grams)[1]))
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets))))
    rows = []
    for i, text in docs:
        words, found = features(text, grams)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain(bucket(f)) for f in found)
        rows.append([i, len(found), len(words), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None])
    fit = sorted((r for r in rows if r[2] >= least), key=lambda r: (-r[4], -(1 << 70) if r[0] is None else r[0]))
    for place, r in enumerate(fit[: num * len(fit) // den], 1):
        r[5] = place
    return sorted(map(str, rows))


@pytest.mark.parametrize(("grams", "buckets"), [(1, 50), (3, 65536)])
def test_resample(spark, grams, buckets):
    rnd = random.Random(grams)
    texts = ODD + [" ".join(rnd.choice(["ab", "cd", "EF", "gé", "hi-jk", "l"]) for _ in range(rnd.randrange(60))) for _ in range(60)]
    docs = [(i, t) for i, t in enumerate(texts)] + [(None, texts[9]), (1 << 40, texts[10])]
    target = ["ab ab cd", None, "", "hi jk l"]
    wide = spark.createDataFrame([(i, t, "x", b"y") for i, t in docs], "doc_id long, text string, _id string, stream binary")
    draw = importance.Draw((25, 100), 20)
    got = importance.resample(wide, spark.createDataFrame([(t,) for t in target], "text string"), grams, buckets, draw).collect()
    plain = [[None if r._id is None else int(r._id), r.n_features, r.n_words, r.weight, r.score, r.rank] for r in got]
    assert sorted(map(str, plain)) == brute_resample(docs, target, grams, buckets, 25, 100, 20)


def test_resample_empty_and_repeated(spark):
    nothing = spark.createDataFrame([], "doc_id long, text string")
    assert importance.resample(nothing, nothing).count() == 0
    twice = spark.createDataFrame([(1, "w " * 20)] * 20, "doc_id long, text string")
    got = importance.resample(twice, nothing).collect()
    assert len(got) == 20 and sorted(r.rank for r in got if r.rank) == [1, 2]
    with pytest.raises(ValueError):
        importance.feature_streams(twice, buckets=70000)


def test_long_text_is_whole(spark):
    long = "needle " + "hay " * 3_000_000 + "needle"
    got = importance.resample(spark.createDataFrame([(1, long)], "doc_id long, text string"), spark.createDataFrame([("needle",)], "text string")).first()
    assert got.n_features == 3_000_002


P = "Plain words make a paragraph of some length, as articles have. "
PAGES = {
    "template": (f'<html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href="/a">a</a></li></ul></nav><!-- ad --><div class="ad">Buy.</div><article><h1>T &amp; U</h1><p><b>{P}<br><p>Short.</p></article><footer>&copy; x</footer>', f"T & U {P}Short."),
    "bare divisions": (f'<div id=header><a href=/>Site</a></div><ul><li><a href=a>Home</a><li><a href=b>News</a></ul><div id=content><h2>Title</h2><p>{P}</p><p>Short.</p><p>{P}</p></div><div><ul><li><a href=x>One</a></li><li><a href=y>Two</a></li></ul></div><div class=comments><p>{P * 4}</p></div><div id=site-footer>Copyright</div>', f"Title {P}Short. {P}".strip()),
    "article in a form": (f'<form><header>Top</header><main><article><header><h1>T</h1><nav>x</nav></header><p>a&amp;b <b>bo</b>ld&nbsp;x.</p><aside>side</aside><section class="comments"><article><p>{P}</p></article></section></article><div><a href=q>links</a></div></main></form>', "T a&b bold x."),
    "unclosed": ("<nav><ul><li>a<li>b</ul><article><p>one<p>two <script>var x='<p>no</p>';</script>three", "one two three"),
    "comment without end": ("<p>a<p>b <!-- c > d", "a b"),
    "comment within a script": ("<p>a<script><!-- x < y </script><p>b", "a b"),
    "tag without end": ("<p>a 1 < 2 <p>c <a href='", "a 1 < 2 c"),
    "text": ("just text &amp; more", "just text & more"),
    "no content": ("<html><body><nav>x</nav></body></html>", ""),
    "table": (f"<table><tr><td>menu<td><p>{P}<p>{P}</table>", f"menu {P}{P}".strip()),
    "hidden": (f'<p>{P}</p><div hidden>no</div><div style="display: none">no</div><span aria-hidden="true">no</span>', P.strip()),
}


@pytest.mark.parametrize("name", PAGES)
def test_main_text(name):
    page, want = PAGES[name]
    assert main_text(page) == want


def test_pages_of_the_table(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet").withColumn("row", F.lit(1)).withColumn("n_chars", F.lit("clash"))
    odd = pages.limit(1).withColumns({"html": F.lit(None).cast("string"), "page_id": F.lit(-1).cast("long")})
    whole = pages.union(odd)
    got = {r.row.page_id: r for r in extract(whole).collect()}
    for r in whole.collect():
        body = re.search("<article>(.*?)</article>", r.html or "", re.S)
        want = " ".join(html.unescape(re.sub("<[^>]*>", " ", re.sub("</?(b|i|em|a)>", "", body[1]))).split()) if body else ""
        assert (got[r.page_id].text, got[r.page_id].n_chars) == (want, len(want))
    assert extract(pages.limit(0)).count() == 0


def test_markup_costs_no_more_than_its_length():
    for page in ("<div>" * 50_000, "<p><b>" * 50_000, "<li>x" * 50_000, "<!-- " * 50_000, "<a " * 50_000, "<script>" + "x</scrip" * 50_000):
        main_text(page + "x")


def brute_negatives(rows, anchors, positives, negatives, low, high):
    out, rows = [], sorted({(i, lab, tuple(v)) for i, lab, v in rows})
    dot = lambda a, b: sum(int(x) * int(y) for x, y in zip(a, b, strict=False))
    for i, lab, v in rows:
        if anchors(i):
            near = sorted((-dot(v, w), j) for j, other, w in rows if other == lab and j != i)[:positives]
            far = sorted((-dot(v, w), j) for j, other, w in rows if other != lab)
            for s, p in near:
                fit = [(n, j) for n, j in far if low * -s <= 100 * -n <= high * -s]
                out += [(i, p, k, j, -s, -n) for k, (n, j) in enumerate(fit[:negatives], 1)]
    return sorted(out)


@pytest.mark.parametrize("scale", [8, 1 << 20])
def test_hard_negatives(spark, monkeypatch, scale):
    monkeypatch.setattr(hard_negatives, "ROWS", 64)
    monkeypatch.setattr(hard_negatives, "PART", 64 * 8 * 6)
    rnd = random.Random(5)
    centers = [[rnd.gauss(0, 1) for _ in range(6)] for _ in range(8)]
    rows = [(i, i % 3, [c + rnd.gauss(0, 0.3) for c in centers[i % 8]]) for i in range(400)]
    rows += [(1000 + i, 1, [0.5] * 6) for i in range(120)]  # a common vector
    rows += [rows[0], rows[5], (7, 2, [1.0] * 6), (2000, 0, [0.25, 0.5]), (2010, 2, [])]  # repeats, an id twice, shorter vectors
    odd = [(3000, None, [1.0] * 6), (3010, 1, None), (3020, 1, [None, 1.0]), (3030, 1, [float("nan")] * 6), (3040, 1, [float("inf")] * 6), (None, 1, [1.0] * 6)]
    table = spark.createDataFrame([(i, lab, v, 0, "x") for i, lab, v in rows + odd], "vec_id long, label int, embedding array<double>, _own int, part string")
    plain = [(i, lab, [math.floor(scale * x) for x in v]) for i, lab, v in rows]
    small = hard_negatives.valid_rows(table, scale=scale)
    assert sorted((r._own, r._label, tuple(r._v)) for r in small.collect()) == sorted((i, lab, tuple(map(float, v))) for i, lab, v in plain)
    monkeypatch.setattr(hard_negatives, "valid_rows", lambda v, **_: small)
    for m in (hard_negatives.Mining(), hard_negatives.Mining(3, 4, 50, 120)):
        got = sorted(map(tuple, hard_negatives.mine(table, F.col("_own") % 10 == 0, m).collect()))
        assert got == brute_negatives(plain, lambda i: i % 10 == 0, m.positives, m.negatives, m.low, m.high)


def test_hard_negatives_of_nothing(spark):
    nothing = spark.createDataFrame([], "vec_id long, label int, embedding array<float>")
    assert hard_negatives.mine(nothing, F.lit(True)).collect() == []


def test_brackets_spare_most_rows():
    """Rows in tight clusters: few are checked exactly, and the best are found all the same; products beyond doubles are exact."""
    rnd = np.random.default_rng(3)
    centers = rnd.integers(-2000, 2000, (40, 16))
    x = np.floor(centers[np.arange(8000) % 40] + rnd.normal(0, 8, (8000, 16)))
    most = float((x**2).sum(1).max())
    added = np.sqrt(most - (x**2).sum(1))
    pivots = hard_negatives.Pivots(np.hstack([x[:12], added[:12, None]]), most)
    far = pivots.distances(x, added)
    order = np.lexsort((far.min(1), far.argmin(1)))
    r = {"size": len(x), "ids": order.astype(np.int64).tobytes(), "labels": np.zeros(len(x), dtype=np.int64).tobytes(), "vectors": x[order].tobytes(), "far": far[order].tobytes()}
    q = x[17]
    held, checked = hard_negatives.nearest(-1, 0, q, pivots.distances(q[None], 0.0)[0], [[*hard_negatives.ANY], [int(q @ q) // 2, int(q @ q)]], [hard_negatives.Rows({**r, **{k: r[k][a * w : (a + 1000) * w] for k, w in (("ids", 8), ("labels", 8), ("vectors", 128), ("far", 96))}, "size": 1000}) for a in range(0, 8000, 1000)], most, 5, True)
    scores = (x @ q).astype(int)
    assert held[0][1].tolist() == sorted(range(8000), key=lambda i: (-scores[i], i))[:5]
    assert held[1][1].tolist() == sorted((i for i in range(8000) if int(q @ q) // 2 <= scores[i] <= int(q @ q)), key=lambda i: (-scores[i], i))[:5]
    assert checked < 6000
    assert hard_negatives.products(np.array([[2.0**31, 3.0]]), np.array([2.0**30, 1.0])).tolist() == [2**61 + 3]


def test_components(spark):
    """Chains, stars around large and small names, rings, doubled and self edges, against union-find."""
    from ledgerloom.llm.components import components

    rnd = random.Random(8)
    edges = [(i, i + 1) for i in range(0, 40) if i % 13] + [(500, i) for i in range(450, 480)] + [(100, i) for i in range(101, 130)] + [(200 + i, 200 + (i + 1) % 17) for i in range(17)] + [(7, 7), (999, 999), (1, 2), (2, 1)]
    edges += [(rnd.randrange(600, 700), rnd.randrange(600, 700)) for _ in range(60)]
    rnd.shuffle(edges)
    root = {}
    find = lambda x: x if root.setdefault(x, x) == x else find(root[x])
    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a int, b int")).collect()}
    assert got == {x: find(x) for x in root}
    assert components(spark.createDataFrame([(3, 3)], "a int, b int")).count() == 0
