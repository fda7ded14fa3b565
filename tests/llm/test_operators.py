"""Training-data operators against brute force on small inputs with nulls, empty and long texts, ties and repeats."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import bin_completion, chosen_path, language_id, line_dedup, media, merge_agenda, packing, piece_codec, quality_rules, substring_dedup, token_files, tokens, url_filters, wordhash

P = pytest.importorskip("public_tokenizers")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = "A line that is long enough to count as one, indeed."
RND = random.Random(11)
VOCAB = ["alpha", "beta", "gamma", "delta", "été", "中文", "x,", "end.", "The", "of"]
PASSAGE = " ".join(RND.choice(VOCAB) + str(i) for i in range(30))
TEXTS = [
    None, "", " \n\t ", "one two", f"{LONG}\nshort\n{LONG.upper()}", f" {LONG} \nx", f"{LONG}\n\n", LONG, f"y\n{LONG}", "z\n",
    PASSAGE, f"start {PASSAGE} finish", f"{PASSAGE} {PASSAGE}", PASSAGE, "w " * 3000, "été été été été", "no  double   spaces\n \nhere",
    *[" ".join(RND.choice(VOCAB) for _ in range(RND.randint(0, 60))) for _ in range(60)],
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if i % 3 else None, "clash", "clash") for i, t in enumerate(TEXTS)]
    rows += [(None, PASSAGE, "en", "a", "b"), (3, "one two", "en", "a", "b")]  # a null id, and a repeated row
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, kept string, _id string").repartition(3).cache()


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def by_id(rows, *columns):
    out = collections.defaultdict(list)
    for r in rows:
        out[r[0]].append(tuple(r[c] for c in columns))
    return out


def test_line_dedup(docs, empty):
    got = line_dedup.dedup_lines(docs).select("row.doc_id", "n_lines", "n_dropped", "kept").collect()
    key = lambda x: re.sub("[A-Z]", lambda m: m[0].lower(), x.strip(" \t\n\x0b\x0c\r"))
    owners = collections.defaultdict(set)
    pairs = [(r.doc_id, r.text or "") for r in docs.collect()]
    for i, t in pairs:
        for x in t.split("\n"):
            if len(key(x)) >= 40 and i is not None:
                owners[key(x)].add(i)
    want = []
    for i, t in pairs:
        kept = [x for x in t.split("\n") if len(owners.get(key(x), ())) < 5 or max(owners[key(x)]) == i]
        want.append((i, len(t.split("\n")), len(t.split("\n")) - len(kept), "\n".join(kept)))
    order = lambda x: sorted(map(tuple, x), key=str)
    assert order(got) == order(want)
    assert sum(w[2] for w in want) > 0
    assert line_dedup.dedup_lines(empty).count() == 0


def test_quality_measures(docs, empty):
    got = by_id(quality_rules.measures(docs).select("_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect(), 1, 2, 3, 4, 5, 6)
    for i, t in enumerate(TEXTS):
        t = t or ""
        w = WORD.findall(t)
        seen = collections.Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
        again = {k + j for k in range(len(w) - 2) if seen[tuple(w[k : k + 3])] > 1 for j in range(3)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(again), len(w) < 50 or 100 * len(again) > 50 * len(w))
        assert want in got[i], (i, t[:50])
    assert quality_rules.measures(empty).count() == 0


def test_quality_thresholds_keep_their_risk(spark):
    from math import comb

    rnd = random.Random(3)
    rows, labels = [], []
    for i in range(6000):
        good = rnd.random() < 0.9
        symbols = "# " * (0 if good else 200)
        rows.append((i, " ".join(f"w{rnd.randint(0, 10**6)}" for _ in range(60)) + " " + symbols, "en"))
        labels.append((i, int(good)))
    d, y = spark.createDataFrame(rows, "doc_id long, text string, lang string"), spark.createDataFrame(labels, "doc_id long, quality int")
    out = quality_rules.assess(d, y).join(y, F.col("_id") == y.doc_id)
    counts = {(r["quality"], r["kept"]): r["count"] for r in out.groupBy("quality", "kept").count().collect()}
    assert counts.get((1, False), 0) == 0 and counts.get((0, True), 0) == 0
    few = quality_rules.assess(d, y.limit(20))  # too few labels to certify anything
    assert few.filter("not kept and not base_failed").isEmpty()
    assert quality_rules.assess(d.limit(5), y.limit(0)).count() == 5
    a, n, k = 0.004, 300, 1  # the tail used for certification, against its definition
    tail = sum(comb(n, j) * a**j * (1 - a) ** (n - j) for j in range(k + 1))
    assert 0.6 < tail < 0.7
    kept = quality_rules.keep_good(d, y)
    assert kept.columns == d.columns and kept.count() == sum(v for (q, ok), v in counts.items() if ok)


def test_urls(spark):
    rows = [(1, "http://A.Example.com/en/71?x#y", None), (2, "https://b.com/en/x", '<a href="//good.net/x">'), (3, None, "x"), (4, "no scheme", None), (5, "http://example.net/de/80", ""), (6, "http://x.net/de/", ""), (7, "ftp://h.org#es/", ""), (7, "ftp://h.org#es/", ""), (8, "http://b.com/zz", ""), (9, "://", "")]
    d = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = by_id(url_filters.filter_urls(d).select("row.page_id", "host", "path", "rule", "verdict").collect(), 1, 2, 3, 4)
    assert got[1] == [("a.example.com", "/en/71", "example.com/en/7", "allow")]
    assert got[2] == [("b.com", "/en/x", "com/en/", "block")]
    assert got[3] == got[4] == [("", "", None, "allow")] and got[9] == [("", "", None, "allow")]
    assert got[5] == [("example.net", "/de/80", "example.net/de/8", "block")] and got[6] == [("x.net", "/de/", "net/de/", "block")]
    assert got[7] == [("h.org", "", None, "allow")] * 2
    assert got[8] == [("b.com", "/zz", None, "block")]  # half of its host's pages are blocked
    assert url_filters.filter_urls(d.limit(0)).count() == 0


def test_rules_of_the_contract(spark, tmp_path):
    """One page a rule on hosts of their own, through the whole query; a net/de/ page isn't blocked, nor does it block its host."""
    rows = [(1, "http://a.com/en/1"), (2, "http://b.example.com/en/7"), (3, "http://x.net/de/1"), (4, "http://x.net/zz"), (5, "http://y.example.net/de/8"), (6, "http://c.org/es/")]
    spark.createDataFrame([(i, u, "") for i, u in rows], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.page_id: (r.rule, r.verdict) for r in url_filters.query(spark, str(tmp_path)).collect()}
    assert got == {1: ("com/en/", "block"), 2: ("example.com/en/7", "allow"), 3: ("net/de/", "allow"), 4: (None, "allow"), 5: ("example.net/de/8", "block"), 6: ("org/es/", "block")}


def test_propagation(spark):
    edges = spark.createDataFrame([("a", "b", 1), ("a", "c", 3), ("b", "c", 1)], "_src string, _dst string, _n long")
    seeds = spark.createDataFrame([(1, "a", 4.0), (0, "c", 2.0)], "kind int, host string, seed double")
    got = {(r["kind"], r["host"]): r["mass"] for r in url_filters.propagate(edges, seeds, 0.5, 0.02).collect()}
    assert got == pytest.approx({(1, "a"): 4.0, (1, "b"): 0.5, (1, "c"): 1.75, (0, "c"): 2.0, (0, "a"): 0.75 + 0.125, (0, "b"): 0.25})


def test_propagation_to_a_tolerance(spark):
    """Against the exact solution on a cycle, where mass never ends: what is missing stays below the tolerance."""
    edges = spark.createDataFrame([("a", "b", 1), ("b", "c", 2), ("c", "a", 1), ("c", "b", 1)], "_src string, _dst string, _n long")
    seeds = spark.createDataFrame([(1, "a", 5.0), (1, "c", 1.0)], "kind int, host string, seed double")
    got = {r["host"]: r["mass"] for r in url_filters.propagate(edges, seeds).collect() if r["kind"] == 1}
    move = np.array([[0, 1, 0], [0, 0, 1], [0.5, 0.5, 0]])
    exact = np.linalg.solve(np.eye(3) - url_filters.DAMPING * move.T, [5.0, 0, 1.0])
    missing = exact - [got[h] for h in "abc"]
    assert (missing >= -1e-9).all() and missing.sum() <= url_filters.TOLERANCE * exact.sum()


def test_words():
    for block in (8, 1 << 20):
        wordhash.BLOCK, was = block, wordhash.BLOCK
        w = wordhash.Words(pa.array([t or "" for t in TEXTS]))
        wordhash.BLOCK = was
        names = {}
        at = 0
        for i, t in enumerate(TEXTS):
            for x in WORD.findall(t or ""):
                assert bytes(w.data[w.start[at] : w.end[at]]).decode() == x and w.row[at] == i and names.setdefault(x, w.hash[at]) == w.hash[at]
                at += 1
        assert at == len(w.hash) and len(set(names.values())) == len(names)


def brute_substrings(pairs, size=20):
    first = {}
    for i, words in pairs:
        for k in range(len(words) - size + 1):
            first.setdefault(tuple(words[k : k + size]), (i, k))
    for i, words in pairs:
        gone = set()
        for k in range(len(words) - size + 1):
            if first[tuple(words[k : k + size])] < (i, k):
                gone |= set(range(k, k + size))
        yield i, len(words), len(gone), hashlib.sha256(" ".join(w for k, w in enumerate(words) if k not in gone).encode()).hexdigest()


def test_substring_dedup(docs, empty):
    d = docs.filter("doc_id is not null")
    got = by_id(substring_dedup.dedup_substrings(d).select("row.doc_id", "n_words", "n_removed", "kept_sha256").collect(), 1, 2, 3)
    for i, *want in brute_substrings([(i, WORD.findall(t or "")) for i, t in enumerate(TEXTS)]):
        assert set(got[i]) == {tuple(want)}, i
    assert sum(r[0][1] for r in got.values()) > 3000
    whole = substring_dedup.dedup_substrings(docs).filter("row.doc_id = 10").head()  # the null id comes first
    assert whole["n_removed"] == 30 and whole["kept"] == "" and whole["spans"] == [[0, 30]]
    assert substring_dedup.dedup_substrings(empty).count() == 0


@pytest.mark.parametrize("parts", [1, 3])
def test_substring_dedup_by_many_ranges(spark, docs, monkeypatch, parts):
    """More ranges than partitions, whose number follows the bytes of the texts and no estimate of a plan."""
    monkeypatch.setattr(substring_dedup, "RANGE_BYTES", 500)
    d = docs.filter("doc_id is not null").unionAll(spark.createDataFrame([(9999, PASSAGE, "en", "", "")], docs.schema))
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    got = by_id(substring_dedup.dedup_substrings(d).select("row.doc_id", "n_words", "n_removed", "kept_sha256").collect(), 1, 2, 3)
    assert substring_dedup.repeated_windows(d).rdd.getNumPartitions() == parts
    spark.conf.set("spark.sql.shuffle.partitions", was)
    for i, *want in brute_substrings([(i, WORD.findall(t or "")) for i, t in [*enumerate(TEXTS), (9999, PASSAGE)]]):
        assert set(got[i]) == {tuple(want)}, i


def jaccard(a, b):
    return len(a & b) / len(a | b)


def shingles(t, n=5):
    w = WORD.findall(t or "")
    return frozenset(tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))) if w else frozenset()


def test_jaccard_join(spark, docs, empty):
    rnd = random.Random(9)
    base = [[f"w{rnd.randint(0, 5000)}" for _ in range(rnd.randint(20, 120))] for _ in range(40)]
    texts = list(TEXTS)
    for b in base:
        texts.append(" ".join(b))
        for _ in range(rnd.randint(0, 6)):
            c = list(b)
            for _ in range(rnd.randint(0, 3)):
                c[rnd.randrange(len(c))] = f"v{rnd.randint(0, 9)}"
            texts.append(" ".join(c))
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found, want = chosen_path.jaccard_join(d).collect(), brute_links(texts)
    assert {r["_id"]: (r["class_id"], r["n_links"]) for r in found} == want
    same = collections.Counter(shingles(t) for t in texts)
    assert {r["_id"]: r["n_copies"] for r in found} == {i: same[shingles(t)] if shingles(t) else 1 for i, t in enumerate(texts)}
    assert sum(n for _, n in want.values()) > 200
    assert chosen_path.jaccard_join(empty).count() == 0
    kept = chosen_path.keep_one(docs)
    assert kept.columns == docs.columns
    assert kept.filter("doc_id = 3").count() == 1 and kept.filter("doc_id in (10, 13)").isEmpty()  # the null id is the first of their class


def copies_of(base, n, edits, seed):
    rnd, out = random.Random(seed), []
    for _ in range(n):
        c = list(base)
        for _ in range(edits):
            c[rnd.randrange(len(c))] = f"v{rnd.randint(0, 10**6)}"
        out.append(" ".join(c))
    return out


def brute_links(texts):
    sets, root, links = [shingles(t) for t in texts], list(range(len(texts))), [0] * len(texts)
    find = lambda x: x if root[x] == x else find(root[x])
    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and jaccard(sets[i], sets[j]) >= 0.8 - 1e-12:
                links[i] += 1
                links[j] += 1
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (find(i), links[i]) for i in range(len(texts))}


@pytest.mark.parametrize("edits", [1, 3])
def test_large_buckets(spark, monkeypatch, edits):
    """Large buckets go by leaders and large components by blocks: near copies of several texts that share half of their words."""
    monkeypatch.setattr(chosen_path, "BLOCK", 7)
    half = [f"w{i}" for i in range(150)]
    texts = [t for k in range(3) for t in copies_of([*half, *[f"x{k}-{i}" for i in range(150)]], 40, edits, k)]
    texts += [" ".join([*half[:40], *[f"y{k}-{i}" for i in range(60)]]) for k in range(30)]
    monkeypatch.setattr(chosen_path, "candidate_edges", lambda n, r, lv, f=chosen_path.candidate_edges: f(n, r, lv, 16, 5))
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = brute_links(texts)
    assert {r["_id"]: (r["class_id"], r["n_links"]) for r in chosen_path.jaccard_join(d).collect()} == want
    assert sum(n for _, n in want.values()) > 1000


def test_rows_follow_the_size_of_a_group(spark, monkeypatch):
    """Edges and link counts for one group of G near copies grow with G; only pairs of blocks, a row each, with (G / BLOCK)^2."""
    monkeypatch.setattr(chosen_path, "BLOCK", 50)
    seen = {}
    for g in (400, 1600):
        texts = copies_of([f"w{i}" for i in range(120)], g, 1, g)
        d = spark.createDataFrame(list(enumerate(texts)), "_id long, _text string").withColumn("_sum", F.lit(0).cast("long"))
        runs = 2
        nodes = d.mapInArrow(chosen_path._signatures(runs, 3, 4.0, 5), "_id long, _sum long, node binary, n long, sketch binary, picks array<array<long>>").dropDuplicates(["node"]).cache()
        edges = chosen_path.candidate_edges(nodes, runs, 3, 100, 20)
        sets = d.select(F.lit(b"c").alias("comp"), F.xxhash64("_text").cast("string").cast("binary").alias("node"), F.lit(1).cast("long").alias("weight"), F.lit(g // 50).alias("parts"), "_text").mapInArrow(chosen_path._with_shingles(5), "comp binary, node binary, weight long, parts int, shingles binary")
        links, tied = chosen_path.verified(sets.withColumn("block", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")), chosen_path.THRESHOLD)
        seen[g] = (edges.count(), links.count(), tied.count())
        assert seen[g][1] == nodes.count()
        assert seen[g][2] <= g + (g // 50) * (g // 50 - 1) / 2
    assert seen[1600][0] <= 4.5 * seen[400][0], seen


def test_strangers_in_a_large_bucket_meet(spark):
    """Leaders settle themselves alone, which leaves fewer than a bucket of strangers: those must still meet each other."""
    rng = np.random.default_rng(5)
    rows, pairs = [], set()
    for bucket in range(12):  # of 24 strangers each, but for one pair
        sketches = rng.integers(0, 256, (24, chosen_path.SKETCH), dtype=np.uint8)
        sketches[1, 20:] = sketches[0, 20:]
        rows += [(bytes([bucket, k]), s.tobytes(), [[bucket]] * 3) for k, s in enumerate(sketches)]
        pairs.add((bytes([bucket, 0]), bytes([bucket, 1])))
    nodes = spark.createDataFrame(rows, "node binary, sketch binary, picks array<array<long>>")
    edges = chosen_path.candidate_edges(nodes, 1, 3, bucket=20, leaders=6).collect()
    assert {tuple(sorted((bytes(e["a"]), bytes(e["b"])))) for e in edges} == pairs


def test_runs():
    assert chosen_path.runs_for(0.99999) == 6 and chosen_path.runs_for(0.5, picks=20.0) == 1


FUZZ = ["a", "B", "é", "'s", "  ", " ", "\n", " \n", "\t", "12", "!", "​", "　", "́", "中", "😀", "<|endoftext|>", "\x1c", "\x85", "Σ", "İ,", "ﬁ", ". ", ", the", "ing", "\r\n", "\x00", "▁", "▁▁", "    ", "7", "x" * 60]


def fuzz(n=4000):
    rnd = random.Random(2)
    return ["".join(rnd.choice(FUZZ) for _ in range(rnd.randint(0, 25))) for _ in range(n)] + [t or "" for t in TEXTS]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_chunk_encoder(name):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(P.path(name))
    enc = tokens.ChunkEncoder(P.path(name), limit=2000)  # so small that it forgets
    special = "<|endoftext|>"
    texts = [*fuzz(), f"a {special} b", special, f"{special}{special} x", f"x \n{special}", special.upper(), "<|endoftext", f"<|startoftext|>a{special}"]
    for i in range(0, len(texts), 500):
        part = texts[i : i + 500]
        ids, at = enc.encode(pa.array(part))
        assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == [e.ids for e in plain.encode_batch(part, add_special_tokens=False)]


def test_piece_codec(docs, empty):
    c = piece_codec.PieceCodec(P.path("piece_bpe_32k.model"), limit=3000)
    texts = fuzz()
    for i in range(0, len(texts), 500):
        got = c.encode(texts[i : i + 500])
        assert [[x for e in g for x in e[1]] for g in got] == c.library.encode(texts[i : i + 500])
        assert not any(e[2] for g in got for e in g)
    chunks = [merge_agenda.SPACE + w for t in texts for w in t.split()]
    assert c.table.encode_many(chunks) == [c.table.encode_one(w) for w in chunks]
    rows = by_id(piece_codec.encode_pieces(docs, P.path("piece_bpe_32k.model")).select("doc_id", "ids", "decoded", "n_tokens", "n_differing").collect(), 1, 2, 3, 4)
    for i, t in enumerate(TEXTS):
        ids = c.library.encode(t or "")
        assert rows[i][0] == (ids, c.library.decode(ids) if ids else "", len(ids), 0)
    assert piece_codec.encode_pieces(empty, P.path("piece_bpe_32k.model")).count() == 0


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_words_of_letters_by_the_model(name):
    """Words of letters get the library's ids without its normalizer and pattern, which see only what is left."""
    P = pytest.importorskip("public_tokenizers")
    words = ["Stra\u00dfe", "\u00e9t\u00e9", "ONTHE", "aa", "x", "\u00ff\u00ff", "Zeit"]
    texts = ["", *words, " ".join(words), "\n".join(words), ". ".join(words) + "!", "\n".join(f"{w}, {w}7 {w}'s" for w in words), "\u00aa\u00ba\u00b5 \u0130x"]
    enc = tokens.ChunkEncoder(P.path(name))
    seen = []
    enc._each = lambda chunks, each=enc._each: (seen.extend(chunks), each(chunks))[1]
    ids, at = enc.encode(pa.array(texts))
    for t, a, b in zip(texts, at[:-1], at[1:], strict=True):
        assert ids[a:b].tolist() == enc.tokenizer.encode(t, add_special_tokens=False).ids, t
    assert enc.lean is not None and not [c for c in seen if tokens._WORD.fullmatch(c)]


def test_chunks_that_are_one():
    """Marks after a word, and white space and case where the tokenizer drops them, make no chunks of their own."""
    P = pytest.importorskip("public_tokenizers")
    texts = ["Word", "word word.\nword### WORD?!\nWord", "caf\u00e9&&& Caf\u00e9.", "H\u0331. h\u0331.", "7. a7! .a .a.", "\u00d7. \u00f7, \u4e57,", "."]
    for name, known in (("word_bpe_49k.json", {"word", "caf\u00e9", "Caf\u00e9"}), ("byte_bpe_50k.json", {"word", "WORD", "\nword", "\nWord", "\ncaf\u00e9", "Caf\u00e9"})):
        enc = tokens.ChunkEncoder(P.path(name))
        ids, at = enc.encode(pa.array(texts))
        for t, a, b in zip(texts, at[:-1], at[1:], strict=True):
            assert ids[a:b].tolist() == enc.tokenizer.encode(t, add_special_tokens=False).ids, t
        assert {c for c in enc.ids if "word" in c.lower() or "caf" in c.lower()} == known
        for few in (pa.array([], pa.string()), pa.array([""]), pa.array(["Word.", "\n", "x y!"]).slice(1)):
            ids, at = enc.encode(few)
            assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == [enc.tokenizer.encode(t, add_special_tokens=False).ids for t in few.to_pylist()]


def test_marked_pieces():
    """Words with a mark are learned from their two parts and get the library's ids all the same."""
    P = pytest.importorskip("public_tokenizers")
    c = piece_codec.PieceCodec(P.path("piece_bpe_32k.model"))
    words = ["Stra\u00dfe", "\u00e9t\u00e9", "ONTHE", "aa", "x", "Zeit", "erndedan"]
    texts = [f"{w}{m}" for w in words for m in [*".,;:!?", "!!", "'s.", "7.", " ,"]] + [". ".join(words) + "?"]
    learned = []
    c._check = lambda chunks, check=c._check: (learned.extend(chunks), check(chunks))[1]
    for t, entries in zip(texts, c.encode(texts), strict=True):
        ids = [i for e in entries for i in e[1]]
        assert ids == c.library.encode(t) and ",".join([e[0] for e in entries]) == ",".join(map(str, ids)), t
    assert c.marks and not [x for x in learned if x[-1] in c.marks and x[:-1].isalpha()]


def test_pieces_cut_at_lines_and_marks():
    """Line feeds and runs of marks make no chunks of their own words; spaces beside spaces are cut one by one."""
    P = pytest.importorskip("public_tokenizers")
    S = merge_agenda.SPACE
    c = piece_codec.PieceCodec(P.path("piece_bpe_32k.model"))
    texts = ["word\nword", "word.\nword### word?!\n\nword", f"word  word {S}word \nword\n word", "\nword", "\n", "", f"word{S}\nword", "7. a7! .a \u00d7. \u4e57,", "x" * 60 + ".\n" + "y" * 60]
    learned = []
    c._check = lambda chunks, check=c._check: (learned.extend(chunks), check(chunks))[1]
    assert [[i for e in g for i in e[1]] for g in c.encode(texts[:2])] == c.library.encode(texts[:2])
    assert {w for w in learned if "word" in w} == {"word", "\nword"}
    for batch in (texts, texts[:1], texts[4:6], []):
        ids, at = c.encode_column(pa.array(batch, pa.string()))
        own = [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)]
        assert own == c.library.encode(batch)
        assert c.names(ids, at) == [",".join(map(str, x)).encode() for x in own]


def test_sketches_and_picks_go(spark, docs):
    """Tables with sketches and picks don't outlive the search for candidates."""
    from pathlib import Path
    from urllib.parse import urlparse

    from ledgerloom.llm.common import shared_root

    root = Path(urlparse(shared_root(spark)).path)
    before = set(root.iterdir())
    found = chosen_path.jaccard_join(docs)
    left = {p.name: spark.read.parquet(str(p)).columns for p in set(root.iterdir()) - before if p.is_dir()}
    assert left and not [n for n, columns in left.items() if {"sketch", "picks", "deeper"} & set(columns)]
    assert found.count() == docs.count()


def test_token_files(spark, docs, empty, tmp_path):
    import pyarrow.parquet as pq
    from tokenizers import Tokenizer

    name = P.path("word_bpe_49k.json")
    token_files.write_tokens(docs, str(tmp_path / "t"), name, end_id=2)
    got = token_files.read_tokens(spark, str(tmp_path / "t")).orderBy("start").collect()
    plain = Tokenizer.from_file(name)
    ids = [i for r in got for i in r["ids"]]
    ordered = sorted(docs.collect(), key=lambda r: -1 if r.doc_id is None else r.doc_id)
    assert [r["doc_id"] for r in got] == [r.doc_id for r in ordered]
    assert ids == [i for r in ordered for i in [*plain.encode(r.text or "", add_special_tokens=False).ids, 2]]
    assert [r["start"] for r in got] == np.cumsum([0, *[r["n_tokens"] for r in got]])[:-1].tolist()
    assert token_files.read_metadata(spark, str(tmp_path / "t")).columns == ["doc_id", "start", "n_tokens", "part"]
    meta = pq.ParquetFile(next((tmp_path / "t").glob("*.parquet"))).metadata.row_group(0)
    kinds = {meta.column(i).path_in_schema: meta.column(i) for i in range(meta.num_columns)}
    assert "DELTA_BINARY_PACKED" in kinds["n_tokens"].encodings and kinds["ids.list.element"].has_dictionary_page and kinds["doc_id"].has_offset_index
    token_files.write_tokens(empty, str(tmp_path / "e"), name, end_id=2)
    assert token_files.read_tokens(spark, str(tmp_path / "e")).count() == 0


def test_bin_completion():
    rnd = random.Random(3)

    def least(items, cap):
        best = len(items)

        def go(i, bins):
            nonlocal best
            if len(bins) >= best:
                return
            if i == len(items):
                best = len(bins)
                return
            for j in {b: k for k, b in enumerate(bins) if b + items[i] <= cap}.values():
                bins[j] += items[i]
                go(i + 1, bins)
                bins[j] -= items[i]
            go(i + 1, [*bins, items[i]])

        go(0, [])
        return best

    for _ in range(120):
        cap = rnd.choice([10, 20, 50])
        items = sorted((rnd.randint(1, cap) for _ in range(rnd.randint(0, 9))), reverse=True)
        plan = bin_completion.pack_counts(collections.Counter(items), cap)
        used = collections.Counter()
        for pattern, times in plan:
            assert sum(pattern) <= cap
            used += collections.Counter({n: c * times for n, c in collections.Counter(pattern).items()})
        assert used == collections.Counter(items)
        assert sum(m for _, m in plan) == least(items, cap) >= bin_completion.lower_bound(collections.Counter(items), cap)
    with pytest.raises(ValueError):
        bin_completion.pack_counts({11: 1}, 10)


def check_packing(rows, texts, capacity):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    sequences, pieces = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"]].append(r)
    for spots in sequences.values():
        at = 0
        for offset, length in sorted(spots):
            assert offset == at
            at += length
        assert at <= capacity
    for i, t in texts:
        ids, at = [*plain.encode(t or "", add_special_tokens=False).ids, 0], 0
        own = sorted(pieces[i], key=lambda r: r["piece"])
        for k, r in enumerate(own):
            assert (r["piece"], r["start"]) == (k, at) and r["ids_crc32"] == zlib.crc32(np.array(ids[at : at + r["length"]], "<u4").tobytes())
            assert r["length"] == capacity or k == 0
            at += r["length"]
        assert at == len(ids) and (len(own) == 1 or len(ids) > capacity)
    return len(sequences), sum(r["length"] for r in rows)


def test_packing(docs, empty):
    d = docs.filter("doc_id is not null and doc_id <> 3")
    rows = packing.pack_documents(d, P.path("byte_bpe_50k.json"), capacity=128).collect()
    used, total = check_packing(rows, [(i, t) for i, t in enumerate(TEXTS) if i != 3], 128)
    assert used <= -(-total // 128) + 1
    assert packing.pack_documents(docs, P.path("byte_bpe_50k.json")).select("sequence_id", "offset").distinct().count() == packing.pack_documents(docs, P.path("byte_bpe_50k.json")).count()
    assert packing.pack_documents(empty, P.path("byte_bpe_50k.json")).count() == 0


def test_media(spark, docs, empty, tmp_path):
    import tarfile

    folder = f"file://{tmp_path}/media"
    index = media.store(docs, folder).cache()
    got = index.join(media.features(index, folder), "digest").collect()
    want = {i: (t or "").encode() for i, t in enumerate(TEXTS)}
    assert len(got) == docs.count()
    for r in got:
        raw = want.get(r["doc_id"], PASSAGE.encode())
        payload = media.pad(raw)
        assert len(payload) % 64 == 0 and payload
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
    heads = media.metadata(index, folder).collect()
    assert {r["width"] for r in heads} == {64} and len(heads) == len({media.pad(r) for r in want.values()})
    for shard in (tmp_path / "media").glob("*.tar"):
        with tarfile.open(shard) as t:
            for m in t.getmembers():
                assert hashlib.sha256(t.extractfile(m).read()).hexdigest() + ".png" == m.name
    assert media.store(empty, folder).count() == 0
    data = media.encode_png(bytes(range(256)))
    assert media.decode_png(data) == bytes(range(256))
    with pytest.raises(ValueError):
        media.read_header(data[1:34])


def test_language(spark, sf):
    d = spark.read.parquet(f"{sf}/documents.parquet")
    model = language_id.train(d.filter("doc_id % 2 = 0"))
    odd = d.filter("doc_id % 2 = 1")
    pairs = language_id.identify(odd, model).select("row.lang", "lang_pred", "score").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in pairs) >= 0.98 * len(pairs) and all(0 <= r["score"] <= 1 for r in pairs)
    edge = spark.createDataFrame([(1, None), (2, ""), (3, "12 ?! \n"), (4, "the and of " * 50_000)], "doc_id long, text string")
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.identify(edge, model).select("row.doc_id", "lang_pred", "score").collect()}
    assert got[1] == got[2] == got[3] == ("und", 0.0) and got[4][0] in model.languages
    assert language_id.identify(edge.limit(0), model).count() == 0
    nothing = language_id.train(d.limit(0))
    assert {r["lang_pred"] for r in language_id.identify(edge, nothing).collect()} == {"und"}
    assert language_id.identify(spark.createDataFrame([(1, "½ ² ① Ⅷ 4"), (2, "ª")], "doc_id long, text string"), model).filter("lang_pred = 'und'").count() == 1
    with pytest.raises(ValueError, match="languages"):
        language_id.labelled_sample(d, sample=2)
    a, b = language_id.weighted(["Hallo Welt", "hello world"])
    held = lambda t, n: {t.lower()[i : i + n] for i in range(len(t) - n + 1)}
    want = sum(w * len(held("Hallo Welt", n) & held("hello world", n)) / (len(held("Hallo Welt", n)) * len(held("hello world", n))) ** 0.5 for n, w in language_id.GRAMS.items())
    assert float(a @ b) == pytest.approx(want, abs=0.02)  # hashing may join a few


def test_language_against_plain_kernel_ridge(spark, sf):
    """With every text a landmark: kernel ridge regression on exact n-gram sets, solved in its dual form."""
    rows = spark.read.parquet(f"{sf}/documents.parquet").filter("lang is not null and length(text) between 50 and 1500").orderBy("doc_id").limit(90).collect()
    texts, own = [r.text for r in rows], np.array([r.lang for r in rows])
    grams = [{n: {t[i : i + n] for i in range(len(t) - n + 1)} for n in language_id.GRAMS} for t in (x.lower() for x in texts)]
    k = np.array([[sum(w * len(a[n] & b[n]) / (len(a[n]) * len(b[n])) ** 0.5 for n, w in language_id.GRAMS.items()) for b in grams] for a in grams])
    names = sorted(set(own))
    y = np.where(own[:60, None] == np.array(names)[None, :], 1.0, -1.0)
    share = np.array([1 / (own[:60] == x).sum() for x in own[:60]])
    alpha = np.linalg.solve(share[:, None] * k[:60, :60] + language_id.RIDGE / len(names) * np.eye(60), share[:, None] * y)
    want = k[60:, :60] @ alpha
    model = language_id.fit(texts[:60], own[:60].tolist(), landmarks=10**6)
    got = language_id.weighted(texts[60:]) @ model.weights
    assert model.languages == names and np.abs(got - want).max() < 0.2
    assert [names[i] for i in want.argmax(axis=1)] == model.predict(texts[60:])[0]


def test_every_column_of_the_digests(spark, sf):
    """Digests that the queries of operators 3, 7 and 8 derive, against the libraries, over the whole smallest table."""
    import sentencepiece
    from tokenizers import Tokenizer

    from ledgerloom.llm.queries import QUERIES

    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    sp = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in QUERIES["op3_piece_codec"](spark, sf).collect()}
    assert got == {i: (len(ids), sha(",".join(map(str, ids))), sha(sp.decode(ids) if ids else "")) for i, ids in ((i, sp.encode(t)) for i, t in texts.items())}
    plain, start = Tokenizer.from_file(P.path("word_bpe_49k.json")), 0
    want = {}
    for i in sorted(texts):
        ids = [*plain.encode(texts[i], add_special_tokens=False).ids, 2]
        want[i] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in QUERIES["op8_token_files"](spark, sf).collect()} == want
    for r in QUERIES["op7_media_columns"](spark, sf).collect():
        payload = media.pad(texts[r.doc_id].encode())
        data, counts = media.encode_png(payload), collections.Counter(payload)
        mode = min(counts, key=lambda b: (-counts[b], b))
        feature = f"64x{len(payload) // 64}x8 mean={sum(payload) * 1000 // len(payload) / 1000:.3f} values={len(counts)} mode={mode}"
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(texts[r.doc_id].encode()), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        assert (r.media_bytes, r.media_sha256, r.feature) == (len(data), hashlib.sha256(data).hexdigest(), feature)


def test_words_that_defeat_polynomials():
    """The Thue-Morse word and its complement have one hash under any polynomial mod 2^64."""
    bits = [bin(i).count("1") % 2 for i in range(4096)]
    a, b = "".join("ab"[x] for x in bits), "".join("ba"[x] for x in bits)
    words = [x[:n] for n in (512, 1024, 2048, 4096) for x in (a, b)]
    assert len(set(wordhash.Words(pa.array(words)).hash.tolist())) == len(words)
