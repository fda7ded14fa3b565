"""Quality rules with risk-controlled thresholds.

Every rule has a score that grows as a text gets worse, and a fixed list of cutoffs from lenient to strict.
Labelled documents that pass the base rules are the holdout. For each stratum and rule the cutoffs are tested in
that order: the null hypothesis "the rule rejects more than its share `alpha / rules` of good documents" has the
exact binomial tail P(Bin(n, alpha / rules) <= k) as its p-value, and testing stops at the first cutoff that
isn't rejected at `delta / (strata * rules)` (fixed sequence within a rule, Bonferroni across). So with probability
1 - delta no stratum loses more than alpha of its good documents. Among the certified cutoffs the one with the best
balance of bad against good documents rejected is used; a rule that gains nothing is left unused.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WS_CHARS, WS_CLASS, lines_of, stash, text_of, words_of

#: Rule name, score over the measures, cutoffs from lenient to strict. A text is rejected when its score is above.
RULES: list[tuple[str, str, list[float]]] = [
    ("symbols", "n_symbols / n_words", [8.0, 4.0, 2.0, 1.0, 0.5, 0.25, 0.1]),
    ("dup_lines", "n_dup_lines / n_lines", [0.9, 0.7, 0.5, 0.4, 0.3, 0.2]),
    ("repeats", "n_repeat_words / n_words", [0.48, 0.44, 0.4, 0.35, 0.3, 0.25, 0.2]),
    ("long_words", "word_chars / n_words", [14.0, 12.0, 10.0, 9.0, 8.0, 7.5, 7.0]),
    ("short_words", "-(word_chars / n_words)", [-1.5, -2.0, -2.5, -3.0, -3.5, -4.0]),
]
#: A good document lost counts as much as this many bad ones rejected when certified cutoffs are compared.
GOOD_WEIGHT = 50


def _same(a: Column, b: Column) -> Column:
    return F.shiftright(a, 31) == F.shiftright(b, 31)


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str | None = "lang") -> DataFrame:
    """`_id, _sum, stratum` and the measures of every text, a row for each input row.

    Words repeated in 3-word windows are found without leaving the row: 32-bit window hashes packed with their
    positions are sorted as plain longs, neighbours with one hash are candidates, and only those are compared by
    their words. The few steps are kept apart so that no array is computed twice.
    """
    text = text_of(text_col)
    d = docs.select(F.col(f"`{id_col}`").alias("_id"), (F.coalesce(F.col(f"`{stratum_col}`").cast("string"), F.lit("")) if stratum_col else F.lit("")).alias("stratum"), text.alias("_t"))
    d = d.select("_id", "stratum", F.xxhash64("_t").alias("_sum"), F.regexp_count("_t", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"), F.filter(lines_of(F.col("_t")), lambda x: F.btrim(x, F.lit(WS_CHARS)) != "").alias("_l"), words_of(F.col("_t")).alias("_w"))
    d = d.select(
        "_id", "stratum", "_sum", "n_symbols", "_w",
        F.size("_l").cast("long").alias("n_lines"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.size("_w").cast("long").alias("n_words"),
        F.char_length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.sort_array(F.transform(F.slice("_w", 1, F.greatest(F.size("_w") - 2, F.lit(0))), lambda w, i: F.shiftleft(F.hash(w, F.get("_w", i + 1), F.get("_w", i + 2)).cast("long"), 31).bitwiseOR(i.cast("long")))).alias("_h"),
    )
    near = F.filter("_h", lambda x, i: ((i > 0) & _same(x, F.get("_h", i - 1))) | ((i < F.size("_h") - 1) & _same(x, F.get("_h", i + 1))))
    d = d.withColumn("_p", F.transform(near, lambda x: x.bitwiseAND(F.lit(2**31 - 1)).cast("int"))).drop("_h")
    d = d.withColumn("_c", F.sort_array(F.transform("_p", lambda p: F.struct(F.array(F.get("_w", p), F.get("_w", p + 1), F.get("_w", p + 2)).alias("w"), p.alias("p"))))).drop("_p", "_w")
    twice = F.filter("_c", lambda x, i: ((i > 0) & (x["w"] == F.get("_c", i - 1)["w"])) | ((i < F.size("_c") - 1) & (x["w"] == F.get("_c", i + 1)["w"])))
    d = d.withColumn("_r", F.sort_array(F.transform(twice, lambda x: x["p"]))).drop("_c")
    steps = F.transform("_r", lambda p, i: F.when(i == 0, 3).otherwise(F.least(F.lit(3), p - F.get("_r", i - 1))))
    d = d.withColumn("n_repeat_words", F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)).drop("_r")
    return d.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def thresholds(measured: DataFrame, labels: DataFrame, alpha: float = 0.02, delta: float = 0.05, label_id: str = "doc_id", label_col: str = "quality", good_weight: int = GOOD_WEIGHT) -> DataFrame:
    """One row for each stratum with labels: `stratum` and `cut_<rule>`, null where no cutoff is certified or worth it.

    Several labels of one document: good if any says so. Null ids or labels are left out.
    """
    marks = labels.select(F.col(f"`{label_id}`").alias("_lid"), F.col(f"`{label_col}`").alias("_q")).filter("_lid is not null and _q is not null").groupBy("_lid").agg((F.max("_q") > 0).alias("good"))
    held = measured.filter("not base_failed").join(marks, F.col("_id") == F.col("_lid"))
    grid = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(i).alias("step"), F.lit(float(c)).alias("cut"), (F.expr(score) > c).alias("hit")) for r, score, cuts in RULES for i, c in enumerate(cuts)])
    g = held.select("stratum", "good", F.explode(grid).alias("g")).select("stratum", "good", "g.*")
    g = g.groupBy("stratum", "rule", "step", "cut").agg(F.count_if("good").alias("n"), F.count_if(F.col("good") & F.col("hit")).alias("k"), F.count_if(~F.col("good") & F.col("hit")).alias("bad"))
    g = stash(g, "grid")
    families = max(1, g.select("stratum").distinct().count() * len(RULES))
    a = alpha / len(RULES)
    log_odds = F.log(F.lit(a / (1 - a)))
    tail = F.aggregate(
        F.sequence(F.lit(0).cast("long"), F.col("k")),
        F.struct((F.col("n") * F.log(F.lit(1 - a))).alias("t"), F.lit(0.0).alias("s")),
        lambda acc, j: F.struct((acc["t"] + F.log((F.col("n") - j).cast("double")) - F.log((j + 1).cast("double")) + log_odds).alias("t"), (acc["s"] + F.exp(acc["t"])).alias("s")),
        lambda acc: acc["s"],
    )
    sure = F.when((F.col("n") == 0) | (F.col("k") >= a * F.col("n")), F.lit(False)).otherwise(tail <= delta / families)
    order = Window.partitionBy("stratum", "rule").orderBy("step")
    gain = F.col("bad") - good_weight * F.col("k")
    best = g.withColumn("ok", F.min(sure).over(order)).filter(F.col("ok") & (gain > 0)).groupBy("stratum", "rule").agg(F.max_by("cut", F.struct(gain, -F.col("step"))).alias("cut"))
    return best.groupBy("stratum").agg(*[F.max(F.when(F.col("rule") == r, F.col("cut"))).alias(f"cut_{r}") for r, _, _ in RULES])


def judge(measured: DataFrame, cuts: DataFrame) -> DataFrame:
    """The measures with `rejected_by` (array of rule names) and `kept`. Strata without labels have no cutoffs."""
    j = measured.join(cuts.withColumnRenamed("stratum", "_stratum"), F.col("stratum") == F.col("_stratum"), "left").drop("_stratum")
    by = F.filter(F.array(*[F.when(F.expr(score) > F.col(f"cut_{r}"), F.lit(r)) for r, score, _ in RULES]), lambda r: r.isNotNull())
    j = j.withColumn("rejected_by", F.when(F.col("base_failed"), F.array(F.lit("base"))).otherwise(by))
    return j.withColumn("kept", F.size("rejected_by") == 0).drop(*[f"cut_{r}" for r, _, _ in RULES])


def assess(docs: DataFrame, labels: DataFrame, alpha: float = 0.02, delta: float = 0.05, id_col: str = "doc_id", text_col: str = "text", stratum_col: str | None = "lang", good_weight: int = GOOD_WEIGHT) -> DataFrame:
    """Measures and verdict of every row of docs: `_id, _sum` (xxhash64 of the text), `stratum`, measures, `kept`.

    Null or empty text: no words, so base_failed. Null stratum: a stratum of its own. Null id: judged like any
    other row, never labelled. Repeated rows are judged alike. Empty docs: empty result; empty labels: base rules
    only. The measures (numbers only, no text) are written once and read for the holdout and for the verdicts.
    """
    measured = stash(measures(docs, id_col, text_col, stratum_col), "measures")
    return judge(measured, thresholds(measured, labels, alpha, delta, good_weight=good_weight))


def keep_good(docs: DataFrame, labels: DataFrame, **params) -> DataFrame:
    """The rows of docs that are kept, all columns as they were."""
    id_col, text_col = params.get("id_col", "doc_id"), params.get("text_col", "text")
    stratum_col = params.get("stratum_col", "lang")
    bad = assess(docs, labels, **params).filter("not kept").select("_id", "_sum", "stratum").distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(f"`{id_col}`").alias("_rid"), F.xxhash64(text_of(text_col)).alias("_rsum"), (F.coalesce(F.col(f"`{stratum_col}`").cast("string"), F.lit("")) if stratum_col else F.lit("")).alias("_rstr"))
    return rows.join(bad, F.col("_rid").eqNullSafe(F.col("_id")) & (F.col("_rsum") == F.col("_sum")) & (F.col("_rstr") == F.col("stratum")), "left_anti").select("_row.*")


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    out = assess(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return out.select(F.col("_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _oracle(alpha: float = 0.02, delta: float = 0.05, good_weight: int = GOOD_WEIGHT) -> str:
    a, r = alpha / len(RULES), len(RULES)
    ln0, ln1 = f"ln({a!r}::DOUBLE)", f"ln((1 - {a!r})::DOUBLE)"
    grid = " UNION ALL ".join(f"SELECT stratum, good, '{n}' AS rule, {i} AS step, {c!r}::DOUBLE AS cut, ({s.replace('/', '::DOUBLE /')} > {c!r}) AS hit FROM held" for n, s, cuts in RULES for i, c in enumerate(cuts))
    over = " OR ".join(f"coalesce({s.replace('/', '::DOUBLE /')} > (SELECT cut FROM best b WHERE b.stratum = m.stratum AND b.rule = '{n}'), false)" for n, s, _ in RULES)
    return rf"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, list_filter(string_split_regex(t, '[{WS_CLASS}]+'), lambda x: x <> '') AS w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^{WS_CLASS}]')) AS l,
             stratum, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols FROM d),
g AS (SELECT doc_id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
p AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM g) WHERE n > 1),
q AS (SELECT doc_id, count(DISTINCT x) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS x FROM p) GROUP BY doc_id),
m0 AS (SELECT w.doc_id, stratum, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, n_symbols,
              len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(q.n, 0) AS n_repeat_words
       FROM w LEFT JOIN q USING (doc_id)),
m AS (SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed FROM m0),
held AS (SELECT m.*, y.good FROM m JOIN (SELECT doc_id, max(quality) > 0 AS good FROM labels WHERE quality IS NOT NULL GROUP BY doc_id) y
         USING (doc_id) WHERE NOT base_failed),
cells AS (SELECT stratum, rule, step, cut, count(*) FILTER (WHERE good) AS n, count(*) FILTER (WHERE good AND hit) AS k,
                 count(*) FILTER (WHERE NOT good AND hit) AS bad FROM ({grid}) GROUP BY ALL),
sure AS (SELECT *, CASE WHEN n = 0 OR k >= {a!r} * n THEN false ELSE
           list_sum(list_transform(range(0, k + 1), lambda j: exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * {ln0} + (n - j) * {ln1})))
           <= {delta!r} / ((SELECT count(DISTINCT stratum) FROM cells) * {r}) END AS ok FROM cells),
seq AS (SELECT *, bool_and(ok) OVER (PARTITION BY stratum, rule ORDER BY step) AS fine, bad - {good_weight} * k AS gain FROM sure),
best AS (SELECT stratum, rule, arg_max(cut, gain * 1000 - step) AS cut FROM seq WHERE fine AND gain > 0 GROUP BY ALL)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT (base_failed OR {over}) AS kept FROM m
"""


ORACLE = _oracle()
