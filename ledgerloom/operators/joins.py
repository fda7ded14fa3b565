"""Joins with contracts: validated lookups, as-of and range joins, set overlap, cardinality classes, comparisons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .state import written


def same(left: Sequence[str], right: Sequence[str]) -> Column:
    """Null-safe equality of two lists of columns."""
    cond = F.lit(True)
    for a, b in zip(left, right, strict=True):
        cond = cond & F.col(a).eqNullSafe(F.col(b))
    return cond


def checked_dimension(dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The dimension, failing at run time if a key repeats."""
    n = F.count("*").over(Window.partitionBy(*keys))
    ok = F.when(n > 1, F.raise_error(F.concat(F.lit("repeated key: "), F.to_json(F.struct(*keys))))).otherwise(F.lit(True).cast("boolean"))
    return dim.withColumn("_ok", ok.cast("boolean")).filter("_ok").drop("_ok")


def lookup(df: DataFrame, dim: DataFrame, on: Sequence[str], required: bool = False, unique: bool = False) -> DataFrame:
    """Many-to-one left join; required: a row without a match is an error. Spark broadcasts dims it knows to be small."""
    dim = checked_dimension(dim, on) if unique else dim
    out = df.join(dim.withColumn("_found", F.lit(True)), list(on), "left")
    if required:
        missing = F.when(F.col("_found").isNull(), F.raise_error(F.concat(F.lit("no match: "), F.to_json(F.struct(*on))))).otherwise(F.lit(True).cast("boolean"))
        out = out.withColumn("_sure", missing.cast("boolean")).filter("_sure").drop("_sure")
    return out.drop("_found")


def indicator_join(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Full outer join with `_merge` of both, left_only or right_only."""
    j = left.withColumn("_l", F.lit(1)).join(right.withColumn("_r", F.lit(1)), list(on), "full")
    return j.withColumn("_merge", F.when(F.col("_l").isNull(), "right_only").when(F.col("_r").isNull(), "left_only").otherwise("both")).drop("_l", "_r")


def asof_join(left: DataFrame, right: DataFrame, by: Sequence[str], left_on: str, right_on: str, take: Sequence[str], tie: str, strict: bool = False) -> DataFrame:
    """Each left row with the columns `take` of the latest right row of its group at or before it (strict: before it).

    One union, one shuffle by the group and one running `last`, so cost is that of a sort. Right rows at one position
    are ordered by `tie`; the greatest counts. A null position on the left gets nothing.
    """
    r = right.filter(F.col(right_on).isNotNull()).select(*by, F.col(right_on).alias("_at"), F.struct(*take).alias("_take"), F.col(tie).alias("_tie"), F.lit(1 if strict else 0).alias("_side"), F.lit(None).cast(left.select(F.struct("*")).schema[0].dataType).alias("_row"))
    l_ = left.select(*by, F.col(left_on).alias("_at"), F.lit(None).cast(r.schema["_take"].dataType).alias("_take"), F.lit(None).cast(r.schema["_tie"].dataType).alias("_tie"), F.lit(0 if strict else 1).alias("_side"), F.struct(*left.columns).alias("_row"))
    w = Window.partitionBy(*by).orderBy("_at", "_side", "_tie").rowsBetween(Window.unboundedPreceding, 0)
    found = F.last("_take", ignorenulls=True).over(w)
    out = r.unionByName(l_).withColumn("_got", F.when(F.col("_at").isNotNull(), found)).filter("_row is not null")
    return out.select("_row.*", *[F.col(f"_got.{c}").alias(c) for c in take])


#: Cells of a grid over the ends of bands; only tables of one row a cell are ordered in one task.
CELLS = 1024
#: Up to so many bands are a CASE expression in the scan of the rows, without any join.
FEW = 64


def band_join(df: DataFrame, bands: DataFrame, value: str, low: str, high: str, order: str, take: Sequence[str]) -> DataFrame:
    """Each row with the columns `take` of the last band (by `order`, not null; then by `take`) whose [low, high) holds the value.

    A few bands (FEW) are tried in turn within the scan. More of them become disjoint pieces, numbered over a grid of cells. A band covers at most two nodes of each level of the
    binary tree over the pieces, and a piece looks up its ancestors, so pieces meet bands by equality in m log m rows
    however many bands overlap. Distinct values find their piece as of its start within a cell; rows join by equality.
    Ends are numbers, dates or timestamps. No bands, a null value, or a band with a null or empty range: nulls.
    """
    bands = bands.filter(F.col(order).isNotNull() & (F.col(low) < F.col(high)))
    few = bands.select(low, high, order, *[c for c in take if c not in (low, high, order)]).limit(FEW + 1).collect()
    if len(few) <= FEW:
        typed = lambda row, c: F.lit(row[c]).cast(bands.schema[c].dataType)
        found = F.lit(None).cast(bands.select(F.struct(*take)).schema[0].dataType)
        for row in sorted(few, key=lambda r: (r[order], *[(r[c] is not None, r[c]) for c in take])):
            within = (F.col(value) >= typed(row, low)) & (F.col(value) < typed(row, high))
            found = F.when(within, F.struct(*[typed(row, c).alias(c) for c in take])).otherwise(found)
        return df.withColumn("_t", found).select(*df.columns, *[F.col(f"_t.{c}").alias(c) for c in take])
    kind = bands.schema[low].dataType.typeName()
    number = (lambda c: F.unix_date(c).cast("double")) if kind == "date" else (lambda c: F.col(c).cast("double"))
    span = bands.agg(F.min(number(low)).alias("a"), F.max(number(high)).alias("b")).head()
    width = (span["b"] - span["a"]) / CELLS or 1.0
    cell = lambda c: F.floor(F.greatest(F.least((number(c) - span["a"]) / width, F.lit(CELLS - 1.0)), F.lit(0.0))).cast("int")
    cut = _pieces(bands, low, high, order, take, cell)
    cut = cut.select(F.explode(F.sequence(cell("_p"), cell("_q"))).alias("_c"), F.col("_p").alias("_at"), "_q", "_t")
    values = df.select(F.col(value).alias("_v")).filter("_v is not null").distinct().withColumn("_c", cell("_v"))
    placed = asof_join(values, cut, ["_c"], "_v", "_at", ["_q", "_t"], "_q").select("_v", F.when(F.col("_v") < F.col("_q"), F.col("_t")).alias("_t"))
    out = df.join(placed, F.col(value) == F.col("_v"), "left")
    return out.select(*df.columns, *[F.col(f"_t.{c}").alias(c) for c in take])


def _pieces(bands: DataFrame, low: str, high: str, order: str, take: Sequence[str], cell) -> DataFrame:
    """`_p, _q, _t`: disjoint pieces [_p, _q) that a band covers, each with `take` of its last band."""
    ends = bands.select(F.col(low).alias("_p")).union(bands.select(F.col(high).alias("_p"))).distinct().withColumn("_c", cell("_p"))
    within, cells = Window.partitionBy("_c").orderBy("_p"), Window.orderBy("_c")
    ends = ends.withColumn("_i", F.row_number().over(within) - 1).withColumn("_q", F.lead("_p").over(within))
    per_cell = ends.groupBy("_c").agg(F.count("*").alias("_n"), F.min("_p").alias("_first"))
    per_cell = per_cell.select("_c", (F.sum("_n").over(cells) - F.col("_n")).alias("_before"), F.lead("_first").over(cells).alias("_next"), F.sum("_n").over(Window.partitionBy()).alias("_total"))
    ends = ends.join(per_cell, "_c").select("_p", F.coalesce("_q", "_next").alias("_q"), (F.col("_before") + F.col("_i")).alias("_i"), "_total")
    at = lambda c, i: ends.select(F.col("_p").alias(c), F.col("_i").alias(i))
    placed = bands.select(F.col(low).alias("_a"), F.col(high).alias("_b"), F.col(order).alias("_o"), F.struct(*take).alias("_t")).join(at("_a", "_l"), "_a").join(at("_b", "_r"), "_b")
    levels = lambda top: F.explode(F.sequence(F.lit(0), F.length(F.bin(top)) - 1))
    spread = placed.withColumn("_k", levels(F.col("_r"))).withColumn("_l", F.expr("shiftright(_l + shiftleft(1L, _k) - 1, _k)")).withColumn("_r", F.expr("shiftright(_r, _k)")).filter("_l < _r")
    nodes = spread.withColumn("_i", F.explode(F.array_compact(F.array(F.when(F.col("_l") % 2 == 1, F.col("_l")), F.when(F.col("_r") % 2 == 1, F.col("_r") - 1)))))
    nodes = nodes.groupBy("_k", "_i").agg(F.max_by("_t", F.struct("_o", "_t")).alias("_t"), F.max("_o").alias("_o"))
    up = ends.filter("_q is not null").withColumn("_k", levels(F.col("_total"))).withColumn("_i", F.expr("shiftright(_i, _k)"))
    return up.join(nodes, ["_k", "_i"]).groupBy("_p", "_q").agg(F.max_by("_t", F.struct("_o", "_t")).alias("_t"))


def set_overlap(sets: DataFrame, group: Sequence[str], owner: str, element: str) -> DataFrame:
    """Pairs of owners (`a` < `b`) of one group with the elements both have: `group..., a, b, shared, size_a, size_b`.

    An equi-join on (group, element) of distinct rows and a count; no pair is made that shares nothing.
    """
    s = sets.select(*group, F.col(owner).alias("_o"), F.col(element).alias("_e")).filter("_e is not null").distinct()
    size = s.groupBy(*group, "_o").agg(F.count("*").alias("_n"))
    a = s.select(*group, "_e", F.col("_o").alias("a"))
    b = s.select(*group, "_e", F.col("_o").alias("b"))
    pairs = a.join(b, [*group, "_e"]).filter("a < b").groupBy(*group, "a", "b").agg(F.count("*").alias("shared"))
    out = pairs.join(size.withColumnsRenamed({"_o": "a", "_n": "size_a"}), [*group, "a"]).join(size.withColumnsRenamed({"_o": "b", "_n": "size_b"}), [*group, "b"])
    return out.select(*group, "a", "b", "shared", "size_a", "size_b")


def contained_earlier(sets: DataFrame, group: Sequence[str], owner: str, element: str, share: float = 0.8, least: int = 1) -> DataFrame:
    """Owners of which an earlier owner of the group holds at least `share` of the elements: the first such, and how many."""
    s = sets.select(*group, F.col(owner).alias("_o"), F.col(element).alias("_e")).distinct()
    size = s.groupBy(*group, "_o").agg(F.count("*").alias("size")).filter(F.col("size") >= least)
    pairs = s.select(*group, "_e", F.col("_o").alias("_x")).join(s.select(*group, "_e", F.col("_o").alias("_y")), [*group, "_e"]).filter("_y < _x")
    counts = pairs.groupBy(*group, "_x", "_y").agg(F.count("*").alias("shared"))
    hits = counts.join(size.withColumnRenamed("_o", "_x"), [*group, "_x"]).filter(F.col("shared") >= share * F.col("size"))
    return hits.groupBy(*group, F.col("_x").alias(owner), "size").agg(F.min(F.struct(F.col("_y").alias("repeats"), "shared")).alias("_m")).select(*group, owner, "size", "_m.repeats", "_m.shared")


def unique_anchor_join(left: DataFrame, right: DataFrame, anchor: str) -> DataFrame:
    """Inner join on anchors that occur once on either side."""
    row = lambda d: F.first(F.struct(*[c for c in d.columns if c != anchor]))
    once = lambda d: d.filter(F.col(anchor).isNotNull()).groupBy(anchor).agg(F.count("*").alias("_c"), row(d).alias("_r")).filter("_c = 1").select(anchor, "_r.*")
    return once(left).join(once(right), anchor)


#: Up to so many nodes with an element, it isn't worth while to look for rarer ones.
FREQUENT = 100


def first_containing(sets: DataFrame, group: Sequence[str], owner: str, element: str, share: float = 0.8, least: int = 1, across: bool = False) -> DataFrame:
    """As contained_earlier, with all of J11 if `across`: the first owner of a group is also compared with all owners of
    other groups. `group..., owner, size, repeats, shared`, and `repeats_<group>...` before `repeats` if `across`.

    The first hit is the least by (group, owner). Equal sets of a group are one node, under its first owner; nodes are
    written once and go by numbers. A node holding `share` of a set has one of its rarest elements, so only those are
    joined; a first try of each element's first node bounds what is left to compare, and 64 marks of either set drop
    most pairs that can't hold before they are shuffled. Hits are counted on whole sets. Null elements don't count.
    """
    s = sets.select(F.struct(F.lit(0).alias("_"), *group).alias("_g"), F.col(owner).alias("_o"), F.col(element).alias("_e")).filter("_e is not null").distinct()
    owners = s.groupBy("_g", "_o").agg(F.sort_array(F.collect_list("_e")).alias("_a"))
    nodes = owners.groupBy("_g", "_a").agg(F.min("_o").alias("_y"), F.collect_list("_o").alias("_os")).withColumn("_n", F.size("_a").cast("long"))
    marks = F.expr("aggregate(_a, 0L, (m, e) -> m | shiftleft(1L, cast(pmod(xxhash64(e), 64L) as int)))")
    nodes = written(nodes.withColumns({"_s": marks, "_gh": F.hash("_g"), "_id": F.monotonically_increasing_id()}))
    lost = F.col("_n") - F.ceil(share * F.col("_n"))  # elements that a node holding the set may lack
    counts = nodes.select(F.explode("_a").alias("_e")).groupBy("_e").agg(F.count("*").alias("_f"))
    if counts.filter(F.col("_f") > FREQUENT).isEmpty():  # any elements will do
        rare = nodes.withColumn("_r", F.slice("_a", 1, (lost + 1).cast("int")))
    else:
        spread = nodes.select("_id", "_n", F.explode("_a").alias("_e"))
        ranked = spread.join(counts, "_e").groupBy("_id", "_n").agg(F.sort_array(F.collect_list(F.struct("_f", "_e"))).alias("_r"))
        ranked = ranked.select("_id", F.transform(F.slice("_r", 1, (lost + 1).cast("int")), lambda x: x["_e"]).alias("_r"))
        rare = nodes.join(ranked, "_id")
    rare = rare.filter(F.col("_n") >= least).select("_id", "_gh", "_y", lost.alias("_lost"), "_s", F.explode("_r").alias("_e"))
    to = nodes.select(F.col("_id").alias("_tid"), F.col("_gh"), F.col("_y").alias("_ty"), F.col("_s").alias("_ts"), F.explode("_a").alias("_e"))
    likely = F.bit_count(F.col("_s").bitwiseAND(F.bitwise_not("_ts"))) <= F.col("_lost")

    def verified(pairs: DataFrame) -> DataFrame:
        """Pairs of nodes that hold: `_id, _hit` of the least."""
        node = lambda a: nodes.select(*[F.col(c).alias(f"{a}{c}") for c in ("_id", "_g", "_y", "_a")])  # noqa: E731  alike, so that one shuffle serves both
        both = pairs.select("_id", "_tid").distinct().join(node("_x"), F.col("_id") == F.col("_x_id")).join(node("_t"), F.col("_tid") == F.col("_t_id"))
        earlier = (F.col("_x_g") == F.col("_t_g")) & (F.col("_t_y") < F.col("_x_y"))
        both = both.filter(earlier | (F.col("_x_g") != F.col("_t_g")) if across else earlier)
        both = both.withColumn("_k", F.size(F.array_intersect("_x_a", "_t_a")).cast("long")).filter(F.col("_k") >= share * F.size("_x_a"))
        return both.groupBy("_id").agg(F.min(F.struct(F.col("_t_g").alias("_tg"), F.col("_t_y").alias("_ty"), "_k")).alias("_hit"))

    near = to
    if group:  # what a group has once makes no pair in it
        near = written(to.drop("_ts").withColumn("_c", F.count("*").over(Window.partitionBy("_gh", "_e"))).filter("_c > 1").drop("_c"))
    leads = near.groupBy("_gh", "_e").agg(F.min(F.struct("_ty", "_tid")).alias("_t")).select("_gh", "_e", "_t._ty", "_t._tid")
    tried = written(verified(rare.join(leads, ["_gh", "_e"]).filter("_ty < _y")).select("_id", F.col("_hit._ty").alias("_bound"), F.col("_hit")))
    left = rare.join(tried.drop("_hit"), "_id", "left").withColumn("_bound", F.coalesce("_bound", "_y"))
    inner = left.join(near, ["_gh", "_e"]).filter("_ty < _bound").filter(likely if "_ts" in near.columns else F.lit(True))
    pairs = inner.select("_id", "_tid")
    if across:
        heads = rare.join(nodes.groupBy("_g").agg(F.min(F.struct("_y", "_id")).alias("_m")).select("_m._id"), "_id", "left_semi").select("_id", "_lost", "_s", "_e")
        pairs = pairs.unionByName(heads.join(to.select("_tid", "_ts", "_e"), "_e").filter(F.col("_id") != F.col("_tid")).filter(likely).select("_id", "_tid"))
    hit = written(verified(pairs).unionByName(tried.select("_id", "_hit")).groupBy("_id").agg(F.min("_hit").alias("_hit")))
    best = nodes.join(hit, "_id", "left").filter(F.col("_n") >= least).withColumn("_o", F.explode("_os"))
    own = F.when(F.col("_o") > F.col("_y"), F.struct(F.col("_g").alias("_tg"), F.col("_y").alias("_ty"), F.col("_n").alias("_k")))
    hits = best.withColumn("_hit", F.least("_hit", own)).filter("_hit is not null")
    extra = [F.col(f"_hit._tg.{c}").alias(f"repeats_{c}") for c in group] if across else []
    return hits.select(*[F.col(f"_g.{c}").alias(c) for c in group], F.col("_o").alias(owner), F.col("_n").alias("size"), *extra, F.col("_hit._ty").alias("repeats"), F.col("_hit._k").alias("shared"))


def word_windows(df: DataFrame, id_: str, text: str, words: int) -> DataFrame:
    """`id, place, _h` of every run of `words` words of the whole text, by 128 bits; a text with fewer words is one run."""
    w = F.filter(F.split(F.col(text), "[ \t\n\r]+"), lambda x: x != "")
    d = df.select(id_, w.alias("_w")).filter(F.size("_w") > 0)
    run = lambda i: F.slice("_w", i, words)
    runs = F.transform(F.sequence(F.lit(1), F.greatest(F.size("_w") - words + 1, F.lit(1))), lambda i: F.struct(i.alias("place"), F.xxhash64(run(i)).alias("a"), F.xxhash64(F.lit(words), run(i)).alias("b"), (F.size("_w") < words).alias("short")))
    return d.select(id_, F.explode(runs).alias("_r")).select(id_, "_r.place", F.struct("_r.a", "_r.b", "_r.short").alias("_h"))


def unique_window_join(left: DataFrame, right: DataFrame, left_id: str, right_id: str, text: str, words: int) -> DataFrame:
    """`left_id, right_id, left_place, right_place` of word windows that occur once in all texts of either side.

    Places (of the first word, from 1) must rise together within a pair of texts, or all matches of the pair go. Left
    windows meet the right side's unique ones before they are counted, so only what can match is shuffled.
    """
    once = lambda d, id_, place: d.groupBy("_h").agg(F.count("*").alias("_n"), F.min(id_).alias(id_), F.min("place").alias(place)).filter("_n = 1").drop("_n")
    r = once(word_windows(right, right_id, text, words), right_id, "right_place")
    found = once(word_windows(left, left_id, text, words).join(r.select("_h"), "_h", "left_semi"), left_id, "left_place").join(r, "_h")
    pair = Window.partitionBy(left_id, right_id)
    back = found.withColumn("_back", F.col("right_place") < F.lag("right_place").over(pair.orderBy("left_place")))
    kept = back.withColumn("_any", F.max(F.coalesce("_back", F.lit(False))).over(pair)).filter("not _any")
    return kept.select(left_id, right_id, "left_place", "right_place")


def classified_join(left: DataFrame, right: DataFrame, key: str, right_id: str) -> DataFrame:
    """Left rows with `matches`, `status` (unmatched, unique, ambiguous) and the right id where it is unique."""
    r = right.groupBy(key).agg(F.count("*").alias("_m"), F.min(right_id).alias("_id"))
    j = left.join(r, key, "left").withColumn("matches", F.coalesce("_m", F.lit(0)))
    return j.withColumn("status", F.when(F.col("matches") == 0, "unmatched").when(F.col("matches") == 1, "unique").otherwise("ambiguous")).withColumn(f"match_{right_id}", F.when(F.col("matches") == 1, F.col("_id"))).drop("_m", "_id")


def or_key_join(left: DataFrame, right: DataFrame, left_keys: Sequence[str], right_key: str) -> DataFrame:
    """Matches on any of several left keys, each pair once: candidates are exploded, so it stays an equi-join."""
    cand = left.withColumn("_k", F.explode(F.array_distinct(F.array(*left_keys)))).filter("_k is not null")
    return cand.join(right, F.col("_k") == F.col(right_key)).drop("_k").distinct()


def fallback_join(left: DataFrame, right: DataFrame, key: str, finer: str, right_id: str) -> DataFrame:
    """A match by key; where several, by key and finer. `match` is null unless exactly one is left."""
    one = right.groupBy(key).agg(F.count("*").alias("_n"), F.min(right_id).alias("_a"))
    two = right.groupBy(key, finer).agg(F.count("*").alias("_m"), F.min(right_id).alias("_b"))
    j = left.join(one, key, "left").join(two, [key, finer], "left")
    return j.withColumn("match", F.when(F.col("_n") == 1, F.col("_a")).when(F.col("_m") == 1, F.col("_b"))).drop("_n", "_a", "_m", "_b")


def positional_join(left: DataFrame, right: DataFrame, by: Sequence[str], left_order: Sequence[str], right_order: Sequence[str]) -> DataFrame:
    """Rows of both sides zipped by their place within a group, only for groups with as many on either side."""
    def numbered(d, order):
        return d.withColumn("_i", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).withColumn("_n", F.count("*").over(Window.partitionBy(*by)))

    return numbered(left, left_order).join(numbered(right, right_order), [*by, "_i", "_n"]).drop("_n").withColumnRenamed("_i", "place")


def compare_predictions(truth: DataFrame, predicted: DataFrame, key: Sequence[str], true_col: str, pred_col: str) -> DataFrame:
    """One row a key: status missing, duplicate, abstained, correct, wrong, or extra for keys without a truth."""
    p = predicted.groupBy(*key).agg(F.count("*").alias("_n"), F.first(pred_col, ignorenulls=True).alias("_p"))
    j = truth.select(*key, F.col(true_col).alias("_t"), F.lit(True).alias("_in")).join(p, list(key), "full")
    status = F.when(F.col("_in").isNull(), "extra").when(F.col("_n").isNull(), "missing").when(F.col("_n") > 1, "duplicate").when(F.col("_p").isNull(), "abstained").when(F.col("_p").eqNullSafe(F.col("_t")), "correct").otherwise("wrong")
    return j.select(*key, status.alias("status"))


def inventory(expected: DataFrame, found: DataFrame, key: str, value: str) -> DataFrame:
    """Two-way comparison of inventories: same, differs, missing (expected only), unexpected (found only)."""
    j = expected.select(key, F.col(value).alias("_e"), F.lit(True).alias("_x")).join(found.select(key, F.col(value).alias("_f"), F.lit(True).alias("_y")), key, "full")
    return j.select(key, F.when(F.col("_y").isNull(), "missing").when(F.col("_x").isNull(), "unexpected").when(F.col("_e").eqNullSafe(F.col("_f")), "same").otherwise("differs").alias("status"))


def identical_groups(df: DataFrame, content: Column, key: str) -> DataFrame:
    """Rows of equal content: `digest, first, aliases (sorted array of the others), members`."""
    g = df.select(F.sha2(content, 256).alias("digest"), key).groupBy("digest").agg(F.sort_array(F.collect_list(key)).alias("_k"))
    return g.select("digest", F.get("_k", 0).alias("first"), F.slice("_k", 2, F.greatest(F.size("_k") - 1, F.lit(0))).alias("aliases"), F.size("_k").cast("long").alias("members"))


def pair_group(a: Column, b: Column) -> Column:
    """One id for an unordered pair of keys."""
    return F.sha2(F.to_json(F.array_sort(F.array(a, b))), 256)


def one_to_one(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join of two sides on which no key repeats (an error at run time), with `_merge` of both or left_only."""
    j = checked_dimension(left, on).join(checked_dimension(right, on).withColumn("_r", F.lit(True)), list(on), "left")
    return j.withColumn("_merge", F.when(F.col("_r").isNull(), "left_only").otherwise("both")).drop("_r")


def last_lookup(df: DataFrame, decisions: DataFrame, on: Sequence[str], order: str) -> DataFrame:
    """Left join with the last decision (by `order`) for each key; rows of df don't fan out."""
    rest = [c for c in decisions.columns if c not in on and c != order]
    last = decisions.groupBy(*on).agg(F.max_by(F.struct(*rest), order).alias("_d"))
    return df.join(last, list(on), "left").select(*df.columns, *[F.col(f"_d.{c}").alias(c) for c in rest])


def both_sides(pairs: DataFrame, left: DataFrame, right: DataFrame, left_key: str, right_key: str, key: str, suffixes: tuple[str, str]) -> DataFrame:
    """Pairs of keys with the columns of either row, suffixed by its side; a key must occur once a side."""
    out = pairs
    for rows, k, suffix in ((left, left_key, suffixes[0]), (right, right_key, suffixes[1])):
        named = checked_dimension(rows, [key]).select(F.col(key).alias(k), *[F.col(c).alias(c + suffix) for c in rows.columns if c != key])
        out = out.join(named, k, "left")
    return out


def mapped_family(df: DataFrame, mapping: DataFrame, families: DataFrame, key: str, mapped: str, family: str, name: str) -> DataFrame:
    """`name` is the family of the key's mapped value where it has one, else the mapped value (null: unmapped)."""
    d = lookup(lookup(df, mapping.select(key, mapped), [key], unique=True), families.select(mapped, family), [mapped], unique=True)
    return d.select(*df.columns, F.coalesce(family, mapped).alias(name))


def reviewed_join(left: DataFrame, right: DataFrame, aliases: DataFrame, key: str, right_id: str) -> DataFrame:
    """Left rows with `match_<right_id>` and `status`: normalized_name, ambiguous_name, reviewed_spelling_variant, unmatched.

    A key without a match is tried under its reviewed spelling (aliases: `key, spelling`, one a key).
    """
    m = right.groupBy(F.col(key).alias("_k")).agg(F.count("*").alias("_n"), F.min(right_id).alias("_id"))
    d = lookup(left, aliases.select(key, F.col("spelling").alias("_alias")), [key], unique=True)
    d = d.join(m, F.col(key) == F.col("_k"), "left").join(m.select(F.col("_k").alias("_ak"), F.col("_n").alias("_an"), F.col("_id").alias("_aid")), F.col("_n").isNull() & (F.col("_alias") == F.col("_ak")), "left")
    n = F.coalesce("_n", "_an")
    status = F.when(n.isNull(), "unmatched").when(n > 1, "ambiguous_name").when(F.col("_n").isNotNull(), "normalized_name").otherwise("reviewed_spelling_variant")
    return d.select(*left.columns, F.when(n == 1, F.coalesce("_id", "_aid")).alias(f"match_{right_id}"), status.alias("status"))


def used_once(df: DataFrame, match: str) -> DataFrame:
    """`reused`: whether the match of a row is that of another row as well (null: no)."""
    uses = df.filter(F.col(match).isNotNull()).groupBy(match).agg((F.count("*") > 1).alias("reused"))
    return df.join(uses, match, "left").withColumn("reused", F.coalesce("reused", F.lit(False)))


def aligned_join(left: DataFrame, right: DataFrame, by: Sequence[str], left_order: Sequence[str], right_order: Sequence[str], left_office: str, right_office: str) -> DataFrame:
    """positional_join for groups whose sequences of offices are the same on both sides."""
    agree = F.min(F.col(left_office).eqNullSafe(F.col(right_office)).cast("int")).over(Window.partitionBy(*by))
    return positional_join(left, right, by, left_order, right_order).withColumn("_same", agree).filter("_same = 1").drop("_same")
