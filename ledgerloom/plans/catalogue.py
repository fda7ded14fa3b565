"""The queries of the core library over the driver's tables, each with SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.functions import text as X
from ledgerloom.operators import aggregates as A
from ledgerloom.operators import joins as J
from ledgerloom.operators import overlay as O
from ledgerloom.operators import predicates as P
from ledgerloom.operators import sets as U
from ledgerloom.operators import windows as W
from ledgerloom.sources import html as H
from ledgerloom.sources.tables import table, workers_find_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        workers_find_package(spark)

    def __getattr__(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql:
            ORACLES[name] = sql
        return f

    return register


# --- projections, predicates, dispositions -------------------------------------------------------------------


@query(
    "q_share_by_group_gate",
    """WITH d AS (SELECT c_mktsegment, n_name, (l_returnflag = 'R')::DOUBLE AS c FROM lineitem JOIN orders ON l_orderkey = o_orderkey
         JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE l_returnflag IS NOT NULL),
    g AS (SELECT c_mktsegment, n_name, count(*) AS n, avg(c) AS share, grouping(c_mktsegment, n_name) AS g FROM d
          GROUP BY GROUPING SETS ((c_mktsegment, n_name), ())),
    b AS (SELECT share AS base FROM g WHERE g > 0)
    SELECT c_mktsegment, n_name, CASE WHEN g > 0 THEN 'all' ELSE 'group' END AS level, n, round(100 * share, 4) AS share,
           round(100 * (share - base), 4) AS deviation, abs(100 * (share - base)) > 3 AS outside FROM g, b""",
)
def share_by_group_gate(t):
    d = t.lineitem.select("l_orderkey", "l_returnflag").join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    d = d.join(t.customer.select("c_custkey", "c_nationkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey")).join(t.nation.select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey"))
    return A.share_gate(d, ["c_mktsegment", "n_name"], F.col("l_returnflag") == "R", 3.0)


@query("q_strict_flags", "SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'R' THEN true WHEN 'N' THEN false END AS returned, CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS closed FROM lineitem")
def strict_flags(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", F.when(F.col("l_returnflag") == "R", True).when(F.col("l_returnflag") == "N", False).alias("returned"), (F.col("l_linestatus") == "F").cast("tinyint").cast("int").alias("closed"))


@query("q_prefix_rename", "SELECT o_orderkey AS order_orderkey, o_custkey AS order_custkey, o_orderstatus AS order_orderstatus, o_orderpriority AS order_orderpriority FROM orders")
def prefix_rename(t):
    d = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    return d.toDF(*[f"order_{c.removeprefix('o_')}" for c in d.columns])


_STATE = """SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN 'provisional' WHEN l.toxic = 1 THEN 'nonseat'
    WHEN l.quality = 0 OR n_chars < 300 OR lang = 'es' THEN 'quarantine' ELSE 'release' END AS disposition,
    concat_ws(';', CASE WHEN l.quality = 0 THEN 'low_quality' END, CASE WHEN n_chars < 300 THEN 'short' END, CASE WHEN lang = 'es' THEN 'language' END) AS reasons
    FROM documents d LEFT JOIN labels l USING (doc_id)"""


def _states(t):
    d = t.documents.select("doc_id", "n_chars", "lang").join(t.labels, "doc_id", "left")
    reviewed = F.col("quality").isNotNull()
    why = O.reasons((F.col("quality") == 0, "low_quality"), (F.col("n_chars") < 300, "short"), (F.col("lang") == "es", "language"))
    d = d.withColumn("reasons", why)
    state = O.disposition((reviewed, "release"), (reviewed & (F.col("reasons") != ""), "quarantine"), (reviewed & (F.col("toxic") == 1), "nonseat"), default="provisional")
    return d.select("doc_id", state.alias("disposition"), "reasons")


@query("q_disposition_case", _STATE)
def disposition_case(t):
    return _states(t)


@query("q_partition_conservation", f"WITH s AS ({_STATE}) SELECT disposition, count(*) AS n FROM s GROUP BY ALL UNION ALL SELECT 'total', count(*) FROM s")
def partition_conservation(t):
    return U.conserved(_states(t), "disposition")


@query(
    "q_flag_reconciliation",
    f"""WITH s AS ({_STATE}), e AS (SELECT unnest(string_split(reasons, ';')) AS flag, disposition FROM s WHERE reasons <> '')
    SELECT flag, count(*) AS total, count(*) FILTER (WHERE disposition = 'quarantine') AS quarantine,
           count(*) FILTER (WHERE disposition = 'provisional') AS provisional, count(*) FILTER (WHERE disposition = 'nonseat') AS nonseat FROM e GROUP BY flag""",
)
def flag_reconciliation(t):
    return A.flag_reconciliation(_states(t), X.flags_of(F.col("reasons")), F.col("disposition"), ["quarantine", "provisional", "nonseat"])


@query("q_reason_overlap", f"WITH s AS ({_STATE}) SELECT reasons, count(*) AS n FROM s WHERE disposition = 'quarantine' GROUP BY ALL")
def reason_overlap(t):
    return A.count_by(_states(t).filter("disposition = 'quarantine'"), "reasons")


@query("q_control_characters", "SELECT doc_id, regexp_matches(text, '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x7f]') AS unreadable FROM documents")
def control_characters(t):
    return t.documents.select("doc_id", X.control_characters(F.col("text")).alias("unreadable"))


# --- joins ---------------------------------------------------------------------------------------------------


@query("q_lookup_override", "SELECT d.doc_id, coalesce(CASE l.quality WHEN 1 THEN 'good' WHEN 0 THEN 'bad' END, d.lang) AS mark FROM documents d LEFT JOIN labels l USING (doc_id)")
def lookup_override(t):
    named = t.labels.select("doc_id", F.when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "bad").alias("named"))
    return J.lookup(t.documents.select("doc_id", "lang"), named, ["doc_id"]).select("doc_id", F.coalesce("named", "lang").alias("mark"))


@query("q_validated_dim_join", "SELECT p_brand, n_name, count(*) AS lines FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL")
def validated_dim_join(t):
    d = J.lookup(t.lineitem.select(F.col("l_partkey").alias("p_partkey"), F.col("l_suppkey").alias("s_suppkey")), t.part.select("p_partkey", "p_brand"), ["p_partkey"], required=True, unique=True)
    d = J.lookup(d, t.supplier.select("s_suppkey", F.col("s_nationkey").alias("n_nationkey")), ["s_suppkey"], required=True, unique=True)
    return J.lookup(d, t.nation.select("n_nationkey", "n_name"), ["n_nationkey"], required=True, unique=True).groupBy("p_brand", "n_name").agg(F.count("*").alias("lines"))


@query(
    "q_one_to_one_indicator",
    """WITH a AS (SELECT sha256(text) AS h, count(*) AS n FROM documents GROUP BY 1), b AS (SELECT sha256(text) AS h, count(*) AS m FROM benchmark GROUP BY 1)
    SELECT CASE WHEN m IS NULL THEN 'left_only' WHEN n IS NULL THEN 'right_only' ELSE 'both' END AS _merge, count(*) AS keys FROM a FULL JOIN b USING (h) GROUP BY 1""",
)
def one_to_one_indicator(t):
    key = lambda d, n: d.groupBy(F.sha2("text", 256).alias("h")).agg(F.count("*").alias(n))
    return J.indicator_join(key(t.documents, "n"), key(t.benchmark, "m"), ["h"]).groupBy("_merge").agg(F.count("*").alias("keys"))


@query("q_semi_exception_keys", "SELECT o_orderkey, o_custkey FROM orders SEMI JOIN (SELECT l_orderkey FROM lineitem WHERE l_quantity >= 50) l ON o_orderkey = l_orderkey")
def semi_exception_keys(t):
    return t.orders.select("o_orderkey", "o_custkey").join(t.lineitem.filter("l_quantity >= 50").select("l_orderkey"), F.col("o_orderkey") == F.col("l_orderkey"), "left_semi")


@query("q_anti_remainder", "SELECT o_orderkey, o_custkey FROM orders ANTI JOIN (SELECT l_orderkey FROM lineitem WHERE l_quantity >= 40) l ON o_orderkey = l_orderkey")
def anti_remainder(t):
    return t.orders.select("o_orderkey", "o_custkey").join(t.lineitem.filter("l_quantity >= 40").select("l_orderkey"), F.col("o_orderkey") == F.col("l_orderkey"), "left_anti")


@query(
    "q_asof_last_label",
    """SELECT p.event_id, p.user_id, (SELECT arg_max(v.event_id, (v.ts, v.event_id)) FROM events v
       WHERE v.user_id = p.user_id AND v.event_type = 'view' AND v.ts <= p.ts) AS view_id FROM events p WHERE p.event_type = 'purchase'""",
)
def asof_last_label(t):
    views = t.events.filter("event_type = 'view'").select("user_id", F.col("ts").alias("view_ts"), F.col("event_id").alias("view_id"))
    return J.asof_join(t.events.filter("event_type = 'purchase'").select("event_id", "user_id", "ts"), views, ["user_id"], "ts", "view_ts", ["view_id"], "view_id").select("event_id", "user_id", "view_id")


BANDS = [(0, 0.0, 10.0, "small"), (1, 10.0, 30.0, "middle"), (2, 25.0, 45.0, "large"), (3, 40.0, 51.0, "bulk")]


@query(
    "q_range_band_join",
    f"""WITH b(ord, lo, hi, name) AS (VALUES {", ".join(f"({o}, {a}, {b}, '{n}')" for o, a, b, n in BANDS)})
    SELECT l_orderkey, l_linenumber, l_quantity, (SELECT arg_max(name, ord) FROM b WHERE l_quantity >= lo AND l_quantity < hi) AS band FROM lineitem""",
)
def range_band_join(t):
    bands = t.spark.createDataFrame(BANDS, "ord int, lo double, hi double, band string")
    return J.band_join(t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity"), bands, "l_quantity", "lo", "hi", "ord", ["band"])


@query(
    "q_block_overlap",
    """WITH s AS (SELECT DISTINCT s_nationkey, l_suppkey AS o, l_partkey AS e FROM lineitem JOIN supplier ON l_suppkey = s_suppkey),
    z AS (SELECT s_nationkey, o, count(*) AS n FROM s GROUP BY ALL),
    p AS (SELECT x.s_nationkey, x.o AS a, y.o AS b, count(*) AS shared FROM s x JOIN s y ON x.s_nationkey = y.s_nationkey AND x.e = y.e AND x.o < y.o GROUP BY ALL)
    SELECT p.s_nationkey, a, b, shared, i.n AS size_a, j.n AS size_b, CASE WHEN shared >= 5 OR shared / j.n >= 0.20 THEN 'link' ELSE 'exclude' END AS proposed
    FROM p JOIN z i ON i.s_nationkey = p.s_nationkey AND i.o = a JOIN z j ON j.s_nationkey = p.s_nationkey AND j.o = b WHERE shared >= 3""",
)
def block_overlap(t):
    from ledgerloom.operators.linkage import overlap_proposals

    sets = t.lineitem.select("l_suppkey", "l_partkey").join(t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
    return overlap_proposals(J.set_overlap(sets, ["s_nationkey"], "l_suppkey", "l_partkey")).drop("share_of_b")


@query(
    "q_repeated_sets",
    """WITH s AS (SELECT DISTINCT o_custkey, o_orderkey, l_partkey % 200 AS e FROM orders JOIN lineitem ON o_orderkey = l_orderkey),
    z AS (SELECT o_custkey, o_orderkey, count(*) AS size FROM s GROUP BY ALL),
    p AS (SELECT x.o_custkey, x.o_orderkey, y.o_orderkey AS r, count(*) AS shared FROM s x JOIN s y ON x.o_custkey = y.o_custkey AND x.e = y.e AND y.o_orderkey < x.o_orderkey GROUP BY ALL)
    SELECT p.o_custkey, p.o_orderkey, size, min(r) AS repeats, arg_min(shared, r) AS shared FROM p JOIN z USING (o_custkey, o_orderkey)
    WHERE size >= 2 AND shared >= 0.8 * size GROUP BY ALL""",
)
def repeated_sets(t):
    d = t.orders.select("o_custkey", "o_orderkey").join(t.lineitem.select("l_orderkey", (F.col("l_partkey") % 200).alias("e")), F.col("o_orderkey") == F.col("l_orderkey"))
    return J.contained_earlier(d, ["o_custkey"], "o_orderkey", "e", 0.8, 2)


@query(
    "q_repeated_part_sets",
    """WITH s AS (SELECT DISTINCT o_custkey AS g, o_orderkey AS o, l_partkey AS e FROM orders JOIN lineitem ON o_orderkey = l_orderkey),
    z AS (SELECT g, o, count(*) AS size FROM s GROUP BY ALL), f AS (SELECT g, min(o) AS head FROM s GROUP BY g),
    p AS (SELECT x.g, x.o, y.g AS rg, y.o AS r, count(*) AS shared FROM s x JOIN f ON f.g = x.g JOIN s y ON x.e = y.e AND ((y.g = x.g AND y.o < x.o) OR (y.g <> x.g AND x.o = head)) GROUP BY ALL)
    SELECT g AS o_custkey, o AS o_orderkey, size, rg AS repeats_o_custkey, r AS repeats, shared FROM p JOIN z USING (g, o)
    WHERE size >= 2 AND shared >= 0.8 * size QUALIFY row_number() OVER (PARTITION BY g, o ORDER BY rg, r) = 1""",
)
def repeated_part_sets(t):
    d = t.orders.select("o_custkey", "o_orderkey").join(t.lineitem.select("l_orderkey", F.col("l_partkey").alias("e")), F.col("o_orderkey") == F.col("l_orderkey"))
    return J.first_containing(d, ["o_custkey"], "o_orderkey", "e", 0.8, 2, across=True)


@query(
    "q_near_dup_documents",
    """WITH s AS (SELECT DISTINCT doc_id, sha256(trim(l)) AS e FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM documents) WHERE length(trim(l)) >= 20),
    z AS (SELECT doc_id, count(*) AS size FROM s GROUP BY ALL),
    p AS (SELECT x.doc_id, y.doc_id AS r, count(*) AS shared FROM s x JOIN s y ON x.e = y.e AND y.doc_id < x.doc_id GROUP BY ALL)
    SELECT doc_id, size, min(r) AS repeats, arg_min(shared, r) AS shared FROM p JOIN z USING (doc_id) WHERE shared >= 0.8 * size GROUP BY ALL""",
)
def near_dup_documents(t):
    rows = t.documents.select("doc_id", F.explode(F.split("text", "\n")).alias("l")).filter("char_length(trim(l)) >= 20")
    return J.first_containing(rows.select("doc_id", F.unhex(F.sha2(F.trim("l"), 256)).alias("e")), [], "doc_id", "e")


@query(
    "q_contained_documents",
    """WITH s AS (SELECT DISTINCT doc_id, sha256(trim(l)) AS e FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM documents) WHERE trim(l) <> ''),
    z AS (SELECT doc_id, count(*) AS size FROM s GROUP BY ALL),
    p AS (SELECT x.doc_id, y.doc_id AS r, count(*) AS shared FROM s x JOIN s y ON x.e = y.e AND y.doc_id < x.doc_id GROUP BY ALL)
    SELECT doc_id, size, min(r) AS repeats, arg_min(shared, r) AS shared FROM p JOIN z USING (doc_id) WHERE shared >= 0.8 * size GROUP BY ALL""",
)
def contained_documents(t):
    rows = t.documents.select("doc_id", F.explode(F.split("text", "\n")).alias("l")).filter("trim(l) <> ''")
    return J.first_containing(rows.select("doc_id", F.unhex(F.md5(F.trim("l"))).alias("e")), [], "doc_id", "e")


@query(
    "q_unique_anchor_join",
    """WITH a AS (SELECT min(doc_id) AS doc_id, k FROM (SELECT doc_id, left(text, 40) AS k FROM documents) GROUP BY k HAVING count(*) = 1),
    b AS (SELECT min(item_id) AS item_id, k FROM (SELECT item_id, left(text, 40) AS k FROM benchmark) GROUP BY k HAVING count(*) = 1)
    SELECT sha256(k) AS anchor, doc_id, item_id FROM a JOIN b USING (k)""",
)
def unique_anchor_join(t):
    d = J.unique_anchor_join(t.documents.select("doc_id", F.substring("text", 1, 40).alias("k")), t.benchmark.select("item_id", F.substring("text", 1, 40).alias("k")), "k")
    return d.select(F.sha2("k", 256).alias("anchor"), "doc_id", "item_id")


@query(
    "q_unique_window_join",
    """WITH d AS (SELECT doc_id, list_filter(string_split_regex(text, '[ \\t\\n\\r]+'), lambda x: x <> '') AS w FROM documents),
    i AS (SELECT item_id, list_filter(string_split_regex(text, '[ \\t\\n\\r]+'), lambda x: x <> '') AS w FROM benchmark),
    x AS (SELECT doc_id, p, list_slice(w, p, p + 7) AS k FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 7, 1))) AS p FROM d WHERE len(w) > 0)),
    y AS (SELECT item_id, p, list_slice(w, p, p + 7) AS k FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 7, 1))) AS p FROM i WHERE len(w) > 0)),
    a AS (SELECT min(doc_id) AS doc_id, min(p) AS p, k FROM x GROUP BY k HAVING count(*) = 1),
    b AS (SELECT min(item_id) AS item_id, min(p) AS p, k FROM y GROUP BY k HAVING count(*) = 1),
    m AS (SELECT doc_id, item_id, a.p AS doc_place, b.p AS item_place, coalesce(b.p < lag(b.p) OVER (PARTITION BY doc_id, item_id ORDER BY a.p), false) AS back FROM a JOIN b USING (k))
    SELECT doc_id, item_id, doc_place, item_place FROM (SELECT *, bool_or(back) OVER (PARTITION BY doc_id, item_id) AS bad FROM m) WHERE NOT bad""",
)
def unique_window_join(t):
    d = J.unique_window_join(t.documents.select("doc_id", "text"), t.benchmark.select("item_id", "text"), "doc_id", "item_id", "text", 8)
    return d.withColumnsRenamed({"left_place": "doc_place", "right_place": "item_place"})


@query(
    "q_cardinality_classified_join",
    """WITH r AS (SELECT regexp_replace(upper(p_name), '[^A-Z0-9]', '', 'g') AS k, count(*) AS m, min(p_partkey) AS i FROM part WHERE p_size <= 25 GROUP BY 1)
    SELECT p_partkey, coalesce(m, 0) AS matches, CASE WHEN m IS NULL THEN 'unmatched' WHEN m = 1 THEN 'unique' ELSE 'ambiguous' END AS status,
           CASE WHEN m = 1 THEN i END AS match_other FROM part LEFT JOIN r ON regexp_replace(upper(p_name), '[^A-Z0-9]', '', 'g') = k WHERE p_size > 25""",
)
def cardinality_classified_join(t):
    p = t.part.select("p_partkey", "p_size", X.alnum_key(F.col("p_name")).alias("k"))
    return J.classified_join(p.filter("p_size > 25").select("p_partkey", "k"), p.filter("p_size <= 25").select("k", F.col("p_partkey").alias("other")), "k", "other").drop("k")


@query("q_or_key_join", "SELECT DISTINCT o_orderkey, c_custkey FROM orders JOIN customer ON c_custkey = o_custkey OR c_custkey = o_orderkey % 100")
def or_key_join(t):
    return J.or_key_join(t.orders.select("o_orderkey", "o_custkey", (F.col("o_orderkey") % 100).alias("alt")), t.customer.select("c_custkey"), ["o_custkey", "alt"], "c_custkey").select("o_orderkey", "c_custkey").distinct()


@query(
    "q_fallback_join",
    """WITH o AS (SELECT s_nationkey, count(*) AS n, min(s_suppkey) AS a FROM supplier GROUP BY 1),
    w AS (SELECT s_nationkey, s_suppkey % 10 AS f, count(*) AS m, min(s_suppkey) AS b FROM supplier GROUP BY ALL)
    SELECT c_custkey, CASE WHEN n = 1 THEN a WHEN m = 1 THEN b END AS match FROM customer LEFT JOIN o ON s_nationkey = c_nationkey
    LEFT JOIN w ON w.s_nationkey = c_nationkey AND f = c_custkey % 10""",
)
def fallback_join(t):
    c = t.customer.select("c_custkey", F.col("c_nationkey").alias("k"), (F.col("c_custkey") % 10).alias("f"))
    return J.fallback_join(c, t.supplier.select(F.col("s_nationkey").alias("k"), (F.col("s_suppkey") % 10).alias("f"), "s_suppkey"), "k", "f", "s_suppkey").select("c_custkey", "match")


@query(
    "q_positional_join",
    """WITH u AS (SELECT conv_id, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i, count(*) OVER (PARTITION BY conv_id) AS n FROM conversations WHERE role = 'user'),
    a AS (SELECT conv_id, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i, count(*) OVER (PARTITION BY conv_id) AS n FROM conversations WHERE role = 'assistant')
    SELECT u.conv_id, u.i AS place, length(u.text) AS asked, length(a.text) AS answered FROM u JOIN a ON u.conv_id = a.conv_id AND u.i = a.i AND u.n = a.n""",
)
def positional_join(t):
    c = t.conversations
    one = lambda r, n: c.filter(F.col("role") == r).select("conv_id", "turn", F.char_length("text").alias(n))
    return J.positional_join(one("user", "asked"), one("assistant", "answered").withColumnRenamed("turn", "turn2"), ["conv_id"], ["turn"], ["turn2"]).select("conv_id", "place", "asked", "answered")


@query("q_overlay_guarded", "SELECT d.doc_id, CASE WHEN l.doc_id IS NOT NULL AND d.lang = 'en' THEN 'reviewed' ELSE d.source END AS source, CASE WHEN l.doc_id IS NULL THEN NULL WHEN d.lang = 'en' THEN 'applied' ELSE 'precondition_failed' END AS review_status, CASE WHEN l.doc_id IS NOT NULL AND d.lang = 'en' THEN d.source END AS source_before FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l USING (doc_id)")
def overlay_guarded(t):
    reviews = t.labels.select("doc_id").distinct().withColumn("seen_lang", F.lit("en"))
    return O.apply_overlay(t.documents.select("doc_id", "lang", "source"), reviews, ["doc_id"], ["lang"], {"source": F.lit("reviewed")}).select("doc_id", "source", "review_status", "source_before")


@query("q_overlay_violations", "SELECT doc_id, CASE WHEN d.doc_id IS NULL THEN 'no row' ELSE 'lang differs' END AS reasons FROM (SELECT DISTINCT doc_id FROM labels) l LEFT JOIN documents d USING (doc_id) WHERE d.lang IS DISTINCT FROM 'en'")
def overlay_violations(t):
    reviews = t.labels.select("doc_id").distinct().withColumn("seen_lang", F.lit("en"))
    return O.violations(t.documents.select("doc_id", "lang"), reviews, ["doc_id"], ["lang"]).select("doc_id", F.array_join("reasons", ";").alias("reasons"))


@query(
    "q_pred_vs_truth",
    """SELECT status, count(*) AS n FROM (SELECT CASE WHEN l.doc_id IS NULL THEN 'extra' WHEN d.doc_id IS NULL THEN 'missing' WHEN p IS NULL THEN 'abstained' WHEN p = quality THEN 'correct' ELSE 'wrong' END AS status
    FROM labels l FULL JOIN (SELECT doc_id, CASE WHEN n_chars < 100 THEN NULL WHEN n_chars > 800 THEN 1 ELSE 0 END AS p FROM documents) d ON l.doc_id = d.doc_id) GROUP BY 1""",
)
def pred_vs_truth(t):
    p = t.documents.select("doc_id", F.when(F.col("n_chars") < 100, None).when(F.col("n_chars") > 800, 1).otherwise(0).alias("p"))
    return A.count_by(J.compare_predictions(t.labels, p, ["doc_id"], "quality", "p"), "status")


@query("q_inventory_diff", "SELECT coalesce(d.doc_id, l.doc_id) AS doc_id, CASE WHEN l.doc_id IS NULL THEN 'missing' WHEN d.doc_id IS NULL THEN 'unexpected' WHEN v = quality THEN 'same' ELSE 'differs' END AS status FROM (SELECT doc_id, CASE WHEN n_chars > 800 THEN 1 ELSE 0 END AS v FROM documents) d FULL JOIN labels l ON l.doc_id = d.doc_id")
def inventory_diff(t):
    return J.inventory(t.documents.select("doc_id", F.when(F.col("n_chars") > 800, 1).otherwise(0).alias("quality")), t.labels.select("doc_id", "quality"), "doc_id", "quality")


@query("q_identical_sources", "SELECT sha256(text) AS digest, min(doc_id) AS first, array_to_string(list_sort(list(doc_id))[2:], ';') AS aliases, count(*) AS members FROM documents GROUP BY 1 HAVING count(*) > 1")
def identical_sources(t):
    d = J.identical_groups(t.documents, F.col("text"), "doc_id").filter("members > 1")
    return d.select("digest", "first", F.array_join(F.transform("aliases", lambda x: x.cast("string")), ";").alias("aliases"), "members")


# --- aggregates ----------------------------------------------------------------------------------------------


@query("q_group_count", "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL")
def group_count(t):
    return A.count_by(t.orders, "o_orderstatus", "o_orderpriority")


@query("q_freq_table", "SELECT o_orderpriority, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM orders), 4) AS pct FROM orders GROUP BY 1")
def freq_table(t):
    return A.frequency(t.orders, "o_orderpriority")


@query("q_dup_keys", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def dup_keys(t):
    return A.repeated_keys(t.lineitem, "l_orderkey", "l_linenumber")


@query("q_rollup_levels", "SELECT r_name, n_name, count(*) AS n, round(sum(c_acctbal), 2) AS balance, (2 - bit_count(grouping(r_name, n_name)::INT))::INT AS depth FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ROLLUP (r_name, n_name)")
def rollup_levels(t):
    d = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return A.rollup_counts(d, ["r_name", "n_name"], balance="c_acctbal").withColumn("balance", F.round("balance", 2))


_GAPS = """SELECT l_orderkey, max(l_linenumber) AS last, list_sort(list_filter(range(1, max(l_linenumber) + 1), lambda x: NOT list_contains(list(l_linenumber), x))) AS gaps,
    count(*) - count(DISTINCT l_linenumber) AS n_repeated FROM lineitem GROUP BY 1"""


@query("q_sequence_gaps", f"SELECT l_orderkey, last, array_to_string(gaps, ';') AS missing, len(gaps) AS n_missing FROM ({_GAPS}) WHERE len(gaps) > 0")
def sequence_gaps(t):
    d = A.sequence_gaps(t.lineitem, ["l_orderkey"], "l_linenumber").filter("n_missing > 0")
    return d.select("l_orderkey", "last", F.array_join(F.transform("missing", lambda x: x.cast("string")), ";").alias("missing"), "n_missing")


@query("q_sequence_repeats", f"SELECT l_orderkey, n_repeated FROM ({_GAPS}) WHERE n_repeated > 0")
def sequence_repeats(t):
    return A.sequence_gaps(t.lineitem, ["l_orderkey"], "l_linenumber").filter("n_repeated > 0").select("l_orderkey", "n_repeated")


@query("q_argmax_group", "SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY (o_orderstatus = 'F') DESC, o_totalprice DESC, o_orderkey) = 1")
def argmax_group(t):
    return A.argmax(t.orders, ["o_custkey"], [F.col("o_orderstatus") == "F", F.col("o_totalprice"), -F.col("o_orderkey")], ["o_orderkey", "o_totalprice"])


@query("q_first_non_null", "SELECT conv_id, turn, first_value(CASE WHEN role = 'user' THEN length(text) END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS asked FROM conversations")
def first_non_null(t):
    w = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return t.conversations.select("conv_id", "turn", F.first(F.when(F.col("role") == "user", F.char_length("text")), ignorenulls=True).over(w).alias("asked"))


@query("q_arith_identity", "SELECT o_orderkey, round(o_totalprice, 2) AS o_totalprice, round(s, 2) AS expected FROM orders JOIN (SELECT l_orderkey, round(sum(l_extendedprice), 2) AS s FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey WHERE abs(o_totalprice - s) > 0.5")
def arith_identity(t):
    s = t.lineitem.groupBy("l_orderkey").agg(F.round(F.sum("l_extendedprice"), 2).alias("s"))
    d = A.identity_audit(t.orders.join(s, F.col("o_orderkey") == F.col("l_orderkey")), "o_totalprice", ["s"], 0.5)
    return d.select("o_orderkey", F.round("o_totalprice", 2).alias("o_totalprice"), F.round("expected", 2).alias("expected"))


@query(
    "q_agreement_rate",
    """WITH o AS (SELECT sha256(text) AS h, doc_id, max(quality) AS v FROM documents LEFT JOIN labels USING (doc_id) GROUP BY ALL)
    SELECT h, count(*) AS witnesses, count(DISTINCT v) <= 1 AND count(v) = count(*) AS agree FROM o GROUP BY 1 HAVING count(*) > 1""",
)
def agreement_rate(t):
    d = t.documents.select("doc_id", F.sha2("text", 256).alias("h")).join(t.labels, "doc_id", "left")
    return A.agreement(d, ["h"], "doc_id", "quality")


_SCORE = "SELECT quality, 1 / (1 + exp(-(n_chars - 600) / 400.0)) AS p FROM documents JOIN labels USING (doc_id)"


def _score(t):
    d = t.documents.select("doc_id", "n_chars").join(t.labels, "doc_id")
    return d.select("quality", (1 / (1 + F.exp(-(F.col("n_chars") - 600) / 400.0))).alias("p"))


@query("q_calibration_bins", f"SELECT CASE WHEN p <= .1 THEN 0 WHEN p <= .3 THEN 1 WHEN p <= .5 THEN 2 WHEN p <= .7 THEN 3 WHEN p <= .9 THEN 4 ELSE 5 END AS bin, count(*) AS n, round(avg(p), 6) AS mean_p, round(avg(quality), 6) AS mean_y FROM ({_SCORE}) GROUP BY 1")
def calibration_bins(t):
    return A.calibration(_score(t), F.col("p"), F.col("quality"))


@query(
    "q_auc_logloss_brier",
    f"""WITH s AS ({_SCORE}), r AS (SELECT *, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0 AS rk FROM s)
    SELECT count(*) AS n, round((sum(rk) FILTER (WHERE quality = 1) - sum(quality) * (sum(quality) + 1) / 2.0) / (sum(quality) * (count(*) - sum(quality))), 4) AS auc,
    round(avg(CASE WHEN quality = 1 THEN -ln(least(greatest(p, 1e-6), 1 - 1e-6)) ELSE -ln(1 - least(greatest(p, 1e-6), 1 - 1e-6)) END), 4) AS log_loss,
    round(avg((p - quality) ** 2), 4) AS brier, round(avg(CASE WHEN (p >= 0.5) = (quality = 1) THEN 1 ELSE 0 END), 4) AS accuracy FROM r""",
)
def auc_logloss_brier(t):
    return A.classifier_metrics(_score(t), F.col("p"), F.col("quality"))


@query("q_bad_pages", "SELECT l_orderkey, count(*) FILTER (WHERE l_quantity < 20) AS miss, count(*) AS n, printf('%d of %d lines are small', count(*) FILTER (WHERE l_quantity < 20), count(*)) AS why FROM lineitem GROUP BY 1 HAVING 2 * count(*) FILTER (WHERE l_quantity < 20) > count(*)")
def bad_pages(t):
    return A.bad_pages(t.lineitem, ["l_orderkey"], F.col("l_quantity") < 20, "%d of %d lines are small")


@query(
    "q_completeness",
    """WITH h AS (SELECT l_orderkey, count(*) AS held, min(l_linenumber) AS f, max(l_linenumber) AS l, count(DISTINCT l_linenumber) AS d FROM lineitem GROUP BY 1)
    SELECT o_orderkey, 4 AS expected, coalesce(held, 0) AS held, f AS first_serial, l AS last_serial, 4 - coalesce(held, 0) AS shortfall,
    coalesce(greatest(l - f + 1 - d, 0), 0) AS missing_inside, greatest(4 - coalesce(held, 0) - coalesce(greatest(l - f + 1 - d, 0), 0), 0) AS missing_at_ends,
    CASE WHEN coalesce(held, 0) = 4 THEN 'complete' WHEN coalesce(held, 0) < 4 THEN 'partial' ELSE 'review' END AS status FROM orders LEFT JOIN h ON l_orderkey = o_orderkey""",
)
def completeness(t):
    return A.completeness(t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber"), t.orders.select("o_orderkey", F.lit(4).alias("size")), ["o_orderkey"], "l_linenumber", "size")


@query("q_topk_deviation", "WITH g AS (SELECT n_name, avg(c_acctbal) - (SELECT avg(c_acctbal) FROM customer) AS d FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1) SELECT n_name, round(d, 2) AS deviation FROM g ORDER BY abs(d) DESC, n_name LIMIT 5")
def topk_deviation(t):
    g = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_name").agg(F.sum("c_acctbal").alias("s"), F.count("*").alias("n"))
    w = Window.partitionBy()
    g = g.withColumn("deviation", F.col("s") / F.col("n") - F.sum("s").over(w) / F.sum("n").over(w)).select("n_name", "deviation")
    return A.top_deviations(g, "deviation", "n_name").withColumn("deviation", F.round("deviation", 2))


# --- windows -------------------------------------------------------------------------------------------------


@query("q_carry_forward", "SELECT event_id, last_value(CASE WHEN event_type = 'purchase' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_purchase FROM events")
def carry_forward(t):
    d = t.events.select("event_id", "user_id", "ts", F.when(F.col("event_type") == "purchase", F.col("event_id")).alias("p"))
    return W.carry_forward(d, ["user_id"], ["ts", "event_id"], "p", "last_purchase").select("event_id", "last_purchase")


_ORD = "l_shipdate, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice"


@query(
    "q_restart_counter",
    f"""WITH a AS (SELECT *, lag(l_linenumber) OVER (PARTITION BY l_orderkey ORDER BY {_ORD}) AS b FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, sum(CASE WHEN l_linenumber <= b THEN 1 ELSE 0 END) OVER (PARTITION BY l_orderkey ORDER BY {_ORD} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS printing FROM a""",
)
def restart_counter(t):
    return W.restarts(t.lineitem, ["l_orderkey"], _ORD.split(", "), "l_linenumber", "printing").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "printing")


@query(
    "q_units",
    """WITH a AS (SELECT event_id, user_id, event_type = 'signup' AS head, CASE WHEN event_type <> 'signup' THEN (event_id % 3 + 1)::INT END AS ward, date_trunc('day', ts) AS page,
      row_number() OVER w AS i, lag(event_type = 'signup') OVER w AS ph, lag(CASE WHEN event_type <> 'signup' THEN (event_id % 3 + 1)::INT END) OVER w AS pw, lag(date_trunc('day', ts)) OVER w AS pp
      FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    b AS (SELECT *, i = 1 OR page <> pp AS st, coalesce((ph AND ward = 1) OR (NOT ph AND ward = pw + 1), false) AS fo FROM a)
    SELECT event_id, (sum(CASE WHEN head OR (st AND i > 1 AND NOT fo) OR coalesce(ward = 1 AND NOT ph, false) THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY i) - 1)::BIGINT AS unit FROM b""",
)
def units(t):
    head = F.col("event_type") == "signup"
    d = t.events.select("event_id", "user_id", "ts", F.when(head, "head").otherwise("ward").alias("tier"), F.when(~head, (F.col("event_id") % 3 + 1).cast("int")).alias("ward"), F.date_trunc("day", "ts").alias("page"))
    return W.units(d, ["user_id"], ["ts", "event_id"], "tier", "ward", "page", "unit").select("event_id", "unit")


@query(
    "q_islands",
    """WITH d AS (SELECT DISTINCT user_id, ts::DATE AS day FROM events), i AS (SELECT *, day - row_number() OVER (PARTITION BY user_id ORDER BY day)::INT AS g FROM d)
    SELECT user_id, min(day)::VARCHAR AS first_day, max(day)::VARCHAR AS last_day, count(*) AS days FROM i GROUP BY user_id, g""",
)
def islands(t):
    d = t.events.select("user_id", F.to_date("ts").alias("day")).distinct()
    w = Window.partitionBy("user_id").orderBy("day")
    d = W.islands(d.withColumn("before", F.lag("day").over(w)), ["user_id"], ["day"], F.datediff("day", "before") > 1, "island")
    return d.groupBy("user_id", "island").agg(F.min("day").cast("string").alias("first_day"), F.max("day").cast("string").alias("last_day"), F.count("*").alias("days")).drop("island")


@query("q_first_appearance_serial", "SELECT o_orderpriority, o_custkey, row_number() OVER (PARTITION BY o_orderpriority ORDER BY m, o_custkey) AS serial FROM (SELECT o_orderpriority, o_custkey, min(o_orderkey) AS m FROM orders GROUP BY ALL)")
def first_appearance_serial(t):
    return W.appearance_serial(t.orders, ["o_orderpriority"], "o_custkey", "o_orderkey")


@query(
    "q_page_reset_carry",
    """WITH a AS (SELECT conv_id, turn, CASE WHEN role = 'user' THEN turn END AS v, turn - lag(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS g, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS pr FROM conversations),
    b AS (SELECT *, sum(CASE WHEN (g <> 0 AND g <> 1) THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn) AS isl FROM a)
    SELECT conv_id, turn, last_value(v IGNORE NULLS) OVER (PARTITION BY conv_id, isl ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS carried FROM b""",
)
def page_reset_carry(t):
    d = t.conversations.select("conv_id", "turn", F.when(F.col("role") == "user", F.col("turn")).alias("v"))
    return W.carry_within_pages(d, ["conv_id"], ["turn"], "turn", "v", "carried").select("conv_id", "turn", "carried")


@query("q_mark_repeats", "SELECT doc_id, count(*) OVER (PARTITION BY text) > 1 AS repeated FROM documents")
def mark_repeats(t):
    return W.mark_repeats(t.documents.select("doc_id", F.sha2("text", 256).alias("h")), ["h"], "repeated").select("doc_id", "repeated")


@query("q_neighbours", "SELECT conv_id, role, next_role, count(*) AS n FROM (SELECT conv_id, role, lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS next_role, lead(1) OVER (PARTITION BY conv_id ORDER BY turn) AS l FROM conversations) WHERE l = 1 GROUP BY ALL")
def neighbours(t):
    return A.count_by(W.neighbours(t.conversations, ["conv_id"], ["turn"], "role"), "conv_id", "role", "next_role")


@query("q_monotone", "SELECT user_id, NOT coalesce(bool_or(value < p), false) AS monotone FROM (SELECT user_id, value, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events) GROUP BY 1")
def monotone(t):
    return W.monotone(t.events, ["user_id"], ["ts", "event_id"], "value")


@query("q_event_windows", "SELECT time_bucket(INTERVAL 1 DAY, ts) AS start, event_type, count(*) AS n FROM events GROUP BY ALL")
def event_windows(t):
    from ledgerloom.streaming.resumable import event_windows as counted

    return counted(t.events, "ts", "1 day", "event_type")


# --- sets ----------------------------------------------------------------------------------------------------


@query("q_set_ops", "SELECT coalesce(a.k, b.k) AS k, CASE WHEN b.k IS NULL THEN 'left_only' WHEN a.k IS NULL THEN 'right_only' ELSE 'both' END AS side FROM (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'F') a FULL JOIN (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'O') b ON a.k = b.k")
def set_ops(t):
    one = lambda s: t.orders.filter(F.col("o_orderstatus") == s).select(F.col("o_custkey").alias("k"))
    return U.key_differences(one("F"), one("O"), "k")


@query("q_union_by_name", "SELECT 'customer' AS kind, c_custkey AS k, c_mktsegment AS segment, NULL::VARCHAR AS brand FROM customer UNION ALL SELECT 'part', p_partkey, NULL, p_brand FROM part")
def union_by_name(t):
    return U.union_all(t.customer.select(F.lit("customer").alias("kind"), F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("segment")), t.part.select(F.lit("part").alias("kind"), F.col("p_partkey").alias("k"), F.col("p_brand").alias("brand")))


@query("q_table_diff", "SELECT 'o_orderstatus' AS \"column\", count(*) FILTER (WHERE o_orderkey % 7 = 0 AND o_orderstatus <> 'X') AS changed FROM orders UNION ALL SELECT 'o_custkey', count(*) FILTER (WHERE o_orderkey % 11 = 0) FROM orders")
def table_diff(t):
    a = t.orders.select("o_orderkey", "o_orderstatus", "o_custkey")
    b = a.withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 7 == 0, "X").otherwise(F.col("o_orderstatus"))).withColumn("o_custkey", F.when(F.col("o_orderkey") % 11 == 0, F.col("o_custkey") + 1).otherwise(F.col("o_custkey")))
    return U.changed_columns(a, b, ["o_orderkey"])


# --- scalar functions ----------------------------------------------------------------------------------------


@query("q_text_normalize", "SELECT p_partkey, upper(regexp_replace(p_name, '[^A-Za-z0-9]', '', 'g')) AS alnum, trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '_', 'g'), '_') AS slug, regexp_replace(lower(p_type), '[^a-z]', '', 'g') AS letters FROM part")
def text_normalize(t):
    return t.part.select("p_partkey", X.alnum_key(F.col("p_name")).alias("alnum"), X.slug(F.col("p_name")).alias("slug"), X.letters(F.col("p_type")).alias("letters"))


@query("q_name_key", "SELECT p_partkey, array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all(lower(p_name), '(\\d+)', 1), lambda x: x::INT))), ';') AS numbers, regexp_matches(lower(p_name), 'uttar|utter') AS north FROM part")
def name_key(t):
    k = X.name_key(F.col("p_name"))
    return t.part.select("p_partkey", F.array_join(F.transform(k["numbers"], lambda x: x.cast("string")), ";").alias("numbers"), F.array_contains(k["directions"], "north").alias("north"))


@query(
    "q_category_ladder",
    """WITH m AS (SELECT s_suppkey, CASE s_suppkey % 6 WHEN 0 THEN 'Scheduled Cast e Women' WHEN 1 THEN 'Unresreved' WHEN 2 THEN 'BC (A) Other than Women' WHEN 3 THEN 'Backward Class A' WHEN 4 THEN 'nothing' ELSE 'S.T. Women' END AS raw FROM supplier)
    SELECT s_suppkey, CASE s_suppkey % 6 WHEN 0 THEN 'SC' WHEN 1 THEN 'NONE' WHEN 2 THEN 'BC_A' WHEN 3 THEN 'BC_A' WHEN 5 THEN 'ST' END AS caste,
    CASE s_suppkey % 6 WHEN 0 THEN 1 WHEN 1 THEN 0 WHEN 2 THEN 0 WHEN 3 THEN 0 WHEN 5 THEN 1 END AS woman FROM m""",
)
def category_ladder(t):
    texts = ["Scheduled Cast e Women", "Unresreved", "BC (A) Other than Women", "Backward Class A", "nothing", "S.T. Women"]
    raw = F.get(F.array(*[F.lit(x) for x in texts]), (F.col("s_suppkey") % 6).cast("int"))
    return t.supplier.select("s_suppkey", X.category_ladder(raw).alias("c")).select("s_suppkey", "c.caste", "c.woman")


@query("q_html_items", "SELECT page_id, count(*) AS items, sum(length(trim(regexp_replace(regexp_replace(i, '<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g')))) AS chars FROM (SELECT page_id, unnest(regexp_extract_all(html, '(?is)<li[^>]*>(.*?)</li>', 1)) AS i FROM pages) GROUP BY 1")
def html_items(t):
    return H.list_items(t.pages, "html", ["page_id"]).groupBy("page_id").agg(F.count("*").alias("items"), F.sum(F.char_length("text")).alias("chars"))


@query("q_html_links", "SELECT page_id, href, count(*) AS n FROM (SELECT page_id, unnest(regexp_extract_all(html, '(?i)<a href=\"([^\"]*)\"', 1)) AS href FROM pages) GROUP BY ALL")
def html_links(t):
    return A.count_by(H.flat_links(t.pages, "html", ["page_id"]), "page_id", "href")


@query("q_url_method", "SELECT page_id, CASE WHEN url IS NULL OR trim(url) = '' THEN 'unknown' WHEN contains(url, 'web.archive.org/') THEN 'wayback' ELSE 'live' END AS method, regexp_extract(url, '^([a-z]+)://', 1) AS scheme FROM pages")
def url_method(t):
    return t.pages.select("page_id", X.url_method(F.col("url")).alias("method"), F.regexp_extract("url", "^([a-z]+)://", 1).alias("scheme"))


@query("q_json_cells", "SELECT json_extract(props, '$.k')::INT % 10 AS k, count(*) AS n FROM events GROUP BY 1")
def json_cells(t):
    return t.events.select((F.from_json("props", "k int")["k"] % 10).alias("k")).groupBy("k").agg(F.count("*").alias("n"))


@query("q_script_detect", "SELECT doc_id, CASE WHEN regexp_matches(text, '[ऀ-ॿ]') THEN 'Devanagari' WHEN regexp_matches(text, '[A-Za-z]') THEN 'Latin' ELSE 'Unreadable' END AS script FROM documents")
def script_detect(t):
    return t.documents.select("doc_id", X.script_of(F.col("text")).alias("script"))


@query("q_numeric_token_typing", "SELECT o_orderkey, CASE WHEN v LIKE '0_%' AND v NOT LIKE '%.%' AND v <> '-' THEN NULL WHEN v LIKE '%.%' THEN NULL WHEN v = '-' THEN NULL ELSE v::BIGINT END AS value, CASE WHEN v = '-' THEN 'dash' WHEN v LIKE '%.%' THEN 'decimal' WHEN v LIKE '0_%' THEN 'leading_zero' END AS reason FROM (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN '-' WHEN 1 THEN '0' || o_custkey WHEN 2 THEN o_custkey || '.5' ELSE o_custkey::VARCHAR END AS v FROM orders)")
def numeric_token_typing(t):
    k = F.col("o_custkey").cast("string")
    v = F.when(F.col("o_orderkey") % 4 == 0, "-").when(F.col("o_orderkey") % 4 == 1, F.concat(F.lit("0"), k)).when(F.col("o_orderkey") % 4 == 2, F.concat(k, F.lit(".5"))).otherwise(k)
    return t.orders.select("o_orderkey", X.numeric_token(v).alias("t")).select("o_orderkey", "t.value", "t.reason")


@query("q_page_identity", "SELECT doc_id, printf('%s-p%04d', left(sha256(text), 12), doc_id % 10000) AS page FROM documents")
def page_identity(t):
    return t.documents.select("doc_id", X.page_identity(F.substring(F.sha2("text", 256), 1, 12), F.col("doc_id") % 10000).alias("page"))


# --- what SQL doesn't express --------------------------------------------------------------------------------


def _halves(t):
    p = t.part.select("p_partkey", "p_brand", "p_name", "p_size")
    return p.filter("p_partkey % 2 = 0"), p.filter("p_partkey % 2 = 1")


@query("q_fuzzy_link")
def fuzzy_link(t):
    from ledgerloom.operators.linkage import link

    a, b = _halves(t)
    return link(a, b, ["p_brand"], "p_name", "p_partkey", "p_size")


def _sql_fold(c: str) -> str:
    """functions.text.fold in SQL; DuckDB's patterns have no back references, so doubled letters go one by one."""
    steps = [x for p, r in X.FOLDS for x in ([(f"{c}{c}", c) for c in "abcdefghijklmnopqrstuvwxyz"] if "\\1" in p else [(p, r.replace("$", "\\"))])]
    return reduce(lambda x, f: f"regexp_replace({x}, '{f[0]}', '{f[1]}', 'g')", steps, f"lower({c})")


_LCS = """len({a}) - bit_count(list_reduce(list_prepend((1::BIGINT << len({a})) - 1, list_transform(range(1, len({b}) + 1), lambda j: list_sum(list_transform(range(1, len({a}) + 1),
    lambda i: CASE WHEN {a}[i] = {b}[j] THEN 1::BIGINT << (i - 1) ELSE 0 END))::BIGINT)), lambda s, m: ((s + (s & m)) | (s - (s & m))) & ((1::BIGINT << len({a})) - 1)))"""


@query(
    "q_name_pairs",
    f"""WITH n AS (SELECT DISTINCT p_name, p_brand, p_partkey % 2 AS half FROM part),
    k AS (SELECT DISTINCT p_name, {_sql_fold("p_name")} AS w FROM n),
    p AS (SELECT a.p_name AS l_name, b.p_name AS r_name, a.w AS a, b.w AS b, regexp_replace(a.w, '[aeiou]', '', 'g') AS sa, regexp_replace(b.w, '[aeiou]', '', 'g') AS sb FROM k a, k b),
    s AS (SELECT l_name, r_name, greatest(2.0 * ({_LCS.format(a="a", b="b")}) / (len(a) + len(b)), 2.0 * ({_LCS.format(a="sa", b="sb")}) / (len(sa) + len(sb)) - 0.05) AS score FROM p)
    SELECT l_name, r_name, round(score, 6) AS score, count(*) AS brands FROM s JOIN n x ON x.p_name = l_name AND x.half = 0 JOIN n y ON y.p_name = r_name AND y.half = 1 AND y.p_brand = x.p_brand
    WHERE score >= 0.8 - 1e-9 GROUP BY l_name, r_name, score""",
)
def name_pairs(t):
    """Pairs of names of one brand's even and odd parts that are alike, and in how many brands both occur."""
    from ledgerloom.operators.comparisons import Name, compare

    a, b = (h.select("p_brand", "p_name").distinct() for h in _halves(t))
    return compare(a, b, ["p_brand"], "p_name", [Name("p_name")], 0.8).groupBy(F.col("left").alias("l_name"), F.col("right").alias("r_name"), F.round("score", 6).alias("score")).agg(F.count("*").alias("brands"))


@query("q_shuffle_baseline")
def shuffle_baseline(t):
    d = W.shuffled_within(t.part.select("p_brand", "p_partkey", "p_size"), ["p_brand"], ["p_partkey"], "p_size", "shuffled")
    return d.agg(F.count("*").alias("n"), F.round(F.avg((F.col("p_size") == F.col("shuffled")).cast("double")), 4).alias("chance"))


def _reads(t):
    """Every order: its customer's orders in turn as positions of a file; each urgent one leaves out a serial."""
    turn = Window.partitionBy("o_custkey").orderBy("o_orderkey").rowsBetween(Window.unboundedPreceding, 0)
    k = F.count("*").over(turn)
    return t.orders.select(F.col("o_custkey").alias("file"), k.alias("k"), (k + F.count_if(F.col("o_orderpriority") == "1-URGENT").over(turn)).alias("serial"))


_SERIALS = """WITH r AS (SELECT o_custkey AS file, count(*) OVER w AS k, count(*) FILTER (WHERE o_orderpriority = '1-URGENT') OVER w AS o
    FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING)),
s AS (SELECT file, min(k) AS first_k, max(k) AS last_k, o AS "offset" FROM r GROUP BY file, o HAVING count(*) > 1)
"""


@query("q_serial_segments", _SERIALS + 'SELECT file, first_k, last_k, "offset" FROM s')
def serial_segments(t):
    from ledgerloom.operators.sequences import segments

    return segments(_reads(t), "file", "k", "serial")


@query(
    "q_serial_assignment",
    _SERIALS
    + """SELECT r.file, r.k, r.k + s."offset" AS assigned, CASE WHEN s.file IS NOT NULL THEN 'inside'
    WHEN r.file IN (SELECT file FROM s) THEN 'outside_confirmed_serials' ELSE 'no_serial_read' END AS basis
FROM r LEFT JOIN s ON r.file = s.file AND r.k BETWEEN s.first_k AND s.last_k""",
)
def serial_assignment(t):
    from ledgerloom.operators.sequences import assign_serials, segments

    return assign_serials(_reads(t).select("file", "k"), segments(_reads(t), "file", "k", "serial"), "file", "k")


@query("q_sequence_align")
def sequence_align(t):
    from ledgerloom.operators.sequences import aligned

    c = t.conversations.groupBy("conv_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("turn", "role"))), lambda x: x["role"]).alias("a"))
    return aligned(c.withColumn("b", F.reverse("a")), "conv_id", "a", "b")


@query("q_logit_groupcv")
def logit_groupcv(t):
    from ledgerloom.operators.inference import cross_validated

    symbols = F.try_divide(F.length(F.regexp_replace("text", "[^#*$%&|<>]+", "")), "n_chars")  # an empty text has no share: its p is null
    d = t.documents.select("doc_id", "source", (F.col("n_chars") / 1000).alias("length"), symbols.alias("symbols")).join(t.labels, "doc_id")
    return cross_validated(d, ["length", "symbols"], "quality", "source", 5).select("doc_id", "fold", F.round("p", 6).alias("p"))


@query("q_nested_links")
def nested_links(t):
    return t.pages.select("page_id", F.explode(H.links("html", "url")).alias("l")).select("page_id", "l.*")


# --- records: filters, lookups, classes, checks --------------------------------------------------------------


@query("q_fewer_names", "SELECT o_custkey, CASE WHEN count(DISTINCT o_orderstatus) < count(DISTINCT o_orderpriority) THEN 'above' ELSE 'below' END AS reading FROM orders GROUP BY 1")
def fewer_names(t):
    return A.fewer_names(t.orders, ["o_custkey"], "o_orderstatus", "o_orderpriority")


@query("q_contiguous", "SELECT l_orderkey, count(*) = count(DISTINCT l_linenumber) AND count(*) = max(l_linenumber) - min(l_linenumber) + 1 AS contiguous FROM lineitem GROUP BY 1")
def contiguous(t):
    return A.contiguous(t.lineitem, ["l_orderkey"], "l_linenumber")


@query("q_cost_rollup", "SELECT round(sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 1000 END) / 1000, 2) AS cost, sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 1000 END) <= 1e9 AS within FROM orders")
def cost_rollup(t):
    d = t.orders.select(F.when(F.col("o_orderstatus") == "F", "completed").otherwise("open").alias("status"), F.col("o_totalprice").alias("priced"), F.lit(1000.0).alias("reserved"))
    return A.cost_rollup(d, "status", "priced", "reserved", 1e9).select(F.round(F.col("cost") / 1000, 2).alias("cost"), "within")


@query("q_mean_where", "SELECT l_returnflag, round(avg(l_discount) FILTER (WHERE l_quantity > 25), 6) AS large, round(avg(l_tax) FILTER (WHERE l_linestatus = 'O'), 6) AS open FROM lineitem GROUP BY 1")
def mean_where(t):
    d = A.mean_where(t.lineitem, ["l_returnflag"], {"large": (F.col("l_quantity") > 25, F.col("l_discount")), "open": (F.col("l_linestatus") == "O", F.col("l_tax"))})
    return d.select("l_returnflag", F.round("large", 6).alias("large"), F.round("open", 6).alias("open"))


@query("q_first_of", "SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1")
def first_of(t):
    return W.first_of(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey")


@query("q_share_within", "SELECT l_orderkey, l_linenumber, round(avg((l_returnflag = 'R')::INT) OVER (PARTITION BY l_orderkey), 6) AS share, avg((l_returnflag = 'R')::INT) OVER (PARTITION BY l_orderkey) BETWEEN .4 AND .6 AS mixed FROM lineitem")
def share_within(t):
    d = W.share_within(t.lineitem, ["l_orderkey"], F.col("l_returnflag") == "R", "s")
    return d.select("l_orderkey", "l_linenumber", F.round("s", 6).alias("share"), F.col("s").between(0.4, 0.6).alias("mixed"))


@query("q_unknown_flags", "SELECT DISTINCT event_type FROM events WHERE event_type NOT IN ('view', 'click', 'purchase')")
def unknown_flags(t):
    return A.unknown_flags(t.events, F.array("event_type"), t.spark.createDataFrame([("view",), ("click",), ("purchase",)], "event_type string"), "event_type")


@query(
    "q_covers_frame",
    """WITH f AS (SELECT o_orderkey AS k, unnest(range(1, 5)) AS i FROM orders), c AS (SELECT l_orderkey AS k, l_linenumber AS i, count(*) AS n FROM lineitem GROUP BY ALL)
    SELECT k, i, CASE WHEN c.n IS NULL THEN 'missing' WHEN f.k IS NULL THEN 'unexpected' ELSE 'duplicate' END AS problem FROM f FULL JOIN c USING (k, i) WHERE c.n IS NULL OR f.k IS NULL OR c.n > 1""",
)
def covers_frame(t):
    from ledgerloom.operators.quality import covers_frame

    frame = t.orders.select(F.col("o_orderkey").alias("k"), F.explode(F.sequence(F.lit(1), F.lit(4))).alias("i"))
    return covers_frame(t.lineitem.select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("i")), frame, "k", "i")


@query("q_pair_group", "SELECT p_partkey, sha256('[\"' || least(p_name, p_brand) || '\",\"' || greatest(p_name, p_brand) || '\"]') AS pair FROM part")
def pair_group(t):
    return t.part.select("p_partkey", J.pair_group(F.col("p_name"), F.col("p_brand")).alias("pair"))


@query("q_last_record", "SELECT user_id, arg_max(event_type, event_id) AS event_type, max(event_id) AS event_id FROM events GROUP BY 1")
def last_record(t):
    from ledgerloom.sources.tables import last_record

    return last_record(t.events.select("user_id", "event_type", "event_id"), "user_id", "event_id")


@query("q_last_lookup", "SELECT c_custkey, (SELECT arg_max(o_orderstatus, o_orderkey) FROM orders WHERE o_custkey = c_custkey) AS o_orderstatus FROM customer")
def last_lookup(t):
    d = t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderstatus", "o_orderkey")
    return J.last_lookup(t.customer.select("c_custkey"), d, ["c_custkey"], "o_orderkey")


@query("q_one_to_one", "SELECT doc_id, quality, CASE WHEN l.doc_id IS NULL THEN 'left_only' ELSE 'both' END AS _merge FROM documents d LEFT JOIN labels l USING (doc_id)")
def one_to_one(t):
    return J.one_to_one(t.documents.select("doc_id"), t.labels.select("doc_id", "quality"), ["doc_id"])


@query("q_both_sides", "SELECT a.p_partkey AS a, b.p_partkey AS b, a.p_name AS p_name_1, b.p_name AS p_name_2 FROM part a JOIN part b ON b.p_partkey = a.p_partkey + 1")
def both_sides(t):
    pairs = t.part.select(F.col("p_partkey").alias("a"), (F.col("p_partkey") + 1).alias("b")).join(t.part.select(F.col("p_partkey").alias("b")), "b", "left_semi")
    rows = t.part.select("p_partkey", "p_name")
    return J.both_sides(pairs, rows, rows, "a", "b", "p_partkey", ("_1", "_2"))


@query("q_mapped_family", "SELECT c_custkey, CASE WHEN n_regionkey = 0 THEN 'south' ELSE n_name END AS family FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey")
def mapped_family(t):
    nations = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    south = t.nation.filter("n_regionkey = 0").select("n_name", F.lit("south").alias("f"))
    return J.mapped_family(t.customer.select("c_custkey", "c_nationkey"), nations, south, "c_nationkey", "n_name", "f", "family").select("c_custkey", "family")


@query(
    "q_reviewed_join",
    """WITH m AS (SELECT p_name AS k, count(*) AS n, min(p_partkey) AS id FROM part WHERE p_size < 3 GROUP BY 1),
    a AS (SELECT p_name AS k, min(p_name) OVER () AS spelling FROM (SELECT DISTINCT p_name FROM part WHERE p_name LIKE 'b%'))
    SELECT p_partkey, CASE WHEN coalesce(m.n, x.n) = 1 THEN coalesce(m.id, x.id) END AS match_id, CASE WHEN coalesce(m.n, x.n) IS NULL THEN 'unmatched' WHEN coalesce(m.n, x.n) > 1 THEN 'ambiguous_name'
    WHEN m.n IS NOT NULL THEN 'normalized_name' ELSE 'reviewed_spelling_variant' END AS status
    FROM part LEFT JOIN m ON p_name = m.k LEFT JOIN a ON p_name = a.k LEFT JOIN m x ON m.n IS NULL AND a.spelling = x.k""",
)
def reviewed_join(t):
    rows = t.part.select("p_partkey", F.col("p_name").alias("k"), "p_size")
    b = rows.filter("k like 'b%'").select("k").distinct()
    aliases = b.join(b.agg(F.min("k").alias("spelling")).hint("broadcast"))
    return J.reviewed_join(rows.select("p_partkey", "k"), rows.filter("p_size < 3").select("k", F.col("p_partkey").alias("id")), aliases, "k", "id").drop("k")


@query("q_used_once", "SELECT o_orderkey, o_custkey, o_custkey IS NOT NULL AND count(*) OVER (PARTITION BY o_custkey) > 1 AS reused FROM orders")
def used_once(t):
    return J.used_once(t.orders.select("o_orderkey", "o_custkey"), "o_custkey")


@query(
    "q_aligned_join",
    """WITH a AS (SELECT l_orderkey AS k, l_returnflag AS fa, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS place, count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem),
    b AS (SELECT l_orderkey AS k, l_returnflag AS fb, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_partkey DESC, l_suppkey DESC) AS place FROM lineitem),
    j AS (SELECT k, place, fa, fb, bool_and(fa = fb) OVER (PARTITION BY k) AS ok FROM a JOIN b USING (k, place)) SELECT k, place, fa, fb FROM j WHERE ok""",
)
def aligned_join(t):
    side = lambda name: t.lineitem.select(F.col("l_orderkey").alias("k"), F.col("l_returnflag").alias(name), F.struct("l_linenumber", "l_partkey", "l_suppkey").alias("o" + name))
    return J.aligned_join(side("fa"), side("fb"), ["k"], [F.asc("ofa")], [F.desc("ofb")], "fa", "fb").select("k", "place", "fa", "fb")


@query(
    "q_repeat_classes",
    """SELECT l_partkey, count(*) AS n, string_agg(DISTINCT l_linenumber::VARCHAR, ';' ORDER BY l_linenumber::VARCHAR) AS pages, CASE WHEN count(DISTINCT (l_returnflag, l_linestatus)) = 1 THEN 'identical' ELSE 'conflict' END AS kind
    FROM lineitem GROUP BY 1 HAVING count(*) > 1""",
)
def repeat_classes(t):
    return A.repeat_classes(t.lineitem, ["l_partkey"], ["l_returnflag", "l_linestatus"], "l_linenumber")


@query(
    "q_printings_agree",
    """WITH l AS (SELECT user_id, event_type, arg_max(value > 50, event_id) AS v FROM events GROUP BY ALL)
    SELECT user_id, count(*) AS scripts, count(DISTINCT v) = 1 AND count(v) = count(*) AS agree FROM l GROUP BY 1 HAVING count(*) > 1""",
)
def printings_agree(t):
    return A.printings_agree(t.events.withColumn("v", F.col("value") > 50), ["user_id"], "event_type", "v", "event_id")


@query(
    "q_interior_steps",
    """WITH s AS (SELECT l_orderkey, (l_linenumber, l_partkey, l_suppkey) AS o, l_suppkey % 3 AS v, lag(l_suppkey % 3) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS b FROM lineitem)
    SELECT l_orderkey, coalesce(sum(greatest(v - b, 0)) FILTER (WHERE b IS NOT NULL), 0)::BIGINT AS missing_inside, coalesce(sum(greatest(b - v, 0)) FILTER (WHERE b IS NOT NULL), 0)::BIGINT AS repeated,
    coalesce(string_agg(b || '>' || v, ';' ORDER BY o) FILTER (WHERE b <> v), '') AS steps FROM s GROUP BY 1""",
)
def interior_steps(t):
    d = t.lineitem.select("l_orderkey", F.struct("l_linenumber", "l_partkey", "l_suppkey").alias("o"), (F.col("l_suppkey") % 3).alias("v"))
    return A.interior_steps(d, ["l_orderkey"], "o", "v")


@query("q_examples", "WITH d AS (SELECT p_brand, p_size, count(*) AS c, row_number() OVER (PARTITION BY p_brand ORDER BY p_size) AS i FROM part GROUP BY 1, 2) SELECT p_brand, sum(c)::BIGINT AS n, string_agg(p_size::VARCHAR, ',' ORDER BY p_size) FILTER (WHERE i <= 3) AS examples FROM d GROUP BY 1")
def examples(t):
    return A.examples(t.part, ["p_brand"], "p_size")


@query("q_subset_gaps", "SELECT DISTINCT o_custkey AS k FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)")
def subset_gaps(t):
    return U.lacking(t.orders.select(F.col("o_custkey").alias("k")), t.customer.filter("c_acctbal > 0").select(F.col("c_custkey").alias("k")), "k")


@query(
    "q_overridden",
    """SELECT doc_id, coalesce(CASE toxic WHEN 1 THEN 'toxic' END, CASE quality WHEN 1 THEN 'good' END, d.lang) AS mark,
    CASE WHEN toxic = 1 THEN 2 WHEN quality = 1 THEN 1 WHEN d.lang IS NOT NULL THEN 0 END AS source FROM documents d LEFT JOIN labels USING (doc_id)""",
)
def overridden(t):
    mark = lambda c, v: t.labels.select("doc_id", F.when(F.col(c) == 1, v).alias("mark"))
    return U.overridden("doc_id", "mark", t.documents.select("doc_id", F.col("lang").alias("mark")), mark("quality", "good"), mark("toxic", "toxic"))


@query("q_keep_origins", "SELECT doc_id, CASE WHEN quality = 1 THEN 'reviewed' ELSE source END AS source FROM documents LEFT JOIN labels USING (doc_id)")
def keep_origins(t):
    return U.keep_origins(t.documents.select("doc_id", "source"), t.labels.select("doc_id", F.when(F.col("quality") == 1, "reviewed").otherwise(" ").alias("source")), "doc_id", "source")


@query("q_won", "SELECT doc_id FROM documents LEFT JOIN labels USING (doc_id) WHERE lang IS NOT NULL AND NOT coalesce(toxic = 1, false)")
def won(t):
    return P.won(t.documents.join(t.labels, "doc_id", "left").withColumn("vacant", F.col("toxic") == 1), "lang", "vacant").select("doc_id")


@query("q_counted_on", "SELECT o_orderpriority, count(*) AS n FROM orders WHERE NOT (o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus = 'F') GROUP BY 1")
def counted_on(t):
    basis = F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "people").otherwise("seats")
    return P.counted_on(t.orders, basis, "people", F.col("o_orderstatus") == "F").groupBy("o_orderpriority").agg(F.count("*").alias("n"))


@query("q_level_rows", "SELECT doc_id FROM documents LEFT JOIN labels USING (doc_id) WHERE lang = 'en' AND quality IS NULL")
def level_rows(t):
    return P.having(t.documents.join(t.labels, "doc_id", "left"), lang="en", quality=None).select("doc_id")


@query(
    "q_outside_domains",
    """SELECT 'o_orderstatus' AS "column", o_orderstatus AS value, count(*) AS n FROM orders WHERE o_orderstatus NOT IN ('F', 'O') GROUP BY 2
    UNION ALL SELECT 'o_orderpriority', o_orderpriority, count(*) FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM') GROUP BY 2""",
)
def outside_domains(t):
    return P.outside_domains(t.orders, {"o_orderstatus": ["F", "O"], "o_orderpriority": ["1-URGENT", "2-HIGH", "3-MEDIUM"]})


@query("q_only_words_of", "SELECT p_partkey FROM part WHERE regexp_full_match(p_name, '(small|large|widget|bolt)( (small|large|widget|bolt))*')")
def only_words_of(t):
    return t.part.filter(P.only_words_of(F.col("p_name"), ["small", "large", "widget", "bolt"])).select("p_partkey")


@query("q_without_confirmed", "SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND toxic = 1)")
def without_confirmed(t):
    return P.without(t.documents.select("doc_id"), t.labels.filter("toxic = 1"), ["doc_id"])


@query(
    "q_bare_labels",
    """WITH d AS (SELECT doc_id, lang, quality, toxic, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS ordinal FROM documents LEFT JOIN labels USING (doc_id))
    SELECT doc_id, ordinal FROM d WHERE lang IS NULL OR quality IS NOT NULL OR toxic IS NOT NULL""",
)
def bare_labels(t):
    d = t.documents.select("doc_id", "lang", "source").join(t.labels, "doc_id", "left")
    return P.without_bare_labels(d, ["source"], ["doc_id"], "lang", ["quality", "toxic"]).select("doc_id", "ordinal")


@query("q_numeric_order", "SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY coalesce(try_cast(left(o_orderpriority, 1) AS BIGINT), 0), o_orderkey) AS place FROM orders")
def numeric_order(t):
    d = t.orders.withColumn("p", F.substring("o_orderpriority", 1, 1))
    return d.select("o_orderkey", F.row_number().over(Window.partitionBy("o_custkey").orderBy(*W.numeric_order("p"), "o_orderkey")).alias("place"))


@query("q_distinct_in_order", "SELECT user_id, event_type, min(event_id) AS event_id FROM events GROUP BY 1, 2")
def distinct_in_order(t):
    return W.distinct_in_order(t.events, ["user_id"], "event_type", "event_id")


@query(
    "q_page_candidates",
    """WITH l AS (SELECT user_id, date_trunc('day', ts)::DATE - DATE '2024-01-01' AS d, event_id, CASE WHEN event_type <> 'view' THEN event_type END AS v FROM events),
    m AS (SELECT user_id, d + 1 AS d, arg_max(v, event_id) AS candidate FROM l WHERE v IS NOT NULL GROUP BY ALL) SELECT event_id, candidate FROM l LEFT JOIN m USING (user_id, d)""",
)
def page_candidates(t):
    d = t.events.select("user_id", F.date_diff(F.to_date("ts"), F.lit("2024-01-01").cast("date")).alias("d"), "event_id", F.when(F.col("event_type") != "view", F.col("event_type")).alias("v"))
    return W.page_candidates(d, ["user_id"], "d", ["event_id"], "v", "candidate").select("event_id", "candidate")


@query("q_logit_clip", "WITH d AS (SELECT doc_id, least(greatest(coalesce(toxic * 1.0, .5), 1e-4), 1 - 1e-4) AS q FROM documents LEFT JOIN labels USING (doc_id)) SELECT doc_id, round(ln(q / (1 - q)), 6) AS z FROM d")
def logit_clip(t):
    return t.documents.select("doc_id").join(t.labels, "doc_id", "left").select("doc_id", F.round(X.logit(F.col("toxic").cast("double")), 6).alias("z"))


@query(
    "q_quality_report",
    """SELECT 'labelled' AS "check", false AS hard, count(quality) >= .97 * count(*) AS ok, count(quality) || ' of ' || count(*) AS detail FROM documents LEFT JOIN labels USING (doc_id)
    UNION ALL SELECT 'no blank text', true, count_if(trim(text) = '') = 0, count_if(trim(text) = '')::VARCHAR FROM documents UNION ALL SELECT 'nations', true, count(*) = 25, count(*) || ' of 25' FROM nation""",
)
def quality_report(t):
    from ledgerloom.operators import quality as Q

    blank = F.count_if(F.trim("text") == "")
    d = t.documents.join(t.labels, "doc_id", "left")
    checks = Q.report(d, [Q.at_least("labelled", F.count("quality"), F.count("*"), 0.97), ("no blank text", True, blank == 0, blank)])
    return checks.unionAll(Q.cardinalities({"nations": (t.nation, 25)}))


# --- markup by depth, printed layouts, gates, review rules, rates, attempts -------------------------------------


@query(
    "q_nested_tables",
    """WITH o AS (SELECT o_custkey AS page, o_orderkey, o_orderpriority, o_orderstatus, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS k FROM orders)
    SELECT DISTINCT page, 1 AS "table", 1 AS depth, 0 AS "row", x AS "column", 'th' AS tag, CASE WHEN x = 1 THEN 'wide' END AS class, CASE WHEN x = 0 THEN 'order & key' ELSE 'state' END AS text FROM o, (SELECT unnest([0, 1]) AS x)
    UNION ALL SELECT page, 1, 1, k, 0, 'td', 'k', o_orderkey::VARCHAR FROM o
    UNION ALL SELECT page, 1, 1, k, 1, 'td', NULL, o_orderpriority || ' end' FROM o
    UNION ALL SELECT page, k + 1, 2, 0, 0, 'td', NULL, o_orderstatus FROM o""",
)
def nested_tables(t):
    """Every order as a row of its customer's page, with a table within a cell, read back by depth."""
    from ledgerloom.sources.markup import table_cells

    line = F.concat(F.lit("<tr><td class='k'>"), F.col("o_orderkey"), F.lit("</td>\n<td>"), F.col("o_orderpriority"), F.lit("<table><tr><td>"), F.col("o_orderstatus"), F.lit("</td></tr></table> end</td></tr>"))
    pages = t.orders.groupBy(F.col("o_custkey").alias("page")).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("o_orderkey", line.alias("h")))), lambda x: x["h"]), "\n").alias("_rows"))
    html = F.concat(F.lit("<p>no table</p><!-- <table> --><table><tr><th>order &amp; key</th><th colspan=2 CLASS=wide>state</th></tr>"), F.col("_rows"), F.lit("</table>"))
    cells = table_cells(pages.select("page", html.alias("html")), "html", ["page"])
    return cells.select("page", "table", "depth", "row", "column", "tag", F.col("attrs")["class"].alias("class"), "text")


@query(
    "q_region_links",
    """WITH l AS (SELECT page_id, url AS base, unnest(regexp_extract_all(html, '(?s)<a href="([^"]*)">[^<]*</a>', 1)) AS href, unnest(regexp_extract_all(html, '(?s)<a href="[^"]*">([^<]*)</a>', 1)) AS label FROM pages)
    SELECT page_id, href, regexp_extract(base, '^[a-z]+://[^/?#]*') || href AS url, trim(label) AS label, '' AS heading, count(*) AS n FROM l WHERE href <> '' AND href[1] = '/' GROUP BY ALL""",
)
def region_links(t):
    from ledgerloom.sources.markup import region_links as read

    return read(t.pages, "html", "url", ["page_id"], "body", "article").groupBy("page_id", "href", "url", "label", "heading").agg(F.count("*").alias("n"))


@query(
    "q_layout_rows",
    """WITH o AS (SELECT o_custkey AS file, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS serial, trim(regexp_replace(o_orderpriority, '[^A-Z]+', ' ', 'g')) || CASE WHEN o_orderstatus = 'P' THEN ' Pending' ELSE '' END AS label,
        floor(o_totalprice) AS price, day(o_orderdate)::DOUBLE AS day FROM orders)
    SELECT file, 'item' AS level, 'CUSTOMER ' || file AS heading, serial::INT AS serial, label, price, day FROM o
    UNION ALL SELECT file, 'group', 'CUSTOMER ' || file, NULL, 'TOTAL', sum(price), sum(day) FROM o GROUP BY file
    UNION ALL SELECT file, 'all', NULL, NULL, 'OF ALL', count(*), max(day) FROM o GROUP BY file""",
)
def layout_rows(t):
    """Every order as a printed line of its customer's sheet, with labels that go on, totals and a grand total, read back."""
    from ledgerloom.operators.layout import Layout
    from ledgerloom.operators.layout import layout_rows as read

    o = t.orders.select(F.col("o_custkey").alias("file"), "o_orderkey", F.trim(F.regexp_replace("o_orderpriority", "[^A-Z]+", " ")).alias("label"), (F.col("o_orderstatus") == "P").alias("more"), F.floor("o_totalprice").alias("price"), F.dayofmonth("o_orderdate").alias("day"))
    f = o.groupBy("file").agg(F.sort_array(F.collect_list(F.struct("o_orderkey", "label", "more", "price", "day"))).alias("x"), F.sum("price").alias("price"), F.sum("day").alias("day"), F.count("*").alias("n"), F.max("day").alias("most"))
    line = F.transform("x", lambda r, i: F.concat(F.lit("  "), (i + 1).cast("string"), F.lit(". "), F.rpad(r["label"], 20, " "), F.lpad(r["price"].cast("string"), 12, " "), F.lpad(r["day"].cast("string"), 6, " "), F.when(r["more"], "\n     Pending").otherwise("")))
    text = F.concat(F.lit("A SHEET\n  NAME   PRICE  DAY\nCUSTOMER "), F.col("file"), F.lit("\n"), F.array_join(line, "\n"), F.lit("\n  TOTAL   "), F.col("price"), F.lit("  "), F.col("day"), F.lit("\n GRAND\n OF ALL   "), F.col("n"), F.lit("  "), F.col("most"))
    rows = read(f.select("file", text.alias("text")), "file", "text", Layout(["price", "day"], r"CUSTOMER \d+", r"NAME\s+PRICE\s+DAY"))
    return rows.select("file", "level", "heading", "serial", "label", F.col("cells")[0]["value"].alias("price"), F.col("cells")[1]["value"].alias("day"))


@query(
    "q_gates",
    """WITH p AS (SELECT l_linestatus AS run, l_orderkey AS g, count(*) AS n, count(*) FILTER (WHERE l_returnflag = 'R') AS r, count(*) FILTER (WHERE l_discount = 0) AS free,
        count(*) FILTER (WHERE l_quantity > 49) AS many, count(DISTINCT l_linenumber) AS d, max(l_linenumber) AS m FROM lineitem GROUP BY 1, 2),
    q AS (SELECT p.*, o_orderpriority = '5-LOW' AS excused, abs(100.0 * r / n - 25) > 30 AS off FROM p JOIN orders ON g = o_orderkey),
    s AS (SELECT run, count(*) AS gs, sum(n) AS n, sum(r) AS r, sum(free) AS free, sum(many) AS many, count(*) FILTER (WHERE off AND NOT excused) AS off, count(*) FILTER (WHERE d <> m OR n <> d) AS gaps FROM q GROUP BY run),
    o AS (SELECT 'F' AS run, 2 * count(*) AS lines, 'elected' AS basis, count(*) AS orders FROM orders UNION ALL SELECT 'O', 2 * count(*), 'seats', NULL FROM orders)
    SELECT run, 'lines' AS "check", false AS hard, n - CASE WHEN basis = 'elected' THEN r ELSE 0 END >= 0.97 * lines AS ok, (n - CASE WHEN basis = 'elected' THEN r ELSE 0 END)::DOUBLE AS found, lines::DOUBLE AS wanted FROM s JOIN o USING (run)
    UNION ALL SELECT run, 'orders', true, coalesce(abs(gs - orders) <= 2, true), gs, orders FROM s JOIN o USING (run)
    UNION ALL SELECT run, 'free lines', true, free <= 10, free, 10 FROM s
    UNION ALL SELECT run, 'returned', true, abs(100.0 * r / n - 25) <= 3, round(100.0 * r / n, 4), 25 FROM s
    UNION ALL SELECT run, 'many', true, 100.0 * many / n < 5, round(100.0 * many / n, 4), 5 FROM s
    UNION ALL SELECT run, 'returned by order', true, off <= 0.2 * gs, off, round(0.2 * gs, 4) FROM s
    UNION ALL SELECT run, 'numbers', false, gaps = 0, gaps, 0 FROM s""",
)
def gates(t):
    from ledgerloom.operators import gates as G

    rows = t.lineitem.select(F.col("l_linestatus").alias("run"), "l_orderkey", "l_linenumber", "l_returnflag", "l_discount", "l_quantity")
    n = t.orders.agg(F.count("*").alias("n"))
    official = n.select(F.explode(F.array(F.struct(F.lit("F").alias("run"), (2 * F.col("n")).alias("lines"), F.lit("elected").alias("basis"), F.col("n").alias("orders")), F.struct(F.lit("O").alias("run"), (2 * F.col("n")).alias("lines"), F.lit("seats").alias("basis"), F.lit(None).cast("long").alias("orders")))).alias("o")).select("o.*")
    excused = t.orders.filter("o_orderpriority = '5-LOW'").select(F.explode(F.array(F.lit("F"), F.lit("O"))).alias("run"), F.col("o_orderkey").alias("l_orderkey"))
    back = F.col("l_returnflag") == "R"
    checks = [
        G.Coverage("lines", False, F.lit(True), "lines", 0.97, "basis", back),
        G.GroupCount("orders", True, "orders", 2),
        G.AtMost("free lines", True, F.col("l_discount") == 0, 10),
        G.Share("returned", True, back, F.lit(True), 25.0, "near", 3.0),
        G.Share("many", True, F.col("l_quantity") > 49, F.lit(True), 5.0, "below"),
        G.GroupsOff("returned by order", True, back, F.lit(True), 25.0, 30.0, 0.2),
        G.Numbered("numbers", False, "l_linenumber"),
    ]
    return G.evaluate(rows, checks, ["run"], ["l_orderkey"], official, excused)


@query(
    "q_review_rules",
    """SELECT o_orderkey, concat_ws(';', CASE WHEN o_orderkey % 3 = 0 THEN 'coordinates' END, CASE WHEN o_orderpriority = '3-MEDIUM' AND o_orderstatus <> 'O' THEN 'state unknown' END,
        CASE WHEN o_orderstatus = 'P' OR o_custkey % 11 = 0 THEN 'state differs' END, CASE WHEN o_custkey % 13 = 0 THEN 'digest' END, CASE WHEN o_totalprice > 400000 THEN 'dear' END, CASE WHEN o_custkey % 5 = 0 THEN 'guard differs' END) AS violations
    FROM orders WHERE o_orderkey % 3 = 0 OR o_orderpriority = '3-MEDIUM' AND o_orderstatus <> 'O' OR o_orderstatus = 'P' OR o_custkey % 11 = 0 OR o_custkey % 13 = 0 OR o_totalprice > 400000 OR o_custkey % 5 = 0""",
)
def review_rules(t):
    from ledgerloom.operators import review_rules as R

    rows = t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice")
    on = lambda k: F.pmod("o_custkey", F.lit(k)) == 0
    reviews = t.orders.select(
        "o_orderkey",
        F.when(F.pmod("o_orderkey", F.lit(3)) == 0, "x").otherwise(F.concat_ws(",", "o_custkey", "o_orderkey")).alias("at"),
        F.col("o_orderstatus").alias("state"),
        ((F.col("o_orderstatus") == "F") != on(11)).alias("closed"),
        F.col("o_orderpriority").alias("evidence"),
        F.when(on(13), "bad").otherwise(F.sha2("o_orderpriority", 256)).alias("sha"),
        F.when(on(5), F.lower("o_orderpriority")).otherwise(F.col("o_orderpriority")).alias("seen_o_orderpriority"),
    )
    rules = [
        R.Pattern("coordinates", "at", r"\d+,\d+"),
        R.OneOf("state unknown", "state", ["O"], when=F.col("evidence") == "3-MEDIUM"),
        R.Literal("state differs", "state", {"F": {"closed": True}, "O": {"closed": False}}),
        R.Digest("digest", "sha", "evidence"),
        R.Holds("dear", F.col("row_o_totalprice") <= 400000),
        R.Agrees("guard differs", ["o_orderpriority"]),
    ]
    return R.check_reviews(rows, reviews, ["o_orderkey"], rules).filter(F.size("violations") > 0).select("o_orderkey", F.array_join("violations", ";").alias("violations"))


@query(
    "q_smoothed_rates",
    """WITH c AS (SELECT o_custkey, o_orderkey % 5 AS fold, count(*) AS n, count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS h FROM orders GROUP BY 1, 2),
    f AS (SELECT fold, sum(n) AS n, sum(h) AS h FROM c GROUP BY fold), p AS (SELECT fold, ((SELECT sum(h) FROM f) - h)::DOUBLE / ((SELECT sum(n) FROM f) - n) AS prior FROM f),
    g AS (SELECT o_custkey, sum(n) AS n, sum(h) AS h FROM c GROUP BY 1)
    SELECT c.o_custkey, c.fold, (g.n - c.n)::BIGINT AS n, CASE WHEN g.n - c.n >= 3 THEN round((g.h - c.h + 20 * prior) / (g.n - c.n + 20), 6) END AS rate FROM c JOIN g USING (o_custkey) JOIN p USING (fold)""",
)
def smoothed_rates(t):
    from ledgerloom.operators.inference import smoothed_rates as rates

    d = t.orders.select("o_custkey", F.pmod("o_orderkey", F.lit(5)).alias("fold"), (F.col("o_orderpriority") == "1-URGENT").alias("urgent"))
    return rates(d, "o_custkey", "fold", F.col("urgent")).withColumn("rate", F.round("rate", 6))


@query(
    "q_last_attempts",
    """SELECT user_id, ts, event_id, event_type, value, props, n AS readings FROM (SELECT *, count(*) OVER (PARTITION BY user_id) AS n,
        row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM events) WHERE k = 1""",
)
def last_attempts(t):
    """Each user's last event and the number of all, by a stream that keeps state by user and writes what changed."""
    import uuid

    from ledgerloom.operators.state import shared_folder
    from ledgerloom.streaming.attempts import current, run_attempts

    root = f"{shared_folder(t.spark).rstrip('/')}/attempts-{uuid.uuid4().hex}"
    run_attempts(t.spark, f"{t.sf_dir}/event[s].parquet", t.events.schema, ["user_id"], ["ts", "event_id"], f"{root}/state", f"{root}/out")
    return current(t.spark, f"{root}/out", ["user_id"])


@query(
    "q_canonical_sources",
    """WITH d AS (SELECT doc_id, source, lang, sha256(coalesce(text, '')) AS digest FROM documents),
    g AS (SELECT digest, min(doc_id) AS first, max(doc_id) AS last, count(DISTINCT concat_ws('|', coalesce(source, '~'), coalesce(lang, '~'))) AS ids FROM d GROUP BY digest),
    r AS (SELECT digest, last FROM g WHERE ids > 1 AND last % 2 = 0)
    SELECT d.doc_id, CASE WHEN ids = 1 THEN first WHEN r.digest IS NOT NULL THEN r.last END AS canonical, CASE WHEN ids = 1 THEN d.doc_id = first WHEN r.digest IS NOT NULL THEN d.doc_id = r.last END AS is_canonical,
        CASE WHEN ids > 1 AND r.digest IS NULL THEN 'needs a review' END AS problem FROM d JOIN g USING (digest) LEFT JOIN r USING (digest)""",
)
def canonical_sources(t):
    """Documents of equal text: the first stands for them, or the one that a review (here: for even last ids) names."""
    from ledgerloom.operators.sources import canonical_sources as choose

    d = t.documents.select("doc_id", "source", "lang", F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest"))
    reviews = d.groupBy("digest").agg(F.max("doc_id").alias("doc_id")).filter("doc_id % 2 = 0")
    return choose(d, "digest", ["source", "lang"], "doc_id", reviews, ["doc_id"]).select("doc_id", "canonical", "is_canonical", "problem")


@query(
    "q_positional_scores",
    """WITH l AS (SELECT l_orderkey, l_returnflag, l_linestatus, floor(l_quantity) AS q, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS i FROM lineitem),
    p AS (SELECT l_orderkey, l_returnflag, CASE WHEN l_tax = 0 THEN 'X' ELSE l_linestatus END AS l_linestatus, floor(l_quantity) AS q, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS i FROM lineitem WHERE l_quantity > 2),
    m AS (SELECT coalesce(l.l_orderkey, p.l_orderkey) AS l_orderkey, l.i AS li, p.i AS pi, coalesce(l.l_returnflag = p.l_returnflag, false) AS a, coalesce(l.l_linestatus = p.l_linestatus, false) AS b, coalesce(l.q = p.q, false) AND l.q > 10 AS c, l.q > 10 AS d FROM l FULL JOIN p ON l.l_orderkey = p.l_orderkey AND l.i = p.i),
    s AS (SELECT l_orderkey, count(li) AS expected_rows, count(pi) AS predicted_rows, count(*) FILTER (WHERE a) AS a, count(*) FILTER (WHERE b) AS b, count(*) FILTER (WHERE c) AS c, count(*) FILTER (WHERE d) AS d, count(*) FILTER (WHERE a AND b) AS e FROM m GROUP BY 1)
    SELECT l_orderkey, expected_rows, predicted_rows, CASE WHEN expected_rows = predicted_rows THEN 'scored' ELSE 'row_count_mismatch' END AS status, CASE WHEN expected_rows = predicted_rows THEN a END AS correct_l_returnflag,
        CASE WHEN expected_rows = predicted_rows THEN b END AS correct_l_linestatus, CASE WHEN expected_rows = predicted_rows THEN c END AS correct_q, CASE WHEN expected_rows = predicted_rows THEN e END AS correct_all, CASE WHEN expected_rows = predicted_rows THEN d END AS checked_q FROM s""",
)
def positional_scores(t):
    """Lines of each order read without those of small quantity, and with some states misread, against all lines."""
    from ledgerloom.operators.sources import positional_scores as score

    own = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", F.floor("l_quantity").alias("q")]
    read = t.lineitem.filter("l_quantity > 2").withColumn("l_linestatus", F.when(F.col("l_tax") == 0, "X").otherwise(F.col("l_linestatus")))
    return score(read.select(*own), t.lineitem.select(*own), ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey"], ["l_returnflag", "l_linestatus", "q"], {"q": F.col("label_q") > 10})


@query(
    "q_overlap_shares",
    ORACLES["q_block_overlap"].replace("CASE WHEN shared >= 5", "round_even(shared / j.n, 3) AS share_of_b, CASE WHEN shared >= 5"),
)
def overlap_shares(t):
    from ledgerloom.operators.linkage import overlap_proposals

    sets = t.lineitem.select("l_suppkey", "l_partkey").join(t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
    return overlap_proposals(J.set_overlap(sets, ["s_nationkey"], "l_suppkey", "l_partkey"))


@query(
    "q_office_tiers",
    """WITH o AS (SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN ' *Panch. ' WHEN '2-HIGH' THEN 'Sarpancn' WHEN '3-MEDIUM' THEN 'सरपंच' WHEN '5-LOW' THEN NULL ELSE 'Clerk' END AS raw, CASE o_orderstatus WHEN 'F' THEN 'block_member' ELSE 'gp' END AS family FROM orders)
    SELECT o_orderkey, CASE raw WHEN ' *Panch. ' THEN 'PANCH' WHEN 'Sarpancn' THEN 'SARPANCH' WHEN 'Clerk' THEN 'CLERK' ELSE coalesce(raw, '') END AS office,
        CASE WHEN raw = ' *Panch. ' THEN 'gp_ward' WHEN raw IN ('Sarpancn', 'सरपंच') THEN 'gp_head' WHEN raw IS NULL AND family = 'block_member' THEN 'block_member' END AS tier FROM o""",
)
def office_tiers(t):
    p = F.col("o_orderpriority")
    d = t.orders.select("o_orderkey", F.when(p == "1-URGENT", " *Panch. ").when(p == "2-HIGH", "Sarpancn").when(p == "3-MEDIUM", "सरपंच").when(p != "5-LOW", "Clerk").alias("raw"), F.when(F.col("o_orderstatus") == "F", "block_member").otherwise("gp").alias("family"))
    return d.select("o_orderkey", X.normalized_office(F.col("raw")).alias("office"), X.office_tier(F.col("raw"), F.col("family")).alias("tier"))


@query(
    "q_changed_rows",
    """SELECT o_orderkey, o_custkey, o_totalprice, 'removed' AS change, 1 AS copies FROM orders WHERE o_totalprice > 490000
    UNION ALL SELECT o_orderkey, o_custkey, -1.0, 'added', 1 FROM orders WHERE o_totalprice > 490000""",
)
def changed_rows(t):
    """A published table of orders against a rebuild that lost the prices of dear ones: parts with equal digests aren't read."""
    import uuid

    from ledgerloom.operators import digests
    from ledgerloom.operators.state import shared_folder

    path = f"{shared_folder(t.spark).rstrip('/')}/published-{uuid.uuid4().hex}"
    old = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    digests.publish(old, path, ["o_orderkey"])
    new = old.withColumn("o_totalprice", F.when(F.col("o_totalprice") > 490000, -1.0).otherwise(F.col("o_totalprice")))
    return digests.changed_rows(new, path, ["o_orderkey"]).withColumn("copies", F.col("copies").cast("int"))


@query("q_folded_names", f"SELECT DISTINCT name, {_sql_fold('name')} AS folded FROM (SELECT p_name AS name FROM part UNION ALL SELECT n_name FROM nation UNION ALL SELECT c_mktsegment FROM customer)")
def folded_names(t):
    names = t.part.select(F.col("p_name").alias("name")).unionAll(t.nation.select("n_name")).unionAll(t.customer.select("c_mktsegment")).distinct()
    return names.select("name", X.fold(F.col("name")).alias("folded"))
