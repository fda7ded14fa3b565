"""Line dedup: lines that many documents share are kept in one of them only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WS_CHARS, ascii_lower, lines_of, stash, text_of


def line_key(line: Column) -> Column:
    """What two lines must share to count as the same: stripped of ASCII white space, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(WS_CHARS)))


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """Positions of the lines to drop: `_id, _sum, drops array<int>`, a row for each document that loses any.

    Only 128-bit digests of long lines travel: once counted over distinct documents (partial counts before
    the shuffle), once to be told the verdict. The join leaves a hot line to adaptive skew splitting.
    """
    lines = docs.select(F.col(f"`{id_col}`").alias("_id"), F.xxhash64(text_of(text_col)).alias("_sum"), F.posexplode(lines_of(text_of(text_col))).alias("_pos", "_line"))
    keyed = lines.select("_id", "_sum", "_pos", line_key(F.col("_line")).alias("_key")).filter(F.char_length("_key") >= min_chars)
    keyed = stash(keyed.select("_id", "_sum", "_pos", F.unhex(F.md5("_key")).alias("_h")), "lines")
    shared = keyed.groupBy("_h").agg(F.countDistinct("_id").alias("_n"), F.max("_id").alias("_last")).filter(F.col("_n") >= min_docs)
    shared = stash(shared.select("_h", "_last"), "shared")
    doomed = keyed.join(shared, "_h").filter(~F.col("_id").eqNullSafe(F.col("_last")))
    return doomed.groupBy("_id", "_sum").agg(F.collect_set("_pos").alias("drops"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """Drops lines found in at least min_docs documents, except in the largest id that holds them.

    Returns `row` (the whole input row as a struct, so that no column name can clash), `kept` (the text of the
    remaining lines), `n_lines` and `n_dropped`; one row for each input row.

    Null or empty text: one empty line, which is never dropped. Rows with a null id keep all their lines unless
    a document with an id holds them too; they don't count as documents. Repeated rows share one id and so count
    once and keep or lose the same lines. An empty table gives an empty result.
    """
    drops = repeated_lines(docs, id_col, text_col, min_chars, min_docs)
    base = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{id_col}`").alias("_key"), text_of(text_col).alias("_text"))
    base = base.withColumn("_own", F.xxhash64("_text"))
    joined = base.join(drops, F.col("_key").eqNullSafe(F.col("_id")) & (F.col("_own") == F.col("_sum")), "left")
    cut = joined.select("row", "_text", lines_of(F.col("_text")).alias("_lines"), "drops")
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("drops")), lambda i: F.get(F.col("_lines"), i))
    return cut.select(
        "row",
        F.when(F.col("drops").isNull(), F.col("_text")).otherwise(F.array_join(kept, "\n")).alias("kept"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("drops"), F.lit(0)).cast("long").alias("n_dropped"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    out = dedup_lines(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return out.select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped", F.sha2(F.col("kept"), 256).alias("kept_sha256"))


ORACLE = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
  FROM documents),
k AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (
  SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
j AS (
  SELECT k.doc_id, k.pos, k.line, (c.key IS NOT NULL AND c.last <> k.doc_id) AS gone
  FROM k LEFT JOIN c ON k.key = c.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""
