"""Corpus pipeline: quality rules, line dedup, near-duplicate documents, repeated passages, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each as Parquet in the shared folder
and reads it again for the next. All but the last return the columns of documents, with n_chars of the new text.
A text that loses all its lines or words stays as an empty document. Import errors are not hidden here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import chosen_path, line_dedup, packing, quality_rules, substring_dedup
from ledgerloom.llm.common import stash


def _columns(rows: DataFrame, text: str, like: DataFrame) -> DataFrame:
    """The columns of like from a struct `row`, with a new text and its length."""
    new = {"text": F.col(text), "n_chars": F.char_length(text).cast("long")}
    return rows.select(*[new[c].alias(c) if c in new else F.col("row").getField(c).alias(c) for c in like.columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents that the rules reject go."""
    return quality_rules.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: lines that many documents share stay in one of them."""
    return _columns(line_dedup.dedup_lines(docs), "kept", docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: one document of each class of near duplicates stays."""
    return chosen_path.keep_one(docs)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: words of passages found earlier go."""
    return _columns(substring_dedup.dedup_substrings(docs), "kept", docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: all documents as pieces of sequences of at most 2048 tokens."""
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality rules", quality), ("line dedup", lines), ("n-gram Jaccard join", near_duplicates), ("substring dedup", passages), ("best-fit packing", sequences)]

#: Packing isn't expressible in SQL; the pipeline is tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stash(docs, f"stage{i + 1}")
    return docs
