"""Token-ID output: Parquet files of token id lists that can be read selectively.

A file holds `doc_id`, `n_tokens`, `local_start` (ids of the file's documents before it), `part` (its place in the
order of files) and `ids`. Ids are dictionary-encoded, the whole numbers delta-encoded (format 2), row groups and
pages are small enough that page indexes lead to single documents, and metadata can be read without the ids.
Files are in ascending doc_id order, within and between them.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import ready, scratch, stash, text_of
from .tokens import encoder, text_slices

SCHEMA = "doc_id long, n_tokens long, local_start long, part int, ids array<int>"
#: Parquet settings of the files: row groups of 32 MB, pages of 256 KB and at most 2,000 rows with an index entry each.
WRITE = {
    "compression": "zstd",
    "parquet.writer.version": "v2",
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "2000",
    "parquet.dictionary.page.size": str(1 << 20),
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#n_tokens": "false",
    "parquet.enable.dictionary#local_start": "false",
}


def token_lists(docs: DataFrame, tokenizer: str, end_id: int | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of SCHEMA in ascending order of id (ties: hash of the text, then the text).

    Texts are dealt out by ranges of (id, hash), so that even one id on a third of all rows spreads out.
    Null text: empty. Null ids come first. Repeated rows stay.
    """
    ready(docs.sparkSession)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc, part, start = encoder(tokenizer), TaskContext.get().partitionId(), 0
        for rows in text_slices(batches, "_text"):
            ids, at = enc.encode(rows.column("_text"))
            if end_id is not None:
                ids, at = np.insert(ids, at[1:], end_id), at + np.arange(len(at))
            n = np.diff(at)
            lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids.view("<i4")))
            yield pa.RecordBatch.from_arrays(
                [rows.column("_id"), pa.array(n, pa.int64()), pa.array(start + at[:-1], pa.int64()), pa.array(np.full(len(n), part, dtype=np.int32)), lists],
                names=["doc_id", "n_tokens", "local_start", "part", "ids"],
            )
            start += int(at[-1])

    keyed = docs.select(F.col(f"`{id_col}`").cast("long").alias("_id"), text_of(text_col).alias("_text")).withColumn("_h", F.xxhash64("_text"))
    dealt = keyed.repartitionByRange("_id", "_h").sortWithinPartitions("_id", "_h", "_text")
    return dealt.select("_id", "_text").mapInArrow(encode, SCHEMA)


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int | None = None, **columns: str) -> None:
    """Writes the token files of docs below path. An empty table gives files without rows."""
    token_lists(docs, tokenizer, end_id, **columns).write.options(**WRITE).parquet(path)


def read_metadata(spark, path: str) -> DataFrame:
    """`doc_id, start, n_tokens, part`: reads no ids. One small row a file is summed up to place the files."""
    files = spark.read.schema(SCHEMA).parquet(path)
    return _placed(files, files).select("doc_id", "start", "n_tokens", "part")


def read_tokens(spark, path: str) -> DataFrame:
    """`doc_id, start, n_tokens, part, ids`; filters on doc_id reach the row groups and page indexes."""
    files = spark.read.schema(SCHEMA).parquet(path)
    return _placed(files, files).select("doc_id", "start", "n_tokens", "part", "ids")


def _placed(rows: DataFrame, files: DataFrame) -> DataFrame:
    sums = files.groupBy(F.col("part").alias("_part")).agg(F.sum("n_tokens").alias("_n"))
    base = stash(sums.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_base")), "places")  # its size is known when the join is planned
    return rows.join(base, F.col("part") == F.col("_part")).withColumn("start", F.col("_base") + F.col("local_start"))


def crc_of_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """`doc_id, start, n_tokens, ids` to `doc_id, start, n_tokens, ids_crc32`; the ids are never turned into Python objects."""
    for batch in batches:
        ids = batch.column("ids")
        at = np.asarray(ids.offsets)
        raw = memoryview(np.ascontiguousarray(np.asarray(ids.values), dtype="<i4")).cast("B")
        sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(at[:-1], at[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("start"), batch.column("n_tokens"), pa.array(sums, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = scratch(spark, "token-ids")
    write_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    found = read_tokens(spark, path).select("doc_id", "start", "n_tokens", "ids")
    return found.mapInArrow(crc_of_lists, "doc_id long, start long, n_tokens long, ids_crc32 long")
