"""Best-fit packing: documents as token sequences of bounded length, as few of them as bin completion finds.

Tokens are counted in Arrow batches; only the histogram of piece lengths (at most `capacity` rows) reaches the
driver, where bin completion plans patterns of lengths. Pieces are then numbered within their length, without
gathering a length in one task, and the number leads to a sequence and an offset.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .bin_completion import Pattern, pack_counts
from .common import ready, stash, text_of
from .tokens import encoder, text_slices

#: Pieces of one length in one counting cell, about.
CELL = 250
#: Cells of one length that are summed up together: a hot length of 10^10 pieces has 10^4 blocks.
CELLS = 4096


def cut_lengths(n: int, capacity: int) -> list[int]:
    """Lengths of the pieces of n tokens: whole ones, and first what is left over."""
    return [n] if n <= capacity else [*([n % capacity] if n % capacity else []), *[capacity] * (n // capacity)]


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = 2048, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """`doc_id, piece, start, length, ids_crc32` [and `ids`] for every piece of every document. Null text: empty."""
    ready(docs.sparkSession)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for rows in text_slices(batches, "_text"):
            ids, at = enc.encode(rows.column("_text"))
            ids, at = np.insert(ids, at[1:], end_id), (at + np.arange(len(at))).tolist()
            raw = memoryview(np.ascontiguousarray(ids, dtype="<u4")).cast("B")
            out: dict[str, list] = {n: [] for n in ("doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else []))}
            for key, a, b in zip(rows.column("_id").to_pylist(), at[:-1], at[1:], strict=True):
                start = 0
                for i, n in enumerate(cut_lengths(b - a, capacity)):
                    for name, value in (("doc_id", key), ("piece", i), ("start", start), ("length", n), ("ids_crc32", zlib.crc32(raw[4 * (a + start) : 4 * (a + start + n)]))):
                        out[name].append(value)
                    if with_ids:
                        out["ids"].append(ids[a + start : a + start + n].view("<i4"))
                    start += n
            kinds = {"piece": pa.int32(), "ids": pa.list_(pa.int32())}
            yield pa.RecordBatch.from_arrays([pa.array(v, kinds.get(k, pa.int64())) for k, v in out.items()], names=list(out))

    keyed = docs.select(F.col(f"`{id_col}`").cast("long").alias("_id"), text_of(text_col).alias("_text"))
    return keyed.mapInArrow(encode, "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else ""))


class Places:
    """From the number of a piece within its length to its sequence and offset, for the patterns of a plan."""

    def __init__(self, patterns: list[Pattern]):
        seen: dict[int, int] = defaultdict(int)
        rows, sequence = [], 0
        for pattern, times in patterns:
            offset = 0
            for n in dict.fromkeys(pattern):
                each = pattern.count(n)
                rows.append((n, seen[n], sequence, each, offset))
                seen[n] += each * times
                offset += n * each
            sequence += times
        rows.sort()
        self.length, self.first, self.sequence, self.each, self.offset = np.array(rows, dtype=np.int64).reshape(-1, 5).T.copy()
        self.sequences = sequence

    def __call__(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.empty(len(length), dtype=np.int64)
        for n in np.unique(length):  # within a length the segments are in order of their first number
            lo, hi = np.searchsorted(self.length, [n, n + 1])
            mine = length == n
            at[mine] = lo + np.searchsorted(self.first[lo:hi], number[mine], side="right") - 1
        k = number - self.first[at]
        return self.sequence[at] + k // self.each[at], self.offset[at] + (k % self.each[at]) * length


def number_within(pieces: DataFrame, key: str, counts: dict[int, int]) -> DataFrame:
    """Adds `_number`, 0 and up without gaps within each value of key (whole numbers from 0, counted in counts).

    A value has as many cells, told by a hash, as its count needs. Counts of cells are summed up in blocks, then those of
    blocks, so neither a hot value nor the whole table meets in one task. Equal rows may swap numbers, which changes nothing.
    """
    cells = F.get(F.lit([max(1, counts.get(n, 0) // CELL) for n in range(max(counts, default=0) + 1)]), F.col(key).cast("int"))
    own = pieces.withColumn("_cell", F.pmod(F.xxhash64(*[c for c in pieces.columns if c != key]), cells))
    counts = own.groupBy(F.col(key).alias("_k"), F.col("_cell").alias("_c")).agg(F.count("*").alias("_n"))
    counts = counts.withColumn("_s", F.col("_c").cast("long").bitwiseAND(F.lit(~(CELLS - 1))))  # blocks of cells, summed up first
    blocks = counts.groupBy("_k", "_s").agg(F.sum("_n").alias("_n"))
    blocks = blocks.select(F.col("_k").alias("_bk"), F.col("_s").alias("_bs"), (F.sum("_n").over(Window.partitionBy("_k").orderBy("_s")) - F.col("_n")).alias("_base"))
    before = counts.select("_k", "_s", "_c", (F.sum("_n").over(Window.partitionBy("_k", "_s").orderBy("_c")) - F.col("_n")).alias("_own")).join(blocks, (F.col("_k") == F.col("_bk")) & (F.col("_s") == F.col("_bs"))).select("_k", "_c", (F.col("_own") + F.col("_base")).alias("_before"))
    ranked = own.withColumn("_rank", F.row_number().over(Window.partitionBy(key, "_cell").orderBy(*[c for c in pieces.columns if c != key])))
    joined = ranked.join(before, (F.col(key) == F.col("_k")) & (F.col("_cell") == F.col("_c")))
    return joined.select(*pieces.columns, (F.col("_before") + F.col("_rank") - 1).alias("_number"))


def pack(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """Adds `sequence_id` and `offset` to pieces (`doc_id, piece, start, length, ids_crc32`), which are read several times.

    The sequences are gapless from offset 0. An empty table gives an empty result.
    """
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `capacity` rows
    places = Places(pack_counts(counts, capacity))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sequence, offset = places(b.column("length").to_numpy(), b.column("_number").to_numpy())
            names = [n for n in b.schema.names if n != "_number"]
            yield pa.RecordBatch.from_arrays([*[b.column(n) for n in names], pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema) + ", sequence_id long, offset long"
    return number_within(pieces, "length", counts).mapInArrow(place, schema)


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Packs all documents: one row a piece with its place.

    Null or empty text: one piece with the end id. Null ids and repeated rows are packed like any others.
    """
    return pack(stash(token_pieces(docs, tokenizer, end_id, capacity, id_col, text_col), "pieces"), capacity)


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))
