"""Target-distribution importance resampling: documents drawn by how much likelier the target makes their features.

Features (runs of words) fall into buckets by a hash. Every slice of texts becomes a packed stream of 16-bit bucket
numbers with the offsets of its documents, written once below the shared folder. The streams are sorted and run-length
encoded for the counts; then the gains of all buckets are gathered along each stream and summed up between offsets.
What the driver holds is one number a bucket.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import ready, stash, text_of
from .tokens import text_slices

#: Buckets of features; a bucket number has 16 bits, so 65536 at most.
BUCKETS = 10_000
#: What tells one draw from another.
SEED = 2024
STREAM = "ids array<string>, stream binary, at array<long>, words array<long>"
#: Letters, digits and whatever isn't ASCII stay, A-Z become a-z, all else parts words. One byte for one byte.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def _string_array(data: bytes, offsets: np.ndarray) -> pa.Array:
    return pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data))


def bucket_stream(texts: pa.Array, grams: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all features of a column of texts without nulls, where each text's begin (with the end), words a text.

    Each distinct feature of the slice is hashed once.
    """
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = (memoryview(texts.buffers()[2])[offsets[0] : offsets[-1]] if texts.buffers()[2] is not None else b"")
    cut = pc.ascii_split_whitespace(_string_array(bytes(data).translate(_TABLE), offsets - offsets[0]))
    at = np.asarray(cut.offsets, dtype=np.int64)
    numbered = cut.values.slice(at[0], at[-1] - at[0]).dictionary_encode()
    word, names = np.asarray(numbered.indices, dtype=np.int64), [n.encode() for n in numbered.dictionary.to_pylist()]
    empty = np.array([not n for n in names], dtype=bool)
    kept = ~empty[word] if empty.any() else np.ones(len(word), dtype=bool)
    owner = np.repeat(np.arange(len(texts)), np.diff(at))[kept]
    word = word[kept]
    n_words = np.bincount(owner, minlength=len(texts))
    own = lambda keys: np.fromiter((zlib.crc32(k) % buckets for k in keys), dtype=np.uint16, count=len(keys))
    found, owners = [own(names)[word] if len(names) else np.zeros(0, dtype=np.uint16)], [owner]
    runs = word[:, None]
    for m in range(2, grams + 1):  # runs of m words, numbered by the run before and one more word
        inside = np.flatnonzero(owner[: len(owner) - m + 1] == owner[m - 1 :])
        runs = np.stack([word[inside + k] for k in range(m)], axis=1)
        distinct, back = np.unique(runs, axis=0, return_inverse=True)
        found.append(own([b" ".join([names[w] for w in run]) for run in distinct.tolist()])[back.ravel()] if len(distinct) else np.zeros(0, dtype=np.uint16))
        owners.append(owner[inside])
    owner, stream = np.concatenate(owners), np.concatenate(found)
    if grams > 1:
        stream = stream[np.argsort(owner, kind="stable")]
    return stream, np.r_[0, np.cumsum(np.bincount(owner, minlength=len(texts)))], n_words


def feature_streams(docs: DataFrame, grams: int = 1, buckets: int = BUCKETS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of STREAM: ids and words of a slice's documents, their packed buckets and offsets into them. Null text: no words."""
    if not 1 <= buckets <= 65536 or grams < 1:
        raise ValueError("1 to 65536 buckets, runs of one word or more")
    ready(docs.sparkSession)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in text_slices(batches, "_text"):
            stream, at, n = bucket_stream(rows.column("_text"), grams, buckets)
            columns = [rows.column("_id").to_pylist()], [stream.astype("<u2").tobytes()], [at.tolist()], [n.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.list_(pa.string()), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())), strict=True)], names=["ids", "stream", "at", "words"])

    return docs.select(F.col(f"`{id_col}`").cast("string").alias("_id"), text_of(f"`{text_col}`").alias("_text")).mapInArrow(pack, STREAM)


def bucket_counts(streams: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """`bucket, n` over all streams: each is sorted and run-length encoded, a task adds its runs up before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for packed in batch.column(0):
                run = np.sort(np.frombuffer(packed.as_py(), dtype="<u2"))
                if len(run):
                    begins = np.flatnonzero(np.r_[True, run[1:] != run[:-1]])
                    total[run[begins]] += np.diff(np.r_[begins, len(run)])
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], names=["bucket", "n"])

    return streams.select("stream").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: dict[int, int], target: dict[int, int], buckets: int = BUCKETS) -> np.ndarray:
    """floor(1000 * ln of the smoothed ratio of shares) of every bucket."""
    s, t = np.zeros(buckets), np.zeros(buckets)
    for into, counts in ((s, source), (t, target)):
        into[list(counts)] = list(counts.values())
    return np.floor(1000 * np.log((t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets)))).astype(np.int64)


def weights(streams: DataFrame, gain: np.ndarray) -> DataFrame:
    """`_id, n_features, n_words, weight`: gains gathered along the stream, summed up from offset to offset."""
    shared = streams.sparkSession.sparkContext.broadcast(gain)  # one number a bucket, 65536 at most

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, packed, at, n in zip(*batch.columns, strict=True):
                at, n, ids = np.asarray(at.values, dtype=np.int64), np.asarray(n.values, dtype=np.int64), ids.values
                each, total = np.diff(at), np.zeros(len(n), dtype=np.int64)
                if at[-1]:
                    full = each > 0  # reduceat gives the element itself where a segment is empty
                    total[full] = np.add.reduceat(shared.value[np.frombuffer(packed.as_py(), dtype="<u2")], at[:-1][full])
                yield pa.RecordBatch.from_arrays([ids, pa.array(each), pa.array(n), pa.array(total)], names=["_id", "n_features", "n_words", "weight"])

    return streams.select("ids", "stream", "at", "words").mapInArrow(gather, "_id string, n_features long, n_words long, weight long")


def gumbel(key: Column) -> Column:
    """floor(-1000 * ln(-ln(u))) of a key's own u, from the first 32 bits of its sha256."""
    u = (F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("long") + 0.5) / F.lit(4294967296.0)
    return F.floor(-1000 * F.ln(-F.ln(u)))


@dataclass(frozen=True)
class Draw:
    """How many are drawn: a share (numerator, denominator) of documents with at least so many words."""

    share: tuple[int, int] = (10, 100)
    least_words: int = 20
    seed: int = SEED


def ranked(scored: DataFrame, draw: Draw) -> DataFrame:
    """scored with `rank`: the best floor(share of the documents that are long enough), ties to the smaller id; else null.

    Rows are put in order by ranges of (score, id), so no task sees more than its range; ranges are placed by their counts.
    """
    spark = scored.sparkSession
    fit = F.coalesce(F.col("n_words") >= draw.least_words, F.lit(False))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.desc("score"), F.asc_nulls_first("_nid"), F.asc_nulls_first("_id")]
    dealt = scored.filter(fit).repartitionByRange(n, *order).sortWithinPartitions(*order)
    parts = stash(dealt.withColumn("_part", F.spark_partition_id()).withColumn("_place", F.monotonically_increasing_id()), "ranges")
    counts = parts.groupBy("_part").agg(F.count("*").alias("_n"))  # a row for each range
    before = counts.select(F.col("_part").alias("_of"), (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"), F.floor(F.sum("_n").over(Window.partitionBy(F.lit(0))) * draw.share[0] / draw.share[1]).alias("_quota"))
    place = F.col("_before") + F.col("_place") - F.shiftleft(F.col("_part").cast("long"), 33) + 1
    placed = parts.join(before, F.col("_part") == F.col("_of")).withColumn("rank", F.when(place <= F.col("_quota"), place))
    return placed.select(*scored.columns, "rank").unionAll(scored.filter(~fit).withColumn("rank", F.lit(None).cast("long")))


def resample(docs: DataFrame, target: DataFrame, grams: int = 1, buckets: int = BUCKETS, draw: Draw | None = None, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text") -> DataFrame:
    """`_id` (string), `n_features, n_words, weight, score, rank` of every document: importance resampling without replacement.

    Gumbel noise from a hash of the id is added to the weight, so the best scores are a draw in proportion to the
    importance. Null and empty texts have no feature and weight 0; with an empty target only the smoothing speaks.
    Rows with one id share their noise, a null id counts as the id ""; repeated rows are documents of their own with
    ranks of their own. Ids go by their numbers where they are numbers. Other columns aren't read.
    """
    draw = draw or Draw()
    streams = stash(feature_streams(docs, grams, buckets, id_col, text_col), "streams")
    counts = lambda s: {r["bucket"]: r["n"] for r in bucket_counts(s, buckets).collect()}  # noqa: E731  a row for each bucket at most
    gain = gains(counts(streams), counts(feature_streams(target.withColumn("_key", F.lit("")), grams, buckets, "_key", target_text)), buckets)
    rows = weights(streams, gain).withColumn("score", F.col("weight") + gumbel(F.concat(F.lit(f"{draw.seed}:"), F.coalesce("_id", F.lit("")))))
    scored = stash(rows.withColumn("_nid", F.expr("try_cast(_id AS BIGINT)")), "scores")
    return ranked(scored, draw).select("_id", "n_features", "n_words", "weight", "score", "rank")


def query(spark, sf_dir: str) -> DataFrame:
    found = resample(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(F.col("_id").cast("long").alias("doc_id"), "n_features", "weight", "score", "rank")


ORACLE = """WITH poly AS (SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
        FROM (SELECT unnest(range(256)) AS i)),
    docs AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents),
    marks AS (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS w FROM benchmark),
    seen AS (SELECT doc_id, w, count(*) AS n FROM (SELECT doc_id, unnest(words) AS w FROM docs) GROUP BY doc_id, w),
    names AS (SELECT w, hex(encode(w)) AS h FROM (SELECT w FROM seen UNION SELECT w FROM marks)),
    hashed AS (SELECT w, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length(h) // 2), lambda i: ('0x' || substr(h, (2 * i + 1)::INT, 2))::BIGINT)),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket FROM names, poly),
    s AS (SELECT bucket, sum(n)::DOUBLE AS n FROM seen JOIN hashed USING (w) GROUP BY bucket),
    t AS (SELECT bucket, count(*)::DOUBLE AS n FROM marks JOIN hashed USING (w) GROUP BY bucket),
    gain AS (SELECT s.bucket, floor(1000 * ln((coalesce(t.n, 0) + 1) * ((SELECT coalesce(sum(n), 0) FROM s) + 10000) / ((s.n + 1) * ((SELECT coalesce(sum(n), 0) FROM t) + 10000))))::BIGINT AS g
        FROM s LEFT JOIN t ON s.bucket = t.bucket),
    heavy AS (SELECT doc_id, sum(n * g)::BIGINT AS weight FROM seen JOIN hashed USING (w) JOIN gain USING (bucket) GROUP BY doc_id),
    scored AS (SELECT doc_id, len(words)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
        coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
        FROM docs LEFT JOIN heavy USING (doc_id)),
    placed AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
    SELECT doc_id, n_features, weight, score, r AS rank FROM scored LEFT JOIN (SELECT doc_id, r FROM placed WHERE r <= n * 10 // 100) USING (doc_id)"""
