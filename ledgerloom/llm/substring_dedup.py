"""Substring dedup: words that stand in a passage found earlier in the corpus are removed.

Rabin-Karp hashes of every window are counted in Spark. Each Arrow slice first settles what repeats within it, so
a passage in a third of all documents is one entry a slice; the other windows go, packed as bytes by hash range, to
the partition of their range, are sorted there, and a task holds one range at a time. Windows with an earlier equal
come back as positions, merge into maximal intervals, and are cut from the texts. Hashes have 64 bits: 30 GB of text have some 10^10 windows, of which about 3 would be
taken for repeated by chance.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_caches, ready, stash, text_of
from .tokens import text_slices
from .wordhash import Words, mix

WINDOW = 20
#: Bytes of text whose windows are sorted together in a worker, of text for one range of hashes, and at most for one
#: partition of such ranges.
SLICE, RANGE_BYTES, PART_BYTES = 4 << 20, 5 << 20, 1 << 30
_DOC = np.dtype([("id", "<i8"), ("sum", "<u4"), ("n", "<u4")])


def pack_entries(ids: np.ndarray, sums: np.ndarray, row: np.ndarray, pos: np.ndarray, hashes: np.ndarray) -> bytes:
    """Windows of one hash range, in order of (row, pos): a table of documents, steps between positions, hashes."""
    starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
    docs = np.empty(len(starts), dtype=_DOC)
    docs["id"], docs["sum"], docs["n"] = ids[row[starts]], sums[row[starts]], np.diff(np.r_[starts, len(row)])
    steps = np.diff(pos, prepend=0)
    steps[starts] = pos[starts]
    small = np.minimum(steps, 255).astype(np.uint8)
    large = steps[steps >= 255].astype("<u4")
    head = np.array([len(docs), len(pos), len(large)], dtype="<u4")
    return b"".join((head.tobytes(), docs.tobytes(), large.tobytes(), small.tobytes(), hashes.astype("<u8").tobytes()))


def unpack_entries(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids, sums, positions and hashes, one of each for every window."""
    n_docs, n, n_large = np.frombuffer(blob, "<u4", 3)
    at = 12
    docs = np.frombuffer(blob, _DOC, n_docs, at)
    at += docs.nbytes
    large = np.frombuffer(blob, "<u4", n_large, at)
    at += large.nbytes
    small = np.frombuffer(blob, np.uint8, n, at)
    hashes = np.frombuffer(blob, "<u8", n, at + n)
    steps = small.astype(np.int64)
    steps[small == 255] = large
    sums = np.cumsum(steps)
    starts = np.cumsum(docs["n"]) - docs["n"]
    base = sums[starts] - steps[starts]
    return np.repeat(docs["id"], docs["n"]), np.repeat(docs["sum"], docs["n"]), sums - np.repeat(base, docs["n"]), hashes


def later_ones(ids: np.ndarray, pos: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which windows have an equal one earlier by (id, position), and which of the others are alone or first."""
    order = np.argsort(hashes, kind="stable")
    h = hashes[order]
    same = h[1:] == h[:-1]
    shared = np.zeros(len(h), dtype=bool)
    shared[1:] |= same
    shared[:-1] |= same
    later = np.zeros(len(h), dtype=bool)
    at = order[shared]
    if len(at):
        at = at[np.lexsort((pos[at], ids[at], hashes[at]))]
        new = np.r_[True, hashes[at][1:] != hashes[at][:-1]]
        first = at[np.flatnonzero(new)[np.cumsum(new) - 1]]
        later[at] = (ids[at] != ids[first]) | (pos[at] != pos[first])
    return later, ~later


def pack_removals(ids: np.ndarray, sums: np.ndarray, pos: np.ndarray) -> bytes:
    """First words of windows to remove, by document: a table of documents and their positions."""
    order = np.lexsort((pos, sums, ids))
    ids, sums, pos = ids[order], sums[order], pos[order]
    starts = np.flatnonzero(np.r_[True, (ids[1:] != ids[:-1]) | (sums[1:] != sums[:-1])])
    docs = np.empty(len(starts), dtype=_DOC)
    docs["id"], docs["sum"], docs["n"] = ids[starts], sums[starts], np.diff(np.r_[starts, len(ids)])
    return np.array([len(docs), len(pos)], dtype="<u4").tobytes() + docs.tobytes() + pos.astype("<u4").tobytes()


def unpack_removals(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n_docs, n = np.frombuffer(blob, "<u4", 2)
    docs = np.frombuffer(blob, _DOC, n_docs, 8)
    return np.repeat(docs["id"], docs["n"]), np.repeat(docs["sum"], docs["n"]), np.frombuffer(blob, "<u4", n, 8 + docs.nbytes)


def _runs(keys: np.ndarray) -> list[tuple[int, int]]:
    """Where equal keys begin and end."""
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]).tolist() if len(keys) else []
    return list(zip(starts, [*starts[1:], len(keys)], strict=False))


def _by_home(ids: np.ndarray, sums: np.ndarray, pos: np.ndarray, homes: int) -> Iterator[tuple[int, bytes]]:
    """Removals packed for the partition that gathers each document's."""
    home = (mix(ids.view(np.uint64) ^ sums.astype(np.uint64) << np.uint64(32)) >> np.uint64(32)) * np.uint64(homes) >> np.uint64(32)
    order = np.argsort(home, kind="stable")
    for a, b in _runs(home[order]):
        one = order[a:b]
        yield int(home[one[0]]), pack_removals(ids[one], sums[one], pos[one])


def _blobs(rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], names=["_range", "_blob"])


def _each_range(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[int, bytes]]]:
    """The blobs of one range after the other, from batches sorted by range."""
    held: list[tuple[int, bytes]] = []
    for batch in batches:
        for own, blob in zip(batch.column("_range").to_pylist(), batch.column("_blob"), strict=True):
            if held and held[0][0] != own:
                yield held
                held = []
            held.append((own, blob.as_py()))
    if held:
        yield held


def repeated_windows(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`_id, _sum, _pos`: first words of the windows that start earlier too, one row for a document that has any.

    _sum (32 bits of a hash of the text) tells rows with one id apart. Windows are dealt out by ranges of their
    hash, what is found by homes of the documents, which have the numbers of the ranges; rows of both hold packed
    bytes. The number of ranges follows the bytes of all texts, counted first, so a task, which holds the windows of
    one range at a time, needs the same memory at any size.
    """
    spark = ready(docs.sparkSession)
    size = docs.agg(F.sum(F.octet_length(F.col(f"`{text_col}`").cast("string")))).head()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // PART_BYTES)
    ranges = max(parts, size // RANGE_BYTES)

    def count_here(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_caches()
        for batch in text_slices(batches, "_text", SLICE):
            ids, sums = batch.column("_id").to_numpy(), batch.column("_sum").to_numpy().astype(np.int64)
            hashes, row, pos = Words(batch.column("_text")).windows(window)
            later, rest = later_ones(ids[row], pos, hashes)
            known = np.flatnonzero(later)
            out = [(home, b"r" + blob) for home, blob in _by_home(ids[row[known]], sums[row[known]], pos[known], ranges)]
            part = (hashes >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)
            at = np.flatnonzero(rest)
            at = at[np.argsort(part[at], kind="stable")]
            for a, b in _runs(part[at]):
                one = at[a:b]
                out.append((int(part[one[0]]), b"e" + pack_entries(ids, sums, row[one], pos[one], hashes[one])))
            yield _blobs(out)

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_caches()
        for blobs in _each_range(batches):
            done = [(own, blob[1:]) for own, blob in blobs if blob[:1] == b"r"]  # found already; its home has this number
            held = [unpack_entries(blob[1:]) for _, blob in blobs if blob[:1] == b"e"]
            if held:
                ids, sums, pos, hashes = (np.concatenate(x) for x in zip(*held, strict=True))
                later, _ = later_ones(ids, pos, hashes)
                done += _by_home(ids[later], sums[later].astype(np.int64), pos[later], ranges)
            yield _blobs(done)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for blobs in _each_range(batches):
            ids, sums, pos = (np.concatenate(x) for x in zip(*[unpack_removals(blob) for _, blob in blobs], strict=True))
            order = np.lexsort((pos, sums, ids))
            ids, sums, pos = ids[order], sums[order].astype(np.int64), pos[order].astype(np.int32)
            starts = np.flatnonzero(np.r_[True, (ids[1:] != ids[:-1]) | (sums[1:] != sums[:-1])])
            ends = np.r_[starts[1:], len(ids)]
            for i in range(0, len(starts), 5000):
                a, b = starts[i : i + 5000], ends[i : i + 5000]
                lists = pa.ListArray.from_arrays(pa.array((np.r_[a, b[-1]] - a[0]).astype(np.int32)), pa.array(pos[a[0] : b[-1]]))
                yield pa.RecordBatch.from_arrays([pa.array(ids[a]), pa.array(sums[a]), lists], names=["_id", "_sum", "_pos"])

    keyed = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(-(2**63))).alias("_id"), text_of(text_col).alias("_text")).withColumn("_sum", _text_sum("_text"))
    packed = "_range int, _blob binary"
    at = (F.col("_range").cast("long") * parts / ranges).cast("int")
    found = keyed.mapInArrow(count_here, packed).repartitionById(parts, at).sortWithinPartitions("_range").mapInArrow(settle, packed)
    return found.repartitionById(parts, at).sortWithinPartitions("_range").mapInArrow(gather, "_id long, _sum long, _pos array<int>")


def _text_sum(column: str):
    return F.xxhash64(column).bitwiseAND(F.lit(2**32 - 1))


def intervals(starts: np.ndarray, window: int) -> np.ndarray:
    """Maximal intervals [from, to) of words covered by windows at these starts; touching ones merge."""
    starts = np.unique(starts)
    new = np.flatnonzero(np.r_[True, starts[1:] > starts[:-1] + window]) if len(starts) else np.zeros(0, np.int64)
    return np.stack([starts[new], starts[np.r_[new[1:], len(starts)] - 1] + window], axis=1) if len(starts) else np.zeros((0, 2), np.int64)


def dedup_substrings(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True) -> DataFrame:
    """`row` (the whole input row), `n_words`, `n_removed`, `kept_sha256`, `spans` (array of [from, to) word intervals) [and `kept`].

    Removed is every word in a window that also starts earlier: under a smaller id, or further up in the same
    document. Windows are judged on the input. What is kept is joined by one space for kept_sha256; `kept` is the text
    itself where nothing was removed. Null or empty text: no words.
    Texts shorter than a window lose nothing. Null id: before all others. Rows with one id and different texts
    count as one document whose positions may tie; identical rows are treated alike, and both stay.
    """
    ready(docs.sparkSession)
    found = stash(repeated_windows(docs, window, id_col, text_col), "windows")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "_text", SLICE):
            n_words, n_removed, sha, spans, kept = [], [], [], [], []
            for text, pos in zip(batch.column("_text"), batch.column("_pos"), strict=True):
                words = text.as_py().encode("utf-8", "surrogatepass").split()  # splits at ASCII white space only
                total, gone = len(words), []
                if pos.is_valid:
                    gone = intervals(np.asarray(pos.values), window).tolist()
                    stay, at = [], 0
                    for a, b in gone:
                        stay += words[at:a]
                        at = b
                    words = stay + words[at:]
                joined = b" ".join(words)
                n_words.append(total)
                n_removed.append(total - len(words))
                sha.append(hashlib.sha256(joined).hexdigest())
                spans.append(gone)
                if with_text:
                    kept.append(joined.decode("utf-8", "surrogatepass") if gone else text.as_py())
            arrays = [batch.column("row"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(sha, pa.string()), pa.array(spans, pa.list_(pa.list_(pa.int32())))]
            names = ["row", "n_words", "n_removed", "kept_sha256", "spans"]
            yield pa.RecordBatch.from_arrays([*arrays, *([pa.array(kept, pa.string())] if with_text else [])], names=[*names, *(["kept"] if with_text else [])])

    rest = [c for c in docs.columns if c != text_col]
    row = F.struct(*[F.col(f"`{c}`") for c in rest])
    texts = docs.select(row.alias("row"), F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(-(2**63))).alias("_key"), text_of(text_col).alias("_text")).withColumn("_own", _text_sum("_text"))
    joined = texts.join(found, (F.col("_key") == F.col("_id")) & (F.col("_own") == F.col("_sum")), "left").select("row", "_text", "_pos")
    kind = joined.schema["row"].dataType.simpleString()
    return joined.mapInArrow(cut, f"row {kind}, n_words long, n_removed long, kept_sha256 string, spans array<array<int>>" + (", kept string" if with_text else ""))


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_substrings(docs, with_text=False).select(F.col("row.doc_id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")


ORACLE = r"""
WITH w AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM w)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS n FROM g) WHERE n > 1),
c AS (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(range(i, i + 20)) AS p FROM r)),
t AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM w),
k AS (SELECT t.doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY t.p) AS kept FROM t ANTI JOIN c ON t.doc_id = c.doc_id AND t.p = c.p GROUP BY t.doc_id)
SELECT w.doc_id, len(w.w) AS n_words, len(w.w) - coalesce(k.n, 0) AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM w LEFT JOIN k USING (doc_id)
"""
