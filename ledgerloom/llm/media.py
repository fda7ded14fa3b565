"""Media columns: content-addressed payloads in tar shards.

Every payload is stored once a task as an 8-bit grey PNG (64 samples a row, lossless) in a tar shard below the shared
folder; rows carry its digest, shard, offset and length. Metadata columns are filled by reading 33 bytes of each
payload's header at its offset, payloads by reading their range; nothing else of a shard is read. Where tasks stored
the same content, all rows point to the first copy.

Shards of a task attempt that was lost stay unused: the index is written by Spark's commit, and only it names shards.
"""

from __future__ import annotations

import hashlib
import struct
import tarfile
import zlib
from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ready, scratch, stash, text_of
from .tokens import text_slices

#: Samples of a row, bytes after which a shard is closed, and bytes of a header that hold all metadata.
WIDTH, SHARD, HEAD = 64, 256 << 20, 33
_SIGNATURE = b"\x89PNG\r\n\x1a\n"


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def pad(raw: bytes) -> bytes:
    """Zero bytes up to a positive multiple of the width."""
    return raw + bytes(-len(raw) % WIDTH) if raw else bytes(WIDTH)


def encode_png(payload: bytes) -> bytes:
    """Samples as a grey image; every row is stored without a filter."""
    rows = np.frombuffer(payload, dtype=np.uint8).reshape(-1, WIDTH)
    lines = np.zeros((len(rows), WIDTH + 1), dtype=np.uint8)
    lines[:, 1:] = rows
    return _SIGNATURE + _chunk(b"IHDR", struct.pack(">IIBBBBB", WIDTH, len(rows), 8, 0, 0, 0, 0)) + _chunk(b"IDAT", zlib.compress(lines, 6)) + _chunk(b"IEND", b"")


def read_header(head: bytes) -> tuple[int, int, int]:
    """Width, height and bits of a sample, from the first 33 bytes."""
    if head[:8] != _SIGNATURE or head[12:16] != b"IHDR" or zlib.crc32(head[12:29]) != struct.unpack(">I", head[29:33])[0]:
        raise ValueError("not the header of a stored payload")
    width, height, bits, colour = struct.unpack(">IIBB", head[16:26])
    if colour:
        raise ValueError("not a grey image")
    return width, height, bits


def decode_png(data: bytes) -> bytes:
    """The samples of an image that encode_png stored."""
    width, height, _ = read_header(data[:HEAD])
    size = struct.unpack(">I", data[HEAD : HEAD + 4])[0]
    lines = np.frombuffer(zlib.decompress(memoryview(data)[HEAD + 8 : HEAD + 8 + size]), dtype=np.uint8).reshape(height, width + 1)
    return lines[:, 1:].tobytes()


def _files(uri: str):
    """File system and path of a shared location, whatever store it is in."""
    from pyarrow import fs

    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri)


class ShardWriter:
    """Appends members to tar shards and tells where their bytes are; content it has is not stored again."""

    def __init__(self, folder: str, name: str):
        self.system, self.path = _files(folder)
        self.system.create_dir(self.path, recursive=True)
        self.name, self.number, self.out, self.at = name, 0, None, 0
        self.known: dict[bytes, tuple[str, int, int]] = {}

    def add(self, data: bytes) -> tuple[bytes, str, int, int]:
        digest = hashlib.sha256(data).digest()
        if digest not in self.known:
            if self.out is None or self.at > SHARD:
                self.close()
                self.shard, self.at = f"{self.name}-{self.number:04d}.tar", 0
                self.out = self.system.open_output_stream(f"{self.path}/{self.shard}")
                self.number += 1
            info = tarfile.TarInfo(f"{digest.hex()}.png")
            info.size = len(data)
            head = info.tobuf(tarfile.PAX_FORMAT)
            self.out.write(head)
            self.out.write(data)
            self.out.write(bytes(-len(data) % tarfile.BLOCKSIZE))
            self.known[digest] = (self.shard, self.at + len(head), len(data))
            self.at += len(head) + len(data) + -len(data) % tarfile.BLOCKSIZE
        return (digest, *self.known[digest])

    def close(self) -> None:
        if self.out is not None:
            self.out.write(bytes(2 * tarfile.BLOCKSIZE))
            self.out.close()
            self.out = None


INDEX = "doc_id long, n_bytes long, digest binary, shard string, offset long, length long"


def store(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes the payloads of all texts below folder and returns the index: rows of INDEX, each digest at one place.

    Null text: the empty text, one row of zeros. Null ids and repeated rows are stored like any others.
    """
    ready(docs.sparkSession)

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        writer = ShardWriter(folder, f"{task.partitionId():06d}-{uuid4().hex[:12]}")
        for batch in text_slices(batches, "_text", 4 << 20):
            sizes, places = [], []
            for text in batch.column("_text"):
                raw = text.as_buffer().to_pybytes()
                sizes.append(len(raw))
                places.append(writer.add(encode_png(pad(raw))))
            digest, shard, offset, length = zip(*places, strict=True)
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(sizes, pa.int64()), pa.array(digest, pa.binary()), pa.array(shard), pa.array(offset, pa.int64()), pa.array(length, pa.int64())], names=["doc_id", "n_bytes", "digest", "shard", "offset", "length"])
        writer.close()

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("_id"), text_of(text_col).alias("_text"))
    index = stash(rows.mapInArrow(put, INDEX), "media-index")
    place = stash(index.groupBy(F.col("digest").alias("_d")).agg(F.min(F.struct("shard", "offset", "length")).alias("_p")), "media-places")
    return index.select("doc_id", "n_bytes", "digest").join(place, F.col("digest") == F.col("_d")).select("doc_id", "n_bytes", "digest", "_p.*")


def each_payload(index: DataFrame) -> DataFrame:
    """One row for each stored content (`digest, shard, offset, length`), dealt out by shard and in its order."""
    return index.select("digest", "shard", "offset", "length").distinct().repartition("shard").sortWithinPartitions("shard", "offset")


def metadata(index: DataFrame, folder: str) -> DataFrame:
    """`digest, width, height, bits` from header-only range reads."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Reader(folder)
        for batch in batches:
            heads = [read_header(reader.read(s, o, HEAD)) for s, o in zip(batch.column("shard").to_pylist(), batch.column("offset").to_pylist(), strict=True)]
            columns = list(zip(*heads, strict=True)) or [[], [], []]
            yield pa.RecordBatch.from_arrays([batch.column("digest"), *[pa.array(c, pa.int64()) for c in columns]], names=["digest", "width", "height", "bits"])

    return each_payload(index).mapInArrow(look, "digest binary, width long, height long, bits long")


class _Reader:
    """Reads ranges; keeps the last shard open."""

    def __init__(self, folder: str):
        self.system, self.path = _files(folder)
        self.name, self.handle = None, None

    def read(self, shard: str, offset: int, length: int) -> bytes:
        if shard != self.name:
            if self.handle is not None:
                self.handle.close()
            self.name, self.handle = shard, self.system.open_input_file(f"{self.path}/{shard}")
        data = self.handle.read_at(length, offset)
        if len(data) != length:
            raise ValueError(f"{shard} ends within a payload")
        return data


FEATURES = "digest binary, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def features(index: DataFrame, folder: str) -> DataFrame:
    """Rows of FEATURES, one for each stored content, from the bytes read back; a digest that differs is an error."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Reader(folder)
        for batch in batches:
            rows = []
            for digest, shard, offset, length in zip(*(batch.column(c).to_pylist() for c in ("digest", "shard", "offset", "length")), strict=True):
                width, height, bits = read_header(reader.read(shard, offset, HEAD))
                data = reader.read(shard, offset, length)
                if hashlib.sha256(data).digest() != digest:
                    raise ValueError(f"{shard} at {offset} doesn't hold what its index says")
                payload = decode_png(data)
                counts = np.bincount(np.frombuffer(payload, dtype=np.uint8), minlength=256)
                mean = int(counts @ np.arange(256)) * 1000 // len(payload)
                rows.append((digest, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-WIDTH:]), length, digest.hex(), f"{width}x{height}x{bits} mean={mean / 1000:.3f} values={int((counts > 0).sum())} mode={int(counts.argmax())}"))
            columns = list(zip(*rows, strict=True)) or [[]] * 7
            kinds = [pa.binary(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[c.split()[0] for c in FEATURES.split(", ")])

    return each_payload(index).mapInArrow(look, FEATURES)


def query(spark, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "media")
    index = stash(store(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), folder), "media-rows")
    found = stash(features(index, folder), "media-features").withColumnRenamed("digest", "_d")
    return index.join(found, F.col("digest") == F.col("_d")).select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")
