"""SentencePiece encoding and decoding of whole texts for merge-type models.

Own encoding by the merge agenda; every distinct chunk is checked against the sentencepiece library in its Arrow
batch before it is used, and one that differs is an error. A text is cut only where no piece of the vocabulary holds both characters
(looked up when the model is loaded), so no merge crosses the place and the ids of a text are those of its chunks: before a
space that stands between two characters other than spaces, before a line feed, and between a letter and marks that end a chunk.
Arrow cuts a slice of texts and numbers its distinct chunks; only those are looked up. Texts where spaces touch spaces are cut one by one.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ready, text_of, worker_caches
from .merge_agenda import SPACE, MergeTable
from .tokens import split_marks, text_slices

#: Chunks remembered by one worker: half of them recent, half of the time before.
CACHE_CHUNKS = 800_000
_CUT = re.compile(rf"(?<=[^ {SPACE}]) (?=[^ {SPACE}])")
#: Letters that part from the marks after them, and runs of marks remembered by one worker.
_LETTERS = r"A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
_TAILS = 10_000
_EDGE = re.compile(rf"^\Z|^[ {SPACE}]|[ {SPACE}]\Z")


class PieceCodec:
    """Chunk by chunk encoding with a cache of ids, as bytes of little-endian 32-bit integers."""

    def __init__(self, path: str, limit: int = CACHE_CHUNKS):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.table = MergeTable(self.library)
        if any(SPACE in p.lstrip(SPACE) for p in self.table.pieces):
            raise ValueError("a piece holds a space after another character: texts can't be cut at spaces")
        if self.library.encode("a b") != self.library.encode("a") + self.library.encode("b") or self.library.normalize(" A  éﬁ ") != f"{SPACE}{SPACE}A{SPACE}{SPACE}éﬁ{SPACE}":
            raise ValueError("the model normalises texts or has no dummy prefix: not supported")
        self.head = self.library.encode("a")  # before a chunk that goes without the space
        #: Marks that no piece holds after a letter: no merge crosses the place between a word and such a mark.
        self.marks: set[str] = set()
        for m in (c for c in map(chr, range(33, 127)) if not c.isalnum()):
            if not any(re.search(rf"[{_LETTERS}]{re.escape(m)}", p) for p in self.table.pieces) and self.library.encode(f"a{m}") == self.head + self.table.encode_one(m):
                self.marks.add(m)
        self.firsts = np.array([chr(b) in self.marks for b in range(256)])
        self.feeds = not any("\n" in p and len(p) > 1 for p in self.table.pieces) and self.library.encode("a\nb") == self.head + self.table.encode_one("\nb")
        self.limit = limit
        self.name = pa.array([f"{i}," for i in range(self.library.get_piece_size())], pa.large_binary())
        #: By chunk: after a space as it is, after no space if it begins with a line feed; a space before it says that it is after a space.
        self.cache: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {}

    def _check(self, chunks: list[str]) -> None:
        fed = [c for c in chunks if c[0] == "\n"]
        self.cache.update(self._checked(fed, fed, [f"a{c}" for c in fed], len(self.head)))
        rest = [c for c in chunks if c[0] != "\n"]
        texts = [c[1:] if c[0] == " " else c for c in rest]
        self.cache.update(self._checked(rest, [SPACE + c for c in texts], texts, 0))

    def _checked(self, chunks: list[str], own: list[str], texts: list[str], head: int) -> Iterator[tuple[str, bytes]]:
        """Chunks with the agenda's ids, which have to be those that the library gives for texts after the head."""
        ids, ends = self.table.encode_flat([t.replace(" ", SPACE) for t in own])
        theirs = self.library.encode(texts, num_threads=1)
        if head:
            theirs = [x[head:] if x[:head] == self.head else [] for x in theirs]
        sizes = np.fromiter(map(len, theirs), dtype=np.int64, count=len(theirs))
        if not np.array_equal(np.cumsum(sizes), ends) or not np.array_equal(np.fromiter(chain.from_iterable(theirs), dtype=np.int64, count=int(sizes.sum())), ids):
            mine = np.split(ids, ends[:-1])
            raise ValueError(f"the agenda's ids of {next(c for c, a, b in zip(chunks, mine, theirs, strict=True) if a.tolist() != b)!r} are not the library's")
        raw, at = ids.astype("<i4").tobytes(), (4 * ends).tolist()
        return zip(chunks, [raw[a:b] for a, b in zip([0, *at], at, strict=False)], strict=True)

    def _tails(self, tails: list[str]) -> list[bytes]:
        """Ids of runs of marks after a letter."""
        if len(self.tails) > _TAILS:
            self.tails.clear()
        new = [t for t in tails if t and t not in self.tails]
        self.tails[""] = b""
        self.tails.update(self._checked(new, new, [f"a{t}" for t in new], len(self.head)))
        return [self.tails[t] for t in tails]

    def encode_column(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a string column without nulls, and where each text's begin (with the end)."""
        if len(self.cache) > self.limit // 2:
            self.old, self.cache = self.cache, {}
        cut = pc.split_pattern(pc.replace_substring(column, "\n", " \n") if self.feeds else column, " ")
        first = np.asarray(cut.offsets, dtype=np.int64)
        numbered = cut.values.dictionary_encode()
        word = np.array(numbered.indices)[first[0] :]
        first = first - first[0]
        bodies, tails = (part.dictionary_encode() for part in split_marks(numbered.dictionary, self.firsts))
        chunks = bodies.dictionary.to_numpy(zero_copy_only=False).tolist()
        missing = [c for c in chunks if c not in self.cache]
        odd = {c for c in missing if not c or c[0] == SPACE or c[-1] == SPACE}
        need, slow = set(missing).difference(odd), {}
        if odd:
            strange = np.array([c in odd for c in chunks])[np.asarray(bodies.indices)][word]
            for k in np.flatnonzero(np.logical_or.reduceat(strange, first[:-1])).tolist():
                text = column[k].as_py()
                slow[k] = [f" {w}" if _EDGE.search(w) or w[0] == "\n" else w for w in (_CUT.split(text) if text else [])]  # keys that no word of another text has
                need.update([w for w in slow[k] if w not in self.cache])
        again = need.intersection(self.old)
        self.cache.update(zip(again, map(self.old.__getitem__, again), strict=True))
        self._check(sorted(need.difference(again)))
        found = pa.array([b"" if c in odd else self.cache[c] for c in chunks] if odd else list(map(self.cache.__getitem__, chunks)), pa.large_binary())
        ends = pa.array(self._tails(tails.dictionary.to_pylist()), pa.large_binary())
        found = pc.binary_join_element_wise(found.take(bodies.indices), ends.take(tails.indices), pa.scalar(b"", pa.large_binary()))
        taken = found.take(pa.array(word))
        at = np.frombuffer(taken.buffers()[1] or bytes(8), dtype=np.int64)[: len(word) + 1] // 4
        ids = np.frombuffer(taken.buffers()[2] or b"", dtype="<i4", count=int(at[-1]))
        starts = at[first]
        if slow:
            parts = [ids[a:b] for a, b in zip(starts[:-1], starts[1:], strict=True)]
            for k, words in slow.items():
                parts[k] = np.frombuffer(b"".join(map(self.cache.__getitem__, words)), dtype="<i4")
            ids, starts = np.concatenate(parts), np.r_[0, np.cumsum([len(p) for p in parts])]
        return ids, starts

    def names(self, ids: np.ndarray, starts: np.ndarray) -> list[bytes]:
        """The decimal ids of each text, joined by commas."""
        taken = self.name.take(pa.array(ids))
        at = np.frombuffer(taken.buffers()[1] or bytes(8), dtype=np.int64)[: len(ids) + 1][starts].tolist()
        raw = memoryview(taken.buffers()[2] or b"")
        return [bytes(raw[a : b - 1]) if b > a else b"" for a, b in zip(at[:-1], at[1:], strict=True)]

    def encode(self, texts: list[str]) -> list[list[tuple[str, tuple[int, ...], bool]]]:
        """For each text one (decimal ids joined by commas, ids, whether the library's differ)."""
        ids, starts = self.encode_column(pa.array(texts, pa.string()))
        return [[(n.decode(), tuple(ids[a:b].tolist()), False)] for n, a, b in zip(self.names(ids, starts), starts[:-1], starts[1:], strict=True)]


_codecs: dict[str, PieceCodec] = {}
worker_caches.append(_codecs)


def codec(path: str) -> PieceCodec:
    if path not in _codecs:
        _codecs.clear()
        _codecs[path] = PieceCodec(path)
    return _codecs[path]


def encode_pieces(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """`doc_id, n_tokens, ids_sha256, decoded_sha256, n_differing` [and `ids, decoded`] of every whole text.

    ids_sha256 is of the decimal ids joined by commas. Null or empty text: no ids. Null ids and repeated rows are
    encoded like any others. The text decoded from the ids comes from the library.
    """
    ready(docs.sparkSession)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model)
        for rows in text_slices(batches, "_text", 4 << 20):
            flat, starts = c.encode_column(rows.column("_text"))
            ids_sha, text_sha, ids, decoded = [hashlib.sha256(n).hexdigest() for n in c.names(flat, starts)], [], [], []
            for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                line = flat[a:b].tolist()
                text = c.library.decode(line) if line else ""
                text_sha.append(hashlib.sha256(text.encode()).hexdigest())
                if with_ids:
                    ids.append(line)
                    decoded.append(text)
            n, differing = np.diff(starts), np.zeros(len(starts) - 1, dtype=np.int64)  # one that differs is an error
            arrays = [rows.column("_id"), pa.array(n, pa.int64()), pa.array(ids_sha), pa.array(text_sha), pa.array(differing, pa.int64())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_differing"]
            if with_ids:
                arrays, names = [*arrays, pa.array(ids, pa.list_(pa.int32())), pa.array(decoded)], [*names, "ids", "decoded"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, n_differing long" + (", ids array<int>, decoded string" if with_ids else "")
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("_id"), text_of(text_col).alias("_text")).mapInArrow(encode, schema)


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return encode_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"), with_ids=False)
