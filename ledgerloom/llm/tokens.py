"""Whole-text token ids from the tokenizers library, with a bounded cache of text chunks in each Python worker.

A text is cut only where the tokenizers cut it anyway: around a single line feed, and before a single space, that
stands between two characters other than white space. So the ids of a text are the ids of its chunks, joined. Arrow
cuts a slice of texts and numbers its distinct chunks; only those are looked up, and only chunks that the worker
doesn't remember are encoded. To the pre-tokenizers below, words of letters are one piece, so they go to the library's model
without normalizer and pattern, and marks that end a chunk after a letter are another, so they are looked up by themselves; where
the tokenizer drops white space and case, chunks that differ in nothing else are one. Texts where white space
touches white space take a slower, equally exact way of cutting. Texts that hold the string of a special token go whole to the
library, which makes that token's id of it.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import release, worker_caches

#: Chunks remembered by one worker: half of them recent, half of the time before.
CACHE_CHUNKS = 800_000
#: White space to any of the regex engines involved: at these characters a text isn't cut.
_GAP = r"\s\x1c-\x1f\u180e\u200b\u2060\ufeff"
_CUT = re.compile(rf"(?<=[^{_GAP}]) (?=[^{_GAP}])")
_GAPS = frozenset(c for c in map(chr, range(0xD800)) if re.match(f"[{_GAP}]", c)) | {"\ufeff"}
#: A word of letters that every engine takes for letters, after a line feed or not.
_WORD = re.compile(r"\n?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
#: Bytes: marks, letters of ASCII, second bytes of the other letters of _WORD (after 0xC3), and the lower case of ASCII.
_MARKS = np.array([33 <= b < 127 and not chr(b).isalnum() for b in range(256)])
_ASCII = np.array([b < 128 and chr(b).isalpha() for b in range(256)])
_LATIN = np.array([128 <= b < 192 and b not in (0x97, 0xB7) for b in range(256)])
_LOWER = np.frombuffer(bytes(range(256)).lower(), dtype=np.uint8)
#: Runs of marks remembered by one worker.
_TAILS = 10_000
#: What may stand between chunks that are encoded together, if the tokenizer makes one id of it, and how many are.
_SEPARATORS, _TOGETHER = ("\t", " 7"), 400
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True}
#: Normalizer and pre-tokenizer of tokenizers to which a word of letters is one piece: the space it takes along, and its case.
_LETTERS = [
    (None, _BYTES | {"use_regex": True}, " ", str),
    (
        [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}],
        [{"type": "Split", "pattern": {"Regex": _PATTERN}, "behavior": "Removed", "invert": True}, _BYTES | {"use_regex": False}],
        "",
        str.lower,
    ),
]


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte before a byte-level model; a line feed stays, to part words."""
    same = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in same]
    return {b: chr(b) for b in same} | {b: chr(256 + k) for k, b in enumerate(others)} | {10: "\n"}


def _shape(part) -> object:
    """What a normalizer or pre-tokenizer says of itself; a sequence as its list."""
    if part is None:
        return None
    found = json.loads(part.__getstate__())
    return found.get("normalizers", found.get("pretokenizers", found))


def split_marks(chunks: pa.Array, firsts: np.ndarray = _MARKS, blank: bool = False) -> tuple[pa.Array, pa.Array]:
    """Chunks without the marks that end them after a letter, and these marks, of which firsts may come first. blank: line feeds and case go."""
    at, n = np.frombuffer(chunks.buffers()[1], dtype=np.int32, count=chunks.offset + len(chunks) + 1)[chunks.offset :].astype(np.int64), len(chunks)
    data = np.frombuffer(chunks.buffers()[2] or b"", dtype=np.uint8)[at[0] : at[-1]]
    start, end = at[:-1] - at[0], at[1:] - at[0]
    size, place = end - start, np.arange(len(data))
    other = np.maximum.accumulate(np.where(_MARKS[data], -1, place))
    last = np.where(size > 0, other[end - 1], -1) if len(data) else np.full(n, -1)  # of those that aren't marks
    letter = (last >= start) & (_ASCII[data[last]] | (last > start) & _LATIN[data[last]] & (data[np.maximum(last - 1, 0)] == 0xC3)) if len(data) else np.zeros(n, dtype=bool)
    cut = np.where(letter & firsts[data[np.minimum(last + 1, len(data) - 1)]], last + 1, end) if len(data) else end
    if blank and len(data):
        plain = np.diff(np.r_[0, np.cumsum(data >= 128)][np.r_[start, len(data)]]) == 0  # others may compose in lower case alone
        data = np.where(np.repeat(plain, size), _LOWER[data], data)
        start = start + ((size > 0) & (data[np.minimum(start, len(data) - 1)] == 10))
    tail = place >= np.repeat(cut, size)
    body = (place >= np.repeat(start, size)) & ~tail
    made = [(np.r_[0, np.cumsum(k)].astype(np.int32), data[m]) for k, m in ((cut - start, body), (end - cut, tail))]
    return tuple(pa.StringArray.from_buffers(n, pa.py_buffer(o), pa.py_buffer(d)) for o, d in made)


class ChunkEncoder:
    """Token ids of whole texts as bytes of little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, limit: int = CACHE_CHUNKS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [(t.content, t.normalized) for t in self.tokenizer.get_added_tokens_decoder().values() if t.content]
        self.tokenizer.encode_special_tokens = True  # for chunks; none of them holds such a string
        self.limit = limit
        self.ids: dict[str, bytes] = {}  # a chunk after a space, or after a line feed that it begins with
        self.old: dict[str, bytes] = {}
        self.feed = self._one("\n")
        self.sep, self.sep_id = next(((s, one[0]) for s in _SEPARATORS if len(one := self._ids(s)) == 1 and self._ids(f"{s} ab{s} c.") == one + self._ids(" ab") + one + self._ids(" c.")), ("", -1))
        self.space, self.case, self.lean, self.tab = "", str, None, -1
        shape = _shape(self.tokenizer.normalizer), _shape(self.tokenizer.pre_tokenizer)
        for normalizer, pieces, space, case in _LETTERS:
            if shape == (normalizer, pieces):
                self._lean(space, case)
        self.tails: dict[str, bytes] = {}
        self.parted = self.lean is not None and all(self._one(f" {w}{m}") == self._one(f" {w}") + self._one(m) for w in ("ab", "Caf\u00e9") for m in (".", "!?", "&&&", "'", '."'))
        self.blank = self.parted and self.case is str.lower and not self.feed and all(self._one(f" {w}") == self._one(w) == self._one(w.lower()) for w in ("Ab", "A-B'S", "7"))

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _one(self, text: str) -> bytes:
        return np.array(self._ids(text), dtype="<u4").tobytes()

    def _lean(self, space: str, case) -> None:
        """The same model (shared, not copied) behind a split at line feeds."""
        from tokenizers import Tokenizer, pre_tokenizers

        self.space, self.case, self.letters = space, case, _byte_letters()
        self.lean = Tokenizer(self.tokenizer.model)
        self.lean.pre_tokenizer = pre_tokenizers.CharDelimiterSplit("\n")
        tab = self.lean.encode(self.letters[9], add_special_tokens=False).ids
        self.tab = tab[0]
        words = ["ab", "Words", "\u00c9t\u00e9", "\nab", "\nWords", "\n\u00e9T\u00c9"]
        self._words(words)
        own, self.ids = self.ids, {}
        self._each(words)
        if len(tab) != 1 or own != self.ids:
            self.lean = None
        self.ids = {}

    def _words(self, words: list[str]) -> None:
        """Words of letters, after a space or a line feed, joined with a tab between them, which none of them holds."""
        for fed, space in ((False, self.space), (True, "")):
            mine = [c for c in words if (c[0] == "\n") == fed]
            blocks = [mine[i : i + _TOGETHER] for i in range(0, len(mine), _TOGETHER)]
            texts = [f"\t\n{space}" + f"\n\t\n{space}".join([c[1:] for c in b] if fed else b) for b in blocks]
            texts = [self.case(t).encode().decode("latin-1").translate(self.letters) for t in texts]
            for block, e in zip(blocks, self.lean.encode_batch_fast(texts, add_special_tokens=False), strict=True):
                ids = np.array(e.ids, dtype="<u4")
                raw, starts = ids.tobytes(), (4 * np.flatnonzero(ids == self.tab)).tolist()
                head = self.feed if fed else b""
                self.ids.update([(c, head + raw[a + 4 : b]) for c, a, b in zip(block, starts, [*starts[1:], len(raw)], strict=True)])

    def _each(self, chunks: list[str]) -> None:
        for c, e in zip(chunks, self.tokenizer.encode_batch_fast([c[1:] if c[0] == "\n" else f" {c}" for c in chunks], add_special_tokens=False), strict=True):
            self.ids[c] = (self.feed if c[0] == "\n" else b"") + np.array(e.ids, dtype="<u4").tobytes()

    def _learn(self, chunks: set[str]) -> None:
        """Many chunks are encoded as one text, with a separator that none of them holds."""
        words, others = set(), []
        for c in chunks:
            (others.append if _WORD.fullmatch(c) is None else words.add)(c)
        if self.lean is not None:
            self._words(list(words))
        else:
            others += words
        sign = self.sep.strip(" ")
        joint = [c for c in others if sign and sign not in c and c[0] != "\n"]
        single = [c for c in others if not sign or sign in c or c[0] == "\n"]
        blocks = [joint[i : i + _TOGETHER] for i in range(0, len(joint), _TOGETHER)]
        for block, e in zip(blocks, self.tokenizer.encode_batch_fast(["".join([f"{self.sep} {c}" for c in b]) for b in blocks], add_special_tokens=False), strict=True):
            ids = np.array(e.ids, dtype="<u4")
            at = np.flatnonzero(ids == self.sep_id)
            if len(at) != len(block):  # the separator's id within a chunk: these go one by one
                single += block
                continue
            raw, starts = ids.tobytes(), (4 * at).tolist()
            self.ids.update([(c, raw[a + 4 : b]) for c, a, b in zip(block, starts, [*starts[1:], len(raw)], strict=True)])
        self._each(single)

    def _tails(self, tails: list[str]) -> list[bytes]:
        if len(self.tails) > _TAILS:
            self.tails.clear()
        self.tails.update([(t, self._one(t)) for t in tails if t not in self.tails])
        return [self.tails[t] for t in tails]

    def _slowly(self, texts: list[str]) -> list[bytes]:
        """Texts with unusual white space, cut before spaces alone; nothing of them is remembered."""
        cut = [_CUT.split(t) for t in texts]
        flat = [w if not i else f" {w}" for words in cut for i, w in enumerate(words)]
        ids = [np.array(e.ids, dtype="<u4").tobytes() for e in self.tokenizer.encode_batch_fast(flat, add_special_tokens=False)]
        ends = np.cumsum([len(words) for words in cut]).tolist()
        return [b"".join(ids[a:b]) for a, b in zip([0, *ends], ends, strict=False)]

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a string column without nulls, and where each text's begin (with the end)."""
        held = [pc.match_substring(column, t, ignore_case=folded) for t, folded in self.special]  # normalised tokens match other cases too
        which = np.flatnonzero(np.logical_or.reduce([np.asarray(h) for h in held])) if held else np.zeros(0, dtype=int)
        if not len(which):
            return self._encode(column)
        mask = np.zeros(len(column), dtype=bool)
        mask[which] = True
        ids, at = self._encode(pc.if_else(pa.array(mask), pa.scalar("", column.type), column))
        parts = [ids[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
        self.tokenizer.encode_special_tokens = False  # the library's own way; a second tokenizer would double the memory
        for k in which.tolist():
            parts[k] = np.array(self._ids(column[k].as_py()), dtype="<u4")
        self.tokenizer.encode_special_tokens = True
        return np.concatenate(parts), np.r_[0, np.cumsum([len(p) for p in parts])]

    def _encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if len(self.ids) > self.limit // 2:
            self.old, self.ids = self.ids, {}
        marked = pc.replace_substring(pc.binary_join_element_wise("\n", column, ""), "\n", " \n")
        cut = pc.split_pattern(marked, " ")
        first = np.asarray(cut.offsets, dtype=np.int64)
        numbered = cut.values.dictionary_encode()
        word, distinct = np.array(numbered.indices)[first[0] :], numbered.dictionary
        first = first - first[0]
        del marked, cut, numbered
        if self.parted:
            bodies, tails = (part.dictionary_encode() for part in split_marks(distinct, blank=self.blank))
            own, chunks = bodies.indices, bodies.dictionary.to_numpy(zero_copy_only=False).tolist()
        else:
            own, tails, chunks = None, None, distinct.to_numpy(zero_copy_only=False).tolist()
        release()  # before chunks are learned
        word[first[:-1]] = len(distinct)  # before the line feed that was added
        get, old = self.ids.get, self.old.get
        found = list(map(get, chunks))
        missing = [c for c, f in zip(chunks, found, strict=True) if f is None]
        odd = set()
        if missing:
            again = [(c, v) for c in missing if (v := old(c)) is not None]
            self.ids.update(again)
            odd = {c for c in missing if not c or c[-1] in _GAPS or c[c[0] == "\n"] in _GAPS}
            self._learn(set(missing).difference([c for c, _ in again], odd))
            found = [get(c) or (self.feed if c[:1] == "\n" else b"") if f is None else f for c, f in zip(chunks, found, strict=True)]
        found, strange = pa.array(found, pa.large_binary()), np.array([c in odd for c in chunks] if odd else [], dtype=bool)
        if own is not None:
            ends = pa.array(self._tails(tails.dictionary.to_pylist()), pa.large_binary()).take(tails.indices)
            found = pc.binary_join_element_wise(found.take(own), ends, pa.scalar(b"", pa.large_binary()))
            strange = strange[np.asarray(own)] if odd else strange
        found = [found, pa.array([b""], pa.large_binary())]
        if self.feed:  # a text's first chunk goes without the line feed that was added
            begin = word[first[:-1] + 1]
            word[first[:-1] + 1] = np.arange(len(distinct) + 1, len(distinct) + 1 + len(begin), dtype=word.dtype)
            found.append(pa.array([v[len(self.feed) :] for v in found[0].take(pa.array(begin)).to_pylist()], pa.large_binary()))
        taken = pa.concat_arrays(found).take(pa.array(word))
        ends = np.frombuffer(taken.buffers()[1] or bytes(8), dtype=np.int64)[: len(word) + 1] // 4
        ids = np.frombuffer(taken.buffers()[2] or b"", dtype="<u4", count=int(ends[-1]))
        starts = ends[first]
        if odd:
            strange = np.r_[strange, False]
            strange = (np.r_[strange, strange[begin]] if self.feed else strange)[word]
            strange[first[:-1]] = False
            which = np.flatnonzero(np.add.reduceat(strange, first[:-1]) > 0)
            parts = [ids[a:b] for a, b in zip(starts[:-1], starts[1:], strict=True)]
            for k, blob in zip(which.tolist(), self._slowly([column[k].as_py() for k in which.tolist()]), strict=True):
                parts[k] = np.frombuffer(blob, dtype="<u4")
            ids, starts = np.concatenate(parts), np.r_[0, np.cumsum([len(p) for p in parts])]
        release()
        return ids, starts


_encoders: dict[str, ChunkEncoder] = {}
worker_caches.append(_encoders)


def encoder(path: str) -> ChunkEncoder:
    """The worker's encoder for a tokenizer file; it outlives the task when workers are reused."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    if path not in _encoders:
        _encoders.clear()
        _encoders[path] = ChunkEncoder(path)
    return _encoders[path]


def text_slices(batches: Iterator[pa.RecordBatch], column: str, size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut into slices with about so many bytes of text in the column, or one row."""
    for batch in batches:
        col = batch.column(column)
        wide = pa.types.is_large_string(col.type)
        offsets = np.frombuffer(col.buffers()[1], dtype=np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
        i = 0
        while i < batch.num_rows:
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, side="right")) - 1)
            yield batch.slice(i, j - i)
            i = j
