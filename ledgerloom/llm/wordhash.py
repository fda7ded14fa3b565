"""Words of Arrow string columns and hashes of their windows, in numpy, without a Python object for a word.

Words are maximal runs of bytes other than ASCII white space. A word's hash is a sum of its bytes' values, each times a
random weight of its place in the word: a polynomial mod 2^64 has words of two letters that collide whatever its base.
A window's hash is a Rabin-Karp polynomial in the hashes of its words. Both are mixed at the end.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Bytes hashed at once; a block ends between two words.
BLOCK = 2 << 20
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTE = np.random.Generator(np.random.PCG64(20240)).integers(1, 2**63, 256, dtype=np.uint64)
_WORD_BASE = 0xD1342543DE82EF95


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every bit of h."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class _Powers:
    """base^i and base^-i mod 2^64, made as far as they are asked for."""

    def __init__(self, base: int):
        self.bases, self.held = (base, pow(base, -1, 1 << 64)), [np.ones(1, np.uint64)] * 2

    def upto(self, n: int) -> list[np.ndarray]:
        if len(self.held[0]) < n:
            for k, b in enumerate(self.bases):
                steps = np.full(n, b, dtype=np.uint64)
                steps[0] = 1
                self.held[k] = np.multiply.accumulate(steps)
        return self.held


_word_powers = _Powers(_WORD_BASE)
_weights = mix(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def _weights_upto(n: int) -> np.ndarray:
    """Weights of the places in a word, made as far as the longest word asks."""
    global _weights
    if len(_weights) < n:
        _weights = mix(np.arange(1, 2 * n + 1, dtype=np.uint64)) | np.uint64(1)
    return _weights


class Words:
    """Words of the rows of a string column: `start`, `end` (bytes in data), `row`, `hash`, and `first` (of each row, with the end)."""

    def __init__(self, column: pa.Array):
        wide = pa.types.is_large_string(column.type)
        buffers = column.buffers()
        offsets = np.frombuffer(buffers[1], dtype=np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
        data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
        lo, hi = (int(offsets[0]), int(offsets[-1])) if len(offsets) else (0, 0)
        self.data, offsets = data[lo:hi], offsets - lo
        word = ~_SPACE[self.data]
        edge = np.zeros(len(word) + 1, dtype=bool)
        edge[offsets] = True  # words end where rows do
        self.start = np.flatnonzero(word & np.r_[True, ~word[:-1]] | word & edge[:-1]) if len(word) else np.zeros(0, np.int64)
        self.end = np.flatnonzero(word & np.r_[~word[1:], True] | word & edge[1:]) + 1 if len(word) else np.zeros(0, np.int64)
        self.first = np.searchsorted(self.start, offsets, side="left")
        self.row = np.repeat(np.arange(len(column)), np.diff(self.first))
        self.hash = self._hashes()

    def _hashes(self) -> np.ndarray:
        out = np.empty(len(self.start), dtype=np.uint64)
        i = 0
        while i < len(out):
            base = self.start[i]
            j = max(i + 1, int(np.searchsorted(self.end, base + BLOCK, side="right")))
            size = self.end[i:j] - self.start[i:j]
            begins = np.cumsum(size) - size
            place = np.arange(int(begins[-1] + size[-1])) - np.repeat(begins, size)
            values = _BYTE[self.data[np.repeat(self.start[i:j], size) + place]] * _weights_upto(int(size.max()))[place]
            out[i:j] = mix(np.add.reduceat(values, begins) + size.astype(np.uint64))
            i = j
        return out

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash, row and first word (within the row) of every window of so many words, rows in order."""
        n = len(self.hash)
        if n < size:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.flatnonzero(self.row[: n - size + 1] == self.row[size - 1 :])
        step, out = 1 << 20, np.empty(len(at), dtype=np.uint64)
        for i in range(0, len(at), step):
            w = at[i : i + step]
            lo, hi = int(w[0]), int(w[-1]) + size
            up, down = _word_powers.upto(hi - lo)
            sums = np.zeros(hi - lo + 1, dtype=np.uint64)
            np.cumsum(self.hash[lo:hi] * up[: hi - lo], out=sums[1:])
            out[i : i + step] = mix((sums[w - lo + size] - sums[w - lo]) * down[w - lo])
        return out, self.row[at], at - self.first[self.row[at]]
