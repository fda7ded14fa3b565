"""Merge-type (BPE) encoding by an agenda of adjacent symbol pairs in order of their score.

Two forms of one procedure: `encode_one` keeps a heap of pairs for a single chunk; `encode_many` and `encode_flat` take the best pair
of every chunk in each round, for many short chunks at once in arrays. Both merge the pair with the highest score,
the leftmost among equals, until no adjacent pair is in the vocabulary. Characters outside it become byte ids.
"""

from __future__ import annotations

import heapq

import numpy as np

#: The mark that a space becomes.
SPACE = "▁"
#: Chunks of more characters go through the heap.
LONG = 48


class MergeTable:
    """Pieces, scores and the pairs of pieces that merge, from a sentencepiece model of the merge type."""

    def __init__(self, processor):
        size = processor.get_piece_size()
        normal = [i for i in range(size) if not (processor.is_control(i) or processor.is_unknown(i) or processor.is_byte(i) or processor.is_unused(i))]
        self.pieces = {processor.id_to_piece(i): i for i in normal}
        self.bytes = [processor.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        scores = {i: processor.get_score(i) for i in normal}
        level = {s: k for k, s in enumerate(sorted(set(scores.values())))}
        self.level = np.zeros(size, dtype=np.int64)  # a higher level merges first, equal scores share one
        for i in normal:
            self.level[i] = level[scores[i]]
        pairs = {}
        for piece, i in self.pieces.items():
            for k in range(1, len(piece)):
                a, b = self.pieces.get(piece[:k], -1), self.pieces.get(piece[k:], -1)
                if a >= 0 and b >= 0:
                    pairs[(a, b)] = i
        self.pairs = pairs
        self._hash(pairs)
        single = {ord(p): i for p, i in self.pieces.items() if len(p) == 1}
        self.char = np.full(max(single) + 1, -1, dtype=np.int64)
        for c, i in single.items():
            self.char[c] = i

    def _hash(self, pairs: dict[tuple[int, int], int]) -> None:
        """An open-addressed table, so that arrays of pairs are looked up in a few vector steps."""
        bits = max(8, int(len(pairs) * 4).bit_length())
        self.mask, self.keys, self.values = (1 << bits) - 1, np.full(1 << bits, -1, dtype=np.int64), np.full(1 << bits, -1, dtype=np.int64)
        self.steps = 0
        for (a, b), i in pairs.items():
            key = a << 20 | b
            at, n = self._slot(key), 1
            while self.keys[at] >= 0:
                at, n = (at + 1) & self.mask, n + 1
            self.keys[at], self.values[at], self.steps = key, i, max(self.steps, n)

    def _slot(self, key):
        return (key * 0x9E3779B1 >> 13) & self.mask

    def merged(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The piece that each pair merges to, or -1; -1 in a or b never merges."""
        key = (a << 20) | b
        out = np.full(len(a), -1, dtype=np.int64)
        todo = np.flatnonzero((a >= 0) & (b >= 0))
        at = self._slot(key[todo])
        for _ in range(self.steps):
            held = self.keys[at]
            hit = held == key[todo]
            out[todo[hit]] = self.values[at[hit]]
            on = ~hit & (held >= 0)
            todo, at = todo[on], (at[on] + 1) & self.mask
            if not len(todo):
                break
        return out

    def _ids(self, symbol: int, char: str) -> list[int]:
        return [symbol] if symbol >= 0 else [self.bytes[b] for b in char.encode("utf-8", "surrogatepass")]

    def encode_one(self, chunk: str) -> list[int]:
        """With a heap of (level, position) and links between the symbols that are left."""
        n = len(chunk)
        symbol = [self.pieces.get(c, -1) for c in chunk]
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        agenda: list[tuple[int, int, int, int, int]] = []

        def offer(i: int, j: int) -> None:
            if i >= 0 and j >= 0 and (m := self.pairs.get((symbol[i], symbol[j]), -1)) >= 0:
                heapq.heappush(agenda, (-int(self.level[m]), i, j, m, symbol[i] << 20 | symbol[j]))

        for i in range(n - 1):
            offer(i, i + 1)
        alive = [True] * n
        while agenda:
            _, i, j, m, was = heapq.heappop(agenda)
            if not (alive[i] and alive[j] and after[i] == j and symbol[i] << 20 | symbol[j] == was):
                continue
            symbol[i], alive[j] = m, False
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            offer(before[i], i)
            offer(i, after[i])
        return [x for i in range(n) if alive[i] for x in self._ids(symbol[i], chunk[i])]

    def encode_many(self, chunks: list[str]) -> list[list[int]]:
        """Ids of every chunk."""
        flat, ends = self.encode_flat(chunks)
        flat, ends = flat.tolist(), ends.tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def encode_flat(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all chunks, one after the other, and where each chunk's end."""
        sizes = np.fromiter(map(len, chunks), dtype=np.int64, count=len(chunks))
        long = sizes > LONG
        if not long.any():
            flat, counts = self._rounds(chunks, sizes)
            return flat, np.cumsum(counts)
        one = [np.array(self.encode_one(chunks[k]), dtype=np.int64) for k in np.flatnonzero(long).tolist()]
        counts = np.zeros(len(chunks), dtype=np.int64)
        some, counts[~long] = self._rounds([c for c in chunks if len(c) <= LONG], sizes[~long])
        counts[long] = [len(x) for x in one]
        flat, own = np.empty(counts.sum(), dtype=np.int64), np.repeat(long, counts)
        flat[own], flat[~own] = np.concatenate(one), some
        return flat, np.cumsum(counts)

    def _rounds(self, chunks: list[str], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all chunks and their numbers; rounds over flat arrays, each with the best pair of every chunk that still has one."""
        if not sizes.any():
            return np.zeros(0, dtype=np.int64), np.zeros(len(chunks), dtype=np.int64)
        code = np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
        symbol = np.where(code < len(self.char), self.char[np.minimum(code, len(self.char) - 1)], -1)
        symbol = np.where(symbol < 0, -1 - code, symbol)  # outside the vocabulary: the character itself, negative
        own = np.repeat(np.arange(len(chunks)), sizes)
        done_symbols, done_own = [], []
        merge = np.full(len(symbol), -1, dtype=np.int64)
        merge[:-1] = self.merged(symbol[:-1], symbol[1:])
        merge[:-1][own[:-1] != own[1:]] = -1
        while len(symbol):
            starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            rank = np.where(merge >= 0, (self.level[merge] + 1 << 32) - np.arange(len(symbol)), -1)
            top = np.maximum.reduceat(rank, starts)
            over = np.repeat(top < 0, np.diff(np.r_[starts, len(symbol)]))
            if over.any():
                done_symbols.append(symbol[over])
                done_own.append(own[over])
                keep = ~over
                symbol, own, merge, rank = symbol[keep], own[keep], merge[keep], rank[keep]
                if not len(symbol):
                    break
                starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
                top = top[top >= 0]
            at = np.flatnonzero(rank == np.repeat(top, np.diff(np.r_[starts, len(symbol)])))
            symbol[at] = merge[at]
            keep = np.ones(len(symbol), dtype=bool)
            keep[at + 1] = False
            at -= np.arange(len(at))  # where they are once the right halves are gone
            symbol, own, merge = symbol[keep], own[keep], merge[keep]
            for i in (at, at[at > 0] - 1):
                i = i[i < len(symbol) - 1]
                new = self.merged(symbol[i], symbol[i + 1])
                new[own[i] != own[i + 1]] = -1
                merge[i] = new
            merge[-1] = -1
        symbol, own = np.concatenate(done_symbols), np.concatenate(done_own)
        order = np.argsort(own, kind="stable")
        symbol, own = symbol[order], own[order]
        if (symbol < 0).any():  # bytes of the characters outside the vocabulary
            ids, whose = [], []
            for s, w in zip(symbol.tolist(), own.tolist(), strict=True):
                got = self._ids(s, "" if s >= 0 else chr(-1 - s))
                ids += got
                whose += [w] * len(got)
            symbol, own = np.array(ids, dtype=np.int64), np.array(whose, dtype=np.int64)
        return symbol, np.bincount(own, minlength=len(chunks))
