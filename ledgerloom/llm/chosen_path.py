"""N-gram Jaccard join by chosen paths.

Texts become sets of 64-bit hashes of their five-word shingles; equal sets are one node. In each run a node is put
into the buckets of the few shingles that a shared hash samples from its set, buckets that are still large are split
again by freshly sampled shingles, and small ones are brute-forced on 128 min-hashes of 8 bits. Runs are repeated
until a pair at the threshold is missed with a probability of 1 - recall at most. What the sketches find similar
(below the threshold) is gathered into candidate components; within these the full sets are compared as matrix
products, so links are exact.

A bucket only tells what is connected, so it gives a spanning forest of its similar members, not their pairs. In a
large bucket members are tied to leaders drawn by hash, one row a member, and only those that aren't connected yet
go on; nothing is capped. In verification a block of nodes is one packed row, so the rows for a group of G near
copies follow G: the G^2 / 2 comparisons that exact link counts need are products within a task.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, free_caches, ready, settings, stash, text_of
from .components import components
from .tokens import text_slices
from .wordhash import Words, mix

SHINGLE, THRESHOLD, RECALL = 5, Fraction(4, 5), 0.99999
#: Shingles sampled for a node at each level of a run, levels, and the largest bucket that is brute-forced.
PICKS, LEVELS, BUCKET = 4.0, 3, 2000
#: Min-hashes of a sketch, and the estimate from which two nodes are candidates: 5 deviations below a pair at .8.
SKETCH, ALIKE = 128, 0.62
#: Leaders drawn from a large bucket (about), estimates from which a member is tied to a leader, and from which it is
#: settled. A partner (.8) of a settled member resembles its leader by .7, so it is tied to it as well: 5 deviations.
LEADERS, TIED, SETTLED = 200, 0.5, 0.9
#: Nodes of a candidate component in one block, and the bytes of their sets.
BLOCK, BLOCK_BYTES = 600, 16 << 20
#: Joins with a selected part of the rows filter the other side before the shuffle, by Spark's Bloom filter of 8 MB at most.
_BLOOM = {"spark__sql__optimizer__runtime__bloomFilter__applicationSideScanSizeThreshold": "0", "spark__sql__optimizer__runtime__bloomFilter__creationSideThreshold": "1024g"}
_RNG = np.random.Generator(np.random.PCG64(77))
_MIN = _RNG.integers(1, 2**63, SKETCH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def runs_for(recall: float, picks: float = PICKS, levels: int = LEVELS, threshold: float = float(THRESHOLD)) -> int:
    """Runs after which a pair at the threshold has met in a last-level bucket with this probability.

    Two sets of Jaccard similarity J share at least J of the larger one, so of about `picks` sampled shingles they
    share none with a probability of exp(-J * picks) at most.
    """
    hit = (1 - math.exp(-threshold * picks)) ** levels
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - hit)))


def shingle_sets(column: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all rows, and where each row's begin (with the end).

    A text of fewer words than a shingle has one shingle of all its words; one without words has none.
    """
    words = Words(column)
    n_words = np.diff(words.first)
    hashes, row, _ = words.windows(size)
    for k in range(1, size):
        few = n_words == k
        if few.any():
            h, r, _ = words.windows(k)
            mine = few[r]
            hashes, row = np.r_[hashes, h[mine]], np.r_[row, r[mine]]
    order = np.lexsort((hashes, row))
    hashes, row = hashes[order], row[order]
    new = np.r_[True, (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])] if len(row) else np.zeros(0, bool)
    hashes, row = hashes[new], row[new]
    return hashes, np.searchsorted(row, np.arange(len(column) + 1))


def _signatures(runs: int, levels: int, picks: float, size: int):
    slots = mix(np.arange(1, runs * levels + 1, dtype=np.uint64)) | np.uint64(1)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_caches()
        for batch in text_slices(batches, "_text", 1 << 20):
            hashes, first = shingle_sets(batch.column("_text"), size)
            n = np.diff(first)
            full = np.flatnonzero(n > 0)
            raw = hashes.tobytes()
            node = [hashlib.md5(raw[8 * first[i] : 8 * first[i + 1]], usedforsecurity=False).digest() if n[i] else None for i in range(len(n))]
            sketch = np.empty((len(full), SKETCH), dtype=np.uint8)
            for k in range(SKETCH if len(full) else 0):
                sketch[:, k] = mix(np.minimum.reduceat(hashes * _MIN[k], first[full])) & np.uint64(0xFF)
            sketches = [None] * len(n)
            for i, s in zip(full.tolist(), sketch, strict=True):
                sketches[i] = s.tobytes()
            row = np.repeat(np.arange(len(n)), n)
            bar = np.minimum(picks / np.maximum(n, 1), 1.0)[row]
            at, slot = [], []
            for k, salt in enumerate(slots):
                chosen = np.flatnonzero((mix(hashes ^ salt) >> np.uint64(11)) * (1.0 / (1 << 53)) < bar)
                at.append(chosen)
                slot.append(np.full(len(chosen), k))
            at, slot = np.concatenate(at), np.concatenate(slot)
            order = np.lexsort((slot, row[at]))
            at, slot = at[order], slot[order]
            cell = np.bincount(row[at] * len(slots) + slot, minlength=len(n) * len(slots))
            inner = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(cell)].astype(np.int32)), pa.array(hashes[at].view(np.int64)))
            outer = pa.ListArray.from_arrays(pa.array((np.arange(len(n) + 1) * len(slots)).astype(np.int32)), inner)
            columns = [batch.column("_id"), batch.column("_sum"), pa.array(node, pa.binary()), pa.array(n.astype(np.int64)), pa.array(sketches, pa.binary()), outer]
            yield pa.RecordBatch.from_arrays(columns, names=["_id", "_sum", "node", "n", "sketch", "picks"])

    return sign


def alike(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated similarity of sketches, row by row."""
    return (a == b).mean(axis=-1)


def _matches(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Equal min-hashes of each sketch of a (row) and of b (column), a byte each."""
    out = np.empty((len(a), len(b)), dtype=np.uint8)
    for k, sketch in enumerate(b):
        out[:, k] = np.count_nonzero(a == sketch, axis=1)
    return out


def _pairs(nodes: list[bytes], sketches: np.ndarray, starts: np.ndarray) -> Iterator[tuple[bytes, bytes]]:
    """Edges that connect what is alike within each bucket: all pairs of tiny buckets, a spanning forest of the others."""
    sizes = np.diff(starts)
    small = np.flatnonzero((sizes > 1) & (sizes <= 4))
    for size in np.unique(sizes[small]):
        first = starts[:-1][small[sizes[small] == size]]
        for i in range(size):
            for j in range(i + 1, size):
                for k in first[alike(sketches[first + i], sketches[first + j]) >= ALIKE].tolist():
                    yield nodes[k + i], nodes[k + j]
    for g in np.flatnonzero(sizes > 4).tolist():
        at, own = int(starts[g]), sketches[starts[g] : starts[g + 1]]
        label = np.arange(len(own))
        for i in range(len(own) - 1):  # only what isn't connected with i yet is compared with it
            rest = i + 1 + np.flatnonzero(label[i + 1 :] != label[i])
            near = rest[alike(own[rest], own[i]) >= ALIKE]
            for k in near[np.unique(label[near], return_index=True)[1]].tolist():
                yield nodes[at + i], nodes[at + k]
                label[label == label[k]] = label[i]


def _edges(pairs: Iterator[tuple[bytes, bytes]]) -> pa.RecordBatch:
    a, b = zip(*pairs, strict=True) if (pairs := list(dict.fromkeys(pairs))) else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])


def _sketches(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(-1, SKETCH)


def _grouped(batches: Iterator[pa.RecordBatch], keys: list[str], rows: int) -> Iterator[pa.Table]:
    """Tables of whole groups from batches sorted by keys, of at least so many rows but for the last."""
    held: list[pa.Table] = []
    for batch in batches:
        held.append(pa.Table.from_batches([batch]))
        if sum(t.num_rows for t in held) < rows:
            continue
        table = pa.concat_tables(held).combine_chunks()
        new = _starts(table, keys)
        cut = int(new[-1])
        if cut:
            yield table.slice(0, cut)
        held = [table.slice(cut)]
    if held and sum(t.num_rows for t in held):
        yield pa.concat_tables(held).combine_chunks()


def _starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    new = np.zeros(table.num_rows, dtype=bool)
    new[:1] = True
    for k in keys:
        values = table.column(k).to_numpy(zero_copy_only=False)
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def brute_force(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidate edges of small buckets (`key, node, sketch`, sorted)."""
    for table in _grouped(batches, ["key"], 10_000):
        yield _edges(_pairs(table.column("node").to_pylist(), _sketches(table.column("sketch")), np.r_[_starts(table, ["key"]), table.num_rows]))


def _trees(hit: np.ndarray) -> np.ndarray:
    """The least member that each row can reach, in a symmetric matrix of links."""
    root = np.arange(len(hit))
    while True:
        least = [np.where(hit[k : k + 256], root[None, :], len(hit)).min(axis=1, initial=len(hit)) for k in range(0, len(hit), 256)]
        new = np.minimum(root, np.concatenate([*least, root[:0]]))
        new = np.minimum(new, new[new])
        if (new == root).all():
            return root
        root = new


def _follow(tied: float):
    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return follow_leaders(batches, tied)

    return follow


def follow_leaders(batches: Iterator[pa.RecordBatch], tied: float) -> Iterator[pa.RecordBatch]:
    """Blocks of large buckets, each with all leaders of its bucket as guests, to one row for each member.

    `label` is the root of the tree of the leader that the member resembles most, `ties` are the roots of other trees
    with leaders that it resembles, and settled are members so near to a leader that all their partners are tied to
    its tree. `main` is the root of the tree with most leaders.
    """
    for table in _grouped(batches, ["key", "part"], 4000):
        starts = np.r_[_starts(table, ["key", "part"]), table.num_rows].tolist()
        node, sketch = table.column("node").to_pylist(), _sketches(table.column("sketch"))
        guest = table.column("guest").to_numpy(zero_copy_only=False).astype(bool)
        keep, labels, settled, ties, main = np.flatnonzero(~guest), [], [], [], []
        for a, b in zip(starts[:-1], starts[1:], strict=True):
            leaders, members = a + np.flatnonzero(guest[a:b]), a + np.flatnonzero(~guest[a:b])
            if not len(leaders):
                labels, settled, ties = labels + [None] * len(members), settled + [False] * len(members), ties + [[]] * len(members)
                main += [None] * len(members)
                continue
            tree = _trees(_matches(sketch[leaders], sketch[leaders]) >= tied * SKETCH)
            like = _matches(sketch[members], sketch[leaders])
            best = like.argmax(axis=1)
            top = like[np.arange(len(members)), best]
            near = np.where(top >= tied * SKETCH, tree[best], -1)
            own = [[] for _ in members]
            order = np.argsort(tree, kind="stable")
            roots, first = np.unique(tree[order], return_index=True)
            other = (np.maximum.reduceat(like[:, order], first, axis=1) >= tied * SKETCH) & (near[:, None] != roots[None, :])
            for m, t in np.argwhere(other).tolist():
                own[m].append(node[leaders[roots[t]]])
            labels += [node[leaders[t]] if t >= 0 else None for t in near.tolist()]
            settled += (top >= SETTLED * SKETCH).tolist()
            ties += own
            main += [node[leaders[np.bincount(tree).argmax()]]] * len(members)
        arrays = [table.column(c).take(pa.array(keep)).combine_chunks() for c in ("run", "key", "node")]
        arrays = [x.chunk(0) if isinstance(x, pa.ChunkedArray) else x for x in arrays]
        yield pa.RecordBatch.from_arrays([*arrays, pa.array(labels, pa.binary()), pa.array(settled, pa.bool_()), pa.array(ties, pa.list_(pa.binary())), pa.array(main, pa.binary())], names=["run", "key", "node", "label", "settled", "ties", "main"])


def candidate_edges(nodes: DataFrame, runs: int, levels: int, bucket: int = BUCKET, leaders: int = LEADERS) -> DataFrame:
    """Edges (`a, b`) that connect the nodes (`node, sketch, picks`) which meet in a bucket and have similar sketches.

    Small buckets are brute-forced. Of a large one some leaders are drawn by hash and its members tied to those they
    resemble: a row a member. What is so near to a leader that its partners must resemble it too is settled; the
    others are split further, unless nearly all are in one tree anyway. Large buckets of the first run go first: those of
    other runs whose members are in one tree then aren't led again. After the last level leaders are drawn anew
    from what is left, four times as many each time, until it is small.
    """
    sketches, found = nodes.select(F.col("node").alias("_n"), "sketch"), []
    tasks = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # few bytes, much to compare: not to be coalesced

    def counted(members: DataFrame) -> DataFrame:
        """Buckets of two and more, with their size; the sizes are written so that hot buckets can be split in the join."""
        members = stash(members, "members")
        sizes = stash(members.groupBy(F.col("key").alias("_key")).agg(F.count("*").alias("size")).filter("size > 1"), "sizes")
        out = stash(members.join(sizes.filter("size > 1"), F.col("key") == F.col("_key")).drop("_key"), "buckets")
        discard(members, sizes)
        return out

    def brute(buckets: DataFrame) -> None:
        rows = buckets.select("key", "node").join(sketches, F.col("node") == F.col("_n")).select("key", "node", "sketch")
        found.append(stash(rows.repartition(tasks, "key").sortWithinPartitions("key", "node").mapInArrow(brute_force, "a binary, b binary"), "found"))

    def follow(rows: DataFrame, guest: Column, tied: float) -> DataFrame:
        """One row for each member (`run, key, node`) of large buckets, tied to the guests of its bucket."""
        parts = F.ceil(F.col("size") / bucket).cast("int")
        at = lambda p, guest: F.struct(p.cast("int").alias("part"), F.lit(guest).alias("guest"))
        own = F.array(at(F.pmod(F.xxhash64("node"), parts), False))
        places = F.when(guest, F.concat(own, F.transform(F.sequence(F.lit(0), parts - 1), lambda p: at(p, True)))).otherwise(own)
        rows = rows.join(sketches, F.col("node") == F.col("_n")).select("run", "key", "node", "sketch", F.explode(places).alias("_p")).select("run", "key", "_p.*", "node", "sketch")
        rows = rows.repartition(tasks, "key", "part").sortWithinPartitions("key", "part", "guest", "node")
        led = stash(rows.mapInArrow(_follow(tied), "run int, key long, node binary, label binary, settled boolean, ties array<binary>, main binary"), "led")
        found.append(led.select(F.col("node").alias("a"), F.col("label").alias("b")).unionAll(led.filter(F.size("ties") > 0).select("node", F.explode("ties"))).filter("a <> b"))
        return led

    def lead(large: DataFrame, salt: int, number: int) -> DataFrame:
        """Ties the members of large buckets to leaders drawn by hash; returns the members of buckets that must be split.

        Members outside of the tree with most leaders are strays. A few strays are guests once more, so that all who
        are open meet them, which ends the bucket: the others are in one tree.
        """
        led = follow(large, F.pmod(F.xxhash64("key", "node", F.lit(salt)), F.col("size")) < number, TIED)
        within = F.coalesce(F.col("label") == F.col("main"), F.lit(False))
        open_ = led.filter("not settled").select("run", "key", "node", within.alias("within"))
        state = open_.groupBy(F.col("key").alias("_key")).agg(F.count("*").alias("size"), F.count(F.when(~F.col("within"), 1)).alias("strays"))
        left = stash(open_.join(stash(state.filter("strays > 0"), "state"), F.col("key") == F.col("_key")).drop("_key"), "left")
        few = left.filter(F.col("strays") <= bucket)
        if not few.isEmpty():
            follow(few, ~F.col("within"), ALIKE)
        return left.filter(F.col("strays") > bucket).select("run", "key", "node")

    def unconnected(large: DataFrame, edges: list[DataFrame]) -> DataFrame:
        """Buckets whose members aren't all in one tree of edges; where they are, nothing new can come of them."""
        known = edges[0]
        for more in edges[1:]:
            known = known.unionAll(more)
        trees = components(known).withColumnsRenamed({"node": "_n", "root": "_root"})
        placed = stash(large.join(trees, F.col("node") == F.col("_n"), "left").select(*large.columns, "_root"), "placed")
        one = placed.groupBy(F.col("key").alias("_key")).agg(((F.count("_root") == F.count("*")) & (F.min("_root") == F.max("_root"))).alias("_one")).filter("_one")
        return stash(placed.join(one, F.col("key") == F.col("_key"), "left_anti").select(*large.columns), "unconnected")

    members = nodes.select("node", F.posexplode(F.slice("picks", 1, runs)).alias("run", "_p")).select("run", "node", F.explode("_p").alias("_t")).select("run", F.xxhash64("run", "_t").alias("key"), "node")
    level, number = 0, leaders
    with settings(nodes.sparkSession, **_BLOOM):
        while True:
            buckets = counted(members)
            brute(buckets.filter(F.col("size") <= bucket))
            large = stash(buckets.filter(F.col("size") > bucket), "large")
            discard(buckets)
            if large.isEmpty():
                break
            if level == 0:
                first = large.filter("run = 0")
                own = len(found)
                members = lead(first, level, number)
                if runs > 1:
                    members = members.unionAll(lead(unconnected(large.filter("run > 0"), found[own:]), level, number))
            else:
                members = lead(large.filter(F.col("size") > bucket), level, number)
            level += 1
            if level < levels:
                deeper = members.join(nodes.select(F.col("node").alias("_n"), "picks"), F.col("node") == F.col("_n"))
                members = deeper.select("run", "key", "node", F.explode(F.get("picks", F.lit(level * runs) + F.col("run"))).alias("_t")).select("run", F.xxhash64("key", "_t").alias("key"), "node")
            else:
                number *= 4
    edges = found[0]
    for more in found[1:]:
        edges = edges.unionAll(more)
    return edges


def _links(overlap: np.ndarray, n: np.ndarray, m: np.ndarray, threshold: Fraction) -> np.ndarray:
    """Where overlap / (n + m - overlap) is at least the threshold, in whole numbers."""
    p, q = threshold.numerator, threshold.denominator
    return overlap.astype(np.int64) * (p + q) >= p * (n[:, None] + m[None, :])


def _overlaps(left: list[np.ndarray], right: list[np.ndarray] | None = None) -> np.ndarray:
    """Sizes of all intersections (of left with itself if there is no right), as products of 0/1 matrices over the shingles that two sets or more share."""
    sets = left + (right or [])
    n, split = len(sets), len(left)
    flat, own = np.concatenate(sets), np.repeat(np.arange(n), [len(s) for s in sets])
    if n == 2 and right is None:
        return np.array([[len(sets[0]), x := len(flat) - len(np.unique(flat))], [x, len(sets[1])]])
    _, inverse, counts = np.unique(flat, return_inverse=True, return_counts=True)
    shared = counts[inverse] > 1
    number = np.cumsum(counts > 1) - 1
    column, own = number[inverse[shared]], own[shared]
    out, step = np.zeros((split, n if right is None else n - split), dtype=np.float32), max(256, 4_000_000 // n)
    order = np.argsort(column, kind="stable")
    column, own = column[order], own[order]
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, step):
        a, b = np.searchsorted(column, [lo, lo + step])
        m = np.zeros((n, min(step, int(column[-1]) + 1 - lo)), dtype=np.float32)
        m[own[a:b], column[a:b] - lo] = 1
        out += m @ m.T if right is None else m[:split] @ m[split:].T
    out = np.rint(out).astype(np.int64)
    if right is None:
        np.fill_diagonal(out, [len(s) for s in left])
    return out


BLOCKS = "comp binary, block int, parts int, nodes array<binary>, weights array<long>, links array<long>, roots array<binary>, sizes array<int>, sets binary"


def _within(threshold: Fraction):
    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks of candidate components (`comp, block, parts, node, weight, shingles`, sorted) to one row each: links within, local roots, and the packed sets where other blocks follow."""
        for table in _grouped(batches, ["comp", "block"], 500):
            table = table.take(pa.array(_starts(table, ["comp", "block", "node"]))).combine_chunks()
            starts = np.r_[_starts(table, ["comp", "block"]), table.num_rows].tolist()
            node, weight, parts = table.column("node").to_pylist(), table.column("weight").to_numpy(), table.column("parts").to_numpy()
            shingles = table.column("shingles").combine_chunks()
            shingles = shingles.chunk(0) if isinstance(shingles, pa.ChunkedArray) else shingles
            out: list[list] = [[] for _ in range(6)]
            for a, b in zip(starts[:-1], starts[1:], strict=True):
                sets = [np.frombuffer(shingles[k].as_buffer(), dtype="<u8") for k in range(a, b)]
                n = np.array([len(s) for s in sets])
                hit = _links(_overlaps(sets), n, n, threshold)
                np.fill_diagonal(hit, False)
                more = parts[a] > 1
                row = (node[a:b], weight[a:b], hit @ weight[a:b], [node[a + k] for k in _trees(hit).tolist()], n.astype(np.int32) if more else None, pa.compress(np.concatenate(sets).tobytes(), "zstd", asbytes=True) if more else None)
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            kinds = [pa.list_(pa.binary()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.binary()), pa.list_(pa.int32()), pa.binary()]
            at = pa.array(starts[:-1], pa.int64())
            head = [table.column(c).take(at).combine_chunks() for c in ("comp", "block", "parts")]
            head = [x.chunk(0) if isinstance(x, pa.ChunkedArray) else x for x in head]
            yield pa.RecordBatch.from_arrays([*head, *[pa.array(c, k) for c, k in zip(out, kinds, strict=True)]], names=["comp", "block", "parts", "nodes", "weights", "links", "roots", "sizes", "sets"])

    return within


def _unpacked(sets: bytes, sizes: list[int]) -> list[np.ndarray]:
    flat = np.frombuffer(pa.decompress(sets, 8 * sum(sizes), "zstd", asbytes=True), dtype="<u8")
    return np.split(flat, np.cumsum(sizes)[:-1])


def _bridges(hit: np.ndarray, left: list[bytes], right: list[bytes]) -> list[tuple[bytes, bytes]]:
    """Edges of a spanning forest between the trees (named by their roots) of two blocks."""
    names = {r: k for k, r in enumerate(dict.fromkeys([*left, *right]))}
    i, j = np.array([names[r] for r in left]), np.array([names[r] for r in right])
    a, b = np.nonzero(hit)
    pairs, label, back, out = np.unique(np.stack([i[a], j[b]], axis=1), axis=0), list(range(len(names))), list(names), []

    def top(x: int) -> int:
        while label[x] != x:
            label[x] = x = label[label[x]]
        return x

    for x, y in pairs.tolist():
        if (p := top(x)) != (q := top(y)):
            label[p] = q
            out.append((back[x], back[y]))
    return out


def _across(threshold: Fraction):
    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pairs of blocks of one component (`comp, i, j`, then a row of BLOCKS for each, sorted) to links by block and edges between their trees: one row a pair."""
        for table in _grouped(batches, ["comp", "i", "j"], 2):
            rows = table.to_pylist()
            out = []
            for x, y in zip(rows[::2], rows[1::2], strict=True):
                n, m = np.array(x["sizes"]), np.array(y["sizes"])
                hit = _links(_overlaps(_unpacked(x["sets"], x["sizes"]), _unpacked(y["sets"], y["sizes"])), n, m, threshold)
                edges = _bridges(hit, x["roots"], y["roots"])
                out.append({"comp": x["comp"], "i": x["i"], "j": x["j"], "links_i": hit @ np.array(y["weights"]), "links_j": hit.T @ np.array(x["weights"]), "a": [e[0] for e in edges], "b": [e[1] for e in edges]})
            kinds = {"comp": pa.binary(), "i": pa.int32(), "j": pa.int32(), "links_i": pa.list_(pa.int64()), "links_j": pa.list_(pa.int64()), "a": pa.list_(pa.binary()), "b": pa.list_(pa.binary())}
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in kinds.items()], names=list(kinds))

    return across


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Link counts of blocks (`comp, block, nodes, links`, sorted, nodes in one row of a block) added up, to a row a block."""
    for table in _grouped(batches, ["comp", "block"], 50):
        starts = np.r_[_starts(table, ["comp", "block"]), table.num_rows].tolist()
        nodes, links = table.column("nodes").to_pylist(), table.column("links").to_pylist()
        named = [next(n for n in nodes[a:b] if n is not None) for a, b in zip(starts[:-1], starts[1:], strict=True)]
        total = [np.sum(np.array(links[a:b], dtype=np.int64), axis=0) for a, b in zip(starts[:-1], starts[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(named, pa.list_(pa.binary())), pa.array(total, pa.list_(pa.int64()))], names=["nodes", "links"])


def verified(sets: DataFrame, threshold: Fraction) -> tuple[DataFrame, DataFrame]:
    """Links counted for each node (`node, links`) and edges (`a, b`) that connect what is linked, from rows `comp, block, parts, node, weight, shingles`.

    A block of a component is one row from here on. Blocks of one component meet pair by pair; a pair gives one row with the
    links of both blocks' nodes, which are added up block by block, and edges between trees alone.
    """
    blocks = stash(sets.repartition("comp", "block").sortWithinPartitions("comp", "block", "node").mapInArrow(_within(threshold), BLOCKS), "blocks")
    edges = blocks.select(F.inline(F.arrays_zip(F.col("nodes").alias("a"), F.col("roots").alias("b"))))
    single = blocks.filter("parts = 1").select(F.inline(F.arrays_zip(F.col("nodes").alias("node"), F.col("links").alias("links"))))
    large = blocks.filter("parts > 1")
    if large.isEmpty():
        return single, edges.filter("a <> b")
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    met = large.withColumn("_o", other).filter("_o <> block").select("comp", F.least("block", "_o").alias("i"), F.greatest("block", "_o").alias("j"), "block", "weights", "roots", "sizes", "sets")
    pairs = stash(met.repartition("comp", "i", "j").sortWithinPartitions("comp", "i", "j", "block").mapInArrow(_across(threshold), "comp binary, i int, j int, links_i array<long>, links_j array<long>, a array<binary>, b array<binary>"), "pairs")
    none = F.lit(None).cast("array<binary>")
    parts = large.select("comp", "block", "nodes", "links").unionAll(pairs.select("comp", F.col("i"), none, F.col("links_i"))).unionAll(pairs.select("comp", F.col("j"), none, F.col("links_j")))
    sums = parts.repartition("comp", "block").sortWithinPartitions("comp", "block").mapInArrow(_summed, "nodes array<binary>, links array<long>")
    links = single.unionAll(sums.select(F.inline(F.arrays_zip(F.col("nodes").alias("node"), F.col("links").alias("links")))))
    return links, edges.unionAll(pairs.select(F.inline(F.arrays_zip("a", "b")))).filter("a <> b")


def _with_shingles(size: int):
    def attach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "_text", 4 << 20):
            hashes, first = shingle_sets(batch.column("_text"), size)
            raw, at = hashes.tobytes(), (8 * first).tolist()
            names = ["comp", "node", "weight", "parts"]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array([raw[a:b] for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary())], names=[*names, "shingles"])

    return attach


def jaccard_join(docs: DataFrame, threshold: Fraction = THRESHOLD, recall: float = RECALL, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`_id, _sum, class_id, class_sum, n_links, n_copies` for every row of docs.

    n_links is the number of other documents whose shingle set has a Jaccard similarity of at least the threshold,
    copies included; n_copies the number with an equal set, itself included. A class is a connected component of
    the links; class_id and class_sum (a hash of the text) are those of its first document.

    Null, empty or blank text: no shingles, no links, a class of its own. Fewer words than a shingle: one shingle.
    Repeated rows are copies of each other. Null id: a document before all others. Empty table: empty result.
    """
    ready(docs.sparkSession)
    runs = runs_for(recall, threshold=float(threshold))
    keyed = docs.select(F.col(f"`{id_col}`").cast("long").alias("_id"), text_of(text_col).alias("_text")).withColumn("_sum", F.xxhash64("_text"))
    signed = keyed.mapInArrow(_signatures(runs, LEVELS, PICKS, shingle), "_id long, _sum long, node binary, n long, sketch binary, picks array<array<long>>")
    # Picks of the first level are told apart in the whole table, deeper ones within a bucket: 31 bits do for these, and equal ones stay equal.
    deeper = F.transform(F.slice("picks", runs + 1, runs * (LEVELS - 1)), lambda p: F.transform(p, lambda t: t.bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")))
    signed = stash(signed.select("_id", "_sum", "node", "n", "sketch", F.slice("picks", 1, runs).alias("picks"), deeper.alias("deeper")), "signatures")
    first = F.min(F.struct("_id", "_sum", "n", "sketch", "picks", "deeper"))
    nodes = stash(signed.filter("node is not null").groupBy("node").agg(first.alias("_rep"), F.count("*").alias("weight")).select("node", "weight", "_rep.*"), "nodes")
    rows = stash(signed.select("_id", "_sum", "node"), "rows")
    discard(signed)
    picks = F.concat("picks", F.transform("deeper", lambda p: p.cast("array<long>")))
    comps = components(candidate_edges(nodes.select("node", "sketch", picks.alias("picks")), runs, LEVELS))
    slim = stash(nodes.select("node", "weight", "n", "_id", "_sum"), "slim")  # from here on nobody reads sketches and picks
    discard(nodes)
    copies = slim.select("node", "weight", F.struct("_id", "_sum").alias("_rep"))
    placed = stash(slim.join(comps.withColumnRenamed("node", "_cn"), F.col("node") == F.col("_cn")).select(F.col("_id").alias("_pi"), F.col("_sum").alias("_ps"), "node", "weight", "n", F.col("root").alias("comp")), "placed")
    parts = F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n") * 8 / BLOCK_BYTES)).cast("int")
    sizes = stash(placed.groupBy(F.col("comp").alias("_root")).agg(parts.alias("parts")), "sizes")
    placed = stash(placed.join(sizes, F.col("comp") == F.col("_root")).drop("_root", "n"), "placed")
    # One hashed key, so that the Bloom filter spares the shuffle most texts; the ids are compared as well.
    same = F.coalesce("_id", F.lit(0)).bitwiseXOR(F.coalesce("_pi", F.lit(0))) == 0
    texts = keyed.withColumn("_k", F.xxhash64("_id", "_sum")).join(placed.filter("parts >= 1").withColumn("_pk", F.xxhash64("_pi", "_ps")), (F.col("_k") == F.col("_pk")) & same)  # repeated rows come twice
    sets = texts.select("comp", "node", "weight", "parts", "_text").mapInArrow(_with_shingles(shingle), "comp binary, node binary, weight long, parts int, shingles binary")
    with settings(docs.sparkSession, **_BLOOM):
        links, edges = verified(sets.withColumn("block", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")), threshold)
    links = links.withColumnRenamed("node", "_ln")
    classes = components(edges).select(F.col("node").alias("_cn"), F.col("root").alias("_cr"))
    whole = copies.join(classes, F.col("node") == F.col("_cn"), "left").join(links, F.col("node") == F.col("_ln"), "left")
    whole = stash(whole.select("node", "_rep", "weight", F.coalesce("_cr", "node").alias("_class"), (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links")), "nodes")
    firsts = stash(whole.groupBy(F.col("_class").alias("_fc")).agg(F.min("_rep").alias("_first")), "firsts")
    info = stash(whole.join(firsts, F.col("_class") == F.col("_fc")).select(F.col("node").alias("_in"), "n_links", "weight", "_first"), "classes")
    joined = rows.join(info, F.col("node") == F.col("_in"), "left")
    none = F.col("_in").isNull()
    return joined.select(
        "_id",
        "_sum",
        F.when(none, F.col("_id")).otherwise(F.col("_first._id")).alias("class_id"),
        F.when(none, F.col("_sum")).otherwise(F.col("_first._sum")).alias("class_sum"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("weight", F.lit(1)).cast("long").alias("n_copies"),
    )


def keep_one(docs: DataFrame, **params) -> DataFrame:
    """The rows of docs that are the first of their class (least id, then hash of the text), once each, all columns as they were."""
    id_col, text_col = params.get("id_col", "doc_id"), params.get("text_col", "text")
    found = jaccard_join(docs, **params)
    gone = found.filter(~(F.col("_id").eqNullSafe(F.col("class_id")) & (F.col("_sum") == F.col("class_sum")))).select(F.col("_id").alias("_gi"), F.col("_sum").alias("_gs")).distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(f"`{id_col}`").cast("long").alias("_id"), F.xxhash64(text_of(text_col)).alias("_sum"))
    return rows.join(gone, F.col("_id").eqNullSafe(F.col("_gi")) & (F.col("_sum") == F.col("_gs")), "left_anti").dropDuplicates(["_id", "_sum"]).select("_row.*")


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return jaccard_join(docs).select(F.col("_id").alias("doc_id"), "class_id", "n_links", "n_copies")
