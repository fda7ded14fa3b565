"""Bin completion over a histogram of lengths: which lengths share a sequence, and how often.

The search works on counts of lengths, so its size depends on the capacity and not on the number of documents.
A node takes the largest length left, lists undominated fillings of the room beside it, and uses a filling as often
as the counts allow. Best-fit decreasing gives the first incumbent; a branch is cut when its waste so
far rules out fewer sequences than the incumbent's. The search is depth-first and stops at the lower bound (of total
length, and of the sequences that large lengths force) or after a stated number of nodes, with the best packing found.
"""

from __future__ import annotations

from bisect import bisect_right

#: Fillings tried at a node, and nodes in all. Only the quality of the packing depends on them; nothing is left out.
WIDTH, NODES = 4, 6000

Pattern = tuple[tuple[int, ...], int]


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """The larger of total length over capacity and, for every threshold, the bins that large lengths force."""
    total = sum(n * c for n, c in counts.items())
    best = -(-total // capacity)
    order = sorted(counts)
    below = [0]
    for n in order:
        below.append(below[-1] + n * counts[n])
    number = [0]
    for n in order:
        number.append(number[-1] + counts[n])
    upto = lambda x: bisect_right(order, x)
    for k in {0, *(n for n in order if 2 * n <= capacity)}:
        big = number[-1] - number[upto(capacity - k)]  # beside these nothing of k or more fits
        mid = number[upto(capacity - k)] - number[upto(capacity // 2)]
        mid_sum = below[upto(capacity - k)] - below[upto(capacity // 2)]
        small = below[upto(capacity // 2)] - below[upto(k - 1)]
        best = max(best, big + mid + max(0, -(-(small - (mid * capacity - mid_sum)) // capacity)))
    return best


def best_fit(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Best-fit decreasing, with equal bins handled together."""
    open_bins: dict[tuple[int, ...], int] = {}
    by_room: dict[int, set[tuple[int, ...]]] = {}

    def put(bin_: tuple[int, ...], number: int) -> None:
        open_bins[bin_] = open_bins.get(bin_, 0) + number
        by_room.setdefault(capacity - sum(bin_), set()).add(bin_)

    for n in sorted(counts, reverse=True):
        left = counts[n]
        while left:
            rooms = [r for r, bins in by_room.items() if r >= n and bins]
            if not rooms:
                each = capacity // n
                if left >= each:
                    put((n,) * each, left // each)
                if left % each:
                    put((n,) * (left % each), 1)
                break
            room = min(rooms)
            old = min(by_room[room])
            used = min(left, open_bins[old])
            open_bins[old] -= used
            if not open_bins[old]:
                del open_bins[old]
                by_room[room].discard(old)
            put((*old, n), used)
            left -= used
    return sorted(open_bins.items())


def fillings(counts: list[int], room: int, top: int, width: int) -> list[tuple[int, ...]]:
    """Undominated fillings of room by lengths of at most top, least waste first.

    counts[n] is the number left of length n. A filling is dominated if one with as few lengths has each at least
    as long, or if a single length is as long as the room: an exact single beats every other filling.
    """
    room_top = min(room, top)
    if room_top <= 0:
        return [()]
    floor = [0] * (room + 1)  # the largest length there is up to each size
    for n in range(1, room + 1):
        floor[n] = n if n <= room_top and counts[n] else floor[n - 1]
    first = floor[room]
    if not first:
        return [()]
    if first == room:
        return [(room,)]
    found: dict[tuple[int, ...], int] = {}

    def complete(head: tuple[int, ...], left: int) -> tuple[int, ...]:
        """Fills the rest greedily by the largest length that fits."""
        out = list(head)
        n = floor[min(left, out[-1])]
        while n:
            spare = counts[n] - out.count(n)
            take = min(spare, left // n)
            out += [n] * take
            left -= take * n
            n = floor[min(left, n - 1)]
        return tuple(out)

    a, tried = first, 0
    while a and tried < 400:
        f = complete((a,), room - a)
        found[f] = room - sum(f)
        b, inner = floor[min(a, room - a)], 0
        while b and inner < 12 and tried < 60:  # exact triples and longer
            if b < a or counts[a] > 1:
                g = complete((a, b), room - a - b)
                found[g] = room - sum(g)
            b, inner = floor[b - 1], inner + 1
        a, tried = floor[a - 1], tried + 1
        if tried >= 8 and sum(not w for w in found.values()) >= width:
            break
    order = sorted(found, key=lambda f: (found[f], len(f), [-n for n in f]))
    out: list[tuple[int, ...]] = []
    for f in order:
        if not any(len(g) <= len(f) and all(x >= y for x, y in zip(g, f[: len(g)], strict=True)) and (len(g) == len(f) or sum(f[len(g) - 1 :]) <= g[-1]) for g in out):
            out.append(f)
        if len(out) == width:
            break
    return out


def pack_counts(counts: dict[int, int], capacity: int, width: int = WIDTH, nodes: int = NODES) -> list[Pattern]:
    """Patterns (lengths in descending order) with multiplicities that use every length as often as counted."""
    if any(n < 1 or n > capacity for n in counts):
        raise ValueError("lengths must be from 1 to the capacity")
    counts = {n: c for n, c in counts.items() if c > 0}
    incumbent = best_fit(counts, capacity)
    best = sum(m for _, m in incumbent)
    bound = lower_bound(counts, capacity)
    total = sum(n * c for n, c in counts.items())
    left = [0] * (capacity + 1)
    for n, c in counts.items():
        left[n] = c
    path: list[Pattern] = []
    used = waste = seen = 0

    def largest(n: int) -> int:
        while n and not left[n]:
            n -= 1
        return n

    def options(n: int) -> list[tuple[int, ...]]:
        left[n] -= 1
        out = fillings(left, capacity - n, n, width)
        left[n] += 1
        return [(n, *f) for f in out]

    def times(pattern: tuple[int, ...]) -> int:
        return min(left[n] // pattern.count(n) for n in set(pattern))

    top = largest(capacity)
    stack: list[list] = [[top, options(top) if top else [], 0, 0]]
    while stack and best > bound:
        node = stack[-1]
        n, choices, m, at = node
        if m:  # back from a branch: undo it
            pattern, m = path.pop()
            for x in pattern:
                left[x] += m
            used, waste, node[2] = used - m, waste - m * (capacity - sum(pattern)), 0
        if not n and used < best:
            incumbent, best = list(path), used
        if not n or at == len(choices) or seen >= nodes:
            stack.pop()
            continue
        pattern = choices[at]
        node[3] += 1
        m = times(pattern)
        loss = m * (capacity - sum(pattern))
        if waste + loss > (best - 1) * capacity - total:
            continue
        for x in pattern:
            left[x] -= m
        path.append((pattern, m))
        used, waste, node[2], seen = used + m, waste + loss, m, seen + 1
        below = largest(n)
        stack.append([below, options(below) if below else [], 0, 0])
    return incumbent
