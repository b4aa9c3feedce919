"""Plans a packing from the histogram of lengths alone.

The histogram has at most `capacity` entries however many pieces there are, so the
plan is made in one place. Bins with the same contents are one class with a
count, and no step looks at single pieces or single bins.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter, deque
from dataclasses import dataclass

import numpy as np

Runs = tuple[tuple[int, int], ...]  # (length, copies), one after another from offset 0


@dataclass
class Bins:
    """`count` bins that all hold `runs` and have `gap` left."""

    count: int
    gap: int
    runs: Runs


class OpenBins:
    """Classes of bins by gap, filled by best fit."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.by_gap: dict[int, list[Bins]] = {}
        self.gaps: list[int] = []

    def add(self, bins: Bins) -> None:
        if bins.gap not in self.by_gap:
            self.by_gap[bins.gap] = []
            insort(self.gaps, bins.gap)
        self.by_gap[bins.gap].append(bins)

    def _tightest(self, length: int) -> Bins | None:
        at = bisect_left(self.gaps, length)
        if at == len(self.gaps):
            return None
        classes = self.by_gap[gap := self.gaps[at]]
        found = classes.pop()
        if not classes:
            del self.by_gap[gap], self.gaps[at]
        return found

    def best_fit(self, length: int, n: int) -> None:
        """Places `n` pieces, each where the least room is left; opens bins where none has room."""
        while n:
            bins = self._tightest(length) or Bins(-(-n // (self.capacity // length)), self.capacity, ())
            copies = bins.gap // length
            full = min(bins.count, n // copies)
            rest = min(n - full * copies, copies - 1) if full < bins.count else 0
            for count, k in ((full, copies), (1, rest)):
                if count and k:
                    self.add(Bins(count, bins.gap - k * length, (*bins.runs, (length, k))))
            n -= full * copies + rest
            if left := bins.count - full - bool(rest):
                self.add(Bins(left, bins.gap, bins.runs))

    def all(self) -> list[Bins]:
        return [bins for gap in self.gaps for bins in self.by_gap[gap]]


def linear_groups(lengths: list[tuple[int, int]], groups: int) -> list[list[tuple[int, int]]]:
    """Cuts (length, count), longest first, into groups of equally many pieces; each is rounded up to its first length."""
    size = -(-sum(n for _, n in lengths) // groups)
    out: list[list[tuple[int, int]]] = [[]]
    room = size
    for length, n in lengths:
        while n:
            if not room:
                out.append([])
                room = size
            k = min(n, room)
            out[-1].append((length, k))
            n, room = n - k, room - k
    merged: dict[int, list[tuple[int, int]]] = {}
    for group in filter(None, out):  # groups that round to one size are one size
        merged.setdefault(group[0][0], []).extend(group)
    return list(merged.values())


def configurations(sizes: list[int], demand: list[int], capacity: int) -> list[tuple[tuple[int, ...], float]]:
    """The fewest bins of few sizes: (pieces of each size in a bin, number of such bins, maybe a fraction).

    Solves the configuration problem's linear relaxation by column generation: the
    simplex method over configurations, the next one found by a knapsack.
    """
    k = len(sizes)
    basis = np.diag([float(capacity // s) for s in sizes])
    inverse = np.linalg.inv(basis)
    want = np.array(demand, float)
    most = capacity // min(sizes)
    for _ in range(40 * k + 200):
        price = inverse.sum(axis=0)
        value, back = np.zeros(capacity + 1), []
        for _ in range(most):  # one more piece in each round
            best, choice = value.copy(), np.full(capacity + 1, -1)
            for j, s in enumerate(sizes):
                if price[j] > 1e-12:
                    with_j = value[: capacity + 1 - s] + price[j]
                    better = with_j > best[s:] + 1e-12
                    best[s:][better] = with_j[better]
                    choice[s:][better] = j
            back.append(choice)
            if np.array_equal(best, value):
                break
            value = best
        if value[capacity] <= 1 + 1e-7:
            break
        column, room = np.zeros(k), capacity
        for choice in reversed(back):
            if (j := choice[room]) >= 0:
                column[j] += 1
                room -= sizes[j]
        step = inverse @ column
        amount = inverse @ want
        ratio = np.where(step > 1e-9, np.maximum(amount, 0) / np.where(step > 1e-9, step, 1), np.inf)
        out = int(np.argmin(ratio))
        basis[:, out] = column
        inverse = np.linalg.inv(basis)
    amount = inverse @ want
    return [(tuple(int(round(v)) for v in basis[:, i]), float(amount[i])) for i in range(k)]


def plan(histogram: dict[int, int], capacity: int, small: float = 1 / 8, groups: int = 96, slack: float = 1 / 512) -> list[Bins]:
    """Bins for all pieces of a histogram {length: count}.

    Pieces longer than `small` of the capacity go through linear grouping: their
    lengths are rounded up within `groups` groups of equal cardinality, whole
    numbers of optimal configurations are taken, and actual lengths replace the
    rounded ones. A bin in which the actual lengths leave more than `slack` of the
    capacity free, by the rounding, is undone. What the whole numbers leave over,
    the undone bins' pieces and the small ones follow by best fit, longest first.
    """
    if any(not 0 < length <= capacity for length in histogram):
        raise ValueError(f"lengths are from 1 to {capacity}")
    left = Counter({length: n for length, n in histogram.items() if n})
    bins = OpenBins(capacity)
    large = sorted(((length, n) for length, n in left.items() if length > small * capacity), reverse=True)
    if large:
        members = linear_groups(large, groups)
        queues = [deque(group) for group in members]
        found = configurations([g[0][0] for g in members], [sum(n for _, n in g) for g in members], capacity)
        for pattern, amount in found:
            for made in _substitute(pattern, int(amount + 1e-6), queues, capacity):
                if made.gap > slack * capacity:
                    continue
                for length, copies in made.runs:
                    left[length] -= copies * made.count
                bins.add(made)
    for length in sorted(left, reverse=True):
        if left[length]:
            bins.best_fit(length, left[length])
    return bins.all()


def _substitute(pattern: tuple[int, ...], n: int, queues: list[deque], capacity: int) -> list[Bins]:
    """`n` bins of a configuration with actual lengths from each group's queue, as long as it lasts."""
    out = []
    wanted = [(j, copies) for j, copies in enumerate(pattern) if copies]
    while n > 0:
        if any(sum(k for _, k in queues[j]) < copies for j, copies in wanted):
            break
        alike = min([n, *(queues[j][0][1] // copies for j, copies in wanted if queues[j][0][1] >= copies)])
        if any(queues[j][0][1] < copies for j, copies in wanted):
            alike = 1  # one bin that mixes two lengths of a group
        runs = []
        for j, copies in wanted:
            need = copies * alike
            while need:
                length, have = queues[j].popleft()
                k = min(have, need)
                runs.append((length, k // alike))
                need -= k
                if have > k:
                    queues[j].appendleft((length, have - k))
        out.append(Bins(alike, capacity - sum(length * k for length, k in runs), tuple(runs)))
        n -= alike
    return out
