"""Where to cut a run of tokens into windows, by dynamic programming over allowed places."""

from __future__ import annotations

import heapq
from collections import deque
from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Costs:
    """What a plan pays, in tokens of padding.

    sentence   a cut behind a sentence that doesn't end its document
    inside     a cut within a sentence, which only stretches longer than `stretch`
               tokens allow, each `stretch` tokens
    opening    one more window, so that few long ones are better than many short ones
    """

    sentence: int = 16
    inside: int = 64
    opening: int = 8
    stretch: int = 256


def padding(length: int, capacity: int) -> int:
    """A window is padded to `capacity`, unless its length is a power of two."""
    return 0 if length & (length - 1) == 0 else capacity - length


def allowed(ends: np.ndarray, sentences: np.ndarray, costs: Costs, free_from: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Places and costs of cuts in the tokens from 0 to ends[-1], 0 included.

    `ends` has the documents' ends, `sentences` the places behind sentences. From
    `free_from` on there may be a cut behind any token, at the cost of one inside.
    """
    size = int(ends[-1])
    edges = np.unique(np.concatenate([[0], ends, sentences]))
    gap = np.diff(edges)
    more = (gap - 1) // costs.stretch
    first = np.repeat(np.cumsum(more) - more, more)
    inner = np.repeat(edges[:-1], more) + costs.stretch * (np.arange(more.sum()) - first + 1)
    tail = np.arange(size if free_from is None else max(0, free_from), size)
    at = np.unique(np.concatenate([edges, inner, tail]))
    cost = np.full(len(at), costs.inside)
    cost[np.searchsorted(at, sentences)] = costs.sentence
    cost[np.searchsorted(at, ends)] = 0
    cost[0] = 0
    return at, cost


def best_windows(at: np.ndarray, cost: np.ndarray, capacity: int, opening: int) -> list[int]:
    """For each place the one before it in the cheapest plan that cuts there.

    The cost of a window from i to j is that of the cut at j, `opening` and the
    padding. A padded one costs (value[i] + at[i]) + capacity - at[j], so that a
    queue of places with ascending value[i] + at[i], in reach of j, has the best i at
    its head. Unpadded ones have a power of two as their length and are few: their
    pairs of places are found beforehand. Of equal plans the longest last window wins.
    """
    n = len(at)
    links = _power_links(at, capacity)
    begin = np.searchsorted(links[:, 0], np.arange(n + 1)).tolist()
    partner = links[:, 1].tolist()
    place, fee = at.tolist(), (cost + opening).tolist()
    value, back = [0] * n, [0] * n
    queue: deque[tuple[int, int]] = deque([(place[0], 0)])  # (value + place, index)
    for j in range(1, n):
        here = place[j]
        while place[queue[0][1]] < here - capacity:
            queue.popleft()
        least, i = queue[0]
        least += capacity - here
        for other in partner[begin[j] : begin[j + 1]]:
            if value[other] < least or value[other] == least and other < i:
                least, i = value[other], other
        value[j], back[j] = least + fee[j], i
        total = value[j] + here
        while queue and queue[-1][0] > total:
            queue.pop()
        queue.append((total, j))
    return back


def _power_links(at: np.ndarray, capacity: int) -> np.ndarray:
    """All (j, i) with at[j] - at[i] a power of two up to `capacity`, by j."""
    found = []
    length = 1
    while length <= capacity:
        i = np.searchsorted(at, at - length)
        j = np.flatnonzero((at >= length) & (at[np.minimum(i, len(at) - 1)] == at - length))
        found.append(np.stack([j, i[j]], axis=1))
        length *= 2
    links = np.concatenate(found)
    return links[np.argsort(links[:, 0], kind="stable")]


def path(back: list[int], last: int) -> list[int]:
    """The places of the plan that ends at `last`, ascending, 0 and `last` included."""
    out = [last]
    while out[-1]:
        out.append(back[out[-1]])
    return out[::-1]


def settled(at: np.ndarray, back: list[int], capacity: int) -> int:
    """The last place that every plan passes, whatever follows behind the last place.

    A later window begins in reach of the end; the plans of all places there are
    followed back until they meet.
    """
    first = int(np.searchsorted(at, at[-1] - capacity, "right"))
    ahead = list(range(first, len(at)))  # ascending; the last is followed back first
    known = set(ahead)
    heap = [-i for i in ahead]
    heapq.heapify(heap)
    while len(heap) > 1:
        i = back[-heapq.heappop(heap)]
        if i not in known:
            known.add(i)
            heapq.heappush(heap, -i)
    return -heap[0]
