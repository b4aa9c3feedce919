"""Exact inner-product search over sparse integer vectors by a tree of balls."""

from __future__ import annotations

import heapq

import numpy as np

#: Share by which bounds are raised, far above what rounding can take from them.
SLACK = 1e-9
#: Steps of the power iteration that finds where to split a node.
STEPS = 2


class BallTree:
    """Rows first[i]:first[i + 1] of (term, value), split until a node has at most `leaf` rows.

    Terms stand in groups (`group` ascends with them), and a node is a run of `order`
    with the mean of its vectors and, for each group of terms, the largest distance
    of a vector from there within these terms: a ball in each group's subspace. No
    vector's inner product with a query is above that of the mean plus, summed over
    the groups, the length of the query there times this distance. Values are not
    negative; terms ascend within a row.
    """

    def __init__(self, first: np.ndarray, term: np.ndarray, value: np.ndarray, group: np.ndarray, leaf: int = 64):
        rows, self.width = len(first) - 1, len(group)
        self.order = np.arange(rows)
        self.exact = float(value.max(initial=0)) * self.width < 2**53  # sums of doubles are then exact
        self._first, self._term, self._value = first, term, value.astype(np.float64)
        self._group = np.unique(group, return_inverse=True)[1]
        self._groups = int(self._group.max(initial=-1)) + 1
        self.child: list[tuple[int, int]] = []  # (-1, leaf number) for leaves
        self.run: list[tuple[int, int]] = []
        centers: list[np.ndarray] = []
        radii: list[np.ndarray] = []
        self.leaves = 0
        todo: list[tuple[int, int, int, int]] = [(0, rows, -1, 0)]
        while todo:
            lo, hi, parent, side = todo.pop()
            node = len(self.run)
            if parent >= 0:
                left, right = self.child[parent]
                self.child[parent] = (left, node) if side else (node, right)
            own = self._rows(self.order[lo:hi])
            center = np.bincount(own[1], own[2], self.width) / max(1, hi - lo)
            centers.append(center)
            radii.append(self._radii(own, center, hi - lo))
            self.run.append((lo, hi))
            if hi - lo <= leaf:
                self.child.append((-1, self.leaves))
                self.leaves += 1
                continue
            self.child.append((0, 0))
            cut = (lo + hi) // 2
            self._split(lo, hi, own, center)
            todo += [(cut, hi, node, 1), (lo, cut, node, 0)]
        self.center = np.ascontiguousarray(np.array(centers).reshape(-1, self.width).T)  # by term
        self.radius = np.ascontiguousarray(np.array(radii).reshape(-1, self._groups).T)  # by group
        own = self._rows(self.order)
        row = np.repeat(np.arange(rows), own[0])
        leaf_of = np.zeros(rows, np.int64)
        for (lo, hi), (kind, number) in zip(self.run, self.child):
            if kind < 0:
                leaf_of[lo:hi] = number
        key = leaf_of[row] * self.width + own[1]
        by_key = np.argsort(key, kind="stable")
        self._key, self._row, self._leaf_value = key[by_key], row[by_key], value[own[3]][by_key]

    def _radii(self, own: tuple[np.ndarray, ...], center: np.ndarray, rows: int) -> np.ndarray:
        """For each group the largest distance from the mean within it, rounded up."""
        size, term, value, _ = own
        of_center = np.bincount(self._group, center * center, self._groups)
        most, met, largest = (np.zeros(self._groups) for _ in range(3))
        if len(term):
            place = np.repeat(np.arange(rows), size) * self._groups + self._group[term]
            runs = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))  # entries of one row and group
            of = self._group[term[runs]]
            most -= np.inf
            np.maximum.at(most, of, np.add.reduceat(value * (value - 2 * center[term]), runs))
            np.maximum.at(largest, of, np.add.reduceat(value * value, runs))
            met = np.bincount(of, minlength=self._groups)
        most = np.where(met < rows, np.maximum(most, 0), most)  # a row without terms of the group is the origin there
        doubt = 1e-12 * (largest + of_center)  # of differences of large squares
        return np.sqrt(np.maximum(0, most + of_center) + doubt)

    def _rows(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Entries of some rows: how many each has, their terms, values and places."""
        size = self._first[rows + 1] - self._first[rows]
        ends = np.cumsum(size)
        at = np.repeat(self._first[rows] - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)
        return size, self._term[at], self._value[at], at

    @staticmethod
    def _dots(own: tuple[np.ndarray, ...], factor: np.ndarray) -> np.ndarray:
        return np.bincount(np.repeat(np.arange(len(own[0])), own[0]), own[2] * factor, len(own[0]))

    def _split(self, lo: int, hi: int, own: tuple[np.ndarray, ...], center: np.ndarray) -> None:
        """Orders a run along the direction in which it is widest, by a few steps of power iteration."""
        axis = np.random.default_rng(lo).standard_normal(self.width)
        for _ in range(STEPS):
            along = self._dots(own, axis[own[1]]) - center @ axis
            axis = np.bincount(own[1], own[2] * np.repeat(along, own[0]), self.width) - along.sum() * center
            axis /= max(np.abs(axis).max(initial=0), 1.0)
        self.order[lo:hi] = self.order[lo:hi][np.argsort(self._dots(own, axis[own[1]]), kind="stable")]

    def best(self, terms: np.ndarray, ids: np.ndarray, k: int, known: list[tuple[int, int]]) -> tuple[list[tuple[int, int]], int]:
        """`known` (score, -id), the best first, joined with the best `k` here, and the leaves visited.

        A query is a set of terms; the score of a row is the sum of its values of
        these, and above 0. Nodes are visited by their bounds, the highest first,
        until a bound falls below the kth score; an equal one may hide a smaller id.
        """
        groups, here = np.unique(self._group[terms], return_counts=True)
        bound = self.center[terms].sum(axis=0) + np.sqrt(here) @ self.radius[groups]
        bound = (bound * (1 + SLACK) + 1).tolist()
        top, visited = known, 0
        heap = [(-bound[0], 0)]
        while heap:
            least = max(1, top[k - 1][0]) if len(top) >= k else 1
            reach, node = heapq.heappop(heap)
            if -reach < least:
                break
            left, right = self.child[node]
            if left >= 0:
                for child in (left, right):
                    if bound[child] >= least:
                        heapq.heappush(heap, (max(reach, -bound[child]), child))
                continue
            visited += 1
            lo, hi = self.run[node]
            scores = self._leaf_scores(right, terms, lo, hi)
            good = np.flatnonzero(scores >= least)
            if len(good):
                if len(good) > k:
                    found = ids[self.order[lo:hi][good]]
                    good = good[np.lexsort((found, -scores[good]))[:k]]
                found = zip(scores[good].tolist(), (-ids[self.order[lo:hi][good]]).tolist())
                top = sorted([*top, *found], reverse=True)[:k]
        return top, visited

    def _leaf_scores(self, leaf: int, terms: np.ndarray, lo: int, hi: int) -> np.ndarray:
        key = leaf * self.width + terms
        first, last = np.searchsorted(self._key, key, "left"), np.searchsorted(self._key, key, "right")
        size = last - first
        ends = np.cumsum(size)
        at = np.repeat(first - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)
        if self.exact:
            return np.bincount(self._row[at] - lo, self._leaf_value[at], hi - lo).astype(np.int64)
        scores = np.zeros(hi - lo, np.int64)
        np.add.at(scores, self._row[at] - lo, self._leaf_value[at])
        return scores
