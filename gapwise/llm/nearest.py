"""Approximate nearest neighbours by multi-probe p-stable hashing."""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapwise.llm.grid import best_of, search, usable
from gapwise.llm.spans import mix


#: A query that meets too few rows tries so many times the probes, as far as there are changes.
WIDER = 3


@dataclass(frozen=True)
class Index:
    """`tables` tables of `functions` hashes floor((a.x + b) / width) of a point on the unit sphere.

    `probes` buckets are visited in each table.
    """

    tables: int = 16
    functions: int = 5
    width: float = 1.0
    probes: int = 100
    seed: int = 7


def perturbations(functions: int, probes: int) -> list[tuple[int, ...]]:
    """The sets of hash changes in the order of their expected success, for ranked changes.

    Change j of 2 * functions has the jth smallest distance to a neighbouring
    bucket; j and its mirror image are the two changes of one hash and exclude
    each other. A set's cost is the sum of its expected squared distances.
    """
    m, n = functions, 2 * functions
    cost = [j * (j + 1) / (4 * (m + 1) * (m + 2)) for j in range(1, m + 1)]
    cost += [1 - (n + 1 - j) / (m + 1) + (n + 1 - j) * (n + 2 - j) / (4 * (m + 1) * (m + 2)) for j in range(m + 1, n + 1)]
    found: list[tuple[int, ...]] = [()]
    heap = [(cost[0], (0,))]
    while heap and len(found) < probes:
        total, own = heapq.heappop(heap)
        if not any(n - 1 - j in own for j in own):
            found.append(own)
        last = own[-1]
        if last + 1 < n:
            heapq.heappush(heap, (total - cost[last] + cost[last + 1], (*own[:-1], last + 1)))
            heapq.heappush(heap, (total + cost[last + 1], (*own, last + 1)))
    return found


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, index: Index = Index()) -> DataFrame:
    """query_id, rank, vec_id, score: of the candidates found the `k` with the largest inner product.

    `vectors` has vec_id and vector, `queries` query_id and vector. A candidate is
    every row whose vec_id isn't the query's; ties go to smaller ids. Null and zero
    vectors and those with a null or non-finite component take no part; a shorter
    vector goes on with zeros. Rows that repeat a vec_id are candidates each for
    itself; of several vectors of one query id the least counts. Without queries or
    candidates there are no rows.

    Every row is indexed. One more component takes each vector to the sphere of the
    largest norm, where the largest inner product is the least distance. A query
    visits in each table its own bucket and those that differ by the likeliest
    changes of its hashes; what the tables find is merged and ranked by exact scores.
    If that is fewer than `k` rows of a block, the query goes on to less likely
    changes and at last to all rows of the block, so that it gets `k` if there are.
    """
    clean = lambda df, name: df.where(usable(F.col("vector"))).select(
        F.col(name).cast("long").alias(name), F.col("vector").cast("array<double>").alias("vector")
    ).where(F.exists("vector", lambda x: x != 0) & F.col(name).isNotNull())
    own = clean(queries, "query_id").groupBy("query_id").agg(F.min("vector").alias("vector"))
    every = clean(vectors, "vec_id")
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)
    norm = float(np.sqrt(every.agg(F.max(square)).first()[0] or 1.0))
    sets = perturbations(index.functions, WIDER * index.probes)

    def cell(query_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return _probed(query_ids, q, ids, d, k, index, (sets[: index.probes], sets[index.probes :]), norm)

    return search(own, every, cell, k, "double")


def _probed(
    query_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, d: np.ndarray, k: int, index: Index, steps: tuple[list[tuple[int, ...]], ...], norm: float
) -> tuple[np.ndarray, ...]:
    rng = np.random.Generator(np.random.PCG64(index.seed))
    lift = np.sqrt(np.maximum(0, 1 - (d * d).sum(axis=1) / norm**2))
    points = np.hstack([d / norm, lift[:, None]])
    asked = np.hstack([q / np.linalg.norm(q, axis=1, keepdims=True), np.zeros((len(q), 1))])
    m, tables = index.functions, []
    for _ in range(index.tables):
        a, b = rng.standard_normal((points.shape[1], m)), rng.random(m)
        place = np.floor(points @ a / index.width + b).astype(np.int64)
        keys = _keys(place)
        order = np.argsort(keys, kind="stable")
        exact = asked @ a / index.width + b
        base = np.floor(exact).astype(np.int64)
        below = exact - base
        change = np.argsort(np.hstack([below, 1 - below]), axis=1, kind="stable")  # by distance to the next bucket
        tables.append((keys[order], order, base, change))

    def mark(seen: np.ndarray, own: np.ndarray, rows: np.ndarray, sets: list[tuple[int, ...]]) -> None:
        """Marks in the rows `own` of `seen` what the queries `rows` meet in the buckets of `sets`."""
        for keys, order, base, change in tables:
            probe = np.empty((len(sets), len(rows)), np.uint64)
            for t, changes in enumerate(sets):
                place = base[rows].copy()
                for j in changes:
                    which = change[rows, j]
                    place[np.arange(len(rows)), which % m] += np.where(which < m, -1, 1)
                probe[t] = _keys(place)
            first, last = np.searchsorted(keys, probe.ravel(), "left"), np.searchsorted(keys, probe.ravel(), "right")
            size = last - first
            at = np.repeat(first - np.cumsum(size) + size, size) + np.arange(size.sum())
            seen[np.repeat(np.tile(own, len(sets)), size), order[at]] = True

    out: list[tuple[np.ndarray, ...]] = []
    chunk = max(1, (1 << 23) // max(1, len(d)))
    for start in range(0, len(q), chunk):
        rows = np.arange(start, min(start + chunk, len(q)))
        seen = np.zeros((len(rows), len(d)), bool)
        short = np.arange(len(rows))
        for sets in steps:
            mark(seen, short, rows[short], sets)
            met_of = np.array([np.count_nonzero(ids[seen[i]] != query_ids[rows[i]]) for i in short], np.int64)
            short = short[met_of < k]
            if not len(short):
                break
        seen[short] = True
        for i, row in enumerate(rows):
            met = np.flatnonzero(seen[i])
            met = met[ids[met] != query_ids[row]]
            if not len(met):
                continue
            score = d[met] @ q[row]
            if len(met) > k:  # sums in another order may differ in the last digits
                least = np.partition(score, len(met) - k)[len(met) - k]
                met = met[score >= least - 1e-9 * max(1.0, abs(least))]
            score = (d[met] * q[row]).sum(axis=1)
            best = best_of(np.zeros(len(met), np.int64), ids[met], score, k)
            out.append((np.full(len(best), row), ids[met][best], score[best]))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return tuple(np.concatenate(x) for x in zip(*out))


def _keys(place: np.ndarray) -> np.ndarray:
    keys = np.zeros(len(place), np.uint64)
    for column in place.T:
        keys = mix(keys * np.uint64(0x9FB21C651E98DF25) + column.astype(np.uint64))
    return keys
