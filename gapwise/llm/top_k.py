"""Exact top-k by inner product with block-at-a-time pruning."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapwise.llm.grid import best_of, search, usable


def exact_top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, block: int = 64) -> DataFrame:
    """query_id, rank, vec_id, score: for each query the `k` largest integer inner products.

    `vectors` has vec_id and vector (array of integers), `queries` query_id and
    vector. A candidate is every row whose vec_id isn't the query's; ties go to
    smaller ids. Null vectors and those with a null component take no part; a
    shorter vector goes on with zeros, an empty one scores 0. Rows that repeat a
    vec_id are candidates each for itself; of several vectors of one query id the
    least counts. Without queries or candidates there are no rows.

    In each block of documents, per query, sub-blocks of `block` documents are
    visited by the sum over terms of the query's weight times the block's extreme
    weight of the term, the largest sum first, until the next falls below the
    query's kth score; a visit scores all of its documents.
    """
    clean = lambda df, name: df.where(usable(F.col("vector"))).select(
        F.col(name).cast("long").alias(name), F.col("vector").cast("array<long>").alias("vector")
    ).where(F.col(name).isNotNull())
    own = clean(queries, "query_id").groupBy("query_id").agg(F.min("vector").alias("vector"))

    def cell(query_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return _pruned(query_ids, q, ids, d, k, block)

    return search(own, clean(vectors, "vec_id"), cell, k, "long")


def _pruned(query_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, d: np.ndarray, k: int, block: int) -> tuple[np.ndarray, ...]:
    # doubles are exact up to 2^53 and have a fast product
    reach = float(np.abs(q).max(initial=0)) * float(np.abs(d).max(initial=0)) * max(1, q.shape[1])
    kind = np.float64 if reach < 2**53 else np.int64
    strongest = np.abs(d).argmax(axis=1) if d.shape[1] else np.zeros(len(d), int)
    signs = np.sign(d[np.arange(len(d)), strongest]) if d.shape[1] else strongest
    order = np.lexsort((ids, signs, strongest))  # documents with the same strong term stand together
    d, ids, q = d[order].astype(kind), ids[order], q.astype(kind)
    starts = np.arange(0, len(d), block)
    high, low = np.maximum.reduceat(d, starts), np.minimum.reduceat(d, starts)
    bounds = np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T
    visits = np.argsort(-bounds, axis=1, kind="stable")
    sorted_bounds = np.take_along_axis(bounds, visits, axis=1)
    top_row, top_id, top_score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, kind)
    worst = -np.inf if kind is np.float64 else np.iinfo(np.int64).min
    kth = np.full(len(q), worst, kind)
    at, wide = 0, 1
    while at < len(starts):
        open_ = sorted_bounds[:, at : at + wide] >= kth[:, None]  # an equal score may have a smaller id
        rows, steps = np.nonzero(open_)
        if not len(rows):
            break
        blocks = visits[rows, at + steps]
        by_block = np.argsort(blocks, kind="stable")
        rows, blocks = rows[by_block], blocks[by_block]
        edges = np.flatnonzero(np.concatenate([[True], blocks[1:] != blocks[:-1], [True]]))
        found = [(top_row, top_id, top_score)]
        for i, j in zip(edges[:-1], edges[1:]):
            own, start = rows[i:j], starts[blocks[i]]
            scores = q[own] @ d[start : start + block].T
            their = ids[start : start + block]
            keep = (scores >= kth[own, None]) & (their[None, :] != query_ids[own, None])
            r, c = np.nonzero(keep)
            found.append((own[r], their[c], scores[r, c]))
        top_row, top_id, top_score = (np.concatenate(x) for x in zip(*found))
        best = best_of(top_row, top_id, top_score, k)
        top_row, top_id, top_score = top_row[best], top_id[best], top_score[best]
        full = np.flatnonzero(np.bincount(top_row, minlength=len(q)) >= k)
        last = np.searchsorted(top_row, full, "right") - 1
        kth[full] = top_score[last]
        at, wide = at + wide, 2 * wide
    return top_row, top_id, top_score.astype(np.int64)
