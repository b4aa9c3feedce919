"""A stated set of queries against all rows, in blocks: each cell has a block of either."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: score(query ids, queries, ids, vectors) -> (query rows, ids, scores)
Cell = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    inf = F.lit(float("inf"))
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != inf)), F.lit(False))


def matrix(column: pa.ChunkedArray, width: int, dtype: type) -> np.ndarray:
    """Vectors as rows; shorter ones go on with zeros."""
    lists = column.combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    sizes = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(sizes), width), dtype)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    if (sizes == width).all():
        out[:] = flat.reshape(-1, width)
    else:
        rows = np.repeat(np.arange(len(sizes)), sizes)
        out[rows, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def search(
    queries: DataFrame, candidates: DataFrame, cell: Cell, k: int, score_type: str, query_block: int = 4096, block: int = 32768
) -> DataFrame:
    """query_id, rank, vec_id, score: the best `k` of what `cell` finds for each query in each block.

    `queries` has query_id and vector, `candidates` vec_id and vector; both are
    dealt to blocks by hashes, and a cell, one task's work, gets one block of
    either. So memory is bounded, and every candidate row meets every query once.
    """
    groups = max(1, -(-queries.count() // query_block))
    shards = max(1, -(-candidates.count() // block))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = queries.select("query_id", "vector", F.pmod(F.xxhash64("query_id"), F.lit(groups)).cast("int").alias("g"), every(shards).alias("s"))
    right = candidates.select("vec_id", "vector", every(groups).alias("g"), F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int").alias("s"))
    dtype = np.int64 if score_type == "long" else np.float64

    def in_cell(q: pa.Table, d: pa.Table) -> pa.Table:
        names = ["query_id", "vec_id", "score"]
        if not (len(q) and len(d)):
            return pa.Table.from_arrays([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.from_numpy_dtype(dtype))], names=names)
        width = max(pc.max(pc.list_value_length(t.column("vector"))).as_py() for t in (q, d))
        ids = q.column("query_id").to_numpy()
        rows, found, scores = cell(
            ids, matrix(q.column("vector"), width, dtype), d.column("vec_id").to_numpy(), matrix(d.column("vector"), width, dtype)
        )
        return pa.Table.from_arrays([pa.array(ids[rows]), pa.array(found), pa.array(scores)], names=names)

    pairs = left.groupBy("g", "s").cogroup(right.groupBy("g", "s")).applyInArrow(in_cell, f"query_id long, vec_id long, score {score_type}")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = pairs.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def best_of(rows: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the best `k` of each row, ties to smaller ids, ordered by row."""
    order = np.lexsort((ids, -scores, rows))
    own = rows[order]
    first = np.searchsorted(own, own, "left")
    return order[np.arange(len(order)) - first < k]
