"""Compresses vectors to codes of nearest codebook entries, found by distances to fixed pivots."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapwise.llm.grid import matrix, usable
from gapwise.llm.staging import staged

#: Rows of one step in numpy, few enough that its tables stay in a core's cache.
STEP = 128
#: Rounding to 24 bits moves a difference of distances by far less than this share of the largest one.
SLACK = 1e-6


@dataclass(frozen=True)
class Codebooks:
    """`entries[p]`: the integer entries of part p, one per row; `pivots[p]`: the fixed points of part p."""

    entries: np.ndarray
    pivots: np.ndarray

    @property
    def parts(self) -> int:
        return len(self.entries)

    def digest(self) -> str:
        """sha256 of all components by part, entry and place, as decimal numbers with commas."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def integers(vector: Column, scale: int = 1024) -> Column:
    """floor(scale * x) of each component of a usable vector, null for any other."""
    return F.when(usable(vector), F.transform(vector, lambda x: F.floor(scale * x.cast("double"))))


def compress(
    vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4, pivots: int = 24
) -> tuple[DataFrame, Codebooks]:
    """(vec_id, label, code, error) of each vector, and the codebooks.

    `vectors` has vec_id, vector (array of integers, null: left out) and label.
    Vectors are cut into `parts` equal parts; a shorter one goes on with zeros, as all
    do up to a multiple of `parts`. A part's codebook starts as that part of the
    vectors with the `entries` (256 at most) smallest vec_ids (of equal ids the lesser
    vectors; rows without id start none, but get codes). Each round assigns every part
    to the nearest entry, of equally near ones the first, and replaces an entry by
    the floor of its parts' mean; an entry without parts stays. `code` has two hex
    digits per part, `error` is the squared distance summed over the parts. Repeated
    rows count each for itself. Without vectors there are no rows and no entries.
    Components must stay below 2^26 or so (what squared distances in 63 bits allow;
    else ValueError).

    Distances of parts to `pivots` fixed points are found once and written, to 24 bits,
    beside the vectors. In each round only the entries' distances to the pivots are new: by the
    triangle inequality the largest difference of the two to one pivot is a lower bound
    of a distance. Entries are tried in the order of their bounds until the bound is above the least
    distance found, which is exact in integers. Entries, the driver's only data, are
    as many as the parameters say; a task sends sums per entry.
    """
    if not 1 <= entries <= 256:
        raise ValueError("two hex digits number 256 entries at most")
    known = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("vector").cast("array<long>").alias("vector")).where(
        "vector IS NOT NULL"
    )
    longest, most = known.agg(F.max(F.size("vector")), F.max(F.array_max(F.transform("vector", F.abs)))).first()
    width = -(-max(longest or 0, 1) // parts) * parts
    if 4 * (most or 0) ** 2 * width * 256 >= 2**63:
        raise ValueError("components are too large for exact distances in 63 bits")
    first = known.where("vec_id IS NOT NULL").select("vec_id", "vector").orderBy("vec_id", "vector").limit(entries).collect()
    start = np.zeros((len(first), width), np.int64)
    for row, own in zip(start, first):
        row[: len(own["vector"])] = own["vector"]
    books = start.reshape(len(first), parts, width // parts).transpose(1, 0, 2)
    fixed = np.stack([_spread(book, pivots) for book in books])
    rows = staged(with_pivot_distances(known, fixed, width), "pivot-distances")
    if not len(first):  # no vector has an id that could start a codebook
        empty = rows.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
        return empty.where(F.lit(False)), Codebooks(books, fixed)
    for _ in range(rounds):
        books = _moved(rows, Codebooks(books, fixed))
    codebooks = Codebooks(books, fixed)
    return _coded(rows, codebooks), codebooks


def _spread(points: np.ndarray, n: int) -> np.ndarray:
    """Up to `n` of the points, each the one farthest from those before it."""
    if not len(points):
        return points
    chosen = [0]
    gap = ((points - points[0]) ** 2).sum(axis=1)
    while len(chosen) < min(n, len(points)) and gap.max() > 0:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, ((points - points[chosen[-1]]) ** 2).sum(axis=1))
    fill = [chosen[0]] * (min(n, len(points)) - len(chosen))  # so that all parts have equally many
    return points[chosen + fill]


def _distances(points: np.ndarray, to: np.ndarray) -> np.ndarray:
    out = np.empty((len(points), len(to)))
    for i, one in enumerate(to):
        gap = points - one
        out[:, i] = np.sqrt(np.einsum("ij,ij->i", gap, gap))
    return out


def with_pivot_distances(vectors: DataFrame, pivots: np.ndarray, width: int) -> DataFrame:
    """`vectors` with all their components and `near`: each part's distances to its pivots."""
    parts, n = pivots.shape[:2]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for got in batches:
            whole = matrix(pa.chunked_array([got.column("vector")]), width, np.int64)
            cut = whole.reshape(len(whole), parts, width // parts)
            near = np.stack([_distances(cut[:, p], pivots[p]) for p in range(parts)], axis=1)
            columns = [got.column("vec_id"), got.column("label"), _lists(whole), _lists(near.reshape(len(whole), parts * n).astype(np.float32))]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "vector", "near"])

    schema = vectors.select("vec_id", "label", "vector", F.array().cast("array<float>").alias("near")).schema
    return vectors.select("vec_id", "label", "vector").mapInArrow(measure, schema)


def _lists(rows: np.ndarray) -> pa.ListArray:
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.ravel()))


def nearest_entries(points: np.ndarray, near: np.ndarray, entries: np.ndarray, of_entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The nearest entry of each point, its squared distance, and how many distances were evaluated.

    `near` has the points' and `of_entries` the entries' distances to the same pivots.
    """
    low, other = near.astype(np.float32, copy=False), of_entries.astype(np.float32)
    bound = np.zeros((len(points), len(entries)), np.float32)
    gap = np.empty_like(bound)
    for i in range(low.shape[1]):
        np.subtract(low[:, i, None], other[None, :, i], out=gap)
        np.maximum(bound, np.abs(gap, out=gap), out=bound)
    bound -= np.float32(SLACK * max(low.max(initial=0), other.max(initial=0)))  # more than rounding may have added
    order = np.argsort(bound, axis=1)
    bound = np.take_along_axis(bound, order, axis=1)
    reached = max(np.abs(points).max(initial=0), np.abs(entries).max(initial=0))
    if 4 * int(reached) ** 2 * points.shape[1] < 2**31:
        points, entries = points.astype(np.int32), entries.astype(np.int32)
    many = len(entries)
    best = np.full(len(points), np.iinfo(np.int64).max)  # squared distance * many + entry: ties go to the lower one
    reach = np.full(len(points), np.inf)
    at, wide, evaluated = 0, 1, 0
    while at < many:
        rows, steps = np.nonzero(bound[:, at : at + wide] <= reach[:, None])
        if not len(rows):
            break
        tried = order[rows, at + steps]
        apart = points[rows] - entries[tried]
        found = np.einsum("ij,ij->i", apart, apart).astype(np.int64) * many + tried
        starts = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
        own = rows[starts]
        best[own] = np.minimum(best[own], np.minimum.reduceat(found, starts))
        reach[own] = np.sqrt(best[own] // many)
        evaluated += len(rows)
        at, wide = at + wide, min(2 * wide, 32)
    return best % many, best // many, evaluated


def _assigned(got: pa.RecordBatch, books: Codebooks, of_entries: list[np.ndarray]) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
    """For each step's rows: their parts, entries and squared distances."""
    width = books.parts * books.entries.shape[2]
    whole = matrix(pa.chunked_array([got.column("vector")]), width, np.int64).reshape(len(got), *books.entries.shape[::2])
    near = matrix(pa.chunked_array([got.column("near")]), books.parts * books.pivots.shape[1], np.float32).reshape(len(got), *books.pivots.shape[:2])
    for start in range(0, len(got), STEP):
        own = slice(start, min(start + STEP, len(got)))
        found = [nearest_entries(whole[own, p], near[own, p], books.entries[p], of_entries[p]) for p in range(books.parts)]
        yield own, whole[own], np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)


def _moved(rows: DataFrame, books: Codebooks) -> np.ndarray:
    """The entries after one round."""
    parts, entries, size = books.entries.shape

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_entries = [_distances(books.entries[p], books.pivots[p]) for p in range(parts)]
        sums, counts = np.zeros((parts * entries, size), np.int64), np.zeros(parts * entries, np.int64)
        for got in batches:
            for _, own, index, _ in _assigned(got, books, of_entries):
                slot = (index + entries * np.arange(parts)).ravel()
                np.add.at(sums, slot, own.reshape(-1, size))
                counts += np.bincount(slot, minlength=len(counts))
        used = np.flatnonzero(counts)
        slots = np.repeat(used, size + 1)
        places = np.tile(np.arange(-1, size), len(used))  # the count stands at place -1
        values = np.concatenate([counts[used, None], sums[used]], axis=1).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (slots, places, values)], names=["slot", "place", "total"])

    found = rows.mapInArrow(totals, "slot long, place long, total long").groupBy("slot", "place").agg(F.sum("total").alias("total")).collect()
    sums, counts = books.entries.reshape(-1, size).copy(), np.ones(parts * entries, np.int64)  # unused entries stay
    for slot, place, total in found:
        if place < 0:
            counts[slot] = total
        else:
            sums[slot, place] = total
    return (sums // counts[:, None]).reshape(parts, entries, size)


def _coded(rows: DataFrame, books: Codebooks) -> DataFrame:
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_entries = [_distances(books.entries[p], books.pivots[p]) for p in range(books.parts)]
        for got in batches:
            codes, errors = [], []
            for _, _, index, distance in _assigned(got, books, of_entries):
                digits = np.ascontiguousarray(index.astype(np.uint8)).tobytes().hex()
                codes += [digits[i : i + 2 * books.parts] for i in range(0, len(digits), 2 * books.parts)]
                errors.append(distance.sum(axis=1))
            error = np.concatenate(errors) if errors else np.zeros(0, np.int64)
            columns = [got.column("vec_id"), got.column("label"), pa.array(codes, pa.string()), pa.array(error)]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "code", "error"])

    schema = rows.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")).schema
    return rows.mapInArrow(code, schema)


def with_group_error(coded: DataFrame, salts: int = 16) -> DataFrame:
    """`coded` with label_error: the error summed over the rows of equal labels, nulls together.

    A label's rows get one of `salts` salts and its sum is repeated for each, so that
    no label meets in one task.
    """
    sums = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    each = sums.select(F.col("label").alias("_label"), "label_error", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_of"))
    salted = coded.withColumn("_salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(salts)).cast("int"))
    on = salted["label"].eqNullSafe(each["_label"]) & (salted["_salt"] == each["_of"])
    return salted.join(each, on).drop("_label", "_of", "_salt")
