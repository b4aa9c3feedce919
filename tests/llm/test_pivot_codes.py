import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from gapwise.llm.pivot_codes import _distances, _spread, compress, integers, nearest_entries, with_group_error


def brute(vectors, parts, entries, rounds):
    """Codes and errors of (id, integers) by trying every entry, and the codebooks."""
    width = -(-max((len(v) for _, v in vectors), default=1) // parts) * parts
    x = np.array([list(v) + [0] * (width - len(v)) for _, v in vectors], np.int64).reshape(len(vectors), parts, -1)
    start = sorted((i, tuple(v)) for i, v in vectors if i is not None)[:entries]
    books = np.array([list(v) + [0] * (width - len(v)) for _, v in start], np.int64).reshape(len(start), parts, -1).transpose(1, 0, 2).copy()
    for step in range(rounds + 1):
        gap = np.stack([((x[:, p, None, :] - books[p][None]) ** 2).sum(axis=2) for p in range(parts)], axis=1)
        index, error = gap.argmin(axis=2), gap.min(axis=2).sum(axis=1)
        if step < rounds:
            for p in range(parts):
                for e in range(len(start)):
                    own = x[index[:, p] == e, p]
                    if len(own):
                        books[p, e] = own.sum(axis=0) // len(own)
    codes = ["".join(f"{i:02x}" for i in row) for row in index]
    return codes, error.tolist(), hashlib.sha256(",".join(str(v) for v in books.ravel().tolist()).encode()).hexdigest()


def frame(spark, vectors):
    rows = [(i, v, None if n % 7 == 0 else n % 3) for n, (i, v) in enumerate(vectors)]
    return spark.createDataFrame(rows, "vec_id long, vector array<long>, label int").selectExpr("*", "0L AS error", "'x' AS code", "1 AS near", "2 AS _salt")


@pytest.mark.parametrize(("n", "width", "scale", "entries", "pivots"), [(700, 16, 900, 256, 12), (300, 8, 4, 32, 3), (20, 4, 50, 256, 12), (200, 12, 2**22, 16, 5)])
def test_codes_are_those_of_brute_force(spark, n, width, scale, entries, pivots):
    r = np.random.default_rng(n)
    vectors = [(int(i), r.integers(-scale, scale, width).tolist()) for i in r.permutation(n)]
    vectors += [(1, vectors[0][1]), (1, vectors[1][1]), (None, vectors[2][1]), (5000, vectors[3][1][:3]), (5001, [])] + [(6000 + i, vectors[5][1]) for i in range(40)]
    coded, books = compress(frame(spark, [*vectors, (0, None)]).repartition(3, "vec_id"), entries=entries, pivots=pivots)
    assert coded.columns == ["vec_id", "label", "code", "error"]
    codes, errors, digest = brute(vectors, 4, entries, 4)
    found = sorted((str(r["vec_id"]), r["code"], r["error"]) for r in coded.collect())
    assert found == sorted((str(i), c, e) for (i, _), c, e in zip(vectors, codes, errors))
    assert books.digest() == digest


def test_group_errors_and_nulls(spark):
    vectors = [(i, [i % 9 * 100, i % 5, 3, -i]) for i in range(200)]
    coded, _ = compress(frame(spark, vectors), entries=4)
    found = with_group_error(coded.drop("_salt")).collect()
    sums = {}
    for r in found:
        sums[r["label"]] = sums.get(r["label"], 0) + r["error"]
    assert len(found) == 200 and None in sums and all(r["label_error"] == sums[r["label"]] for r in found)


def test_no_vectors(spark):
    for rows in ([], [(1, None)], [(None, [1, 2])]):
        coded, books = compress(frame(spark, rows) if rows else frame(spark, [(1, None)]).limit(0))
        assert coded.collect() == [] and books.entries.size == 0
        assert with_group_error(coded).collect() == []


def test_integers_of_odd_vectors(spark):
    df = spark.sql("SELECT * FROM VALUES (array(0.5f, -0.0001f)), (array(cast('nan' AS float))), (array(1f, NULL)), (NULL), (array(cast('-infinity' AS float))) AS t(v)")
    assert [r[0] for r in df.select(integers(F.col("v"))).collect()] == [[512, -1], None, None, None, None]


def test_vectors_too_large_are_refused(spark):
    with pytest.raises(ValueError):
        compress(frame(spark, [(1, [2**40, 0, 0, 0])]))


@pytest.mark.parametrize("clusters", [12, 200])
def test_few_distances_are_evaluated_where_parts_cluster(clusters):
    r = np.random.default_rng(clusters)
    centers = r.integers(-5000, 5000, (clusters, 4))
    points = centers[r.integers(0, clusters, 3000)] + r.integers(-20, 20, (3000, 4))
    entries = points[:256].copy()
    entries[9] = entries[8]  # ties go to the lower index
    pivots = _spread(entries, 12)
    index, distance, evaluated = nearest_entries(points, _distances(points, pivots), entries, _distances(entries, pivots))
    gap = ((points[:, None] - entries[None]) ** 2).sum(axis=2)
    assert (index == gap.argmin(axis=1)).all() and (distance == gap.min(axis=1)).all()
    assert evaluated < gap.size / 4
