import random
import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from gapwise.llm.components import components
from gapwise.llm.near_duplicates import band_keys, circulant_signatures, near_duplicates, odd_sketch
from gapwise.llm.shingles import shingle_set, words_of


def sets_of(text, width=3):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < width:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def expected(rows, at_least=85):
    ids = sorted({i for i, _ in rows})
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (i, a), (j, b) in combinations([(i, sets_of(t)) for i, t in rows], 2):
        if a and b and 100 * len(a & b) >= at_least * len(a | b):
            low, high = sorted((find(i), find(j)))
            parent[high] = low
    return {i: find(i) for i in ids}


def corpus(seed, n):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(2, 6)))
    bases = [[word() for _ in range(r.randint(1, 160))] for _ in range(n)]
    rows = []
    for base in bases:
        for _ in range(r.choice([1, 1, 2, 12])):
            own = list(base)
            for _ in range(r.randint(0, 3)):
                own[r.randrange(len(own))] = word()
            rows.append((len(rows), " ".join(own)))
    return rows


def test_same_components_as_brute_force(spark):
    rows = corpus(1, 60) + [(10_000, None), (10_001, ""), (10_002, " \t\n"), (10_003, "One two"), (10_004, "one\nTWO"), (10_005, "one")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS kept", "'x' AS set_id", "2 AS component_id")
    found = near_duplicates(docs, width=3, at_least=85).collect()
    want = expected(rows)
    assert {r.doc_id: r.component_id for r in found} == want
    assert {r.doc_id: r.n_shingles for r in found} == {i: len(sets_of(t)) for i, t in rows}
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_repeated_rows_null_ids_and_empty_tables(spark):
    kind = "doc_id long, text string"
    found = near_duplicates(spark.createDataFrame([(7, "a b c d e f"), (7, "a b c d e f"), (3, "a b c d e f"), (None, "x y z v w")], kind)).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in found) == [(0, 0), (3, 3), (7, 3), (7, 3)]
    assert near_duplicates(spark.createDataFrame([], kind)).count() == 0


def test_near_copies_without_an_id_are_one_group(spark):
    words = [f"w{i}" for i in range(200)]
    near = " ".join([*words[:-1], "other"])
    rows = [(None, " ".join(words)), (None, near), (None, "a b c d"), (5, "x " + near), (6, "p q r s t u"), (None, "p q r s t u"), (None, None), (None, " ")]
    found = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=3, at_least=85).collect()
    groups = {}
    for r in found:
        groups.setdefault(r.group_id, set()).add((r.doc_id, r.n_shingles, r.component_id, r.kept))
    assert sorted(map(len, groups.values())) == [1, 1, 2, 2]
    assert {(None, 198, 5, False), (5, 199, 5, True)} in groups.values()
    assert {(6, 4, 6, True), (None, 4, 6, False)} in groups.values()
    alone = near_duplicates(spark.createDataFrame(rows[:3], "doc_id long, text string"), width=3, at_least=85).collect()
    assert sorted((len({r.text_key for r in alone if r.group_id == g}), g is None) for g in {r.group_id for r in alone}) == [(1, False), (2, False)]


def test_a_centre_links_copies_that_are_not_linked_themselves(spark):
    words = [f"w{i}" for i in range(120)]
    rows = [(0, " ".join(words))]
    for i in range(1, 40):  # each differs from the first a little, and from the others too much
        own = list(words)
        for k in range(4):
            own[(i * 3 + 30 * k) % 120] = f"x{i}-{k}"
        rows.append((i, " ".join(own)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = expected(rows, 80)
    assert {r.doc_id: r.component_id for r in near_duplicates(docs, width=3, at_least=80).collect()} == want


@pytest.mark.parametrize("shape", ["chain", "star", "loops"])
def test_components_of_any_shape(spark, shape):
    edges = {"chain": [(i, i + 1) for i in range(50)], "star": [(0, i) for i in range(1, 50)], "loops": [(1, 1), (2, 3), (3, 2), (2, 3)]}[shape]
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert len(found) == len({x for e in edges for x in e})
    assert len({r.label for r in found}) == (2 if shape == "loops" else 1)


def test_coordinates_agree_as_often_as_sets_are_similar():
    rng = np.random.default_rng(3)
    agree, bands = [], []
    for _ in range(30):
        a = rng.integers(0, 2**63, 900).astype(np.uint64)
        b = a.copy()
        b[:73] = rng.integers(0, 2**63, 73).astype(np.uint64)
        x = circulant_signatures([np.unique(a), np.unique(b)], 320)
        agree.append((x[0] == x[1]).mean())
        bands.append((band_keys(x, 40)[0] == band_keys(x, 40)[1]).sum())
        bits = np.bitwise_xor(*[np.unpackbits(odd_sketch(s).view(np.uint8)) for s in (a, b)]).sum()
        assert bits <= 2 * 73  # never more than differ
    assert abs(np.mean(agree) - 827 / 973) < 0.01 and min(bands) > 0


def test_long_texts_are_hashed_in_windows():
    text = " ".join(f"w{i % 5000} é{i}" for i in range(150_000))
    long, short = words_of(pa.array([text, "a B"]))
    assert len(long) == 300_000 and len(short) == 2
    assert (long[:20] == next(words_of(pa.array([text[:200]])))[:20]).all()
    assert len(shingle_set(next(words_of(pa.array(["x" * (3 << 20)]))), 3)) == 1
