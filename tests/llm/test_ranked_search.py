import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from gapwise.llm.ball_tree import BallTree
from gapwise.llm.ranked_search import Blocks, ranked_search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=10):
    counted = [(d, Counter(terms(t))) for d, t in docs]
    counted = [(d, c) for d, c in counted if c]
    n, length = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    least = {}
    for item, text in items:
        if item is not None and text is not None:
            least[item] = min(text, least.get(item, text), key=lambda t: t.encode())
    out = set()
    for item, text in least.items():
        scored = []
        for d, c in counted:
            m = 10 + 90 * sum(c.values()) * n // length
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if t in c)
            if score > 0 and d is not None:
                scored.append((-score, d))
        out |= {(item, rank + 1, d, -s) for rank, (s, d) in enumerate(sorted(scored)[:k])}
    return out


def some_texts(seed, n, words):
    r = random.Random(seed)
    vocabulary = ["Ab", "ab", "é", "ÉA", "日本", "x1", "the", "of"] + [f"w{i}" for i in range(words)]
    odds = [1 / (i + 1) for i in range(len(vocabulary))]
    joined = lambda size: "".join(w + r.choice([" ", ", ", ".\n", "_"]) for w in r.choices(vocabulary, odds, k=size))
    return [joined(r.choice([1, 5, 30, 300])) for _ in range(n)]


@pytest.mark.parametrize("blocks", [Blocks(), Blocks(rows=40, leaf=2), Blocks(entries=300, leaf=5, vocabulary=30), Blocks(queries=1)])
def test_results_are_those_of_brute_force(spark, blocks):
    texts = some_texts(5, 300, 200)
    docs = list(enumerate(texts)) + [(900 + i, texts[7]) for i in range(30)] + [(3, "the twin of 3"), (None, texts[9]), (901, None), (902, ""), (903, " .,!"), (904, "word " * 200_000)]
    items = [(i, texts[i * 3]) for i in range(20)] + [(1, "aa"), (30, ""), (31, None), (None, "the of"), (32, "nowhere unheard"), (33, "the the THE")]
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS score", "'x' AS n", "0 AS item_id")
    q = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "2 AS doc_id", "3 AS terms")
    found = ranked_search(d.repartition(3, "doc_id"), q, blocks=blocks)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    if blocks.queries > 1:
        rows = [tuple(r) for r in found.collect()]
        assert len(rows) == len(set(rows)) and set(rows) == brute(docs, items)
    else:  # one round over the documents per query
        few = q.where("item_id < 3")
        assert {tuple(r) for r in ranked_search(d, few, blocks=blocks).collect()} == {r for r in brute(docs, items) if r[0] < 3}


def test_no_documents_and_no_queries(spark):
    empty = lambda key: spark.createDataFrame([], f"{key} long, text string")
    one = spark.createDataFrame([(1, "some words")], "doc_id long, text string")
    asked = one.withColumnRenamed("doc_id", "item_id")
    assert ranked_search(one, empty("item_id")).collect() == []
    assert ranked_search(empty("doc_id"), asked).collect() == []
    assert ranked_search(spark.createDataFrame([(1, None), (2, "?")], "doc_id long, text string"), asked).collect() == []
    assert ranked_search(one, spark.createDataFrame([(1, "other")], "item_id long, text string")).collect() == []
    assert [tuple(r) for r in ranked_search(one, asked).collect()] == list(brute([(1, "some words")], [(1, "some words")]))


def sparse(dense):
    rows = [np.flatnonzero(r) for r in dense]
    first = np.cumsum([0] + [len(r) for r in rows])
    return first, np.concatenate(rows), np.concatenate([d[r] for d, r in zip(dense, rows)])


@pytest.mark.parametrize(("scale", "grouped"), [(50, True), (10**6, False), (3, True)])
def test_no_bound_lies_below_a_score(scale, grouped):
    r = np.random.default_rng(scale)
    dense = r.integers(0, scale, (400, 60)) * (r.random((400, 60)) < 0.2)
    group = np.sort(r.integers(0, 9, 60)) if grouped else np.arange(60)
    tree = BallTree(*sparse(dense), group, leaf=7)
    ids = r.permutation(400)
    for _ in range(50):
        asked = np.sort(r.choice(60, r.integers(1, 12), replace=False))
        scores = dense[:, asked].sum(axis=1)
        groups, here = np.unique(group[asked], return_counts=True)
        index = np.unique(group, return_inverse=True)[1][[np.flatnonzero(group == g)[0] for g in groups]]
        bound = tree.center[asked].sum(axis=0) + np.sqrt(here) @ tree.radius[index]
        for (lo, hi), most in zip(tree.run, bound):
            assert scores[tree.order[lo:hi]].max() <= most * (1 + 1e-9) + 1
        wanted = sorted(((int(s), -int(i)) for s, i in zip(scores, ids) if s > 0), reverse=True)[:10]
        assert tree.best(asked, ids, 10, [])[0] == wanted


def test_sums_beyond_doubles_are_exact():
    dense = np.array([[2**52 + 1, 2**52, 1], [2**52, 2**52 + 1, 2]])
    tree = BallTree(*sparse(dense), np.arange(3), leaf=1)
    assert not tree.exact
    assert tree.best(np.arange(3), np.array([5, 6]), 2, [])[0] == [(2**53 + 3, -6), (2**53 + 2, -5)]


def test_clustered_documents_are_pruned():
    """Documents on one of many subjects: a query on one visits few of the leaves."""
    r = np.random.default_rng(2)
    dense = np.zeros((4000, 800), np.int64)
    for i in range(4000):
        subject = i % 40
        dense[i, 20 * subject + r.choice(20, 12, replace=False)] = r.integers(500, 600, 12)
    tree = BallTree(*sparse(dense), np.arange(800) // 20, leaf=32)
    for subject in range(40):
        asked = np.arange(20 * subject, 20 * subject + 12)
        scores = dense[:, asked].sum(axis=1)
        top, visited = tree.best(asked, np.arange(4000), 10, [])
        assert top == sorted(((int(s), -i) for i, s in enumerate(scores) if s), reverse=True)[:10]
        assert visited < tree.leaves / 8
