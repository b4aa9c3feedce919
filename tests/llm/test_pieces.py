import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")

from gapwise.llm.pieces import EDIT, PieceEncoder, Vocabulary, decoded, edited, encode_n_best, lattice_text  # noqa: E402

MODEL = public_tokenizers.path("piece_bpe_32k.model")
PARTS = ["a", "the ", "er", "in", " ", ".", ",", "\n", "  ", "▁", "é", "\U0001f600", "w.", "\t", "\r", ")", "x", "tion", ""]


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary(MODEL)


def brute_scores(vocabulary, text, n):
    """The best scores by listing the n best for each beginning of the text."""
    lattice = lattice_text(" " + text) if text else ""
    best = [[0.0]] + [[] for _ in lattice]
    for j in range(1, len(lattice) + 1):
        for i in range(j):
            node = vocabulary.trie
            for char in lattice[i:j]:
                node = node.get(char) if node is not None else None
            known = node and node.get("")
            if known or j == i + 1:
                best[j] += [s + (known[0] if known else vocabulary.unknown) for s in best[i]]
        best[j] = sorted(best[j], reverse=True)[:n]
    return best[-1]


@pytest.mark.parametrize("remember", [600_000, 40])
def test_best_scores_are_those_of_brute_force(vocabulary, remember):
    r = random.Random(5)
    texts = ["".join(r.choice(PARTS) for _ in range(r.randint(0, 14))) for _ in range(800)] + [None, ""]
    encoder = PieceEncoder(MODEL, 3, remember)
    for start in range(0, len(texts), 40):
        some = texts[start : start + 40]
        for text, (score, _, others) in zip(some, encoder.segment(pa.array(some, pa.string()))):
            assert np.allclose([score, *(s for s, _ in others)], brute_scores(vocabulary, text or "", 3))


def test_all_segmentations_decode_to_the_text(spark):
    r = random.Random(6)
    rows = [(i, "".join(r.choice(PARTS) for _ in range(r.randint(0, 30)))) for i in range(300)]
    rows += [(1000, None), (1001, ""), (1002, " "), (1003, "x" * 3000 + " y" * 700_000), (1004, "a b"), (1004, "a b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "0 AS ids", "0 AS score")
    found = encode_n_best(docs, MODEL).join(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).distinct(), "doc_id")
    nothing = F.array().cast(f"array<{EDIT}>")
    best = decoded("ids", MODEL) == F.col("text")
    other = lambda i: decoded(edited("ids", F.coalesce(F.get("others", i)["edits"], nothing)), MODEL) == F.col("text")
    checked = found.select("doc_id", best.alias("a"), other(0).alias("b"), other(1).alias("c")).collect()
    assert len(checked) == len(rows) and all(x.a and x.b and x.c for x in checked)
    assert encode_n_best(docs.limit(0), MODEL).count() == 0


def test_texts_share_the_lattice_of_a_common_beginning(vocabulary):
    """Beginnings are not solved again, and what came before changes no segmentation."""
    _, edges = vocabulary._lattice(lattice_text(" wintering"))
    kept = list(edges)
    assert vocabulary._lattice(lattice_text(" winterly"))[1][:8] == kept[:8]
    assert all(a is b for a, b in zip(vocabulary.into[:8], kept))
    r = random.Random(7)
    words = [lattice_text(" " + "".join(r.choice("abeinrst▁é") for _ in range(r.randint(1, 9)))) for _ in range(300)]
    alone = {}
    for word in words:
        vocabulary._lattice("")
        alone[word] = vocabulary.n_best(word, 3)
    for order in (words, sorted(words), sorted(words, reverse=True)):
        assert all(vocabulary.n_best(word, 3) == alone[word] for word in order)
