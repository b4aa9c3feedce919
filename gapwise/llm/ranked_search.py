"""Ranks all documents for each of a stated set of queries by term weights, exactly."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gapwise.llm.ball_tree import BallTree
from gapwise.llm.staging import staged

#: Letters and digits of ASCII and all bytes of other characters; only A-Z are made lower case.
TERM = re.compile(rb"[0-9a-z\x80-\xff]+")


@dataclass(frozen=True)
class Blocks:
    """Bounds of what one task holds.

    rows        documents of one tree
    entries     terms of documents of one tree, if that is reached before
    leaf        documents of a leaf
    vocabulary  different terms of the queries that are answered at once; more
                queries make more rounds over the documents
    queries     queries answered at once
    """

    rows: int = 8192
    entries: int = 2_000_000
    leaf: int = 64
    vocabulary: int = 16_384
    queries: int = 4096


def terms_of(text: str | None) -> list[bytes]:
    return TERM.findall(text.encode().lower()) if text else []


def ranked_search(docs: DataFrame, queries: DataFrame, k: int = 10, blocks: Blocks = Blocks()) -> DataFrame:
    """item_id, rank, doc_id, score: for each query the `k` documents with the highest scores above 0.

    `docs` has doc_id and text, `queries` item_id and text; other columns are not read.
    Terms are runs of ASCII letters and digits and of all characters beyond ASCII, A-Z
    in lower case. N documents have terms, L in all, one document n of them. A term
    that df documents have weighs w = floor(1000 ln((2N + 2) / (2 df + 1))). A
    document with tf of them adds w * (10^9 tf div (1000 tf + 8 m)) to its score, where
    m = 10 + 90 n N div L; each term of a query counts once.

    Null and empty texts have no terms. Equal scores go to smaller ids. Rows that
    repeat a doc_id are documents each for itself; rows without doc_id count in N, L
    and df and are not ranked. Of several texts of one item_id the least counts, rows
    without item_id or terms have no results. Without documents there are no rows.

    The queries come to the driver one after another and are answered in groups
    whose size `blocks` bounds. For a group the documents are reduced to their counts of
    its terms and these are written; each task then builds ball trees over blocks of
    documents as it meets them and searches them best-first, and no document is shuffled.
    """
    asked = queries.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    asked = asked.where("item_id IS NOT NULL AND text IS NOT NULL").groupBy("item_id").agg(F.min("text").alias("text"))
    found = [_answered(docs, group, k, blocks) for group in _groups(asked, blocks)]
    spark = docs.sparkSession
    pairs = reduce(DataFrame.unionAll, found) if found else spark.createDataFrame([], "item_id long, doc_id long, score long")
    best = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    return pairs.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def _groups(asked: DataFrame, blocks: Blocks) -> Iterator[dict[int, set[bytes]]]:
    """Queries and their terms, as many at once as the bounds allow, one at least."""
    group: dict[int, set[bytes]] = {}
    known: set[bytes] = set()
    for row in asked.toLocalIterator():
        terms = set(terms_of(row["text"]))
        if group and (len(known | terms) > blocks.vocabulary or len(group) == blocks.queries):
            yield group
            group, known = {}, set()
        if terms:
            group[row["item_id"]] = terms
            known |= terms
    if group:
        yield group


def _term_groups(queries: dict[int, set[bytes]]) -> dict[bytes, int]:
    """Terms and their groups, by group: those that only one query has are that query's, any other is one by itself."""
    users = Counter(term for terms in queries.values() for term in terms)
    own = sorted((item, term) for item, terms in queries.items() for term in terms if users[term] == 1)
    number = {item: i for i, item in enumerate(dict.fromkeys(item for item, _ in own))}
    shared = sorted(term for term, n in users.items() if n > 1)
    return {term: number[item] for item, term in own} | {term: len(number) + i for i, term in enumerate(shared)}


def term_counts(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n, terms, counts of each row with terms: how many it has, and those of a vocabulary with their numbers."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.keys()
        for got in batches:
            ids, sizes, ends, terms, counts = [], [], [0], [], []
            for doc_id, text in zip(got.column(0).to_pylist(), got.column(1)):
                words = terms_of(text.as_py())
                if not words:
                    continue
                met = Counter(words)
                own = sorted((vocabulary[t], met[t]) for t in met.keys() & known)
                ids.append(doc_id)
                sizes.append(len(words))
                terms += [t for t, _ in own]
                counts += [c for _, c in own]
                ends.append(len(terms))
            offsets = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(terms, pa.int32())),
                    pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int64())),
                ],
                names=["doc_id", "n", "terms", "counts"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(count, "doc_id long, n long, terms array<int>, counts array<long>")


def _answered(docs: DataFrame, group: dict[int, set[bytes]], k: int, blocks: Blocks) -> DataFrame:
    """item_id, doc_id, score: the best `k` of each task."""
    groups = _term_groups(group)
    vocabulary = {term: i for i, term in enumerate(groups)}
    of_term = np.array(list(groups.values()), np.int64)
    counted = staged(term_counts(docs, vocabulary), "term-counts")
    total, length = counted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    # as many rows as the vocabulary, which is bounded
    having = counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).collect()
    weight = np.zeros(len(vocabulary), np.int64)
    for term, df in having:
        weight[term] = math.floor(1000 * math.log((2 * total + 2) / (2 * df + 1)))
    asked = {item: np.array(sorted(vocabulary[t] for t in terms), np.int64) for item, terms in group.items()}

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top: dict[int, list[tuple[int, int]]] = {item: [] for item in asked}
        for ids, first, terms, values in _trees(batches, weight, total, length, blocks):
            used, local = np.unique(terms, return_inverse=True)
            tree = BallTree(first, local, values, of_term[used], blocks.leaf)
            for item, wanted in asked.items():
                at = np.searchsorted(used, wanted)
                here = at[(at < len(used)) & (used[np.minimum(at, len(used) - 1)] == wanted)]
                if len(here):
                    top[item], _ = tree.best(here, ids, k, top[item])
        rows = [(item, -minus, score) for item, best in top.items() for score, minus in best]
        columns = list(zip(*rows)) or [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["item_id", "doc_id", "score"])

    return counted.where("doc_id IS NOT NULL AND size(terms) > 0").mapInArrow(search, "item_id long, doc_id long, score long")


def _trees(
    batches: Iterator[pa.RecordBatch], weight: np.ndarray, total: int, length: int, blocks: Blocks
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, offsets, terms and weighted values of blocks of documents."""
    held: list[tuple[np.ndarray, ...]] = []
    rows = entries = 0
    for got in batches:
        ids, n = got.column("doc_id").to_numpy(), got.column("n").to_numpy()
        size = np.diff(got.column("terms").offsets.to_numpy())
        terms, tf = (got.column(c).flatten().to_numpy() for c in ("terms", "counts"))
        m = 10 + 90 * n * total // length
        values = weight[terms] * (10**9 * tf // (1000 * tf + 8 * np.repeat(m, size)))
        ends = np.concatenate([[0], np.cumsum(size)])
        at = 0
        while at < len(ids):
            room = int(np.searchsorted(ends, ends[at] + blocks.entries - entries, "right")) - 1 - at
            take = min(len(ids) - at, blocks.rows - rows, room) if rows else max(1, min(len(ids) - at, blocks.rows, room))
            if take > 0:
                i, j = ends[at], ends[at + take]
                held.append((ids[at : at + take], size[at : at + take], terms[i:j], values[i:j]))
                rows, entries, at = rows + take, entries + int(j - i), at + take
            if at < len(ids):
                yield _joined(held)
                held, rows, entries = [], 0, 0
    if held:
        yield _joined(held)


def _joined(held: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    ids, size, terms, values = (np.concatenate(x) for x in zip(*held))
    return ids, np.concatenate([[0], np.cumsum(size)]), terms.astype(np.int64), values
