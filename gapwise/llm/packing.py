"""Packs pieces of texts into sequences of a fixed number of tokens."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gapwise.llm.packing_plan import plan
from gapwise.llm.staging import staged
from gapwise.llm.tokens import check_tokenizer, encoder

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut_pieces(docs: DataFrame, tokenizer: str, kind: str = "word", end_id: int = 0, capacity: int = 2048, escape: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32.

    A document is the ids of its `text` and `end_id`. Only documents of more than
    `capacity` ids are cut, into pieces of `capacity` ids, the last maybe shorter. A
    null text is empty and gives one piece of one id. Other columns are not read.
    Repeated rows give repeated pieces. A control string in a text gets its own id;
    with `escape` it is ordinary text.
    """
    check_tokenizer(tokenizer, kind)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, end = encoder(tokenizer, kind, escape).encode, np.array([end_id], "<u4")
        for got in batches:
            rows: list[tuple] = []
            for doc_id, ids in zip(got.column(0).to_pylist(), ids_of(got.column(1))):
                ids = np.concatenate([ids, end]).astype("<u4", copy=False)
                for i, at in enumerate(range(0, len(ids), capacity)):
                    own = ids[at : at + capacity]
                    rows.append((doc_id, i, at, len(own), zlib.crc32(own)))
            if rows:
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(cut, PIECES)


def numbered(pieces: DataFrame) -> DataFrame:
    """`pieces` with `_part` and `_nth`: which task met a row, and how many of its length it met before."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, met = TaskContext.get().partitionId(), {}
        for got in batches:
            nth = []
            for length in got.column("length").to_pylist():
                nth.append(k := met.get(length, 0))
                met[length] = k + 1
            columns = [*got.columns, pa.array(np.full(len(nth), part, np.int32)), pa.array(nth, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*got.schema.names, "_part", "_nth"])

    schema = pieces.select("*", F.lit(0).alias("_part"), F.lit(0).cast("long").alias("_nth")).schema
    return pieces.mapInArrow(number, schema)


def pack(pieces: DataFrame, capacity: int = 2048, small: float = 1 / 8, groups: int = 96) -> DataFrame:
    """`pieces` with sequence_id and offset: its place in sequences of at most `capacity`.

    Needs a column `length` (long, from 1 to `capacity`; else ValueError, null
    included); keeps all other columns, for which the names _part and _nth are not
    allowed. Repeated rows are packed each for itself. Of the whole input the
    driver sees the number of pieces of each length, `capacity` rows at most.
    Sequences are as few as the plan finds (see `packing_plan.plan`); each is full
    from 0 without a hole. Without rows the result is empty.
    """
    if {"_part", "_nth", "sequence_id", "offset"} & set(pieces.columns):
        raise ValueError("_part, _nth, sequence_id and offset are names of this operator")
    # written before they are numbered, so that a task has one Python process at a time
    written = staged(pieces.withColumn("length", F.col("length").cast("long")), "cut")
    rows = staged(numbered(written), "pieces")
    met = staged(rows.groupBy("length", "_part").agg(F.count("*").alias("n")), "lengths")
    ends = met.agg(F.min("length"), F.max("length"), F.count(F.when(F.col("length").isNull(), 1))).first()
    if ends[2] or ends[0] is not None and (ends[0] < 1 or ends[1] > capacity):
        raise ValueError(f"length must be from 1 to {capacity}")
    totals = {r["length"]: r["n"] for r in met.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = met.select("length", "_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_base"))
    # each task of the numbering has at most `capacity` lengths, so no key of this join is hot
    ranked = rows.join(bases, ["length", "_part"]).withColumn("_rank", F.col("_base") + F.col("_nth"))
    place = _places(totals, capacity, small, groups)
    schema = ranked.select(*pieces.columns, F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset")).schema

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for got in batches:
            length, rank = (got.column(c).to_numpy() for c in ("length", "_rank"))
            sequence, offset = place(length, rank)
            columns = [got.column(c) for c in schema.names[:-2]]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sequence), pa.array(offset)], names=schema.names)

    return ranked.select(*pieces.columns, "_rank").mapInArrow(put, schema)


def _places(totals: dict[int, int], capacity: int, small: float, groups: int):
    """A function from lengths and ranks in them to sequences and offsets.

    A run of a class of bins takes a range of ranks of its length. The table of
    runs is as long as the plan, which `capacity` bounds, and not as the input.
    """
    taken: dict[int, int] = {}
    runs, sequence = [], 0
    for bins in plan(totals, capacity, small, groups):
        offset = 0
        for length, copies in bins.runs:
            first = taken.get(length, 0)
            runs.append((length, first, copies, sequence, offset))
            taken[length] = first + copies * bins.count
            offset += length * copies
        sequence += bins.count
    table = np.array(sorted(runs), np.int64).reshape(-1, 5)

    def place(length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        if not len(length):
            return sequence, offset
        for own in np.unique(length):
            at = np.flatnonzero(length == own)
            lo, hi = np.searchsorted(table[:, 0], [own, own + 1])
            run = table[lo + np.searchsorted(table[lo:hi, 1], rank[at], "right") - 1]
            in_run = rank[at] - run[:, 1]
            sequence[at] = run[:, 3] + in_run // run[:, 2]
            offset[at] = run[:, 4] + in_run % run[:, 2] * own
        return sequence, offset

    return place
