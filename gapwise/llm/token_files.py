"""Token ids in ORC files, and what the files say about each document.

The ids of a document are one array of integers, which ORC writes with its
integer run-length encoding in stripes that tasks read in parallel. Every stripe
has row indexes and a Bloom filter on the document ids, so that a lookup of a few
documents skips the other stripes and row groups without reading their ids.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gapwise.llm.tokens import check_tokenizer, encoder

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("part", T.IntegerType()),
        T.StructField("part_start", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids", T.ArrayType(T.IntegerType(), False)),
    ]
)
#: Ids in one Arrow batch on their way to the JVM.
BATCH_IDS = 500_000


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    kind: str = "byte",
    end_id: int = 0,
    parts: int | None = None,
    stripe_bytes: int = 32 << 20,
    index_stride: int = 1_000,
    escape: bool = False,
) -> None:
    """Writes the ids of every `text` of `docs`, `end_id` after each, to ORC files below `path`.

    Files, and rows in a file, are in ascending order of (doc_id, hash of the text);
    null ids come first. A null text counts as empty and gives the end id alone.
    Rows that repeat an id are kept, each as a document of its own. Other columns
    are not read. A control string in a text gets its own id; with `escape` it is
    ordinary text. A row holds its document's `part` (number of the file in this
    order) and `part_start` (ids before it in its part), so that any reader finds
    its place in the whole without reading ids.
    """
    check_tokenizer(tokenizer, kind)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    keys = [F.col("doc_id"), F.xxhash64("text")]
    ordered = rows.repartitionByRange(*([parts] if parts else []), *keys).sortWithinPartitions(*keys)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, before = TaskContext.get().partitionId(), 0
        end = np.array([end_id], np.uint32)
        arrow = pa.schema(
            [("doc_id", pa.int64()), ("part", pa.int32()), ("part_start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32()))]
        )

        def batch(doc_ids: list, found: list[np.ndarray]) -> pa.RecordBatch:
            nonlocal before
            lengths = np.array([len(x) + 1 for x in found], np.int64)
            ends = np.cumsum(lengths)
            starts = before + ends - lengths
            before += int(ends[-1])
            offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
            ids = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([y for x in found for y in (x, end)]).view(np.int32)))
            columns = [pa.array(doc_ids, pa.int64()), pa.array(np.full(len(found), part, np.int32)), pa.array(starts), pa.array(lengths), ids]
            return pa.RecordBatch.from_arrays(columns, schema=arrow)

        ids_of = encoder(tokenizer, kind, escape).encode
        for got in batches:
            doc_ids, found, size = [], [], 0
            for doc_id, ids in zip(got.column(0).to_pylist(), ids_of(got.column(1))):
                doc_ids.append(doc_id)
                found.append(ids)
                size += len(ids) + 1
                if size >= BATCH_IDS:
                    yield batch(doc_ids, found)
                    doc_ids, found, size = [], [], 0
            if found:
                yield batch(doc_ids, found)

    (
        ordered.mapInArrow(encode, SCHEMA)
        .write.option("orc.stripe.size", stripe_bytes)
        .option("orc.row.index.stride", index_stride)
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", "0.01")
        .orc(path)
    )


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the files; filters on doc_id reach their statistics and Bloom filters."""
    return spark.read.schema(SCHEMA).orc(path)


def places(spark: SparkSession, path: str) -> DataFrame:
    """part, base: the ids in all parts before each; one row per part that has rows."""
    ends = read_token_files(spark, path).groupBy("part").agg(F.max(F.col("part_start") + F.col("n_tokens")).alias("in_part"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return ends.select("part", F.coalesce(F.sum("in_part").over(before), F.lit(0)).alias("base"))


def token_report(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens, ids_crc32, all from the files at `path`."""

    def checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for got in batches:
            ids = got.column(3)
            ends = ids.offsets.to_numpy()
            raw = memoryview(ids.values.to_numpy(zero_copy_only=True).astype("<i4", copy=False)).cast("B")
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(ends[:-1], ends[1:])]
            columns = [got.column(0), got.column(1), got.column(2), pa.array(np.diff(ends), pa.int64()), pa.array(crc, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "part", "part_start", "n_tokens", "ids_crc32"])

    found = (
        read_token_files(spark, path)
        .select("doc_id", "part", "part_start", "ids")
        .mapInArrow(checksums, "doc_id long, part int, part_start long, n_tokens long, ids_crc32 long")
    )
    # one row per file, as many as tasks of the writing job
    return found.join(F.broadcast(places(spark, path)), "part").select(
        "doc_id", (F.col("base") + F.col("part_start")).alias("start"), "n_tokens", "ids_crc32"
    )
