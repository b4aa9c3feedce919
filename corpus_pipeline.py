"""The corpus pipeline: stages that turn raw documents into packed training sequences."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gapwise.llm.near_duplicates import near_duplicates, text_key
from gapwise.llm.packing import cut_pieces, pack
from gapwise.llm.personal_data import masked, with_personal_data
from gapwise.llm.quality import fit, score
from gapwise.llm.staging import spare, staged

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: A document needs this score to stay.
LEAST_QUALITY = 0.5


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on `labels`, takes for good ones; the same columns."""
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    names = tuple(spare(name, docs.columns) for name in ("content_score", "metadata_score", "quality_score"))
    return _only(score(docs, model, into=names).where(F.col(names[2]) >= LEAST_QUALITY), docs.columns)


def deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity 0.8); the same columns.

    The one with the smallest doc_id stays, one without an id only if no other has
    one, and of several texts of this id one; of rows that repeat an id and a text one.
    Documents without words are no group, whatever their ids.
    """
    found = near_duplicates(docs, width=5, at_least=80, rows=6)
    key, own = F.struct("doc_id", "text_key"), F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")
    first = found.groupBy("group_id", F.when(F.col("group_id").isNull(), key).alias("alone")).agg(F.min(own).alias("first"))
    name, text, id_ = (spare(name, docs.columns) for name in ("text_key", "kept_text", "kept_id"))
    kept = first.select(F.col("first.doc_id").alias(id_), F.col("first.text_key").alias(text))
    rows = docs.withColumn(name, text_key(F.col("text").cast("string")))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(id_)) & (F.col(name) == F.col(text))
    return _only(rows.join(kept, same, "left_semi").dropDuplicates(["doc_id", name]), docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced by its kind; n_chars follows."""
    spans = spare("spans", docs.columns)
    found = with_personal_data(docs, into=spans)
    text = masked(F.coalesce("text", F.lit("")), F.col(spans))
    rows = found.withColumn("text", F.when(F.col("text").isNotNull(), text))
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.char_length("text").cast("long")).otherwise(F.col("n_chars")))
    return _only(rows, docs.columns)


def _only(rows: DataFrame, names: list[str]) -> DataFrame:
    return rows.select(*(F.col("`" + name.replace("`", "``") + "`") for name in names))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in sequences of 2048 tokens."""
    import public_tokenizers

    return pack(cut_pieces(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality),
    ("near deduplication", deduplication),
    ("personal data", personal_data),
    ("best-fit packing", packing),
]

#: SQL can express neither the classifier nor the packing; the stages are tested one by one.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each result written as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
