"""Intermediate results as Parquet in the folder that all executors share."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from gapwise.operators.staging import shared_folder

#: Rows of one Arrow batch between the JVM and Python; whole texts make larger ones heavy on both sides.
BATCH = 2_000
_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def new_folder(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing has used yet."""
    return f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """`df` written once and read again: cuts the lineage, survives lost executors.

    The files stay until the owner of the shared folder removes them, since the
    frames that read them are lazy. While it is written, Arrow batches have at most
    `BATCH` rows; the session's own setting holds again afterwards.
    """
    spark = df.sparkSession
    path, before = new_folder(spark, name), spark.conf.get(_ROWS)
    spark.conf.set(_ROWS, str(BATCH if int(before) <= 0 else min(BATCH, int(before))))
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_ROWS, before)
    return spark.read.schema(df.schema).parquet(path)


def spare(name: str, taken: Sequence[str]) -> str:
    """`name` behind as many underscores as no column of `taken` has, whatever its case."""
    used = {c.lower() for c in taken}
    while name.lower() in used or not name.startswith("_"):
        name = "_" + name
    return name
