"""Report on old files. Nothing is ever deleted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gapwise.functions.scalars import age_seconds


def stale_files(
    spark: SparkSession, path: str, days: int, as_of: Column | None = None
) -> DataFrame:
    """Files below a path with their age; stale if older than ``days``.

    The comparison is strict. File contents are pruned from the scan, so that
    only the listing is read. ``as_of`` defaults to the current time.
    """
    now = F.current_timestamp() if as_of is None else as_of
    listing = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    )
    return (
        listing.select("path", "length", F.col("modificationTime").alias("modified_at"))
        .withColumn("age_seconds", age_seconds(F.col("modified_at"), now))
        .withColumn("is_stale", F.col("age_seconds") > days * 24 * 60 * 60)
    )
