"""Scalar helpers whose exact form matters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_timestamp(column: Column, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Text to a timestamp that keeps the time of day."""
    return F.to_timestamp_ntz(column, F.lit(pattern))


def id_from_text(column: Column) -> Column:
    """The id held in a text column, NULL where the text is no whole number."""
    return column.try_cast("bigint")


def age_seconds(modified_at: Column, as_of: Column) -> Column:
    return F.unix_timestamp(as_of) - F.unix_timestamp(modified_at)
