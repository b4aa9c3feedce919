"""Facts from several tables about the same key, gathered by one shuffle."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapwise.operators.skew import lookup_join


def any_true(column: Column | str) -> Column:
    """Aggregate of a flag that is False, not NULL, where no row speaks for it."""
    return F.coalesce(F.max(column), F.lit(False))


def gather_facts(
    df: DataFrame,
    key: str,
    sources: Sequence[DataFrame],
    aggregates: Mapping[str, Callable[[str], Column]],
    used: DataFrame | None = None,
) -> DataFrame:
    """Add columns aggregated per key from several frames of (key, value) rows.

    ``df`` keeps its rows. The sources are stacked and aggregated together, on the map
    side first, so that a key with very many rows reaches its task as a few partial
    results, and the aggregate is cut to the keys of ``df``. If Spark finds these keys
    few enough to broadcast it moves that cut below the aggregate into the scans of
    the sources; if not, it costs no further shuffle of the sources. ``used`` may name a
    written frame that has these keys, so that ``df`` is not computed for them as well.
    """
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sources)
    per_key = (
        stacked.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(*[how(column).alias(column) for column, how in aggregates.items()])
    )
    keys = (df if used is None else used).select(key).where(F.col(key).isNotNull())
    joined = lookup_join(df, per_key.join(keys, key, "left_semi"), [key])
    flags = [column for column, how in aggregates.items() if how is any_true]
    return joined.fillna(False, subset=flags) if flags else joined
