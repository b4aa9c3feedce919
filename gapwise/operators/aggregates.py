"""Grouped counts with a status, and ordered concatenation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapwise.operators.skew import HotKeys, lookup_join


def grouped_count_status(
    df: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    missing: str,
    *,
    counted: str | None = None,
    count_name: str = "n",
    status_name: str = "status",
    present: str | None = None,
    **options,
) -> DataFrame:
    """Count the partners of each row and label those that have none.

    Equal to a left join with ``GROUP BY`` and ``COUNT(column)``: rows of
    ``right`` whose ``counted`` column is NULL do not count. The right side is
    counted before the join, so that its rows never fan out over ``df``, whose
    ``keys`` identify its rows.
    """
    one = F.col(counted) if counted else F.lit(1)
    counts = right.groupBy(*keys).agg(F.count(one).alias(count_name))
    joined = lookup_join(df, counts, keys, **options)
    n = F.coalesce(F.col(count_name), F.lit(0))
    return joined.withColumn(count_name, n).withColumn(
        status_name, F.when(F.col(count_name) == 0, F.lit(missing)).otherwise(F.lit(present))
    )


def grouped_concat(
    df: DataFrame,
    key: str,
    order_by: Sequence[str],
    value: str,
    sep: str,
    *,
    name: str = "text",
    condition: Column | None = None,
    hot: HotKeys | None = None,
    pieces: bool = False,
    run_parts: int = 8,
) -> DataFrame:
    """Values of each group as one text, in the order of ``order_by``, NULLs left out.

    Rows of hot keys are dealt to tasks by ranges of key, order and value, about
    ``run_parts`` ranges for each part of a hot key. What a task has of a group is a run
    of the group's order, whatever ties there are in the leading column; the runs are
    joined to texts, and only these texts meet for the group, in the order of the ranges.
    With ``pieces`` the text comes as one row per value of the leading order column, for
    groups whose whole text would not fit one row.
    """
    if condition is not None:
        df = df.where(condition)
    lead = order_by[0]
    kept = df.where(F.col(value).isNotNull())
    group = [key, lead] if pieces else [key]
    if not hot:
        return kept.groupBy(*group).agg(_in_order(order_by, value, sep).alias(name))
    is_hot = F.coalesce(F.col(key).isin(list(hot)), F.lit(False))
    plain = kept.where(~is_hot).groupBy(*group).agg(_in_order(order_by, value, sep).alias(name))
    texts = _joined_runs(kept.where(is_hot), group, [key, *order_by, value], order_by, value, sep, name, run_parts * sum(hot.values()))
    return plain.unionByName(texts)


def _in_order(order_by: Sequence[str], value: str, sep: str) -> Column:
    row = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order_by)], F.col(value).alias("v"))
    in_order = F.array_sort(F.collect_list(row))
    return F.array_join(F.transform(in_order, lambda e: e["v"].cast("string")), sep)


def _joined_runs(
    df: DataFrame, group: Sequence[str], sort: Sequence[str], order_by: Sequence[str], value: str, sep: str, name: str, ranges: int
) -> DataFrame:
    """Texts of runs, and of them the texts of groups.

    Rows that are equal in all of these columns may go to either side of a bound; the
    task that read them tells them apart, so that no run takes all of them.
    """
    dealt = df.withColumn("_from", F.spark_partition_id()).repartitionByRange(ranges, *sort, "_from")
    runs = dealt.withColumn("_run", F.spark_partition_id()).groupBy(*group, "_run").agg(_in_order(order_by, value, sep).alias(name))
    in_order = F.array_sort(F.collect_list(F.struct("_run", name)))
    return runs.groupBy(*group).agg(F.array_join(F.transform(in_order, lambda e: e[name]), sep).alias(name))
