"""Existence flags, lookups and the other join shapes of the analysis."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapwise.operators.skew import HotKeys, left_spread_join, lookup_join, spread_join, without_partner
from gapwise.operators.staging import cut_to_keys


def left_outer_join(left: DataFrame, right: DataFrame, keys: Sequence[str], **options) -> DataFrame:
    """Every left row with each of its partners, or with NULLs where it has none.

    Keyword arguments go to :func:`gapwise.operators.skew.left_spread_join`, which splits
    hot keys of either side.
    """
    return left_spread_join(left, right, keys, **options)


def left_join_on_filter(
    left: DataFrame, right: DataFrame, keys: Sequence[str], right_condition: Column, **options
) -> DataFrame:
    """Left join whose ON clause also restricts the right side; no left row is lost."""
    return left_spread_join(left, right.where(right_condition), keys, **options)


def two_hop_absence(
    df: DataFrame,
    link: DataFrame,
    target: DataFrame,
    key: str,
    target_key: str,
    *,
    hot_key: Callable[[], HotKeys] | None = None,
    hot_target: Callable[[], HotKeys] | None = None,
) -> DataFrame:
    """Rows of ``df`` that reach no row of ``target`` through ``link``.

    A link to a target that does not exist counts as absence, and a row of
    ``df`` comes out once however many links it has. ``link`` has the columns
    ``key`` and ``target_key``. Links are first cut to the keys of ``df``, so
    that the second hop sees only those that can matter. ``hot_*`` give hot keys of
    the link where a cut has to shuffle.
    """
    links = cut_to_keys(link.select(key, target_key), df, key, hot_key, [target_key])
    if hot_target:
        links = links.distinct()  # copies of a link would share their salt
    reached = cut_to_keys(links, target, target_key, hot_target, [key])
    return without_partner(df, reached, [key])


def unique_rows(df: DataFrame, keys: Sequence[str], named: bool = False) -> DataFrame:
    """``df``, of which no two rows may have the same keys: a second one is an error that names them.

    Counted by an aggregate with a map side, whose rows are the result. Keys with a NULL
    name nothing and may repeat; with ``named`` such rows are left out, and the keys
    alone are grouped by, so that a join by them needs no further shuffle or sort.
    """
    rest = [c for c in df.columns if c not in keys]
    message = F.concat(F.lit("more than one row for key "), F.to_json(F.struct(*keys)))
    if named:
        found = df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *[F.min(c).alias(c) for c in rest])
        once = F.when(F.col("_n") > 1, F.raise_error(message).cast("boolean")).otherwise(True)
        return found.where(once).select(*df.columns)
    unnamed = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    apart = F.when(unnamed, F.xxhash64(*df.columns)).alias("_apart")
    found = df.groupBy(*keys, apart).agg(F.count(F.lit(1)).alias("_n"), *[F.min(c).alias(c) for c in rest])
    once = F.when((F.col("_n") > 1) & F.col("_apart").isNull(), F.raise_error(message).cast("boolean")).otherwise(True)
    copies = F.explode(F.sequence(F.lit(1), F.col("_n")))  # of rows that name nothing
    return found.where(once).withColumn("_copy", copies).select(*df.columns)


def exists_flag(
    df: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    name: str,
    **lookup,
) -> DataFrame:
    """Add a boolean column: does the right side have a row with these keys?

    Never NULL and never changes the number of rows. Keyword arguments go to
    :func:`gapwise.operators.skew.lookup_join`.
    """
    marks = right.select(*keys).distinct().withColumn(name, F.lit(True))
    joined = lookup_join(df, marks, keys, **lookup)
    return joined.withColumn(name, F.coalesce(F.col(name), F.lit(False)))


def missing_flag(df: DataFrame, right: DataFrame, keys: Sequence[str], name: str, **lookup) -> DataFrame:
    """The opposite of :func:`exists_flag`; several keys test one composite key."""
    return exists_flag(df, right, keys, name, **lookup).withColumn(name, ~F.col(name))


def not_exists(
    df: DataFrame, right: DataFrame, keys: Sequence[str], *, hot: HotKeys | None = None, spread: Sequence[str] = ()
) -> DataFrame:
    """Rows of ``df`` without a partner.

    The right side is reduced to its distinct keys on the map side; ``hot`` names hot
    keys of ``df``, ``spread`` the columns that split their rows and those with a NULL key.
    """
    return without_partner(df, right, keys, hot=hot, spread=spread)


def unique_lookup(
    df: DataFrame, lookup: DataFrame, keys: Sequence[str], value: str, **options
) -> DataFrame:
    """Add one value per key. More than one row for a key that is used is an error."""
    per_key = lookup.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.min(value).alias(value)
    )
    joined = lookup_join(df, per_key, keys, **options)
    checked = F.when(
        F.col("_n") > 1,
        F.raise_error(F.concat(F.lit("more than one row for key "), F.to_json(F.struct(*keys)))),
    ).otherwise(F.col(value))
    return joined.withColumn(value, checked).drop("_n")


def first_match(
    df: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    columns: Sequence[str],
    **options,
) -> DataFrame:
    """Add columns of the lookup row that comes first in ascending order.

    The order has to be total for the result to be determined; the looked up
    columns break remaining ties. The minimum is taken on the map side, so that
    a key with many rows never moves them to one task. NULL sorts first.
    """
    ranked = F.struct(*order_by, *[F.col(c).alias(f"_v_{c}") for c in columns])
    best = lookup.groupBy(*keys).agg(F.min(ranked).alias("_best"))
    flat = best.select(*keys, *[F.col(f"_best._v_{c}").alias(c) for c in columns])
    return lookup_join(df, flat, keys, **options)


def nested_lookup(
    df: DataFrame,
    outer: DataFrame,
    inner: DataFrame,
    outer_key: str,
    inner_key: str,
    value: str,
    *,
    hot_inner: HotKeys | None = None,
) -> DataFrame:
    """``outer_key`` to the lowest ``inner_key``, and from there to the lowest value."""
    hop = outer.groupBy(outer_key).agg(F.min(inner_key).alias(inner_key))
    with_hop = lookup_join(df, hop, [outer_key])
    values = inner.groupBy(inner_key).agg(F.min(value).alias(value))
    return lookup_join(with_hop, values, [inner_key], hot=hot_inner, spread=[outer_key])


def count_zero_flag(df: DataFrame, right: DataFrame, keys: Sequence[str], name: str, **options) -> DataFrame:
    """True where the count of partners is zero."""
    counts = right.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    joined = lookup_join(df, counts, keys, **options)
    return joined.withColumn(name, F.coalesce(F.col("_n"), F.lit(0)) == 0).drop("_n")


def or_key_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_keys: Sequence[str],
    *,
    how: str = "left",
    hot: HotKeys | None = None,
    hot_right: Sequence[HotKeys] = (),
) -> DataFrame:
    """Join where the left key may equal any of several right columns.

    The right columns become rows, one per distinct value, which leaves an equi
    join. A right row whose columns hold the same value matches once. ``hot`` has
    hot values of the left key, ``hot_right`` those of each right column in turn; a
    value that is hot in several of them has the rows of all.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"an inner or a left join, not {how!r}")
    by_key = right.withColumn("_keys", F.array_distinct(F.array(*right_keys))).select(
        F.explode("_keys").alias("_key"), *right.columns
    )
    by_key = by_key.where(F.col("_key").isNotNull())
    keyed = left.withColumn("_key", F.col(left_key))
    parts: dict[object, int] = {}
    for own in hot_right:
        for value, n in own.items():
            parts[value] = parts.get(value, 0) + n
    if how == "left":
        return left_spread_join(keyed, by_key, ["_key"], hot_left=hot, hot_right=parts).drop("_key")
    return spread_join(keyed, by_key, ["_key"], hot_left=hot, hot_right=parts).drop("_key")


def unpivot_keys(right: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """``(kind, key)`` rows for each key column; ``kinds`` maps kind to column."""
    entries = F.array(
        *[F.struct(F.lit(kind).alias("kind"), F.col(c).alias("key")) for kind, c in kinds.items()]
    )
    return right.select(F.inline(entries)).where(F.col("key").isNotNull())


def two_key_column_lookup(
    left: DataFrame,
    right: DataFrame,
    kind: Column,
    key: str,
    kinds: dict[str, str],
    name: str,
    **options,
) -> DataFrame:
    """Look a value up in the key column that ``kind`` names on each left row.

    Adds the value itself where it was found. The choice of column becomes part
    of an equi key instead of a condition that only a nested loop could test.
    """
    entries = unpivot_keys(right, kinds).distinct().select(
        F.col("key").alias(key), F.col("kind").alias("_kind"), F.col("key").alias(name)
    )
    return lookup_join(left.withColumn("_kind", kind), entries, [key, "_kind"], **options).drop("_kind")


def state_gated_join(
    left: DataFrame, right: DataFrame, gate: Column, keys: Sequence[str], **options
) -> DataFrame:
    """Left join that happens only on rows where the gate holds.

    The first key is set to NULL where the gate is closed, so that the
    condition on the left side becomes part of the key. Closed rows are spread by
    a hash of all their columns, unless ``spread`` names others, and don't meet.
    """
    first = keys[0]
    options.setdefault("spread", left.columns)
    gated = left.withColumn("_keep", F.col(first)).withColumn(first, F.when(gate, F.col(first)))
    joined = lookup_join(gated, right, keys, **options)
    return joined.withColumn(first, F.col("_keep")).drop("_keep").select(
        *left.columns, *[c for c in right.columns if c not in keys]
    )


def star_inner_join(
    hub: DataFrame,
    points: Sequence[DataFrame],
    key: str,
    *,
    hot: Sequence[HotKeys] = (),
) -> DataFrame:
    """Hub joined to several frames on one key; matches per key multiply.

    All joins share the partitioning by the key. ``hot`` may give the hot keys
    of the hub and of each point in turn; such keys are then split on the side
    that has the many rows, and again on the growing result.
    """
    profiles = list(hot) + [{}] * (1 + len(points) - len(hot))
    joined, grown = hub, dict(profiles[0])
    for point, own in zip(points, profiles[1:]):
        joined = spread_join(joined, point, [key], hot_left=grown, hot_right=own)
        for value, parts in own.items():
            grown[value] = parts * grown.get(value, 1)  # as the rows of the key do
    return joined


def wide_left_assembly(
    base: DataFrame, checks: Sequence[tuple[DataFrame, Sequence[str]]]
) -> DataFrame:
    """Attach results of several checks; each is already at the grain of its key."""
    for check, keys in checks:
        base = base.join(check, list(keys), "left")
    return base
