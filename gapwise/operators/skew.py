"""Joins that hold when one key has a large part of all rows.

Adaptive execution splits a skewed join only where both sides arrive straight
from a shuffle. A side that was aggregated on the join key does not, and nearly
every lookup here is aggregated to one row per key first. The split is
therefore part of the plan: rows of a hot key get a salt, and the few rows the
other side has for that key are repeated once per salt.

Which keys are hot comes from counts of the key column, made before the shuffle.
Fewer keys can be hot than the table has rows for each, so the list is short
against the table. It steers performance alone; a wrong or empty list gives the
same rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: key value -> number of parts its rows are split into
HotKeys = Mapping[object, int]


class Profile(dict):
    """Hot keys of a column, and how many of them an expression may list."""

    def __init__(self, hot: Mapping[object, int], listed: int):
        super().__init__(hot)
        self.listed = listed


@dataclass(frozen=True)
class SkewPolicy:
    """When a key counts as hot.

    hot_rows   rows of one key that one task can take; all keys with more are hot, and
               tables with fewer rows have none
    max_hot    hot keys up to which their list is part of an expression; a longer one
               is a broadcast table
    """

    hot_rows: int = 5_000_000
    max_hot: int = 2_000


def estimated_bytes(df: DataFrame) -> int | None:
    """Size that Spark's optimizer estimates, None if it can not be asked."""
    plan = getattr(df, "_jdf", None)
    if plan is None:
        return None
    return int(str(plan.queryExecution().optimizedPlan().stats().sizeInBytes()))


#: What a frequent-items sketch may hold, the hot keys the first one is made for, and the types it takes.
TRACKED = 1_000_000
MOST = 64
SKETCHED = ("bigint", "int", "smallint", "tinyint", "string", "date", "boolean")


def hot_keys(df: DataFrame, columns: Sequence[str], policy: SkewPolicy) -> dict[str, HotKeys]:
    """Hot values of each column, with the number of parts to split them into.

    One pass counts the rows and makes a frequent-items sketch of every column at once.
    A table without more rows than ``hot_rows`` has no hot key, whatever its size in
    bytes. The sketch never estimates a count too low, so that a table none of whose
    estimates is above ``hot_rows`` has none either. Only else one more pass counts the
    keys that have such an estimate, all columns together. No other key is shuffled. If
    more keys could be hot than a sketch was made for it is made again, and if more than
    one can hold a column is counted by all of its keys.
    """
    kinds = dict(df.dtypes)
    sketched = [c for c in columns if kinds[c] in SKETCHED]
    rows, named = _sketch(df, sketched, MOST)
    if rows <= policy.hot_rows:
        return {column: Profile({}, policy.max_hot) for column in columns}
    most = rows // policy.hot_rows  # no more keys can be hot
    if 16 * most > TRACKED:
        sketched = []
    elif most > MOST:
        named = _sketch(df, sketched, most)[1]
    found = _counted(df, {c: named[c] for c in sketched}, policy.hot_rows)
    for column in columns:
        if column not in found:
            counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("key")).agg(F.count(F.lit(1)).alias("n"))
            found[column] = {r["key"]: r["n"] for r in counts.where(F.col("n") > policy.hot_rows).collect()}
    parts = {column: {key: -(-n // policy.hot_rows) for key, n in found[column].items()} for column in columns}
    return {column: Profile(parts[column], policy.max_hot) for column in columns}


def _sketch(df: DataFrame, columns: Sequence[str], most: int) -> tuple[int, dict[str, dict[object, int]]]:
    """Number of rows, and for each column the keys that may be hot with estimates of their rows.

    A sketch of m items misjudges a count by 3.5 / m of all rows at most, and never
    below it. With 16 items for each key that can be hot that is less than a quarter of
    ``hot_rows``, so that every hot key is named, and fewer than twice as many keys as
    can be hot.
    """
    tracked = max(1024, 16 * most)
    sketches = [F.expr(f"approx_top_k(`{c}`, {2 * most + 1}, {tracked})").alias(c) for c in columns]
    found = df.agg(F.count(F.lit(1)), *sketches).first()
    return found[0], {c: {x["item"]: x["count"] for x in own or [] if x["item"] is not None} for c, own in zip(columns, found[1:])}


def _counted(df: DataFrame, named: Mapping[str, Mapping[object, int]], hot_rows: int) -> dict[str, dict[object, int]]:
    """Rows of each named key with more than ``hot_rows``; those with lower estimates are not counted."""
    found: dict[str, dict[object, int]] = {c: {} for c in named}
    values = {c: {str(key): key for key, n in keys.items() if n > hot_rows} for c, keys in named.items()}
    columns = [c for c in named if values[c]]
    if not columns:
        return found
    entries = F.array(
        *[
            F.when(F.col(c).isin(list(values[c].values())), F.struct(F.lit(i).alias("column"), F.col(c).cast("string").alias("key")))
            for i, c in enumerate(columns)
        ]
    )
    met = df.select(F.inline(F.filter(entries, lambda e: e.isNotNull())))
    counts = met.groupBy("column", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot_rows)
    for row in counts.collect():
        column = columns[row["column"]]
        by_text = {str(v).lower() if isinstance(v, bool) else k: v for k, v in values[column].items()}
        found[column][by_text[row["key"]]] = row["n"]
    return found


def parts_of(key: Column, hot: HotKeys) -> Column:
    """Number of parts for each key, rounded up to a power of two; 1 if not hot."""
    by_parts: dict[int, list] = {}
    for value, parts in hot.items():
        by_parts.setdefault(1 << max(parts - 1, 1).bit_length(), []).append(value)
    expr = F.lit(1)
    for parts, values in sorted(by_parts.items()):
        expr = F.when(key.isin(values), F.lit(parts)).otherwise(expr)
    return expr


def with_parts(df: DataFrame, key: str, hot: HotKeys, name: str) -> DataFrame:
    """Add the number of parts of each row's key: by an expression, or by a broadcast table of the hot keys.

    A profile of a table says how many keys an expression may list, a plain mapping is taken to have the default.
    """
    if len(hot) <= getattr(hot, "listed", SkewPolicy.max_hot):
        return df.withColumn(name, parts_of(F.col(key), hot))
    rows = [(value, 1 << max(parts - 1, 1).bit_length()) for value, parts in hot.items()]
    kind = df.schema[key].dataType.simpleString()
    listed = df.sparkSession.createDataFrame(rows, f"_key {kind}, {name} int")
    joined = df.join(F.broadcast(listed), df[key] == listed["_key"], "left").drop("_key")
    return joined.withColumn(name, F.coalesce(name, F.lit(1)))


def _pick(spread: Sequence[str], parts: Column) -> Column:
    """A salt below ``parts``, the same on every retry of a task."""
    return F.pmod(F.xxhash64(*spread), parts).cast("int")


def _all(parts: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), parts - 1))


def _hot_column(keys: Sequence[str], hot_on: str | None, hot: HotKeys | None) -> str:
    """The key column that hot values belong to; it has to be one of the keys."""
    if hot and hot_on is not None and hot_on not in keys:
        raise ValueError(f"hot values are of a key column, and {hot_on!r} is none of {list(keys)}")
    return hot_on or keys[0]


def spread_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    *,
    hot_on: str | None = None,
    hot_left: HotKeys | None = None,
    hot_right: HotKeys | None = None,
    spread_left: Sequence[str] = (),
    spread_right: Sequence[str] = (),
) -> DataFrame:
    """Equi join on columns of the same names, with hot keys split over tasks.

    ``hot_left`` splits rows of the left side, ``hot_right`` those of the right
    side; the other side is repeated. ``hot_on`` names the key column the hot
    values belong to, ``spread_*`` the columns whose hash gives the salt.
    Splitting the right side is exact for inner joins alone.
    """
    keys = list(keys)
    hot_on = _hot_column(keys, hot_on, hot_left or hot_right)
    if hot_right and how != "inner":
        raise ValueError("the right side can be split in inner joins only")
    on = keys
    if hot_left:
        spread = spread_left or left.columns
        left = with_parts(left, hot_on, hot_left, "_parts").withColumn("_salt_l", _pick(spread, F.col("_parts"))).drop("_parts")
        right = with_parts(right, hot_on, hot_left, "_parts").withColumn("_salt_l", _all(F.col("_parts"))).drop("_parts")
        on = [*on, "_salt_l"]
    if hot_right:
        spread = spread_right or [c for c in right.columns if c != "_salt_l"]
        right = with_parts(right, hot_on, hot_right, "_parts").withColumn("_salt_r", _pick(spread, F.col("_parts"))).drop("_parts")
        left = with_parts(left, hot_on, hot_right, "_parts").withColumn("_salt_r", _all(F.col("_parts"))).drop("_parts")
        on = [*on, "_salt_r"]
    return left.join(right, on, how).drop("_salt_l", "_salt_r")


def left_spread_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    *,
    hot_left: HotKeys | None = None,
    hot_right: HotKeys | None = None,
    spread_left: Sequence[str] = (),
    spread_right: Sequence[str] = (),
) -> DataFrame:
    """Left equi join with any number of partners per row, hot keys of either side split over tasks.

    With its right side split a left row would find no partner in most of the parts
    it is repeated for. Partners are therefore found by an inner join, which may split
    both sides, and rows without any by an anti join on the right side's keys, which
    are made distinct on the map side first. Without hot keys on the right it is one
    join. ``left`` is read twice otherwise and should be cheap to read.
    """
    if not hot_right:
        return spread_join(left, right, keys, "left", hot_left=hot_left, spread_left=spread_left)
    found = spread_join(left, right, keys, hot_left=hot_left, hot_right=hot_right, spread_left=spread_left, spread_right=spread_right)
    alone = without_partner(left, right, keys, hot=hot_left, spread=spread_left)
    return found.unionByName(alone, allowMissingColumns=True)


def without_partner(
    left: DataFrame, right: DataFrame, keys: Sequence[str], *, hot: HotKeys | None = None, spread: Sequence[str] = ()
) -> DataFrame:
    """Rows of ``left`` whose keys the right side does not have; a NULL in a key has no partner.

    Only the right side's distinct keys are shuffled, made distinct on the map side
    first, so that no key has more rows there than there are map tasks. Rows of a key
    that is hot on the left are split, and rows with a NULL as their first key are
    spread if ``spread`` names columns.
    """
    marks = right.select(*keys).distinct()
    if not (hot or spread):
        return left.join(marks, list(keys), "left_anti").select(*left.columns)
    joined = lookup_join(left, marks.withColumn("_partner", F.lit(True)), keys, hot=hot, spread=spread)
    return joined.where(F.col("_partner").isNull()).select(*left.columns)


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    *,
    hot_on: str | None = None,
    hot: HotKeys | None = None,
    spread: Sequence[str] = (),
) -> DataFrame:
    """Left join to a side that has one row per key; never changes the row count.

    Rows with a NULL key would all meet in one partition. If ``spread`` names
    columns to hash, such rows get that hash as their join key instead, under a
    condition that keeps them unmatched.
    """
    keys = list(keys)
    if hot:
        left_hot = _hot_column(keys, hot_on, hot)
        by = spread or left.columns
        left = with_parts(left, left_hot, hot, "_parts").withColumn("_salt", _pick(by, F.col("_parts"))).drop("_parts")
        right = with_parts(right, left_hot, hot, "_parts").withColumn("_salt", _all(F.col("_parts"))).drop("_parts")
        keys = [*keys, "_salt"]
    if not spread:
        return left.join(right, keys, "left").drop("_salt")

    first, rest = keys[0], keys[1:]
    kind = left.schema[first].dataType
    probe = F.coalesce(F.col(first), _hash_as(kind.simpleString(), spread))
    renamed = right.select(
        *[F.col(k).alias(f"_r_{k}") for k in keys],
        *[c for c in right.columns if c not in keys],
    )
    left = left.withColumn("_probe", probe)
    condition = (left["_probe"] == renamed[f"_r_{first}"]) & left[first].isNotNull()
    for k in rest:
        condition = condition & (left[k] == renamed[f"_r_{k}"])
    return left.join(renamed, condition, "left").drop(
        "_probe", "_salt", *[f"_r_{k}" for k in keys]
    )


def _hash_as(kind: str, spread: Sequence[str]) -> Column:
    if kind == "bigint":
        return F.xxhash64(*spread)
    if kind == "int":
        return F.hash(*spread)
    return F.xxhash64(*spread).cast(kind)
