"""Column predicates. All of them stay inside code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def unusable_id(column: Column) -> Column:
    """True where an id is missing or a placeholder (NULL, zero or negative)."""
    return F.coalesce(column, F.lit(0)) < 1


def usable_id(column: Column) -> Column:
    return F.coalesce(column, F.lit(0)) >= 1


def in_time_range(column: Column, start: str, end: str, inclusive: bool = False) -> Column:
    """``start <= column < end``, or ``<= end`` if inclusive.

    The bounds stay text, so that Spark casts them to the type of the column
    (with or without time zone) while it folds constants. The comparison then
    reaches the Parquet scan. An inclusive bound at 23:59:59 loses the rows in
    the last second of the day, hence the half-open default.
    """
    upper = column <= F.lit(end) if inclusive else column < F.lit(end)
    return (column >= F.lit(start)) & upper


def differs_from(column: Column, value) -> Column:
    """NULL counts as different, unlike ``column <> value``."""
    return ~column.eqNullSafe(F.lit(value))


def address_usable(
    site: Column, special_site: int, special_ok: Column, regular_ok: Column, any_record: Column
) -> Column:
    """Is there an address whose id for this site can be used?

    The special site looks at one id, every other site at the other one. With
    an unknown site no id can be chosen, so that a record alone is enough.
    """
    return (
        any_record
        & (
            site.isNull()
            | ((site == special_site) & special_ok)
            | ((site != special_site) & regular_ok)
        )
    )
