"""Small building blocks for expressions over arrays."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCK = 64


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with the value computed once, also where `use` needs it inside a lambda."""
    return F.transform(F.array(value), use)[0]


def indexes(n: Column) -> Column:
    """0 to n - 1, empty for 0."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def running(values: Column, start: Column, op: Callable[[Column, Column], Column]) -> Column:
    """For each value of an array of longs what `op` makes of those before it.

    Goes block by block, and block sums by themselves, so that an array of n values
    takes some n * (BLOCK + n / BLOCK**2) steps and not n * n.
    """

    def over(v: Column) -> Column:
        blocks = F.ceil(F.size(v) / BLOCK).cast("int")
        sums = F.transform(indexes(blocks), lambda c: F.aggregate(F.slice(v, c * BLOCK + 1, BLOCK), start, op))
        bases = lambda s: F.transform(indexes(blocks), lambda c: F.aggregate(F.slice(s, 1, c), start, op))

        def each(b: Column) -> Column:
            def before(x: Column, i: Column) -> Column:
                block = F.floor(i / BLOCK).cast("int")
                return F.aggregate(F.slice(v, block * BLOCK + 1, i % BLOCK), F.get(b, block), op)

            return F.transform(v, before)

        return let(sums, lambda s: let(bases(s), each))

    return let(values, over)


#: Code points in a block of a text.
CUT = 1024


def cut_blocks(text: Column) -> Column:
    """A text in blocks of `CUT` code points, from which `part` takes any range without reading what is before."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CUT}}}"), F.lit(0))


def part(blocks: Column, start: Column, end: Column) -> Column:
    """Code points `start` to `end` (exclusive) of the text of `cut_blocks`."""
    first = F.floor(start / CUT).cast("int")
    last = F.floor((end - 1) / CUT).cast("int")

    def of_block(block: Column, i: Column) -> Column:
        base = (first + i).cast("long") * CUT
        begin = F.greatest(start - base, F.lit(0).cast("long"))
        return F.substring(block, (begin + 1).cast("int"), (F.least(end - base, F.lit(CUT).cast("long")) - begin).cast("int"))

    own = F.slice(blocks, first + 1, last - first + 1)
    return F.when(end > start, F.array_join(F.transform(own, of_block), "")).otherwise("")
