"""Hand-made rows: NULL keys, duplicates, dangling links, ties."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from gapwise.functions import predicates as p
from gapwise.functions import scalars
from gapwise.operators import aggregates, joins


def frame(spark, ddl, *values):
    return spark.createDataFrame(list(values), ddl)


def test_two_hop_absence(spark):
    df = frame(spark, "a int", (1,), (2,), (3,), (4,), (None,))
    link = frame(spark, "a int, b int", (1, 10), (2, 20), (2, 21), (3, 30), (3, 99), (None, 10))
    target = frame(spark, "b int", (10,), (30,), (None,))
    # 2 has two dangling links and comes out once, 3 has one good link, NULL reaches nothing
    assert rows(joins.two_hop_absence(df, link, target, "a", "b")) == [(None,), (2,), (4,)]


def test_exists_and_missing_flags_keep_grain(spark):
    df = frame(spark, "k int", (1,), (1,), (2,), (None,))
    right = frame(spark, "k int", (1,), (1,), (None,))
    assert rows(joins.exists_flag(df, right, ["k"], "f")) == [
        (None, False), (1, True), (1, True), (2, False)
    ]
    assert rows(joins.missing_flag(df, right, ["k"], "f")) == [
        (None, True), (1, False), (1, False), (2, True)
    ]


def test_not_exists_on_two_keys(spark):
    df = frame(spark, "a int, b int", (1, 1), (1, 2), (2, 1), (1, None))
    right = frame(spark, "a int, b int", (1, 1), (2, 2), (1, 1))
    assert rows(joins.not_exists(df, right, ["a", "b"])) == [(1, None), (1, 2), (2, 1)]


def test_unique_lookup_value_and_null(spark):
    df = frame(spark, "k int", (1,), (2,), (None,))
    lookup = frame(spark, "k int, v string", (1, "x"), (3, "y"), (3, "z"))
    # key 3 repeats, but nobody asks for it
    assert rows(joins.unique_lookup(df, lookup, ["k"], "v")) == [(None, None), (1, "x"), (2, None)]


def test_unique_lookup_fails_on_a_used_duplicate(spark):
    df = frame(spark, "k int", (3,))
    lookup = frame(spark, "k int, v string", (3, "y"), (3, "z"))
    with pytest.raises(Exception, match="more than one row"):
        joins.unique_lookup(df, lookup, ["k"], "v").collect()


def test_first_match_order_ties_and_nulls(spark):
    df = frame(spark, "k int", (1,), (2,), (3,))
    lookup = frame(
        spark,
        "k int, o int, v string",
        (1, 2, "late"), (1, 1, "b"), (1, 1, "a"), (2, None, "null first"), (2, 0, "zero"),
    )
    got = joins.first_match(df, lookup, ["k"], ["o"], ["v"])
    assert rows(got) == [(1, "a"), (2, "null first"), (3, None)]


def test_nested_lookup(spark):
    df = frame(spark, "c int", (1,), (2,), (3,))
    outer = frame(spark, "c int, a int", (1, 7), (1, 5), (2, 8))
    inner = frame(spark, "a int, v int", (5, 50), (5, 40), (7, 1))
    assert rows(joins.nested_lookup(df, outer, inner, "c", "a", "v"), "c", "a", "v") == [
        (1, 5, 40), (2, 8, None), (3, None, None)
    ]


def test_count_zero_flag(spark):
    df = frame(spark, "k int", (1,), (2,), (None,))
    right = frame(spark, "k int", (1,), (1,), (None,))
    assert rows(joins.count_zero_flag(df, right, ["k"], "z")) == [(None, True), (1, False), (2, True)]


def test_or_key_join_matches_once_per_row(spark):
    left = frame(spark, "k int", (1,), (2,), (3,), (None,))
    right = frame(spark, "a int, b int", (1, 1), (2, 1), (None, 2), (None, None))
    got = rows(joins.or_key_join(left, right, "k", ["a", "b"]))
    assert got == [(None, None, None), (1, 1, 1), (1, 2, 1), (2, None, 2), (2, 2, 1), (3, None, None)]


def test_two_key_column_lookup(spark):
    left = frame(spark, "site int, k string", (6, "x"), (1, "x"), (None, "y"), (6, "y"), (6, None))
    right = frame(spark, "a string, b string", ("x", "y"), ("x", "z"))
    kind = F.when(F.col("site") == 6, "a").otherwise("b")
    got = joins.two_key_column_lookup(left, right, kind, "k", {"a": "a", "b": "b"}, "found")
    assert rows(got, "site", "k", "found") == [
        (None, "y", "y"), (1, "x", None), (6, None, None), (6, "x", "x"), (6, "y", None)
    ]


def test_state_gated_join(spark):
    left = frame(spark, "s string, k int", ("open", 1), ("shut", 1), (None, 1), ("open", None))
    right = frame(spark, "k int, v string", (1, "hit"))
    got = joins.state_gated_join(left, right, F.col("s") == "open", ["k"])
    assert rows(got) == [(None, 1, None), ("open", None, None), ("open", 1, "hit"), ("shut", 1, None)]


def test_left_join_on_filter_keeps_left_rows(spark):
    left = frame(spark, "k int", (1,), (2,))
    right = frame(spark, "k int, v int", (1, 5), (2, 50))
    assert rows(joins.left_join_on_filter(left, right, ["k"], F.col("v") < 10)) == [(1, 5), (2, None)]


def test_wide_left_assembly(spark):
    base = frame(spark, "k int", (1,), (2,))
    a, b = frame(spark, "k int, a int", (1, 1)), frame(spark, "k int, b int", (2, 2))
    got = joins.wide_left_assembly(base, [(a, ["k"]), (b, ["k"])])
    assert rows(got) == [(1, 1, None), (2, None, 2)]


def test_grouped_count_status_counts_non_null(spark):
    df = frame(spark, "k int", (1,), (2,), (3,))
    right = frame(spark, "k int, v int", (1, 1), (1, None), (2, None))
    got = aggregates.grouped_count_status(df, right, ["k"], "missing", counted="v")
    assert rows(got, "k", "n", "status") == [(1, 1, None), (2, 0, "missing"), (3, 0, "missing")]


@pytest.mark.parametrize("hot", [None, {1: 4}, {1: 4, 2: 2}])
def test_grouped_concat_order_and_hot_groups(spark, hot):
    df = frame(
        spark,
        "k int, o int, t int, v string",
        (1, 2, 1, "c"), (1, 1, 2, "b"), (1, 1, 1, "a"), (1, 3, 1, None), (2, 10, 1, "y"), (2, 9, 1, "x"),
    )
    got = aggregates.grouped_concat(df, "k", ["o", "t"], "v", " ", hot=hot)
    assert rows(got) == [(1, "a b c"), (2, "x y")]


def test_grouped_concat_pieces(spark):
    df = frame(spark, "k int, o int, v string", (1, 2, "c"), (1, 1, "b"), (1, 1, "a"))
    got = aggregates.grouped_concat(df, "k", ["o", "v"], "v", ",", pieces=True)
    assert rows(got) == [(1, 1, "a,b"), (1, 2, "c")]


def test_grouped_concat_condition(spark):
    df = frame(spark, "k int, o int, v string", (1, 2, "c"), (1, 1, "b"), (2, 1, "a"))
    got = aggregates.grouped_concat(df, "k", ["o"], "v", ",", condition=F.col("o") == 1)
    assert rows(got) == [(1, "b"), (2, "a")]


def test_unusable_id(spark):
    df = frame(spark, "v bigint", (None,), (-1,), (0,), (1,))
    assert rows(df.select("v", p.unusable_id(F.col("v")), p.usable_id(F.col("v")))) == [
        (None, True, False), (-1, True, False), (0, True, False), (1, False, True)
    ]


def test_time_range_keeps_the_last_second(spark):
    df = spark.sql(
        "select timestamp_ntz'2023-10-31 23:59:59.5' as t union all "
        "select timestamp_ntz'2023-11-01 00:00:00'"
    )
    half_open = p.in_time_range(F.col("t"), "2023-10-01 00:00:00", "2023-11-01 00:00:00")
    closed = p.in_time_range(F.col("t"), "2023-10-01 00:00:00", "2023-10-31 23:59:59", inclusive=True)
    assert df.where(half_open).count() == 1
    assert df.where(closed).count() == 0


def test_differs_from_and_three_valued(spark):
    df = frame(spark, "s int", (None,), (6,), (1,))
    got = rows(df.select("s", p.differs_from(F.col("s"), 6), F.col("s") != 6))
    assert got == [(None, True, None), (1, True, True), (6, False, False)]


def test_id_from_text(spark):
    df = frame(spark, "v string", ("12",), ("x1",), ("",), (None,))
    got = dict(rows(df.select("v", scalars.id_from_text(F.col("v")))))
    assert got == {"12": 12, "x1": None, "": None, None: None}


def test_parse_timestamp_keeps_time(spark):
    df = frame(spark, "v string", ("2023-10-31 23:59:59",))
    got = df.select(scalars.parse_timestamp(F.col("v"))).first()[0]
    assert (got.hour, got.minute, got.second) == (23, 59, 59)
