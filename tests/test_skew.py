"""Splitting hot keys must never change a result."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from gapwise.operators import aggregates, joins
from gapwise.operators.skew import SkewPolicy, hot_keys, lookup_join, parts_of, spread_join

SHARP = SkewPolicy(hot_rows=20, max_hot=1000)


@pytest.fixture(scope="module")
def left(spark):
    """Key 7 has a third of the rows, NULL another tenth."""
    key = "case when id % 3 = 0 then 7 when id % 10 = 1 then null else id % 41 end"
    return spark.range(600).selectExpr("id", f"{key} as k", "id % 5 as v")


@pytest.fixture(scope="module")
def right(spark):
    """Key 9 has many rows; a few keys of the left side are missing."""
    key = "case when id % 2 = 0 then 9 else id % 37 end"
    return spark.range(200).selectExpr(f"{key} as k", "id as w")


def test_hot_keys_found_with_parts(left):
    hot = hot_keys(left, ["k"], SHARP)["k"]
    assert set(hot) == {7}
    assert hot[7] >= 200 // 20


def test_small_tables_are_not_profiled(left):
    assert hot_keys(left, ["k", "v"], SkewPolicy()) == {"k": {}, "v": {}}


def test_every_key_above_the_bound_is_hot(spark):
    """However many keys there are, none with more rows than a task takes is left whole."""
    df = spark.range(100_000).selectExpr("id % 5000 as k")
    policy = SkewPolicy(hot_rows=10, max_hot=10)
    hot = hot_keys(df, ["k"], policy)["k"]
    assert len(hot) == 5000 and set(hot.values()) == {2}


def test_one_key_in_a_small_file_is_hot(spark, tmp_path):
    spark.range(200_000).selectExpr("cast(1 as bigint) as k").write.parquet(f"{tmp_path}/one")
    policy = SkewPolicy(hot_rows=50_000)
    assert hot_keys(spark.read.parquet(f"{tmp_path}/one"), ["k"], policy)["k"] == {1: 4}


def test_many_hot_keys_are_a_table(spark, left, right):
    hot = {k: 3 for k in range(5000)}
    plain, split = left.join(right, "k"), spread_join(left, right, ["k"], hot_left=hot, hot_right={9: 4}, spread_left=["id"])
    assert rows(split, "id", "k", "v", "w") == rows(plain, "id", "k", "v", "w")
    right_once = right.groupBy("k").agg(F.max("w").alias("w"))
    looked = lookup_join(left, right_once, ["k"], hot=hot, spread=["id"])
    assert rows(looked, "id", "k", "v", "w") == rows(left.join(right_once, "k", "left"), "id", "k", "v", "w")


def test_closed_gates_do_not_meet_in_one_task(spark):
    shuffled = spark.range(8000).selectExpr("id", "id % 50 as k")
    lookup = spark.range(50).selectExpr("id as k", "id * 2 as w")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = joins.state_gated_join(shuffled, lookup, F.col("id") < 800, ["k"])
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(sizes) == 8000 and max(sizes) < 2000


def test_parts_are_powers_of_two_and_cover(spark):
    hot = {1: 2, 2: 3, 3: 9}
    got = dict(rows(spark.range(5).select("id", parts_of(F.col("id"), hot))))
    assert got == {0: 1, 1: 2, 2: 4, 3: 16, 4: 1}


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_left_split_equals_plain_join(left, right, how):
    plain = left.join(right, "k", how)
    split = spread_join(left, right, ["k"], how, hot_left={7: 8, 9: 4}, spread_left=["id"])
    assert rows(split, *sorted(split.columns)) == rows(plain, *sorted(plain.columns))


def test_both_sides_split_equals_plain_join(left, right):
    plain = left.join(right, "k")
    split = spread_join(left, right, ["k"], hot_left={7: 8, 9: 2}, hot_right={9: 16, 7: 2})
    assert rows(split, "id", "k", "v", "w") == rows(plain, "id", "k", "v", "w")


def test_right_split_is_refused_for_outer_joins(left, right):
    with pytest.raises(ValueError):
        spread_join(left, right, ["k"], "left", hot_right={9: 4})


@pytest.mark.parametrize("hot", [{}, {7: 8}, {7: 8, 3: 2}])
@pytest.mark.parametrize("spread", [[], ["id"]])
@pytest.mark.parametrize("keys", [["k"], ["k", "v"]])
def test_lookup_keeps_rows_and_nulls(left, right, hot, spread, keys):
    per_key = right.select("k", (F.col("w") % 5).alias("v"), "w").groupBy(*keys).agg(
        F.max("w").alias("top")
    )
    plain = left.join(per_key, keys, "left")
    got = lookup_join(left, per_key, keys, hot=hot, spread=spread)
    assert sorted(got.columns) == sorted(plain.columns)
    assert rows(got, "id", "k", "v", "top") == rows(plain, "id", "k", "v", "top")


def test_null_keys_do_not_meet_in_one_partition(spark):
    left = spark.range(4000).selectExpr("id", "cast(null as bigint) as k")
    right = spark.range(10).selectExpr("id as k", "id as w")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = lookup_join(left, right, ["k"], spread=["id"])
        sizes = rows(got.groupBy(F.spark_partition_id().alias("p")).count(), "count")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(sizes) > 4
    assert sum(n for (n,) in sizes) == 4000


def test_hot_key_is_spread_over_tasks(spark):
    left = spark.range(4000).selectExpr("id", "if(id % 3 = 0, 7L, id) as k")
    right = spark.range(4000).selectExpr("id as k", "id * 2 as w")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = lookup_join(left, right, ["k"], hot={7: 32}, spread=["id"])
        hot = got.where("k = 7").groupBy(F.spark_partition_id().alias("p")).count()
        sizes = [n for (n,) in rows(hot, "count")]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(sizes) == 1335  # every third id, and id 7 itself
    assert max(sizes) < 1335 / 2


def test_star_join_with_hot_points(spark):
    hub = spark.range(60).selectExpr("if(id < 20, 1, id % 9) as k", "id as h")
    a = spark.range(90).selectExpr("if(id < 30, 1, id % 7) as k", "id as a")
    b = spark.range(30).selectExpr("id % 5 as k", "id as b")
    plain = hub.join(a, "k").join(b, "k")
    hot = joins.star_inner_join(hub, [a, b], "k", hot=[{1: 4}, {1: 8, 2: 2}, {3: 2}])
    assert rows(hot, "k", "h", "a", "b") == rows(plain, "k", "h", "a", "b")


def test_two_hop_absence_with_hot_links(spark):
    df = spark.range(20).selectExpr("id as a")
    link = spark.range(300).selectExpr(
        "if(id % 3 = 0, 4L, id % 25) as a", "if(id % 3 = 1, 5L, id % 60) as b"
    )
    target = spark.range(60).where("id % 4 = 1").selectExpr("id as b")
    plain = joins.two_hop_absence(df, link, target, "a", "b")
    hot = joins.two_hop_absence(
        df, link, target, "a", "b", hot_key=lambda: {4: 8}, hot_target=lambda: {5: 8, 9: 2}
    )
    assert rows(hot) == rows(plain)


@pytest.fixture
def shuffled(spark):
    """Plans whose tasks are as many as the setting says and whose sides all shuffle."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def largest(df):
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    return max(sizes), sum(sizes)


#: a third of the right rows, 4,000 of 12,000, have key 7
HOT_RIGHT = "case when id % 3 = 0 then 7 when id % 50 = 1 then null else id % 900 end"


@pytest.mark.parametrize("hot_left", [None, {7: 2, 8: 2}])
@pytest.mark.parametrize("hot_right", [{}, {7: 8}, {7: 8, 11: 2, 5000: 4}])
def test_left_join_with_hot_partners_equals_plain_join(left, right, hot_left, hot_right):
    partners = right.unionByName(right.selectExpr("if(k = 9, 7, k) as k", "w + 1000 as w"))
    split = joins.left_outer_join(left, partners, ["k"], hot_left=hot_left, hot_right=hot_right, spread_left=["id"])
    plain = left.join(partners, "k", "left")
    assert split.columns == plain.columns
    assert rows(split, "id", "k", "v", "w") == rows(plain, "id", "k", "v", "w")


def test_partners_of_a_hot_key_are_spread(spark, shuffled):
    left = spark.range(1000).selectExpr("id as k", "id % 7 as v")
    right = spark.range(12_000).selectExpr(f"{HOT_RIGHT} as k", "id as w")
    plain, total = largest(joins.left_outer_join(left, right, ["k"]))
    assert plain >= 4000
    split, same = largest(joins.left_outer_join(left, right, ["k"], hot_right={7: 32}))
    assert same == total and split < 1500
    kept = F.col("w") % 2 == 0
    filtered, n = largest(joins.left_join_on_filter(left, right, ["k"], kept, hot_right={7: 32}))
    assert filtered < 1000 and n == left.join(right.where(kept), "k", "left").count()


@pytest.mark.parametrize("how", ["left", "inner"])
def test_or_keys_with_hot_partners(spark, shuffled, how):
    left = spark.range(1000).selectExpr("id as k")
    right = spark.range(12_000).selectExpr(f"{HOT_RIGHT} as a", "if(id % 5 = 0, 7L, id % 1100) as b", "id as w")
    plain = joins.or_key_join(left, right, "k", ["a", "b"], how=how)
    split = joins.or_key_join(left, right, "k", ["a", "b"], how=how, hot_right=[{7: 32}, {7: 16}])
    assert rows(split, "k", "a", "b", "w") == rows(plain, "k", "a", "b", "w")
    assert largest(plain)[0] >= 4000 and largest(split)[0] < 1600
    with pytest.raises(ValueError):
        joins.or_key_join(left, right, "k", ["a", "b"], how="full")


def test_hot_keys_of_an_anti_join_are_reduced_or_spread(spark, shuffled):
    """The right side has a key once per map task at most, hot or NULL rows of the left side don't meet."""
    left = spark.range(12_000).selectExpr("id", f"{HOT_RIGHT} as k")
    right = spark.range(100_000).selectExpr("if(id % 3 = 0, 11L, id % 40 + 860) as k")
    plain = left.join(right, "k", "left_anti")
    for options in ({}, {"spread": ["id"]}, {"hot": {7: 32}, "spread": ["id"]}):
        got = joins.not_exists(left, right, ["k"], **options)
        assert got.columns == left.columns
        assert rows(got, "id", "k") == rows(plain, "id", "k")
        plan = got._jdf.queryExecution().executedPlan()
        seen = _shuffled_rows(spark, got)
        assert seen < 12_000 * 1.1 + 8 * 41 + 200, plan.toString()  # 8 map tasks, 41 keys on the right, 32 salts of one
    assert largest(joins.not_exists(left, right, ["k"]))[0] >= 4000
    assert largest(joins.not_exists(left, right, ["k"], hot={7: 32}, spread=["id"]))[0] < 1200


def _shuffled_rows(spark, df):
    """Records that one run of a plan writes to shuffles."""
    df._jdf.queryExecution().executedPlan()
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan()
    total, todo = 0, [plan]
    df.collect()
    while todo:
        node = todo.pop()
        metrics = node.metrics()
        if "Exchange" in node.nodeName() and metrics.contains("shuffleRecordsWritten"):
            total += metrics.get("shuffleRecordsWritten").get().value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return total


def test_one_group_with_one_leading_value_is_joined_by_many_tasks(spark):
    n = 1_000_000
    df = spark.range(n).selectExpr("1L as k", "5 as o", f"({n} - id) as t", "cast(id % 10 as string) as v")
    got = aggregates.grouped_concat(df, "k", ["o", "t"], "v", "", hot={1: 4})
    text = got.first()["text"]
    assert text == "".join(str(i % 10) for i in reversed(range(n)))
    runs = aggregates._joined_runs(df, ["k"], ["k", "o", "t", "v"], ["o", "t"], "v", "", "text", 32)
    plan = runs._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" in plan
    dealt = df.repartitionByRange(32, "k", "o", "t", "v")
    assert largest(dealt)[0] < 2 * n // 32


@pytest.mark.parametrize("pieces", [False, True])
def test_runs_keep_ties_and_nulls_in_order(spark, pieces):
    df = spark.range(3000).selectExpr(
        "id % 3 as k", "if(id % 7 = 0, null, id % 2) as o", "if(id % 11 = 0, null, id % 5) as t", "if(id % 13 = 0, null, cast(id % 4 as string)) as v"
    )
    plain = aggregates.grouped_concat(df, "k", ["o", "t"], "v", ",", pieces=pieces)
    split = aggregates.grouped_concat(df.repartition(6), "k", ["o", "t"], "v", ",", pieces=pieces, hot={0: 2, 2: 3})
    assert rows(split) == rows(plain)


def test_hot_keys_of_all_columns_by_one_sketch(spark):
    df = spark.range(60_000).selectExpr(
        "if(id % 3 = 0, 7L, id) as a", "if(id % 4 = 0, 'x', cast(id % 100 as string)) as b", "cast(id % 2 = 0 as boolean) as c",
        "if(id % 5 = 0, null, cast(id % 3 as int)) as d", "cast(id % 2 as decimal(9, 2)) as e", "date_add(date'2024-01-01', cast(id % 400 as int)) as f",
    )
    policy = SkewPolicy(hot_rows=5000)
    found = hot_keys(df, df.columns, policy)
    exact = {}
    for column in df.columns:
        counts = df.where(F.col(column).isNotNull()).groupBy(column).count().collect()
        exact[column] = {r[0]: -(-r[1] // 5000) for r in counts if r[1] > 5000}
    assert found == exact and found["a"] == {7: 5} and found["f"] == {}


def test_one_sketch_serves_all_columns(spark):
    """A count, a sketch and a count of what it names, whatever the number of columns."""
    df = spark.range(50_000).selectExpr("id % 3 as a", "id % 4 as b", "id % 5 as c")
    tracker, context = spark.sparkContext.statusTracker(), spark.sparkContext
    context.setJobGroup("profile", "profile")
    hot_keys(df, ["a", "b", "c"], SkewPolicy(hot_rows=1000))
    jobs = tracker.getJobIdsForGroup("profile")
    context.setJobGroup("other", "other")
    stages = {s for job in jobs for s in tracker.getJobInfo(job).stageIds}
    infos = [tracker.getStageInfo(s) for s in stages]
    reading = [i for i in infos if i and i.numTasks == i.numCompletedTasks == 8]  # others were skipped
    assert len(reading) <= 4  # three passes, and the shuffle's side of the last


def test_more_hot_keys_than_listed_are_a_table(left):
    lookup = left.groupBy("k").agg(F.max("v").alias("top"))
    for listed, joined in ((2, 3), (500, 1)):  # the hot keys are joined to either side, or none are
        hot = hot_keys(left, ["k"], SkewPolicy(hot_rows=5, max_hot=listed))["k"]
        assert len(hot) > 2
        plan = lookup_join(left, lookup, ["k"], hot=hot)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Join ") == joined


def test_hot_values_belong_to_a_key(left, right):
    with pytest.raises(ValueError):
        spread_join(left, right, ["k"], hot_on="w", hot_left={1: 2})
    with pytest.raises(ValueError):
        lookup_join(left, right, ["k"], hot_on="v", hot={1: 2})


def test_a_table_without_hot_keys_is_read_once(spark, tmp_path):
    """The sketch that comes with the count rules all keys out."""
    spark.range(50_000).selectExpr("id as a", "id % 700 as b").write.parquet(f"{tmp_path}/even")
    df, context = spark.read.parquet(f"{tmp_path}/even"), spark.sparkContext
    tracker = context.statusTracker()
    context.setJobGroup("even", "even")
    assert hot_keys(df, ["a", "b"], SkewPolicy(hot_rows=20_000)) == {"a": {}, "b": {}}
    jobs = tracker.getJobIdsForGroup("even")
    context.setJobGroup("other", "other")
    infos = [tracker.getStageInfo(s) for s in {s for job in jobs for s in tracker.getJobInfo(job).stageIds}]
    reading = [i for i in infos if i and i.numTasks == i.numCompletedTasks > 1]
    assert len(reading) == 1


def test_a_longer_sketch_is_made_for_more_hot_keys(spark):
    df = spark.range(120_000).selectExpr("if(id % 2 = 0, id % 200, id) as k")
    found = hot_keys(df, ["k"], SkewPolicy(hot_rows=250))["k"]
    exact = df.groupBy("k").count().where("count > 250").collect()
    assert found == {r["k"]: -(-r["count"] // 250) for r in exact} and len(found) > 64
