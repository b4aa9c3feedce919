"""Intermediate results: where they go, and what is known of their size."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from gapwise.operators import staging
from gapwise.operators.facts import any_true, gather_facts
from gapwise.operators.joins import unique_rows
from gapwise.operators.skew import SkewPolicy
from gapwise.operators.staging import cut_to_keys, stage


def test_written_and_counted(spark):
    df = spark.range(10).selectExpr("id", "cast(id as string) as s", "7 as k")
    few = stage(df, SkewPolicy())
    assert few.rows == 10 and few.hot("k") == {}
    assert rows(few.df) == rows(df)
    assert stage(df, SkewPolicy(hot_rows=4)).hot("k") == {7: 3}


def test_empty_frame(spark):
    empty = stage(spark.range(0).selectExpr("id"), SkewPolicy())
    assert empty.rows == 0 and empty.df.count() == 0


def test_stays_in_the_checkpoint_folder(spark):
    staged = stage(spark.range(3).selectExpr("id"), SkewPolicy()).df
    folder = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    assert all(folder in path for path in staged.inputFiles())


class FakeContext:
    """Stands for a session whose settings are those of a cluster."""

    def __init__(self, master, configured=None):
        self.master, self.chosen, self.configured = master, None, configured
        self.sparkContext = self.conf = self

    def get(self, key, default):
        assert key == "spark.checkpoint.dir"
        return self.configured or default

    def getCheckpointDir(self):
        return self.chosen

    def setCheckpointDir(self, path):
        self.chosen = path


def test_cluster_uses_the_named_folder_and_never_its_own():
    assert staging.shared_folder(FakeContext("yarn", "hdfs://shared/checkpoints/")).rstrip("/") == "hdfs://shared/checkpoints"
    with pytest.raises(ValueError):
        staging.shared_folder(FakeContext("yarn"))
    assert staging.shared_folder(FakeContext("local[8]"))


@pytest.mark.parametrize("bound", ["10m", "-1"])
def test_gathered_facts(spark, bound):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (None, "d")], "k bigint, v string")
    flags = spark.createDataFrame([(1,), (1,), (9,), (None,)], "k bigint").withColumn("f", F.lit(True))
    values = spark.createDataFrame([(1, 7), (1, 5), (2, None)], "k bigint, n int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", bound)
    try:
        for used in (None, df.unionByName(df)):
            got = gather_facts(df, "k", [flags, values], {"f": any_true, "n": F.min}, used)
            assert rows(got, "k", "v", "f", "n") == [
                (None, "d", False, None), (1, "a", True, 5), (2, "b", False, None), (3, "c", False, None)
            ]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("bound", ["10m", "-1"])
def test_cut_asks_for_hot_keys_only_where_it_shuffles(spark, bound):
    table = spark.range(900).selectExpr("if(id % 3 = 0, 7, id) as k", "id as v")
    keys = spark.createDataFrame([(7,), (7,), (8,), (None,), (5000,)], "k bigint")
    keys = stage(keys, SkewPolicy()).df
    asked = []
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", bound)
    try:
        got = cut_to_keys(table, keys, "k", lambda: asked.append(1) or {7: 8}, ["v"])
        assert rows(got, "k", "v") == [(7, i) for i in sorted([7, *range(0, 900, 3)])] + [(8, 8)]
        assert asked == ([] if bound == "10m" else [1])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_second_row_of_a_key_is_an_error_that_names_it(spark):
    good = [(1, "a", 5), (2, None, 6), (None, "x", 1), (None, "x", 1), (None, "y", 1)]
    df = spark.createDataFrame(good, "k bigint, v string, n int")
    assert rows(unique_rows(df, ["k"]), "k", "v", "n") == rows(df)
    twice = df.unionByName(spark.createDataFrame([(2, "b", 6)], df.schema))
    with pytest.raises(Exception, match='more than one row for key .*2'):
        unique_rows(twice, ["k"]).collect()
    with pytest.raises(Exception, match='more than one row for key .*2'):
        unique_rows(twice, ["k"]).select("k").collect()
    assert unique_rows(twice, ["k", "v"]).count() == 6
