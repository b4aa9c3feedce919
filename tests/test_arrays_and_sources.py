import os
import time

import pytest
from conftest import rows
from pyspark.sql import functions as F

from gapwise.functions import arrays
from gapwise.sources import records
from gapwise.sources.files import stale_files
from gapwise.sources.tables import spread

DDL = "id int, cntr array<int>, resp array<string>, service array<string>, reason array<string>"


def scanned(spark, *data, sep=" "):
    df = spark.createDataFrame(list(data), DDL)
    z = arrays.zip_columns("cntr", "resp", "service", "reason")
    return df.select("id", z.alias("z")).withColumn("s", arrays.scan_summary(F.col("z"), sep=sep))


def test_trailing_separator_and_nulls(spark):
    df = scanned(
        spark,
        (1, [1, 2, 3], ["s", None, "x"], ["MEDLIMIT", "MEDLIMIT", "OTHER"], ["HD", "HC", "MX"]),
        (2, [], [], [], []),
        (3, [1], ["s"], [None], ["HD"]),
    )
    got = rows(df, "id", "s.service_seq", "s.resp_flags", "s.reason_codes")
    assert got == [(1, "1 2 ", "s  ", "HD HC "), (2, "", "", ""), (3, "", "", "")]


def test_flags_need_service_response_and_reason(spark):
    m = "MEDLIMIT"
    df = scanned(
        spark,
        (1, [1, 2], ["s", "x"], [m, m], ["HC", "HD"]),
        (2, [1], ["S"], [m], ["HD"]),  # the response is case sensitive
        (3, [1, 2], ["H", "H"], [m, m], ["HD", "MX"]),
        (4, [1], ["H"], ["OTHER"], ["HD"]),
        (5, [1, 2], [None, "H"], [m, m], ["HD", None]),
    )
    got = rows(df, "id", "s.c_e_flag", "s.q_r_flag", "s.w_aa_flag")
    assert got == [(1, "Y", "", ""), (2, "", "", ""), (3, "", "Y", "Y"), (4, "", "", ""), (5, "", "", "")]


def test_slots(spark):
    df = scanned(
        spark,
        (1, [2, 2, 11, 0, 10], list("abcde"), list("vwxyz"), list("lmnop")),
        (2, [1], ["a"], [], []),
        (3, [], [], [], []),
    ).withColumn("slots", arrays.place_in_slots(F.col("z")))
    got = {r["id"]: r["slots"] for r in df.collect()}
    assert all(len(slots) == 10 for slots in got.values())
    assert [i + 1 for i, s in enumerate(got[1]) if s is not None] == [2, 10]
    assert tuple(got[1][1]) == ("b", "w", "m")
    assert tuple(got[2][0]) == ("a", None, None)
    assert got[3] == [None] * 10


def test_scalar_service(spark):
    df = spark.createDataFrame(
        [(1, [1, 2], ["s", "H"], "MEDLIMIT", ["HD", "HD"]), (2, [1], ["s"], "OTHER", ["HD"])],
        DDL.replace("service array<string>", "service string"),
    )
    z = arrays.zip_columns("cntr", "resp", "service", "reason", scalar_service=True)
    got = df.select("id", arrays.scan_summary(z, sep="|").alias("s"))
    assert rows(got, "id", "s.service_seq", "s.c_e_flag", "s.q_r_flag") == [
        (1, "1|2|", "Y", "Y"), (2, "", "", "")
    ]


def test_scans_of_null_arrays_and_null_elements(spark):
    df = scanned(spark, (1, None, None, None, None), (2, [None, 3, 3], ["s", None, "H"], ["MEDLIMIT"] * 3, [None, "HD", "MX"]))
    got = {r["id"]: r for r in df.withColumn("slots", arrays.place_in_slots(F.col("z"))).collect()}
    assert got[1]["slots"] is None or got[1]["slots"] == [None] * 10
    assert (got[1]["s"]["service_seq"], got[1]["s"]["c_e_flag"]) == (None, "")
    assert tuple(got[2]["s"]) == (" 3 3 ", "s  H ", " HD MX ", "", "", "Y")
    assert [s and tuple(s) for s in got[2]["slots"]] == [None, None, ("H", "MEDLIMIT", "MX"), *[None] * 7]


@pytest.mark.parametrize("files", [1, 20])
def test_only_small_scans_are_spread(spark, tmp_path, files):
    path = str(tmp_path / "t")
    spark.conf.set("spark.sql.files.openCostInBytes", "128m")
    try:
        spark.range(2000).repartition(files).write.parquet(path)
        got = spread(spark.read.parquet(path))
        assert got.rdd.getNumPartitions() == (8 if files == 1 else 20)
        assert got.selectExpr("sum(id)").first()[0] == 1999 * 1000
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_row_flags_have_no_gate(spark):
    df = spark.createDataFrame([("s", "HC"), ("H", "MX"), (None, "HD"), ("x", None)], "r string, c string")
    got = rows(df.select("r", *arrays.row_flags(F.col("r"), F.col("c")).values()))
    assert got == [(None, "", "", ""), ("H", "", "", "Y"), ("s", "Y", "", ""), ("x", "", "", "")]


def test_struct_unpack(spark):
    df = spark.range(1).select("id")
    got = records.struct_unpack(df, "s", F.struct(F.lit(1).alias("a"), F.lit("x").alias("b")))
    assert got.columns == ["id", "a", "b"]
    assert rows(got) == [(0, 1, "x")]


def test_flatten_missing_fields_and_bad_text(spark):
    df = spark.createDataFrame(
        [
            (1, '{"d_prescriber_rec": {"pbr_npi": "7", "unknown": 1}}'),
            (2, "{}"),
            (3, "no json"),
            (4, None),
        ],
        "id int, j string",
    )
    got = records.flatten_record(df, "j", records.PRESCRIBER, "d_prescriber_rec", keep=("id",))
    assert got.columns == [
        "id", "pbr_dea_id", "pbr_npi", "pbr_first_nm", "pbr_mid_init_nm", "pbr_last_nm"
    ]
    assert rows(got, "id", "pbr_npi") == [(1, "7"), (2, None), (3, None), (4, None)]


def test_read_records_with_a_leading_digit(spark, tmp_path):
    (tmp_path / "r.json").write_text(
        '{"1_reject_code_rec": {"dxf_sk": 5, "rej_cd": "A"}}\n{"1_reject_code_rec": null}\n'
    )
    got = records.read_records(spark, str(tmp_path), records.REJECT_CODE, "1_reject_code_rec")
    assert rows(got, "dxf_sk", "rej_cd", "src_env_sk") == [(None, None, None), (5, "A", None)]


def test_stale_files(spark, tmp_path):
    now = int(time.time())
    (tmp_path / "sub").mkdir()
    ages = {"new": 0, "sub/edge": 2 * 86400, "sub/old": 2 * 86400 + 5}
    for name, age in ages.items():
        path = tmp_path / name
        path.write_text("x")
        os.utime(path, (now - age, now - age))
    as_of = F.timestamp_seconds(F.lit(now))
    df = stale_files(spark, str(tmp_path), 2, as_of)
    got = {os.path.basename(r["path"]): (r["age_seconds"], r["is_stale"]) for r in df.collect()}
    assert got == {"new": (0, False), "edge": (2 * 86400, False), "old": (2 * 86400 + 5, True)}
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1]


@pytest.mark.parametrize("seps", [" ", "|"])
def test_scan_stays_in_the_jvm(spark, seps):
    df = scanned(spark, (1, [1], ["s"], ["MEDLIMIT"], ["HD"]), sep=seps)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
