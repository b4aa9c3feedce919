"""One query per base operator, on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from gapwise.functions import arrays, predicates, scalars
from gapwise.operators import aggregates, joins
from gapwise.operators.skew import HotKeys, SkewPolicy, hot_keys
from gapwise.sources.files import stale_files
from gapwise.sources.records import PRESCRIBER, REJECT_CODE, flatten_record, struct_unpack
from gapwise.sources.tables import scan, spread


class Given:
    """The given Parquet files of one folder by table name."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getitem__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def hot(self, name: str, column: str) -> HotKeys:
        """Hot values of a join key; none for tables too small to have any."""
        return hot_keys(self[name], [column], SkewPolicy())[column]


# --- sources -----------------------------------------------------------------


def scan_rename(t: Given) -> DataFrame:
    return scan(
        t,
        "customer",
        {"c_custkey": "customer_id", "c_name": "customer_name", "c_mktsegment": "segment"},
    )


def nested_record_flatten(t: Given) -> DataFrame:
    schema = StructType([StructField("k", IntegerType())])
    return flatten_record(t["events"], "props", schema, keep=("event_id",))


def nested_prescriber(t: Given) -> DataFrame:
    record = F.struct(
        F.struct(
            F.concat(F.lit("D"), F.col("c_custkey")).alias("pbr_dea_id"),
            F.when(F.col("c_custkey") % 3 != 0, F.col("c_nationkey").cast("string")).alias("pbr_npi"),
            F.col("c_name").alias("pbr_first_nm"),
            F.col("c_mktsegment").alias("pbr_last_nm"),
        ).alias("d_prescriber_rec")
    )
    texts = t["customer"].select("c_custkey", F.to_json(record).alias("record"))
    return flatten_record(texts, "record", PRESCRIBER, "d_prescriber_rec", keep=("c_custkey",))


def nested_reject_code(t: Given) -> DataFrame:
    record = F.struct(
        F.struct(
            F.col("p_size").alias("dxf_sk"),
            F.col("p_brand").alias("rej_cd"),
            F.when(F.col("p_partkey") % 5 != 0, F.col("p_type")).alias("rej_cd_desc"),
        ).alias("1_reject_code_rec")
    )
    texts = t["part"].select("p_partkey", F.to_json(record).alias("record"))
    return flatten_record(texts, "record", REJECT_CODE, "1_reject_code_rec", keep=("p_partkey",))


def stale_file_report(t: Given) -> DataFrame:
    return stale_files(t.spark, t.sf_dir, days=30)


# --- predicates --------------------------------------------------------------


def filter_in_list(t: Given) -> DataFrame:
    return t["orders"].where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).select(
        "o_orderkey", "o_orderpriority"
    )


def filter_constant_eq(t: Given) -> DataFrame:
    return t["lineitem"].where(
        (F.col("l_returnflag") == "A") & (F.col("l_linenumber") == 1)
    ).select("l_orderkey", "l_partkey", "l_suppkey")


def filter_time_range(t: Given) -> DataFrame:
    when = predicates.in_time_range(
        F.col("o_orderdate"), "1996-01-01 00:00:00", "1997-01-01 00:00:00"
    )
    return t["orders"].where(when).select("o_orderkey", "o_orderdate")


def filter_time_range_inclusive(t: Given) -> DataFrame:
    when = predicates.in_time_range(
        F.col("ts"), "2024-01-02 00:00:00", "2024-01-03 23:59:59", inclusive=True
    )
    return t["events"].where(when).select("event_id", "ts")


def _customer_orders(t: Given) -> DataFrame:
    orders = t["orders"].withColumnRenamed("o_custkey", "c_custkey")
    return joins.left_join_on_filter(
        t["customer"].select("c_custkey", "c_mktsegment"),
        orders.select("c_custkey", "o_orderkey", "o_orderstatus", "o_totalprice"),
        ["c_custkey"],
        (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 400000),
        hot_right=t.hot("orders", "o_custkey"),
    )


def left_join_on_filter(t: Given) -> DataFrame:
    return _customer_orders(t).select("c_custkey", "o_orderkey", "o_orderstatus")


def filter_null_tests(t: Given) -> DataFrame:
    joined = _customer_orders(t)
    kept = joined.where(F.col("o_orderkey").isNull() | F.col("c_mktsegment").isNotNull())
    return kept.select(
        "c_custkey",
        F.col("o_orderkey").isNull().alias("is_missing"),
        F.col("o_orderkey").isNotNull().alias("is_present"),
    )


def usable_id_predicate(t: Given) -> DataFrame:
    number = F.nullif(F.col("c_custkey") % 5, F.lit(3))
    return t["customer"].select("c_custkey", number.alias("number")).withColumn(
        "is_unusable", predicates.unusable_id(F.col("number"))
    )


def case_searched(t: Given) -> DataFrame:
    line = F.col("l_linestatus")
    label = (
        F.when(F.col("l_returnflag") == "A", "returned")
        .when((line == "O") & (F.col("l_quantity") > 25), "open large")
        .otherwise(F.when(line == "O", "open").when(F.col("l_quantity") > 40, "large"))
    )
    return t["lineitem"].select("l_orderkey", "l_linenumber", "l_partkey", label.alias("label"))


def coalesce_chain(t: Given) -> DataFrame:
    key = F.col("o_orderkey")
    value = F.coalesce(
        F.when(key % 7 == 0, F.lit("seven")),
        F.when(key % 5 == 0, key.cast("string")),
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")),
        F.lit("none"),
    )
    return t["orders"].select("o_orderkey", value.alias("status"))


def scalar_functions(t: Given) -> DataFrame:
    text = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    parsed = scalars.parse_timestamp(F.concat(F.substring(text, 1, 10), F.lit(" 13:14:15")))
    words = F.split("o_orderpriority", "-")
    return t["orders"].select(
        "o_orderkey",
        parsed.alias("parsed_at"),
        scalars.age_seconds(F.col("o_orderdate"), F.lit("2001-08-02 00:00:00").cast("timestamp_ntz")).alias("age"),
        F.concat(F.lit("K"), F.col("o_orderkey").cast("string"), F.lit("|")).alias("joined"),
        F.concat_ws(" ", F.col("o_orderstatus"), F.lit(None).cast("string"), F.col("o_orderpriority")).alias("words"),
        F.size(words).alias("n_words"),
        scalars.id_from_text(words[0]).alias("priority"),
        scalars.id_from_text(words[1]).alias("no_number"),
    )


# --- joins -------------------------------------------------------------------


def inner_equi_join(t: Given) -> DataFrame:
    customer = t["customer"].select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey")
    )
    return (
        t["orders"]
        .select("o_orderkey", "o_custkey")
        .join(customer, "o_custkey")
        .join(t["nation"].select("n_nationkey", "n_name"), "n_nationkey")
        .select("o_orderkey", "o_custkey", "n_name")
    )


def left_outer_join(t: Given) -> DataFrame:
    orders = t["orders"].select(F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    return joins.left_outer_join(
        t["customer"].select("c_custkey"), orders, ["c_custkey"], hot_right=t.hot("orders", "o_custkey")
    )


def two_hop_absence(t: Given) -> DataFrame:
    link = t["orders"].select(F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    target = t["lineitem"].where("l_quantity > 49").select(F.col("l_orderkey").alias("o_orderkey"))
    return joins.two_hop_absence(
        t["customer"].select("c_custkey"),
        link,
        target,
        "c_custkey",
        "o_orderkey",
        hot_key=lambda: t.hot("orders", "o_custkey"),
    )


def exists_flag(t: Given) -> DataFrame:
    urgent = t["orders"].where(F.col("o_orderpriority") == "1-URGENT")
    return joins.exists_flag(
        t["customer"].select("c_custkey"),
        urgent.select(F.col("o_custkey").alias("c_custkey")),
        ["c_custkey"],
        "has_urgent",
    )


def not_exists(t: Given) -> DataFrame:
    lines = t["lineitem"].where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return joins.not_exists(t["orders"].select("o_orderkey", "o_custkey"), lines, ["o_orderkey"])


def unique_lookup(t: Given) -> DataFrame:
    names = t["customer"].select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return joins.unique_lookup(
        t["orders"].select("o_orderkey", "o_custkey"),
        names,
        ["o_custkey"],
        "c_name",
        hot=t.hot("orders", "o_custkey"),
        spread=["o_orderkey"],
    )


def first_match_lookup(t: Given) -> DataFrame:
    orders = t["orders"].withColumnRenamed("o_custkey", "c_custkey")
    return joins.first_match(
        t["customer"].select("c_custkey"),
        orders,
        ["c_custkey"],
        ["o_orderdate", "o_orderkey"],
        ["o_orderkey", "o_orderstatus"],
    )


def count_zero_flag(t: Given) -> DataFrame:
    failed = t["orders"].where("o_orderstatus = 'F'")
    return joins.count_zero_flag(
        t["customer"].select("c_custkey"),
        failed.select(F.col("o_custkey").alias("c_custkey")),
        ["c_custkey"],
        "has_none",
    )


def or_key_join(t: Given) -> DataFrame:
    return joins.or_key_join(
        t["customer"].select("c_custkey"),
        t["orders"].select("o_orderkey", "o_custkey"),
        "c_custkey",
        ["o_custkey", "o_orderkey"],
        hot_right=[t.hot("orders", "o_custkey")],
    )


def left_join_where_right(t: Given) -> DataFrame:
    return left_outer_join_all(t).where("o_orderstatus = 'F'")


def left_outer_join_all(t: Given) -> DataFrame:
    orders = t["orders"].withColumnRenamed("o_custkey", "c_custkey")
    return t["customer"].select("c_custkey").join(
        orders.select("c_custkey", "o_orderkey", "o_orderstatus"), "c_custkey", "left"
    )


def state_gated_join(t: Given) -> DataFrame:
    nation = t["nation"].select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return joins.state_gated_join(
        t["customer"].select("c_custkey", "c_mktsegment", "c_nationkey"),
        nation,
        F.col("c_mktsegment") == "BUILDING",
        ["c_nationkey"],
    )


def star_inner_join(t: Given) -> DataFrame:
    def lines(flag: str, column: str, name: str) -> DataFrame:
        return t["lineitem"].where(F.col("l_returnflag") == flag).select(
            F.col("l_orderkey").alias("o_orderkey"), F.col(column).alias(name)
        )

    return joins.star_inner_join(
        t["orders"].select("o_orderkey", "o_orderstatus"),
        [
            lines("A", "l_partkey", "returned_part"),
            lines("R", "l_suppkey", "refused_supplier"),
            lines("N", "l_linenumber", "kept_line"),
        ],
        "o_orderkey",
        hot=[{}] + [t.hot("lineitem", "l_orderkey")] * 3,
    )


# --- aggregates --------------------------------------------------------------


def grouped_count_status(t: Given) -> DataFrame:
    orders = t["orders"].where("o_totalprice > 300000").select(
        F.col("o_custkey").alias("c_custkey"), "o_orderkey"
    )
    return aggregates.grouped_count_status(
        t["customer"].select("c_custkey"),
        orders,
        ["c_custkey"],
        "No large order",
        counted="o_orderkey",
        count_name="n_orders",
        present="Exists",
    )


def grouped_concat(t: Given) -> DataFrame:
    return aggregates.grouped_concat(
        t["lineitem"],
        "l_orderkey",
        ["l_linenumber", "l_partkey"],
        "l_partkey",
        " ",
        name="parts",
        condition=F.col("l_returnflag") == "A",
        hot=t.hot("lineitem", "l_orderkey"),
    )


# --- arrays ------------------------------------------------------------------


def order_records(t: Given) -> DataFrame:
    """Records with four aligned arrays, as the scans expect them; test data only.

    Elements are sorted by everything that can make a difference to a result.
    """
    element = F.struct(
        "l_linenumber",
        "l_partkey",
        "l_returnflag",
        "l_linestatus",
        (F.col("l_linenumber") + F.when(F.col("l_orderkey") % 4 == 0, 5).otherwise(0)).alias("cntr"),
        F.expr("case l_returnflag when 'A' then 's' when 'N' then 'H' else 'x' end").alias("resp"),
        F.expr("if(l_linestatus = 'O', 'MEDLIMIT', 'OTHER')").alias("service"),
        F.expr("case l_partkey % 4 when 0 then 'HD' when 1 then 'HC' when 2 then 'MX' else 'ZZ' end").alias("reason"),
    )
    per_order = t["lineitem"].groupBy("l_orderkey").agg(
        F.array_sort(F.collect_list(element)).alias("e")
    )
    return per_order.select(
        "l_orderkey", *[F.col(f"e.{name}").alias(name) for name in ("cntr", "resp", "service", "reason")]
    )


def _zipped(t: Given) -> DataFrame:
    return order_records(t).select(
        "l_orderkey", arrays.zip_columns("cntr", "resp", "service", "reason").alias("z")
    )


def array_match_concat(t: Given) -> DataFrame:
    z = F.col("z")
    return _zipped(t).select(
        "l_orderkey",
        arrays.match_concat(z, "cntr").alias("service_seq"),
        arrays.match_concat(z, "resp").alias("resp_flags"),
        arrays.match_concat(z, "reason").alias("reason_codes"),
    )


def array_match_flags(t: Given) -> DataFrame:
    return _zipped(t).select(
        "l_orderkey",
        *[
            arrays.match_flag(F.col("z"), response, reasons).alias(name)
            for name, response, reasons in arrays.FLAG_RULES
        ],
    )


def array_scan_scalar_service(t: Given) -> DataFrame:
    records = order_records(t).withColumn(
        "service", F.when(F.col("l_orderkey") % 3 == 0, "OTHER").otherwise(arrays.SERVICE_NAME)
    )
    zipped = arrays.zip_columns("cntr", "resp", "service", "reason", scalar_service=True)
    return struct_unpack(
        records.select("l_orderkey", zipped.alias("z")), "s", arrays.scan_summary(F.col("z"), sep="|")
    ).drop("z")


def struct_unpack_query(t: Given) -> DataFrame:
    return struct_unpack(_zipped(t), "s", arrays.scan_summary(F.col("z"))).drop("z")


def array_slot_placement(t: Given) -> DataFrame:
    placed = _zipped(t).select("l_orderkey", F.posexplode(arrays.place_in_slots(F.col("z"))))
    return placed.select("l_orderkey", (F.col("pos") + 1).alias("slot"), "col.*")


def array_scan_words(t: Given) -> DataFrame:
    """A scan over the words of whole texts: arrays that need no grouping to exist."""
    served = F.filter(F.split("text", " "), lambda w: F.length(w) % 2 == 0)
    element = lambda w: F.struct(
        F.length(w).alias("cntr"),
        F.substring(w, 1, 1).alias("resp"),
        F.element_at(
            F.array(*[F.lit(r) for r in ("HD", "HC", "MX", "ZZ")]),
            (F.floor(F.length(w) / 2) % 4 + 1).cast("int"),
        ).alias("reason"),
    )
    hits = spread(t["documents"].select("doc_id", "text")).select("doc_id", F.transform(served, element).alias("z"))
    return struct_unpack(hits, "s", arrays.hit_summary(F.col("z"))).drop("z")


def row_flags(t: Given) -> DataFrame:
    rows = t["lineitem"].select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.expr("case l_returnflag when 'A' then 's' when 'N' then 'H' else 'x' end").alias("resp"),
        F.expr("if(l_linestatus = 'O', 'MEDLIMIT', 'OTHER')").alias("service"),
        F.expr(
            "case l_partkey % 4 when 0 then 'HD' when 1 then 'HC' when 2 then 'MX' else 'ZZ' end"
        ).alias("reason_service"),
    )
    return rows.withColumns(arrays.row_flags(F.col("resp"), F.col("reason_service")))


QUERIES = {
    "scan_rename": scan_rename,
    "nested_record_flatten": nested_record_flatten,
    "nested_prescriber": nested_prescriber,
    "nested_reject_code": nested_reject_code,
    "stale_files": stale_file_report,
    "filter_in_list": filter_in_list,
    "filter_constant_eq": filter_constant_eq,
    "filter_time_range": filter_time_range,
    "filter_time_range_inclusive": filter_time_range_inclusive,
    "filter_null_tests": filter_null_tests,
    "usable_id_predicate": usable_id_predicate,
    "case_searched": case_searched,
    "coalesce_chain": coalesce_chain,
    "scalar_functions": scalar_functions,
    "inner_equi_join": inner_equi_join,
    "left_outer_join": left_outer_join,
    "left_join_on_filter": left_join_on_filter,
    "two_hop_absence": two_hop_absence,
    "exists_flag": exists_flag,
    "not_exists": not_exists,
    "unique_lookup": unique_lookup,
    "first_match_lookup": first_match_lookup,
    "count_zero_flag": count_zero_flag,
    "or_key_join": or_key_join,
    "left_join_where_right": left_join_where_right,
    "state_gated_join": state_gated_join,
    "star_inner_join": star_inner_join,
    "grouped_count_status": grouped_count_status,
    "grouped_concat": grouped_concat,
    "array_match_concat": array_match_concat,
    "array_match_flags": array_match_flags,
    "array_scan_scalar_service": array_scan_scalar_service,
    "array_scan_words": array_scan_words,
    "struct_unpack": struct_unpack_query,
    "array_slot_placement": array_slot_placement,
    "row_flags": row_flags,
}
