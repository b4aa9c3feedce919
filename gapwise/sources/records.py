"""Nested records with a declared schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

# The record schemas. All fields can be NULL; the second outer
# field starts with a digit, so that SQL has to quote it.
PRESCRIBER = StructType(
    [
        StructField(
            "d_prescriber_rec",
            StructType(
                [
                    StructField("pbr_dea_id", StringType()),
                    StructField("pbr_npi", StringType()),
                    StructField("pbr_first_nm", StringType()),
                    StructField("pbr_mid_init_nm", StringType()),
                    StructField("pbr_last_nm", StringType()),
                ]
            ),
        )
    ]
)
REJECT_CODE = StructType(
    [
        StructField(
            "1_reject_code_rec",
            StructType(
                [
                    StructField("dxf_sk", IntegerType()),
                    StructField("rej_cd", StringType()),
                    StructField("rej_cd_desc", StringType()),
                    StructField("src_env_sk", StringType()),
                ]
            ),
        )
    ]
)


def _inner(path: str) -> str:
    quoted = ".".join(f"`{part}`" for part in path.split(".") if part)
    return f"{quoted}.*"


def flatten_record(
    df: DataFrame, json_column: str, schema: StructType, path: str = "", keep: tuple[str, ...] = ()
) -> DataFrame:
    """Parse JSON text and lift the fields of the struct at ``path`` to columns.

    Fields that a record lacks come out as NULL, and so does everything for
    text that is no record. The fields have to be read from one parse, hence
    the parsed struct is made in a projection of its own.
    """
    parsed = df.select(*keep, F.from_json(json_column, schema).alias("_record"))
    return parsed.select(*keep, _inner(f"_record.{path}"))


def read_records(spark: SparkSession, location: str, schema: StructType, path: str) -> DataFrame:
    """The same from JSON files, one record per line; no schema inference pass."""
    return spark.read.schema(schema).json(location).select(_inner(path))


def struct_unpack(df: DataFrame, name: str, struct: Column) -> DataFrame:
    """Compute a struct column, spread its fields to columns and drop it."""
    return df.withColumn(name, struct).select("*", f"{name}.*").drop(name)
