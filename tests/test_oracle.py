"""Every registered query against its SQL on another engine, on the smallest tables."""

import pytest
from conftest import SMALL

import __spark_entry__ as entry

duckdb = pytest.importorskip("duckdb")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return connection


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([repr(row[i]) for i in order] for row in rows)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, database, name):
    df = entry.queries()[name](spark, SMALL)
    result = database.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    got = normal([tuple(r) for r in df.collect()], df.columns)
    assert got and got == normal(result.fetchall(), columns)


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert "root_cause" in df.columns and df.count() > 0
