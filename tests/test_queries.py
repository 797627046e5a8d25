"""Every registered query against its SQL in DuckDB, over whole tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from docquay.queries import QUERIES
from tests.conftest import SF_DIR

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings"
    " pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = contract.queries()[name](spark, SF_DIR)
    got = normal([tuple(r) for r in df.collect()], df.columns)
    cursor = duck.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert got == normal(cursor.fetchall(), columns)


def test_entry(spark):
    rows = contract.entry(spark)
    assert rows.count() > 0
    assert rows.columns[0] == "identifier"
