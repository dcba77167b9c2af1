"""Every registered query against its SQL, over whole tables."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from dialtrail import registry
from tests.compare import duck_bag, spark_bag

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
QUERIES = registry.queries()
ORACLES = registry.oracle_sql()

# DuckDB's name for each Spark type that a result may hold.
DUCK_TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in ("customer", "nation", "orders", "events"):
        path = f"{SF_DIR}/{table}.parquet"
        connection.sql(f"create view {table} as select * from '{path}'")
    return connection


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= contract.queries().keys()
    assert contract.oracle_sql().items() >= ORACLES.items()


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    expected = duck.sql(ORACLES[name])
    found = {column: DUCK_TYPES[kind] for column, kind in result.dtypes}
    assert found == dict(zip(expected.columns, map(str, expected.types)))
    assert spark_bag(result) == duck_bag(expected)


def test_entry(spark):
    assert contract.entry(spark).count() > 0
