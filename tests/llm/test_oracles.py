"""Registered queries against their SQL, over whole tables."""

import os

import duckdb
import pytest

from dialtrail.llm.registry import oracle_sql, queries
from tests.compare import duck_bag, spark_bag

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", oracle_sql())
def test_query_matches_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "conversations", "labels"):
        duck.sql(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    expected = duck.sql(oracle_sql()[name])
    assert spark_bag(queries()[name](spark, SF_DIR)) == duck_bag(expected)
