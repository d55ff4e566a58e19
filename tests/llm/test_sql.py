"""Corpus queries that SQL can express, against it; and the registration of all of them."""

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from check_oracle import rows_of
from checks.scans import TABLES
from tidemark.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    result = duck.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, result.fetchall())


def test_all_are_registered():
    names = set(queries())
    assert set(QUERIES) | {"pipeline"} <= names and set(ORACLES) <= set(oracle_sql())
    assert {n.split("_")[0] for n in QUERIES} == {f"op{k}" for k in range(1, 14)}
