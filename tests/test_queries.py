"""Every registered query against its SQL in DuckDB, whole tables, order-insensitive."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from sediment.queries import all_oracles, all_queries
from tests.conftest import SF_DIR


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"create view {name} as select * from '{path}'")
    return connection


def normal(value):
    if isinstance(value, float):
        return "NULL" if math.isnan(value) else repr(value)
    return "NULL" if value is None else str(value)


def test_every_query_has_an_oracle():
    assert set(all_queries()) == set(all_oracles())
    assert set(all_queries()) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_equals_oracle(spark, oracle, name):
    df = entry.queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    cursor = oracle.execute(entry.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    expected = sorted(tuple(normal(row[i]) for i in order) for row in cursor.fetchall())
    found = sorted(tuple(normal(row[c]) for c in columns) for row in df.collect())
    assert len(found) > 0
    assert found == expected


def test_entry(spark):
    assert entry.entry(spark).columns == ["country", "category", "total_units_sold", "total_revenue"]
