"""Every registered query against its SQL, on the smallest of the driver's tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from broadsheet.catalog import QUERIES
from broadsheet.oracles import ORACLES

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for table in ("documents", "benchmark"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    return connection


def comparable(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        tuple(f"{row[i]:.9f}" if isinstance(row[i], float) else repr(row[i]) for i in order)
        for row in rows
    )


def test_every_query_has_its_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert contract.queries().keys() >= QUERIES.keys()
    assert contract.oracle_sql().keys() >= ORACLES.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, sql, name):
    found = QUERIES[name](spark, DATA)
    rows = [tuple(row) for row in found.collect()]
    result = sql.execute(ORACLES[name])
    columns = [column[0] for column in result.description]
    assert sorted(found.columns) == sorted(columns)
    expected = comparable(columns, result.fetchall())
    assert expected
    assert comparable(found.columns, rows) == expected


def test_entry(spark):
    assert contract.entry(spark).count() == 40
