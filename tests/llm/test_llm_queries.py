"""Every query of the subpackage that has SQL against it, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from broadsheet.llm.queries import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"


def test_all_are_registered():
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in QUERIES}
    assert contract.queries().keys() >= {*QUERIES, "pipeline"}
    assert ORACLES.keys() <= QUERIES.keys()


@pytest.mark.parametrize("name", ORACLES)
def test_query(spark, name):
    sql = duckdb.connect()
    for table in ("documents", "embeddings"):
        sql.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    found = QUERIES[name](spark, DATA)
    result = sql.execute(ORACLES[name])
    columns = [column[0] for column in result.description]
    assert sorted(found.columns) == sorted(columns)
    assert sorted(map(tuple, found.select(*columns).collect())) == sorted(result.fetchall())
