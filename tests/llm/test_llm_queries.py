"""The operators' queries over a small table against their SQL."""

import duckdb
import pytest

from check import TABLES, compare, rows_of
from loomframe.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    df = QUERIES[name](spark, SF_DIR)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    assert got
    if name in ORACLES:
        result = db.execute(ORACLES[name])
        names = [c[0] for c in result.description]
        assert sorted(names) == sorted(df.columns)
        assert compare(got, rows_of(names, result.fetchall())) == "ok"


def test_operators():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
