"""Every registered query against its SQL on the same parquet tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
import duckdb_oracle

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("orders", "customer")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return con


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(str(row[i]) for i in order) for row in rows)


def test_every_query_has_an_oracle():
    assert set(contract.balance_queries()) == set(duckdb_oracle.oracle_sql())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables not present")
@pytest.mark.parametrize("name", sorted(contract.balance_queries()))
def test_query_matches_oracle(spark, duck, name):
    df = contract.balance_queries()[name](spark, SF_DIR)
    result = duck.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    expected = _rows(columns, result.fetchall())
    actual = _rows(df.columns, [tuple(r) for r in df.collect()])
    assert len(actual) == len(expected)
    assert actual == expected
