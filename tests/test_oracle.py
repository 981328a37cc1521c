"""Every named query against its SQL oracle in an independent engine."""

import math

import duckdb
import pytest

import __spark_entry__ as contract
from autostrata.workload.oracle import ORACLE
from autostrata.workload.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

DUCK_TYPES = {
    "int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE",
    "boolean": "BOOLEAN", "date": "DATE",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def _row(row, columns):
    cells = []
    for column in columns:
        value = row[column]
        if isinstance(value, float):
            value = "nan" if math.isnan(value) else float(f"{value:.12g}")
        cells.append((value is not None, str(value)))
    return tuple(cells)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_oracle(spark, duck, name):
    result = contract.queries()[name](spark, SF_DIR)
    expected = duck.sql(contract.oracle_sql()[name])
    assert sorted(result.columns) == sorted(expected.columns)
    types = {c: DUCK_TYPES[t] for c, t in result.dtypes}
    assert types == {c: str(t) for c, t in zip(expected.columns, expected.types)}
    columns = sorted(result.columns)
    got = sorted(_row(r.asDict(), columns) for r in result.collect())
    want = sorted(_row(dict(zip(expected.columns, r)), columns) for r in expected.fetchall())
    assert len(got) == len(want)
    assert got == want
    assert got, "the query returns no rows, so the comparison says nothing"


def test_entry(spark):
    assert contract.entry(spark).count() > 0
