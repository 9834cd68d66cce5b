"""Every catalogue query against its SQL, on the smallest test tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as contract
from terrane.plans import catalogue, oracle

NAMES = [query.__name__ for query in catalogue.QUERIES]
SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()
# Spark type -> SQL type of the same result column.
TYPES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "timestamp_ntz": "TIMESTAMP",
    "date": "DATE", "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    yield con
    con.close()


def plain(value):
    return None if isinstance(value, float) and math.isnan(value) else value


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, db, name):
    df = contract.queries()[name](spark, SF_DIR)
    result = db.execute(contract.oracle_sql()[name])
    types = {column[0]: str(column[1]) for column in result.description}
    assert {column: TYPES[kind] for column, kind in df.dtypes} == types
    order = [list(types).index(column) for column in sorted(types)]
    expected = sorted(repr([plain(row[i]) for i in order]) for row in result.fetchall())
    got = sorted(repr([plain(v) for v in row]) for row in df.select(*sorted(df.columns)).collect())
    assert got == expected
    assert got


def test_contract(spark):
    assert set(NAMES) == set(oracle.SQL)
    assert set(NAMES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).count() > 0
