"""Queries that SQL can express, against that SQL."""

import os

import duckdb
import pytest

from terrane.llm import queries, sql

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sql.SQL)
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    df = getattr(queries, name)(spark, SF)
    result = con.execute(sql.SQL[name])
    types = {column[0]: str(column[1]) for column in result.description}
    assert {column: TYPES[kind] for column, kind in df.dtypes} == types
    order = [list(types).index(column) for column in sorted(types)]
    expected = sorted(repr([row[i] for i in order]) for row in result.fetchall())
    assert sorted(repr(list(row)) for row in df.select(*sorted(df.columns)).collect()) == expected
    assert expected


def test_every_operator_has_its_query():
    numbers = [int(q.__name__[2:].split("_")[0]) for q in queries.QUERIES]
    assert numbers == list(range(1, 14))
