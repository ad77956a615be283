"""Every query against its SQL in DuckDB, all rows and values."""

import re
from collections import Counter
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

DATA = Path("/root/testdata")
ORACLE = oracle_sql()
# The operators for training text have tests of their own.
QUERIES = {k: v for k, v in queries().items() if not re.match(r"op\d+_|pipeline$", k)}


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for file in sorted((DATA / "sf0.01").glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def test_every_query_has_sql():
    assert QUERIES.keys() <= ORACLE.keys()


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_as_sql(spark, tables, name):
    ours = QUERIES[name](spark, str(DATA / "sf0.01"))
    result = tables.execute(ORACLE[name])
    columns = [column[0] for column in result.description]
    assert sorted(columns) == sorted(ours.columns)
    expected = Counter(result.fetchall())
    found = Counter(tuple(row) for row in ours.select(*[f"`{c}`" for c in columns]).collect())
    assert found == expected
    assert expected


def test_entry(spark):
    rows = entry(spark).collect()
    assert [row["rank"] for row in rows] == [0, 1, 2, 3, 4]
