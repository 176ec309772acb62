"""Every query against its SQL, values, column names and types."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from loadglass.catalog import QUERIES

SPARK_TO_SQL = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def tables(folder):
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    yield connection
    connection.close()


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, folder, tables, name):
    result = entry.queries()[name](spark, folder)
    expected = tables.sql(entry.oracle_sql()[name])

    columns = sorted(result.columns)
    types = {f.name: SPARK_TO_SQL[f.dataType.simpleString()] for f in result.schema}
    assert types == dict(zip(expected.columns, map(str, expected.types)))

    order = [expected.columns.index(column) for column in columns]
    got = sorted(repr(tuple(row[c] for c in columns)) for row in result.collect())
    want = sorted(repr(tuple(row[i] for i in order)) for row in expected.fetchall())
    assert got == want


def test_entry_is_the_flagship(spark):
    result = entry.entry(spark)
    assert result.count() == 12
    assert result.columns == [
        "service", "endpoint", "mean_ms", "median_ms", "p95_ms", "request_count",
        "error_rate",
    ]
