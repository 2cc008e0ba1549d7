"""Every checked query against its SQL on the smallest driver tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_points

QUERIES = entry_points.queries()
ORACLES = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    if not os.path.isdir(sf_dir):
        pytest.skip("driver tables not present")
    connection = duckdb.connect()
    for file in sorted(os.listdir(sf_dir)):
        table = file.removesuffix(".parquet")
        connection.sql(f"create view {table} as select * from '{sf_dir}/{file}'")
    return connection


def _comparable(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def cell(value):
        if isinstance(value, float) and math.isnan(value):
            return "nan"
        if isinstance(value, bool) or value is None or isinstance(value, str):
            return str(value)
        return repr(float(value) + 0.0)

    return sorted(tuple(cell(row[i]) for i in order) for row in rows)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, sf_dir, name):
    result = QUERIES[name](spark, sf_dir)
    expected = duck.sql(ORACLES[name])
    assert sorted(result.columns) == sorted(expected.columns)
    assert _comparable(result.collect(), result.columns) == _comparable(
        expected.fetchall(), expected.columns
    )


def test_flagship_query(spark):
    assert {row["label_name"] for row in entry_points.entry(spark).collect()} == {
        "Dropout",
        "Enrolled",
        "Graduate",
    }
