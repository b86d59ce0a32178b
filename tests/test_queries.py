"""Every registered query against the same query in another engine."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from tidemark.workloads.checks import CHECKS
from tidemark.workloads.queries import QUERIES

TYPES = {
    "int64": "BIGINT",
    "int32": "INTEGER",
    "string": "VARCHAR",
    "large_string": "VARCHAR",
    "double": "DOUBLE",
    "bool": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for file in os.listdir(sf_dir):
        name = file.split(".")[0]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{file}'")
    return connection


def in_order(rows):
    return sorted(rows, key=lambda row: tuple((v is None, str(v)) for v in row))


def test_every_query_has_a_check():
    assert set(QUERIES) == set(CHECKS)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(CHECKS) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_check(spark, duck, sf_dir, name):
    got = QUERIES[name](spark, sf_dir).toArrow()
    cursor = duck.execute(CHECKS[name])
    want, names = cursor.fetchall(), [d[0] for d in cursor.description]
    types = {d[0]: str(d[1]).upper() for d in cursor.description}
    columns = sorted(names)
    assert sorted(got.column_names) == columns
    assert {f.name: TYPES[str(f.type)] for f in got.schema} == types
    at = [names.index(c) for c in columns]
    rows = zip(*(got[c].to_pylist() for c in columns))
    assert in_order(rows) == in_order(tuple(r[i] for i in at) for r in want)


def test_entry_has_rows(spark):
    assert entry_points.entry(spark).count() > 0
