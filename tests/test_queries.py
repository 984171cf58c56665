"""Every query against its SQL on the small tables."""

import collections
import glob
import os

import duckdb
import pytest

import __spark_entry__ as contract

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TYPES = {
    "string": "VARCHAR",
    "double": "DOUBLE",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def bag(rows):
    rounded = ([round(v, 6) if isinstance(v, float) else v for v in row] for row in rows)
    return collections.Counter(tuple(row) for row in rounded)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_matches_sql(spark, duck, name):
    found = contract.queries()[name](spark, FOLDER)
    columns = sorted(found.columns)
    wanted = duck.sql(f"SELECT * FROM ({contract.oracle_sql()[name]})")
    assert sorted(wanted.columns) == columns
    kinds = dict(zip(wanted.columns, map(str, wanted.types)))
    assert {c: TYPES[t] for c, t in found.dtypes} == kinds
    order = [wanted.columns.index(c) for c in columns]
    expected = bag([row[i] for i in order] for row in wanted.fetchall())
    assert bag(found.select(*[f"`{c}`" for c in columns]).collect()) == expected


def test_each_sql_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
