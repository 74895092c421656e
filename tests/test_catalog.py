"""Every registered query against its SQL in DuckDB."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from feedmill import catalog

QUERIES = entry.queries()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for file in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(file).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from '{file}'")
    yield con
    con.close()


def test_every_query_has_its_sql():
    """Those of the optional training-data package are tested with it where SQL cannot express them."""
    assert catalog.QUERIES.keys() == catalog.ORACLE.keys()
    assert catalog.QUERIES.keys() <= entry.oracle_sql().keys() <= QUERIES.keys()


def test_entry(spark):
    assert entry.entry(spark).count() == 254


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_rows_as_sql(spark, duck, sf_dir, name):
    found = QUERIES[name](spark, sf_dir)
    columns = sorted(found.columns)
    wanted = duck.execute(entry.oracle_sql()[name])
    assert sorted(d[0] for d in wanted.description) == columns
    order = [[d[0] for d in wanted.description].index(c) for c in columns]
    expected = sorted(repr(tuple(row[i] for i in order)) for row in wanted.fetchall())
    assert sorted(repr(tuple(r)) for r in found.select(*columns).collect()) == expected
