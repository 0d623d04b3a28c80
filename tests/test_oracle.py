"""Every registered query against DuckDB on the smallest test data."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry_point
from shared import SF_DIR
from sumstone.plans import catalog


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    yield con
    con.close()


def canonical(table):
    names = sorted(table.column_names)
    table = table.select(names)
    types = [str(table.schema.field(n).type) for n in names]
    rows = sorted(map(repr, zip(*[c.to_pylist() for c in table.columns])))
    return names, types, rows


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_sql(spark, duck, name):
    found = canonical(catalog.QUERIES[name](spark, SF_DIR).toArrow())
    wanted = canonical(duck.sql(catalog.ORACLES[name]).to_arrow_table())
    assert found[0] == wanted[0]
    assert found[1] == wanted[1]
    assert found[2] == wanted[2]


def test_contract(spark):
    assert entry_point.queries().keys() >= entry_point.oracle_sql().keys()
    assert entry_point.entry(spark).columns == ["country", "channel", "users", "orders", "revenue"]
    assert all(catalog.COVERS[name] for name in catalog.QUERIES)
