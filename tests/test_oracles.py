"""Every registered query against its DuckDB oracle at sf0.01 (the driver's gate)."""

import os

import pytest

import __spark_entry__ as entry
from ledgerlake.plans import catalog
from oracle_compare import compare, duck_connection

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
QUERIES, SQL = catalog.queries(), catalog.oracle_sql()


@pytest.fixture(scope="module")
def con():
    if not os.path.exists(f"{SF_DIR}/orders.parquet"):
        pytest.skip("test data not present")
    return duck_connection(SF_DIR)


def test_every_query_has_an_oracle_and_inventory_lines():
    assert set(QUERIES) == set(SQL) == set(catalog.COVERS)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, QUERIES[name](spark, SF_DIR), SQL[name])
    assert r["ok"], r


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["c_nationkey", "leaf_amount"] and df.count() > 0
