"""The correctness gate: every catalogued query equals its DuckDB oracle
(row count, column names and types, order-insensitive value hash) over
the whole supplied tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as se
from millrun.plans import catalog
from conftest import SF001, SF01
from oracle_compare import compare, duck

QUERIES = {name: fn for name, fn in se.queries().items() if name in catalog.QUERIES}
SQL = {name: sql for name, sql in se.oracle_sql().items() if name in catalog.QUERIES}


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL) == set(catalog.QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, SF01, name, QUERIES[name], SQL[name], con)
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["columns_match"] and r["types_match"], r
    assert r["hash_match"], r


def test_entry_smoke(spark):
    df = se.entry(spark)
    assert df.columns[:2] == ["wbt", "wet"]
    assert df.count() > 0
    small = compare(spark, SF001, "q_size_stats_window", QUERIES["q_size_stats_window"],
                    SQL["q_size_stats_window"], duck(SF001))
    assert small["hash_match"], small
