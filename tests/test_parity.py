"""Every registered query equals its DuckDB oracle at sf0.01 (rows, names, values)."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from conftest import SF001, SF01
from parity import compare, duck
from sessionmart import catalog
from sessionmart.oracle import ORACLE

QUERIES = catalog.queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(QUERIES[name](spark, SF01), con, ORACLE[name])
    assert r["cols_match"] and r["values_match"] and r["rows_spark"] == r["rows_oracle"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == E.entry(spark).columns
    assert SF001.endswith("0.001")
