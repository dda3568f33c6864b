"""Every registered query against its DuckDB twin on sf0.001, and the entry smoke."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import compare, duck  # noqa: E402

from martforge.plans import catalog  # noqa: E402

SF = "/root/testdata/sf0.001"
QUERIES, SQL = E.queries(), E.oracle_sql()
MARTS = sorted(catalog.QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_mart_query_has_an_oracle():
    assert set(MARTS) == set(catalog.ORACLE) and set(MARTS) <= set(QUERIES) and set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", MARTS)
def test_query_matches_oracle(spark, con, name):
    same, msg = compare(spark, con, name, SF, QUERIES, SQL)
    assert same, msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "cnt" in df.columns
