"""Every registered query with a SQL twin gives the same rows as DuckDB on the smallest tables."""

import os

import pytest

from oracle import compare, connect
from riskweave.catalog import load

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLE = load()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(ORACLE))
def test_same_rows_as_sql(spark, con, name):
    state, _, _, note = compare(spark, con, name, QUERIES, ORACLE, FOLDER)
    assert state in ("ok", "EMPTY"), note


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLE])
def test_runs(spark, name):
    assert len(QUERIES[name](spark, FOLDER).collect()) > 0
