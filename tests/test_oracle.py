"""Every registered query against DuckDB over whole tables."""

from __future__ import annotations

import os

import pytest

from suite import ORACLES, QUERIES
from tests.oracle import connect, difference

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) is None


def test_entry(spark):
    import __spark_entry__ as entry

    rows = {r["rule"]: r["violations"] for r in entry.entry(spark).collect()}
    assert set(rows) == {"valid-event-type", "value-cap", "ts-not-future", "props-two-digits"}  # no user above 139 here
    assert set(entry.oracle_sql()) <= set(entry.queries()) >= set(QUERIES)
