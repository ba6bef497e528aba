"""Every catalog query against its SQL on another engine."""

from __future__ import annotations

import os

import pytest
from oracle import compare, connect

from seatgrid.plans.oracle import ORACLE_SQL
from seatgrid.plans.queries import QUERIES

import __spark_entry__ as entry_point

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(entry_point.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, connection, name):
    problems = compare(
        spark, SF_DIR, connection, QUERIES[name], ORACLE_SQL[name]
    )
    assert problems == []


def test_entry_has_rows(spark):
    df = entry_point.entry(spark)
    assert "feature_slots" in df.columns
    assert df.count() > 0
