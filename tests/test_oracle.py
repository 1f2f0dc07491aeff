"""Every registered query against its SQL on the whole tables at sf0.01."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_point
from tillstream.plans.catalog import ORACLES, QUERIES
from tests.oracle import compare, connect


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    assert compare(df, con, ORACLES[name]) > 0


def test_entry_has_rows(spark):
    assert entry_point.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())
