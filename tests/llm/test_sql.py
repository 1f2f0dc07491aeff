"""Queries of the text operators against their SQL on the whole tables at sf0.01."""

from __future__ import annotations

import pytest

from tests.oracle import compare, connect
from tillstream.llm.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf, con, name):
    assert compare(QUERIES[name](spark, sf), con, ORACLES[name]) > 0


def test_native_operators_run_no_python(spark, sf):
    for name in ("op5_secret_scan", "op6_perspectives", "op10_benchmark_leaks"):
        text = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        for operator in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert operator not in text, (name, operator)
