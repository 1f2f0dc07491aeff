"""What the physical plans must and must not hold."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry_point
from tillstream.plans.catalog import QUERIES
from tillstream.config import AlertRule
from tillstream.operators import alerts, dedup
from tillstream.sources import domain
from tillstream.sources.files import table

BATCH = sorted(n for n in QUERIES if not n.startswith("stream_") and n != "table_upsert")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_query_pairs_all_rows_or_leaves_the_jvm(spark, sf):
    for name in BATCH:
        text = plan(entry_point.queries()[name](spark, sf))
        for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ArrowEval"):
            assert operator not in text, (name, operator)


@pytest.mark.parametrize("name, columns", [
    ("dau_by_hour", "ts:timestamp_ntz,user_id:bigint"),
    ("gmv_total", "o_totalprice:double,o_orderdate:timestamp_ntz"),
    ("term_filter", "o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string"),
])
def test_only_needed_columns_are_read(spark, sf, name, columns):
    assert f"ReadSchema: struct<{columns}>" in plan(entry_point.queries()[name](spark, sf))


def test_filters_reach_the_scan(spark, sf):
    assert "EqualTo(o_orderstatus,F)" in plan(entry_point.queries()["term_filter"](spark, sf))
    assert "EqualTo(event_type,purchase)" in plan(entry_point.queries()["gmv_by_hour"](spark, sf))
    # The status filter of a search passes the joins.
    assert "EqualTo(o_orderstatus,F)" in plan(entry_point.queries()["hit_total"](spark, sf))
    assert "GreaterThanOrEqual(o_custkey,100)" in plan(entry_point.queries()["page_after_row"](spark, sf))


def test_pages_keep_only_the_top_rows(spark, sf):
    for name in ("page_offset", "page_sorted", "page_after_row", "terms_top_n"):
        assert "TakeOrderedAndProject" in plan(entry_point.queries()[name](spark, sf))


def test_picks_are_made_before_the_shuffle(spark, sf):
    events = table(spark, sf, "events")
    text = plan(dedup.latest_by_key(events, ["user_id"], ["ts"]))
    assert "partial_max" in text and text.count("Exchange") == 1


def test_facets_read_the_hits_once(spark, sf):
    text = plan(entry_point.queries()["faceted_search"](spark, sf))
    assert len(re.findall(r"lineitem\.parquet", text)) == 1


def test_windows_are_not_copied(spark, sf):
    """The step form makes at most a handful of rows per slot, whatever the slide."""
    logs = domain.event_logs(table(spark, sf, "events"))
    for slide in ("1 hour", "1 minute"):
        rule = AlertRule(window="1 day", slide=slide, coupon=("purchase",), browse=("view",))
        text = plan(alerts.fired(alerts.window_counts(logs, rule), rule))
        # One generator per step array and one for the windows that fired.
        assert text.count("Generate explode") == 3
        below = text[text.index("Generate explode(sequence"):]
        assert "n_browse" in below and re.search(r"Filter \(.*n_uids", below)
