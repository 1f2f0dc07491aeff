"""Scalar functions on hand-made rows."""

from __future__ import annotations

from datetime import date, timedelta

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tillstream.functions import (
    age_band, age_years, all_terms, any_term, hour_of, keyword_terms, mask_phone, minute_doc_id, ms_to_time,
    pct, pct_text, prev_day, to_number, tokens, with_create_parts, with_log_parts,
)


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_log_parts_at_day_edges(spark):
    ms = [(1704153599999,), (1704153600000,), (None,)]
    df = with_log_parts(spark.createDataFrame(ms, "ts bigint")).select("log_date", "log_hour")
    assert [tuple(r) for r in df.collect()] == [("2024-01-01", "23"), ("2024-01-02", "00"), (None, None)]


def test_create_parts_take_the_hour_not_the_minute(spark):
    rows = [("2024-03-05 09:05:59",), ("2024-03-05",), (None,)]
    df = with_create_parts(spark.createDataFrame(rows, "create_time string")).drop("create_time")
    assert [tuple(r) for r in df.collect()] == [("2024-03-05", "09"), ("2024-03-05", None), (None, None)]


def test_mask_phone_short_and_null(spark):
    rows = [("13812345678",), ("13",), (None,)]
    assert values(spark, rows, "p string", mask_phone(F.col("p"))) == [("1381*******",), ("13*******",), (None,)]


def test_age_around_multiples_of_365_days(spark):
    as_of = date(2024, 1, 1)
    rows = [(as_of - timedelta(days=d),) for d in (7299, 7300, 7301, 0, -10)] + [(None,)]
    got = values(spark, rows, "b date", age_years(F.col("b"), F.lit("2024-01-01")))
    assert [g[0] for g in got] == [19, 20, 20, 0, 0, None]


def test_age_bands(spark):
    rows = [(a,) for a in (19, 20, 29, 30)] + [(None,)]
    got = [g[0] for g in values(spark, rows, "a int", age_band(F.col("a")))]
    assert got == ["under 20", "20 to 30", "20 to 30", "30 and over", None]


def test_pct_rounds_halves_up_and_survives_zero(spark):
    rows = [(9, 400), (705, 1345), (640, 1345), (0, 0), (0, 5), (5, 5)]
    got = values(spark, rows, "x bigint, t bigint", pct(F.col("x"), F.col("t")), pct_text(F.col("x"), F.col("t")))
    assert got[0] == (2.3, "2.3")
    assert got[1][0] == 52.4
    # The sample value: 100 - 705 * 100 / (705 + 640), one decimal.
    assert got[2] == (47.6, "47.6")
    assert got[3][0] is None
    assert got[4:] == [(0.0, "0.0"), (100.0, "100.0")]


def test_to_number(spark):
    assert values(spark, [("12.50",), ("x",), (None,)], "s string", to_number(F.col("s"))) == [(12.5,), (None,), (None,)]


def test_prev_day_and_minute_id(spark):
    rows = [("2024-03-01", 1709251199000)]
    got = values(
        spark, rows, "d string, ts bigint",
        prev_day(F.col("d")), minute_doc_id(F.lit("mid_7"), ms_to_time(F.col("ts"))), hour_of(ms_to_time(F.col("ts"))),
    )
    assert got == [("2024-02-29", "mid_7-2024-02-29 23:59", "23")]


TEXTS = ["cold Widget", "widget, COLD-brew", "coldwidget", "", None, "乒乓球篮球击剑", "橄榄球 ball", "Größe élan", "a1 b2"]


@pytest.mark.parametrize("keyword, all_hits, any_hits", [
    ("widget cold", {"cold Widget", "widget, COLD-brew"}, {"cold Widget", "widget, COLD-brew"}),
    ("球", {"乒乓球篮球击剑", "橄榄球 ball"}, {"乒乓球篮球击剑", "橄榄球 ball"}),
    ("ball cold", set(), {"cold Widget", "widget, COLD-brew", "橄榄球 ball"}),
    ("GRÖSSE", set(), set()),
    ("größe", {"Größe élan"}, {"Größe élan"}),
    ("a", set(), set()),
    ("", set(), set()),
    (None, set(), set()),
])
def test_match(spark, keyword, all_hits, any_hits):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    assert {r.t for r in df.where(all_terms(F.col("t"), keyword)).collect()} == all_hits
    assert {r.t for r in df.where(any_term(F.col("t"), keyword)).collect()} == any_hits


def test_tokens(spark):
    got = [g[0] for g in values(spark, [(t,) for t in TEXTS], "t string", tokens(F.col("t")))]
    assert got[1] == ["widget", "cold", "brew"]
    assert got[3] == [] and got[4] == []
    assert got[5] == list("乒乓球篮击剑")
    assert keyword_terms("Cold 球ball") == ["cold", "球", "ball"]


ALPHABET = "ab1 .-é球が́ü"


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(ALPHABET, max_size=12), min_size=1, max_size=30), st.text(ALPHABET, min_size=1, max_size=4))
def test_searching_equals_cutting(spark, texts, keyword):
    """The search pattern agrees with the token arrays on any text."""
    terms = keyword_terms(keyword)
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    want = F.lit(bool(terms))
    for t in terms:
        want = want & F.array_contains(tokens(F.col("t")), t)
    assert df.where(want != all_terms(F.col("t"), keyword)).count() == 0
