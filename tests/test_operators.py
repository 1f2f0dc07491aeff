"""Batch operators on small hand-made rows, with the edge cases of each."""

from __future__ import annotations

import json
from collections import defaultdict
from dataclasses import replace
from datetime import datetime, timedelta
from random import Random

import pytest
from pyspark.sql import functions as F

from tillstream.config import AlertRule
from tests import fixtures
from tillstream.operators import alerts, dedup, joins, metrics, search
from tillstream.streaming.sinks import KeyedTable, upsert, with_auto_id


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# --- dedup -----------------------------------------------------------------------------------

def test_first_and_latest_break_ties_by_id(spark):
    df = spark.createDataFrame(
        [("a", 5, 2), ("a", 5, 1), ("a", 9, 3), ("b", 1, 4), (None, 2, 5)], "k string, ts int, id int")
    assert rows(dedup.first_per_key(df, ["k"], ["ts", "id"])) == [("a", 5, 1), ("b", 1, 4), (None, 2, 5)]
    assert rows(dedup.latest_by_key(df, ["k"], ["ts"])) == [("a", 9, 3), ("b", 1, 4), (None, 2, 5)]


def test_pick_with_map_column_and_keys_only(spark):
    df = spark.createDataFrame([("a", 1, {"x": "1"}), ("a", 2, {"y": "2"})], "k string, ts int, m map<string,string>")
    assert dedup.latest_by_key(df, ["k"], ["ts"]).first().m == {"y": "2"}
    assert dedup.first_per_key(df.select("k"), ["k"], []).count() == 1


def test_daily_first_over_midnight(spark):
    df = spark.createDataFrame(
        [("d1", "m", 10), ("d2", "m", 20), ("d2", "m", 15), ("d1", "n", 11)], "log_date string, mid string, ts int")
    assert rows(dedup.daily_first(df, ["ts"])) == [("d1", "m", 10), ("d1", "n", 11), ("d2", "m", 15)]


def test_seen_filters(spark):
    df = spark.createDataFrame([("d1", "m"), ("d2", "m"), ("d1", "n")], "log_date string, mid string")
    seen = spark.createDataFrame([("d1", "m"), ("d1", "m")], "log_date string, mid string")
    assert rows(dedup.not_seen(df, seen, ["log_date", "mid"])) == [("d1", "n"), ("d2", "m")]
    assert rows(dedup.is_seen(df, seen, ["log_date", "mid"])) == [("d1", "m")]


# --- joins -----------------------------------------------------------------------------------

@pytest.fixture()
def orders(spark):
    return spark.createDataFrame(
        [("o1", "u1", "1001", "2024-03-05 09:05:00", "2024-03-05"), ("o2", "u9", "1001", "2024-03-05 10:00:00", "2024-03-05"),
         ("o3", "u1", "1001", "2024-03-06 10:00:00", "2024-03-06")],
        "id string, user_id string, order_status string, create_time string, create_date string")


@pytest.fixture()
def details(spark):
    return spark.createDataFrame(
        [("d1", "o1", "s1", "cold widget", "9.50"), ("d2", "o1", "s2", "ring", "1"), ("d3", "o2", "s1", "cold widget", "9.50"),
         ("d4", "oX", "s1", "lost", "3")],
        "id string, order_id string, sku_id string, sku_name string, order_price string")


def test_full_outer_join(orders, details):
    mine = joins.orders_full_outer_details(orders, details)
    want = orders.select(F.col("id").alias("o"), "user_id").join(
        details.select("id", "order_id"), F.col("o") == F.col("order_id"), "full_outer")
    got = mine.select(F.col("id_of_order").alias("o"), "user_id", "id", "order_id")
    assert rows(got) == rows(want) and got.count() == 5


def test_sale_detail_with_users(spark, orders, details):
    sales = joins.sale_detail(orders, details)
    assert sales.count() == 3
    cache = spark.createDataFrame([("u1", "F", "3", "2000-01-01")], "id string, gender string, user_level string, birthday string")
    base = spark.createDataFrame([("u1", "M", "1", "1990-01-01"), ("u2", "M", "1", "1990-01-01")], cache.schema)
    users = joins.two_level_users(cache, base)
    assert rows(users.select("id", "gender")) == [("u1", "F"), ("u2", "M")]
    out = {r.order_detail_id: r for r in joins.enrich_with_users(sales, users, F.lit("2020-01-01")).collect()}
    assert (out["d1"].user_gender, out["d1"].user_age, out["d1"].sku_price) == ("F", 20, 9.5)
    assert out["d3"].user_gender is None and out["d3"].user_age is None


def test_unmatched(orders, details):
    assert [r.id for r in joins.unmatched_orders(orders, details, "id", "order_id").collect()] == ["o3"]
    assert [r.id for r in joins.unmatched_details(orders, details, "id", "order_id").collect()] == ["d4"]


def test_interval_join_bounds(spark):
    t = datetime(2024, 1, 1)
    o = spark.createDataFrame([("o", t)], "id string, at timestamp")
    d = spark.createDataFrame(
        [(f"{s:+d}", "o", t + timedelta(seconds=s)) for s in (-101, -100, -99, 0, 99, 100, 101)],
        "d string, order_id string, d_at timestamp")
    near = joins.orders_near_details(o, d, "id", "order_id", "at", "d_at", "100 seconds", "100 seconds")
    assert {r.d for r in near.collect()} == {"-100", "-99", "+0", "+99", "+100"}


# --- metrics ---------------------------------------------------------------------------------

def test_totals_of_one_day(spark):
    dau = spark.createDataFrame([("2024-01-01", "m", "09"), ("2024-01-02", "m", "10"), ("2024-01-02", "n", "10")],
                                "log_date string, mid string, log_hour string")
    orders = spark.createDataFrame([("2024-01-02", "10", 0.1), ("2024-01-02", "11", 0.2)],
                                   "create_date string, create_hour string, total_amount double")
    got = [(r.ord, r.id, r.value) for r in metrics.realtime_total(dau, orders, day="2024-01-02").orderBy("ord").collect()]
    assert got == [(0, "dau", 2.0), (1, "new_mid", 1.0), (2, "order_amount", 0.3)]
    none = [(r.id, r.value) for r in metrics.realtime_total(dau, orders, day="2024-01-09").orderBy("ord").collect()]
    assert none == [("dau", 0.0), ("new_mid", 0.0), ("order_amount", None)]
    assert metrics.gmv_of_day(orders, "2024-01-09").first().sum_amount is None


def test_hours(spark):
    dau = spark.createDataFrame([("2024-01-01", "09", "a"), ("2024-01-02", "09", "b"), ("2024-01-02", "23", "c")],
                                "log_date string, log_hour string, mid string")
    hours = metrics.dau_by_hour(dau)
    two = metrics.day_over_day(hours, "log_date", "log_hour", "ct", only="2024-01-02")
    assert rows(two) == [("2024-01-02", "09", 1, 1), ("2024-01-02", "23", None, 1)]
    dense = metrics.densify_hours(hours, "log_date", "log_hour", "ct").where("log_date = '2024-01-02'").orderBy("log_hour")
    assert [r.ct for r in dense.collect()] == [0] * 9 + [1] + [0] * 13 + [1]
    m = metrics.hour_map(hours, "log_date", "log_hour", "ct").where("log_date = '2024-01-02'").first().hours
    assert m == {"09": 1, "23": 1}
    with pytest.raises(KeyError):
        metrics.select_metric("other", dau, dau)


# --- alerts ----------------------------------------------------------------------------------

EVENTS = "event_id int, mid string, uid string, evid string, itemid string, event_time timestamp"
T0 = datetime(2024, 1, 1)


def brute_force(data, rule):
    """Every window of every device by looping."""
    width, step = alerts.seconds_of(rule.window), alerts.seconds_of(rule.slide)
    groups = defaultdict(list)
    for row in data:
        sec = (row[5] - T0).total_seconds()
        first = int((sec - width) // step + 1) * step
        for start in range(first, int(sec // step) * step + 1, step):
            groups[row[1], start].append(row)
    out = {}
    for (mid, start), members in groups.items():
        uids = {m[2] for m in members if m[3] in rule.coupon and m[2] is not None}
        if len(uids) >= rule.min_uids and not any(m[3] in rule.browse for m in members):
            out[mid, T0 + timedelta(seconds=start)] = members
    return out


def random_events(n, seed):
    r = Random(seed)
    return [
        (i, r.choice(["m1", "m1", "m1", "m2", "m3"]), r.choice(["u1", "u2", "u3", "u4", None]),
         r.choice(["coupon"] * 8 + ["addCart", "clickItem"]), str(r.randrange(5)),
         T0 + timedelta(milliseconds=r.randrange(3_600_000)))
        for i in range(n)
    ]


@pytest.mark.parametrize("slide", ["5 minutes", "1 minute", "5 seconds"])
def test_alerts_equal_brute_force(spark, slide):
    rule, data = AlertRule(slide=slide), random_events(150, 7)
    got = {(r.mid, r.window_start): (r.n_uids, r.n_events)
           for r in alerts.coupon_alerts(spark.createDataFrame(data, EVENTS), rule).collect()}
    want = brute_force(data, rule)
    assert got.keys() == want.keys() and len(want) > 0
    for key, members in want.items():
        uids = {m[2] for m in members if m[3] == "coupon" and m[2] is not None}
        assert got[key] == (len(uids), len(members))


@pytest.mark.parametrize("slide", ["1 minute", "5 minutes"])
def test_members_hold_every_event(spark, slide):
    rule, data = AlertRule(slide=slide), random_events(150, 8)
    events = spark.createDataFrame(data, EVENTS)
    found = alerts.alert_members(alerts.coupon_alerts(events, rule), events, rule).collect()
    merged = defaultdict(lambda: (set(), set(), []))
    for m in found:
        uids, items, evs = merged[m.mid, m.window_start]
        if m.kind == "event":
            evs.append((m.event_time, m.event_id, m.value, m.n))
        else:
            assert m.n == 1 and m.event_time is None
            (uids if m.kind == "uid" else items).add(m.value)
    want = brute_force(data, rule)
    assert merged.keys() == want.keys()
    for key, members in want.items():
        uids, items, evs = merged[key]
        coupons = [m for m in members if m[3] == "coupon"]
        assert uids == {m[2] for m in coupons if m[2] is not None} and items == {m[4] for m in coupons}
        assert [e[2:] for e in sorted(evs)] == [(m[3], 1) for m in sorted(members, key=lambda m: (m[5], m[0]))]


def test_large_group_has_the_same_shape(spark):
    n = 50_000
    events = spark.range(n).selectExpr(
        "id as event_id", "'m' as mid", "concat('u', id % 4) as uid", "'coupon' as evid", "string(id % 7) as itemid",
        "timestamp_seconds(1704067200 + id % 200) as event_time")
    rule = AlertRule(slide="5 minutes")
    members = alerts.alert_members(alerts.coupon_alerts(events, rule), events, rule)
    assert {(r.kind, r["count"]) for r in members.groupBy("kind").count().collect()} == {("event", n), ("uid", 4), ("item", 7)}
    assert members.select("doc_id").distinct().count() == 1


@pytest.mark.parametrize("accounts, browse, fires", [
    (["a", "b"], False, False), (["a", "b", "c"], False, True), (["a", "a", "a"], False, False),
    (["a", "b", "c", "d"], True, False), (["a", "b", None], False, False),
])
def test_rule_cases(spark, accounts, browse, fires):
    data = [(i, "m", u, "coupon", "1", T0 + timedelta(seconds=i)) for i, u in enumerate(accounts)]
    if browse:
        data.append((99, "m", "z", "clickItem", "1", T0 + timedelta(seconds=2)))
    rule = AlertRule(slide="5 minutes")
    assert (alerts.coupon_alerts(spark.createDataFrame(data, EVENTS), rule).count() > 0) == fires


def test_unknown_hours_and_days_without_rows(spark):
    hours = spark.createDataFrame([("2024-01-01", "03", 5), ("2024-01-01", None, 2)], "log_date string, log_hour string, ct bigint")
    assert metrics.hour_map(hours, "log_date", "log_hour", "ct").first().hours == {"03": 5}
    dense = metrics.densify_hours(hours, "log_date", "log_hour", "ct", ["2024-01-01", "2024-01-02"]).collect()
    assert len(dense) == 48 and sum(r.ct for r in dense) == 5


def test_unknown_order_values_come_last(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", 5, 2), ("b", None, 3)], "k string, ts int, v int")
    assert rows(dedup.first_per_key(df, ["k"], ["ts"])) == [("a", 5, 2), ("b", None, 3)]
    assert rows(dedup.latest_by_key(df, ["k"], ["ts"])) == [("a", 5, 2), ("b", None, 3)]


def test_one_alert_per_minute(spark):
    df = spark.createDataFrame(
        [("m", T0 + timedelta(seconds=s), n) for s, n in ((1, 3), (59, 4), (61, 5))], "mid string, window_end timestamp, n_uids int")
    assert rows(alerts.one_per_minute(df).select("doc_id", "n_uids")) == [
        ("m-2024-01-01 00:00", 4), ("m-2024-01-01 00:01", 5)]


def test_slide_must_divide_window():
    with pytest.raises(ValueError):
        alerts.windows_per_event(AlertRule(slide="2 minutes"))


# --- search ----------------------------------------------------------------------------------

@pytest.fixture()
def students(spark):
    return spark.createDataFrame(
        [(1001, "0620", "true", 17, "球"), (1003, "0621", "false", 10000, "乒乓球篮球击剑"),
         (1006, "0621", "true", 99999, "橄榄球降维打击"), (1007, "0621", "true", 5, "击剑")],
        "stu_id int, class_id string, gender string, age int, favo2 string")


def test_sample_search(students):
    request = search.Request(terms={"class_id": "0621"}, match=("favo2", "球"), match_all=False)
    found = search.hits(students, request)
    assert search.hit_total(found).first().total == 2
    assert [r.stu_id for r in search.page(found, [F.col("stu_id")], 1, 2).collect()] == [1003, 1006]
    assert rows(search.top_terms(found, "gender")) == [("false", 1), ("true", 1)]
    assert search.max_metric(found, "age", "maxAge").first().maxAge == 99999


def test_facets_in_one_pass(spark):
    df = spark.createDataFrame([("M", 20), ("F", 20), (None, 31), ("F", None)], "user_gender string, user_age int")
    assert rows(search.facets(df, ["user_gender", "user_age"])) == rows(spark.createDataFrame(
        [("total", None, 4), ("user_gender", "M", 1), ("user_gender", "F", 2), ("user_age", "20", 2), ("user_age", "31", 1)],
        "f string, v string, n bigint"))


def test_ratios(spark):
    df = spark.createDataFrame([("M", 19), ("F", 20), (None, 29), ("F", 30), ("F", None)], "user_gender string, user_age int")
    assert tuple(search.gender_ratio(df).first()) == (5, 20.0, 80.0, 1)
    assert tuple(search.age_ratio(df).first()) == (5, 4, 25.0, 50.0, 25.0)
    none = df.where("user_age > 99")
    assert tuple(search.gender_ratio(none).first()) == (0, None, None, 0)


def test_paging(spark):
    df = spark.range(25).select(F.col("id"), (F.col("id") % 3).alias("g"))
    order = [F.col("id")]
    assert [r.id for r in search.page(df, order, 3, 10).collect()] == [20, 21, 22, 23, 24]
    assert search.page(df, order, 4, 10).count() == 0
    assert [r.id for r in search.page_at_row(df, order, 7, 10).collect()] == list(range(7, 17))
    assert [r.id for r in search.page(spark.range(30_000), order, 1502, 10).collect()] == list(range(15_010, 15_020))
    with pytest.raises(ValueError):
        search.page(df, order, 0, 10)
    last, seen = None, []
    while page := search.page_after(df, ["g", "id"], last, 7).collect():
        seen += [(r.g, r.id) for r in page]
        last = seen[-1]
    assert seen == sorted((i % 3, i) for i in range(25))


def test_paging_past_null_keys(spark):
    data = [(None, 1), (None, 2), (1, None), (1, 3), (2, 4)]
    df = spark.createDataFrame(data, "g int, id int")
    last, seen = None, []
    while page := search.page_after(df, ["g", "id"], last, 1).collect():
        seen += [tuple(r) for r in page]
        last = seen[-1]
    assert seen == data


def test_one_search_honours_every_part_of_the_request(students):
    request = search.Request(terms={"class_id": "0621"}, sort=("-age",), page=2, size=1)
    reply = search.search(students, request, ("gender",), "age")
    assert [r.stu_id for r in reply.page.collect()] == [1003]
    assert reply.total.first().total == 3 and reply.maximum.first().maximum == 99999
    assert rows(reply.facets) == [("gender", "false", 1), ("gender", "true", 2), ("total", None, 3)]


def test_shares_of_no_hits_are_null(spark):
    none = spark.createDataFrame([], "user_gender string, user_age int, id int")
    document = json.loads(search.stat_document(none, [F.col("id")], 1, 5).first().document)
    assert document["total"] == 0 and document["detail"] == []
    assert all("value" not in o for chart in document["stat"] for o in chart["options"])


# --- upsert ----------------------------------------------------------------------------------

def test_upsert(spark):
    schema = "id string, v int, ts int"
    old = spark.createDataFrame([("a", 1, 1), ("b", 2, 1)], schema)
    new = spark.createDataFrame([("b", 3, 2), ("b", 4, 3), ("c", 5, 2)], schema)
    assert rows(upsert(old, new, ["id"], ["ts"])) == [("a", 1, 1), ("b", 4, 3), ("c", 5, 2)]
    assert rows(upsert(old, new.limit(0), ["id"], ["ts"])) == rows(old)
    auto = with_auto_id(spark.createDataFrame([(None, 1), ("x", 2)], "id string, v int"), "id", ["v"]).collect()
    assert len(auto[0].id) == 64 and auto[1].id == "x"


def test_keyed_table(spark, tmp_path):
    schema = spark.createDataFrame([], "dt string, id string, v int, ts int").schema
    t = KeyedTable(str(tmp_path / "t"), ("id",), "dt", ("ts",))
    make = lambda *data: spark.createDataFrame(list(data), schema)
    assert t.read(spark, schema).count() == 0
    t.write_batch(make(("d1", "a", 1, 1), ("d1", "a", 2, 2), ("d2", "b", 3, 1)), 0)
    t.write_batch(make(("d1", "a", 9, 0)), 1)
    t.write_batch(make(("d1", "a", 9, 0)), 1)
    t.write_batch(make(), 2)
    assert rows(t.read(spark, schema)) == [("d1", "a", 9, 0), ("d2", "b", 3, 1)]
    assert rows(t.read(spark, schema, ["d2"])) == [("d2", "b", 3, 1)]
    later = t.of_writer("second")
    later.write_batch(make(("d1", "a", 10, 0)), 0)
    assert rows(t.read(spark, schema, ["d1"])) == [("d1", "a", 10, 0)]
    t.write_batch(make(("d3", "c", 0, 0)), 3)
    replace(t, writer="base", epoch=-1).write_batch(make(("d1", "a", 0, 0), ("d1", "z", 5, 5)), 0)
    assert rows(t.read(spark, schema, ["d1", "d3"])) == [("d1", "a", 10, 0), ("d1", "z", 5, 5), ("d3", "c", 0, 0)]
    target = str(tmp_path / "published")
    t.publish(spark, schema, target)
    t.publish(spark, schema, target, ["d1"])
    assert rows(spark.read.parquet(target).select("dt", "id", "v", "ts")) == [
        ("d1", "a", 10, 0), ("d1", "z", 5, 5), ("d2", "b", 3, 1), ("d3", "c", 0, 0)]


# --- generated rows --------------------------------------------------------------------------

def test_generated_logs(spark):
    n = 20_000
    starts = fixtures.startup_rows(spark, n).cache()
    assert rows(starts.limit(50)) == rows(fixtures.startup_rows(spark, n).limit(50))
    share = starts.agg(F.avg((F.col("os") == "ios").cast("int"))).first()[0]
    assert abs(share - 0.3) < 0.02
    assert starts.where((F.col("os") == "ios") != (F.col("ch") == "appstore")).count() == 0
    assert starts.select("mid").distinct().count() == 200 and starts.select("uid").distinct().count() == 500
    events = fixtures.event_rows(starts)
    assert abs(events.count() / n - 4) < 0.2
    coupon = events.agg(F.avg((F.col("evid") == "coupon").cast("int"))).first()[0]
    assert abs(coupon - 45 / 110) < 0.02
    low, high = events.agg(F.min("itemid"), F.max("itemid")).first()
    assert (low, high) == (0, 49)
    times = [r.ts for r in starts.orderBy("id").select("ts").collect()]
    assert times == sorted(times)


def test_full_outer_join_holds_no_table_of_line_keys(spark, monkeypatch):
    """Only heavy keys are counted down to one row each; null keys and orders that come twice stay."""
    lines = spark.createDataFrame([(i, None if i % 50 == 0 else 1 if i % 3 == 0 else i) for i in range(400)], "id int, order_id int")
    orders = spark.createDataFrame([(k, f"u{k}") for k in [None, 1, 1, 2, 5, 1000, 1000]], "key int, user_id string")
    want = orders.join(lines, F.col("key") == F.col("order_id"), "full_outer").select("key", "user_id", "id", "order_id")
    for heavy in ({}, {spark.range(1).select(F.xxhash64(F.lit(1))).first()[0]: 4}):
        monkeypatch.setattr(joins, "heavy_keys", lambda *a: heavy)
        mine = joins.orders_full_outer_details(orders, lines, "key", "order_id")
        plan = mine._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Aggregate") == len(heavy)
        got = mine.select("key", "user_id", "id", "order_id")
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
