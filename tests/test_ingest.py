"""Decoding, quarantine, stamping, routing, change records."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tillstream import schemas
from tillstream.config import Topics
from tillstream.operators import ingest
from tillstream.sources import changelog, jdbc, kafka


def lines(spark, *values):
    return spark.createDataFrame([(v if isinstance(v, str) or v is None else json.dumps(v),) for v in values], "value string")


def test_decode_and_quarantine(spark):
    good = {"mid": "m1", "uid": 5, "ts": "1704067200000", "type": "startup"}
    df = lines(spark, good, {**good, "ts": "soon"}, "not json", None, {**good, "ts": 1704067200001})
    decoded = ingest.decode(df, schemas.STARTUP_LOG, schemas.STARTUP_CASTS).cache()
    rows = ingest.good_rows(decoded).orderBy("ts").collect()
    assert [(r.mid, r.uid, r.ts) for r in rows] == [("m1", "5", 1704067200000), ("m1", "5", 1704067200001)]
    bad = {r.value for r in ingest.quarantine(decoded).collect()}
    assert bad == {json.dumps({**good, "ts": "soon"}), "not json", ""}


def test_order_rows(spark):
    order = {"id": "1", "total_amount": "12.50", "create_time": "2024-03-05 09:05:59", "consignee_tel": "13812345678"}
    row = ingest.order_rows(lines(spark, order)).first()
    assert (str(row.total_amount), row.create_date, row.create_hour, row.consignee_tel) == (
        "12.50", "2024-03-05", "09", "1381*******")


def test_event_rows_accept_numbers_for_text(spark):
    row = ingest.event_rows(lines(spark, {"mid": "m", "pgid": 7, "itemid": 3, "ts": 1704067200000})).first()
    assert (row.pgid, row.itemid, row.log_date, row.log_hour) == ("7", "3", "2024-01-01", "00")


def test_encode_then_decode(spark):
    row = {"id": "1", "order_id": "2", "sku_name": 'a "b" 球', "sku_id": "3", "order_price": "9.99", "img_url": "u", "sku_num": "2"}
    again = ingest.encode(ingest.good_rows(ingest.decode(lines(spark, row), schemas.ORDER_DETAIL)))
    assert json.loads(again.first().value) == row


def test_stamp_line_overwrites_ts_and_keeps_bad_lines(spark):
    df = ingest.stamp_line(lines(spark, {"a": 1, "ts": 5}, "oops"), F.lit(99).cast("bigint"))
    a, b = [r.value for r in df.collect()]
    assert json.loads(a) == {"a": "1", "ts": "99"} and b == "oops"
    assert ingest.stamp(spark.range(1)).dtypes[-1] == ("ts", "bigint")


def test_route_by_type(spark):
    df = spark.createDataFrame([("startup",), ("event",), (None,), ("Startup",)], "type string")
    t = Topics(startup="S", event="E")
    assert [r.topic for r in ingest.route_by_type(df, t).collect()] == ["S", "E", "E", "E"]


def test_change_routing(spark):
    tables = ["order_info", "order_detail", "user_info", "other"]
    ops = ["INSERT", "UPDATE", "DELETE"]
    df = lines(spark, *[{"table": t, "op": o, "after": {"id": f"{t}{o}", "n": None}} for t in tables for o in ops], "junk")
    got = {(r.topic, json.loads(r.value)["id"]) for r in changelog.topic_records(df).collect()}
    t = Topics()
    assert got == {
        (t.order_info, "order_infoINSERT"), (t.order_detail, "order_detailINSERT"),
        (t.user_info, "user_infoINSERT"), (t.user_info, "user_infoUPDATE"),
    }


def test_empty_after_image(spark):
    df = lines(spark, {"table": "user_info", "op": "INSERT", "after": {}})
    assert [r.value for r in changelog.topic_records(df).collect()] == ["{}"]


def test_connector_options(spark):
    o = kafka.reader_options("h:1", "t", max_per_trigger=10)
    assert o["subscribe"] == "t" and o["startingOffsets"] == "latest" and o["maxOffsetsPerTrigger"] == "10"
    df = spark.createDataFrame([("x", "T", 1)], "value string, topic string, other int")
    assert kafka.records(df).columns == ["topic", "value"] and kafka.records(df, "Z").first().topic == "Z"
    raw = spark.createDataFrame([(bytearray(b"{}"),)], "value binary").withColumn("timestamp", F.current_timestamp())
    assert kafka.lines(raw).first().value == "{}"
    r = jdbc.read_options("u", "t", partition_column="id", lower=0, upper=10, partitions=4)
    with pytest.raises(ValueError):
        jdbc.read(None, "u", "t")
    assert r["numPartitions"] == "4" and jdbc.write_options("u", "t", batch_size=7)["batchsize"] == "7"
