"""Decoding, routing and scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from tillstream.config import DETAIL_TABLE, ORDER_TABLE, USER_TABLE
from tillstream.functions import (
    age_band, age_years, mask_phone, minute_doc_id, pct, prev_day, to_number, with_create_parts, with_log_parts,
)
from tillstream.operators import ingest, metrics
from tillstream.plans.catalog import query
from tillstream.sources import domain
from tillstream.sources.files import table


@query("select event_id, try_cast(json_extract_string(props, '$.k') as bigint) as k from events")
def json_decode(spark, folder):
    schema = T.StructType([T.StructField("k", T.StringType())])
    decoded = ingest.decode(table(spark, folder, "events"), schema, {"k": "bigint"}, "props", ("event_id",))
    return ingest.good_rows(decoded)


LINES_SQL = """
select event_id, event_type, json_extract_string(props, '$.k') as mid, case event_type
    when 'error' then 'broken ' || event_id
    when 'signup' then '{"mid":"' || json_extract_string(props, '$.k') || '","uid":"' || event_id || '"}'
    else '{"mid":"' || json_extract_string(props, '$.k') || '","uid":"' || event_id || '","ts":' || epoch_ms(ts) || '}' end as value
from events
"""


def _lines(spark, folder) -> DataFrame:
    """Events as raw log lines, of which some are no JSON and some have no time."""
    mid, uid = F.get_json_object("props", "$.k"), F.col("event_id").cast("string")
    kind, ms = F.col("event_type"), F.unix_millis(F.col("ts").cast("timestamp")).cast("string")
    head = F.concat(F.lit('{"mid":"'), mid, F.lit('","uid":"'), uid)
    value = F.when(kind == "error", F.concat(F.lit("broken "), uid)).when(
        kind == "signup", F.concat(head, F.lit('"}'))).otherwise(F.concat(head, F.lit('","ts":'), ms, F.lit("}")))
    return table(spark, folder, "events").select("event_id", value.alias("value"))


@query(f"""
select 'event' as kind, case event_type when 'error' then 'not readable' else 'without ts' end as reason, value
from ({LINES_SQL}) where event_type in ('error', 'signup')
""")
def json_quarantine(spark, folder):
    return ingest.rejected(_lines(spark, folder), "event")


@query(f"""
select event_id, case when event_type <> 'error' then '1704067200000' end as ts,
       case when event_type <> 'error' then mid end as mid, case when event_type = 'error' then value end as unchanged
from ({LINES_SQL})
""")
def stamp_line(spark, folder):
    stamped = ingest.stamp_line(_lines(spark, folder), F.lit(1704067200000))
    ts = F.get_json_object("value", "$.ts")
    return stamped.select(
        "event_id", ts.alias("ts"), F.get_json_object("value", "$.mid").alias("mid"), F.when(ts.isNull(), F.col("value")).alias("unchanged"))


@query("""
select o_orderkey, to_json({'id': o_orderkey, 'user_id': o_custkey, 'order_status': o_orderstatus})::varchar as value
from orders
""")
def json_encode(spark, folder):
    rows = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("user_id"),
        F.col("o_orderstatus").alias("order_status"),
    )
    return ingest.encode(rows, keep=("id",)).withColumnRenamed("id", "o_orderkey")


@query("""
select event_id, case when event_type = 'signup' then 'TOPIC_STARTUP' else 'TOPIC_EVENT' end as topic from events
""")
def route_by_type(spark, folder):
    kind = F.when(F.col("event_type") == "signup", F.lit("startup"))
    return ingest.route_by_type(table(spark, folder, "events").select("event_id", kind.alias("type"))).drop("type")


@query("select event_id, strftime(ts, '%Y-%m-%d') as log_date, strftime(ts, '%H') as log_hour from events")
def log_date_hour(spark, folder):
    logs = table(spark, folder, "events").select(
        "event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("ts")
    )
    return with_log_parts(logs).select("event_id", "log_date", "log_hour")


@query("select event_id, strftime(ts, '%Y-%m-%d') as create_date, strftime(ts, '%H') as create_hour from events")
def order_date_hour(spark, folder):
    logs = table(spark, folder, "events").select("event_id", F.col("ts").cast("string").alias("create_time"))
    return with_create_parts(logs).drop("create_time")


@query("select c_custkey, substr(c_name, 1, 4) || '*******' as masked from customer")
def mask_phone_number(spark, folder):
    return table(spark, folder, "customer").select("c_custkey", mask_phone(F.col("c_name")).alias("masked"))


def change_records(spark, folder) -> DataFrame:
    """Orders, lines and customers as change records; a column of each stands for the kind of change."""

    def records(name: str, source: DataFrame, op, **after):
        pairs = [x for k, v in after.items() for x in (F.lit(k), v.cast("string"))]
        return source.select(F.lit(name).alias("table"), op.alias("op"), F.create_map(*pairs).alias("after"))

    status, flag, segment = F.col("o_orderstatus"), F.col("l_returnflag"), F.col("c_mktsegment")
    return (
        records(
            ORDER_TABLE, table(spark, folder, "orders"),
            F.when(status == "O", "INSERT").when(status == "F", "UPDATE").otherwise("DELETE"),
            id=F.col("o_orderkey"), user_id=F.col("o_custkey"),
        ).unionByName(records(
            DETAIL_TABLE, table(spark, folder, "lineitem"),
            F.when(flag == "A", "INSERT").when(flag == "N", "UPDATE").otherwise("DELETE"),
            id=domain.detail_id(), order_id=F.col("l_orderkey"),
        )).unionByName(records(
            USER_TABLE, table(spark, folder, "customer"),
            F.when(segment == "BUILDING", "DELETE").when(segment == "MACHINERY", "UPDATE").otherwise("INSERT"),
            id=F.col("c_custkey"), login_name=F.col("c_name"),
        ))
    )


DETAIL_ID = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y-%m-%d'))"


@query(f"""
select 'TOPIC_ORDER_INFO' as topic, cast(o_orderkey as varchar) as id from orders where o_orderstatus = 'O'
union all
select 'TOPIC_ORDER_DETAIL', {DETAIL_ID} from lineitem where l_returnflag = 'A'
union all
select 'TOPIC_USER_INFO', cast(c_custkey as varchar) from customer where c_mktsegment <> 'BUILDING'
""")
def cdc_filter_route(spark, folder):
    return ingest.route_changes(change_records(spark, folder)).select("topic", F.col("after")["id"].alias("id"))


@query(f"""
select 'TOPIC_ORDER_INFO' as topic,
       to_json({{'id': o_orderkey::varchar, 'user_id': o_custkey::varchar}})::varchar as value
from orders where o_orderstatus = 'O'
union all
select 'TOPIC_ORDER_DETAIL', to_json({{'id': {DETAIL_ID}, 'order_id': l_orderkey::varchar}})::varchar
from lineitem where l_returnflag = 'A'
union all
select 'TOPIC_USER_INFO', to_json({{'id': c_custkey::varchar, 'login_name': c_name}})::varchar
from customer where c_mktsegment <> 'BUILDING'
""")
def cdc_after_image(spark, folder):
    return ingest.after_image(ingest.route_changes(change_records(spark, folder)))


@query("""
select o_orderkey, o_totalprice as amount, try_cast(o_orderpriority as double) as malformed from orders
""")
def string_to_double(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey",
        to_number(F.col("o_totalprice").cast("string")).alias("amount"),
        to_number(F.col("o_orderpriority")).alias("malformed"),
    )


@query("""
select o_orderkey, cast(date_diff('day', cast(o_orderdate as date), date '2010-01-01') // 365 as integer) as age
from orders
""")
def age_in_years(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey", age_years(F.col("o_orderdate"), F.lit(domain.AS_OF)).alias("age")
    )


USERS_SQL = """
select c_custkey, c_mktsegment, c_nationkey,
       cast(date_diff('day', date '1970-01-01' + cast((c_custkey * 7919) % 14000 as integer),
                      date '2010-01-01') // 365 as integer) as age
from customer
"""


@query(f"""
select c_custkey, age,
       case when age < 20 then 'under 20' when age >= 30 then '30 and over' else '20 to 30' end as band
from ({USERS_SQL})
""")
def age_bands(spark, folder):
    users = domain.user_infos(table(spark, folder, "customer"))
    aged = users.select(F.col("id").alias("c_custkey"), age_years(F.col("birthday"), F.lit(domain.AS_OF)).alias("age"))
    return aged.withColumn("band", age_band(F.col("age")))


@query("select o_orderkey, strftime(o_orderdate - interval 1 day, '%Y-%m-%d') as day_before from orders")
def previous_day(spark, folder):
    return table(spark, folder, "orders").select("o_orderkey", prev_day(F.col("o_orderdate")).alias("day_before"))


@query("select event_id, user_id || '-' || strftime(ts, '%Y-%m-%d %H:%M') as doc_id from events")
def minute_document_id(spark, folder):
    return table(spark, folder, "events").select(
        "event_id", minute_doc_id(F.col("user_id").cast("string"), F.col("ts")).alias("doc_id")
    )


@query("""
select event_type, n, (n * 2000 + total) // (total * 2) / 10.0 as share,
       ((total - n) * 2000 + total) // (total * 2) / 10.0 as rest
from (select event_type, count(*) as n, sum(count(*)) over ()::bigint as total from events group by 1)
""")
def percent_one_decimal(spark, folder):
    counts = table(spark, folder, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    # The total is summed from the few counts and put in as a single value.
    total = counts.agg(F.sum("n")).scalar()
    n, t = F.col("n"), F.col("total")
    return counts.withColumn("total", total).select(
        "event_type", "n", pct(n, t).alias("share"), pct(t - n, t).alias("rest")
    )


@query("select coalesce(max(o_custkey), 0) as newest, 0::bigint as none from orders")
def scalar_or_zero(spark, folder):
    orders = table(spark, folder, "orders")
    newest = metrics.scalar_or_zero(orders, F.max("o_custkey"), "newest")
    none = metrics.scalar_or_zero(orders.where(F.col("o_orderstatus") == "?"), F.max("o_custkey"), "none")
    return newest.withColumn("none", none.scalar())
