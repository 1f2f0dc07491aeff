"""Orders, lines and users over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillstream.operators import joins
from tillstream.plans.catalog import query
from tillstream.plans.ingest_queries import DETAIL_ID, USERS_SQL
from tillstream.sources import domain
from tillstream.sources.files import table
from tillstream.session import scratch_path
from tillstream.streaming.sinks import KeyedTable

SALES_DOC_SQL = f"""
select {DETAIL_ID} as order_detail_id, o_orderkey as order_id, o_orderstatus as order_status,
       strftime(o_orderdate, '%Y-%m-%d') as dt, o_custkey as user_id, l_partkey as sku_id, p_name as sku_name,
       l_extendedprice as sku_price, c_mktsegment as user_gender, c_nationkey as user_level, age as user_age
from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey
left join ({USERS_SQL}) on o_custkey = c_custkey
"""


@query(SALES_DOC_SQL)
def sale_detail(spark, folder):
    return domain.sale_documents(spark, folder).drop("create_time")


@query("""
select o_orderkey, o_custkey, l_orderkey, l_linenumber, l_partkey, l_suppkey
from orders full outer join lineitem on o_orderkey = l_orderkey
""")
def order_detail_full_outer(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    details = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return joins.orders_full_outer_details(orders, details, "o_orderkey", "l_orderkey")


NEAR_SQL = """
select o_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice
from orders join lineitem on l_orderkey = o_orderkey
where l_shipdate between o_orderdate and o_orderdate + interval 30 day
"""


@query(NEAR_SQL)
def order_detail_stream_join(spark, folder):
    near = joins.orders_near_details(
        table(spark, folder, "orders"), table(spark, folder, "lineitem"), "o_orderkey", "l_orderkey",
        "o_orderdate", "l_shipdate", "0 days", "30 days",
    )
    return near.select("o_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


@query("select o_orderkey, o_custkey from orders where o_orderkey not in (select l_orderkey from lineitem)")
def unmatched_side(spark, folder):
    return joins.unmatched_orders(
        table(spark, folder, "orders"), table(spark, folder, "lineitem"), "o_orderkey", "l_orderkey"
    ).select("o_orderkey", "o_custkey")


@query(f"""
select o_orderkey, o_custkey, c_mktsegment as user_gender, user_level, age as user_age from orders left join (
  select *, case when c_mktsegment = 'MACHINERY' then c_nationkey + 100 else c_nationkey end as user_level from ({USERS_SQL})
) on o_custkey = c_custkey
""")
def user_enrich(spark, folder):
    # Recently changed users come from the cache with their new level, all others from the base table.
    users = domain.user_infos(table(spark, folder, "customer"))
    cache = users.where(F.col("gender") == "MACHINERY").withColumn("user_level", F.col("user_level") + 100)
    orders = table(spark, folder, "orders").select("o_orderkey", F.col("o_custkey").alias("user_id"))
    out = joins.enrich_with_users(orders, joins.two_level_users(cache, users), F.lit(domain.AS_OF))
    return out.withColumnRenamed("user_id", "o_custkey")


@query("""
with d as (select cast(user_id as varchar) as doc_id, event_id, event_type, value, ts,
                  case when event_type = 'purchase' then 1 else 0 end as batch from events)
select doc_id, event_id, event_type, value from (
  select *, row_number() over (partition by doc_id order by batch desc, ts desc, event_id desc) as rn from d) where rn = 1
""")
def doc_upsert_bulk(spark, folder):
    # Two batches through the table that the jobs use: purchases come last, several per document.
    docs = table(spark, folder, "events").select(
        F.col("user_id").cast("string").alias("doc_id"), "event_id", "event_type", "value", "ts", F.lit("all").alias("dt")
    )
    stored = KeyedTable(scratch_path(spark, "documents"), ("doc_id",), "dt", ("ts", "event_id"))
    bought = F.col("event_type") == "purchase"
    for batch_id, rows in enumerate((docs.where(~bought), docs.where(bought), docs.where(bought))):
        stored.write_batch(rows, min(batch_id, 1))
    return stored.read(spark, docs.schema).drop("ts", "dt")
