"""Deduplication and dashboard numbers over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillstream.functions import hour_of
from tillstream.operators import dedup, metrics
from tillstream.plans.catalog import query
from tillstream.sources import domain
from tillstream.sources.files import table

FIRST_SQL = """
select *, strftime(ts, '%Y-%m-%d') as log_date, strftime(ts, '%H') as log_hour from (
  select *, row_number() over (partition by cast(ts as date), user_id order by ts, event_id) as rn from events
) where rn = 1
"""
SALES_SQL = """
select strftime(ts, '%Y-%m-%d') as create_date, strftime(ts, '%H') as create_hour,
       cast(sum(cast(value as decimal(18, 2))) as double) as sum_amount
from events where event_type = 'purchase' group by 1, 2
"""
DAU_HOURS_SQL = f"select log_date, log_hour, count(*) as ct from ({FIRST_SQL}) group by 1, 2"


def visits(spark, folder):
    """First visit of every device and day, as small as the metrics need it."""
    events = table(spark, folder, "events").withColumnRenamed("user_id", "mid")
    first = dedup.first_visit_times(events, "ts", F.to_date("ts"))
    return first.select(
        F.col("log_date").cast("string").alias("log_date"), "mid", hour_of(F.col("first_ts")).alias("log_hour")
    )


def sales(spark, folder):
    return domain.hourly_sales(table(spark, folder, "events"))


@query(f"select log_date, log_hour, event_id, user_id as mid, event_type as type from ({FIRST_SQL})")
def dedup_daily_device(spark, folder):
    logs = domain.startup_logs(table(spark, folder, "events"))
    return dedup.daily_first(logs, ["ts", "event_id"]).select(
        "log_date", "log_hour", "event_id", "mid", "type"
    )


@query("""
select user_id as mid, event_id, event_type from (
  select *, row_number() over (partition by user_id order by ts, event_id) as rn from events) where rn = 1
""")
def first_per_key(spark, folder):
    events = table(spark, folder, "events").withColumnRenamed("user_id", "mid")
    return dedup.first_per_key(events, ["mid"], ["ts", "event_id"]).select("mid", "event_id", "event_type")


@query("""
select l_partkey, l_orderkey, l_linenumber, l_suppkey from (
  select *, row_number() over (
    partition by l_partkey order by l_shipdate, l_orderkey, l_linenumber, l_suppkey, l_extendedprice) as rn
  from lineitem) where rn = 1
""")
def rank_first(spark, folder):
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice"]
    return dedup.first_per_key(table(spark, folder, "lineitem"), ["l_partkey"], order).select(
        "l_partkey", "l_orderkey", "l_linenumber", "l_suppkey"
    )


@query("""
select user_id, event_id, event_type, value from (
  select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn from events) where rn = 1
""")
def latest_by_key(spark, folder):
    return dedup.latest_by_key(table(spark, folder, "events"), ["user_id"], ["ts", "event_id"]).select(
        "user_id", "event_id", "event_type", "value"
    )


@query("""
select event_id, user_id as mid, strftime(ts, '%Y-%m-%d') as log_date from events e
where not exists (select 1 from events s where s.event_type = 'signup' and s.user_id = e.user_id
                  and cast(s.ts as date) = cast(e.ts as date))
""")
def seen_anti(spark, folder):
    logs = domain.startup_logs(table(spark, folder, "events"))
    seen = logs.where(F.col("type") == "signup")
    return dedup.not_seen(logs.select("event_id", "mid", "log_date"), seen, ["log_date", "mid"])


@query("select c_custkey, c_name from customer where c_custkey in (select o_custkey from orders where o_orderstatus = 'P')")
def exists_semi(spark, folder):
    pending = table(spark, folder, "orders").where(F.col("o_orderstatus") == "P")
    pending = pending.select(F.col("o_custkey").alias("c_custkey"))
    return dedup.is_seen(table(spark, folder, "customer").select("c_custkey", "c_name"), pending, ["c_custkey"])


@query("select o_orderkey, o_custkey from orders where o_custkey not in (select c_custkey from customer where c_acctbal < 0)")
def blacklist_anti(spark, folder):
    black = table(spark, folder, "customer").where(F.col("c_acctbal") < 0)
    black = black.select(F.col("c_custkey").alias("o_custkey"))
    return dedup.not_seen(table(spark, folder, "orders").select("o_orderkey", "o_custkey"), black, ["o_custkey"])


@query(f"select log_date, count(*) as ct from ({FIRST_SQL}) group by 1")
def dau_total(spark, folder):
    return metrics.dau_total(visits(spark, folder))


@query(DAU_HOURS_SQL)
def dau_by_hour(spark, folder):
    return metrics.dau_by_hour(visits(spark, folder))


@query("""
select strftime(o_orderdate, '%Y-%m-%d') as create_date,
       cast(sum(cast(o_totalprice as decimal(18, 2))) as double) as sum_amount
from orders group by 1
""")
def gmv_total(spark, folder):
    # Grouped by the day itself; only the few result rows are turned into text.
    orders = table(spark, folder, "orders").select(
        F.to_date("o_orderdate").alias("create_date"), F.col("o_totalprice").alias("total_amount")
    )
    return metrics.gmv_total(orders).withColumn("create_date", F.col("create_date").cast("string"))


@query(SALES_SQL)
def gmv_by_hour(spark, folder):
    return metrics.gmv_by_hour(sales(spark, folder))


@query(f"""
select log_date, string_agg(log_hour || '=' || ct, ',' order by log_hour) as hours from ({DAU_HOURS_SQL}) group by 1
""")
def rows_to_map(spark, folder):
    hours = metrics.hour_map(metrics.dau_by_hour(visits(spark, folder)), "log_date", "log_hour", "ct")
    text = F.transform(F.map_entries("hours"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))
    return hours.select("log_date", F.array_join(F.array_sort(text), ",").alias("hours"))


@query(f"""
select log_date, 0 as ord, 'dau' as id, '{metrics.TOTAL_NAMES['dau']}' as name, cast(count(*) as double) as value from ({FIRST_SQL}) group by 1
union all
select first_day, 1, 'new_mid', '{metrics.TOTAL_NAMES['new_mid']}', cast(count(*) as double) from (
  select user_id, strftime(min(ts), '%Y-%m-%d') as first_day from events group by 1) group by 1
union all
select create_date, 2, 'order_amount', '{metrics.TOTAL_NAMES['order_amount']}', cast(sum(cast(sum_amount as decimal(18, 2))) as double)
from ({SALES_SQL}) group by 1
""")
def realtime_total(spark, folder):
    return metrics.realtime_total(visits(spark, folder), sales(spark, folder))


@query("""
select first_day as log_date, count(*) as ct from (
  select user_id, strftime(min(ts), '%Y-%m-%d') as first_day from events group by 1) group by 1
""")
def new_devices(spark, folder):
    events = table(spark, folder, "events").select(F.col("user_id").alias("mid"), F.to_date("ts").alias("log_date"))
    return metrics.new_devices(events).withColumn("log_date", F.col("log_date").cast("string"))


def _day_over_day_sql(hours: str, day: str, hour: str, value: str) -> str:
    return f"""
with h as ({hours})
select coalesce(t.{day}, strftime(cast(y.{day} as date) + 1, '%Y-%m-%d')) as day,
       coalesce(t.{hour}, y.{hour}) as hour, y.{value} as yesterday, t.{value} as today
from h t full outer join h y
  on cast(t.{day} as date) = cast(y.{day} as date) + 1 and t.{hour} = y.{hour}
"""


@query(_day_over_day_sql(DAU_HOURS_SQL, "log_date", "log_hour", "ct"))
def day_over_day(spark, folder):
    return metrics.day_over_day(metrics.dau_by_hour(visits(spark, folder)), "log_date", "log_hour", "ct")


@query(f"""
select day, coalesce(string_agg(hour || '=' || yesterday, ',' order by hour), '') as yesterday,
       coalesce(string_agg(hour || '=' || today, ',' order by hour), '') as today
from ({_day_over_day_sql(DAU_HOURS_SQL, "log_date", "log_hour", "ct")}) group by day
""")
def realtime_hours_reply(spark, folder):
    reply = metrics.hours_reply(metrics.dau_by_hour(visits(spark, folder)), "log_date", "log_hour", "ct")

    def text(side):
        entries = F.transform(F.map_entries(side), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))
        return F.array_join(F.array_sort(entries), ",").alias(side)

    return reply.select("day", text("yesterday"), text("today"))


@query(_day_over_day_sql(SALES_SQL, "create_date", "create_hour", "sum_amount"))
def day_over_day_amount(spark, folder):
    hours, day, hour, value = metrics.select_metric("order_amount", visits(spark, folder), sales(spark, folder))
    return metrics.day_over_day(hours, day, hour, value)


@query(f"""
with h as ({DAU_HOURS_SQL})
select d.log_date, s.log_hour, coalesce(h.ct, 0) as ct
from (select distinct log_date from h) d
cross join (select lpad(cast(range as varchar), 2, '0') as log_hour from range(24)) s
left join h on h.log_date = d.log_date and h.log_hour = s.log_hour
""")
def hours_densify(spark, folder):
    return metrics.densify_hours(metrics.dau_by_hour(visits(spark, folder)), "log_date", "log_hour", "ct")
