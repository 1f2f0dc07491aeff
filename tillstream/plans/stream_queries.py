"""Streaming forms run over the whole tables, each compared with the SQL of its batch form.

Each table is one file and so arrives in one batch. The watermark moves between batches only, so
no row is late and the streaming result is the whole result, with watermarks as a job would set
them; the batch without data that follows drops the state behind them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillstream.config import JoinBound, Settings
from tillstream.operators.alerts import fired, windows_of_slots
from tillstream.operators.skew import heavy_keys
from tillstream.plans.alert_queries import SLIDING_SQL, TEXT
from tillstream.plans.catalog import query
from tillstream.plans.metric_queries import FIRST_SQL
from tillstream.session import scratch_path, state_on_disk
from tillstream.sources import domain
from tillstream.sources.files import table, table_stream
from tillstream.streaming import jobs, stateful
from tillstream.streaming.sinks import KeyedTable, upper_names


def _zoned(df: DataFrame, *columns: str) -> DataFrame:
    """Watermarks need timestamps with a zone."""
    return df.withColumns({c: F.col(c).cast("timestamp") for c in columns})


def _upserted(spark: SparkSession, stream: DataFrame, table: KeyedTable, mode: str) -> DataFrame:
    """Run a stream through a keyed table until its input is used up, and read the result."""
    writer = (
        stream.writeStream.outputMode(mode).foreachBatch(table.write_batch)
        .option("checkpointLocation", f"{table.path}-checkpoint").trigger(availableNow=True)
    )
    writer.start().awaitTermination()
    return table.read(spark, stream.schema)


def _appended(spark: SparkSession, stream: DataFrame, name: str) -> DataFrame:
    path = scratch_path(spark, name)
    writer = (
        stream.writeStream.format("parquet").option("path", path)
        .option("checkpointLocation", f"{path}-checkpoint").trigger(availableNow=True)
    )
    with state_on_disk(spark):
        run = writer.start()
    run.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def _hot_orders(spark: SparkSession, folder: str) -> dict[int, int]:
    """Orders with so many lines that they need several tasks, told from the stored lines."""
    return heavy_keys(table(spark, folder, "lineitem").select("l_orderkey"), ["l_orderkey"])


def _logs(spark, folder):
    logs = domain.startup_logs(table_stream(spark, folder, "events"))
    return _zoned(logs.withColumnRenamed("ts", "event_time"), "event_time")


DAILY_SQL = f"select log_date, log_hour, event_id, user_id as mid, event_type as type from ({FIRST_SQL})"


@query(DAILY_SQL)
def stream_daily_first(spark, folder):
    first = stateful.daily_first_updates(_logs(spark, folder), ["event_time", "event_id"])
    table = KeyedTable(scratch_path(spark, "daily"), ("mid",), "log_date", ("event_time", "event_id"), earliest=True)
    return _upserted(spark, first, table, "update").drop("event_time")


@query("""
select o_orderkey, l_linenumber, l_partkey, l_suppkey
from orders join lineitem on l_orderkey = o_orderkey
where l_shipdate between o_orderdate - interval 30 day and o_orderdate + interval 30 day
""")
def stream_order_detail_join(spark, folder):
    orders = table_stream(spark, folder, "orders").select("o_orderkey", F.col("o_orderdate").alias("order_arrival"))
    details = table_stream(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        domain.detail_id().alias("order_detail_id"), F.col("l_shipdate").alias("detail_arrival"),
    )
    joined = stateful.orders_with_lines(
        _zoned(orders, "order_arrival"), _zoned(details, "detail_arrival"),
        JoinBound(seconds=30 * 86400, watermark="30 days", salts=4), "o_orderkey", "l_orderkey",
        heavy=_hot_orders(spark, folder),
    )
    columns = ["o_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return _appended(spark, joined.select(*columns), "joined")


@query("""
select o_orderkey, o_custkey from orders o
where o_orderdate + interval 30 day < least(
    (select max(o_orderdate) from orders), (select max(l_shipdate) from lineitem)) - interval 30 day
  and not exists (select 1 from lineitem where l_orderkey = o_orderkey
    and l_shipdate between o_orderdate - interval 30 day and o_orderdate + interval 30 day)
""")
def stream_unmatched_side(spark, folder):
    # Orders are given out once the watermark, here 30 days behind the slower stream, has passed their time.
    orders = table_stream(spark, folder, "orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").alias("order_arrival"))
    details = table_stream(spark, folder, "lineitem").select(
        "l_orderkey", domain.detail_id().alias("order_detail_id"), F.col("l_shipdate").alias("detail_arrival"))
    alone = stateful.unmatched_orders(
        _zoned(orders, "order_arrival"), _zoned(details, "detail_arrival"),
        JoinBound(seconds=30 * 86400, watermark="30 days", salts=4), "o_orderkey", "l_orderkey",
        heavy=_hot_orders(spark, folder))
    return _appended(spark, alone.select("o_orderkey", "o_custkey"), "unmatched")


@query("""
select log_date, count(*) as n from (select user_id, strftime(min(ts), '%Y-%m-%d') as log_date from events where user_id is not null group by user_id)
group by log_date
""")
def stream_new_devices(spark, folder):
    # Kept up to date batch by batch; the total of a day reads the folders of that day.
    root, settings = scratch_path(spark, "devices"), Settings()
    by_day, by_device = jobs.first_seen_table(root, settings), jobs.device_table(root, settings)
    write = jobs.first_seen_writer(root, settings, by_day.write_batch, by_device.write_batch)
    visits = _logs(spark, folder).select(F.col("mid").cast("string").alias("mid"), F.col("log_date").alias("logdate"))
    visits.writeStream.foreachBatch(write).option("checkpointLocation", f"{root}/checkpoint").trigger(
        availableNow=True).start().awaitTermination()
    kept = by_day.read(spark, jobs.FIRST_SEEN_TABLE).where("is_first")
    return kept.groupBy(F.col("dt").alias("log_date")).agg(F.count(F.lit(1)).alias("n"))


@query(f"""
select mid, {TEXT.format('window_start')} as window_start, n_uids, n_events from ({SLIDING_SQL})
where n_uids >= 3 and n_browse = 0
""")
def stream_sliding_alert(spark, folder):
    # Counts per slot are kept up to date in a table; windows that are still open count as well.
    rule = domain.SLIDING_RULE
    events = _zoned(domain.event_logs(table_stream(spark, folder, "events")), "event_time")
    slots = stateful.slot_counts(events, rule)
    day = F.to_date("slot_start").cast("string")
    table = KeyedTable(scratch_path(spark, "slots"), ("slot", "mid", "uid"), "dt")
    stored = _upserted(spark, slots.withColumn("dt", day), table, "update").drop("dt", "slot_start")
    found = fired(windows_of_slots(stored, rule, events.schema["event_time"].dataType), rule)
    return found.select("mid", F.substring(F.col("window_start").cast("string"), 1, 19).alias("window_start"), "n_uids", "n_events")


@query("""
select MID, LOG_DATE, EVENT_ID, TYPE, VALUE from (
  select user_id as MID, strftime(ts, '%Y-%m-%d') as LOG_DATE, event_id as EVENT_ID, event_type as TYPE,
         value as VALUE, row_number() over (partition by user_id, cast(ts as date) order by ts desc, event_id desc) as rn
  from events) where rn = 1
""")
def table_upsert(spark, folder):
    events = table_stream(spark, folder, "events")
    rows = events.select(
        F.col("user_id").alias("mid"), F.to_date("ts").cast("string").alias("log_date"),
        "event_id", F.col("event_type").alias("type"), "value", "ts",
    )
    table = KeyedTable(scratch_path(spark, "upsert"), ("mid",), "log_date", ("ts", "event_id"))
    return upper_names(_upserted(spark, rows, table, "append").drop("ts"))
