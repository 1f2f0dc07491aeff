"""Distinct devices over ranges of days, from hourly bitmaps."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillstream.operators import bitmaps
from tillstream.plans.catalog import query
from tillstream.sources.files import table


def _hourly(spark, folder):
    visits = table(spark, folder, "events").select(
        F.col("user_id").cast("string").alias("mid"), F.date_format("ts", "yyyy-MM-dd").alias("log_date"),
        F.date_format("ts", "HH").alias("log_hour"))
    return bitmaps.device_bitmaps(visits, bitmaps.number_devices(visits), ["log_date", "log_hour"])


@query("""
select strftime(ts, '%Y-%m-%d') as log_date, strftime(ts, '%H') as log_hour, count(distinct user_id) as devices
from events where user_id is not null group by 1, 2
""")
def hourly_distinct(spark, folder):
    return bitmaps.distinct_devices(_hourly(spark, folder), ["log_date", "log_hour"])


@query("""
with days as (select distinct cast(ts as date) as day from events where user_id is not null)
select strftime(day, '%Y-%m-%d') as log_date, count(distinct user_id) as devices
from days join events on cast(ts as date) between day - 6 and day group by day
""")
def weekly_distinct(spark, folder):
    # Hours become days, days become weeks; the events are read for the hours alone.
    return bitmaps.trailing_distinct(_hourly(spark, folder), 7)
