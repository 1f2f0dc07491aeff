"""Dashboard numbers: totals, hourly series, day against day before.

Every function takes an optional day. With a day it filters first (the filter reaches the
scan and prunes day partitions); without one it answers for all days at once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tillstream.config import METRIC_DAU, METRIC_NEW_DEVICE, METRIC_ORDER_AMOUNT
from tillstream.functions import exact_sum, prev_day

HOURS = 24
# Titles of the totals.
TOTAL_NAMES = {METRIC_DAU: "新增日活", METRIC_NEW_DEVICE: "新增设备", METRIC_ORDER_AMOUNT: "新增交易额"}


def _of_day(df: DataFrame, column: str, day: str | None) -> DataFrame:
    return df if day is None else df.where(F.col(column) == day)


def dau_total(dau: DataFrame, day: str | None = None) -> DataFrame:
    """Rows of the deduplicated table per day."""
    return _of_day(dau, "log_date", day).groupBy("log_date").agg(F.count(F.lit(1)).alias("ct"))


def dau_by_hour(dau: DataFrame, day: str | None = None) -> DataFrame:
    """Devices by the hour of their first visit."""
    return (
        _of_day(dau, "log_date", day)
        .groupBy("log_date", "log_hour").agg(F.count(F.lit(1)).alias("ct"))
    )


def gmv_total(orders: DataFrame, day: str | None = None) -> DataFrame:
    """Sum of order amounts per day."""
    return (
        _of_day(orders, "create_date", day)
        .groupBy("create_date").agg(exact_sum(F.col("total_amount")).alias("sum_amount"))
    )


def gmv_of_day(orders: DataFrame, day: str) -> DataFrame:
    """Sum of one day as exactly one row; null when the day has no orders."""
    return _of_day(orders, "create_date", day).agg(exact_sum(F.col("total_amount")).alias("sum_amount"))


def gmv_by_hour(orders: DataFrame, day: str | None = None) -> DataFrame:
    return (
        _of_day(orders, "create_date", day)
        .groupBy("create_date", "create_hour")
        .agg(exact_sum(F.col("total_amount")).alias("sum_amount"))
    )


def hour_map(hours: DataFrame, day: str, hour: str, value: str) -> DataFrame:
    """One map of hour to value per day; at most 24 entries each. An unknown hour is no entry."""
    entries = F.sort_array(F.collect_list(F.when(F.col(hour).isNotNull(), F.struct(hour, value))))
    return hours.groupBy(day).agg(F.map_from_entries(entries).alias("hours"))


def new_devices(logs: DataFrame, day: str | None = None) -> DataFrame:
    """Devices by the first day they were ever seen.

    ``logs`` may be raw logs or the deduplicated table; the minimum is taken in the map tasks
    before the shuffle. With a day, later days are not read: they cannot change a first day.
    """
    known = logs if day is None else logs.where(F.col("log_date") <= day)
    first_day = known.groupBy("mid").agg(F.min("log_date").alias("log_date"))
    return _of_day(first_day, "log_date", day).groupBy("log_date").agg(F.count(F.lit(1)).alias("ct"))


def concat_metrics(frames: list[tuple[str, DataFrame]], day: str, value: str) -> DataFrame:
    """Several per-day metrics as rows ``(day, ord, id, name, value)`` in the given order."""
    parts = [
        df.select(
            F.col(day), F.lit(i).alias("ord"), F.lit(name).alias("id"), F.lit(TOTAL_NAMES.get(name)).alias("name"),
            F.col(value).cast("double").alias("value"),
        )
        for i, (name, df) in enumerate(frames)
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def realtime_total(dau: DataFrame, orders: DataFrame, logs: DataFrame | None = None,
                   day: str | None = None) -> DataFrame:
    """Active devices, new devices and order amount, in this order.

    With a day: always three rows; counts without rows are 0, an amount without orders is null.
    """
    devices = dau if logs is None else logs
    frames = [
        (METRIC_DAU, dau_total(dau, day), "ct"),
        (METRIC_NEW_DEVICE, new_devices(devices, day), "ct"),
        (METRIC_ORDER_AMOUNT, gmv_total(orders, day).withColumnRenamed("create_date", "log_date"), "sum_amount"),
    ]
    if day is not None:
        empty = {METRIC_DAU: F.lit(0.0), METRIC_NEW_DEVICE: F.lit(0.0), METRIC_ORDER_AMOUNT: F.lit(None)}
        frames = [
            (name, df.agg(F.coalesce(F.max(value).cast("double"), empty[name].cast("double")).alias("value"))
             .withColumn("log_date", F.lit(day)), "value")
            for name, df, value in frames
        ]
    return concat_metrics(
        [(name, df.withColumnRenamed(value, "value")) for name, df, value in frames], "log_date", "value"
    )


def day_over_day(hours: DataFrame, day: str, hour: str, value: str, only: str | None = None) -> DataFrame:
    """Each hour's value on the day and on the day before, side by side.

    The small hourly series is read once: every row counts for its own day and for the next.
    An hour present on neither day gives no row.
    """
    if only is not None:
        hours = hours.where(F.col(day).isin(F.lit(only)) | (F.col(day) == prev_day(F.lit(only))))
    own = F.struct(F.col(day).alias("day"), F.lit("today").alias("side"))
    following = F.struct(
        F.date_add(F.to_date(F.col(day)), 1).cast("string").alias("day"), F.lit("yesterday").alias("side")
    )
    sides = hours.select(F.explode(F.array(own, following)).alias("s"), F.col(hour).alias("hour"), F.col(value).alias("v"))

    def side(name: str) -> Column:
        return F.max(F.when(F.col("s.side") == name, F.col("v"))).alias(name)

    out = sides.groupBy(F.col("s.day").alias("day"), "hour").agg(side("yesterday"), side("today"))
    return out if only is None else out.where(F.col("day") == only)


def hours_reply(hours: DataFrame, day: str, hour: str, value: str, only: str | None = None) -> DataFrame:
    """One row per day with two maps of hour to value, ``yesterday`` and ``today``; at most 24 entries
    each. A day of which neither side has a row gives no row."""
    sides = day_over_day(hours, day, hour, value, only)

    def side(name: str) -> Column:
        known = F.col("hour").isNotNull() & F.col(name).isNotNull()
        return F.map_from_entries(F.sort_array(F.collect_list(F.when(known, F.struct("hour", name))))).alias(name)

    return sides.groupBy("day").agg(side("yesterday"), side("today"))


def densify_hours(hours: DataFrame, day: str, hour: str, value: str, days: list[str] | None = None) -> DataFrame:
    """All 24 hours of every day present, or of the given ``days``; a missing value becomes 0.

    The days come from the already aggregated series, and each one expands to 24 slots, so
    nothing is joined to the raw data. A given day without rows has 24 zeros. An unknown hour
    belongs to no slot.
    """
    zero = F.lit(0).cast(hours.schema[value].dataType)
    slots = F.transform(F.sequence(F.lit(0), F.lit(HOURS - 1)), lambda h: F.lpad(h.cast("string"), 2, "0"))
    per_day = hours.groupBy(day).agg(
        F.map_from_entries(F.collect_list(
            F.when(F.col(hour).isNotNull(), F.struct(F.col(hour), F.col(value))))).alias("_m")
    )
    if days is not None:
        wanted = hours.sparkSession.createDataFrame([(d,) for d in days], "_day string")
        wanted = wanted.select(F.col("_day").cast(hours.schema[day].dataType).alias(day)).distinct()
        per_day = wanted.join(per_day, day, "left")
    return per_day.select(day, F.explode(slots).alias(hour), "_m").select(
        day, hour, F.coalesce(F.try_element_at("_m", F.col(hour)), zero).alias(value)
    )


def select_metric(name: str, dau: DataFrame, orders: DataFrame) -> tuple[DataFrame, str, str, str]:
    """Hourly series of a metric by its id, with its day, hour and value columns."""
    builders: dict[str, Callable[[], tuple[DataFrame, str, str, str]]] = {
        METRIC_DAU: lambda: (dau_by_hour(dau), "log_date", "log_hour", "ct"),
        METRIC_ORDER_AMOUNT: lambda: (gmv_by_hour(orders), "create_date", "create_hour", "sum_amount"),
    }
    if name not in builders:
        raise KeyError(f"unknown metric {name!r}; known: {sorted(builders)}")
    return builders[name]()


def scalar_or_zero(df: DataFrame, value: Column, name: str = "value") -> DataFrame:
    """One-row frame of an aggregate, 0 when there is nothing to aggregate."""
    return df.agg(F.coalesce(value, F.lit(0)).alias(name))
