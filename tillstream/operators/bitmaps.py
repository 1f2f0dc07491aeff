"""Distinct devices over any union of hours, without the logs: bitmaps of device numbers.

A device's number is a place in its hash bucket, so numbers are given out bucket by bucket and stay
dense. An hour's devices are bitmaps of 32,768 numbers each (4 KB); a union is their bitwise or,
made in the map tasks, and a distinct count is the number of bits. Exact for any range of hours, days or
weeks, and for unions of several sites, at the cost of the bitmaps alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Buckets of device numbers. Each is numbered in one task.
BUCKETS = 4096


def number_devices(devices: DataFrame, known: DataFrame | None = None, device: str = "mid",
                   buckets: int = BUCKETS) -> DataFrame:
    """``(device, number)`` of the devices that ``known``, a table of the same shape, does not have.

    Repeated and null devices give no further row. Append the result to ``known``; numbers once given
    never change.
    """
    new = devices.select(device).where(F.col(device).isNotNull()).distinct()
    bucket = F.pmod(F.xxhash64(device), F.lit(buckets)).alias("_bucket")
    place = F.row_number().over(Window.partitionBy("_bucket").orderBy(device)).cast("bigint")
    if known is None:
        return new.select(device, bucket).select(device, ((place - 1) * buckets + F.col("_bucket")).alias("number"))
    new = new.join(known.select(device), device, "left_anti").select(device, bucket)
    used = known.groupBy(F.pmod("number", F.lit(buckets)).alias("_bucket")).agg(
        (F.floor(F.max("number") / buckets) + 1).alias("_used"))
    placed = new.join(used, "_bucket", "left").withColumn("_place", place - 1 + F.coalesce("_used", F.lit(0)))
    return placed.select(device, (F.col("_place") * buckets + F.col("_bucket")).alias("number"))


def device_bitmaps(visits: DataFrame, numbers: DataFrame, by: list[str], device: str = "mid") -> DataFrame:
    """``(by..., segment, bits)``: the devices of each group, for example of each day and hour.

    Visits are made distinct in the map tasks before they meet the numbers. Visits without a device, or
    of one without number, are in no bitmap.
    """
    own = visits.select(*by, device).distinct().join(numbers.select(device, "number"), device)
    value = F.col("number") + 1  # segments of positive values count from 1
    return own.groupBy(*by, F.bitmap_bucket_number(value).alias("segment")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(value)).alias("bits"))


def merged(bitmaps: DataFrame, by: list[str | Column]) -> DataFrame:
    """Bitmaps of larger groups: ``(by..., segment, bits)``. Merging is associative and repeats do no harm."""
    return bitmaps.groupBy(*by, "segment").agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_devices(bitmaps: DataFrame, by: list[str | Column], name: str = "devices") -> DataFrame:
    """Number of distinct devices of each group of bitmaps."""
    whole = merged(bitmaps, by)
    keys = [c for c in whole.columns if c not in ("segment", "bits")]
    return whole.groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias(name))


def trailing_distinct(bitmaps: DataFrame, days: int, day: str = "log_date", name: str = "devices") -> DataFrame:
    """Distinct devices of every day together with the ``days - 1`` before it, for days with bitmaps.

    A day's bitmaps are merged first; each then counts for the following days, which are ``days`` rows
    per segment of a day and not per visit.
    """
    daily = merged(bitmaps, [day])
    ends = F.explode(F.sequence(F.to_date(day), F.date_add(F.to_date(day), days - 1))).alias("_end")
    counted = distinct_devices(daily.select(ends, "segment", "bits").withColumn("_end", F.col("_end").cast("string")), ["_end"], name)
    return daily.select(F.to_date(day).cast("string").alias("_end")).distinct().join(counted, "_end").select(
        F.col("_end").alias(day), name)
