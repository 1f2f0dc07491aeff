"""The given tables seen as the rows of the domain.

Keys keep their native type here: comparing and hashing numbers is cheaper than text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillstream.config import AlertRule
from tillstream.functions import day_of, hour_of
from tillstream.sources.files import table

# What the given tables stand for.
AS_OF = "2010-01-01"
FIRST_BIRTHDAY = "1970-01-01"
BIRTHDAY_STEP = 7919
BIRTHDAY_RANGE = 14_000
MALE = "BUILDING"
DAILY_RULE = AlertRule(window="1 day", slide="1 day", coupon=("purchase", "click"), browse=("view",))
SLIDING_RULE = AlertRule(window="1 day", slide="6 hours", coupon=("purchase", "click"), browse=("view",))


def startup_logs(events: DataFrame) -> DataFrame:
    """Events as startup logs of the device ``user_id``."""
    return events.select(
        "event_id", F.col("user_id").alias("mid"), F.col("event_type").alias("type"), "ts",
        day_of(F.col("ts")).alias("log_date"), hour_of(F.col("ts")).alias("log_hour"),
    )


def event_logs(events: DataFrame) -> DataFrame:
    """Events as action logs: the device is the ``k`` of the JSON properties."""
    return events.select(
        "event_id",
        F.get_json_object("props", "$.k").alias("mid"),
        F.col("user_id").alias("uid"),
        F.col("event_type").alias("evid"),
        F.floor("value").cast("string").alias("itemid"),
        F.col("ts").alias("event_time"),
    )


def hourly_sales(events: DataFrame) -> DataFrame:
    """Purchases as orders with an hour (the order table has days only)."""
    return events.where(F.col("event_type") == "purchase").select(
        day_of(F.col("ts")).alias("create_date"), hour_of(F.col("ts")).alias("create_hour"),
        F.col("value").alias("total_amount"),
    )


def order_infos(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("user_id"),
        F.col("o_orderstatus").alias("order_status"), F.col("o_totalprice").alias("total_amount"),
        F.col("o_orderdate").alias("create_time"), day_of(F.col("o_orderdate")).alias("create_date"),
    )


def detail_id() -> Column:
    """Unique text id of a line item row."""
    return F.concat_ws(
        "-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", day_of(F.col("l_shipdate")),
    )


def order_details(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """Lines with the name of their article."""
    names = part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("sku_name"))
    lines = lineitem.select(
        detail_id().alias("id"), F.col("l_orderkey").alias("order_id"), "l_partkey",
        F.col("l_extendedprice").alias("order_price"),
    )
    return lines.join(names, "l_partkey").withColumnRenamed("l_partkey", "sku_id")


def birthday(key: Column) -> Column:
    """A birthday derived from the customer key, spread over some 38 years."""
    days = F.pmod(key * BIRTHDAY_STEP, F.lit(BIRTHDAY_RANGE)).cast("int")
    return F.date_add(F.lit(FIRST_BIRTHDAY).cast("date"), days)


def user_infos(customer: DataFrame) -> DataFrame:
    """Customers as users; the market segment stands for the gender."""
    return customer.select(
        F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("gender"),
        F.col("c_nationkey").alias("user_level"), birthday(F.col("c_custkey")).alias("birthday"),
    )


def sale_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Line, order, article and buyer joined: the documents that are searched."""
    from tillstream.operators.joins import enrich_with_users, sale_detail

    details = order_details(table(spark, folder, "lineitem"), table(spark, folder, "part"))
    sales = sale_detail(order_infos(table(spark, folder, "orders")), details)
    return enrich_with_users(sales, user_infos(table(spark, folder, "customer")), F.lit(AS_OF))
