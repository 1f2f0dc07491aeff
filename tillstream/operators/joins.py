"""Orders with their lines, then with their user."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillstream.functions import age_years
from tillstream.operators.skew import heavy_keys


def orders_full_outer_details(orders: DataFrame, details: DataFrame, order_key: str = "id",
                              detail_key: str = "order_id") -> DataFrame:
    """Full outer join of orders (one row per key) with their lines.

    Written as "lines left join orders" plus "orders without lines". Adaptive execution can
    split a skewed side of a left or anti join but not of a full outer join, so one order
    with very many lines does not end up in a single task. Order columns whose name a line
    column has too get the suffix ``_of_order``.
    """
    taken = set(details.columns)
    names = {c: f"{c}_of_order" if c in taken else c for c in orders.columns}
    o, key = orders.withColumnsRenamed(names), names[order_key]
    lines = details.join(o, F.col(detail_key) == F.col(key), "left")
    alone = o.join(_line_keys(details.select(F.col(detail_key).alias(key)), key), key, "left_anti")
    return lines.unionByName(alone, allowMissingColumns=True)


def _line_keys(keys: DataFrame, key: str) -> DataFrame:
    """The keys of the lines for an anti join: of the heavy ones one row each, all others as they are.

    A ``distinct`` over all would hold every key that a task reads in a hash table, and most orders have few
    lines. Only a heavy key must not send all its rows to one task.
    """
    heavy = list(heavy_keys(keys, [key]))
    if not heavy:
        return keys
    is_heavy = F.xxhash64(key).isin(heavy)
    return keys.where(~is_heavy).union(keys.where(is_heavy).distinct())


def orders_with_details(orders: DataFrame, details: DataFrame, order_key: str, detail_key: str) -> DataFrame:
    """Inner join on the order id."""
    return details.join(orders, F.col(detail_key) == F.col(order_key))


def orders_near_details(orders: DataFrame, details: DataFrame, order_key: str, detail_key: str,
                        order_time: str, detail_time: str, before: str, after: str) -> DataFrame:
    """Inner join on the order id where the line's time lies in
    ``[order time - before, order time + after]``."""
    o, d = F.col(order_time), F.col(detail_time)
    near = d.between(o - F.expr(f"interval {before}"), o + F.expr(f"interval {after}"))
    return details.join(orders, (F.col(detail_key) == F.col(order_key)) & near)


def unmatched_orders(orders: DataFrame, details: DataFrame, order_key: str, detail_key: str) -> DataFrame:
    """Orders that have no line at all."""
    keys = details.select(F.col(detail_key).alias(order_key)).distinct()
    return orders.join(keys, order_key, "left_anti")


def unmatched_details(orders: DataFrame, details: DataFrame, order_key: str, detail_key: str) -> DataFrame:
    """Lines whose order is missing. Orders have one row per key, so they need no ``distinct``,
    and the plain join lets Spark split an order with very many lines."""
    keys = orders.select(F.col(order_key).alias(detail_key))
    return details.join(keys, detail_key, "left_anti")


def sale_detail(orders: DataFrame, details: DataFrame) -> DataFrame:
    """Order and line columns of the sale detail row, before the user is added."""
    o = orders.select(
        F.col("id").alias("order_id"), "order_status", "create_time", "user_id",
        F.col("create_date").alias("dt"),
    )
    d = details.select(
        F.col("id").alias("order_detail_id"), "order_id", "sku_id", "sku_name",
        F.col("order_price").cast("double").alias("sku_price"),
    )
    return d.join(o, "order_id")


def two_level_users(cache: DataFrame, base: DataFrame, key: str = "id") -> DataFrame:
    """User rows from the cache, and from the base table where the cache has none.

    Both sides hold one row per user. A cached row wins as a whole.
    """
    return cache.unionByName(base.join(cache.select(key), key, "left_anti"))


def enrich_with_users(sales: DataFrame, users: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Add gender, level and age of the buyer; unknown users give nulls.

    A plain left join: Spark broadcasts the users only while their size is below the
    configured limit, else it shuffles both sides and splits skewed buyers at run time.
    """
    as_of = F.current_date() if as_of is None else as_of
    u = users.select(
        F.col("id").alias("user_id"),
        F.col("gender").alias("user_gender"),
        F.col("user_level"),
        age_years(F.col("birthday"), as_of).alias("user_age"),
    )
    return sales.join(u, "user_id", "left")
