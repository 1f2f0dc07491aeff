"""Connected components of a link table, for any number of links and any size of a component.

Each round points every node at the smallest node among its neighbours, first for the larger
neighbours and then for the smaller ones; chains shorten by about half per round. Minimums are
taken in the map tasks and joined back, so a node with very many neighbours is no single group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillstream.llm.scratch import save


def _minimum(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def _round(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step over edges (u, v) with v < u."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    # Written, as it is read three times; the plan of a whole round would be long.
    large = save(
        both.join(_minimum(both), "u").where("v > u")
        .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct(), "large")
    low = _minimum(large)
    small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return small.union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, component)`` for every node of a link; the component is its smallest node.

    Links of a node with itself and links with null are left out. No links give no rows.
    """
    u, v = F.greatest(a, b), F.least(a, b)
    now = save(edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
               .select(u.alias("u"), v.alias("v")).distinct(), "links")
    state = None
    while True:
        seen = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if tuple(seen) == state:
            break
        state = tuple(seen)
        now = save(_round(now), "links")
    roots = now.select(F.col("v").alias("node")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        roots.select("node", F.col("node").alias("component")))
