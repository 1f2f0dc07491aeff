"""Joins that stay even when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

#: Keys followed by the sketch of frequent keys, and those it may name.
TRACKED, NAMED = 10_000, 256
#: A key is heavy from this multiple of a task's even share on, and from this many rows.
SHARE, LEAST_ROWS = 2, 100_000


def _hash(keys: list[str]) -> Column:
    return F.xxhash64(*keys)


def heavy_keys(df: DataFrame, keys: list[str], tasks: int | None = None, least_rows: int = LEAST_ROWS) -> dict[int, int]:
    """Hashes of the keys that hold more rows than a few tasks should, and over how many tasks to spread each.

    One pass over the key columns with a frequent-items sketch, merged from the map tasks. It returns
    at most ``NAMED`` keys, and there cannot be more than half as many as ``tasks``, by default the
    session's shuffle partitions.
    """
    tasks = tasks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    top = F.expr(f"approx_top_k(_hash, {min(NAMED, max(1, tasks // SHARE))}, {TRACKED})").alias("top")
    found = df.select(_hash(keys).alias("_hash")).agg(F.count(F.lit(1)).alias("n"), top).first()
    even = found.n / tasks
    return {
        r["item"]: min(tasks, int(-(-r["count"] // max(1, even)))) for r in found.top or []
        if r["count"] >= max(SHARE * even, least_rows)
    }


def join_spread(left: DataFrame, right: DataFrame, keys: list[str], how: str, salts: int | None = None,
                heavy: dict[int, int] | None = None) -> DataFrame:
    """Join with a side that has one row per key, spreading heavy keys over several tasks.

    Adaptive execution splits skewed partitions only where a join reads two plain shuffles.
    Where the right side is an aggregate Spark reuses its shuffle instead, and the left rows of
    a hot key would meet in one task. So the left rows of heavy keys are spread by a hash of their
    content (the same again after a lost executor), and the right rows of these keys are copied to
    each of their salts; all other rows stay single. Heavy keys are those of :func:`heavy_keys`,
    unless they are given; a fixed number of ``salts`` treats all keys alike and needs no pass.
    """
    if salts is None and heavy is None:
        heavy = heavy_keys(left, keys)
    if salts == 1 or (salts is None and not heavy):
        return left.join(right, keys, how)
    spread = F.lit(salts or 1)
    for item, n in (heavy or {}).items():
        spread = F.when(_hash(keys) == item, F.lit(n)).otherwise(spread)
    content = [c for c in left.columns if not isinstance(left.schema[c].dataType, (T.MapType, T.VariantType))]
    l = left.withColumn("_salt", F.pmod(F.xxhash64(*content), spread).cast("int"))
    r = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), spread.cast("int") - 1)))
    return l.join(r, [*keys, "_salt"], how).drop("_salt")
