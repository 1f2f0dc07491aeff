"""Heavy keys and mergeable distinct counts."""

from __future__ import annotations

from random import Random

from pyspark.sql import functions as F

from tillstream.operators import bitmaps, dedup, skew


def test_a_key_with_a_third_of_the_rows_is_spread_and_others_are_not_copied(spark):
    n = 30_000
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    heavy = skew.heavy_keys(df, ["k"], tasks=100, least_rows=1000)
    assert len(heavy) == 1 and 30 <= list(heavy.values())[0] <= 40
    assert skew.heavy_keys(df.where("k >= 0"), ["k"], tasks=100, least_rows=100) == {}
    assert skew.heavy_keys(df.limit(0), ["k"]) == {}
    seen = df.select("k").where("k % 2 = 1 or k = -1").distinct()
    joined = skew.join_spread(df, seen, ["k"], "left_semi", heavy=heavy)
    assert joined.count() == df.where("k % 2 = 1 or k = -1").count()
    # Only the heavy key's row is copied, once per salt.
    salted = [x for x in (1, list(heavy.values())[0])]
    tasks = skew.join_spread(df, seen.withColumn("w", F.lit(1)), ["k"], "inner", heavy=heavy)
    assert tasks.count() == joined.count() and tasks.agg(F.sum("w")).first()[0] == joined.count()
    spread = F.when(F.xxhash64("k") == list(heavy)[0], F.lit(salted[1])).otherwise(F.lit(1))
    assert seen.select(F.explode(F.sequence(F.lit(0), spread - 1))).count() == seen.count() + salted[1] - 1


def test_heavy_string_and_null_keys_keep_the_result(spark):
    rng = Random(1)
    rows = [(rng.choice(["a", "a", "a", None, f"k{i % 50}"]), rng.choice(["x", None]), i) for i in range(2000)]
    df = spark.createDataFrame(rows, "k string, l string, v int")
    heavy = skew.heavy_keys(df, ["k", "l"], tasks=10, least_rows=100)
    assert heavy
    for how in ("left_semi", "left_anti", "inner", "left"):
        right = df.select("k", "l").where("v % 2 = 0").distinct()
        got = skew.join_spread(df, right, ["k", "l"], how, heavy=heavy)
        assert sorted(map(str, got.collect())) == sorted(map(str, df.join(right, ["k", "l"], how).collect())), how
    assert dedup.not_seen(df, df, ["v"]).count() == 0


def test_bitmaps_count_any_union(spark):
    rng = Random(2)
    data = [(f"2024-01-{rng.randrange(1, 12):02}", f"{rng.randrange(3):02}", rng.choice([f"m{rng.randrange(300)}", None])) for _ in range(2000)]
    visits = spark.createDataFrame(data, "log_date string, log_hour string, mid string")
    early, late = visits.where("log_date < '2024-01-05'"), visits
    first = bitmaps.number_devices(early, buckets=8)
    numbers = first.unionByName(bitmaps.number_devices(late, first, buckets=8))
    got = numbers.collect()
    assert len(got) == len({r.number for r in got}) == len({r.mid for r in got}) == len({m for *_, m in data if m})
    assert max(r.number for r in got) < 3 * len(got)
    assert {r.mid: r.number for r in first.collect()}.items() <= {r.mid: r.number for r in got}.items()
    maps = bitmaps.device_bitmaps(visits, numbers, ["log_date", "log_hour"])
    count = lambda df: {tuple(r)[:-1]: r.devices for r in df.collect()}
    brute = lambda key: {k: len({m for d, h, m in data if m and key(d, h) == k}) for k in {key(d, h) for d, h, m in data if m}}
    assert count(bitmaps.distinct_devices(maps, ["log_date", "log_hour"])) == brute(lambda d, h: (d, h))
    assert count(bitmaps.distinct_devices(bitmaps.merged(maps, ["log_date"]), ["log_date"])) == brute(lambda d, h: (d,))
    # Merging parts, with repeats, gives the whole.
    parts = bitmaps.merged(maps.where("log_hour = '00'").unionByName(maps), [])
    assert bitmaps.distinct_devices(parts, []).first().devices == len(got)
    days = sorted({d for d, _, m in data if m})
    want = {(d,): len({m for e, _, m in data if m and days.index(d) - days.index(e) in range(4) and e >= d[:8] + f"{int(d[8:]) - 3:02}"}) for d in days}
    assert count(bitmaps.trailing_distinct(maps, 4)) == want
    assert bitmaps.distinct_devices(maps.limit(0), ["log_date"]).count() == 0
