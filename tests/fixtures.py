"""Log rows with the distributions of the app simulator, generated in parallel.

Every value is a hash of the row number and a seed, so a rerun after a lost executor gives
the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillstream.config import EVENT_TYPE, STARTUP_TYPE

# Options and their weights.
OS = {"ios": 3, "andriod": 7}
AREA = {
    "beijing": 10, "shanghai": 10, "guangdong": 20, "hebei": 5, "heilongjiang": 5,
    "shandong": 5, "tianjin": 5, "shan3xi": 5, "shan1xi": 5, "sichuan": 5,
}
VERSION = {"1.2.0": 50, "1.1.2": 15, "1.1.3": 30, "1.1.1": 5}
EVENT = {"addFavor": 10, "addComment": 30, "addCart": 20, "clickItem": 5, "coupon": 45}
CHANNEL = {
    "xiaomi": 10, "huawei": 20, "wandoujia": 30, "360": 20, "tencent": 20, "baidu": 10, "website": 10,
}
IOS_CHANNEL = "appstore"
DEVICES = (1, 200)
USERS = (1, 500)
PAGES = (1, 50)
ITEMS = (0, 49)
STOP_CHANCE = 0.2


def uniform(seed: int, *key: Column) -> Column:
    """A number in [0, 1) fixed by the key and the seed."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *key), 11)
    return bits.cast("double") / float(1 << 53)


def weighted(u: Column, options: dict[str, int]) -> Column:
    """Pick an option by its weight."""
    total, upto, pick = sum(options.values()), 0, None
    for name, weight in options.items():
        upto += weight
        test = u * total < upto
        pick = F.when(test, F.lit(name)) if pick is None else pick.when(test, F.lit(name))
    return pick


def integer(u: Column, bounds: tuple[int, int]) -> Column:
    """A whole number between two bounds, both included."""
    low, high = bounds
    return (F.floor(u * (high - low + 1)) + low).cast("int")


def increasing_ms(id_: Column, seed: int, start_ms: int, step_ms: int) -> Column:
    """Times that rise with the row number: an even grid with a random shift inside each step."""
    return (F.lit(start_ms) + id_ * step_ms + F.floor(uniform(seed, id_) * step_ms)).cast("bigint")


def startup_rows(spark: SparkSession, n: int, seed: int = 1, app_id: str = "shop",
                 start_ms: int = 1_704_067_200_000, step_ms: int = 200) -> DataFrame:
    """``n`` startup rows. Apple devices always come from the app store."""
    row = F.col("id")
    df = spark.range(n).withColumn("os", weighted(uniform(seed + 2, row), OS))
    return df.select(
        "id",
        F.lit(STARTUP_TYPE).alias("type"),
        F.concat(F.lit("mid_"), integer(uniform(seed, row), DEVICES).cast("string")).alias("mid"),
        integer(uniform(seed + 1, row), USERS).cast("string").alias("uid"),
        "os",
        F.lit(app_id).alias("appid"),
        weighted(uniform(seed + 3, row), AREA).alias("area"),
        F.when(F.col("os") == "ios", IOS_CHANNEL).otherwise(weighted(uniform(seed + 4, row), CHANNEL)).alias("ch"),
        weighted(uniform(seed + 5, row), VERSION).alias("vs"),
        increasing_ms(row, seed + 6, start_ms, step_ms).alias("ts"),
    )


def event_rows(startups: DataFrame, seed: int = 101, step_ms: int = 10) -> DataFrame:
    """Events of every startup: 0 or more, stopping with a fixed chance after each (mean 4)."""
    row, no = F.col("id"), F.col("no")
    draw = F.greatest(uniform(seed, row), F.lit(1e-15))
    count = F.floor(F.log(draw) / F.log(F.lit(1 - STOP_CHANCE))).cast("int")
    numbers = F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>"))
    return startups.withColumn("no", F.explode(numbers)).select(
        "id", "no",
        F.lit(EVENT_TYPE).alias("type"),
        "mid", "uid", "os", "appid", "area",
        weighted(uniform(seed + 1, row, no), EVENT).alias("evid"),
        integer(uniform(seed + 2, row, no), PAGES).alias("pgid"),
        integer(uniform(seed + 3, row, no), PAGES).alias("npgid"),
        integer(uniform(seed + 4, row, no), ITEMS).alias("itemid"),
        (F.col("ts") + no * step_ms).alias("ts"),
    )
