"""Coupon-abuse alerts: several accounts take coupons on one device and nothing is browsed.

The rule is decided on counts, never on collected groups. Events are first counted per
device, time slot and account; these counts are merged into one row per device and window.
Every step has a map-side part, so a device that sends a large share of
all events arrives as a few partial rows per task. The accounts, items and events of windows
that fired are flat member rows, so a group of any size has the same shape.
"""

from __future__ import annotations

import re
from math import gcd

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tillstream.config import AlertRule
from tillstream.functions import minute_doc_id
from tillstream.operators.dedup import is_seen, latest_by_key
from tillstream.operators.skew import join_spread

# Seconds per unit.
UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}
SPAN_SLOTS = 10_000


def seconds_of(text: str) -> int:
    """``"5 minutes"`` to 300."""
    match = re.fullmatch(r"\s*(\d+)\s+(second|minute|hour|day)s?\s*", text)
    if not match:
        raise ValueError(f"duration expected, like '5 minutes', not {text!r}")
    return int(match[1]) * UNIT_SECONDS[match[2]]


def windows_per_event(rule: AlertRule) -> int:
    window, slide = seconds_of(rule.window), seconds_of(rule.slide)
    if gcd(window, slide) != slide:
        raise ValueError("slide must divide window")
    return window // slide


def is_coupon(rule: AlertRule, evid: Column) -> Column:
    return F.coalesce(evid.isin(*rule.coupon), F.lit(False))


def is_browse(rule: AlertRule, evid: Column) -> Column:
    return F.coalesce(evid.isin(*rule.browse), F.lit(False))


def _epoch_seconds(df: DataFrame, ts: str) -> Column:
    """Whole seconds since 1970, for timestamps with and without zone."""
    t = F.col(ts)
    if isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        clock = F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)
        return F.datediff(t, F.lit("1970-01-01").cast("date")).cast("bigint") * 86400 + clock
    return F.unix_seconds(t)


def _slot(df: DataFrame, ts: str, seconds: int) -> Column:
    """Number of the time slot of a row; slots are ``seconds`` long."""
    return F.floor(_epoch_seconds(df, ts) / seconds)


def _slot_start(slot: Column, seconds: int, like: T.DataType) -> Column:
    if isinstance(like, T.TimestampNTZType):
        return F.lit("1970-01-01").cast(like) + F.make_dt_interval(secs=slot * seconds)
    return F.timestamp_seconds(slot * seconds)


def event_counts(rule: AlertRule) -> list[Column]:
    """Counts of one device and account: events, browses, coupons."""
    evid = F.col("evid")
    return [
        F.count(F.lit(1)).alias("n_events"),
        F.count_if(is_browse(rule, evid)).alias("n_browse"),
        F.count_if(is_coupon(rule, evid)).alias("n_coupon"),
    ]


def window_counts(events: DataFrame, rule: AlertRule, ts: str = "event_time") -> DataFrame:
    """Counts per device and window: events, browses, coupon accounts.

    Events without a device are left out: they come from many unknown devices, not from one.
    """
    per_slot = events.where(F.col("mid").isNotNull()).groupBy(
        "mid", _slot(events, ts, seconds_of(rule.slide)).alias("slot"), "uid").agg(*event_counts(rule))
    return windows_of_slots(per_slot, rule, events.schema[ts].dataType)


def windows_of_slots(per_slot: DataFrame, rule: AlertRule, kind: T.DataType) -> DataFrame:
    """Window counts from counts per device, slot and account; slots are as long as the slide."""
    slide = seconds_of(rule.slide)
    if windows_per_event(rule) == 1:
        counts = per_slot.groupBy("mid", F.col("slot").alias("first")).agg(
            F.sum("n_events").alias("n_events"),
            F.sum("n_browse").alias("n_browse"),
            F.count_if(_counts_as_account()).alias("n_uids"),
        )
    else:
        counts = _sliding_counts(per_slot, windows_per_event(rule))
    start = _slot_start(F.col("first"), slide, kind)
    return counts.select("mid", start.alias("window_start"), "n_events", "n_browse", "n_uids")


def _counts_as_account() -> Column:
    return (F.col("n_coupon") > 0) & F.col("uid").isNotNull()


def _sliding_counts(per_slot: DataFrame, n: int) -> DataFrame:
    """Counts of all windows of ``n`` slots, without copying rows into the windows.

    A slot lies in the windows that begin in its last ``n`` slots, so it raises their counts
    at one begin and lowers them again after another: two steps instead of ``n`` copies. An
    account counts once per window: each of its slots raises only windows that begin after its
    slot before. Running sums over the steps give the counts; the steps are cut into spans of
    bounded length, so that no device's running sum grows with the length of the history.
    """
    slot, span = F.col("slot"), max(n, SPAN_SLOTS)
    earlier = Window.partitionBy("mid", "uid").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    counts = _counts_as_account()
    before = F.last(F.when(counts, slot), ignorenulls=True).over(earlier)
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")

    def raised(begin: Column, n_events: Column, n_browse: Column, n_uids: Column) -> Column:
        return F.struct(
            begin.alias("begin"), n_events.alias("n_events"), n_browse.alias("n_browse"), n_uids.alias("n_uids"),
        )

    first = slot - (n - 1)
    changes = per_slot.withColumn("before", before).select(
        "mid", (slot + 1).alias("end"),
        F.explode(F.filter(F.array(
            raised(first, F.col("n_events"), F.col("n_browse"), zero),
            F.when(counts, raised(F.greatest(first, F.col("before") + 1), zero, zero, one)),
        ), lambda c: c.isNotNull())).alias("c"),
    )

    def step(span_no: Column, at: Column, sign: int) -> Column:
        return F.struct(
            span_no.alias("span"), at.alias("first"),
            *[(F.col(f"c.{k}") * sign).alias(k) for k in ("n_events", "n_browse", "n_uids")],
        )

    begin, end = F.col("c.begin"), F.col("end")
    begin_span, end_span = F.floor(begin / span), F.floor((end - 1) / span)
    steps = changes.select("mid", F.explode(F.filter(F.array(
        step(begin_span, begin, 1),
        F.when(begin_span != end_span, step(end_span, end_span * span, 1)),
        step(end_span, end, -1),
    ), lambda s: s.isNotNull())).alias("s")).select("mid", "s.*")
    merged = steps.groupBy("mid", "span", "first").agg(
        *[F.sum(k).alias(k) for k in ("n_events", "n_browse", "n_uids")]
    )
    so_far = Window.partitionBy("mid", "span").orderBy("first")
    totals = merged.select(
        "mid", "first",
        F.coalesce(F.lead("first").over(so_far), (F.col("span") + 1) * span).alias("until"),
        *[F.sum(k).over(so_far).alias(k) for k in ("n_events", "n_browse", "n_uids")],
    ).where((F.col("n_events") > 0) & (F.col("until") > F.col("first")))
    return totals.withColumn("first", F.explode(F.sequence(F.col("first"), F.col("until") - 1)))


def fired(counts: DataFrame, rule: AlertRule) -> DataFrame:
    """Windows that meet the rule, with their end as the time of the alert."""
    end = F.col("window_start") + F.make_dt_interval(secs=F.lit(seconds_of(rule.window)))
    return (
        counts.where((F.col("n_uids") >= rule.min_uids) & (F.col("n_browse") == 0))
        .select("mid", "window_start", end.alias("window_end"), "n_uids", "n_events")
    )


def suspects(events: DataFrame, rule: AlertRule, ts: str = "event_time") -> DataFrame:
    """Device and block pairs outside of which no window can meet the rule.

    Time is cut into blocks as long as the window, so a window lies in two neighbouring
    blocks. It can have ``min_uids`` coupon accounts only if the accounts of both blocks add
    up to that many; then every event of both blocks is needed, and no other.
    """
    evid, width = F.col("evid"), F.make_dt_interval(secs=F.lit(seconds_of(rule.window)))
    block = F.col("block")
    accounts = (
        events.where(is_coupon(rule, evid) & F.col("uid").isNotNull() & F.col("mid").isNotNull())
        .select("mid", _block(ts, rule), "uid").distinct()
        .groupBy("mid", "block").agg(F.count(F.lit(1)).alias("n"))
    )
    first_blocks = (
        accounts.select("mid", F.explode(F.array(block, block - width)).alias("block"), "n")
        .groupBy("mid", "block").agg(F.sum("n").alias("n")).where(F.col("n") >= rule.min_uids)
    )
    return first_blocks.select("mid", F.explode(F.array(block, block + width)).alias("block"))


def _block(ts: str, rule: AlertRule) -> Column:
    return F.window(ts, rule.window)["start"].alias("block")


def coupon_alerts(events: DataFrame, rule: AlertRule, ts: str = "event_time") -> DataFrame:
    """One row per device and window that meets the rule.

    Abuse is rare. Where windows overlap, the events are first cut down to the suspect blocks,
    so that only few are copied into windows.
    """
    if windows_per_event(rule) > 1:
        blocks = events.withColumn("block", _block(ts, rule))
        events = is_seen(blocks, suspects(events, rule, ts), ["mid", "block"])
    return fired(window_counts(events, rule, ts), rule)


def one_per_minute(alerts: DataFrame) -> DataFrame:
    """One alert per device and minute: the latest, under its document id."""
    ids = alerts.withColumn("doc_id", minute_doc_id(F.col("mid"), F.col("window_end")))
    return latest_by_key(ids, ["doc_id"], ["window_end"])


def group_members(events: DataFrame, keys: list[str], order: list[str], rule: AlertRule) -> DataFrame:
    """Account set, item set and event list of every group as flat rows, whatever its size.

    Rows are ``(*keys, kind, value, *order, n)``: kind ``uid`` and ``item`` once per value of the
    coupon events, kind ``event`` once per event, with its place in the order columns; ``n`` counts
    equal events. Equal rows are merged in the map tasks and no group is gathered.
    """
    coupon = is_coupon(rule, F.col("evid"))

    def member(kind: str, value: Column, placed: bool) -> Column:
        at = [(F.col(c) if placed else F.lit(None).cast(events.schema[c].dataType)).alias(c) for c in order]
        return F.struct(F.lit(kind).alias("kind"), value.cast("string").alias("value"), *at)

    members = F.filter(F.array(
        member("event", F.col("evid"), True),
        F.when(coupon & F.col("uid").isNotNull(), member("uid", F.col("uid"), False)),
        F.when(coupon & F.col("itemid").isNotNull(), member("item", F.col("itemid"), False)),
    ), lambda m: m.isNotNull())
    counted = events.select(*keys, F.explode(members).alias("m")).select(*keys, "m.*").groupBy(
        *keys, "kind", "value", *order).agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("n", F.when(F.col("kind") == "event", F.col("n")).otherwise(F.lit(1).cast("bigint")))


def alert_members(alerts: DataFrame, events: DataFrame, rule: AlertRule, ts: str = "event_time",
                  order: tuple[str, ...] = ("event_id",)) -> DataFrame:
    """Accounts, items and events of alerts, as member rows under the alert's ``doc_id``.

    Events are first cut down to the blocks of time that the alerts of their device touch, then
    placed into windows and joined back. Alerts are few, so Spark mostly broadcasts them; beyond
    its size limit it shuffles, and the events of a hot device are spread over several tasks.
    """
    slide, width, kind = seconds_of(rule.slide), seconds_of(rule.window), events.schema[ts].dataType
    slot = _slot(events, ts, slide)
    first = F.explode(F.sequence(slot - (windows_per_event(rule) - 1), slot))
    if windows_per_event(rule) > 1:
        # A window lies in the block of its start and the one after it.
        start = F.window("window_start", rule.window)["start"]
        touched = alerts.select("mid", F.explode(F.array(
            start, start + F.make_dt_interval(secs=F.lit(width)))).alias("block")).distinct()
        events = is_seen(events.withColumn("block", _block(ts, rule)), touched, ["mid", "block"]).drop("block")
    in_windows = events.withColumn("first", first).withColumn(
        "window_start", _slot_start(F.col("first"), slide, kind)
    ).drop("first")
    found = alerts.select("mid", "window_start", minute_doc_id(F.col("mid"), F.col("window_end")).alias("doc_id"))
    members = join_spread(in_windows, found, ["mid", "window_start"], "inner")
    return group_members(members, ["doc_id", "mid", "window_start"], [ts, *order], rule)
