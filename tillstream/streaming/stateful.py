"""Stateful stream operators.

Rows meet in one task per key, so all of them shrink the input before that shuffle: built-in
aggregates do so by themselves, the Python processors through :func:`_shrink`, which reduces
each Arrow batch to the few rows the state can use.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

import tillstream
from tillstream.config import AlertRule, JoinBound
from tillstream.operators.alerts import event_counts, fired, is_browse, is_coupon, seconds_of
from tillstream.streaming.probe import probe

# The processors travel to the workers as code, so these need no copy of the package.
cloudpickle.register_pickle_by_value(tillstream)

DAY_MS = 24 * 3600 * 1000


def _shrink(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: T.StructType) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                yield fn(pdf)

    return df.mapInPandas(run, schema)


# --- earliest row per device and day ---------------------------------------------------------


def daily_first_updates(logs: DataFrame, order: list[str], watermark: str = "1 day",
                        day_start: str = "0 seconds", ts: str = "event_time",
                        day: str = "log_date", device: str = "mid", unseen: str | None = None) -> DataFrame:
    """Earliest row per device and day as a streaming aggregate (use output mode ``update``).

    Built-in and exact: a row that arrives late but is earlier replaces the one given out
    before, through the upsert key (day, device). The day window carries the watermark that
    drops old state. Where the session's days start at another time than the window's, which
    ``day_start`` can shift, a device has two rows for a day; the table keeps the earliest.

    ``unseen`` names a stage that counts a batch's rows of devices not known for their day before the
    batch. A device is new in the batch whose time is the first it was counted at; all its rows are of it.
    """
    first = [*order, *[c for c in logs.columns if c not in order and c not in (day, device)]]
    counts = []
    if unseen is not None:
        logs = logs.withColumn("_at", F.current_timestamp())
        counts = [F.min("_at").alias("_since"), F.count(F.lit(1)).alias("_rows")]
    found = (
        logs.withWatermark(ts, watermark)
        .groupBy(F.window(ts, "1 day", startTime=day_start).alias("_day"), day, device)
        .agg(F.min(F.struct(*first)).alias("_first"), *counts)
    )
    if unseen is not None:
        found = found.withColumn("_rows", F.when(F.col("_since") == F.current_timestamp(), F.col("_rows")))
        found = probe(found, unseen, F.col("_rows"))
    return found.select(day, device, "_first.*")


class DailyFirst(StatefulProcessor):
    """Gives out a device's earliest row of the batch that first shows it, once per day."""

    def __init__(self, order: list[str], ts: str) -> None:
        self.order, self.ts = order, ts

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "seen boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        if self.seen.exists():
            return
        first = None
        for pdf in rows:
            batch = pdf if first is None else pd.concat([first, pdf])
            first = batch.sort_values(self.order).head(1)
        if first is not None:
            self.seen.update((True,))
            at = first[self.ts].iloc[0]
            self.handle.registerTimer(int(at.timestamp() * 1000) + 2 * DAY_MS)
            yield first

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.seen.clear()
        return iter(())

    def close(self) -> None:
        pass


def daily_first_once(logs: DataFrame, order: list[str], watermark: str = "1 day", ts: str = "event_time",
                     day: str = "log_date", device: str = "mid") -> DataFrame:
    """One row per device and day in append mode: never corrected, emitted at once.

    The state is one flag per device and day, dropped when the watermark is two days past it.
    ``watermark`` must be below two days, or a late row could meet an emptied state.
    """
    keys, order = [day, device], list(order)

    def earliest(pdf: pd.DataFrame) -> pd.DataFrame:
        return pdf.sort_values(order).drop_duplicates(keys)

    slim = _shrink(logs, earliest, logs.schema).withWatermark(ts, watermark)
    return slim.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=DailyFirst(order, ts),
        outputStructType=logs.schema,
        outputMode="Append",
        timeMode="EventTime",
    )


# --- orders meet their lines -----------------------------------------------------------------


def orders_with_lines(orders: DataFrame, details: DataFrame, bound: JoinBound = JoinBound(),
                      order_key: str = "id", detail_key: str = "order_id",
                      order_time: str = "order_arrival", detail_time: str = "detail_arrival",
                      salt_by: str = "order_detail_id", heavy: dict[int, int] | None = None) -> DataFrame:
    """Orders and lines whose arrivals are at most ``bound.seconds`` apart.

    Streams are not re-planned at run time, so a hot order is split here: its lines are spread
    over ``bound.salts`` tasks, and the order is kept in each of them. The result is the same.
    Where the hot orders are known beforehand, ``heavy`` names their hashes and salts as
    ``operators.skew.heavy_keys`` gives them over the lines' key; all other orders are then kept once.
    """
    o, d = _salted(orders, details, bound, order_key, detail_key, order_time, detail_time, salt_by, heavy)
    return o.join(d, _near(bound, order_key, detail_key, order_time, detail_time)
                  & (F.col("_osalt") == F.col("_dsalt"))).drop("_osalt", "_dsalt")


def unmatched_orders(orders: DataFrame, details: DataFrame, bound: JoinBound = JoinBound(),
                     order_key: str = "id", detail_key: str = "order_id",
                     order_time: str = "order_arrival", detail_time: str = "detail_arrival",
                     salt_by: str = "order_detail_id", heavy: dict[int, int] | None = None) -> DataFrame:
    """Orders that no line came near, given out once the watermark has passed.

    Lines are spread over ``bound.salts`` (at most 62) tasks, or those of ``heavy``, as in
    :func:`orders_with_lines`. Every salt tells which orders it met no line of; an order is given out when
    all its salts say so, which an aggregate decides that keeps one number per order. Repeated equal
    orders are one.
    """
    o, d = _salted(orders, details, bound, order_key, detail_key, order_time, detail_time, salt_by, heavy)
    near = _near(bound, order_key, detail_key, order_time, detail_time) & (F.col("_osalt") == F.col("_dsalt"))
    missed = o.join(d.select(detail_key, detail_time, "_dsalt"), near, "left_outer").where(F.col("_dsalt").isNull())
    told = F.expr("bit_or(shiftleft(1L, _osalt))").alias("_told")
    every = F.call_function("shiftleft", F.lit(1).cast("long"), _spread(order_key, bound, heavy)) - 1
    return missed.groupBy(*orders.columns).agg(told).where(F.col("_told") == every).drop("_told")


def unmatched_lines(orders: DataFrame, details: DataFrame, bound: JoinBound = JoinBound(),
                    order_key: str = "id", detail_key: str = "order_id",
                    order_time: str = "order_arrival", detail_time: str = "detail_arrival",
                    salt_by: str = "order_detail_id") -> DataFrame:
    """Lines that no order came near, given out once the watermark has passed. A line has one salt, so
    the join alone decides."""
    o, d = _salted(orders, details, bound, order_key, detail_key, order_time, detail_time, salt_by)
    near = _near(bound, order_key, detail_key, order_time, detail_time) & (F.col("_osalt") == F.col("_dsalt"))
    joined = d.join(o.select(order_key, order_time, "_osalt"), near, "left_outer")
    return joined.where(F.col("_osalt").isNull()).select(*details.columns)


#: Bits of the number by which salts tell what they missed.
MOST_SALTS = 62


def _spread(key: str, bound: JoinBound, heavy: dict[int, int] | None) -> Column:
    """Number of salts of a row by its key."""
    spread = F.lit(bound.salts if heavy is None else 1)
    for item, n in (heavy or {}).items():
        spread = F.when(F.xxhash64(key) == item, F.lit(min(n, MOST_SALTS))).otherwise(spread)
    return spread


def _salted(orders: DataFrame, details: DataFrame, bound: JoinBound, order_key: str, detail_key: str, order_time: str,
            detail_time: str, salt_by: str, heavy: dict[int, int] | None = None) -> tuple[DataFrame, DataFrame]:
    """Both streams with watermarks: every order in each of its salts, every line in one."""
    if heavy and orders.schema[order_key].dataType != details.schema[detail_key].dataType:
        raise ValueError("heavy keys are told by their hashes, which needs keys of one type")
    o = orders.withWatermark(order_time, bound.watermark).withColumn(
        "_osalt", F.explode(F.sequence(F.lit(0), _spread(order_key, bound, heavy) - 1)))
    d = details.withWatermark(detail_time, bound.watermark).withColumn(
        "_dsalt", F.pmod(F.xxhash64(salt_by), _spread(detail_key, bound, heavy)).cast("int"))
    return o, d


def _near(bound: JoinBound, order_key: str, detail_key: str, order_time: str, detail_time: str):
    gap = F.expr(f"interval {bound.seconds} seconds")
    o, d = F.col(order_time), F.col(detail_time)
    return (F.col(order_key) == F.col(detail_key)) & (d >= o - gap) & (d <= o + gap)


# --- coupon alerts ---------------------------------------------------------------------------


def slot_counts(events: DataFrame, rule: AlertRule = AlertRule(), watermark: str = "1 minute",
                ts: str = "event_time") -> DataFrame:
    """Counts per device, slot and account as a streaming aggregate (use output mode ``update``).

    A row of state per slot instead of one per window, whatever the slide. Stored under (slot,
    device, account), they give the counts of all windows, open ones included, through
    ``alerts.windows_of_slots``.
    """
    slide = seconds_of(rule.slide)
    counted = (
        events.where(F.col("mid").isNotNull()).withWatermark(ts, watermark)
        .groupBy(F.window(ts, rule.slide).alias("window"), "mid", "uid").agg(*event_counts(rule))
    )
    start = F.col("window.start")
    return counted.select(
        F.floor(F.unix_seconds(start) / slide).alias("slot"), start.alias("slot_start"), "mid", "uid",
        "n_events", "n_browse", "n_coupon")


def windowed_alerts(events: DataFrame, rule: AlertRule = AlertRule(), watermark: str = "1 minute",
                    ts: str = "event_time") -> DataFrame:
    """Alerts of closed windows, in append mode.

    Two chained aggregates: per account first, then per device. Distinct accounts are counted
    rows, so the state holds numbers only and a hot device is spread over its accounts.
    """
    per_account = (
        events.where(F.col("mid").isNotNull()).withWatermark(ts, watermark)
        .groupBy(F.window(ts, rule.window, rule.slide).alias("window"), "mid", "uid")
        .agg(*event_counts(rule))
    )
    counts = per_account.groupBy("window", "mid").agg(
        F.sum("n_events").alias("n_events"),
        F.sum("n_browse").alias("n_browse"),
        F.count_if((F.col("n_coupon") > 0) & F.col("uid").isNotNull()).alias("n_uids"),
    )
    return fired(counts.withColumn("window_start", F.col("window.start")), rule)


PANE_ALERT = T.StructType([
    T.StructField("mid", T.StringType()),
    T.StructField("window_start", T.LongType()),
    T.StructField("n_uids", T.LongType()),
    T.StructField("n_events", T.LongType()),
])


class Panes(StatefulProcessor):
    """Keeps a device's last panes, one per slot that has events, and judges every window once.

    A window is judged when the watermark has passed its last slot. Going from one window to the next
    adds a pane and takes one away, so the work follows the panes and not panes times windows.
    """

    def __init__(self, k: int, slide_ms: int, size: int) -> None:
        self.k, self.slide_ms, self.size = k, slide_ms, size

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.kept = handle.getValueState(
            "panes", "slots array<bigint>, events array<bigint>, browses array<bigint>, uids array<array<string>>, next bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        panes, following = self._load()
        for pdf in rows:
            for slot, uid, n_events, n_browse, n_coupon in pdf[["slot", "uid", "n_events", "n_browse", "n_coupon"]].itertuples(index=False):
                pane = panes.setdefault(int(slot), [0, 0, set()])
                pane[0] += int(n_events)
                pane[1] += int(n_browse)
                if n_coupon > 0 and uid is not None and uid == uid:
                    pane[2].add(uid)
        return self._judge(key, panes, following, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        return self._judge(key, *self._load(), timerValues)

    def _load(self) -> tuple[dict, int | None]:
        if not self.kept.exists():
            return {}, None
        slots, events, browses, uids, following = self.kept.get()
        return {s: [e, b, set(u)] for s, e, b, u in zip(slots, events, browses, uids)}, following

    def _judge(self, key, panes: dict, following: int | None, timerValues) -> Iterator[pd.DataFrame]:
        """Judge the windows that closed since, and keep the panes that later windows hold."""
        # Of the slots up to this one all rows are there.
        closed = timerValues.getCurrentWatermarkInMs() // self.slide_ms - 1
        last = closed - self.size + 1
        fired = []
        start = min(panes) - self.size + 1 if panes else last + 1
        start = start if following is None else max(start, following)
        inside = [s for s in sorted(panes) if start <= s < start + self.size - 1]
        n_events, n_browse = sum(panes[s][0] for s in inside), sum(panes[s][1] for s in inside)
        uids = Counter(u for s in inside for u in panes[s][2])
        while start <= last:
            entering = panes.get(start + self.size - 1)
            if entering:
                n_events, n_browse = n_events + entering[0], n_browse + entering[1]
                uids.update(entering[2])
            if len(uids) >= self.k and not n_browse:
                fired.append((key[0], start * self.slide_ms, len(uids), n_events))
            leaving = panes.pop(start, None)
            if leaving:
                n_events, n_browse = n_events - leaving[0], n_browse - leaving[1]
                uids.subtract(leaving[2])
                uids = +uids
            # Without panes ahead there is nothing more to judge; over a gap the next window begins later.
            ahead = min(panes, default=None)
            start = last + 1 if ahead is None else max(start + 1, ahead - self.size + 1)
        if panes:
            rows = sorted(panes.items())
            self.kept.update((
                [s for s, _ in rows], [p[0] for _, p in rows], [p[1] for _, p in rows], [sorted(p[2]) for _, p in rows], start))
            self.handle.registerTimer((start + self.size) * self.slide_ms)
        else:
            self.kept.clear()
        if fired:
            yield pd.DataFrame(fired, columns=PANE_ALERT.fieldNames())

    def close(self) -> None:
        pass


def pane_alerts(events: DataFrame, rule: AlertRule = AlertRule(), watermark: str = "1 minute",
                ts: str = "event_time") -> DataFrame:
    """Alerts of closed windows, in append mode, without copying events into the windows that hold them.

    Counts per device, account and slot come first, as a built-in aggregate that spreads a hot device over
    its accounts. A device's closed slots then enter its panes: state and rows are one per slot, whatever the
    slide. Same result as :func:`windowed_alerts`.
    """
    slide, window = seconds_of(rule.slide), seconds_of(rule.window)
    counted = (
        events.where(F.col("mid").isNotNull()).withColumn("mid", F.col("mid").cast("string")).withWatermark(ts, watermark)
        .groupBy(F.window(ts, rule.slide).alias("window"), "mid", "uid").agg(*event_counts(rule))
    )
    slots = counted.select(
        F.window_time("window").alias("at"), "mid", F.floor(F.unix_seconds("window.start") / slide).alias("slot"),
        F.col("uid").cast("string").alias("uid"), "n_events", "n_browse", "n_coupon")
    alerts = slots.groupBy("mid").transformWithStateInPandas(
        statefulProcessor=Panes(rule.min_uids, 1000 * slide, window // slide), outputStructType=PANE_ALERT,
        outputMode="Append", timeMode="EventTime")
    start = F.timestamp_millis("window_start")
    return alerts.select(
        "mid", start.alias("window_start"), (start + F.make_dt_interval(secs=F.lit(window))).alias("window_end"), "n_uids", "n_events")


RECENT = T.StructType([
    T.StructField("mid", T.StringType()),
    T.StructField("uid", T.StringType()),
    T.StructField("coupon_ms", T.LongType()),
    T.StructField("browse_ms", T.LongType()),
    T.StructField("seen_ms", T.LongType()),
    T.StructField("at", T.TimestampType()),
])
RECENT_ALERT = T.StructType([
    T.StructField("mid", T.StringType()),
    T.StructField("uids", T.ArrayType(T.StringType())),
    T.StructField("ts", T.LongType()),
])


def last_coupons(rows: pd.DataFrame) -> pd.DataFrame:
    """Last coupon time of every account."""
    return rows.dropna(subset=["uid", "coupon_ms"]).groupby("uid", as_index=False)["coupon_ms"].max()


class RecentCoupons(StatefulProcessor):
    """Watches one device: its accounts that took coupons within the window, with their last
    times, and the times of its last browse and last event. Older accounts leave the state."""

    def __init__(self, k: int, window_ms: int) -> None:
        self.k, self.window_ms = k, window_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.recent = handle.getValueState(
            "recent", "uids array<string>, coupons array<bigint>, browse bigint, seen bigint"
        )

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        uids, coupons, browse, seen = self.recent.get() if self.recent.exists() else ([], [], -1, -1)
        if seen >= 0:
            self.handle.deleteTimer(seen + 2 * self.window_ms)
        known = pd.DataFrame({"uid": list(uids), "coupon_ms": list(coupons)})
        for pdf in rows:
            known = last_coupons(pd.concat([known, pdf[["uid", "coupon_ms"]]]))
            browse = max([browse, *pdf["browse_ms"].dropna()])
            seen = max([seen, *pdf["seen_ms"].dropna()])
        browse, seen = int(browse), int(seen)
        start = seen - self.window_ms
        known = known[known["coupon_ms"] > start]
        self.recent.update((
            known["uid"].tolist(), [int(c) for c in known["coupon_ms"]], browse, seen,
        ))
        self.handle.registerTimer(seen + 2 * self.window_ms)
        if len(known) >= self.k and browse <= start:
            yield pd.DataFrame({"mid": [key[0]], "uids": [sorted(known["uid"])], "ts": [seen]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.recent.clear()
        return iter(())

    def close(self) -> None:
        pass


def instant_alerts(events: DataFrame, rule: AlertRule = AlertRule(), watermark: str = "1 minute",
                   ts: str = "event_time") -> DataFrame:
    """Alerts at the end of every micro-batch, without waiting for the watermark.

    For devices with new events, the last ``rule.window`` up to their newest event is judged.
    ``uids`` are all accounts with coupons in that time. Assumes batches arrive in time order per
    device; the windowed form is exact for any order.
    """
    k, evid = rule.min_uids, F.col("evid")
    when = F.unix_millis(ts)
    slim = events.where(F.col("mid").isNotNull()).select(
        F.col("mid").cast("string").alias("mid"),
        F.when(is_coupon(rule, evid), F.col("uid").cast("string")).alias("uid"),
        F.when(is_coupon(rule, evid), when).alias("coupon_ms"),
        F.when(is_browse(rule, evid), when).alias("browse_ms"),
        when.alias("seen_ms"),
        F.col(ts).alias("at"),
    )

    def shrink(pdf: pd.DataFrame) -> pd.DataFrame:
        times = pdf.groupby("mid", as_index=False, dropna=False)[["browse_ms", "seen_ms"]].max()
        last = (
            pdf.dropna(subset=["uid", "coupon_ms"])
            .groupby(["mid", "uid"], as_index=False, dropna=False)["coupon_ms"].max()
        )
        out = pd.concat([times, last], ignore_index=True)
        for c in ("coupon_ms", "browse_ms", "seen_ms"):
            out[c] = out[c].astype("Int64")
        # Every kept row carries the device's newest time, so none of them counts as late.
        newest = pdf.groupby("mid", dropna=False)["at"].max()
        out["at"] = out["mid"].map(newest)
        return out[RECENT.fieldNames()]

    return _shrink(slim, shrink, RECENT).withWatermark("at", watermark).groupBy("mid").transformWithStateInPandas(
        statefulProcessor=RecentCoupons(k, 1000 * seconds_of(rule.window)),
        outputStructType=RECENT_ALERT,
        outputMode="Append",
        timeMode="EventTime",
    )
