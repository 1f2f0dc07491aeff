"""Names, durations and thresholds. Every value can be overridden by the caller."""

from __future__ import annotations

from dataclasses import dataclass, field

# Log type, event ids, change kinds, windows and thresholds of the domain.
STARTUP_TYPE = "startup"
EVENT_TYPE = "event"
COUPON_EVENT = "coupon"
BROWSE_EVENT = "clickItem"
ORDER_TABLE = "order_info"
DETAIL_TABLE = "order_detail"
USER_TABLE = "user_info"
METRIC_DAU = "dau"
METRIC_NEW_DEVICE = "new_mid"
METRIC_ORDER_AMOUNT = "order_amount"
GENDER_MALE = "M"
YOUNG_BELOW = 20
SENIOR_FROM = 30
PHONE_PREFIX = 4
PHONE_MASK = "*******"


@dataclass(frozen=True)
class Topics:
    """Topic names. The two log topics carry a deployment's own name."""

    startup: str = "TOPIC_STARTUP"
    event: str = "TOPIC_EVENT"
    order_info: str = "TOPIC_ORDER_INFO"
    order_detail: str = "TOPIC_ORDER_DETAIL"
    user_info: str = "TOPIC_USER_INFO"


@dataclass(frozen=True)
class Tables:
    """Names of the written tables, one folder each below the warehouse root."""

    dau: str = "dau"
    order_info: str = "order_info"
    user_info: str = "user_info"
    device: str = "device"
    first_seen: str = "first_seen"
    alert: str = "coupon_alert"
    instant_alert: str = "instant_coupon_alert"
    event: str = "event_log"
    log: str = "raw_log"
    sale_detail: str = "sale_detail"


@dataclass(frozen=True)
class Intervals:
    """Micro-batch intervals of the five jobs."""

    dau: str = "3 seconds"
    gmv: str = "3 seconds"
    alert: str = "5 seconds"
    sale_detail: str = "5 seconds"
    user: str = "5 seconds"


@dataclass(frozen=True)
class JoinBound:
    """How long an order and its lines wait for each other."""

    seconds: int = 100
    watermark: str = "100 seconds"
    salts: int = 8


@dataclass(frozen=True)
class AlertRule:
    """At least ``min_uids`` accounts take coupons on one device, nothing browsed.

    ``slide`` equal to ``window`` gives tumbling windows; it must divide ``window``.
    """

    window: str = "5 minutes"
    slide: str = "1 minute"
    min_uids: int = 3
    coupon: tuple[str, ...] = (COUPON_EVENT,)
    browse: tuple[str, ...] = (BROWSE_EVENT,)


@dataclass(frozen=True)
class Settings:
    """``buckets`` is the number of folders of the tables that are looked up by user or device."""

    topics: Topics = field(default_factory=Topics)
    tables: Tables = field(default_factory=Tables)
    intervals: Intervals = field(default_factory=Intervals)
    join: JoinBound = field(default_factory=JoinBound)
    alert: AlertRule = field(default_factory=AlertRule)
    buckets: int = 64
