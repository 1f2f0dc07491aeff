"""Row types of the logs, change records and result tables.

Numbers inside JSON change records are quoted, so source fields are strings here and are
converted with ``try_cast`` after decoding.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Field names of the wire formats, in their natural order.
STARTUP_FIELDS = ("mid", "uid", "appid", "area", "os", "ch", "type", "vs")
EVENT_FIELDS = ("mid", "uid", "appid", "area", "os", "type", "evid", "pgid", "npgid", "itemid")
ORDER_FIELDS = (
    "id", "province_id", "consignee", "order_comment", "consignee_tel", "order_status",
    "payment_way", "user_id", "img_url", "total_amount", "expire_time", "delivery_address",
    "create_time", "operate_time", "tracking_no", "parent_order_id", "out_trade_no", "trade_body",
)
DETAIL_FIELDS = ("id", "order_id", "sku_name", "sku_id", "order_price", "img_url", "sku_num")
USER_FIELDS = ("id", "login_name", "user_level", "birthday", "gender")
SALE_DETAIL_FIELDS = (
    "order_detail_id", "order_id", "order_status", "create_time", "user_id", "sku_id",
    "user_gender", "user_age", "user_level", "sku_price", "sku_name", "dt",
)
DAU_COLUMNS = ("mid", "uid", "appid", "area", "os", "ch", "type", "vs", "logdate", "loghour", "ts")


def strings(names: tuple[str, ...]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# ``ts`` is read as a string too: a quoted number in a bigint field would decode to null.
STARTUP_LOG = strings(STARTUP_FIELDS + ("ts",))
EVENT_LOG = strings(EVENT_FIELDS + ("ts",))
ORDER_INFO = strings(ORDER_FIELDS)
ORDER_DETAIL = strings(DETAIL_FIELDS)
USER_INFO = strings(USER_FIELDS)

CHANGE_LOG = T.StructType([
    T.StructField("table", T.StringType()),
    T.StructField("op", T.StringType()),
    T.StructField("after", T.MapType(T.StringType(), T.StringType())),
])

# Casts applied after decoding, per row type.
STARTUP_CASTS = {"ts": "bigint"}
EVENT_CASTS = {"ts": "bigint"}
ORDER_CASTS = {"total_amount": "decimal(18,2)"}
DETAIL_CASTS = {"order_price": "decimal(18,2)", "sku_num": "bigint"}
USER_CASTS = {"birthday": "date"}
