"""Decode, stamp, route: from raw JSON lines and change records to typed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tillstream import schemas
from tillstream.config import DETAIL_TABLE, ORDER_TABLE, STARTUP_TYPE, USER_TABLE, Topics
from tillstream.functions import mask_phone, with_create_parts, with_log_parts

CORRUPT = "_corrupt"
#: Schema, casts and required fields of the rows of each kind.
KINDS: dict[str, tuple[T.StructType, dict[str, str], tuple[str, ...]]] = {
    "startup": (schemas.STARTUP_LOG, schemas.STARTUP_CASTS, ("ts",)),
    "event": (schemas.EVENT_LOG, schemas.EVENT_CASTS, ("ts",)),
    "order": (schemas.ORDER_INFO, schemas.ORDER_CASTS, ()),
    "detail": (schemas.ORDER_DETAIL, schemas.DETAIL_CASTS, ()),
    "user": (schemas.USER_INFO, schemas.USER_CASTS, ()),
    "change": (schemas.CHANGE_LOG, {}, ("table", "op")),
}


def decode(df: DataFrame, schema: T.StructType, casts: dict[str, str] | None = None,
           value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """JSON text column to typed columns, plus ``_corrupt`` holding the text of a bad row.

    A row is bad when its text is not a JSON object, or when a field named in ``casts`` is
    present but cannot be converted. Split the result with :func:`good_rows` and
    :func:`quarantine`.
    """
    casts = casts or {}
    permissive = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    parsed = df.withColumn(
        "_row", F.from_json(F.col(value), permissive, {"columnNameOfCorruptRecord": CORRUPT})
    )
    columns: list[Column] = [F.col(k) for k in keep]
    failed = F.col(f"_row.{CORRUPT}").isNotNull() | F.col("_row").isNull()
    for name in schema.fieldNames():
        raw = F.col(f"_row.`{name}`")
        if name in casts:
            typed = raw.try_cast(casts[name])
            failed = failed | (raw.isNotNull() & typed.isNull())
            columns.append(typed.alias(name))
        else:
            columns.append(raw.alias(name))
    columns.append(F.when(failed, F.coalesce(F.col(value), F.lit(""))).alias(CORRUPT))
    return parsed.select(*columns)


def good_rows(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def quarantine(decoded: DataFrame) -> DataFrame:
    """Texts of the rows that could not be decoded."""
    return decoded.where(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("value"))


def rejected(df: DataFrame, kind: str) -> DataFrame:
    """``(kind, reason, value)`` of the lines that the decoder of this kind does not pass on.

    Kinds are ``startup``, ``event``, ``order``, ``detail``, ``user`` and ``change``. Log lines need a
    time and change records a table and a kind of change; every other line is passed on.
    """
    schema, casts, needed = KINDS[kind]
    bad = decode(df, schema, casts, keep=("value",))
    missing = F.lit(False)
    for name in needed:
        missing = missing | F.col(name).isNull()
    reason = F.when(F.col(CORRUPT).isNotNull(), "not readable").when(missing, f"without {' or '.join(needed)}")
    return bad.select(F.lit(kind).alias("kind"), reason.alias("reason"), F.coalesce("value", F.lit("")).alias("value")).where(
        F.col("reason").isNotNull())


def encode(df: DataFrame, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Whole row to one JSON text column."""
    return df.select(*keep, F.to_json(F.struct("*")).alias(value))


def startup_rows(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Startup log lines to rows with day and hour."""
    rows = good_rows(decode(df, schemas.STARTUP_LOG, schemas.STARTUP_CASTS, keep=keep))
    return with_log_parts(rows)


def event_rows(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Event log lines to rows with day and hour."""
    return with_log_parts(good_rows(decode(df, schemas.EVENT_LOG, schemas.EVENT_CASTS, keep=keep)))


def order_rows(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Order records with creation day and hour and a masked phone number."""
    rows = good_rows(decode(df, schemas.ORDER_INFO, schemas.ORDER_CASTS, keep=keep))
    return with_create_parts(rows).withColumn("consignee_tel", mask_phone(F.col("consignee_tel")))


def detail_rows(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return good_rows(decode(df, schemas.ORDER_DETAIL, schemas.DETAIL_CASTS, keep=keep))


def user_rows(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return good_rows(decode(df, schemas.USER_INFO, schemas.USER_CASTS, keep=keep))


def stamp(df: DataFrame, clock: Column | None = None) -> DataFrame:
    """Put the receiving time in milliseconds as ``ts``, over any existing value."""
    return df.withColumn("ts", F.unix_millis(F.current_timestamp()) if clock is None else clock)


def stamp_line(df: DataFrame, clock: Column | None = None, value: str = "value") -> DataFrame:
    """Stamp raw JSON lines: the object is read as a map, ``ts`` replaced, written back.

    All values come back as JSON strings, which the decoders accept. A line that is not an
    object is passed on unchanged, so that the decoder puts it into quarantine.
    """
    now = F.unix_millis(F.current_timestamp()) if clock is None else clock
    fields = F.from_json(F.col(value), T.MapType(T.StringType(), T.StringType()))
    others = F.map_filter(fields, lambda k, _: k != "ts")
    stamped = F.map_concat(others, F.create_map(F.lit("ts"), now.cast("string")))
    return df.withColumn(value, F.coalesce(F.to_json(stamped), F.col(value)))


def route_by_type(df: DataFrame, topics: Topics = Topics(), kind: Column | None = None) -> DataFrame:
    """Add ``topic``: startup lines to one topic, everything else (also null) to the other."""
    kind = F.col("type") if kind is None else kind
    is_startup = kind.eqNullSafe(F.lit(STARTUP_TYPE))
    return df.withColumn("topic", F.when(is_startup, topics.startup).otherwise(topics.event))


def route_changes(changes: DataFrame, topics: Topics = Topics()) -> DataFrame:
    """Keep the change records that are forwarded and name their topic.

    New orders and new order lines; new and changed users. All else is dropped, deletions
    and order updates included: sales count orders as created.
    """
    table, op = F.col("table"), F.col("op")
    topic = (
        F.when((table == ORDER_TABLE) & (op == "INSERT"), topics.order_info)
        .when((table == DETAIL_TABLE) & (op == "INSERT"), topics.order_detail)
        .when((table == USER_TABLE) & op.isin("INSERT", "UPDATE"), topics.user_info)
    )
    return changes.withColumn("topic", topic).where(F.col("topic").isNotNull())


def after_image(routed: DataFrame, after: str = "after") -> DataFrame:
    """After-image map to a flat JSON object of strings: the record sent to ``topic``."""
    others = [c for c in routed.columns if c not in (after, "table", "op")]
    return routed.select(*others, F.to_json(F.col(after)).alias("value"))
