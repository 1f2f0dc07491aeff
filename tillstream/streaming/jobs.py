"""The jobs. Each takes decoded-text streams (``value``, ``arrival``) and a root folder.

Sources are passed in, so the same job runs on Kafka, on files or in a test. Delivery: the
offsets live in the checkpoint and every sink replaces what a replayed batch wrote before. The
lines a job cannot use go to ``quarantine/<job>``: by the same query where the job keeps no state,
else by a second one.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tillstream import schemas
from tillstream.config import Settings
from tillstream.functions import day_of, minute_doc_id
from tillstream.operators import alerts as alert_rules, ingest
from tillstream.operators.dedup import is_seen
from tillstream.operators.joins import enrich_with_users, two_level_users
from tillstream.streaming.probe import probe
from tillstream.sources import changelog
from tillstream.streaming.sinks import KeyedTable, upper_names
from tillstream.streaming.stateful import (
    daily_first_updates, instant_alerts, orders_with_lines, pane_alerts,
)


def _named(columns: tuple[str, ...], **kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(c, kinds.get(c, T.StringType())) for c in columns])


LONG = T.LongType()
DAU_TABLE = _named(schemas.DAU_COLUMNS, ts=LONG)
ORDER_TABLE = _named(
    schemas.ORDER_FIELDS + ("create_date", "create_hour"), total_amount=T.DecimalType(18, 2)
)
USER_TABLE = _named(schemas.USER_FIELDS + ("bucket",), birthday=T.DateType(), bucket=T.IntegerType())
SALE_TABLE = _named(schemas.SALE_DETAIL_FIELDS, user_age=T.IntegerType(), sku_price=T.DoubleType())
ALERT_TABLE = _named(("doc_id", "mid", "ts", "n_uids", "n_events", "dt"), ts=LONG, n_uids=LONG, n_events=LONG)
DEVICE_TABLE = _named(("mid", "first_day", "bucket"), bucket=T.IntegerType())
FIRST_SEEN_TABLE = _named(("mid", "is_first", "dt"), is_first=T.BooleanType())
RECENT_TABLE = _named(("doc_id", "mid", "uids", "ts", "dt"), uids=T.ArrayType(T.StringType()), ts=LONG)


def dau_table(root: str, settings: Settings = Settings()) -> KeyedTable:
    return KeyedTable(f"{root}/{settings.tables.dau}", ("mid",), "logdate", ("ts", "uid"), earliest=True)


def order_table(root: str, settings: Settings = Settings()) -> KeyedTable:
    return KeyedTable(f"{root}/{settings.tables.order_info}", ("id",), "create_date", ("create_time",))


def user_table(root: str, settings: Settings = Settings()) -> KeyedTable:
    """Users lie in buckets by a hash of their id, so that a batch reads those of its own users."""
    return KeyedTable(f"{root}/{settings.tables.user_info}", ("id",), "bucket", ("arrival",))


def device_table(root: str, settings: Settings = Settings()) -> KeyedTable:
    """First day of every device, in buckets by a hash of the device."""
    return KeyedTable(f"{root}/{settings.tables.device}", ("mid",), "bucket", ("first_day",), earliest=True)


def first_seen_table(root: str, settings: Settings = Settings()) -> KeyedTable:
    """Devices by the day that is, or for a time was taken for, their first one."""
    return KeyedTable(f"{root}/{settings.tables.first_seen}", ("mid",), "dt")


def sale_table(root: str, settings: Settings = Settings()) -> KeyedTable:
    return KeyedTable(f"{root}/{settings.tables.sale_detail}", ("order_detail_id",), "dt", ("create_time",))


def alert_table(root: str, settings: Settings = Settings()) -> KeyedTable:
    return KeyedTable(f"{root}/{settings.tables.alert}", ("doc_id",), "dt", ("ts",))


def instant_alert_table(root: str, settings: Settings = Settings()) -> KeyedTable:
    return KeyedTable(f"{root}/{settings.tables.instant_alert}", ("doc_id",), "dt", ("ts",))


def bucket_of(key: str, settings: Settings = Settings()) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(settings.buckets)).cast("int")


def _buckets(df: DataFrame, key: str, settings: Settings) -> list[int]:
    """Buckets of the keys in a batch, at most ``settings.buckets`` numbers."""
    return [r.b for r in df.select(bucket_of(key, settings).alias("b")).distinct().collect()]


def _query_id(spark: SparkSession, root: str, name: str) -> str:
    """The id that its checkpoint gave the query."""
    return json.loads(spark.read.text(f"{_checkpoint(root, name)}/metadata").first().value)["id"]


#: Takes a micro-batch and its number.
Write = Callable[[DataFrame, int], None]


def _checkpoint(root: str, name: str) -> str:
    return f"{root}/_checkpoints/{name}"


def _into(table: KeyedTable, root: str, name: str) -> Write:
    """Batch writer under the id that the checkpoint gave the query, looked up at the first batch."""
    own: list[KeyedTable] = []

    def write(df: DataFrame, batch_id: int) -> None:
        if not own:
            own.append(table.of_writer(_query_id(df.sparkSession, root, name)))
        own[0].write_batch(df, batch_id)

    return write


def quarantine_job(lines: DataFrame, kind: str, root: str, name: str, interval: str, once: bool = False) -> StreamingQuery:
    """Lines that the decoder of ``kind`` rejects, with the reason, appended as JSON."""
    job = f"quarantine/{name}"
    writer = ingest.rejected(lines, kind).writeStream.format("json").option("path", f"{root}/{job}")
    query = _start(writer, root, job.replace("/", "_"), interval, once)
    if once:
        query.awaitTermination()
    return query


def _start_split(lines: DataFrame, kind: str, good: Callable[[DataFrame], DataFrame], write: Write, root: str, name: str,
                 interval: str, once: bool) -> StreamingQuery:
    """One query for a job without state: ``write`` takes the ``good`` rows of each batch, the quarantine the rest.

    The rejected lines of a batch are a folder of its own, which a replay replaces; a batch without any has none.
    """

    def batch(df: DataFrame, batch_id: int) -> None:
        spark, df = df.sparkSession, df.persist()
        bad = ingest.rejected(df, kind)
        if not bad.isEmpty():
            path = f"{root}/quarantine/{name}/batch={_query_id(spark, root, name)}.{batch_id}"
            bad.write.mode("overwrite").json(path)
        write(good(df), batch_id)
        df.unpersist()

    return _start(lines.writeStream.foreachBatch(batch), root, name, interval, once)


def _start(writer: DataStreamWriter, root: str, name: str, interval: str, once: bool) -> StreamingQuery:
    writer = writer.option("checkpointLocation", _checkpoint(root, name)).queryName(name)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)).start()


def dau_job(lines: DataFrame, root: str, settings: Settings = Settings(),
            once: bool = False) -> StreamingQuery:
    """Startup lines to one row per device and day.

    Stages counted by batch: rows ``decoded``, rows ``unseen`` (of devices not known for their day before the
    batch), and ``first``, the rows given out.
    """
    quarantine_job(lines, "startup", root, "dau", settings.intervals.dau, once)
    logs = probe(ingest.startup_rows(lines).where(F.col("event_time").isNotNull()), "decoded")
    first = daily_first_updates(logs, ["ts", "uid"], unseen="unseen")
    rows = first.withColumnsRenamed({"log_date": "logdate", "log_hour": "loghour"}).select(*schemas.DAU_COLUMNS)
    store = _into(dau_table(root, settings), root, "dau")
    note = first_seen_writer(root, settings, *[
        _into(table(root, settings), root, "dau") for table in (first_seen_table, device_table)])

    def write(df: DataFrame, batch_id: int) -> None:
        df = df.persist()
        store(df, batch_id)
        note(df, batch_id)
        df.unpersist()

    writer = probe(rows, "first").writeStream.outputMode("update").foreachBatch(write)
    return _start(writer, root, "dau", settings.intervals.dau, once)


def first_seen_writer(root: str, settings: Settings, by_day: Write, by_device: Write) -> Write:
    """Batch writer that keeps the first day of every device, and the devices by first day.

    Takes rows with ``mid`` and ``logdate``; ``by_day`` and ``by_device`` write the two tables. Only the
    buckets of the batch's devices are read. A device that turns out to have an earlier first day is taken
    back from the day it was counted on. The table by device is written last: a batch replayed before
    that finds it as the batch did.
    """

    def write(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        fresh = df.where("mid is not null and logdate is not null").groupBy("mid").agg(F.min("logdate").alias("first_day"))
        known = device_table(root, settings).read(spark, DEVICE_TABLE, _buckets(df, "mid", settings)).select(
            "mid", F.col("first_day").alias("known_day"))
        moved = fresh.join(known, "mid", "left").where("known_day is null or first_day < known_day").persist()
        by_day(
            moved.select("mid", F.lit(True).alias("is_first"), F.col("first_day").alias("dt")).unionByName(
                moved.where("known_day is not null").select(
                    "mid", F.lit(False).alias("is_first"), F.col("known_day").alias("dt"))), batch_id)
        by_device(moved.select("mid", "first_day", bucket_of("mid", settings).alias("bucket")), batch_id)
        moved.unpersist()

    return write


def new_devices(spark: SparkSession, root: str, day: str, settings: Settings = Settings()) -> DataFrame:
    """Number of devices whose first day is the given one, as ``n``. Reads that day's folders only."""
    rows = first_seen_table(root, settings).read(spark, FIRST_SEEN_TABLE, [day])
    return rows.agg(F.count_if("is_first").alias("n"))


def gmv_job(lines: DataFrame, root: str, settings: Settings = Settings(),
            once: bool = False, upper: bool = False) -> StreamingQuery:
    """Order records to the order table.

    With ``upper`` the stored columns have upper-case names, as wide-column stores expect them.
    """
    table = order_table(root, settings)
    if upper:
        table = replace(table, keys=("ID",), day="CREATE_DATE", order=("CREATE_TIME",))

    def orders(df: DataFrame) -> DataFrame:
        rows = ingest.order_rows(df).select(*ORDER_TABLE.fieldNames())
        return upper_names(rows) if upper else rows

    return _start_split(lines, "order", orders, _into(table, root, "gmv"), root, "gmv", settings.intervals.gmv, once)


def user_job(lines: DataFrame, root: str, settings: Settings = Settings(),
             once: bool = False) -> StreamingQuery:
    """User records to the user table: the newest row per user wins."""

    def users(df: DataFrame) -> DataFrame:
        return ingest.user_rows(df, keep=("arrival",)).withColumn("bucket", bucket_of("id", settings)).select(
            "arrival", *USER_TABLE.fieldNames())

    write = _into(user_table(root, settings), root, "user")
    return _start_split(lines, "user", users, write, root, "user", settings.intervals.user, once)


def load_users(users: DataFrame, root: str, settings: Settings = Settings(), load: int = 0) -> None:
    """Put all users of the base table into the user table, behind any row of the change stream.

    A later load needs a higher number; the same number again changes nothing.
    """
    rows = users.select(*schemas.USER_FIELDS).withColumns({
        "bucket": bucket_of("id", settings), "arrival": F.lit(None).cast("timestamp")})
    replace(user_table(root, settings).of_writer("base"), epoch=-1).write_batch(rows, load)


#: Users of a base table by their ids, looked up in each batch: from (session, rows with ``id``).
BaseUsers = Callable[[SparkSession, DataFrame], DataFrame]


def users_of(spark: SparkSession, root: str, ids: DataFrame, settings: Settings = Settings(),
             base: DataFrame | BaseUsers | None = None) -> DataFrame:
    """Newest user rows of the given ids (``id``), as they are now.

    Only the buckets of these ids are read. Ids the table does not know are looked up in ``base``; with
    :func:`load_users` the table knows all and needs none.
    """
    ids = ids.select("id").where("id is not null").distinct()
    stored = user_table(root, settings).read(spark, USER_TABLE, _buckets(ids, "id", settings)).select(*schemas.USER_FIELDS)
    found = is_seen(stored, ids, ["id"], salts=1)
    if base is None:
        return found
    rows = is_seen(base.select(*schemas.USER_FIELDS), ids, ["id"], salts=1) if isinstance(base, DataFrame) else base(spark, ids)
    return two_level_users(found, rows.select(*schemas.USER_FIELDS))


def sale_detail_job(order_lines: DataFrame, detail_lines: DataFrame, root: str,
                    base_users: DataFrame | BaseUsers | None = None, as_of: Column | None = None,
                    settings: Settings = Settings(), once: bool = False) -> StreamingQuery:
    """Orders meet their lines, get their buyer, and are stored under the line id.

    Buyers are looked up anew in every batch, so changes count while the job runs.
    """
    quarantine_job(order_lines, "order", root, "sale_detail_orders", settings.intervals.sale_detail, once)
    quarantine_job(detail_lines, "detail", root, "sale_detail_lines", settings.intervals.sale_detail, once)
    orders = ingest.order_rows(order_lines, keep=("arrival",)).select(
        F.col("id").alias("o_id"), "order_status", "create_time", "user_id",
        F.col("create_date").alias("dt"), F.col("arrival").alias("order_arrival"),
    )
    details = ingest.detail_rows(detail_lines, keep=("arrival",)).select(
        F.col("id").alias("order_detail_id"), "order_id", "sku_id", "sku_name",
        F.col("order_price").cast("double").alias("sku_price"), F.col("arrival").alias("detail_arrival"),
    )
    sales = orders_with_lines(orders, details, settings.join, order_key="o_id").drop("o_id")
    store = _into(sale_table(root, settings), root, "sale_detail")

    def write(df: DataFrame, batch_id: int) -> None:
        # Inside a batch the plan is adaptive: skewed buyers are split, sizes decide the join.
        df = df.persist()
        users = users_of(df.sparkSession, root, df.select(F.col("user_id").alias("id")), settings, base_users)
        store(enrich_with_users(df, users, as_of).select(*SALE_TABLE.fieldNames()), batch_id)
        df.unpersist()

    return _start(sales.writeStream.foreachBatch(write), root, "sale_detail", settings.intervals.sale_detail, once)


def alert_job(lines: DataFrame, root: str, settings: Settings = Settings(),
              watermark: str = "1 minute", once: bool = False) -> StreamingQuery:
    """Event lines to alerts of closed windows, one per device and minute.

    The events themselves are appended by day beside the alerts; :func:`alert_members` reads both.
    """
    quarantine_job(lines, "event", root, "alert", settings.intervals.alert, once)
    land_events(lines, root, settings, once)
    events = ingest.event_rows(lines).where(F.col("event_time").isNotNull())
    alerts = pane_alerts(events, settings.alert, watermark)
    docs = alerts.select(
        minute_doc_id(F.col("mid"), F.col("window_end")).alias("doc_id"), "mid",
        F.unix_millis("window_end").alias("ts"), "n_uids", "n_events",
        day_of(F.col("window_end")).alias("dt"),
    )
    return _start(docs.writeStream.foreachBatch(_into(alert_table(root, settings), root, "alert")), root, "alert", settings.intervals.alert, once)


def instant_alert_job(lines: DataFrame, root: str, settings: Settings = Settings(),
                      once: bool = False) -> StreamingQuery:
    """The same rule judged at the end of every micro-batch."""
    quarantine_job(lines, "event", root, "instant_alert", settings.intervals.alert, once)
    alerts = instant_alerts(ingest.event_rows(lines).where(F.col("event_time").isNotNull()), settings.alert)
    at = F.timestamp_millis("ts")
    docs = alerts.select(
        minute_doc_id(F.col("mid"), at).alias("doc_id"), "mid", "uids", "ts", day_of(at).alias("dt"),
    )
    write = _into(instant_alert_table(root, settings), root, "instant_alert")
    return _start(docs.writeStream.foreachBatch(write), root, "instant_alert", settings.intervals.alert, once)


def land_events(lines: DataFrame, root: str, settings: Settings = Settings(), once: bool = False) -> StreamingQuery:
    """Decoded events with a time, appended as Parquet below one folder per day."""
    events = ingest.event_rows(lines).where(F.col("event_time").isNotNull()).withColumn("dt", F.col("log_date"))
    writer = events.writeStream.format("parquet").partitionBy("dt").option("path", f"{root}/{settings.tables.event}")
    query = _start(writer, root, "event_log", settings.intervals.alert, once)
    if once:
        query.awaitTermination()
    return query


def alert_members(spark: SparkSession, root: str, settings: Settings = Settings(), days: list[str] | None = None) -> DataFrame:
    """All accounts, items and events behind the stored alerts, of the days of their ends or of all.

    Only the days that such windows can touch are read.
    """
    rule = settings.alert
    width = F.make_dt_interval(secs=F.lit(alert_rules.seconds_of(rule.window)))
    end = F.timestamp_millis("ts")
    found = alert_table(root, settings).read(spark, ALERT_TABLE, days).select(
        "mid", (end - width).alias("window_start"), end.alias("window_end"))
    events = spark.read.parquet(f"{root}/{settings.tables.event}")
    if days is not None:
        earliest = F.to_date(F.lit(min(days)).cast("timestamp") - width)
        events = events.where((F.to_date("dt") >= earliest) & (F.to_date("dt") <= F.lit(max(days)).cast("date")))
    return alert_rules.alert_members(found, events, rule, order=("ts", "uid", "itemid"))


Send = Callable[[DataFrame], None]


def intake_job(lines: DataFrame, root: str, send: Send, settings: Settings = Settings(), clock: Column | None = None,
               once: bool = False) -> StreamingQuery:
    """Raw log lines: stamp, land by day, route to the two log topics.

    ``send`` takes a batch of ``(topic, value)`` records, for example to the broker. A line that is
    no JSON object has no stamp; it lands under the unknown day and goes to the event topic, whose
    decoder puts it into quarantine.
    """
    stamped = ingest.stamp_line(lines, clock)
    kind = F.get_json_object("value", "$.type")
    routed = ingest.route_by_type(stamped, settings.topics, kind).select("topic", "value")

    def write(df: DataFrame, batch_id: int) -> None:
        # The stamp must be the same for both uses.
        df = df.persist()
        day = day_of(F.timestamp_millis(F.get_json_object("value", "$.ts").try_cast("bigint")))
        (
            df.select("value", day.alias("log_date"), F.lit(int(batch_id)).alias("batch")).write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic").partitionBy("log_date", "batch").text(f"{root}/{settings.tables.log}")
        )
        send(df)
        df.unpersist()

    return _start(routed.writeStream.foreachBatch(write), root, "intake", settings.intervals.dau, once)


def change_job(lines: DataFrame, root: str, send: Send, settings: Settings = Settings(), once: bool = False) -> StreamingQuery:
    """Change records to the topics of orders, order lines and users."""

    def records(df: DataFrame) -> DataFrame:
        return changelog.topic_records(df, settings.topics)

    return _start_split(lines, "change", records, lambda df, _: send(df), root, "change", settings.intervals.user, once)
