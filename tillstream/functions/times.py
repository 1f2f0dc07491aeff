"""Day, hour and minute columns. All are built-in expressions and stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def ms_to_time(ms: Column) -> Column:
    """Epoch milliseconds to a timestamp."""
    return F.timestamp_millis(ms)


def day_of(ts: Column) -> Column:
    """``yyyy-MM-dd`` text of a timestamp (with or without zone)."""
    return F.to_date(ts).cast("string")


def hour_of(ts: Column) -> Column:
    """Two-digit hour text ``00`` .. ``23``."""
    return F.lpad(F.hour(ts).cast("string"), 2, "0")


def with_log_parts(df: DataFrame, ts_ms: str = "ts") -> DataFrame:
    """Add ``event_time``, ``log_date`` and ``log_hour`` from an epoch-millisecond column."""
    time = ms_to_time(F.col(ts_ms))
    return df.withColumns({"event_time": time, "log_date": day_of(time), "log_hour": hour_of(time)})


def with_create_parts(df: DataFrame, create_time: str = "create_time") -> DataFrame:
    """Split a ``yyyy-MM-dd HH:mm:ss`` text into ``create_date`` and ``create_hour``.

    A missing or short text gives null parts instead of failing the task.
    """
    day_and_clock = F.split(F.col(create_time), " ")
    clock = F.get(day_and_clock, F.lit(1))
    return df.withColumns({
        "create_date": F.get(day_and_clock, F.lit(0)),
        "create_hour": F.get(F.split(clock, ":"), F.lit(0)),
    })


def prev_day(day: Column) -> Column:
    """The day before, as ``yyyy-MM-dd`` text."""
    return F.date_sub(F.to_date(day), 1).cast("string")


def current_day() -> Column:
    """Today as text; operators take the day as a parameter and use this as default."""
    return F.current_date().cast("string")


def minute_doc_id(key: Column, ts: Column) -> Column:
    """``key-yyyy-MM-dd HH:mm``: one document per key and minute."""
    minute = F.concat_ws(
        ":",
        hour_of(ts),
        F.lpad(F.minute(ts).cast("string"), 2, "0"),
    )
    return F.concat_ws("-", key, F.concat_ws(" ", day_of(ts), minute))
