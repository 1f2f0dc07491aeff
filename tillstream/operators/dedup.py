"""First row per key, newest row per key, and filters by keys seen before."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tillstream.operators.skew import join_spread

Keys = list[str]
UNORDERED = (T.MapType, T.VariantType)


def _pick(df: DataFrame, keys: Keys, order: Keys, pick, pick_by, unknown_last: bool = False) -> DataFrame:
    order = [c for c in order if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order]
    if not order and not rest:
        return df.select(*keys).distinct().select(*df.columns)
    if order and any(isinstance(df.schema[c].dataType, UNORDERED) for c in rest):
        row = pick_by(F.struct(*order, *rest), F.struct(*_ranked(order, unknown_last)))
    else:
        # Equal order values are told apart by the other columns, so reruns give the same row.
        row = pick(F.struct(*_ranked(order, unknown_last), *rest))
    return df.groupBy(*keys).agg(row.alias("_row")).select(*keys, "_row.*").select(*df.columns)


def _ranked(order: Keys, unknown_last: bool) -> list[Column]:
    """Order columns, each behind a flag that puts its nulls last."""
    if not unknown_last:
        return [F.col(c) for c in order]
    return [x for i, c in enumerate(order) for x in (F.col(c).isNull().alias(f"_unknown_{i}"), F.col(c))]


def first_per_key(df: DataFrame, keys: Keys, order: Keys) -> DataFrame:
    """The first row of every key in the order of the given columns, with all columns.

    A minimum over whole rows, not a ranking: it is taken in the map tasks first, so a key that
    holds a large part of the table sends one row per map task, and nothing is sorted by time.
    A null order value comes last.
    """
    return _pick(df, keys, order, F.min, F.min_by, unknown_last=True)


def latest_by_key(df: DataFrame, keys: Keys, order: Keys) -> DataFrame:
    """The newest row of every key; the ``order`` columns ascend with time."""
    return _pick(df, keys, order, F.max, F.max_by)


def daily_first(logs: DataFrame, order: Keys, day: str = "log_date", device: str = "mid") -> DataFrame:
    """Earliest log of every device on every day."""
    return first_per_key(logs, [day, device], order)


def first_visit_times(logs: DataFrame, ts: str, day: Column, device: str = "mid") -> DataFrame:
    """Day, device and time of the first visit only.

    When the rest of the row is not wanted a hash aggregate is enough: no sort, and each map
    task sends one small row per device and day.
    """
    return logs.groupBy(day.alias("log_date"), device).agg(F.min(ts).alias("first_ts"))


def not_seen(df: DataFrame, seen: DataFrame, keys: Keys, salts: int | None = None) -> DataFrame:
    """Rows whose key is not in ``seen``.

    The seen keys are made distinct first, so a repeated key weighs nothing in the join; the
    rows of a heavy key are spread over several tasks (see :func:`join_spread`).
    """
    return join_spread(df, seen.select(*keys).distinct(), keys, "left_anti", salts)


def is_seen(df: DataFrame, seen: DataFrame, keys: Keys, salts: int | None = None) -> DataFrame:
    """Rows whose key is in ``seen``."""
    return join_spread(df, seen.select(*keys).distinct(), keys, "left_semi", salts)
