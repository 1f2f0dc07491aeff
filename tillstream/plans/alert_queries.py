"""The alert rule over the whole event table."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tillstream.functions import day_of
from tillstream.operators import alerts
from tillstream.plans.catalog import query
from tillstream.sources import domain
from tillstream.sources.files import table

LOGS_SQL = """
select event_id, json_extract_string(props, '$.k') as mid, user_id as uid, event_type as evid,
       cast(cast(floor(value) as bigint) as varchar) as itemid, ts from events
"""
COUNTS_SQL = """
count(*) as n_events, count(*) filter (evid = 'view') as n_browse,
count(distinct case when evid in ('purchase', 'click') then uid end) as n_uids
"""
DAILY_SQL = f"""
select mid, date_trunc('day', ts)::timestamp as window_start, {COUNTS_SQL} from ({LOGS_SQL}) group by 1, 2
"""
SLIDING_SQL = f"""
select mid, window_start, {COUNTS_SQL} from (
  select *, time_bucket(interval 6 hours, ts) - to_hours(6 * k::int) as window_start from ({LOGS_SQL}), range(4) r(k)
) group by 1, 2
"""
TEXT = "strftime({}, '%Y-%m-%d %H:%M:%S')"


def logs(spark, folder):
    return domain.event_logs(table(spark, folder, "events"))


def _text(ts: str) -> Column:
    return F.substring(F.col(ts).cast("string"), 1, 19)


def _shown(rows):
    return rows.withColumns({"window_start": _text("window_start"), "window_end": _text("window_end")})


def _fired_sql(counts: str) -> str:
    return f"""
select mid, {TEXT.format('window_start')} as window_start,
       {TEXT.format('window_start + interval 1 day')} as window_end, n_uids, n_events
from ({counts}) where n_uids >= 3 and n_browse = 0
"""


@query(_fired_sql(DAILY_SQL))
def coupon_alert(spark, folder):
    return _shown(alerts.coupon_alerts(logs(spark, folder), domain.DAILY_RULE))


@query(_fired_sql(SLIDING_SQL))
def sliding_window_alert(spark, folder):
    return _shown(alerts.coupon_alerts(logs(spark, folder), domain.SLIDING_RULE))


@query(f"select mid, strftime(window_start, '%Y-%m-%d') as day, n_uids from ({DAILY_SQL}) where n_uids >= 3")
def distinct_uid_threshold(spark, folder):
    counts = alerts.window_counts(logs(spark, folder), domain.DAILY_RULE)
    return counts.where(F.col("n_uids") >= domain.DAILY_RULE.min_uids).select(
        "mid", day_of(F.col("window_start")).alias("day"), "n_uids"
    )


@query(f"select mid, strftime(window_start, '%Y-%m-%d') as day, n_browse = 0 as kept from ({DAILY_SQL})")
def any_browse_veto(spark, folder):
    counts = alerts.window_counts(logs(spark, folder), domain.DAILY_RULE)
    return counts.select("mid", day_of(F.col("window_start")).alias("day"), (F.col("n_browse") == 0).alias("kept"))


BOTH_SQL = " union all ".join(
    f"select mid, window_start, window_start + interval 1 day as window_end, n_uids, n_events from ({sql})"
    f" where n_uids >= 3 and n_browse = 0" for sql in (DAILY_SQL, SLIDING_SQL))


@query(f"""
select doc_id, mid, n_uids, n_events from (
  select *, row_number() over (
    partition by doc_id order by window_end desc, mid desc, window_start desc, n_uids desc, n_events desc) as rn
  from (select *, mid || '-' || strftime(window_end, '%Y-%m-%d %H:%M') as doc_id from ({BOTH_SQL}))) where rn = 1
""")
def alert_minute_dedup(spark, folder):
    # Days and sliding days both end at midnight, so those alerts come twice.
    events = logs(spark, folder)
    found = alerts.coupon_alerts(events, domain.SLIDING_RULE).unionByName(alerts.coupon_alerts(events, domain.DAILY_RULE))
    return alerts.one_per_minute(found).select("doc_id", "mid", "n_uids", "n_events")


def _members_sql(keys: str, rows: str) -> str:
    """Member rows of groups in SQL; ``rows`` are the events with the group's keys."""
    coupon = "evid in ('purchase', 'click')"
    at = "cast(null as varchar) as at, cast(null as bigint) as event_id, cast(1 as bigint) as n"
    return f"""
with m as ({rows})
select {keys}, 'event' as kind, evid as value, {TEXT.format('ts')} as at, event_id, count(*) as n from m group by all
union all
select distinct {keys}, 'uid', cast(uid as varchar), {at} from m where {coupon} and uid is not null
union all
select distinct {keys}, 'item', itemid, {at} from m where {coupon} and itemid is not null
"""


def _members(rows, *keys: str):
    return rows.select(*keys, "kind", "value", _text("event_time").alias("at"), "event_id", "n")


@query(_members_sql("mid, day", f"select *, strftime(ts, '%Y-%m-%d') as day from ({LOGS_SQL})"))
def group_collect(spark, folder):
    rows = logs(spark, folder).withColumn("day", day_of(F.col("event_time")))
    return _members(alerts.group_members(rows, ["mid", "day"], ["event_time", "event_id"], domain.DAILY_RULE), "mid", "day")


@query(_members_sql("doc_id", f"""
select e.*, e.mid || '-' || strftime(window_start + interval 1 day, '%Y-%m-%d %H:%M') as doc_id
from (select *, date_trunc('day', ts)::timestamp as window_start from ({LOGS_SQL})) e
join (select mid, window_start from ({DAILY_SQL}) where n_uids >= 3 and n_browse = 0) using (mid, window_start)
"""))
def alert_documents(spark, folder):
    rule, events = domain.DAILY_RULE, logs(spark, folder)
    return _members(alerts.alert_members(alerts.coupon_alerts(events, rule), events, rule), "doc_id")


@query(_members_sql("doc_id", f"""
select e.*, e.mid || '-' || strftime(w.window_start + interval 1 day, '%Y-%m-%d %H:%M') as doc_id
from ({LOGS_SQL}) e
join (select mid, window_start from ({SLIDING_SQL}) where n_uids >= 3 and n_browse = 0) w
on e.mid = w.mid and e.ts >= w.window_start and e.ts < w.window_start + interval 1 day
"""))
def sliding_alert_documents(spark, folder):
    rule, events = domain.SLIDING_RULE, logs(spark, folder)
    return _members(alerts.alert_members(alerts.coupon_alerts(events, rule), events, rule), "doc_id")
