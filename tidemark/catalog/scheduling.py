"""Calendars, matching, next runs and the load of each run."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog import shared_sql  # noqa: F401
from tidemark.catalog.registry import register
from tidemark.operators import schedules as H
from tidemark.plans import views as W


@register("SELECT schedule, epoch_us(run_ts) // 1000 AS run_ms FROM v_calendar", uses=("v_calendar",))
def run_calendar(spark, d):
    runs = H.run_calendar(W.user_schedules(spark, d), W.BASE_MS, W.END_MS)
    return runs.select("schedule", F.unix_millis("run_ts").alias("run_ms"))


@register(
    "SELECT name, 'invalid cron' AS cron FROM v_user_schedules WHERE type = 'cron' AND form = 9",
    uses=("v_user_schedules",),
)
def invalid_schedules(spark, d):
    return H.invalid_schedules(W.user_schedules(spark, d)).select("name", "cron")


@register(
    """SELECT e.event_id, n.n_name AS schedule FROM events e, nation n JOIN v_forms f ON f.form = n.n_nationkey % 10
       WHERE n.n_nationkey % 3 <> 0 AND n.n_nationkey % 11 <> 5 AND list_contains(f.minutes, minute(e.ts))
         AND list_contains(f.hours, hour(e.ts)) AND list_contains(f.days, day(e.ts))""",
    uses=("v_forms",),
)
def match_schedules(spark, d):
    e = W.change_events(spark, d).select(F.col("seq").alias("event_id"), "ts")
    return H.match_schedules(e, W.nation_schedules(spark, d)).select("event_id", "schedule")


@register(
    """SELECT e.seq, CASE WHEN s.enabled AND s.type = 'interval' THEN epoch_us(e.ts) // 1000 + s.interval_ms
         WHEN s.enabled AND r.run_ts <= date_trunc('minute', e.ts) + INTERVAL 1 MONTH THEN epoch_us(r.run_ts) // 1000 END AS next_ms
       FROM (SELECT ev.*, sc.form, sc.type, date_trunc('minute', ev.ts) AS at FROM v_events ev
             JOIN v_user_schedules sc ON sc.name = ev.schedule) e
       JOIN v_user_schedules s ON s.name = e.schedule
       ASOF LEFT JOIN v_form_runs r ON e.form = r.form AND e.at < r.run_ts""",
    uses=("v_events", "v_user_schedules", "v_form_runs"),
)
def next_run_for(spark, d):
    runs = H.next_run_for(W.change_events(spark, d), W.user_schedules(spark, d))
    return runs.select("seq", F.unix_millis("next_run").alias("next_ms"))


def _load_sql(calendar: str) -> str:
    """Load of the runs of a calendar view: changes are placed by an as-of join to all its runs."""
    return f"""SELECT schedule, epoch_us(run_ts) // 1000 AS run_ms, arrived, before + arrived - left_over AS taken, left_over FROM (
         SELECT *, coalesce(lag(left_over) OVER (PARTITION BY schedule ORDER BY run_ts), 0) AS before FROM (
           SELECT *, s - least(0, min(s) OVER (PARTITION BY schedule ORDER BY run_ts ROWS UNBOUNDED PRECEDING)) AS left_over
           FROM (SELECT schedule, run_ts, arrived, (sum(arrived - 2) OVER (PARTITION BY schedule ORDER BY run_ts
                   ROWS UNBOUNDED PRECEDING))::BIGINT AS s
             FROM (SELECT c.schedule, c.run_ts, count(a.seq) AS arrived FROM {calendar} c LEFT JOIN (
                     SELECT e.seq, e.schedule, r.run_ts FROM (SELECT *, date_trunc('minute', ts) AS at FROM v_events) e
                     ASOF JOIN {calendar} r ON e.schedule = r.schedule
                       AND CASE WHEN e.user_id % 3 = 0 THEN e.ts ELSE e.at END < r.run_ts) a
                   ON a.schedule = c.schedule AND a.run_ts = c.run_ts GROUP BY c.schedule, c.run_ts))))"""


@register(_load_sql("v_calendar"), uses=("v_events", "v_calendar"))
def changes_per_run(spark, d):
    load = H.changes_per_run(
        W.change_events(spark, d), W.user_schedules(spark, d), W.BASE_MS, W.END_MS, n=2
    )
    return load.select("schedule", F.unix_millis("run_ts").alias("run_ms"), "arrived", "taken", "left_over")


@register(_load_sql("v_long_calendar"), uses=("v_events", "v_long_calendar"))
def changes_per_run_long(spark, d):
    end_ms = W.BASE_MS + 120 * 86_400_000
    load = H.changes_per_run(
        W.change_events(spark, d), W.user_schedules(spark, d), W.BASE_MS, end_ms, n=2, full=True
    )
    return load.select("schedule", F.unix_millis("run_ts").alias("run_ms"), "arrived", "taken", "left_over")


_SECONDS = (W.END_MS - W.BASE_MS) // 1000


@register(
    f"""SELECT epoch_us(run_ts) // 1000 AS run_ms, arrived, coalesce(lag(left_over) OVER (ORDER BY run_ts), 0) + arrived - left_over AS taken,
          left_over FROM (
         SELECT run_ts, arrived, s - least(0, min(s) OVER (ORDER BY run_ts ROWS UNBOUNDED PRECEDING)) AS left_over FROM (
           SELECT c.run_ts, coalesce(a.arrived, 0) AS arrived, (sum(coalesce(a.arrived, 0) - 1) OVER (ORDER BY c.run_ts ROWS UNBOUNDED PRECEDING))::BIGINT AS s
           FROM (SELECT TIMESTAMP '2024-01-01' + to_seconds(k) AS run_ts FROM range(1, {_SECONDS} + 1) t(k)) c
           LEFT JOIN (SELECT date_trunc('second', ts) + INTERVAL 1 SECOND AS run_ts, count(*) AS arrived FROM v_events
                      WHERE ts >= TIMESTAMP '2024-01-01' GROUP BY ALL) a USING (run_ts)))
       QUALIFY arrived > 0 OR taken > 0""",
    uses=("v_events",),
)
def changes_per_run_dense(spark, d):
    """All changes wait for one schedule that runs every second and takes one; its runs with something to do."""
    # The name comes from the rows on both sides: a join on a constant would be planned as one without keys.
    name = lambda column: F.concat(F.lit("dense"), F.left(column, F.lit(0)))
    changes = W.change_events(spark, d).withColumn("schedule", name("path"))
    one = W.read(spark, d, "region").agg(F.max(name("r_name")).alias("name"), F.lit("interval").alias("type"), F.min(F.lit(1000)).cast("long").alias("interval_ms"))
    schedule = one.select("*", F.lit(None).cast("string").alias("cron"), F.lit(True).alias("enabled"))
    load = H.changes_per_run(changes, schedule, W.BASE_MS, W.END_MS, n=1).filter("arrived > 0 OR taken > 0")
    return load.select(F.unix_millis("run_ts").alias("run_ms"), "arrived", "taken", "left_over")
