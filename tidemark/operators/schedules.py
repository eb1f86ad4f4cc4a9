"""Run calendars, schedule matching and next runs, computed from tables instead of timers.

Clock fields follow the session time zone. Schedules reach events by an equality join on the schedule
name or on the minute. Nothing is hinted as broadcast: Spark broadcasts schedules if their
measured size allows, and otherwise splits the tasks of a hot schedule (adaptive skew join).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.functions.cron import FIELD_BOUNDS, cron_fields, field_values

_HOUR_MS = 3_600_000
RUNS_A_TASK = 1 << 20  # runs that a task sorts and carries at once, on average


def with_cron_values(schedules: DataFrame, full: bool = False) -> DataFrame:
    """Adds `valid` and the value lists `minutes`, `hours`, `days`, `months`, `weekdays`.

    Month and weekday stand open unless `full` is set. A cron schedule is valid with five or more
    fields, an interval schedule with a positive interval.
    """
    cron = "type = 'cron' AND size(_f) >= 5"
    values = {}
    for at, (name, (low, high)) in enumerate(FIELD_BOUNDS.items()):
        read = field_values("_f", at, low, high)
        if name in ("months", "weekdays") and not full:
            read = F.expr(f"sequence({low}, {high})")
        values[name] = F.when(F.expr(cron), read)
    valid = F.expr(f"coalesce({cron} OR (type = 'interval' AND interval_ms > 0), false)")
    split = schedules.withColumn("_f", cron_fields("cron"))
    return split.withColumns({"valid": valid, **values}).drop("_f")


def invalid_schedules(schedules: DataFrame) -> DataFrame:
    """Schedules that can never be registered, by name."""
    return with_cron_values(schedules).filter(~F.col("valid")).select("name", "type", "cron", "interval_ms")


def _usable(schedules: DataFrame, full: bool = False) -> DataFrame:
    """Valid, enabled schedules under the column name that events use."""
    rules = with_cron_values(schedules, full).filter("valid AND coalesce(enabled, true)")
    return rules.select(F.col("name").alias("schedule"), "type", "interval_ms", *FIELD_BOUNDS)


def _fires(date: str) -> str:
    """SQL test: does a schedule fire on this day?"""
    return (
        f"(array_contains(days, day({date})) AND array_contains(months, month({date}))"
        f" AND array_contains(weekdays, dayofweek({date}) - 1))"
    )


def _at(date: str, hour: str, minute: str) -> str:
    return f"make_timestamp(year({date}), month({date}), day({date}), {hour}, {minute}, 0)"


def _fire_days(rules: DataFrame, start: str, end: str) -> DataFrame:
    """A row for each cron schedule and each day from `start` to `end` on which it fires, with its clock lists."""
    days = f"explode(sequence(to_date({start}), to_date({end}))) AS _day"
    return rules.filter("type = 'cron'").selectExpr("*", days).filter(_fires("_day"))


def run_calendar(schedules: DataFrame, start_ms: int, end_ms: int, full: bool = False) -> DataFrame:
    """`(schedule, run_ts)`: every firing of each enabled schedule after the start, through the end.

    An interval fires at whole multiples after the start. Runs unfold day by day (cron) or hour by
    hour (interval), so no row holds more than a day's or an hour's firings. The days and hours are dealt
    out over the tasks before they unfold, so one dense schedule is not one task's work.
    """
    rules = _usable(schedules, full)
    start, end = f"timestamp_millis({start_ms}L)", f"timestamp_millis({end_ms}L)"
    cron = (
        _fire_days(rules, start, end)
        .select("schedule", "_day", "minutes", "hours")
        .repartition("schedule", "_day")
        .selectExpr("schedule", "_day", "minutes", "explode(hours) AS _hour")
        .selectExpr("schedule", "_day", "_hour", "explode(minutes) AS _minute")
        .selectExpr("schedule", f"{_at('_day', '_hour', '_minute')} AS run_ts")
        .filter(f"run_ts > {start} AND run_ts <= {end}")
    )
    length = end_ms - start_ms
    slices = max(-(-length // _HOUR_MS), 1)
    interval = (
        rules.filter("type = 'interval'")
        .selectExpr("schedule", "interval_ms", f"explode(sequence(0L, {slices - 1}L)) AS _slice")
        .selectExpr(
            "schedule", "interval_ms", f"_slice * {_HOUR_MS} DIV interval_ms + 1 AS _low",
            f"least((_slice + 1) * {_HOUR_MS}, {length}) DIV interval_ms AS _high",
        )
        .filter("_low <= _high")
        .repartition("schedule", "_low")
        .selectExpr("schedule", "interval_ms", "explode(sequence(_low, _high)) AS _k")
        .selectExpr("schedule", f"timestamp_millis({start_ms}L + _k * interval_ms) AS run_ts")
    )
    return cron.unionByName(interval)


def _bits(values: str) -> str:
    """SQL: the whole number with the bits of a list of small numbers."""
    return f"aggregate({values}, 0L, (b, v) -> b | shiftleft(1L, v))"


def _has(bits: str, at: str) -> str:
    return f"getbit({bits}, {at}) = 1"


def with_bitmaps(rules: DataFrame) -> DataFrame:
    """The value lists of cron fields as one bitmap each: whole numbers under the names of the fields."""
    return rules.withColumns({name: F.expr(_bits(name)) for name in FIELD_BOUNDS})


def match_schedules(events: DataFrame, schedules: DataFrame, ts: str = "ts", full: bool = False) -> DataFrame:
    """Each event beside every enabled cron schedule that fires in its minute, as `schedule`.

    Schedules that fire alike, by equal bitmaps of their fields, are one calendar. The hours in which events happen, each with a bitmap of its
    minutes, meet the calendars that are open in that hour of the day; the common bits of both bitmaps are the minutes that fire. These
    two tables are as long as the time is and the calendars are many, whatever the number of events. Events then join on their own
    minute of their own day, so those of all midnights are not one key; adaptive execution splits a minute that is hot by itself.
    Events are read twice, the first time for their times alone.
    """
    bits = with_bitmaps(_usable(schedules, full).filter("type = 'cron'")).select("schedule", *FIELD_BOUNDS)
    calendars = bits.select(*FIELD_BOUNDS).distinct()
    open_ = calendars.selectExpr("*", f"explode(filter(sequence(0, 23), h -> {_has('hours', 'h')})) AS _of_day")
    hour = F.expr(f"date_trunc('HOUR', {ts})").alias("_hour")
    hours = events.select(hour, F.expr(f"shiftleft(1L, minute({ts}))").alias("_bit")).groupBy("_hour").agg(F.bit_or("_bit").alias("_there"))
    day = f"{_has('days', 'day(_hour)')} AND {_has('months', 'month(_hour)')} AND {_has('weekdays', 'dayofweek(_hour) - 1')}"
    met = hours.withColumn("_of_day", F.expr("hour(_hour)")).join(open_, "_of_day").withColumn("_both", F.expr("_there & minutes"))
    met = met.filter(f"_both <> 0 AND {day}")
    firing = met.selectExpr(*FIELD_BOUNDS, "_hour", f"explode(filter(sequence(0, 59), m -> {_has('_both', 'm')})) AS _minute")
    named = firing.join(bits, list(FIELD_BOUNDS)).select("_hour", "_minute", "schedule")
    placed = events.withColumns({"_hour": F.expr(f"date_trunc('HOUR', {ts})"), "_minute": F.expr(f"minute({ts})")})
    return placed.join(named, ["_hour", "_minute"]).select(*events.columns, "schedule")


def _later_today(ts: str) -> str:
    """SQL: first whole minute after the minute of `ts` that fires on the same day, else null."""
    next_minute = f"get(filter(minutes, m -> m > minute({ts})), 0)"
    next_hour = f"get(filter(hours, h -> h > hour({ts})), 0)"
    return f"""CASE
        WHEN {_fires(ts)} AND array_contains(hours, hour({ts})) AND {next_minute} IS NOT NULL
          THEN {_at(ts, f'hour({ts})', next_minute)}
        WHEN {_fires(ts)} AND {next_hour} IS NOT NULL THEN {_at(ts, next_hour, 'get(minutes, 0)')} END"""


def _next_cron(ts: str) -> str:
    """SQL: first whole minute after the minute of `ts` that fires, within one month, else null."""
    ahead = f"get(filter(sequence(1, 31), d -> {_fires(f'date_add(to_date({ts}), d)')}), 0)"
    later = _at(f"date_add(to_date({ts}), {ahead})", "get(hours, 0)", "get(minutes, 0)")
    limit = f"date_trunc('MINUTE', {ts}) + INTERVAL 1 MONTH"
    return f"get(filter(array(coalesce({_later_today(ts)}, {later})), c -> c <= {limit}), 0)"


def next_run_for(events: DataFrame, schedules: DataFrame, ts: str = "ts", full: bool = False) -> DataFrame:
    """Each event with `next_run`, the next run of the schedule it names in column `schedule`.

    Worked out from the field lists by arithmetic on each row, so no calendar is unfolded or joined.
    Null for a schedule that is missing, disabled, invalid or without a run within a month.
    """
    runs = f"""CASE type WHEN 'interval' THEN timestamp_millis(unix_millis(_when) + interval_ms)
        WHEN 'cron' THEN {_next_cron('_when')} END AS next_run"""
    timed = events.withColumn("_when", F.col(ts).cast("timestamp"))
    return timed.join(_usable(schedules, full), "schedule", "left").select(*events.columns, F.expr(runs))


def _next_days(rules: DataFrame, start_ms: int, end_ms: int) -> DataFrame:
    """`(schedule, _day, _next)`: for each cron schedule and day of the horizon, the first run of a later day."""
    start, end = f"timestamp_millis({start_ms}L)", f"timestamp_millis({end_ms}L)"
    days = rules.filter("type = 'cron'").selectExpr("*", f"explode(sequence(to_date({start}), to_date({end}))) AS _day")
    first = f"CASE WHEN {_fires('_day')} THEN {_at('_day', 'get(hours, 0)', 'get(minutes, 0)')} END AS _first"
    after = Window.partitionBy("schedule").orderBy("_day").rowsBetween(1, Window.unboundedFollowing)
    return days.selectExpr("schedule", "_day", first).select("schedule", "_day", F.min("_first").over(after).alias("_next"))


def _run_estimate(rules: DataFrame, start_ms: int, end_ms: int) -> int:
    """About how many runs the rules have from start to end: a day's runs by the share of days on which a cron schedule fires (this acts)."""
    days = (end_ms - start_ms) / 86_400_000
    cron = f"size(hours) * size(minutes) * {days} * size(days) / 31 * size(months) / 12 * size(weekdays) / 7"
    runs = F.expr(f"CASE type WHEN 'interval' THEN {end_ms - start_ms} / interval_ms ELSE {cron} END")
    return int(rules.agg(F.sum(runs)).first()[0] or 0)


def changes_per_run(
    changes: DataFrame,
    schedules: DataFrame,
    start_ms: int,
    end_ms: int,
    n: int = K.SYNC_BATCH_FILES,
    ts: str = "ts",
    full: bool = False,
) -> DataFrame:
    """Per scheduled run: changes that arrived for it, taken (at most `n`) and left for later runs.

    Changes name their `schedule`, and each waits for that schedule's next run, however far off: on the same
    day by arithmetic on the row, else on the next day of the horizon on which the schedule fires. A change
    without a run before the end is in no row. Changes are counted per run or day inside each task before they
    are gathered, so a schedule with a third of all changes sends few rows. What a run leaves over is summed hour by hour, the hours of one
    schedule at the same time, and carried from hour to hour, so a dense schedule is many tasks' work. Runs are estimated first (this acts)
    and dealt out to as many tasks: their rows compress so well that tasks of equal shuffled bytes would hold too many.
    """
    grid = f"""timestamp_millis({start_ms}L +
        ((unix_millis(_when) - {start_ms}L) DIV interval_ms + 1) * interval_ms)"""
    inside = changes.select("schedule", F.col(ts).cast("timestamp").alias("_when")).filter(
        f"_when >= timestamp_millis({start_ms}L) AND _when <= timestamp_millis({end_ms}L)"
    )
    rules = _usable(schedules, full)
    waiting = (
        inside.join(rules, "schedule")
        .selectExpr("schedule", "to_date(_when) AS _day", f"CASE type WHEN 'interval' THEN {grid} ELSE {_later_today('_when')} END AS _run")
        .groupBy("schedule", F.when(F.col("_run").isNull(), F.col("_day")).alias("_day"), "_run")
        .agg(F.count("*").alias("_n"))
    )
    arrivals = (
        waiting.join(_next_days(rules, start_ms, end_ms), ["schedule", "_day"], "left")
        .groupBy("schedule", F.coalesce("_run", "_next").alias("run_ts"))
        .agg(F.sum("_n").alias("arrived"))
    )
    runs = (
        run_calendar(schedules, start_ms, end_ms, full)
        .join(arrivals, ["schedule", "run_ts"], "left")
        .withColumn("arrived", F.coalesce("arrived", F.lit(0)))
    )
    return carry_over(runs, n, -(-_run_estimate(rules, start_ms, end_ms) // RUNS_A_TASK))


def carry_over(runs: DataFrame, n: int, tasks: int = 1) -> DataFrame:
    """Runs `(schedule, run_ts, arrived)` with `taken`, at most `n`, and `left_over` for the next run of the schedule.

    A queue's length is the sum of what came and went, less its lowest point so far. Both add up over pieces of time: each hour of a schedule is
    summed by itself, a row for each hour is carried along the schedule, and what is left at an hour's start enters its runs. Hours are dealt
    out to so many `tasks`, if to more than one.
    """
    cut = runs.withColumn("_hour", F.date_trunc("HOUR", "run_ts"))
    cut = cut.repartition(tasks, "schedule", "_hour") if tasks > 1 else cut
    by_time = Window.partitionBy("schedule", "_hour").orderBy("run_ts")
    upto = by_time.rowsBetween(Window.unboundedPreceding, 0)
    cut = cut.withColumn("_s", F.sum(F.col("arrived") - n).over(upto)).withColumn("_low", F.least(F.lit(0), F.min("_s").over(upto)))
    hours = cut.groupBy("schedule", "_hour").agg(F.max_by("_s", "run_ts").alias("_sum"), F.min("_low").alias("_least"))
    along = Window.partitionBy("schedule").orderBy("_hour")
    so_far = along.rowsBetween(Window.unboundedPreceding, 0)
    hours = hours.withColumn("_all", F.sum("_sum").over(so_far))
    lowest = F.least(F.lit(0), F.min(F.col("_all") - F.col("_sum") + F.col("_least")).over(so_far))
    hours = hours.withColumn("_end", F.col("_all") - lowest)
    starts = hours.select("schedule", "_hour", F.lag("_end", 1, 0).over(along).alias("_start"))
    met = cut.join(starts, ["schedule", "_hour"])
    met = met.withColumn("left_over", F.col("_s") - F.least(-F.col("_start"), F.col("_low")))
    before = F.coalesce(F.lag("left_over").over(by_time), "_start")
    return met.select("schedule", "run_ts", "arrived", (before + F.col("arrived") - F.col("left_over")).alias("taken"), "left_over")
