import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import audit as G
from tidemark.operators import reports as R
from tidemark.operators import schedules as H
from tidemark.operators import search as Q

SCHEDULE = "name string, type string, interval_ms long, cron string, enabled boolean"


def ms(*parts):
    return int(dt.datetime(*parts, tzinfo=dt.timezone.utc).timestamp() * 1000)


def _crons(spark, *exprs, full=False):
    df = spark.createDataFrame([(e, "cron", None, e, True) for e in exprs], SCHEDULE)
    return {r.name: r for r in H.with_cron_values(df, full).collect()}


def test_cron_fields(spark):
    got = _crons(spark, "0 0 * * *", "0 9-17 * * 1-5", "*/15 * * * *", "  1,x,3 \t 5  1 * *  ")
    assert got["0 0 * * *"].days == list(range(1, 32))
    assert got["0 9-17 * * 1-5"].hours == list(range(9, 18))
    assert got["*/15 * * * *"].minutes == [0, 15, 30, 45]
    odd = got["  1,x,3 \t 5  1 * *  "]
    assert (odd.minutes, odd.hours, odd.days, odd.valid) == ([1, 3], [5], [1], True)


@pytest.mark.parametrize("field", ["5-1", "0-70", "*/0", "1-5/2", "x", "60", "5/2"])
def test_fields_that_never_fire(spark, field):
    assert _crons(spark, f"{field} * * * *")[f"{field} * * * *"].minutes == []


def test_odd_fields_that_do_fire(spark):
    got = _crons(spark, "- * * * *", "1-5-7x * * * *", "*/x * * * *", ",2 * * * *")
    assert [r.minutes for r in got.values()] == [[0], [1, 2, 3, 4, 5], [0], [0, 2]]


def test_invalid_cron_is_listed(spark):
    df = spark.createDataFrame(
        [("a", "cron", None, "invalid cron", True), ("b", "cron", None, "* * * * *", True), ("c", "interval", 0, None, True),
         ("d", "interval", 60000, None, True), ("e", "cron", None, None, True), ("f", "on-demand", None, None, True)],
        SCHEDULE,
    )
    assert sorted(r.name for r in H.invalid_schedules(df).collect()) == ["a", "c", "e", "f"]


def _runs(spark, rows, start, end, **options):
    df = spark.createDataFrame(rows, SCHEDULE)
    return sorted((r.schedule, r.at) for r in H.run_calendar(df, start, end, **options).select("schedule", F.unix_millis("run_ts").alias("at")).collect())


def test_calendar(spark):
    start, end = ms(2024, 2, 28), ms(2024, 3, 1, 12)
    rows = [("i", "interval", 50 * 3_600_000, None, True), ("off", "interval", 1000, None, False), ("c", "cron", None, "30 6,18 29,1 * *", True)]
    assert _runs(spark, rows, start, end) == [
        ("c", ms(2024, 2, 29, 6, 30)), ("c", ms(2024, 2, 29, 18, 30)), ("c", ms(2024, 3, 1, 6, 30)), ("i", start + 50 * 3_600_000)
    ]


def test_calendar_ends_are_after_start_through_end(spark):
    day = ms(2024, 1, 1)
    assert _runs(spark, [("c", "cron", None, "0 0 * * *", True)], day, day + 86_400_000) == [("c", day + 86_400_000)]
    dense = _runs(spark, [("i", "interval", 700_000, None, True)], day, day + 7_200_000)
    assert [a for _, a in dense] == [day + k * 700_000 for k in range(1, 11)]


def test_month_and_weekday_count_only_on_request(spark):
    rows = [("c", "cron", None, "0 12 * 1 1-5", True)]
    start, end = ms(2024, 1, 27), ms(2024, 2, 3)
    assert len(_runs(spark, rows, start, end)) == 7
    assert [a for _, a in _runs(spark, rows, start, end, full=True)] == [ms(2024, 1, d, 12) for d in (29, 30, 31)]


def test_matching_at_midnight(spark):
    schedules = spark.createDataFrame([("m", "cron", None, "0 0 * * *", True), ("h", "cron", None, "0 * * * *", True)], SCHEDULE)
    events = spark.createDataFrame([(ms(2024, 1, 1, 0, 0, 59),), (ms(2024, 1, 1, 0, 1),), (ms(2024, 1, 1, 5),)], "at long").withColumn("ts", F.timestamp_millis("at"))
    got = sorted((r.at, r.schedule) for r in H.match_schedules(events, schedules).collect())
    assert got == [(ms(2024, 1, 1, 0, 0, 59), "h"), (ms(2024, 1, 1, 0, 0, 59), "m"), (ms(2024, 1, 1, 5), "h")]


def _brute_next(at, minutes, hours, days):
    """Steps one minute at a time, as long as a month."""
    now = dt.datetime.fromtimestamp(at / 1000, dt.timezone.utc).replace(second=0, microsecond=0)
    month = now.month % 12 + 1
    limit = now
    for day in (now.day, 30, 29, 28):
        try:
            limit = now.replace(year=now.year + (now.month == 12), month=month, day=day)
            break
        except ValueError:
            continue
    while now < limit:
        now += dt.timedelta(minutes=1)
        if now.minute in minutes and now.hour in hours and now.day in days:
            return int(now.timestamp() * 1000)
    return None


def test_next_run_against_stepping(spark):
    forms = {
        "*/20 3-4 * * *": ([0, 20, 40], [3, 4], range(1, 32)), "0 0 31 * *": ([0], [0], [31]),
        "59 23 1,15 * *": ([59], [23], [1, 15]), "30 12 29 * *": ([30], [12], [29]), "0 99 * * *": ([0], [], range(1, 32)),
    }
    schedules = spark.createDataFrame([(c, "cron", None, c, True) for c in forms] + [("i", "interval", 90_000, None, True), ("off", "cron", None, "* * * * *", False)], SCHEDULE)
    times = [ms(2024, 1, 31, 0, 0, 30), ms(2024, 1, 15, 23, 59), ms(2023, 12, 31, 23, 59, 59), ms(2024, 2, 29, 12, 30), ms(2024, 4, 1, 4, 40, 1), ms(2024, 3, 31, 0, 0)]
    events = spark.createDataFrame([(t, n) for t in times for n in [*forms, "i", "off", "none"]], "at long, schedule string")
    out = H.next_run_for(events.withColumn("ts", F.timestamp_millis("at")), schedules)
    got = {(r.at, r.schedule): r.n for r in out.select("at", "schedule", F.unix_millis("next_run").alias("n")).collect()}
    for (at, name), value in got.items():
        want = _brute_next(at, *forms[name]) if name in forms else at + 90_000 if name == "i" else None
        assert value == want, (at, name)


def test_changes_per_run_against_a_queue(spark):
    hour = 3_600_000
    start = ms(2024, 1, 1)
    counts = [5, 0, 0, 1, 9, 0, 0, 0, 2]
    changes = spark.createDataFrame([("i", start + i * hour + k) for i, n in enumerate(counts) for k in range(n)], "schedule string, at long")
    schedules = spark.createDataFrame([("i", "interval", hour, None, True)], SCHEDULE)
    load = H.changes_per_run(changes.withColumn("ts", F.timestamp_millis("at")), schedules, start, start + 9 * hour, n=2)
    got = [tuple(r) for r in load.orderBy("run_ts").select("arrived", "taken", "left_over").collect()]
    queue, want = 0, []
    for n in counts:
        queue += n
        took = min(queue, 2)
        queue -= took
        want.append((n, took, queue))
    assert got == want


def test_retry_backlog(spark):
    rows = [("once", 1), ("twice", 1), ("twice", 2)] + [("many", t) for t in range(9)]
    df = spark.createDataFrame(rows, "key string, s long").withColumn("ts", F.timestamp_seconds("s"))
    fixed = R.RetryPolicy(max_retries=1, initial_ms=50, jitter=0.0)
    got = {r.key: (r.attempts, r.wait_ms, r.next_ms, r.exhausted) for r in R.retry_backlog(df, fixed).collect()}
    assert got["once"] == (1, 50.0, 1050, False)
    assert got["twice"] == (2, None, None, True) and got["many"][3] is True
    patient = {r.key: r.wait_ms for r in R.retry_backlog(df, R.RetryPolicy(max_retries=20, jitter=0.5)).collect()}
    assert 100 <= patient["once"] <= 150 and patient["many"] == 10_000.0
    again = {r.key: r.wait_ms for r in R.retry_backlog(df, R.RetryPolicy(max_retries=20, jitter=0.5)).collect()}
    assert again == patient


def test_batches_number_the_whole_table(spark):
    df = spark.range(0, 1003, 1, 7).select(((F.col("id") * 7919) % 1003).alias("k"))
    got = {r.k: (r.row_no, r.batch) for r in R.assign_batches(df, 50, ["k"]).collect()}
    assert got == {k: (k + 1, k // 50) for k in range(1003)}


def test_reports(spark):
    pushed = spark.createDataFrame([(2, False, None), (3, True, None), (9, False, "x")], "chunks long, unchanged boolean, error string")
    assert tuple(R.push_report(pushed).first()) == (1, 1, 1, 5)
    assert tuple(R.push_report(pushed, dry_run=True).first()) == (2, 0, 1, 5)
    batch = spark.createDataFrame([("100/a", None), ("100/b", "boom"), ("900/c", "boom")], "path string, error string")
    outcomes = R.batch_outcome(batch)
    assert {r.path: (r.outcome, r.error) for r in outcomes.collect()} == {
        "100/a": ("synced", None), "100/b": ("failed", "boom"), "900/c": ("skipped", None)
    }
    assert tuple(R.batch_report(outcomes).first()) == (1, 1, 1, "error")
    types = spark.createDataFrame([("a",), ("a",), (None,), ("",)], "type string")
    assert {r.type: r.docs for r in R.type_counts(types).collect()} == {"a": 2, "unknown": 2}


def _log(spark):
    df = spark.createDataFrame([(1, "100"), (2, "100"), (3, None), (3, "200")], "s long, scope string")
    df = df.withColumn("ts", F.timestamp_seconds("s")).withColumn("seq", F.monotonically_increasing_id())
    return G.audit_rows(df, "sync_file", F.when(F.col("s") == 1, "error").otherwise("success"), "done", path=F.when(F.col("s") < 3, "p"), scope=F.col("scope"))


def test_audit(spark):
    lines = [r.line for r in G.audit_lines(_log(spark)).orderBy("seq").collect()]
    assert lines[0] == "[1970-01-01T00:00:01.000Z] [sync_file] [100] ERROR: p done"
    assert lines[2] == "[1970-01-01T00:00:03.000Z] [sync_file] OK: done"
    kept = G.retain_audit(_log(spark), 2)
    assert sorted(r.scope or "" for r in kept.collect()) == ["", "200"]
    assert G.retain_audit(_log(spark), 1, per="scope").count() == 3
    assert [r.scope for r in G.audit_log(_log(spark)).collect()][:2] == ["100", "100"]
    with pytest.raises(ValueError):
        G.audit_rows(_log(spark), "nonsense", "success", "m")
    with pytest.raises(ValueError):
        G.audit_rows(_log(spark), "init", "maybe", "m")


def test_search(spark):
    text = "\n".join(["Needle"] * 3 + ["hay"] + ["a NEEDLE b"] * 4)
    rows = [(f"100/{n:02d}.md", text) for n in range(25)] + [
        ("100/x.png", text), ("100/node_modules/y.md", text), ("200/z.md", text), ("100/hay.TXT", "hay"), ("100/one.JSON", "x\nneedle"),
    ]
    df = spark.createDataFrame(rows, "path string, content string")
    hits = Q.search(df, "needle").collect()
    assert [h.path for h in hits] == [f"100/{n:02d}.md" for n in range(20)]
    assert [m.line for m in hits[0].matches] == [1, 2, 3, 5, 6] and hits[0].matches[3].text == "a NEEDLE b"
    assert [h.path for h in Q.search(df, "needle", scope="100/o").collect()] == ["100/one.JSON"]
    assert Q.search(df, "absent").count() == 0
    assert Q.search(df, "needle", scope="100/O").count() == 0
    assert tuple(Q.search_total(df, "needle").first()) == (26, 25 * 7 + 1)
    with pytest.raises(ValueError):
        Q.search(df, "  ")
