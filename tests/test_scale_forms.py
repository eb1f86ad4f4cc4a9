"""Posting lists, the scope matrix, bitmap calendars, carried queues and newest rows on cases of their own."""

import datetime
import functools
import random

import pyarrow as pa
import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.catalog import merges
from tidemark.operators import audit as G
from tidemark.operators import postings as N
from tidemark.operators import schedules as H
from tidemark.operators import scopes as S
from tidemark.operators import search as Q
from tidemark.plans import views as W
from tidemark.session import work_dir
from tidemark.streaming import newest

DAY = datetime.datetime(2024, 1, 1)
TEXTS = [
    ("100/a.md", "The quick brown fox\njumps over\n\nab"), ("100/b.txt", "QUICK\nBrown foxes"), ("200/c.md", "a"), ("100/d.md", ""), ("100/e.md", None),
    ("100/f.png", "quick"), ("node_modules/g.md", "quick"), ("100/h.md", "x" * 50 + "needle\U0001F600s" + "y" * 50), ("100/i.md", "ΟΔΟΣ und Straße"), ("300/j.md", "ab\nquick ab"),
]
QUERIES = ["quick", "Brown Fox", "a", "ab", "fox\njumps", " ", None, "needle\U0001F600", "\U0001F600", "οδος", "STRAßE", "xyneed", "xneedle", "b", "zzz", "quick brown fox jumps", "k\nb", "aB"]


def _index(spark, texts, **options):
    out = work_dir(spark, "postings")
    N.write_index(spark.createDataFrame(texts, "path string, content string"), out, **options)
    return N.read_index(spark, out)


@pytest.mark.parametrize("piece,blocks,listed", [(1 << 16, None, 1_000), (1, 3, 0)])
def test_many_queries_find_what_each_finds(spark, monkeypatch, piece, blocks, listed):
    monkeypatch.setattr(N, "PIECE", piece)
    monkeypatch.setattr(N, "MAX_LISTED_GRAMS", listed)
    texts, lists = _index(spark, TEXTS, blocks=blocks)
    asked = spark.createDataFrame([*enumerate(QUERIES), (0, "quick")], "query_id int, query string")
    files = spark.createDataFrame(TEXTS, "path string, content string")
    for options in ({"enforce": False}, {"agent": "assistant", "max_lines": None, "scope": "100"}):
        got = {}
        for r in N.search_many(texts, lists, asked, **options).collect():
            assert (r.query_id, r.path) not in got
            got[r.query_id, r.path] = r.matches
        each = [Q.search_all(files, q, **options).withColumn("i", F.lit(i)) for i, q in enumerate(QUERIES) if q and q.strip()]
        want = {(r.i, r.path): r.matches for r in functools.reduce(DataFrame.unionByName, each).collect()}
        assert got == want
    assert N.search_many(texts, lists, asked.limit(0)).count() == 0


def test_search_in_an_empty_index(spark):
    texts, lists = _index(spark, [])
    asked = spark.createDataFrame([(1, "quick"), (2, "a")], "query_id int, query string")
    assert N.search_many(texts, lists, asked).count() == 0


def test_texts_without_candidates_are_not_read(spark):
    texts, lists = _index(spark, [(f"100/{i}.md", f"common words and number{i}") for i in range(500)])
    asked = spark.createDataFrame([(1, "Number77"), (2, "nowhere")], "query_id int, query string")
    assert sorted(r.path for r in N.candidates(lists, asked.select("query_id", F.lower("query").alias("needle"))).join(
        texts.select("path", N._doc_id().alias("doc")), "doc").collect()) == ["100/77.md"]
    plan = N.search_many(texts, lists, asked, enforce=False)._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.split("\n") if "FileScan" in line and "content" in line)
    assert "EqualTo(chunk_id" in scan or "In(chunk_id" in scan
    assert "PartitionFilters: []" not in scan


def _plain_lists(texts, blocks):
    found = {}
    for doc, text in texts:
        for line in text.split("\n"):
            for i in range(len(line)):
                found.setdefault((line[i : i + N.N], doc % blocks), set()).add(doc)
    return found


@pytest.mark.parametrize("letters,blocks", [("ab\n", 1), ("aé\U0001F600\0\n", 3), ("".join(map(chr, range(32, 50_000))) + "\n" * 9_000, 2), ("\n", 1)])
def test_lists_of_a_few_texts_hold_each_gram_of_their_lines(letters, blocks):
    draw = random.Random(5)
    held = [(draw.randrange(-40, 40) * 7919, "".join(draw.choices(letters, k=draw.randrange(90)))) for _ in range(120)] + [(-(1 << 63), "ab"), (1, "")]
    rows = N._lists(held, blocks).to_pylist()
    assert len({(r["gram"], r["block"]) for r in rows}) == len(rows)
    assert all(len(set(r["docs"])) == len(r["docs"]) for r in rows)
    assert {(r["gram"], r["block"]): set(r["docs"]) for r in rows} == _plain_lists(held, blocks)


def test_more_letters_than_pairs_can_number():
    # 300,000 letters and 700 texts: gram and doc do not fit one number side by side.
    wide = "".join(chr(c) for c in range(0x10000, 0x10000 + 300_000))
    held = [(i, wide[i * 420 : i * 420 + 450] + "tail") for i in range(700)]
    rows = N._lists(held, 2).to_pylist()
    assert {(r["gram"], r["block"]): set(r["docs"]) for r in rows} == _plain_lists(held, 2)


def test_lists_are_made_in_batches_and_texts_move_once_to_their_queries(spark):
    texts = spark.createDataFrame([("a.md", "x\U0001F600yz"), ("b.md", None)], "path string, content string")
    lists = N.posting_lists(texts)
    assert sorted(r.gram for r in lists.collect()) == sorted(["x\U0001F600y", "\U0001F600yz", "yz", "z"])
    plan = lists._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "regexp_extract_all" not in plan
    stored, lists = _index(spark, [(f"100/{i}.md", f"common words {i}") for i in range(50)])
    asked = spark.createDataFrame([(i, f"words {i}") for i in range(9)], "query_id int, query string")
    plan = N.search_many(stored, lists, asked, enforce=False)._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and plan.count("lower(content") == 1


def test_hits_given_on_at_once_are_bounded(monkeypatch):
    lines = [["Ab", "b", "ab\u03b1"], [""], ["zab", "AB"]]
    asked = [["ab", "q", "b"], ["a"], ["ab"]]
    low = pa.array(["\n".join(text).lower() for text in lines])
    batch = pa.record_batch([pa.array(["p", "q", "r"]), low, pa.array(lines), pa.array([[1, 2, 3], [4], [None]], pa.list_(pa.int32())), pa.array(asked)],
                            ["path", "low", "lines", "ids", "needles"])
    want = [(1, "p", [(1, "Ab"), (3, "ab\u03b1")]), (3, "p", [(1, "Ab"), (2, "b"), (3, "ab\u03b1")]), (None, "r", [(1, "zab"), (2, "AB")])]
    for most, batches, cut in ((1 << 24, 1, None), (1, 3, None), (1, 3, 1)):
        monkeypatch.setattr(N, "FOUND_AT_ONCE", most)
        out = list(N._tested(cut)(iter([batch, batch.slice(0, 0)])))
        assert len(out) == batches
        got = [(r["query_id"], r["path"], [(h["line"], h["text"]) for h in r["matches"]]) for b in out for r in b.to_pylist()]
        assert got == [(q, path, hits[:cut]) for q, path, hits in want]
        sliced = [r["path"] for b in N._tested(cut)(iter([batch.slice(2)])) for r in b.to_pylist()]
        assert sliced == ["r"]


def _allowed(path, prefixes):
    return any(path.lower().replace("\\", "/").split("/")[0].startswith(p.lower()) for p in prefixes)


def test_scope_matrix_is_every_agents_filter(spark, rows):
    draw = random.Random(3)
    text = lambda most: "".join(draw.choice("ab1éZ\U0001F600") for _ in range(draw.randrange(most)))
    rules = {f"g{i}": [text(4) for _ in range(draw.randrange(4))] for i in range(25)} | {"none": [], "all": [""], "same": ["a", "A", "a"]}
    paths = [f"{text(6)}/x{i}.md" for i in range(120)] + ["B\\y.md", "noslash", "", "aab/same", "aab/same"]
    files = spark.createDataFrame([(p,) for p in paths] + [(None,)], "path string").withColumn("agent", F.lit("given"))
    want = sorted((p, agent) for p in paths for agent, own in rules.items() if _allowed(p, own))
    found = S.scope_matrix(files, rules)
    assert sorted((r.path, r.agent) for r in found.collect()) == want
    assert found.columns == ["path", "agent", "scope"]
    few = {k: rules[k] for k in ("g1", "all", "same")}
    for agent in few:
        assert rows(S.scope_matrix(files, few).filter(F.col("agent") == agent).select("path")) == rows(S.scope_filter(files, few, agent).select("path"))
    assert S.scope_matrix(files.limit(0), rules).count() == 0 and S.scope_matrix(files, {"none": []}).count() == 0


def test_segments_meet_one_prefix_each(spark):
    """Long common heads neither gather in one range nor multiply rows."""
    segments = spark.range(5_000).select(F.concat(F.lit("user"), F.lpad(F.col("id").cast("string"), 9, "0")).alias("_segment"))
    prefixes = spark.range(0, 5_000, 7).select(F.concat(F.lit("user"), F.lpad(F.col("id").cast("string"), 9, "0")).alias("_prefix"))
    prefixes = prefixes.unionByName(spark.createDataFrame([("",), ("user",), ("user00000",)], "_prefix string"))
    placed = S._placed(segments, prefixes).collect()
    assert len(placed) == 5_000
    assert all(r._near == f"user{int(r._segment[4:]) // 7 * 7:09d}" for r in placed)


SCHEDULE = "name string, type string, interval_ms long, cron string, enabled boolean"


def test_events_of_one_midnight_are_spread(spark):
    schedules = spark.createDataFrame([(f"s{i}", "cron", None, ("0 0 * * *", "* * * * *", "0 1 * * *")[i % 3], True) for i in range(9)], SCHEDULE)
    events = spark.range(60_000).select("id", F.timestamp_seconds(F.col("id") % 60 + 1_704_067_200).alias("ts"), F.sha2(F.col("id").cast("string"), 256).alias("body"))
    keep = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        for key, value in zip(keep, ("50k", "50k", "-1")):
            spark.conf.set(key, value)
        out = H.match_schedules(events.repartition(8), schedules)
        assert out.groupBy("schedule").count().filter("count = 60000").count() == 6
        out.collect()
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in keep.items():
            spark.conf.set(key, value)


def test_tasks_of_a_calendar_follow_its_runs(spark, monkeypatch, rows):
    schedules = spark.createDataFrame([(f"s{i}", "interval", 60_000 * (i + 1), None, True) for i in range(4)] + [("c", "cron", None, "*/10 * * * *", True)],
                                      "name string, type string, interval_ms long, cron string, enabled boolean")
    changes = spark.range(500).select(F.concat(F.lit("s"), F.col("id") % 4).alias("schedule"), F.timestamp_millis(F.col("id") * 40_000).alias("ts"))
    load = lambda: H.changes_per_run(changes, schedules, 0, 86_400_000, n=1)
    whole = load()
    n = whole.count()
    assert abs(H._run_estimate(H._usable(schedules), 0, 86_400_000) - n) < n // 20
    assert "REPARTITION_BY_NUM" not in whole._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(H, "RUNS_A_TASK", 500)
    cut = load()
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert f"{-(-n // 500)}), REPARTITION_BY_NUM" in plan
    assert rows(cut) == rows(whole)


def test_queue_carried_from_hour_to_hour(spark):
    draw = random.Random(5)
    runs, want = [], []
    for schedule, step, n in (("often", 300, 400), ("rare", 5_000, 60), ("one", 1, 1)):
        queue = 0
        for i in range(n):
            arrived = draw.choice((0, 0, 0, 1, 2, 9))
            at = DAY + datetime.timedelta(seconds=step * i)
            took = min(queue + arrived, 2)
            queue += arrived - took
            runs.append((schedule, at, arrived))
            want.append((schedule, at, arrived, took, queue))
    load = H.carry_over(spark.createDataFrame(runs, "schedule string, run_ts timestamp, arrived long"), 2)
    assert sorted(tuple(r) for r in load.collect()) == sorted(want)


def test_dense_schedule_is_cut_by_hours(spark):
    schedule = spark.createDataFrame([("s", "interval", 1000, None, True)], SCHEDULE)
    changes = spark.range(10).select(F.lit("s").alias("schedule"), F.timestamp_millis(F.col("id") * 1000).alias("ts"))
    plan = H.changes_per_run(changes, schedule, 0, 3 * 3_600_000, n=1)._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.split("\n") if "Window [" in line]
    assert windows and all("_hour" in line for line in windows if "run_ts" in line)


LOG = "ts timestamp, seq long, action string, path string, status string, message string, scope string"


def test_newest_rows_of_a_repeated_and_merged_log(spark, rows):
    draw = random.Random(9)
    batches = [
        [(DAY + datetime.timedelta(seconds=draw.randrange(50)), b * 100 + i, "a", None, "success", "m", draw.choice(("x", "x", "y", None))) for i in range(draw.randrange(12))]
        for b in range(5)
    ]
    for per in ("scope", None):
        out = work_dir(spark, "newest")
        schema = spark.createDataFrame([], LOG).schema
        assert newest.newest_rows(spark, out, schema, 3, per).count() == 0
        for number, batch in enumerate(batches):
            df = spark.createDataFrame(batch, LOG)
            for _ in range(2):  # a batch that comes again changes nothing
                newest.fold_batch(df, number, out, 3, per, 2)
            so_far = spark.createDataFrame([r for b in batches[: number + 1] for r in b], LOG)
            assert rows(newest.newest_rows(spark, out, schema, 3, per)) == rows(G.retain_audit(so_far, 3, per))
        assert spark.read.parquet(f"{out}/batches").select("batch").distinct().count() <= 4
    with pytest.raises(ValueError):
        newest.keep_newest(None, out, out, merge_every=0)


def test_sides_of_a_sync_are_made_without_bringing_texts_together(spark, rows):
    d = "/root/testdata/sf0.001"
    plan = merges._sync(spark, d)[0]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1  # with the labels
    kept = ["doc_id", "local_mtime", "remote_mtime"]
    joined = merges._routed(spark, d).join(W.merge_sides(spark, d).select("n", *kept), "n")
    assert rows(merges._routed(spark, d, *kept).select(joined.columns)) == rows(joined)
