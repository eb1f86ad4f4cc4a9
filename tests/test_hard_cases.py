"""Cases that the given tables are too tame to show."""

import datetime
import hashlib
import json
import random
import time

import pytest
from pyspark.sql import functions as F

from tidemark.functions.core import iso_millis
from tidemark.functions.merging import index_keys_first
from tidemark.operators import chunks as C
from tidemark.operators import diff as D
from tidemark.operators import merge_json as J
from tidemark.operators import schedules as H
from tidemark.operators.filters import valid_paths
from tidemark.operators.reports import batch_outcome
from tidemark.operators.scopes import scope_filter, scope_verdict
from tidemark.plans.pipelines import pull, push
from tidemark.session import shuffles_removed
from tidemark.sources import sinks
from tidemark.streaming import feeds, remote

DAY = 86_400_000
JAN = 1_704_067_200_000


def stamp(ms):
    return datetime.datetime.fromtimestamp(ms / 1000, datetime.timezone.utc).replace(tzinfo=None)


@pytest.mark.parametrize("full", [False, True])
def test_a_change_waits_for_a_run_months_away(spark, full):
    schedules = spark.createDataFrame([("s", "cron", None, "0 0 31 * *", True)], "name string, type string, interval_ms long, cron string, enabled boolean")
    changes = spark.createDataFrame([("s", stamp(JAN + 35 * DAY)), ("s", stamp(JAN)), ("s", stamp(JAN + 119 * DAY))], "schedule string, ts timestamp")
    load = H.changes_per_run(changes, schedules, JAN, JAN + 120 * DAY, full=full).orderBy("run_ts").collect()
    assert [(r.run_ts.month, r.run_ts.day, r.arrived) for r in load] == [(1, 31, 1), (3, 31, 1)]


def test_a_month_field_is_kept(spark):
    schedules = spark.createDataFrame([("s", "cron", None, "0 0 1 4 *", True)], "name string, type string, interval_ms long, cron string, enabled boolean")
    changes = spark.createDataFrame([("s", stamp(JAN + DAY))], "schedule string, ts timestamp")
    load = H.changes_per_run(changes, schedules, JAN, JAN + 120 * DAY, full=True).collect()
    assert [(r.run_ts.month, r.arrived) for r in load] == [(4, 1)]


@pytest.fixture
def variants(spark):
    rows = [("100/A.md", b"AAAA1111", stamp(JAN)), ("100/a.md", b"bbbb2222", stamp(JAN + 1000)), ("100/c.md", b"c", stamp(JAN))]
    return spark.createDataFrame(rows, "path string, content binary, mtime timestamp")


def test_paths_that_share_a_key_keep_their_bytes(variants):
    store = C.with_chunk_id(C.chunk_files(variants, 4, key="path")).select("chunk_id", "data").dropDuplicates(["chunk_id"])
    out = {r.path: bytes(r.content) for r in C.reassemble(C.file_documents(variants, 4), store).collect()}
    assert out == {"100/A.md": b"AAAA1111", "100/a.md": b"bbbb2222", "100/c.md": b"c"}


def test_a_push_stores_the_newest_of_paths_that_share_a_key(spark, variants):
    none = C.file_documents(variants, 4).limit(0)
    docs, pieces = push(variants, none, spark.createDataFrame([], "chunk_id string, data binary"), chunk_bytes=4)
    assert sorted((r.doc_id, r.path, r.version) for r in docs.collect()) == [("100/a.md", "100/a.md", 1), ("100/c.md", "100/c.md", 1)]
    restored = {r.doc_id: bytes(r.content) for r in pull(docs, pieces).collect()}
    assert restored == {"100/a.md": b"bbbb2222", "100/c.md": b"c"}


def test_an_upsert_of_repeated_keys_stores_one_row(spark, variants):
    docs = C.file_documents(variants, 4)
    assert D.upsert_docs(docs.filter("doc_id <> '100/a.md'"), docs).groupBy("doc_id").count().filter("count > 1").count() == 0


def test_scope_is_judged_by_the_key_where_there_is_no_path(spark, variants):
    docs = C.file_documents(variants.filter("path = '100/c.md'"), 4).withColumn("path", F.lit(None).cast("string"))
    store = C.with_chunk_id(C.chunk_files(variants, 4, key="path")).select("chunk_id", "data").dropDuplicates(["chunk_id"])
    assert valid_paths(docs).count() == 1
    assert [(r.path, bytes(r.content)) for r in pull(docs, store).collect()] == [("100/c.md", b"c")]


def test_both_forms_of_scope_rules_agree(spark):
    paths = [(None,), ("",), ("100/A.md",), ("ABC/x",), ("abcd/y",), ("200/z",), ("/100",)]
    df = spark.createDataFrame(paths, "path string")
    few = {"a": ["100", "aBc"], "b": []}
    many = {"a": few["a"] + [f"zz{i}" for i in range(300)], "b": []}
    for agent in ("a", "b", "c"):
        answers = [sorted(map(repr, scope_verdict(df, rules, agent).collect())) for rules in (few, many)]
        assert agent == "b" or answers[0] == answers[1]
        assert all(r.allowed is not None for r in scope_verdict(df, few, agent).collect())
        kept = [sorted(map(repr, scope_filter(df, rules, agent).collect())) for rules in (few, many)]
        assert kept[0] == kept[1]
    batch = df.withColumn("error", F.lit(None).cast("string"))
    outcomes = [sorted(map(repr, batch_outcome(batch, rules, "a").collect())) for rules in (few, many)]
    assert outcomes[0] == outcomes[1] and "outcome='skipped'" in outcomes[0][0] + outcomes[0][-1]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_iso_text_is_utc_in_any_session(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = spark.createDataFrame([(0,), (1,), (-1,), (1_710_054_000_123,), (1_730_611_800_999,)], "ms long")
        texts = [r[0] for r in rows.select(iso_millis(F.timestamp_millis("ms"))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert texts == [
        "1970-01-01T00:00:00.000Z", "1970-01-01T00:00:00.001Z", "1969-12-31T23:59:59.999Z", "2024-03-10T07:00:00.123Z", "2024-11-03T05:30:00.999Z",
    ]


def test_index_keys_have_one_rule(spark):
    keys = ["b", "1700000000", "4294967294", "4294967295", "01", "7", "a", "99999999999", "0"]
    df = spark.createDataFrame([(keys,)], "k array<string>")
    expected = ["0", "7", "1700000000", "4294967294", "b", "4294967295", "01", "a", "99999999999"]
    assert df.select(index_keys_first(F.col("k"))).first()[0] == expected
    assert list(J._keys_in_order(dict.fromkeys(keys))) == expected


@pytest.mark.parametrize("text,shown", [
    ("0.00001", "0.00001"), ("1e-7", "1e-7"), ("1.5e-7", "1.5e-7"), ("0.000001", "0.000001"), ("1e21", "1e+21"), ("1.25e22", "1.25e+22"),
    ("1e20", "100000000000000000000"), ("1.0", "1"), ("-0.5", "-0.5"), ("123456789.125", "123456789.125"),
])
def test_json_numbers(text, shown):
    assert J._text(J._load(text)) == shown


def _random_object(draw, depth):
    if depth == 0 or draw.random() < 0.25:
        return draw.choice([1, "x", True, None, "y", 2.5])
    return {draw.choice("abcd"): _random_object(draw, depth - 1) for _ in range(draw.randint(1, 3))}


def test_leaf_conflicts_are_those_of_the_merge_at_any_depth(spark):
    draw = random.Random(3)
    rows = []
    for i in range(60):
        mine = {"r": _random_object(draw, 8)}
        theirs = json.loads(json.dumps(mine))
        at = theirs
        while isinstance(at.get(next(iter(at))), dict) and at.get(next(iter(at))):
            at = at[next(iter(at))]
        at[next(iter(at))] = draw.choice([1, "x", "changed"])
        at["new"] = {"deeper": {"still": i}}
        rows.append((i, json.dumps(mine), json.dumps(theirs)))
    df = spark.createDataFrame(rows, "id int, local string, remote string")
    leaves = J.merge_json_leaves(J.json_leaves(df, "id", "local"), J.json_leaves(df, "id", "remote"), "id")
    found = {(r.id, r.json_path) for r in leaves.filter("conflict").collect()}
    merged = J.merge_json(df, with_base=False).collect()
    assert found == {(r.id, c.split(":")[0]) for r in merged for c in r.conflicts}
    assert leaves.filter("json_path like '%new.deeper.still'").count() == 60


def test_a_damaged_store_is_not_an_empty_one(spark, tmp_path):
    assert sinks.read_chunks(spark, str(tmp_path / "absent")).count() == 0
    with pytest.raises(Exception, match="(?i)denied|permission|unsupported|scheme"):
        sinks.read_chunks(spark, "nosuch://store/chunks").count()


FEED = "doc_id string, path string, type string, children array<string>, size long, data binary, mtime timestamp, deleted boolean"


def follow(spark, folder, *batches, **options):
    """Runs the feed over batches given as rows, one file each."""
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, FEED).coalesce(1).write.mode("append").parquet(f"{folder}/source")
        stream = feeds.read_doc_stream(spark, f"{folder}/source", spark.read.parquet(f"{folder}/source").schema)
        remote.follow_remote(stream, f"{folder}/replica", enforce=False, digits=1, **options).awaitTermination()
    return {r.doc_id: (bytes(r.content), r.missing_chunks) for r in remote.applied_files(spark, f"{folder}/replica").collect()}


def file_row(name, ids, ms, deleted=False):
    return (name, name, "plain", ids, None, None, stamp(JAN + ms), deleted)


def chunk_row(chunk_id, data):
    return (chunk_id, None, "leaf", None, None, data, None, False)


def test_a_deleted_file_does_not_come_back(spark, tmp_path):
    out = follow(
        spark, str(tmp_path),
        [file_row("a", ["c1", "c2"], 0), file_row("b", ["c1"], 0), chunk_row("c1", b"one")],
        [file_row("a", None, 1, deleted=True)],
        [chunk_row("c2", b"two")],
    )
    assert out == {"b": (b"one", 0)}


def test_a_late_chunk_completes_its_file_and_a_new_state_replaces_it(spark, tmp_path):
    first = [file_row("a", ["c1", "c2"], 0), chunk_row("c1", b"one")]
    assert follow(spark, str(tmp_path), first, [chunk_row("c9", b"x")], [chunk_row("c2", b"two")]) == {"a": (b"onetwo", 0)}
    assert follow(spark, str(tmp_path), [file_row("a", ["c9"], 5)]) == {"a": (b"x", 0)}


def test_a_lost_chunk_is_not_waited_for_for_ever(spark, tmp_path):
    first = [file_row("a", ["c1", "c2"], 0), chunk_row("c1", b"one")]
    out = follow(spark, str(tmp_path), first, [chunk_row("c3", b"x")], [chunk_row("c2", b"two")], patience=1)
    assert out == {"a": (b"one", 1)}


def _shuffles(spark):
    """Numbers of the shuffles that have files on this machine."""
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    names = (blocks.apply(i).name() for i in range(blocks.size()))
    return {int(n.split("_")[1]) for n in names if n.startswith("shuffle_")}


def _soon(test, seconds=10):
    end = time.time() + seconds
    while not test() and time.time() < end:
        time.sleep(0.1)
    return test()


def test_a_command_can_take_its_shuffles_along(spark, tmp_path):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, setting = _shuffles(spark), spark.conf.get(name, None)
    with shuffles_removed(spark):
        spark.range(1_000).groupBy((F.col("id") % 7).alias("k")).count().write.parquet(str(tmp_path / "out"))
    assert _soon(lambda: _shuffles(spark) <= before)
    assert spark.conf.get(name, None) == setting and spark.read.parquet(str(tmp_path / "out")).count() == 7


def test_a_feed_keeps_no_shuffles_copies_or_old_state(spark, tmp_path):
    before = _shuffles(spark)
    out = follow(
        spark, str(tmp_path),
        [file_row("a", ["c1", "c2"], 0), chunk_row("c1", b"one")], [chunk_row("c3", b"x")], [file_row("b", ["c3", "c4"], 0)], [chunk_row("c2", b"two")],
    )
    assert out == {"a": (b"onetwo", 0), "b": (b"x", 1)}
    assert sorted(p.name for p in (tmp_path / "replica").iterdir()) == ["checkpoint", "chunks", "files", "removed", "waiting"]
    assert sorted(p.name for p in (tmp_path / "replica" / "waiting").iterdir()) == ["batch=2", "batch=3"]
    setting = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None)
    assert setting != "true"
    assert _soon(lambda: len(_shuffles(spark) - before) <= 4)  # those of this test's own reads may stay


def test_a_feed_can_consume_its_folder(spark, tmp_path):
    source = tmp_path / "in"
    for i in range(4):
        spark.createDataFrame([file_row(f"f{i}", [f"c{i}"], i), chunk_row(f"c{i}", b"x")], FEED).coalesce(1).write.mode("append").parquet(str(source))
    schema = spark.read.parquet(str(source)).schema
    stream = feeds.read_doc_stream(spark, str(source), schema, files_per_batch=1, consume=True)
    remote.follow_remote(stream, str(tmp_path / "replica"), enforce=False, digits=1).awaitTermination()
    assert _soon(lambda: len(list(source.glob("part-*"))) <= 1)
    assert remote.applied_files(spark, str(tmp_path / "replica")).count() == 4


def test_given_files_move_without_their_content(spark, tmp_path):
    follow(spark, str(tmp_path), [file_row("a", ["c1"], 0), file_row("b", ["c1", "c2"], 0), chunk_row("c1", b"one")], [chunk_row("c2", b"two")])
    hashed = remote.applied_files(spark, f"{tmp_path}/replica", F.col("path"), F.sha2("content", 256).alias("hash"))
    assert {r.path: r.hash for r in hashed.collect()} == {p: hashlib.sha256(t).hexdigest() for p, t in (("a", b"one"), ("b", b"onetwo"))}
    lines = hashed._jdf.queryExecution().executedPlan().toString().split("\n")
    assert not any("content#" in lines[i + 1] and "sha2" not in lines[i + 1] for i, line in enumerate(lines) if "Exchange" in line)
