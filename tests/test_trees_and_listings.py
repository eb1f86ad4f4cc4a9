"""Digest trees, events from listings, waiting files and sketches on cases of their own."""

import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import chunks as C
from tidemark.operators import diff as D
from tidemark.operators import tree as T
from tidemark.plans import pipelines
from tidemark.session import work_dir
from tidemark.streaming import feeds, listings, waiting

LISTING = "path string, hash string, mtime timestamp"
DAY = datetime.datetime(2024, 1, 1)


def _listing(spark, files):
    return spark.createDataFrame([(p, h, DAY + datetime.timedelta(seconds=s)) for p, h, s in files], LISTING)


BEFORE = [("a.md", "1", 0), ("x/b.md", "2", 0), ("x/y/c.md", "3", 0), ("x/y/z/w/d.md", "4", 0), ("x/y/open.md", "", 0), ("q/null.md", None, 0), ("x/#3/e.md", "5", 0)]
AFTER = [("a.md", "1", 0), ("x/b.md", "2", 5), ("x/y/c.md", "9", 0), ("x/y/open.md", "", 0), ("q/null.md", None, 0), ("x/#3/e.md", "5", 0), ("new/f.md", "6", 0)]


@pytest.mark.parametrize("depth,listed", [(0, 1_000), (2, 1_000), (2, 1), (5, 1_000)])
def test_tree_finds_what_the_join_finds(spark, rows, monkeypatch, depth, listed):
    monkeypatch.setattr(T, "MAX_LISTED_LEAVES", listed)
    before, after = _listing(spark, BEFORE), _listing(spark, AFTER)
    want = D.detect_changes(before, after)
    assert rows(T.detect_changes_tree(before, after, depth=depth, unchanged=True)) == rows(want)
    assert rows(T.detect_changes_tree(before, after, depth=depth)) == rows(want.filter("status <> 'unchanged'"))
    assert T.detect_changes_tree(after.limit(0), after.limit(0), depth=depth).count() == 0
    assert rows(T.detect_changes_tree(before.limit(0), after, depth=depth)) == rows(D.detect_changes(before.limit(0), after))


def test_tree_adds_up_and_sees_every_column(spark):
    tree = {(r.level, r.node): r for r in T.digest_tree(_listing(spark, BEFORE)).collect()}
    root = tree[0, ""]
    for level in (1, 2, 3):
        assert sum(r.digest for (at, _), r in tree.items() if at == level) == root.digest and sum(r.files for (at, _), r in tree.items() if at == level) == 7
    for other in ([("b", "1", 0)], [("a", "2", 0)], [("a", "1", 1)], [("a", None, 0)]):
        digests = [T.digest_tree(_listing(spark, files), depth=0, parts=1).filter("level = 0").first().digest for files in ([("a", "1", 0)], other)]
        assert digests[0] != digests[1]


def test_stored_trees_spare_reading_equal_leaves(spark, monkeypatch):
    monkeypatch.setattr(T, "ROW_GROUP_BYTES", 1 << 12)
    files = spark.range(20_000).select(
        F.concat(F.lit("f"), (F.col("id") % 100).cast("string"), F.lit("/"), F.col("id").cast("string")).alias("path"), F.sha2(F.col("id").cast("string"), 256).alias("hash"),
        F.lit(DAY).alias("mtime"))
    out, stored = work_dir(spark, "listings"), []
    for name, listing in (("a", files), ("b", files.withColumn("hash", F.when(F.col("path") == "f7/7", "changed").otherwise(F.col("hash"))))):
        T.write_listing(listing, f"{out}/{name}")
        stored.append(T.read_listing(spark, f"{out}/{name}"))
    (prev, prev_tree), (curr, curr_tree) = stored
    found = T.detect_changes_tree(prev, curr, prev_tree, curr_tree)
    assert [(r.path, r.status) for r in found.collect()] == [("f7/7", "modified")]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(leaf" in plan or "In(leaf" in plan


def _events(spark, steps, late="0 seconds"):
    """Events of listings `(hour, files)`, each written as one file and read as one batch."""
    out = work_dir(spark, "listed")
    for hour, files in steps:
        rows = [(DAY + datetime.timedelta(hours=hour), p, h, DAY) for p, h in files]
        spark.createDataFrame(rows, "listed_at timestamp, path string, hash string, mtime timestamp").coalesce(1).write.mode("append").parquet(f"{out}/source")
    schema = spark.read.parquet(f"{out}/source").schema
    stream = listings.change_events(feeds.read_doc_stream(spark, f"{out}/source", schema, files_per_batch=1), 3_600_000, late)
    feeds.run_to_table(stream, f"{out}/table", f"{out}/checkpoint").awaitTermination()
    found = spark.read.schema(stream.schema).parquet(f"{out}/table").collect()
    return sorted((r.path, int((r.ts - DAY).total_seconds() // 3600), r.event, r.hash) for r in found)


def test_events_of_listings(spark):
    steps = [
        (0, [("a", "1"), ("b", "1"), ("c", None)]), (1, [("a", "1"), ("a", "1"), ("c", None)]), (2, [("a", "2"), ("c", "3")]), (3, [("a", "2"), ("b", "1"), ("c", "3")]),
        (4, [("z", "0")]), (5, [("z", "0")]),
    ]
    assert _events(spark, steps) == [
        ("a", 0, "add", "1"), ("a", 2, "change", "2"), ("a", 3, "unlink", None), ("b", 0, "add", "1"), ("b", 0, "unlink", None), ("b", 3, "add", "1"),
        ("b", 3, "unlink", None), ("c", 0, "add", None), ("c", 2, "change", "3"), ("c", 3, "unlink", None), ("z", 4, "add", "0"),
    ]


def test_waiting_counts_each_chunk_once(spark, rows):
    resolved = spark.createDataFrame(
        [("d", DAY, 0, 2, "x", True), ("d", DAY, 0, 2, "x", True), ("d", DAY, 1, 2, "y", False), ("e", DAY, None, 0, None, True), ("w", DAY, 0, 2, "x", True)],
        "doc_id string, asked timestamp, pos int, n int, chunk_id string, found boolean")
    assert sorted(tuple(r)[::2] + (r.found,) for r in waiting.completeness(resolved).collect()) == [("d", 2, 1, 1), ("e", 0, 0, 0), ("w", 2, 0, 1)]


def test_sketches_merge(spark):
    rows = spark.range(40_000).select((F.col("id") % 4).alias("day"), F.sha2((F.col("id") % 9_000).cast("string"), 256).alias("chunk_id"), F.repeat(F.lit("x"), 1500).cast("binary").alias("data"))
    by_day = C.sketch_chunks(rows, "day")
    assert by_day.count() == 4
    (total,) = C.sketch_totals(by_day).collect()
    assert total.chunks == 40_000 and abs(total.distinct_chunks - 9_000) < 180 and abs(total.distinct_kilobytes - 18_000) < 360


def test_local_and_remote_variants_of_one_document(spark):
    local = spark.createDataFrame([("100/a.md", "100/A.md", "mine", DAY), ("100/a.md", "100/a.md", "older", DAY - datetime.timedelta(days=1))], "doc_id string, path string, content string, mtime timestamp")
    remote = spark.createDataFrame([("100/a.md", "100/a.md", "theirs", DAY), ("100/a.md", "100/a.MD", "old", DAY - datetime.timedelta(days=1))], "doc_id string, path string, content string, mtime timestamp")
    out = pipelines.sync_with_merge(local, remote, local.select("doc_id", "content").limit(1)).collect()
    assert [(r.doc_id, r.path) for r in out] == [("100/a.md", "100/A.md")]
    store = spark.createDataFrame([], "chunk_id string, data binary")
    whole = pipelines.sync(local, remote.withColumn("version", F.lit(3)), local.select("doc_id", "content"), store, enforce=False)
    assert whole.documents.count() == 1 and whole.archives.count() <= 1 and whole.audit.count() == 1


@pytest.mark.parametrize("buckets", [1, 3, 256])
def test_events_do_not_depend_on_how_files_are_held(spark, buckets, monkeypatch):
    monkeypatch.setattr(listings.change_events, "__defaults__", ("0 seconds", buckets))
    steps = [
        (0, [("a", "1"), ("b", None), ("c", "1"), ("d", "")]), (1, [("a", "1"), ("b", None), ("d", None), ("e", "1"), ("e", "2")]), (2, [("a", "2"), ("b", None), ("d", None), ("c", "1")]),
        (3, [("b", "5"), ("c", "1")]), (4, [("z", "0")]), (5, [("z", "0")]),
    ]
    assert _events(spark, steps) == [
        ("a", 0, "add", "1"), ("a", 2, "change", "2"), ("a", 2, "unlink", None), ("b", 0, "add", None), ("b", 3, "change", "5"), ("b", 3, "unlink", None),
        ("c", 0, "add", "1"), ("c", 0, "unlink", None), ("c", 2, "add", "1"), ("c", 3, "unlink", None), ("d", 0, "add", ""), ("d", 1, "change", None),
        ("d", 2, "unlink", None), ("e", 1, "add", "1"), ("e", 1, "unlink", None), ("z", 4, "add", "0"),
    ]


def test_a_listing_of_many_files_is_not_followed_file_by_file(spark, monkeypatch):
    """Calls of the Python side follow the buckets, not the files."""
    calls = spark.sparkContext.accumulator(0)
    plain = listings._steps

    def counted(*args):
        calls.add(1)
        return plain(*args)

    monkeypatch.setattr(listings, "_steps", counted)
    monkeypatch.setattr(listings.change_events, "__defaults__", ("0 seconds", 4))
    files = [(f"f{i}", "1") for i in range(2_000)]
    found = _events(spark, [(0, files), (1, files[:1_000]), (2, files[:1_000])])
    assert len(found) == 3_000 and 0 < calls.value <= 4 * 4
