import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark import schemas
from tidemark.operators.chunks import chunk_files, file_documents, with_chunk_id
from tidemark.sources import scan, sinks
from tidemark.streaming import events as E
from tidemark.streaming import feeds, local, remote


def _events(spark, rows):
    return spark.createDataFrame(rows, "path string, event string, at long, seq long").select(
        "path", "event", F.timestamp_millis("at").alias("ts"), "seq"
    )


BURSTS = [("a", "add", 0, 1), ("a", "change", 500, 2), ("a", "unlink", 1000, 3), ("a", "add", 1501, 4), ("b", "change", 0, 5), ("b", "add", 0, 6)]


def _bursts(df):
    return sorted((r.path, r.event, r.at, r.events) for r in df.select("path", "event", F.unix_millis("ts").alias("at"), "events").collect())


def test_debounce_joins_events_exactly_one_gap_apart(spark):
    assert _bursts(E.debounce(_events(spark, BURSTS))) == [("a", "add", 1501, 1), ("a", "unlink", 1000, 3), ("b", "add", 0, 2)]
    assert len(_bursts(E.debounce(_events(spark, BURSTS), K.STABILITY_MS))) == 5


@pytest.mark.parametrize("gap", [500, 40_000_000])
def test_bursts_across_days_against_a_plain_loop(spark, gap):
    rng = random.Random(gap)
    day = 86_400_000
    rows, seq = [], 0
    for path in "abc":
        for _ in range(150):
            near = rng.choice([0, day, 2 * day, 7 * day, rng.randrange(10 * day)])
            seq += 1
            rows.append((path, rng.choice(["add", "change", "unlink"]), near + rng.randrange(-2 * 500, 2 * 500) * rng.choice([1, gap // 500]), seq))
    want = []
    for path in "abc":
        burst = []
        for _, event, at, number in sorted((r for r in rows if r[0] == path), key=lambda r: (r[2], r[3])):
            if burst and at - burst[-1][0] > gap:
                want.append((path, burst[-1][1], burst[-1][0], len(burst)))
                burst = []
            burst.append((at, event, number))
        want.append((path, burst[-1][1], burst[-1][0], len(burst)))
    assert _bursts(E.debounce(_events(spark, rows), gap)) == sorted(want)
    local = _events(spark, rows).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    assert sorted((r.path, r.event, r.events) for r in E.debounce(local, gap).collect()) == sorted((p, e, n) for p, e, _, n in want)


def test_a_filter_on_the_close_keeps_whole_bursts(spark):
    late = E.debounce(_events(spark, BURSTS)).filter(F.unix_millis("closes") > 1400)
    assert _bursts(late) == [("a", "add", 1501, 1), ("a", "unlink", 1000, 3)]


def test_pending_events(spark):
    assert _bursts(E.pending_events(_events(spark, BURSTS), 1200)) == [("a", "unlink", 1000, 3)]
    assert _bursts(E.pending_events(_events(spark, BURSTS), 1501)) == [("a", "add", 1501, 1)]
    assert _bursts(E.pending_events(_events(spark, BURSTS), 5000)) == []


def test_routes(spark):
    files = spark.createDataFrame([("x/a", "ha"), ("x/u", "hu")], "path string, hash string")
    events = _events(spark, [("x/a", "add", 0, 1), ("x/u", "unlink", 0, 2), ("x/gone", "change", 0, 3)])
    got = {r.path: (r.hash, r.route, r.status, r.scope) for r in E.route_events(E.enrich_events(events, files)).collect()}
    assert got == {
        "x/a": ("ha", "sync", "success", "x"), "x/u": (None, "report", "success", "x"), "x/gone": (None, "failed", "error", "x")
    }


def test_stream_gives_the_batch_answer_without_the_open_bursts(spark, tmp_path):
    rows = [(f"p{i % 5}", "change", i * 700 + (i % 3) * 400, i) for i in range(200)]
    _events(spark, rows).repartition(3).write.parquet(str(tmp_path / "in"))
    stream = feeds.read_change_stream(spark, str(tmp_path / "in"), schemas.CHANGE_EVENTS)
    out = E.debounce(stream, 3000, "1 second")
    feeds.run_to_table(out, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    batch = E.debounce(_events(spark, rows), 3000)
    bound = max(r[2] for r in rows) - 1000
    closed = batch.filter(F.unix_millis("closes") <= bound)
    assert _bursts(spark.read.parquet(str(tmp_path / "out"))) == _bursts(closed)
    assert 0 < closed.count() < batch.count()


def test_a_feed_starts_where_it_subscribed_and_resumes(spark, tmp_path):
    source, out, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    _events(spark, BURSTS).write.parquet(source)

    def drain():
        stream = feeds.read_change_stream(spark, source, schemas.CHANGE_EVENTS, since_ms=500)
        feeds.run_to_table(stream.select("seq"), out, cp).awaitTermination()
        return sorted(r.seq for r in spark.read.parquet(out).collect())

    assert drain() == [2, 3, 4]
    _events(spark, [("c", "add", 9000, 7)]).write.mode("append").parquet(source)
    assert drain() == [2, 3, 4, 7]


def test_dedupe_stream(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1), ("b", 1), ("a", 2), ("a", 3)], "chunk_id string, s long").withColumn("ts", F.timestamp_seconds("s"))
    rows.write.parquet(str(tmp_path / "in"))
    stream = feeds.read_doc_stream(spark, str(tmp_path / "in"), rows.schema)
    feeds.run_to_table(E.dedupe_stream(stream, "1 hour").select("chunk_id"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert sorted(r.chunk_id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "b"]


def _feed_docs(spark):
    raw = spark.createDataFrame([("100/A.md", "hello world"), ("100/b.md", "hello again"), ("900/c.md", "no")], "path string, content string")
    raw = raw.withColumn("mtime", F.timestamp_seconds(F.lit(5)))
    none = F.lit(None)
    docs = file_documents(raw, 6).select(
        "doc_id", "path", "type", "children", "size", none.cast("binary").alias("data"), F.lit(False).alias("deleted"), "mtime"
    )
    pieces = with_chunk_id(chunk_files(raw, 6, key="path")).dropDuplicates(["chunk_id"]).select(
        F.col("chunk_id").alias("doc_id"), none.cast("string").alias("path"), F.lit("leaf").alias("type"),
        none.cast("array<string>").alias("children"), none.cast("long").alias("size"), "data", F.lit(False).alias("deleted"),
        none.cast("timestamp").alias("mtime"),
    )
    return docs, pieces


def test_chunks_may_come_after_their_file(spark, tmp_path):
    docs, pieces = _feed_docs(spark)
    world = hashlib.sha256(b"world").hexdigest()
    source, replica = str(tmp_path / "in"), str(tmp_path / "replica")
    first = docs.unionByName(pieces.filter(F.col("doc_id") != world))

    def drain():
        stream = feeds.read_doc_stream(spark, source, docs.schema)
        remote.follow_remote(stream, replica, digits=1).awaitTermination()
        return {r.doc_id: (bytes(r.content), r.missing_chunks) for r in remote.applied_files(spark, replica).collect()}

    first.coalesce(1).write.parquet(source)
    assert drain() == {"100/a.md": (b"hello ", 1), "100/b.md": (b"hello again", 0)}
    pieces.filter(F.col("doc_id") == world).coalesce(1).write.mode("append").parquet(source)
    assert drain() == {"100/a.md": (b"hello world", 0), "100/b.md": (b"hello again", 0)}
    assert sinks.read_chunks(spark, f"{replica}/chunks").count() == pieces.count()


def test_batch_form_of_the_feed(spark):
    docs, pieces = _feed_docs(spark)
    gone = docs.withColumn("deleted", F.col("path") == "100/b.md")
    store = scan.chunk_docs(scan.classify_docs(pieces))
    out = remote.apply_remote(gone, store)
    assert [(r.doc_id, bytes(r.content)) for r in out.collect()] == [("100/a.md", b"hello world")]


def test_local_changes_are_synced_and_recorded(spark, tmp_path):
    rows = [("x/a.md", "add", 0, 1), ("x/a.md", "change", 300, 2), ("x/gone.md", "change", 0, 3), ("x/u.md", "unlink", 0, 4), ("z", "add", 90_000, 5)]
    _events(spark, rows).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = feeds.read_change_stream(spark, str(tmp_path / "in"), schemas.CHANGE_EVENTS)

    def files(texts):
        df = spark.createDataFrame([(p, p, t) for p, t in texts.items()], "doc_id string, path string, content string")
        return df.withColumn("mtime", F.timestamp_seconds(F.lit(5)))

    out = str(tmp_path / "out")
    local.follow_local(
        stream, lambda: files({"x/a.md": "A\nb", "x/u.md": "u", "y/other.md": "o"}),
        lambda: files({"x/a.md": "a\nB"}), lambda: files({"x/a.md": "a\nb"}), out, watermark="1 second",
    ).awaitTermination()
    synced = spark.read.parquet(f"{out}/documents").collect()
    assert [(r.path, r.outcome, r.content) for r in synced] == [("x/a.md", "merged", "A\nB")]
    log = {r.path: (r.status, r.message) for r in spark.read.parquet(f"{out}/audit").collect()}
    assert log == {
        "x/a.md": ("success", "auto-synced: change"), "x/gone.md": ("error", "auto-sync failed: file not found"),
        "x/u.md": ("success", "file removed"),
    }


DOC = "doc_id string, type string, children array<string>, data string"


def test_classify(spark):
    df = spark.createDataFrame(
        [("c", "leaf", None, "x"), ("e", "leaf", None, ""), ("p", "plain", None, None), ("n", "newnote", [], None), ("k", None, ["c"], None),
         ("z", None, [], "x"), ("_d", None, None, None)],
        DOC,
    )
    kinds = {r.doc_id: r.kind for r in scan.classify_docs(df, fallback=True).collect()}
    assert kinds == {"c": "chunk", "e": "ignored", "p": "file", "n": "file", "k": "file", "z": "ignored", "_d": "ignored"}
    bare = df.filter("doc_id IN ('z', '_d')")
    assert {r.doc_id: r.kind for r in scan.classify_docs(bare, fallback=True).collect()} == {"z": "file", "_d": "ignored"}
    assert scan.classify_docs(df.limit(0), fallback=True).count() == 0


def test_scan_files(spark, tmp_path):
    for name, text in {"100/a.md": "a", "100/sub/b.md": "b", "100/.hid/c.md": "c", "200/d.md": "d"}.items():
        target = tmp_path / name
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_text(text)
    found = {r.path: r.hash for r in scan.scan_files(spark, str(tmp_path)).collect()}
    assert found == {p: hashlib.sha256(p[-4].encode()).hexdigest() for p in ("100/a.md", "100/sub/b.md", "200/d.md")}
    some = scan.scan_files(spark, f"file:{tmp_path}/", watched=["100"], content=True)
    assert {r.path: bytes(r.content) for r in some.collect()} == {"100/a.md": b"a", "100/sub/b.md": b"b"}


def test_state_versions(spark, tmp_path):
    path = str(tmp_path / "state")
    assert sinks.load_state(spark, path).count() == 0
    one = spark.createDataFrame([("a", "h")], "path string, hash string").withColumn("mtime", F.timestamp_seconds(F.lit(1)))
    sinks.save_state(one, path, 1, 1000)
    sinks.save_state(one.unionByName(one.withColumn("path", F.lit("b"))), path, 2, 2000)
    sinks.save_state(one.unionByName(one.withColumn("path", F.lit("b"))), path, 2, 2000)
    assert sorted(r.path for r in sinks.synced_paths(sinks.load_state(spark, path)).collect()) == ["a", "b"]
    one.write.parquet(f"{path}/state/version=3")  # a version without its meta row was never finished
    assert sinks.load_state(spark, path).count() == 2
    assert sinks.state_meta(spark, path).count() == 2


def test_written_files_are_partitioned_by_scope(spark, tmp_path):
    df = spark.createDataFrame([("100/a.md", b"a"), ("B/c.md", b"c")], "path string, content binary")
    sinks.write_files(df, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((r.path, str(r.scope)) for r in back.collect()) == [("100/a.md", "100"), ("B/c.md", "b")]
    with pytest.raises(Exception):
        sinks.write_files(df, str(tmp_path / "out"))
