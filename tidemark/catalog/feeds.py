"""Change feeds: the batch form of every operator, and streams run to their end."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.catalog import shared_sql  # noqa: F401
from tidemark.catalog.registry import register, view
from tidemark.operators import chunks as C
from tidemark.plans import views as W
from tidemark.session import shuffles_removed, work_dir
from tidemark.streaming import events as E
from tidemark.streaming import feeds, local, remote, waiting

_GAP = 6 * 3_600_000
_NOW = W.BASE_MS + 15 * 86_400_000


def _bursts(df):
    return df.select("path", "event", F.unix_millis("ts").alias("last_ms"), "events")


@register("SELECT path, event, epoch_us(last) // 1000 AS last_ms, events FROM v_bursts", uses=("v_bursts",))
def debounce(spark, d):
    return _bursts(E.debounce(W.change_events(spark, d), _GAP))


@register(
    """SELECT path, event, epoch_us(last) // 1000 AS last_ms, events FROM v_bursts
       WHERE last + INTERVAL 6 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE""",
    uses=("v_bursts",),
)
def debounce_stream(spark, d):
    """Bursts the watermark has passed; those still open at the end of the feed are not given out."""
    out = work_dir(spark, "bursts")
    W.change_events(spark, d).write.parquet(f"{out}/source")
    schema = spark.read.parquet(f"{out}/source").schema
    stream = E.debounce(feeds.read_change_stream(spark, f"{out}/source", schema), _GAP)
    feeds.run_to_table(stream, f"{out}/table", f"{out}/checkpoint").awaitTermination()
    return _bursts(spark.read.schema(stream.schema).parquet(f"{out}/table"))


@register("SELECT event_id AS seq FROM events WHERE ts >= TIMESTAMP '2024-01-16'")
def change_stream(spark, d):
    """Events from the moment of subscription on."""
    out = work_dir(spark, "changes")
    W.change_events(spark, d).write.parquet(f"{out}/source")
    schema = spark.read.parquet(f"{out}/source").schema
    stream = feeds.read_change_stream(spark, f"{out}/source", schema, since_ms=_NOW)
    feeds.run_to_table(stream.select("seq"), f"{out}/table", f"{out}/checkpoint").awaitTermination()
    return spark.read.schema("seq bigint").parquet(f"{out}/table")


@register(
    """SELECT path, event, epoch_us(last) // 1000 AS last_ms, events FROM (
         SELECT path, arg_max(event, (ts, seq)) AS event, max(ts) AS last, count(*) AS events FROM (
           SELECT *, sum(starts) OVER (PARTITION BY path ORDER BY ts, seq ROWS UNBOUNDED PRECEDING) AS burst FROM (
             SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY path ORDER BY ts, seq) <= INTERVAL 6 HOUR THEN 0 ELSE 1 END
               AS starts FROM v_events WHERE ts <= TIMESTAMP '2024-01-16'))
         GROUP BY path, burst) WHERE last + INTERVAL 6 HOUR > TIMESTAMP '2024-01-16'""",
    uses=("v_events",),
)
def pending_events(spark, d):
    """Bursts open in the middle of the month, of the events known by then."""
    return _bursts(E.pending_events(W.change_events(spark, d), _NOW, _GAP))


def _watched_files(spark, d):
    """Files of the users' paths: one for every user with a click, hashed by its first click."""
    e = W.change_events(spark, d).join(
        W.read(spark, d, "events").filter(F.col("event_type") == "click").select(F.col("event_id").alias("seq")), "seq"
    )
    return e.groupBy("path").agg(F.sha2(F.min("seq").cast("string"), 256).alias("hash"))


view(
    "v_enriched",
    """SELECT b.path, b.event, epoch_us(b.last) // 1000 AS last_ms, CASE WHEN b.event <> 'unlink' THEN f.hash END AS hash
       FROM v_bursts b LEFT JOIN (SELECT path, sha256(min(seq)::VARCHAR) AS hash FROM v_events JOIN events ON event_id = seq
         WHERE event_type = 'click' GROUP BY path) f USING (path)""",
)


def _enriched(spark, d):
    return E.enrich_events(E.debounce(W.change_events(spark, d), _GAP), _watched_files(spark, d))


@register("SELECT path, event, last_ms, hash FROM v_enriched", uses=("v_enriched",))
def enrich_events(spark, d):
    return _enriched(spark, d).select("path", "event", F.unix_millis("ts").alias("last_ms"), "hash")


@register(
    """SELECT path, last_ms, CASE WHEN event = 'unlink' THEN 'report' WHEN hash IS NULL THEN 'failed' ELSE 'sync' END AS route,
         CASE WHEN event <> 'unlink' AND hash IS NULL THEN 'error' ELSE 'success' END AS status,
         CASE WHEN event = 'unlink' THEN 'file removed' WHEN hash IS NULL THEN 'auto-sync failed: file not found'
              ELSE 'auto-synced: ' || event END AS message, split_part(path, '/', 1) AS scope FROM v_enriched""",
    uses=("v_enriched",),
)
def route_events(spark, d):
    return E.route_events(_enriched(spark, d)).select(
        "path", F.unix_millis("ts").alias("last_ms"), "route", "status", "message", "scope"
    )


def _stamped_chunks(spark, d):
    f = W.files(spark, d).withColumn("ts", F.col("mtime"))
    pieces = C.with_chunk_id(C.chunk_files(f, W.CHUNK, key="n"))
    return pieces.select("chunk_id", "data", F.timestamp_millis(F.lit(W.BASE_MS) + F.col("n") * 1000).alias("ts"))


@register("SELECT DISTINCT chunk_id FROM v_chunks", uses=("v_chunks",))
def dedupe_stream_batch(spark, d):
    return E.dedupe_stream(_stamped_chunks(spark, d)).select("chunk_id")


@register("SELECT DISTINCT chunk_id FROM v_chunks", uses=("v_chunks",))
def dedupe_stream(spark, d):
    """The feed of all chunks through a watermark longer than the feed, so no copy outlives its state."""
    out = work_dir(spark, "dedupe")
    _stamped_chunks(spark, d).select("chunk_id", "ts").write.parquet(f"{out}/source")
    schema = spark.read.parquet(f"{out}/source").schema
    stream = feeds.read_doc_stream(spark, f"{out}/source", schema)
    once = E.dedupe_stream(stream, "400 days").select("chunk_id")
    feeds.run_to_table(once, f"{out}/table", f"{out}/checkpoint").awaitTermination()
    return spark.read.schema("chunk_id string").parquet(f"{out}/table")


_LIVE = """SELECT f.doc_id, sha256(f.content) AS hash, 0::BIGINT AS missing_chunks FROM v_files f
  LEFT JOIN labels l ON l.doc_id = f.n WHERE coalesce(toxic, 0) = 0"""


def _restored():
    return F.col("doc_id"), F.sha2("content", 256).alias("hash"), F.col("missing_chunks").cast("long").alias("missing_chunks")


@register(_LIVE, uses=("v_files",))
def apply_remote(spark, d):
    """The feed brings all documents and the chunks the store lacks; the store has the labelled ones."""
    from tidemark.catalog.chunk_store import _store

    store = _store(spark, d)
    docs = W.mixed_docs(spark, d)
    arriving = docs.join(store.select(F.col("chunk_id").alias("doc_id")), "doc_id", "left_anti")
    return remote.apply_remote(arriving, store, enforce=False).select(*_restored())


@register(
    """SELECT f.doc_id, sha256(f.content) AS hash FROM v_files f LEFT JOIN labels l ON l.doc_id = f.n WHERE coalesce(toxic, 0) = 0 AND n % 5 NOT IN (2, 3)
       UNION ALL SELECT doc_id, sha256('back') FROM v_files WHERE n % 5 = 3""",
    uses=("v_files",),
)
def apply_remote_deleted(spark, d):
    """The same feed with later rows: some files deleted after they came, some deleted and put back with other content."""
    from tidemark.catalog.chunk_store import _store

    docs = W.mixed_docs(spark, d)
    numbered = W.files(spark, d).select("n", "doc_id")
    later = lambda rest, ms: docs.join(numbered.filter(F.col("n") % 5 == rest), "doc_id").drop("n").withColumn(
        "mtime", F.timestamp_millis(F.unix_millis("mtime") + ms))
    gone = later(2, 1).unionByName(later(3, 1)).withColumns({"deleted": F.lit(True), "children": F.lit(None).cast("array<string>")})
    back = C.chunk_id(F.lit("back").cast("binary"))
    again = later(3, 2).withColumns({"deleted": F.lit(False), "children": F.array(back)})
    chunk = docs.limit(1).select(back.alias("doc_id"), *[F.lit(None).cast(t).alias(c) for c, t in docs.dtypes if c not in ("doc_id", "type", "data", "deleted")],
                                 F.lit("leaf").alias("type"), F.lit("back").cast("binary").alias("data"), F.lit(False).alias("deleted"))
    found = remote.apply_remote(docs.unionByName(gone).unionByName(again).unionByName(chunk), _store(spark, d), enforce=False)
    return found.select("doc_id", F.sha2("content", 256).alias("hash"))


@register(_LIVE, uses=("v_files",))
def follow_remote(spark, d):
    """The mixed dump as a live feed of four files, chunks and documents in no particular order."""
    out = work_dir(spark, "remote")
    with shuffles_removed(spark):
        W.mixed_docs(spark, d).repartition(4, "doc_id").write.option("compression", K.STORE_CODEC).parquet(f"{out}/source")
    schema = spark.read.parquet(f"{out}/source").schema
    stream = feeds.read_doc_stream(spark, f"{out}/source", schema, files_per_batch=1, consume=True)
    remote.follow_remote(stream, f"{out}/replica", enforce=False, digits=1).awaitTermination()
    return remote.applied_files(spark, f"{out}/replica", *_restored())


@register(
    """SELECT path, last_ms AS ts_ms, CASE WHEN event <> 'unlink' AND hash IS NULL THEN 'error' ELSE 'success' END AS status,
         CASE WHEN event = 'unlink' THEN 'file removed' WHEN hash IS NULL THEN 'auto-sync failed: file not found'
              ELSE 'auto-synced: ' || event END AS message FROM v_enriched
       WHERE last_ms + 21600000 <= (SELECT epoch_us(max(ts)) // 1000 FROM events) - 600000""",
    uses=("v_enriched",),
)
def follow_local(spark, d):
    """The audit rows of syncing the closed bursts of the event feed over an empty remote side."""
    out = work_dir(spark, "local")
    W.change_events(spark, d).write.parquet(f"{out}/source")
    stream = feeds.read_change_stream(spark, f"{out}/source", spark.read.parquet(f"{out}/source").schema)
    e = W.change_events(spark, d).join(
        W.read(spark, d, "events").filter(F.col("event_type") == "click").select(F.col("event_id").alias("seq")), "seq"
    )
    texts = e.groupBy("path").agg(F.min("seq").cast("string").alias("content"), F.max("ts").alias("mtime"))
    texts = texts.withColumn("doc_id", F.col("path"))
    nothing = texts.limit(0)
    local.follow_local(
        stream, lambda: texts, lambda: nothing, lambda: nothing, f"{out}/replica", gap_ms=_GAP
    ).awaitTermination()
    rows = spark.read.parquet(f"{out}/replica/audit")
    return rows.select("path", F.unix_millis("ts").alias("ts_ms"), "status", "message")


_RULES = {"assistant": ("0", "1")}
_FOLDERS = [f"{i:03d}" for i in range(0, 230, 2)]


def _user_files(spark, d):
    """A file for every user with an event, its text the number of its last one; remote and base for two thirds of them."""
    e = W.change_events(spark, d)
    last = e.groupBy("path").agg(F.max("seq").alias("n"), F.max("ts").alias("mtime"))
    local = last.select("path", F.col("path").alias("doc_id"), F.col("n").cast("string").alias("content"), "mtime", "n")
    some = local.filter(F.col("n") % 3 != 0)
    theirs = F.when(F.col("n") % 3 == 1, F.concat(F.lit("remote "), "content")).otherwise(F.col("content"))
    remote_ = some.select("path", "doc_id", theirs.alias("content"), F.timestamp_millis(F.unix_millis("mtime") + (F.col("n") % 2) * 120_000 - 60_000).alias("mtime"), F.lit(4).alias("version"))
    base = some.filter(F.col("n") % 2 == 0).select("doc_id", "content")
    return local.drop("n"), C.with_hash(remote_), base


view(
    "v_followed",
    f"""SELECT path, epoch_us(last) // 1000 AS last_ms FROM v_bursts
        WHERE event <> 'unlink' AND left(path, 3)::INTEGER % 2 = 0 AND left(path, 1) IN ('0', '1')
          AND epoch_us(last) // 1000 + 21600000 <= (SELECT epoch_us(max(ts)) // 1000 FROM events) - 600000""",
)


@register(
    """SELECT DISTINCT doc_id, outcome, sha256(CASE WHEN outcome IN ('merged', 'remote') THEN 'remote ' || text ELSE text END) AS hash,
         CASE WHEN outcome = 'new' THEN 1 WHEN outcome = 'remote' THEN 4 ELSE 5 END::INTEGER AS version FROM (
         SELECT f.path AS doc_id, n::VARCHAR AS text, CASE WHEN n % 3 = 0 THEN 'new' WHEN n % 3 = 2 THEN 'unchanged'
             WHEN n % 2 = 0 THEN 'merged' ELSE 'remote' END AS outcome
         FROM v_followed f JOIN (SELECT path, max(seq) AS n FROM v_events GROUP BY path) USING (path))""",
    uses=("v_followed", "v_events"),
)
def follow_local_documents(spark, d):
    """The documents of syncing the event feed: every second folder is watched, and folders from 200 on are out of scope."""
    out = work_dir(spark, "local")
    W.change_events(spark, d).write.parquet(f"{out}/source")
    stream = feeds.read_change_stream(spark, f"{out}/source", spark.read.parquet(f"{out}/source").schema)
    mine, theirs, base = _user_files(spark, d)
    local.follow_local(
        stream, lambda: mine, lambda: theirs, lambda: base, f"{out}/replica", gap_ms=_GAP, watched=_FOLDERS, rules=_RULES, enforce=True
    ).awaitTermination()
    rows = spark.read.parquet(f"{out}/replica/documents")
    return rows.select("doc_id", "outcome", "hash", "version").distinct()


# When chunks come, by the number of the first file with them: at once, late but in time, an hour and a half later, or never.
_DELAYS = (0, 40, 90, None, 20)


view(
    "v_arrivals",
    f"""SELECT chunk_id, {W.BASE_MS} + min(n) * 1000 + 60000 * CASE min(n) % 5 WHEN 0 THEN 0 WHEN 1 THEN 40 WHEN 2 THEN 90 ELSE 20 END AS came
        FROM v_chunks GROUP BY chunk_id HAVING min(n) % 5 <> 3""",
)


@register(
    """SELECT c.doc_id, count(*) AS n, count(*) FILTER (a.came IS NOT NULL) AS found, count(*) FILTER (a.came IS NULL) AS lost
       FROM v_chunks c JOIN v_files f USING (doc_id) LEFT JOIN v_arrivals a
         ON a.chunk_id = c.chunk_id AND a.came BETWEEN f.mtime_ms - 3600000 AND f.mtime_ms + 3600000 GROUP BY c.doc_id""",
    uses=("v_chunks", "v_arrivals", "v_files"),
)
def resolve_refs_stream(spark, d):
    """Files and chunks as two streams: chunks that are prompt, late, too late, lost, and all of them sent twice."""
    out = work_dir(spark, "waiting")
    f = W.files(spark, d)
    end = F.timestamp_millis(F.lit(W.END_MS))  # a last row on either side lets the watermark pass all others
    files = C.file_documents(f, W.CHUNK).select("doc_id", "children", F.col("mtime").alias("ts"))
    last = spark.range(1).select(F.lit("end").alias("doc_id"), F.array().cast("array<string>").alias("children"), end.alias("ts"))
    firsts = C.with_chunk_id(C.chunk_files(f, W.CHUNK, key="n")).groupBy("chunk_id").agg(F.min("n").alias("n"))
    minutes = F.element_at(F.array(*[F.lit(m) for m in _DELAYS]), (F.col("n") % 5 + 1).cast("int"))
    sent = firsts.filter(minutes.isNotNull()).select("chunk_id", F.timestamp_millis(F.lit(W.BASE_MS) + F.col("n") * 1000 + minutes * 60_000).alias("ts"))
    twice = sent.unionByName(sent).unionByName(spark.range(1).select(F.lit("end").alias("chunk_id"), end.alias("ts")))
    files.unionByName(last).write.parquet(f"{out}/files")
    twice.write.parquet(f"{out}/chunks")
    sides = [feeds.read_doc_stream(spark, f"{out}/{name}", spark.read.parquet(f"{out}/{name}").schema) for name in ("files", "chunks")]
    resolved = waiting.resolve_refs(*sides)
    feeds.run_to_table(resolved, f"{out}/table", f"{out}/checkpoint").awaitTermination()
    told = waiting.completeness(spark.read.schema(resolved.schema).parquet(f"{out}/table"))
    return told.filter("doc_id <> 'end'").select("doc_id", F.col("n").cast("long").alias("n"), "found", "lost")
