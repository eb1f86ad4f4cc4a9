"""Counts, outcomes, backlog, batches and the audit log."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog import shared_sql  # noqa: F401
from tidemark.catalog.registry import register, view
from tidemark.operators import audit as G
from tidemark.operators import chunks as C
from tidemark.operators import reports as R
from tidemark.plans import pipelines
from tidemark.plans import views as W
from tidemark.session import work_dir
from tidemark.sources import scan, sinks
from tidemark.streaming import feeds, newest


@register(
    """SELECT 'plain' AS type, count(*) AS docs FROM v_files
       UNION ALL SELECT 'leaf', count(DISTINCT chunk_id) FROM v_chunks UNION ALL SELECT 'unknown', count(*) FROM pages""",
    uses=("v_chunks",),
)
def type_counts(spark, d):
    return R.type_counts(W.mixed_docs(spark, d))


_MAY = "regexp_matches(f.path, '^(100|101|102|103|104)')"


@register(
    f"""SELECT (SELECT count(DISTINCT chunk_id) FROM v_chunks WHERE octet_length(piece) > 0) AS chunks_decoded,
          0::BIGINT AS chunks_failed,
          count(*) FILTER ({_MAY} AND coalesce(toxic, 0) = 0) AS files_written, 0::BIGINT AS files_bad_path,
          count(*) FILTER (NOT {_MAY}) AS files_denied, count(*) FILTER ({_MAY} AND toxic = 1) AS files_deleted,
          0::BIGINT AS files_no_content
        FROM v_files f LEFT JOIN labels l ON l.doc_id = f.n""",
    uses=("v_chunks",),
)
def pull_report(spark, d):
    kinds = scan.classify_docs(W.mixed_docs(spark, d))
    files, chunks = scan.file_docs(kinds), scan.chunk_docs(kinds)
    return R.pull_report(R.pull_outcomes(files, pipelines.pull(files, chunks)), chunks)


@register(
    f"""SELECT doc_id, sha256(content) AS hash FROM (SELECT f.doc_id, f.content FROM v_files f
          LEFT JOIN labels l ON l.doc_id = f.n WHERE {_MAY} AND coalesce(toxic, 0) = 0)""",
    uses=("v_files",),
)
def pull(spark, d):
    kinds = scan.classify_docs(W.mixed_docs(spark, d))
    back = pipelines.pull(scan.file_docs(kinds), scan.chunk_docs(kinds))
    return back.select("doc_id", F.sha2("content", 256).alias("hash"))


@register(
    "SELECT path, sha256(content) AS hash, octet_length(encode(content))::BIGINT AS bytes FROM v_files WHERE left(path, 2) IN ('00', '11')",
    uses=("v_files",),
)
def pull_few_folders(spark, d):
    """The files of a few folders out of the stored chunks of all: only their chunks' folders, row groups and bytes are read."""
    store = work_dir(spark, "store")
    files = W.files(spark, d)
    sinks.write_chunks(C.with_chunk_id(C.chunk_files(files, W.CHUNK)).dropDuplicates(["chunk_id"]), store)
    back = pipelines.pull(C.file_documents(files, W.CHUNK), sinks.read_chunks(spark, store), {"few": ("00", "11")}, "few")
    return back.select("path", F.sha2("content", 256).alias("hash"), F.octet_length("content").cast("long").alias("bytes"))


def _stored(spark, d):
    """Documents and chunks of the previous snapshot."""
    prev, _ = W.snapshots(spark, d)
    docs = C.file_documents(prev, W.CHUNK).withColumn("version", F.lit(1))
    pieces = C.with_chunk_id(C.chunk_files(prev, W.CHUNK, key="path"))
    return docs, pieces.select("chunk_id", "data").dropDuplicates(["chunk_id"])


@register(
    """SELECT lower(path) AS doc_id, coalesce(c.hash, p.hash) AS hash,
         CASE WHEN p.hash IS NULL THEN 1 WHEN c.hash IS NULL THEN 1 WHEN p.mtime_ms = c.mtime_ms
           AND octet_length(encode(p.content)) = octet_length(encode(c.content)) THEN 1 ELSE 2 END::INTEGER AS version
       FROM v_prev p FULL OUTER JOIN v_curr c USING (path)""",
    uses=("v_prev", "v_curr"),
)
def push_documents(spark, d):
    _, curr = W.snapshots(spark, d)
    docs, _ = pipelines.push(curr, *_stored(spark, d), enforce=False, chunk_bytes=W.CHUNK)
    return docs.select("doc_id", "hash", "version")


view(
    "v_curr_chunks",
    """SELECT path, sha256(array_slice(raw, pos * 1024 + 1, (pos + 1) * 1024)) AS chunk_id FROM (
         SELECT path, encode(content) AS raw, unnest(range(greatest((octet_length(encode(content)) + 1023) // 1024, 1))) AS pos
         FROM v_curr)""",
)


@register(
    "SELECT DISTINCT chunk_id FROM v_curr_chunks WHERE chunk_id NOT IN (SELECT chunk_id FROM v_chunks)",
    uses=("v_curr_chunks", "v_chunks"),
)
def push_chunks(spark, d):
    _, curr = W.snapshots(spark, d)
    _, fresh = pipelines.push(curr, *_stored(spark, d), enforce=False, chunk_bytes=W.CHUNK)
    return fresh.select("chunk_id")


def _pushed(spark, d):
    """Current files, with those already stored marked and toxic sources failing to read."""
    prev, curr = W.snapshots(spark, d)
    size = F.octet_length("content")
    known = prev.select("path", F.col("mtime").alias("_m"), size.alias("_s"))
    return curr.join(known, "path", "left").select(
        "path",
        F.greatest(F.ceil(size / F.lit(W.CHUNK)), F.lit(1)).alias("chunks"),
        ((F.col("_m") == F.col("mtime")) & (F.col("_s") == size)).alias("unchanged"),
        F.when(F.col("path").endswith(".png"), F.lit("unreadable")).alias("error"),
    )


view(
    "v_pushed",
    """SELECT c.path, greatest((octet_length(encode(c.content)) + 1023) // 1024, 1) AS chunks, ends_with(c.path, '.png') AS failed,
         coalesce(p.mtime_ms = c.mtime_ms AND octet_length(encode(p.content)) = octet_length(encode(c.content)), false) AS same
       FROM v_curr c LEFT JOIN v_prev p USING (path)""",
)
_PUSH = """count(*) FILTER (failed) AS failed, (sum(chunks) FILTER (NOT failed))::BIGINT AS total_chunks FROM v_pushed"""


@register(
    f"SELECT count(*) FILTER (NOT failed AND NOT same) AS pushed, count(*) FILTER (NOT failed AND same) AS unchanged, {_PUSH}",
    uses=("v_pushed",),
)
def push_report(spark, d):
    return R.push_report(_pushed(spark, d))


@register(f"SELECT count(*) FILTER (NOT failed) AS pushed, 0::BIGINT AS unchanged, {_PUSH}", uses=("v_pushed",))
def push_report_dry_run(spark, d):
    return R.push_report(_pushed(spark, d), dry_run=True)


def _batch(spark, d):
    files = W.files(spark, d)
    labels = W.read(spark, d, "labels").select(F.col("doc_id").alias("n"), "toxic")
    error = F.when(F.col("toxic") == 1, F.concat(F.lit("no such file: "), "path"))
    return files.join(labels, "n", "left").select("path", error.alias("error"))


view(
    "v_batch",
    f"""SELECT path, CASE WHEN NOT {_MAY} THEN 'skipped' WHEN toxic = 1 THEN 'failed' ELSE 'synced' END AS outcome,
          CASE WHEN {_MAY} AND toxic = 1 THEN 'no such file: ' || path END AS error
        FROM v_files f LEFT JOIN labels l ON l.doc_id = f.n""",
)


@register("SELECT path, outcome, error FROM v_batch", uses=("v_batch",))
def batch_outcome(spark, d):
    return R.batch_outcome(_batch(spark, d))


@register(
    """SELECT count(*) FILTER (outcome = 'synced') AS synced, count(*) FILTER (outcome = 'failed') AS failed,
         count(*) FILTER (outcome = 'skipped') AS skipped,
         CASE WHEN count(*) FILTER (outcome = 'failed') > 0 THEN 'error' ELSE 'success' END AS status FROM v_batch""",
    uses=("v_batch",),
)
def batch_report(spark, d):
    return R.batch_report(R.batch_outcome(_batch(spark, d)))


@register(
    """SELECT key, attempts, last_ms, CASE WHEN attempts <= 12 THEN wait END AS wait_ms,
         CASE WHEN attempts <= 12 THEN last_ms + round(wait)::BIGINT END AS next_ms, attempts > 12 AS exhausted
       FROM (SELECT *, least(100.0::DOUBLE * pow(1.5, attempts - 1), 10000.0::DOUBLE) AS wait FROM (
         SELECT user_id AS key, count(*) AS attempts, epoch_us(max(ts)) // 1000 AS last_ms FROM events
         WHERE event_type = 'error' GROUP BY user_id))"""
)
def retry_backlog(spark, d):
    failed = W.change_events(spark, d).filter(F.col("event") == "unlink")
    user = F.substr("schedule", F.lit(2)).cast("long")
    policy = R.RetryPolicy(max_retries=12, multiplier=1.5, jitter=0.0)
    return R.retry_backlog(failed.withColumn("key", user), policy)


@register(
    """SELECT l_orderkey, l_linenumber, row_no, ((row_no - 1) // 500)::BIGINT AS batch FROM (
         SELECT l_orderkey, l_linenumber, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) AS row_no
         FROM lineitem)"""
)
def assign_batches(spark, d):
    lines = W.read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return R.assign_batches(lines, 500, order).select("l_orderkey", "l_linenumber", "row_no", "batch")


view(
    "v_audit",
    """SELECT ts, event_id AS seq, CASE event_type WHEN 'error' THEN 'error' WHEN 'signup' THEN 'init' WHEN 'view' THEN 'pull_vault'
         ELSE 'sync_file' END AS action,
         CASE WHEN event_type <> 'view' THEN 'u' || user_id || '.md' END AS path,
         CASE event_type WHEN 'error' THEN 'error' ELSE 'success' END AS status, 'event ' || event_type AS message,
         CASE WHEN user_id % 7 <> 0 THEN lpad((user_id % 230)::VARCHAR, 3, '0') END AS scope FROM events""",
)
_AUDIT = "epoch_us(ts) // 1000 AS ts_ms, seq, action, path, status, message, scope"


def _plain(df):
    return df.select(F.unix_millis("ts").alias("ts_ms"), "seq", "action", "path", "status", "message", "scope")


@register(f"SELECT {_AUDIT} FROM v_audit", uses=("v_audit",))
def audit_rows(spark, d):
    return _plain(W.audit(spark, d))


@register(
    """SELECT seq, '[' || strftime(ts, '%Y-%m-%dT%H:%M:%S.') || lpad((epoch_us(ts) // 1000 % 1000)::VARCHAR, 3, '0') || 'Z] [' || action || ']' ||
         coalesce(' [' || scope || ']', '') || CASE status WHEN 'error' THEN ' ERROR:' ELSE ' OK:' END || coalesce(' ' || path, '') ||
         ' ' || message AS line FROM v_audit""",
    uses=("v_audit",),
)
def audit_lines(spark, d):
    return G.audit_lines(W.audit(spark, d)).select("seq", "line")


@register(f"SELECT {_AUDIT} FROM v_audit ORDER BY ts, seq", uses=("v_audit",))
def audit_log(spark, d):
    return _plain(G.audit_log(W.audit(spark, d)))


@register(f"SELECT {_AUDIT} FROM v_audit ORDER BY ts DESC, seq DESC LIMIT 1000", uses=("v_audit",))
def retain_audit(spark, d):
    return _plain(G.retain_audit(W.audit(spark, d)))


@register(
    f"""SELECT {_AUDIT} FROM (SELECT *, row_number() OVER (PARTITION BY scope ORDER BY ts DESC, seq DESC) AS rn FROM v_audit)
        WHERE rn <= 20""",
    uses=("v_audit",),
)
def retain_audit_per_scope(spark, d):
    return _plain(G.retain_audit(W.audit(spark, d), 20, per="scope"))


@register(
    f"""SELECT {_AUDIT} FROM (SELECT *, row_number() OVER (PARTITION BY scope ORDER BY ts DESC, seq DESC) AS rn FROM v_audit)
        WHERE rn <= 20""",
    uses=("v_audit",),
)
def retain_audit_stream(spark, d):
    """The same kept by a stream: the log comes in eight batches and is merged after every third."""
    out = work_dir(spark, "audit")
    log = W.audit(spark, d)
    log.repartition(8, "seq").write.parquet(f"{out}/log")
    stream = feeds.read_doc_stream(spark, f"{out}/log", log.schema, files_per_batch=1)
    newest.keep_newest(stream, f"{out}/kept", f"{out}/checkpoint", 20, "scope", merge_every=3).awaitTermination()
    return _plain(newest.newest_rows(spark, f"{out}/kept", log.schema, 20, "scope"))
