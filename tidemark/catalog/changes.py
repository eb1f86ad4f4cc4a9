"""Snapshot comparison, pairing and batching."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog import shared_sql  # noqa: F401
from tidemark.catalog.registry import register, view
from tidemark.operators import diff as D
from tidemark.operators import tree as T
from tidemark.operators.chunks import with_hash
from tidemark.plans import views as W
from tidemark.session import work_dir
from tidemark.streaming import feeds, listings


def _changes(spark, d):
    return D.detect_changes(*W.snapshots(spark, d))


@register("SELECT path, status, hash, mtime_ms FROM v_changes", uses=("v_changes",))
def detect_changes(spark, d):
    return _changes(spark, d).select("path", "status", "hash", F.unix_millis("mtime").alias("mtime_ms"))


@register(
    """SELECT count(*) FILTER (status = 'added') AS added, count(*) FILTER (status = 'modified') AS modified,
         count(*) FILTER (status = 'deleted') AS deleted, count(*) FILTER (status = 'unchanged') AS unchanged,
         count(*) FILTER (status <> 'deleted') AS total_files FROM v_changes""",
    uses=("v_changes",),
)
def change_summary(spark, d):
    return D.change_summary(_changes(spark, d))


@register("SELECT path, status FROM v_changes WHERE status IN ('added', 'modified')", uses=("v_changes",))
def changed_paths(spark, d):
    return D.changed_paths(_changes(spark, d)).select("path", "status")


@register(
    """SELECT path, status FROM v_changes WHERE status IN ('added', 'modified')
       ORDER BY CASE status WHEN 'added' THEN 0 ELSE 1 END, path LIMIT 50""",
    uses=("v_changes",),
)
def next_batch(spark, d):
    return D.next_batch(_changes(spark, d), W.BASE_MS + 1_000, W.BASE_MS)


@register("SELECT path, status FROM v_changes WHERE false", uses=("v_changes",))
def next_batch_too_soon(spark, d):
    return D.next_batch(_changes(spark, d), W.BASE_MS + 999, W.BASE_MS)


@register(
    """SELECT c.path AS doc_id, c.hash FROM v_curr c LEFT JOIN v_prev p USING (path)
       WHERE p.path IS NULL OR p.mtime_ms <> c.mtime_ms
         OR octet_length(encode(p.content)) <> octet_length(encode(c.content))""",
    uses=("v_curr", "v_prev"),
)
def skip_unchanged(spark, d):
    prev, curr = [
        s.select(F.col("path").alias("doc_id"), "hash", "mtime", F.octet_length("content").alias("size"))
        for s in W.snapshots(spark, d)
    ]
    return D.skip_unchanged(curr, prev).select("doc_id", "hash")


@register(
    """SELECT path, CASE WHEN s.status IN ('added', 'modified') THEN c.hash ELSE p.hash END AS hash,
         CASE WHEN s.status IN ('added', 'modified') THEN c.mtime_ms ELSE p.mtime_ms END AS mtime_ms
       FROM v_changes s LEFT JOIN v_prev p USING (path) LEFT JOIN v_curr c USING (path)""",
    uses=("v_changes",),
)
def mark_synced(spark, d):
    prev, curr = W.snapshots(spark, d)
    done = D.changed_paths(D.detect_changes(prev, curr))
    return D.mark_synced(prev, curr, done).select("path", "hash", F.unix_millis("mtime").alias("mtime_ms"))


@register(
    """SELECT doc_id, lh AS local_hash, rh AS remote_hash, lm AS local_ms, rm AS remote_ms, rv AS remote_version, remote_exists
       FROM v_paired""",
    uses=("v_paired",),
)
def pair_replicas(spark, d):
    local, remote = W.replicas(spark, d)
    return D.pair_replicas(local, remote).select(
        "doc_id", "local_hash", "remote_hash", F.unix_millis("local_mtime").alias("local_ms"),
        F.unix_millis("remote_mtime").alias("remote_ms"), "remote_version", "remote_exists",
    )


@register("SELECT path, status, hash, mtime_ms FROM v_changes WHERE status <> 'unchanged'", uses=("v_changes",))
def detect_changes_tree(spark, d):
    """The changes between two stored listings, by their trees: rows of equal leaves are not read."""
    out = work_dir(spark, "listings")
    stored = []
    for name, listing in zip(("prev", "curr"), W.snapshots(spark, d)):
        T.write_listing(listing, f"{out}/{name}")
        stored.append(T.read_listing(spark, f"{out}/{name}"))
    (prev, prev_tree), (curr, curr_tree) = stored
    found = T.detect_changes_tree(prev, curr, prev_tree, curr_tree)
    return found.select("path", "status", "hash", F.unix_millis("mtime").alias("mtime_ms"))


@register("SELECT path, status, hash, mtime_ms FROM v_changes", uses=("v_changes",))
def detect_changes_tree_whole(spark, d):
    """The same over listings without stored trees, unchanged rows included."""
    prev, curr = [s.select("path", "hash", "mtime") for s in W.snapshots(spark, d)]
    return T.detect_changes_tree(prev, curr, unchanged=True).select("path", "status", "hash", F.unix_millis("mtime").alias("mtime_ms"))


_HOUR = 3_600_000
_LISTING_FILES = 8


view(
    "v_listings",
    """SELECT 0 AS k, path, hash, mtime_ms FROM v_prev UNION ALL SELECT 1, path, hash, mtime_ms FROM v_curr
       UNION ALL SELECT 2, path, hash, mtime_ms FROM v_prev UNION ALL SELECT 3, path, hash, mtime_ms FROM v_prev""",
)
view(
    "v_listing_steps",
    """SELECT path, k, hash, k - lag(k) OVER w AS gap, hash = lag(hash) OVER w AND mtime_ms = lag(mtime_ms) OVER w AS same,
         lead(k) OVER w AS following FROM v_listings WINDOW w AS (PARTITION BY path ORDER BY k)""",
)


@register(
    f"""SELECT path, CASE WHEN gap = 1 THEN 'change' ELSE 'add' END AS event, {W.BASE_MS} + k * {_HOUR} AS ts_ms, hash
        FROM v_listing_steps WHERE gap IS NULL OR gap > 1 OR NOT same
        UNION ALL SELECT path, 'unlink', {W.BASE_MS} + k * {_HOUR}, NULL FROM v_listing_steps
        WHERE (following IS NULL OR following > k + 1) AND k < 3""",
    uses=("v_listing_steps",),
)
def change_stream_from_listings(spark, d):
    """Hourly listings as a stream: the previous snapshot, the current one, and the previous one twice again."""
    out = work_dir(spark, "listed")
    prev, curr = W.snapshots(spark, d)
    for k, listing in enumerate((prev, curr, prev, prev)):
        stamped = listing.select(F.timestamp_millis(F.lit(W.BASE_MS + k * _HOUR)).alias("listed_at"), "path", "hash", "mtime")
        stamped.repartition(_LISTING_FILES, "path").write.mode("append").parquet(f"{out}/source")
    schema = spark.read.parquet(f"{out}/source").schema
    stream = feeds.read_doc_stream(spark, f"{out}/source", schema, files_per_batch=_LISTING_FILES)
    events = listings.change_events(stream, _HOUR, "20 minutes")  # a batch may end inside a listing
    feeds.run_to_table(events, f"{out}/table", f"{out}/checkpoint").awaitTermination()
    return spark.read.schema(events.schema).parquet(f"{out}/table").select("path", "event", F.unix_millis("ts").alias("ts_ms"), "hash")
