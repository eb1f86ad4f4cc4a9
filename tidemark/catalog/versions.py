"""Conflicts between replicas and version histories."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog import shared_sql  # noqa: F401
from tidemark.catalog.registry import register, view
from tidemark.operators import conflict as X
from tidemark.operators import diff as D
from tidemark.operators import versions as V
from tidemark.plans import views as W


def _paired(spark, d):
    return D.pair_replicas(*W.replicas(spark, d))


def _strategy():
    """Every strategy in turn, and one that does not exist."""
    names = F.array(*[F.lit(s) for s in ("last-write-wins", "remote-wins", "local-wins", "keep-both", "other")])
    return F.get(names, F.col("local_n") % 5)


view(
    "v_resolved",
    """SELECT *, CASE WHEN NOT conflict THEN 'local' WHEN n % 5 = 0 AND rm > lm THEN 'remote' WHEN n % 5 = 1 THEN 'remote'
         WHEN n % 5 = 3 THEN 'both' ELSE 'local' END AS winner,
         CASE WHEN NOT conflict THEN 'no conflict'
              WHEN n % 5 = 0 THEN CASE WHEN lm > rm THEN 'local is newer' WHEN rm > lm THEN 'remote is newer'
                ELSE 'same mtime, local wins (tiebreaker)' END
              ELSE (['remote-wins strategy', 'local-wins strategy', 'keeping both versions',
                     'unknown strategy, defaulting to local'])[n % 5] END AS action
       FROM v_paired""",
)


def _resolved(spark, d):
    return X.resolve(_paired(spark, d), _strategy())


@register("SELECT doc_id, conflict FROM v_paired", uses=("v_paired",))
def has_conflict(spark, d):
    return X.has_conflict(_paired(spark, d)).select("doc_id", "conflict")


@register("SELECT doc_id, conflict, winner, action FROM v_resolved", uses=("v_resolved",))
def resolve(spark, d):
    return _resolved(spark, d).select("doc_id", "conflict", "winner", "action")


@register(
    """SELECT doc_id, conflict, CASE WHEN conflict AND rm > lm THEN 'remote' ELSE 'local' END AS winner FROM v_paired""",
    uses=("v_paired",),
)
def resolve_last_write(spark, d):
    return X.resolve(_paired(spark, d)).select("doc_id", "conflict", "winner")


@register(
    """SELECT path, seq, event FROM (SELECT *, row_number() OVER (PARTITION BY path ORDER BY date_trunc('hour', ts) DESC,
         CASE event WHEN 'add' THEN 0 ELSE 1 END, seq) AS rn FROM v_events) WHERE rn = 1""",
    uses=("v_events",),
)
def latest_write(spark, d):
    e = W.change_events(spark, d).withColumn("hour", F.date_trunc("HOUR", "ts"))
    return X.latest_write(e, "path", "hour", F.col("event") == "add", "seq").select("path", "seq", "event")


@register(
    """SELECT doc_id, winner, CASE WHEN winner = 'remote' THEN rh ELSE lh END AS hash,
         CASE WHEN winner = 'remote' THEN rm ELSE lm END AS mtime_ms FROM v_resolved""",
    uses=("v_resolved",),
)
def apply_resolution(spark, d):
    return X.apply_resolution(_resolved(spark, d)).select(
        "doc_id", "winner", "hash", F.unix_millis("mtime").alias("mtime_ms")
    )


@register(
    """SELECT doc_id || '.v' || rv AS doc_id, path, rh AS hash, rm AS mtime_ms, rv AS version, true AS archived
       FROM v_resolved WHERE conflict AND winner <> 'remote'""",
    uses=("v_resolved",),
)
def archive_rows(spark, d):
    return X.archive_rows(_resolved(spark, d)).select(
        "doc_id", "path", "hash", F.unix_millis("mtime").alias("mtime_ms"), "version", "archived"
    )


view(
    "v_newest",
    "SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY version DESC) AS age FROM v_versions",
)


def _shown(history):
    """A history as text: version, source and hash of each entry."""
    return F.array_join(
        F.transform(history, lambda v: F.concat_ws(":", v["version"].cast("string"), v["source"], v["hash"])), ","
    )


_LIST = "string_agg(version || ':' || source || ':' || hash, ',' ORDER BY version)"


def _store(spark, d, n=10):
    """The newest version of each file with the history of all its versions."""
    rows = W.version_rows(spark, d)
    newest = V.retain_version_rows(rows, 1)
    return newest.join(V.nest_versions(rows, n), "doc_id", "left")


@register(
    f"SELECT doc_id, max(version)::INTEGER AS version, {_LIST} AS versions FROM v_newest WHERE age <= 10 GROUP BY doc_id",
    uses=("v_newest",),
)
def record_version(spark, d):
    """The newest version is recorded on top of a history of the earlier ones."""
    rows = W.version_rows(spark, d)
    newest = V.retain_version_rows(rows, 1)
    earlier = rows.join(
        newest.select("doc_id", F.col("version").alias("_top")), "doc_id"
    ).filter(F.col("version") < F.col("_top")).drop("_top")
    current = newest.join(V.nest_versions(earlier), "doc_id", "left")
    recorded = V.record_version(current, F.col("source"), F.col("conflict"))
    return recorded.select("doc_id", "version", _shown(F.col("versions")).alias("versions"))


@register(
    f"SELECT doc_id, {_LIST} AS versions FROM v_newest WHERE age <= 3 GROUP BY doc_id", uses=("v_newest",)
)
def retain_versions(spark, d):
    return V.retain_versions(_store(spark, d), 3).select("doc_id", _shown(F.col("versions")).alias("versions"))


@register("SELECT doc_id, version::INTEGER AS version, hash FROM v_newest WHERE age <= 3", uses=("v_newest",))
def retain_version_rows(spark, d):
    return V.retain_version_rows(W.version_rows(spark, d), 3).select("doc_id", "version", "hash")


@register(
    f"SELECT doc_id, {_LIST} AS versions FROM v_newest WHERE age <= 10 GROUP BY doc_id", uses=("v_newest",)
)
def nest_versions(spark, d):
    return V.nest_versions(W.version_rows(spark, d)).select("doc_id", _shown(F.col("versions")).alias("versions"))


@register(
    """SELECT r.path, s.doc_id IS NOT NULL AS found, s.version, s.mtime_ms, s.entries
       FROM (SELECT DISTINCT path FROM v_versions UNION ALL SELECT path FROM v_files) r
       LEFT JOIN (SELECT doc_id, max(version)::INTEGER AS version, max(mtime_ms) AS mtime_ms,
                    least(count(*), 10)::INTEGER AS entries FROM v_versions GROUP BY doc_id) s ON s.doc_id = lower(r.path)""",
    uses=("v_versions", "v_files"),
)
def version_history(spark, d):
    """Asks for every versioned file and for every document, which has no version."""
    asked = W.version_rows(spark, d).select("path").distinct().unionByName(W.files(spark, d).select("path"))
    return V.version_history(_store(spark, d), asked).select(
        "path", "found", "version", F.unix_millis("mtime").alias("mtime_ms"), F.size("versions").alias("entries")
    )


@register(
    "SELECT doc_id, version::INTEGER AS version, hash, mtime_ms FROM v_versions WHERE version = 2", uses=("v_versions",)
)
def revert_meta(spark, d):
    return V.revert_meta(_store(spark, d), 2).select(
        "doc_id", "version", "hash", F.unix_millis("mtime").alias("mtime_ms")
    )


@register(
    """SELECT c.doc_id, (c.version + 1)::INTEGER AS version, a.hash, a.version::INTEGER AS reverted_from, 1706745600000 AS mtime_ms
       FROM v_newest c JOIN v_newest a ON a.doc_id = c.doc_id AND a.version = c.version - 1
       WHERE c.age = 1 AND regexp_matches(c.path, '^(000|001|002|003|004|005)')""",
    uses=("v_newest",),
)
def revert_to(spark, d):
    """Every file is asked back to the version before its newest; scopes decide which go through."""
    store, newest = _with_archives(spark, d)
    wanted = newest.select("path", (F.col("version") - 1).alias("to_version"))
    return _reverted(V.revert_to(store, wanted, W.END_MS, agent="owner"))


@register(
    """SELECT c.doc_id, (c.version + 1)::INTEGER AS version, a.hash, 1::INTEGER AS reverted_from, 1706745600000 AS mtime_ms
       FROM v_newest c JOIN v_newest a ON a.doc_id = c.doc_id AND a.version = 1
       WHERE c.age = 1 AND c.version > 1 AND regexp_matches(c.path, '^(000|001|002|003|004|005)')""",
    uses=("v_newest",),
)
def revert_repeated(spark, d):
    """Every file is asked back twice to the version before its newest, and later once to its first: one row each."""
    store, newest = _with_archives(spark, d)
    early = newest.select("path", (F.col("version") - 1).alias("to_version"), F.timestamp_millis(F.lit(W.BASE_MS)).alias("requested_at"))
    late = early.withColumns({"to_version": F.lit(1), "requested_at": F.timestamp_millis(F.lit(W.BASE_MS + 1))})
    return _reverted(V.revert_to(store, early.unionByName(early).unionByName(late), W.END_MS, agent="owner"))


def _with_archives(spark, d):
    """Current rows beside all older versions as archived rows; and the current rows alone."""
    rows = W.version_rows(spark, d).withColumn("children", F.array("hash"))
    newest = V.retain_version_rows(rows, 1)
    current = newest.withColumn("archived", F.lit(False))
    archived = (
        rows.join(newest.select("doc_id", F.col("version").alias("_top")), "doc_id")
        .filter(F.col("version") < F.col("_top"))
        .withColumn("doc_id", F.concat("doc_id", F.lit(".v"), F.col("version").cast("string")))
        .withColumn("archived", F.lit(True))
        .drop("_top")
    )
    return current.unionByName(archived), newest


def _reverted(back):
    return back.select("doc_id", "version", "hash", "reverted_from", F.unix_millis("mtime").alias("mtime_ms"))
