"""Version history: record, trim, look up and restore."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark import schemas
from tidemark.functions.core import from_millis, let
from tidemark.functions.paths import archive_key, doc_key
from tidemark.operators.scopes import Rules, scope_filter

_HISTORY = f"array<{schemas.VERSION_ENTRY.simpleString()}>"


def _newest(history: Column, n: int) -> Column:
    return F.slice(history, F.greatest(F.size(history) - n + 1, F.lit(1)), F.lit(n))


def as_history(versions: Column) -> Column:
    """A history column in the standard shape, empty for null."""
    return F.coalesce(versions.cast(_HISTORY), F.array().cast(_HISTORY))


def _history(df: DataFrame) -> Column:
    return as_history(F.col("versions") if "versions" in df.columns else F.lit(None))


def version_entry(
    version: Column, mtime: Column, hash: Column, doc_id: Column, source: Column, conflict: Column
) -> Column:
    return F.struct(
        version.cast("int").alias("version"),
        mtime.alias("mtime"),
        hash.alias("hash"),
        archive_key(doc_id, version).alias("doc_id"),
        source.alias("source"),
        conflict.alias("conflict"),
    )


def appended(history: Column, entry: Column, keep: int = K.KEPT_VERSIONS) -> Column:
    """The history with one more entry, cut to the newest `keep`."""
    grown = F.concat(as_history(history), F.array(entry).cast(_HISTORY))
    return let(grown, lambda h: _newest(h, keep))


def record_version(
    df: DataFrame, source: str | Column, conflict: bool | Column = False, keep: int = K.KEPT_VERSIONS
) -> DataFrame:
    """Appends the row's own version to its history and keeps the newest `keep` entries."""
    entry = version_entry(
        F.col("version"), F.col("mtime"), F.col("hash"), F.col("doc_id"),
        F.lit(source) if isinstance(source, str) else source,
        F.lit(conflict) if isinstance(conflict, bool) else conflict,
    )
    return df.withColumn("versions", appended(_history(df), entry, keep))


def retain_versions(df: DataFrame, n: int = K.KEPT_VERSIONS) -> DataFrame:
    """Keeps the newest `n` entries of each nested history."""
    return df.withColumn("versions", _newest(F.col("versions"), n))


def retain_version_rows(
    df: DataFrame, n: int = K.KEPT_VERSIONS, key: str = "doc_id", order: str = "version"
) -> DataFrame:
    """Keeps the newest `n` rows of each key where versions are rows of their own.

    The rank limit is applied inside each map task before the shuffle, so one file with a third of
    all versions sends at most `n` rows per task.
    """
    newest_first = Window.partitionBy(key).orderBy(F.col(order).desc())
    ranked = df.withColumn("_rank", F.row_number().over(newest_first))
    return ranked.filter(F.col("_rank") <= n).drop("_rank")


def nest_versions(rows: DataFrame, n: int = K.KEPT_VERSIONS) -> DataFrame:
    """Histories as nested lists `(doc_id, versions)` from version rows, trimmed before collecting."""
    kept = retain_version_rows(rows, n)
    entry = version_entry(*[F.col(c) for c in ("version", "mtime", "hash", "doc_id", "source", "conflict")])
    return kept.groupBy("doc_id").agg(F.array_sort(F.collect_list(entry)).alias("versions"))


def version_history(store: DataFrame, requests: DataFrame) -> DataFrame:
    """`(path, found, version, mtime, versions)` for every requested path.

    A document without a version counts as version 1; a missing document gives a row with
    `found = false`.
    """
    held = store.select("doc_id", "version", "mtime", _history(store).alias("versions"), F.lit(True).alias("_found"))
    found = F.coalesce("_found", F.lit(False))
    version = F.coalesce(F.nullif(F.col("version"), F.lit(0)), F.lit(1))
    return (
        requests.select("path", doc_key("path").alias("doc_id"))
        .join(held, "doc_id", "left")
        .select(
            "path",
            found.alias("found"),
            F.when(found, version).alias("version"),
            "mtime",
            F.when(found, F.col("versions")).alias("versions"),
        )
    )


def revert_meta(df: DataFrame, n: int | Column) -> DataFrame:
    """Version, mtime and hash set back to those of entry `n`; rows without that entry are left out."""
    wanted = F.lit(n) if isinstance(n, int) else n
    target = F.get(F.filter(F.col("versions"), lambda v: v["version"] == wanted), F.lit(0))
    return (
        df.withColumn("_target", target)
        .filter(F.col("_target").isNotNull())
        .withColumn("version", F.col("_target.version"))
        .withColumn("mtime", F.col("_target.mtime"))
        .withColumn("hash", F.col("_target.hash"))
        .drop("_target")
    )


def revert_to(
    store: DataFrame,
    requests: DataFrame,
    now_ms: int,
    rules: Rules = K.DEFAULT_SCOPES,
    agent: str = K.DEFAULT_AGENT,
    enforce: bool = True,
) -> DataFrame:
    """New current rows that restore archived versions, for many requests `(path, to_version)` at once.

    Children and hash come from the archived row, the version is the current one plus one, and
    requests outside the agent's scope or for a version not archived give no row. A document is reverted once: of
    several requests that can be met the last by `requested_at` counts (if there is such a column), then that for the highest version.
    """
    asked = scope_filter(requests, rules, agent, enforce=enforce)
    when = F.col("requested_at") if "requested_at" in requests.columns else F.lit(None).cast("timestamp")
    requested = asked.select(doc_key("path").alias("doc_id"), when.alias("at"), F.col("to_version").cast("int").alias("version"))
    archived = F.coalesce(F.col("archived"), F.lit(False))
    old = store.filter(archived).select(
        F.col("doc_id").alias("_archive_id"), F.col("children").alias("_children"), F.col("hash").alias("_hash")
    )
    granted = requested.withColumn("_archive_id", archive_key("doc_id", "version")).join(old.select("_archive_id"), "_archive_id", "left_semi")
    wanted = granted.groupBy("doc_id").agg(F.max(F.struct("at", "version")).getField("version").alias("reverted_from"))
    kept = [c for c in store.columns if c not in ("children", "hash", "mtime", "version", "reverted_from")]
    return (
        store.filter(~archived)
        .drop("reverted_from")
        .join(wanted, "doc_id")
        .withColumn("_archive_id", archive_key("doc_id", "reverted_from"))
        .join(old, "_archive_id")
        .select(
            *kept,
            F.col("_children").alias("children"),
            F.col("_hash").alias("hash"),
            from_millis(now_ms).alias("mtime"),
            (F.col("version") + 1).cast("int").alias("version"),
            "reverted_from",
        )
    )
