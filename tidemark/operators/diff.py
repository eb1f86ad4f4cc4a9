"""Snapshot comparison, pairing, batching and upsert.

Listings have one row per path, so every join here is an equality join on a unique key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.operators.conflict import newest_docs


def detect_changes(prev: DataFrame, curr: DataFrame) -> DataFrame:
    """`(path, status, hash, mtime)`: added, modified, deleted or unchanged.

    A path is modified if its hash or its mtime differs, and added if the previous hash is missing
    or empty.
    """
    p = prev.select("path", F.col("hash").alias("_ph"), F.col("mtime").alias("_pm"), F.lit(True).alias("_was"))
    c = curr.select("path", "hash", "mtime", F.lit(True).alias("_is"))
    same = F.col("_ph").eqNullSafe(F.col("hash")) & F.col("_pm").eqNullSafe(F.col("mtime"))
    status = (
        F.when(F.col("_is").isNull(), "deleted")
        .when(F.coalesce("_ph", F.lit("")) == "", "added")
        .when(same, "unchanged")
        .otherwise("modified")
    )
    return p.join(c, "path", "full_outer").select("path", status.alias("status"), "hash", "mtime")


def change_summary(changes: DataFrame) -> DataFrame:
    """One row of counts; `total_files` leaves out deleted paths."""
    status = F.col("status")
    return changes.agg(
        *[F.count_if(status == s).alias(s) for s in ("added", "modified", "deleted", "unchanged")],
        F.count_if(status != "deleted").alias("total_files"),
    )


def changed_paths(changes: DataFrame) -> DataFrame:
    """Added and modified paths together."""
    return changes.filter(F.col("status").isin("added", "modified"))


def next_batch(
    changes: DataFrame,
    now_ms: int | Column,
    last_batch_ms: int | Column,
    n: int = K.SYNC_BATCH_FILES,
    min_delay_ms: int = K.MIN_BATCH_DELAY_MS,
) -> DataFrame:
    """The first `n` changes, added before modified, then by path; none within the minimum delay."""
    due = (F.lit(now_ms) - F.lit(last_batch_ms)) >= min_delay_ms
    rank = F.when(F.col("status") == "added", 0).otherwise(1)
    return changed_paths(changes).filter(due).orderBy(rank, "path").limit(n).select("path", "status")


def skip_unchanged(curr: DataFrame, store: DataFrame) -> DataFrame:
    """Rows of `curr` whose (whole-millisecond mtime, size) the store does not hold under their key."""
    known = store.select("doc_id", F.unix_millis("mtime").alias("_ms"), F.col("size").alias("_size"))
    fresh = F.col("_ms").eqNullSafe(F.unix_millis("mtime")) & F.col("_size").eqNullSafe(F.col("size"))
    return curr.join(known, "doc_id", "left").filter(~fresh | F.col("_ms").isNull()).select(*curr.columns)


def update_state(scan: DataFrame) -> DataFrame:
    """The snapshot that replaces the state after a full sync."""
    return scan.select("path", "hash", "mtime")


def mark_synced(state: DataFrame, scan: DataFrame, paths: DataFrame) -> DataFrame:
    """State with the given paths taken from the scan; every other row stays as it is."""
    done = scan.join(paths.select("path").distinct(), "path", "left_semi").select("path", "hash", "mtime")
    return state.select("path", "hash", "mtime").join(done, "path", "left_anti").unionByName(done)


def pair_replicas(local: DataFrame, remote: DataFrame, key: str = "doc_id") -> DataFrame:
    """Each local row beside the remote row of the same key, as `local_*` and `remote_*`."""
    left = local.select(key, *[F.col(c).alias(f"local_{c}") for c in local.columns if c != key])
    right = remote.select(
        key, *[F.col(c).alias(f"remote_{c}") for c in remote.columns if c != key], F.lit(True).alias("remote_exists")
    )
    return left.join(right, key, "left").withColumn("remote_exists", F.coalesce("remote_exists", F.lit(False)))


def upsert_docs(current: DataFrame, incoming: DataFrame, key: str = "doc_id") -> DataFrame:
    """`current` with `incoming` put over it, in one full outer join.

    A replaced document keeps its `ctime` and every column that `incoming` lacks; its `version` goes
    up by one. A new document starts at version 1. Of incoming rows with one key the newest counts.
    """
    incoming = newest_docs(incoming, key)
    cur = current.select(key, F.struct(*[c for c in current.columns if c != key]).alias("_c"))
    inc = incoming.select(key, F.struct(*[c for c in incoming.columns if c != key]).alias("_i"))
    arrives = F.col("_i").isNotNull()
    names = [c for c in current.columns if c != key] + [
        c for c in incoming.columns if c != key and c not in current.columns
    ]
    out = [F.col(key)]
    for name in names:
        old = F.col(f"_c.{name}") if name in current.columns else F.lit(None)
        new = F.col(f"_i.{name}") if name in incoming.columns else None
        if name == "ctime" and new is not None:
            value = F.coalesce(old, new)
        elif name == "version":
            value = F.when(arrives, F.coalesce(old, F.lit(0)) + 1).otherwise(old).cast("int")
        elif new is not None:
            value = F.when(arrives, new).otherwise(old)
        else:
            value = old
        out.append(value.alias(name))
    if "version" not in names:
        out.append(F.when(arrives, F.lit(1)).alias("version"))
    return cur.join(inc, key, "full_outer").select(*out)
