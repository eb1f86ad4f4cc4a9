"""Whole flows over tables: push, pull, merge and incremental sync."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.functions.core import as_bytes
from tidemark.functions.paths import archive_key, doc_key, first_segment
from tidemark.operators import chunks as C
from tidemark.operators import conflict as X
from tidemark.operators import diff as D
from tidemark.operators import versions as V
from tidemark.operators.audit import audit_rows
from tidemark.operators.filters import live_docs, valid_paths, with_effective_path
from tidemark.operators.merge import merge_conflicts
from tidemark.operators.scopes import Rules, scope_filter, scope_verdict


def _described(df: DataFrame, *extras: str) -> DataFrame:
    """Key, hash and times of files, without their content; a hash that is stored is not computed again."""
    own = df if "hash" in df.columns else C.with_hash(df)
    return own.select("doc_id", "hash", "mtime", *[c for c in extras if c in df.columns])


def sync_with_merge(
    local: DataFrame,
    remote: DataFrame,
    base: DataFrame,
    strategy: str | Column = "last-write-wins",
    chunk_bytes: int = K.CHUNK_BYTES,
    auto_merge: bool = True,
) -> DataFrame:
    """The outcome of syncing each local file `(doc_id, path, content, mtime)` over its remote copy.

    `(doc_id, path, outcome, action, hash, size, children, version, mtime, versions, content)`. Files
    without a conflict keep the local text. In a conflict a clean merge of the three texts wins;
    otherwise the strategy decides: `outcome` is new, unchanged, merged, local, remote or both. The
    remote version that is overwritten is appended to the history. `content` is the text to write
    locally: the merged or the remote one, null where the local file stands.

    Files are paired by hash and time alone; only those in conflict have their three texts brought
    together, so the cost of the merge follows the number of conflicts. Rows that share a key are one document: of
    local, remote and base its newest row counts (then the first by path, then by hash).
    """
    raw = as_bytes("content")
    mine = local.select(
        "doc_id", "path", "mtime", F.sha2(raw, 256).alias("hash"), F.octet_length(raw).cast("long").alias("size"),
        C.child_ids(raw, chunk_bytes).alias("children"),
    )
    mine = X.newest_docs(mine)
    theirs = X.newest_docs(_described(remote, "version", "versions", "path")).drop("path")
    decided = X.resolve(D.pair_replicas(mine, theirs), strategy)

    clashes = decided.filter("conflict").select("doc_id", F.col("local_path").alias("path"))

    def texts(side: DataFrame, name: str) -> DataFrame:
        # The conflicts lead, so a side is cut down to them before its texts are hashed or ranked.
        few = side.join(clashes.select("doc_id"), "doc_id", "left_semi")
        hashed = few if "hash" in few.columns else C.with_hash(few)
        kept = [c for c in ("mtime", "path") if c in few.columns]
        return X.newest_docs(hashed.select("doc_id", "hash", *kept, F.col("content").alias(name))).select("doc_id", name)

    named = (
        clashes.join(local.select("doc_id", "path", F.col("content").alias("local")), ["doc_id", "path"])
        .join(texts(remote, "remote"), "doc_id")
        .join(texts(base, "base"), "doc_id", "left")
    )
    merged = merge_conflicts(named.withColumn("base", F.coalesce("base", F.lit("")))).select(
        "doc_id", "merged", "has_conflicts", F.col("remote").alias("_remote_text")
    )

    clean = F.col("conflict") & ~F.coalesce("has_conflicts", F.lit(True)) & F.lit(auto_merge)
    took_remote = F.col("conflict") & ~clean & (F.col("winner") == "remote")
    outcome = (
        F.when(~F.col("remote_exists"), "new")
        .when(~F.col("conflict"), "unchanged")
        .when(clean, "merged")
        .otherwise(F.col("winner"))
    )
    old_version = F.coalesce("remote_version", F.lit(0)) if "version" in theirs.columns else F.lit(0)
    history = F.col("remote_versions") if "versions" in theirs.columns else F.lit(None)
    overwritten = V.version_entry(
        old_version, F.col("remote_mtime"), F.col("remote_hash"), F.col("doc_id"), F.lit("remote"), F.lit(True)
    )
    out = decided.join(merged, "doc_id", "left").select(
        "doc_id",
        F.col("local_path").alias("path"),
        outcome.alias("outcome"),
        F.when(clean, "merged").otherwise(F.col("action")).alias("action"),
        F.when(took_remote, old_version).otherwise(old_version + 1).cast("int").alias("version"),
        F.when(took_remote, F.col("remote_mtime")).otherwise(F.col("local_mtime")).alias("mtime"),
        F.when(F.col("conflict") & ~took_remote, V.appended(history, overwritten))
        .otherwise(V.as_history(history))
        .alias("versions"),
        F.when(clean, F.col("merged")).when(took_remote, F.col("_remote_text")).alias("content"),
        "local_hash", "local_size", "local_children",
    )
    replaced = F.col("content").isNotNull()
    text = as_bytes("content")
    return out.select(
        "doc_id", "path", "outcome", "action",
        F.when(replaced, F.sha2(text, 256)).otherwise(F.col("local_hash")).alias("hash"),
        F.when(replaced, F.octet_length(text).cast("long")).otherwise(F.col("local_size")).alias("size"),
        F.when(replaced, C.child_ids(text, chunk_bytes)).otherwise(F.col("local_children")).alias("children"),
        "version", "mtime", "versions", "content",
    )


@dataclass(frozen=True)
class Synced:
    """What a sync writes: documents, chunks the store lacks, archived versions and audit rows."""

    documents: DataFrame
    chunks: DataFrame
    archives: DataFrame
    audit: DataFrame


def sync(
    local: DataFrame,
    remote: DataFrame,
    base: DataFrame,
    store_chunks: DataFrame,
    rules: Rules = K.DEFAULT_SCOPES,
    agent: str = K.DEFAULT_AGENT,
    enforce: bool = True,
    strategy: str | Column = "last-write-wins",
    chunk_bytes: int = K.CHUNK_BYTES,
    settle: Callable[[DataFrame], DataFrame] | None = None,
) -> Synced:
    """A whole sync of local files over their remote documents.

    Paths outside the agent's scope are refused before a byte of theirs is read, and are in the audit alone. Documents are
    those of `sync_with_merge`. Their new texts are chunked, and every remote version that is
    overwritten leaves an archived row `<doc>.v<n>` with its children, so it can be restored. Chunks, archives and audit
    are derived from the documents; `settle` may write these and give them back as read, so that the texts are compared once.
    """
    asked = local.select("doc_id", "path", "mtime")
    refused = scope_verdict(asked, rules, agent, enforce=enforce).filter(~F.col("allowed"))
    visible = scope_filter(local, rules, agent, enforce=enforce)
    documents = sync_with_merge(visible, remote, base, strategy, chunk_bytes)
    documents = settle(documents) if settle else documents

    stored = documents.filter(F.col("outcome").isin("new", "local", "both", "merged"))
    texts = visible.select("doc_id", "path", F.col("content").alias("_own"))
    written = stored.select("doc_id", "path", "content").join(texts, ["doc_id", "path"]).select(
        "doc_id", F.coalesce(as_bytes("content"), as_bytes("_own")).alias("content")
    )
    if settle and "bucket" in store_chunks.columns:  # the ids to look for stand in what was written
        store_chunks = C.fetch(store_chunks.select("bucket", "chunk_id"), C.listed_ids(stored))
    pieces = C.new_chunks(C.with_chunk_id(C.chunk_files(written, chunk_bytes)), store_chunks)

    lost = documents.filter(F.col("outcome").isin("local", "both", "merged")).select("doc_id")
    kept = [c for c in ("path", "children", "mtime", "hash", "size") if c in remote.columns]
    version = F.coalesce("version", F.lit(0)) if "version" in remote.columns else F.lit(0)
    slim = [c for c in remote.columns if c not in ("content", "data")]
    archives = X.newest_docs(remote.select(slim).join(lost, "doc_id", "left_semi")).select(
        archive_key("doc_id", version).alias("doc_id"), *kept, version.cast("int").alias("version"),
        F.lit("plain").alias("type"), F.lit(True).alias("archived"),
    )
    rows = [
        audit_rows(
            df, "sync_file", status, message, ts="mtime", seq=F.xxhash64("path"), path=F.col("path"),
            scope=first_segment(doc_key("path")),
        )
        for df, status, message in (
            (documents, "success", F.concat(F.lit("synced: "), "outcome")),
            (refused, "error", F.col("reason")),
        )
    ]
    return Synced(documents, pieces, archives, rows[0].unionByName(rows[1]))


def push(
    listing: DataFrame,
    store_files: DataFrame,
    store_chunks: DataFrame,
    rules: Rules = K.DEFAULT_SCOPES,
    agent: str = K.DEFAULT_AGENT,
    enforce: bool = True,
    chunk_bytes: int = K.CHUNK_BYTES,
) -> tuple[DataFrame, DataFrame]:
    """File documents and new chunks of a push of `(path, content, mtime)`, with `size` if it is known.

    Files unchanged by (mtime, size) are left out before any of their bytes is hashed or chunked. Paths that share a
    key are one document: its newest file counts.
    """
    visible = scope_filter(listing, rules, agent, enforce=enforce).withColumn("doc_id", doc_key("path"))
    if "size" not in listing.columns:
        visible = visible.withColumn("size", F.octet_length(as_bytes("content")).cast("long"))
    newest = X.newest_docs(visible.select("doc_id", "path", "mtime", "size"))
    todo = D.skip_unchanged(newest, store_files).select("doc_id", "path")
    changed = visible.join(todo, ["doc_id", "path"], "left_semi")
    pieces = C.with_chunk_id(C.chunk_files(changed, chunk_bytes))
    return D.upsert_docs(store_files, C.file_documents(changed, chunk_bytes)), C.new_chunks(pieces, store_chunks)


def pull(
    files: DataFrame,
    chunks: DataFrame,
    rules: Rules = K.DEFAULT_SCOPES,
    agent: str = K.DEFAULT_AGENT,
    enforce: bool = True,
    strict: bool = False,
) -> DataFrame:
    """Every live file an agent may see, rebuilt from its chunks.

    Of a stored chunk table (one with `bucket`), only the chunks of those files are fetched (see `chunks.fetch`, which acts).
    """
    named = with_effective_path(live_docs(files))
    visible = X.newest_docs(scope_filter(valid_paths(named), rules, agent, enforce=enforce))
    if "bucket" in chunks.columns:
        chunks = C.fetch(chunks, C.listed_ids(visible))
    return C.reassemble(visible, chunks, strict=strict)
