"""Following local changes: debounced events in, synced documents and audit rows out."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark import constants as K
from tidemark.operators.audit import audit_rows
from tidemark.operators.chunks import with_hash
from tidemark.operators.filters import ignore_filter, watched_filter
from tidemark.operators.scopes import Rules, scope_verdict
from tidemark.plans.pipelines import sync
from tidemark.sources.sinks import read_chunks, write_chunks
from tidemark.streaming.events import debounce, enrich_events, route_events
from tidemark.streaming.feeds import run_feed


def follow_local(
    events: DataFrame,
    files: Callable[[], DataFrame],
    remote: Callable[[], DataFrame],
    base: Callable[[], DataFrame],
    folder: str,
    gap_ms: int = K.DEBOUNCE_MS,
    watermark: str = "10 minutes",
    strategy: str | Column = "last-write-wins",
    every: str | None = None,
    watched: Sequence[str] | None = None,
    rules: Rules = K.DEFAULT_SCOPES,
    agent: str = K.DEFAULT_AGENT,
    enforce: bool = False,
    chunk_bytes: int = K.CHUNK_BYTES,
) -> StreamingQuery:
    """Syncs the files behind each batch of debounced events.

    `files`, `remote` and `base` give the frames of `sync` as they stand at the time of the batch; they are cut down
    to the batch's paths and keys before anything of theirs is hashed. Events on ignored paths are passed over, as are those
    outside the `watched` folders (None: all folders); with `enforce`, events outside the agent's scope are refused. Results go to
    `folder`: `bursts`, `documents`, `archives` and `audit` by batch, and `chunks` by bucket. Removed files are only
    reported, and an event whose file is gone is recorded as an error beside the others.
    """

    spark = events.sparkSession

    def handle(batch: DataFrame, batch_id: int) -> None:
        # Written first, since every use of the batch would otherwise run the stateful debounce again.
        bursts = f"{folder}/bursts/batch={batch_id}"
        seen = ignore_filter(batch if watched is None else watched_filter(batch, watched))
        seen.write.mode("overwrite").parquet(bursts)
        closed = spark.read.schema(batch.schema).parquet(bursts)
        if closed.isEmpty():
            return
        paths = closed.select("path").distinct()
        local = files().join(paths, "path", "left_semi")
        known = local.select("path", "hash") if "hash" in local.columns else with_hash(local).select("path", "hash")
        judged = scope_verdict(closed, rules, agent, enforce=enforce).drop("scope")
        routed = route_events(enrich_events(judged, known))
        refused = ~F.col("allowed")
        routed = routed.withColumns({
            "route": F.when(refused, "refused").otherwise(F.col("route")),
            "status": F.when(refused, "error").otherwise(F.col("status")),
            "message": F.when(refused, F.col("reason")).otherwise(F.col("message")),
        })
        wanted = routed.filter("route = 'sync'").select("path").distinct()
        todo = local.join(wanted, "path", "left_semi").persist()
        keys = todo.select("doc_id")
        theirs, before = [side().join(keys, "doc_id", "left_semi") for side in (remote, base)]

        def settle(documents: DataFrame) -> DataFrame:
            out = f"{folder}/documents/batch={batch_id}"
            documents.write.mode("overwrite").parquet(out)
            return spark.read.schema(documents.schema).parquet(out)

        stored = read_chunks(spark, f"{folder}/chunks")
        done = sync(todo, theirs, before, stored, enforce=False, strategy=strategy, chunk_bytes=chunk_bytes, settle=settle)
        done.archives.write.mode("overwrite").parquet(f"{folder}/archives/batch={batch_id}")
        write_chunks(done.chunks, f"{folder}/chunks", "append")
        rows = audit_rows(
            routed, "sync_file", F.col("status"), F.col("message"), seq=F.xxhash64("path", "ts"), path=F.col("path"),
            scope=F.col("scope"),
        )
        rows.write.mode("overwrite").parquet(f"{folder}/audit/batch={batch_id}")
        todo.unpersist()

    return run_feed(debounce(events, gap_ms, watermark), handle, f"{folder}/checkpoint", every)
