"""Debounced change events. Every function takes a streaming or a batch frame."""

from __future__ import annotations

from pyspark.sql import DataFrame, GroupedData, Window
from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.functions.core import from_millis
from tidemark.functions.paths import first_segment


def debounce(events: DataFrame, gap_ms: int = K.DEBOUNCE_MS, watermark: str = "10 minutes") -> DataFrame:
    """One row per path and burst: the last event of events no more than `gap_ms` apart.

    `(path, event, ts, closes, events)`, with `ts` the time of the last event and `closes` the time
    the burst ended. On a stream a burst is given out once the watermark has passed its close. With a
    gap of the write-stability wait the same operator tells when a file has settled.

    `closes` is worked out from the last event and not read from the session window: a filter on the
    window itself moves below the grouping, where it would cut the early events off a burst.
    """
    if events.isStreaming:
        window = F.session_window("ts", f"{gap_ms} milliseconds")
        bursts = _newest(events.withWatermark("ts", watermark).groupBy("path", window))
    else:
        bursts = _batch_bursts(events, gap_ms)
    closes = F.col("last") + F.expr(f"INTERVAL '{gap_ms / 1000:.3f}' SECOND")
    return bursts.select("path", "event", F.col("last").alias("ts"), closes.alias("closes"), "events")


def _newest(groups: GroupedData) -> DataFrame:
    """First and last time, last event and number of each group."""
    return groups.agg(
        F.max_by("event", F.struct("ts", "seq")).alias("event"),
        F.max_by("seq", F.struct("ts", "seq")).alias("seq"),
        F.min("ts").alias("first"),
        F.max("ts").alias("last"),
        F.count("*").alias("events"),
    )


def _batch_bursts(events: DataFrame, gap_ms: int) -> DataFrame:
    """Bursts of a table, found hour by hour and joined across hours.

    A path may hold a third of all events, so its events are not gathered in one task: they are
    grouped by path and hour (or four gaps, if that is longer). Only bursts within a gap of the edge of
    their hour can go on in another one; those, at most two per path and hour, are chained by path.
    Every other burst is whole and forms a group of its own.
    """
    step = max(3_600_000, 4 * gap_ms)
    window = F.session_window("ts", f"{gap_ms} milliseconds")
    hourly = _newest(
        events.withColumn("_hour", F.expr(f"{_millis(events)} DIV {step}L")).groupBy("path", "_hour", window)
    ).drop("session_window")
    begins = F.expr(f"{_millis(events, 'first')} - _hour * {step}L")
    ends = F.expr(f"(_hour + 1) * {step}L - {_millis(events, 'last')}")
    at_edge = (begins <= gap_ms + 1) | (ends <= gap_ms + 1)
    hourly = hourly.withColumn("_alone", F.when(~at_edge, F.col("first"))).drop("_hour")
    by_time = Window.partitionBy("path", "_alone").orderBy("first")
    since = F.col("first") - F.lag("last").over(by_time)
    starts = F.when(since <= F.expr(f"INTERVAL '{gap_ms / 1000:.3f}' SECOND"), 0).otherwise(1)
    chained = hourly.withColumn("_starts", starts).withColumn(
        "_burst", F.sum("_starts").over(by_time.rowsBetween(Window.unboundedPreceding, 0))
    )
    return chained.groupBy("path", "_alone", "_burst").agg(
        F.max_by("event", F.struct("last", "seq")).alias("event"),
        F.max("last").alias("last"),
        F.sum("events").cast("long").alias("events"),
    )


def _millis(events: DataFrame, column: str = "ts") -> str:
    """SQL: whole milliseconds of a time, for instants and zone-less times alike."""
    if dict(events.dtypes)["ts"] == "timestamp_ntz":
        return f"timestampdiff(MILLISECOND, timestamp_ntz'1970-01-01', {column})"
    return f"unix_millis({column})"


def pending_events(events: DataFrame, now_ms: int, gap_ms: int = K.DEBOUNCE_MS) -> DataFrame:
    """Bursts that are still open at `now_ms`, of the events known by then."""
    now = from_millis(now_ms)
    return debounce(events.filter(F.col("ts") <= now), gap_ms).filter(F.col("closes") > now)


def enrich_events(events: DataFrame, files: DataFrame) -> DataFrame:
    """Adds the current content hash to add and change events; unlink events carry none."""
    known = files.select("path", F.col("hash").alias("_hash"))
    hashed = F.when(F.col("event").isin("add", "change"), F.col("_hash"))
    # Debounced events of one path are few, and a plain join runs the debounce once.
    return events.join(known, "path", "left").select(*events.columns, hashed.alias("hash"))


def route_events(events: DataFrame) -> DataFrame:
    """Adds `route`, `status`, `message` and `scope` to enriched events.

    Unlinks are only reported, the others go to sync; an event whose file is gone is recorded as an
    error and does not hold up the rest.
    """
    gone = F.col("event") == "unlink"
    lost = ~gone & F.col("hash").isNull()
    return (
        events.withColumn("route", F.when(gone, "report").when(lost, "failed").otherwise("sync"))
        .withColumn("status", F.when(lost, "error").otherwise("success"))
        .withColumn(
            "message",
            F.when(gone, "file removed")
            .when(lost, "auto-sync failed: file not found")
            .otherwise(F.concat(F.lit("auto-synced: "), F.col("event"))),
        )
        .withColumn("scope", first_segment("path"))
    )


def dedupe_stream(chunks: DataFrame, watermark: str = "10 minutes") -> DataFrame:
    """Each chunk id once. On a stream its state is kept for the watermark delay, not for ever."""
    if not chunks.isStreaming:
        return chunks.dropDuplicates(["chunk_id"])
    return chunks.withWatermark("ts", watermark).dropDuplicatesWithinWatermark(["chunk_id"])
