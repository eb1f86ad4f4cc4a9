"""Change-feed sources and the micro-batch runner."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemark.functions.core import from_millis


def _read(spark: SparkSession, path: str, schema: StructType, fmt: str, files_per_batch: int | None, consume: bool = False) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt)
    if consume:
        reader = reader.option("cleanSource", "delete")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def _since(df: DataFrame, since_ms: int | None, ts: str) -> DataFrame:
    return df if since_ms is None else df.filter(F.col(ts) >= from_millis(since_ms))


def read_change_stream(
    spark: SparkSession,
    path: str,
    schema: StructType,
    since_ms: int | None = None,
    fmt: str = "parquet",
    ts: str = "ts",
    files_per_batch: int | None = None,
) -> DataFrame:
    """Local change events (add, change, unlink) arriving as files of rows.

    `since_ms` leaves out what happened before the subscription; there is no initial scan.
    """
    return _since(_read(spark, path, schema, fmt, files_per_batch), since_ms, ts)


def read_doc_stream(
    spark: SparkSession,
    path: str,
    schema: StructType,
    since_ms: int | None = None,
    fmt: str = "parquet",
    ts: str = "ts",
    files_per_batch: int | None = None,
    consume: bool = False,
) -> DataFrame:
    """Remote documents, whole, as they are written; `since_ms` is the moment of subscription.

    `consume` is for a folder that this feed alone reads: its files are deleted once the checkpoint has their batch as done, but for the last one's.
    """
    return _since(_read(spark, path, schema, fmt, files_per_batch, consume), since_ms, ts)


def run_feed(
    stream: DataFrame,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    every: str | None = None,
) -> StreamingQuery:
    """Hands each micro-batch to `handle(batch, batch_id)`.

    Without `every` the feed drains what is there and stops. The checkpoint restarts a failed feed
    where it stood, so `handle` must give the same result if a batch comes again.
    """
    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def run_to_table(stream: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Appends the results of a stream to a parquet table, exactly once."""
    writer = stream.writeStream.format("parquet").outputMode("append")
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()
