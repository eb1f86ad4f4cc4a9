"""The newest rows of a growing log, kept up to date batch by batch."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from tidemark import constants as K
from tidemark.operators.audit import retain_audit
from tidemark.session import remove
from tidemark.sources.sinks import absent
from tidemark.streaming.feeds import run_feed

MERGE_EVERY = 16  # batches after which their rows are merged into one table


def _table(spark: SparkSession, path: str, schema: StructType, mark: str) -> DataFrame | None:
    """The rows of all folders `mark=N` below a path, with N as a column; None if there are none yet."""
    try:
        return spark.read.schema(StructType([*schema.fields, StructField(mark, LongType())])).parquet(path)
    except AnalysisException as error:
        absent(error)
        return None


def _merged_upto(spark: SparkSession, path: str, below: int | None = None) -> int:
    """The last batch that a complete merge holds, -1 if there is none. The mark is written after the merge it tells of."""
    marks = _table(spark, f"{path}/marks", StructType(), "upto")
    if marks is not None and below is not None:
        marks = marks.filter(F.col("upto") < below)
    newest = None if marks is None else marks.agg(F.max("upto")).first()[0]
    return -1 if newest is None else newest


def _rows(spark: SparkSession, path: str, schema: StructType, base: int, last: int | None = None) -> DataFrame | None:
    """What the merge up to `base` and the batches after it hold."""
    later = _table(spark, f"{path}/batches", schema, "batch")
    if later is None:
        return None
    later = later.filter(F.col("batch") > base)
    later = (later if last is None else later.filter(F.col("batch") <= last)).drop("batch")
    return later if base < 0 else spark.read.schema(schema).parquet(f"{path}/merged/upto={base}").unionByName(later)


def fold_batch(batch: DataFrame, number: int, path: str, n: int, per: str | None, merge_every: int) -> None:
    """Writes the newest `n` rows of a batch, and after every `merge_every` batches those of all so far.

    The newest rows of a union are among the newest of its parts, so nothing that counts is lost by cutting each batch first. A batch that comes
    again writes the same folders again: its merge starts from the merge before it, whose number is below its own.
    """
    spark = batch.sparkSession
    retain_audit(batch, n, per).write.mode("overwrite").parquet(f"{path}/batches/batch={number}")
    if (number + 1) % merge_every:
        return
    base = _merged_upto(spark, path, below=number)
    rows = _rows(spark, path, batch.schema, base, number)
    retain_audit(rows, n, per).write.mode("overwrite").parquet(f"{path}/merged/upto={number}")
    spark.range(1).coalesce(1).write.mode("overwrite").parquet(f"{path}/marks/upto={number}")
    # A repeated batch, and a reader that began before, still find the merge before and what came after it.
    for old in range(max(base - merge_every + 1, 0), base + 1):
        remove(spark, f"{path}/batches/batch={old}")
    if base >= merge_every:
        remove(spark, f"{path}/merged/upto={base - merge_every}")


def keep_newest(
    stream: DataFrame, path: str, checkpoint: str, n: int = K.KEPT_AUDIT_ROWS, per: str | None = None,
    merge_every: int = MERGE_EVERY, every: str | None = None,
) -> StreamingQuery:
    """Keeps the newest `n` rows of a stream of audit rows, or of each value of `per`, in tables under `path`; see `newest_rows`.

    A batch reads its own rows alone, and a merge at most `n` rows of each scope and batch, so the work does not grow with the log. A hot scope is
    cut inside each task. Each merge removes the folders that the merge before it had taken in, so a reader has the time of `merge_every` batches.
    """
    if merge_every < 1:
        raise ValueError("merge_every must be at least 1")
    return run_feed(stream, lambda batch, number: fold_batch(batch, number, path, n, per, merge_every), checkpoint, every)


def newest_rows(spark: SparkSession, path: str, schema: StructType, n: int = K.KEPT_AUDIT_ROWS, per: str | None = None) -> DataFrame:
    """The newest `n` rows kept so far, of the log or of each value of `per`: `retain_audit` of all rows that came. Empty before the first batch.

    This reads one number first, that of the last merge.
    """
    rows = _rows(spark, path, schema, _merged_upto(spark, path))
    return spark.createDataFrame([], schema) if rows is None else retain_audit(rows, n, per)
