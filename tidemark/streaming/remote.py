"""Applying a live feed of remote documents.

Each micro-batch adds its new chunks to the stored chunk table and rebuilds its files against that
table. A file whose chunks have not all come yet is given out with what is there and is tried again
when one of its chunks comes, so chunks and files may arrive in any order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType
from pyspark.errors import AnalysisException

from tidemark import constants as K
from tidemark.functions.core import as_bytes
from tidemark.operators.chunks import BUCKET_DIGITS, fetch, listed_ids, new_chunks, reassemble
from tidemark.operators.conflict import newest_docs
from tidemark.operators.filters import live_docs, valid_paths, with_effective_path
from tidemark.operators.scopes import Rules, scope_filter
from tidemark.session import remove, shuffles_removed
from tidemark.sources.scan import chunk_docs, classify_docs
from tidemark.sources.sinks import absent, read_chunks, write_chunks
from tidemark.streaming.feeds import run_feed


def apply_remote(
    docs: DataFrame,
    store: DataFrame,
    rules: Rules = K.DEFAULT_SCOPES,
    agent: str = K.DEFAULT_AGENT,
    enforce: bool = True,
) -> DataFrame:
    """Batch form: the files of one feed rebuilt from its own chunks and the stored ones.

    The newest row of a file decides, a deletion included: deleted documents, bad paths and paths out of scope are passed over. Inline data stands in where
    no chunk was found.
    """
    own = chunk_docs(classify_docs(live_docs(docs))).withColumn("data", as_bytes("data"))
    newest, gone = _last_states(docs)
    files = _newest(newest.filter(~gone).drop("kind"), rules, agent, enforce)
    held = (fetch(store, listed_ids(files)) if "bucket" in store.columns else store).select("chunk_id", "data")
    return _restore(files, held.unionByName(new_chunks(own, held)))


def _last_states(docs: DataFrame) -> tuple[DataFrame, Column]:
    """The newest row of each file, a deletion included, and whether it is one.

    A tombstone need not say what it was; only chunks are never removed this way.
    """
    gone = F.coalesce(F.col("deleted"), F.lit(False)) if "deleted" in docs.columns else F.lit(False)
    stated = classify_docs(docs).filter((F.col("kind") == "file") | (gone & (F.col("kind") != "chunk")))
    return newest_docs(with_effective_path(stated)), gone


def _newest(files: DataFrame, rules: Rules, agent: str, enforce: bool) -> DataFrame:
    """The last state of each file an agent may see."""
    visible = scope_filter(valid_paths(with_effective_path(files)), rules, agent, enforce=enforce)
    return newest_docs(visible)


def _restore(files: DataFrame, chunks: DataFrame, digits: int = BUCKET_DIGITS, hold: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    return reassemble(files, chunks, empty_ok=False, inline="unresolved", digits=digits, hold=hold)


def _earlier(spark: SparkSession, folder: str, batch_id: int, schema: StructType) -> DataFrame:
    """What an earlier batch wrote; no rows before the first."""
    try:
        return spark.read.schema(schema).parquet(f"{folder}/batch={batch_id}")
    except AnalysisException as error:
        absent(error)
        return spark.createDataFrame([], schema)


def _stored(df: DataFrame, path: str) -> DataFrame:
    """The frame read again from where it was written."""
    df.write.mode("overwrite").option("compression", K.STORE_CODEC).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def follow_remote(
    stream: DataFrame,
    folder: str,
    rules: Rules = K.DEFAULT_SCOPES,
    agent: str = K.DEFAULT_AGENT,
    enforce: bool = True,
    every: str | None = None,
    digits: int = BUCKET_DIGITS,
    patience: int = 1_000,
) -> StreamingQuery:
    """Applies a document stream to `folder`: `chunks` (by bucket), `files`, `removed` and, of the last two, `waiting` (by batch).

    The newest row of a document decides, a deleted one included: a deletion ends the wait of its file and is
    recorded in `removed`. A batch rebuilds its own files and those waiting files that one of its chunks
    belongs to; a file whose chunks do not come within `patience` batches is waited for no longer, and stays as
    it was last given out. Every write of a batch either adds only chunks that are not stored yet or overwrites the
    batch's own folder, so a batch that runs again changes nothing.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession  # the feed's own, so other queries keep their settings
        with shuffles_removed(spark):
            apply(spark, batch, batch_id)

    def apply(spark: SparkSession, batch: DataFrame, batch_id: int) -> None:
        # The batch is read again where it is needed, by columns: kept, its chunks would go to disk as soon as they overfill the memory.
        own = chunk_docs(classify_docs(live_docs(batch))).withColumn("data", as_bytes("data"))
        chunk_path, wait_path, work_path = f"{folder}/chunks", f"{folder}/waiting", f"{folder}/work"
        stored = read_chunks(spark, chunk_path)
        known_ids = fetch(stored.select("bucket", "chunk_id"), own, digits)
        write_chunks(new_chunks(own, known_ids, digits), chunk_path, "append", digits)

        newest, gone = _last_states(batch)
        _stored(newest.filter(gone).select("doc_id", "path"), f"{folder}/removed/batch={batch_id}")
        arrived = _newest(newest.filter(~gone).drop("kind"), rules, agent, enforce).withColumn("_since", F.lit(batch_id).cast("long"))

        earlier = _earlier(spark, wait_path, batch_id - 1, arrived.schema).join(newest.select("doc_id"), "doc_id", "left_anti")
        refs = earlier.select("doc_id", F.explode("children").alias("chunk_id"))
        touched = refs.join(own.select("chunk_id"), "chunk_id", "left_semi").select("doc_id", F.lit(True).alias("_now")).distinct()
        open_files = arrived.withColumn("_now", F.lit(True)).unionByName(earlier.join(touched, "doc_id", "left").fillna(False, ["_now"]))
        still = _stored(open_files, f"{work_path}/open")
        files = still.filter("_now").drop("_now")
        wanted = fetch(read_chunks(spark, chunk_path), listed_ids(files), digits)
        restored = _restore(files, wanted, digits, hold=lambda found: _stored(found, f"{work_path}/pieces"))
        given = _stored(restored, f"{folder}/files/batch={batch_id}")

        done = given.filter(F.col("missing_chunks") == 0)
        waiting = still.drop("_now").join(done.select("doc_id"), "doc_id", "left_anti").filter(
            (F.size("children") > 0) & (F.col("_since") > batch_id - patience)
        )
        _stored(waiting, f"{wait_path}/batch={batch_id}")
        for passed in (work_path, f"{wait_path}/batch={batch_id - 2}"):  # the batch before is done, so what it read is not needed again
            remove(spark, passed)

    return run_feed(stream, handle, f"{folder}/checkpoint", every)


def applied_files(spark: SparkSession, folder: str, *columns: Column) -> DataFrame:
    """The state of each file after all batches: what was last given out for its key, unless it was removed since.

    Keys and batches are ranked alone; content is read for the rows that stand. `columns` (all by default) are computed
    where rows are read, so that a hash moves in place of its content.
    """
    out = spark.read.option("basePath", f"{folder}/files").parquet(f"{folder}/files")
    removed = spark.read.option("basePath", f"{folder}/removed").parquet(f"{folder}/removed")
    last = out.select("doc_id", "batch").groupBy("doc_id").agg(F.max("batch").alias("batch"))
    ends = removed.groupBy("doc_id").agg(F.max("batch").alias("_removed"))
    standing = last.join(ends, "doc_id", "left").filter(F.col("_removed").isNull() | (F.col("_removed") < F.col("batch")))
    given = out.select(F.col("doc_id").alias("_id"), F.col("batch").alias("_batch"), *(columns or out.columns))
    last_given = standing.select(F.col("doc_id").alias("_id"), F.col("batch").alias("_batch"))
    return given.join(last_given, ["_id", "_batch"], "left_semi").drop("_id", "_batch")
