"""Sinks for rebuilt files, chunks and sync state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from tidemark import constants as K
from tidemark import schemas
from tidemark.operators.chunks import BUCKET_DIGITS, bucketed
from tidemark.sources.scan import with_scope_folder

# Row groups of the chunk store: small enough that a wanted chunk brings few others along.
ROW_GROUP_BYTES, ROW_GROUP_IDS = 16 << 20, 20_000
_META = T.StructType([T.StructField("last_sync", T.TimestampType()), T.StructField("version", T.LongType())])


def absent(error: AnalysisException) -> None:
    """Returns if a path was never written; any other error, such as a damaged store, is raised again."""
    if error.getCondition() != "PATH_NOT_FOUND":
        raise error


def write_files(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists", by_scope: bool = True) -> None:
    """Writes `(path, content)` rows, in one folder per scope unless `by_scope` is off.

    Rows are rebalanced by scope first: small scopes share a task and a scope with a third of all
    files is split over many, so each folder gets few files of a sensible size.
    """
    out = with_scope_folder(df).hint("rebalance", "scope") if by_scope else df
    writer = out.write.format(fmt).mode(mode)
    (writer.partitionBy("scope") if by_scope else writer).save(path)


def write_chunks(df: DataFrame, path: str, mode: str = "overwrite", digits: int = BUCKET_DIGITS) -> None:
    """Writes chunks in folders by the end of their id, sorted by id, with a bloom filter of ids in each row group.

    Ids are hashes, so the folders fill evenly; `digits` hexadecimal digits give `16 ** digits` of them. A reader prunes
    folders by name, row groups and pages by the range of their ids and by the filter, and reads the bytes of what is left.
    """
    out = bucketed(df.select("chunk_id", "data"), digits).hint("rebalance", "bucket").sortWithinPartitions("bucket", "chunk_id")
    writer = out.write.mode(mode).partitionBy("bucket").option("compression", K.STORE_CODEC).option("parquet.block.size", ROW_GROUP_BYTES)
    writer.option("parquet.bloom.filter.enabled#chunk_id", "true").option(
        "parquet.bloom.filter.expected.ndv#chunk_id", ROW_GROUP_IDS
    ).parquet(path)


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """The stored chunks `(chunk_id, data, bucket)`, empty where nothing was stored yet."""
    try:
        # The folder names are digits of ids and must not be read as numbers.
        return spark.read.schema("chunk_id string, data binary, bucket string").parquet(path)
    except AnalysisException as error:
        absent(error)
        return spark.createDataFrame([], "chunk_id string, data binary, bucket string")


def save_state(df: DataFrame, path: str, version: int, last_sync_ms: int) -> None:
    """Writes the snapshot `(path, hash, mtime)` as a new version.

    The state goes to a folder of its own and the one-row meta table follows, so readers never see a
    half-written version, and writing the same version again is harmless.
    """
    df.select("path", "hash", "mtime").write.mode("overwrite").parquet(f"{path}/state/version={version}")
    meta = df.sparkSession.range(1).select(F.timestamp_millis(F.lit(last_sync_ms)).alias("last_sync"))
    meta.coalesce(1).write.mode("overwrite").parquet(f"{path}/meta/version={version}")


def state_meta(spark: SparkSession, path: str) -> DataFrame:
    """`(last_sync, version)` of every complete version; empty if there is none."""
    try:
        return spark.read.schema(_META).parquet(f"{path}/meta")
    except AnalysisException as error:
        absent(error)
        return spark.createDataFrame([], _META)


def load_state(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete snapshot, or an empty one where nothing was saved yet."""
    newest = state_meta(spark, path).agg(F.max("version")).first()[0]
    if newest is None:
        return spark.createDataFrame([], schemas.SYNC_STATE)
    return spark.read.schema(schemas.SYNC_STATE).parquet(f"{path}/state/version={newest}")


def synced_paths(state: DataFrame) -> DataFrame:
    """Paths the state knows."""
    return state.select("path")
