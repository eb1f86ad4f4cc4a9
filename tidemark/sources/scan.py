"""Scans of folders and document dumps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark import constants as K
from tidemark.functions import paths as P


def scan_files(
    spark: SparkSession, root: str, watched: Sequence[str] | None = None, content: bool = False
) -> DataFrame:
    """`(path, hash, mtime, size)` of every file below `root`, or below its `watched` folders.

    Paths are relative to the root. Folders with a dotted name are passed over. Spark itself also
    leaves out files whose name begins with `.` or `_`.
    """
    base = root.rstrip("/")
    targets = [f"{base}/{folder}" for folder in watched] if watched else [base]
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(targets)
    plain = base.split(":", 1)[1] if ":" in base.split("/", 1)[0] else base
    tail = "/" + plain.lstrip("/") + "/"
    relative = F.substr(F.col("path"), F.locate(tail, F.col("path")) + len(tail))
    out = raw.select(
        relative.alias("path"),
        F.sha2("content", 256).alias("hash"),
        F.col("modificationTime").alias("mtime"),
        F.col("length").alias("size"),
        *(["content"] if content else []),
    )
    return out.filter(~F.col("path").rlike(r"(^|/)\.[^/]*/"))


def read_docs(spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | None = None) -> DataFrame:
    """A mixed dump of documents; the partitioned scan takes the place of paging."""
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def classify_docs(df: DataFrame, fallback: bool = False) -> DataFrame:
    """Adds `kind`: chunk, file or ignored.

    A leaf with data is a chunk; a document of a file type or with children is a file. With
    `fallback`, if the whole dump holds neither, every document whose key does not begin with `_` is
    a file; that test looks for one such row and stops there.
    """
    leaf = (F.col("type") == K.CHUNK_TYPE) & (F.octet_length(F.col("data")) > 0)
    file = F.col("type").isin(*K.FILE_TYPES) | (F.size("children") > 0)
    kind = F.when(leaf, "chunk").when(file, "file").otherwise("ignored")
    out = df.withColumn("kind", kind)
    if not fallback:
        return out
    nothing = out.filter("kind <> 'ignored'").limit(1).agg(F.count("*") == 0).scalar()
    return out.withColumn("kind", F.when(nothing & ~F.col("doc_id").startswith("_"), "file").otherwise(F.col("kind")))


def chunk_docs(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col("kind") == "chunk").select(F.col("doc_id").alias("chunk_id"), "data")


def file_docs(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col("kind") == "file").drop("kind")


def preview_docs(df: DataFrame, n: int = K.PREVIEW_IDS, key: str = "doc_id") -> DataFrame:
    """The first `n` documents by key, as a distributed top-k."""
    return df.orderBy(key).limit(n)


def with_scope_folder(df: DataFrame, path_col: str = "path") -> DataFrame:
    """Adds `scope`, the folder that `write_files` partitions by."""
    return df.withColumn("scope", P.first_segment(P.doc_key(path_col)))
