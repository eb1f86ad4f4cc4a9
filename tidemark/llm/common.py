"""Helpers that the operators share: reading, writing intermediate tables, byte-level words, row hashes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import work_dir

Query = Callable[[SparkSession, str], DataFrame]

# Lower-cases A-Z alone. In UTF-8 no byte of another letter lies in that range.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def own_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores before it as it takes not to be a column of `df`."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def columns_of(df: DataFrame, *left_out: str) -> list[Column]:
    """The columns of `df` as they are named, but for those left out."""
    return [F.col(f"`{c}`") for c in df.columns if c not in left_out]


def settled(df: DataFrame, name: str) -> DataFrame:
    """`df` written to the shared folder and read again: later work survives lost executors and repeats nothing."""
    folder = work_dir(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def dropped(df: DataFrame) -> None:
    """Removes the files of a settled table that no later plan reads."""
    jvm = df.sparkSession._jvm
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def file_store(uri: str):
    """Arrow's file system for a folder or file and the path in it: local, HDFS or an object store, by the scheme."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file://") else uri)


def words_of(text: str | None) -> list[bytes]:
    """Words `[^\\x20\\x09-\\x0D]+` of a text in UTF-8, A-Z lower-cased; none for null."""
    return text.encode("utf-8", "surrogatepass").translate(LOWER).split() if text else []


def id_remainder(doc_id: Column | str, divisor: int) -> Column:
    """crc32 of the id as text, modulo `divisor`; null ids count as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id) if isinstance(doc_id, str) else doc_id, F.lit("")).cast("string").cast("binary")) % divisor


def text_hash(text: str = "text") -> Column:
    """A long that tells texts apart; null has one of its own."""
    return F.xxhash64(F.col(text).isNull(), F.col(text))
