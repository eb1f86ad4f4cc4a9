"""Path and tombstone filters, and reading of single documents. All are narrow: no shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.functions import paths as P
from tidemark.functions.core import as_bytes, iso_millis
from tidemark.operators.scopes import Rules, scope_filter


def with_is_binary(df: DataFrame, path_col: str = "path") -> DataFrame:
    """Adds `is_binary`, from the document type (when there is one) or the file extension."""
    doc_type = "type" if "type" in df.columns else None
    return df.withColumn("is_binary", P.is_binary(path_col, doc_type))


def effective_path(df: DataFrame) -> Column:
    """`path`, or the key where there is no path."""
    if "doc_id" not in df.columns:
        return F.col("path")
    return F.when(F.col("path").isNull() | (F.col("path") == ""), F.col("doc_id")).otherwise(F.col("path"))


def with_effective_path(df: DataFrame) -> DataFrame:
    """`path` filled from the key where it is missing, so that later filters judge one and the same path."""
    return df.withColumn("path", effective_path(df))


def valid_paths(df: DataFrame) -> DataFrame:
    """Drops rows whose path is empty, begins with `_`, is absolute or climbs out of the root."""
    path = effective_path(df)
    return df.filter(path.isNotNull() & (path != "") & ~path.startswith("_") & P.stays_inside(path))


def ignore_filter(
    df: DataFrame,
    names: Sequence[str] = K.IGNORED_NAMES,
    suffixes: Sequence[str] = K.IGNORED_SUFFIXES,
    hidden: bool = True,
    path_col: str = "path",
) -> DataFrame:
    """Drops paths with an ignored or (with `hidden`) dotted segment, and ignored file suffixes."""
    keep = ~P.any_segment(path_col, names)
    for suffix in suffixes:
        keep = keep & ~F.col(path_col).endswith(suffix)
    if hidden:
        keep = keep & ~P.has_hidden_segment(path_col)
    return df.filter(keep)


def prefix_filter(df: DataFrame, prefix: str, path_col: str = "path") -> DataFrame:
    """Paths that begin with `prefix`, case-sensitive; reaches the parquet scan."""
    return df.filter(F.col(path_col).startswith(prefix))


def watched_filter(
    df: DataFrame, watched: Sequence[str] = K.WATCHED_FOLDERS, path_col: str = "path"
) -> DataFrame:
    """Paths whose first segment is exactly one of the watched folders."""
    return df.filter(P.first_segment(path_col).isin(*watched))


def _is_deleted(df: DataFrame) -> Column:
    return F.coalesce(F.col("deleted"), F.lit(False)) if "deleted" in df.columns else F.lit(False)


def live_docs(df: DataFrame) -> DataFrame:
    """Rows that are not tombstones."""
    return df.filter(~_is_deleted(df))


def tombstones(df: DataFrame) -> DataFrame:
    """Valid paths of deleted documents: what a pull has to remove."""
    gone = valid_paths(df.filter(_is_deleted(df)))
    return gone.select(effective_path(gone).alias("path"))


def read_files(
    df: DataFrame, rules: Rules = K.DEFAULT_SCOPES, agent: str = K.DEFAULT_AGENT, enforce: bool = True
) -> DataFrame:
    """Readable form of the documents an agent may see: binary files give their size alone."""
    own = with_is_binary(scope_filter(df, rules, agent, enforce=enforce), "path")
    text = ~F.col("is_binary")
    return own.select(
        "path",
        F.col("is_binary").alias("binary"),
        F.when(text, F.col("content")).alias("content"),
        F.octet_length(as_bytes("content")).cast("long").alias("size_bytes"),
        F.when(text, iso_millis("mtime")).alias("modified_at"),
    )


def read_file(
    df: DataFrame,
    path: str,
    rules: Rules = K.DEFAULT_SCOPES,
    agent: str = K.DEFAULT_AGENT,
    enforce: bool = True,
) -> DataFrame:
    """One document; the equality on `path` reaches the scan."""
    return read_files(df.filter(F.col("path") == path), rules, agent, enforce)
