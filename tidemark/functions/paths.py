"""Path expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import constants as K


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def forward_slashes(path: Column | str) -> Column:
    return F.replace(_column(path), F.lit("\\"), F.lit("/"))


def doc_key(path: Column | str) -> Column:
    """Document key of a path: lower case, forward slashes."""
    return F.lower(forward_slashes(path))


def first_segment(path: Column | str) -> Column:
    return F.split_part(_column(path), F.lit("/"), F.lit(1))


def file_name(path: Column | str) -> Column:
    return F.substring_index(_column(path), "/", -1)


def archive_key(doc_id: Column | str, version: Column | str) -> Column:
    """Key of the archived row of one version."""
    return F.concat(_column(doc_id), F.lit(".v"), _column(version).cast("string"))


def has_extension(path: Column | str, extensions: Sequence[str]) -> Column:
    return _column(path).rlike(r"(?i)\.(" + "|".join(extensions) + r")\z")


def is_binary(path: Column | str, doc_type: Column | str | None = None) -> Column:
    by_name = has_extension(path, K.BINARY_EXTENSIONS)
    if doc_type is None:
        return by_name
    return F.coalesce(_column(doc_type) == K.BINARY_TYPE, F.lit(False)) | by_name


def stays_inside(path: Column | str) -> Column:
    """False for absolute paths and for paths that climb above their root at any point."""
    plain = forward_slashes(path)
    segments = F.split(plain, "/")
    depth = F.aggregate(
        segments,
        F.lit(0),
        lambda d, s: F.when(d < 0, d)
        .when(s.isin("", "."), d)
        .when(s == "..", d - 1)
        .otherwise(d + 1),
    )
    return ~plain.startswith("/") & ~plain.rlike("^[A-Za-z]:") & (depth >= 0)


def any_segment(path: Column | str, names: Sequence[str]) -> Column:
    return F.arrays_overlap(F.split(_column(path), "/"), F.array(*[F.lit(n) for n in names]))


def in_folder(path: Column | str, names: Sequence[str]) -> Column:
    """True if a folder on the path, not the file itself, has one of the names."""
    segments = F.split(_column(path), "/")
    folders = F.slice(segments, F.lit(1), F.size(segments) - 1)
    return F.arrays_overlap(folders, F.array(*[F.lit(n) for n in names]))


def has_hidden_segment(path: Column | str) -> Column:
    return _column(path).rlike(r"(^|/)\.")
