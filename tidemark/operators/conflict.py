"""Conflict detection and resolution between two or more replicas.

`paired` frames come from `pair_replicas`. Each side is judged by its own modification time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.functions.paths import archive_key


def has_conflict(paired: DataFrame) -> DataFrame:
    """Adds `conflict`: both sides exist and their hashes differ."""
    differs = F.coalesce("local_hash", F.lit("")) != F.coalesce("remote_hash", F.lit(""))
    return paired.withColumn("conflict", F.col("remote_exists") & differs)


def resolve(paired: DataFrame, strategy: str | Column = "last-write-wins") -> DataFrame:
    """Adds `conflict`, `winner` (local, remote or both) and `action`.

    `strategy` is one name or a column of names; an unknown name falls to local.
    """
    df = paired if "conflict" in paired.columns else has_conflict(paired)
    rule = F.lit(strategy) if isinstance(strategy, str) else strategy
    by_time, remote_rule, local_rule, both_rule = (rule == name for name in K.STRATEGIES)
    clash, mine, theirs = F.col("conflict"), F.col("local_mtime"), F.col("remote_mtime")
    # What each case of a conflict leads to; a remote time that is missing counts as the oldest.
    outcome = (
        F.when(~clash, _outcome("local", K.NO_CONFLICT))
        .when(by_time & (theirs.isNull() | (mine > theirs)), _outcome("local", K.LOCAL_NEWER))
        .when(by_time & (theirs > mine), _outcome("remote", K.REMOTE_NEWER))
        .when(by_time, _outcome("local", K.SAME_TIME))
        .when(remote_rule, _outcome("remote", K.REMOTE_RULE))
        .when(local_rule, _outcome("local", K.LOCAL_RULE))
        .when(both_rule, _outcome("both", K.BOTH_RULE))
        .otherwise(_outcome("local", K.UNKNOWN_RULE))
    )
    return df.withColumn("_outcome", outcome).select("*", "_outcome.*").drop("_outcome")


def _outcome(winner: str, action: str) -> Column:
    return F.struct(F.lit(winner).alias("winner"), F.lit(action).alias("action"))


def latest_write(df: DataFrame, key: str, ts: str, prefer: Column | None = None, *ties: str) -> DataFrame:
    """The newest row of each key among any number of replicas.

    `prefer` marks rows that win an equal time; `ties` are further columns, ascending. The rank filter
    keeps one row per key inside each map task before the shuffle, so a hot key ships few rows.
    """
    order = [F.col(ts).desc()]
    if prefer is not None:
        order.append(F.coalesce(prefer, F.lit(False)).desc())
    order += [F.col(c).asc() for c in ties]
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def newest_docs(df: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row for each key: the newest by `mtime`, then the first by path and hash, as far as there are such columns.

    For rows without content: whole rows move. With content, choose among `(key, mtime, path)` and join.
    """
    order = [F.col("mtime").desc_nulls_last()] if "mtime" in df.columns else []
    order += [F.col(c).asc() for c in ("path", "hash") if c in df.columns]
    best = F.row_number().over(Window.partitionBy(key).orderBy(*(order or [F.lit(0)])))
    return df.withColumn("_rank", best).filter(F.col("_rank") == 1).drop("_rank")


def _side_columns(df: DataFrame, side: str) -> list[str]:
    return [c[len(side) + 1:] for c in df.columns if c.startswith(f"{side}_") and c != "remote_exists"]


def apply_resolution(resolved: DataFrame, key: str = "doc_id") -> DataFrame:
    """The surviving row of each pair, with `winner`: the remote row where remote won, else the local."""
    remote_names = set(_side_columns(resolved, "remote"))
    took_remote = F.col("winner") == "remote"
    return resolved.select(
        key,
        *[
            (
                F.when(took_remote, F.col(f"remote_{c}")).otherwise(F.col(f"local_{c}"))
                if c in remote_names
                else F.when(~took_remote, F.col(f"local_{c}"))
            ).alias(c)
            for c in _side_columns(resolved, "local")
        ],
        "winner",
    )


def archive_rows(resolved: DataFrame, key: str = "doc_id") -> DataFrame:
    """A `<key>.v<n>` row, marked archived, for every remote version that is about to be overwritten."""
    lost = resolved.filter(F.col("conflict") & (F.col("winner") != "remote"))
    version = F.coalesce("remote_version", F.lit(0)) if "remote_version" in resolved.columns else F.lit(0)
    kept = [c for c in ("path", "children", "mtime", "hash") if f"remote_{c}" in resolved.columns]
    return lost.select(
        archive_key(key, version).alias(key),
        *[F.col(f"remote_{c}").alias(c) for c in kept],
        version.cast("int").alias("version"),
        F.lit("plain").alias("type"),
        F.lit(True).alias("archived"),
    )
