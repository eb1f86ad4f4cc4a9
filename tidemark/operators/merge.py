"""Three-way merge of text, front-matter Markdown and JSON, chosen by file name.

Input frames carry `base`, `local` and `remote` beside any other columns; outputs add `merged` and
`has_conflicts`. A null base counts as empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import merging as M
from tidemark.operators.merge_json import json_merge_column


def _with_result(df: DataFrame, result: Column) -> DataFrame:
    out = df.withColumn("_m", result)
    return out.withColumn("merged", F.col("_m.merged")).withColumn("has_conflicts", F.col("_m.conflict")).drop("_m")


def merge_text(df: DataFrame) -> DataFrame:
    """Positional line merge; conflicting lines become marked blocks."""
    return _with_result(df, M.three_way(F.col("base"), F.col("local"), F.col("remote")))


def extract_frontmatter(df: DataFrame, text: str = "content") -> DataFrame:
    """Adds `front_matter`, an array of `struct(key, value)`, and `body`."""
    cut = df.withColumn("_parts", M.parts_of(F.col(text)))
    added = {"front_matter": M.entries_of(F.col("_parts.front")), "body": F.col("_parts.body")}
    return cut.withColumns(added).drop("_parts")


def frontmatter_rows(df: DataFrame, text: str = "content", key: str = "path") -> DataFrame:
    """Front matter as rows `(path, key, value)`, the last of repeated keys winning."""
    none = F.array().cast("array<struct<key:string,value:string>>")
    entries = M.entries_of(M.parts_of(F.col(text))["front"])
    rows = df.select(F.col(key), F.inline(M.merge_entries(none, entries, none)).alias("_key", "value"))
    return rows.withColumnRenamed("_key", "key")


def merge_frontmatter(df: DataFrame, key: str = "path") -> DataFrame:
    """Merged front matter of three sides as rows `(path, pos, key, value)`; no shuffle."""
    fronts = [M.parts_of(F.coalesce(F.col(c), F.lit("")))["front"] for c in ("base", "local", "remote")]
    merged = M.merge_entries(*[M.entries_of(f) for f in fronts])
    return df.select(F.col(key), F.posexplode(merged).alias("pos", "_e")).select(
        key, "pos", F.col("_e.key").alias("key"), F.col("_e.value").alias("value")
    )


def merge_markdown(df: DataFrame) -> DataFrame:
    """Front matter merged by key and the body by line, rendered as one document."""
    return _with_result(df, M.three_way_markdown(F.col("base"), F.col("local"), F.col("remote")))


def merge_conflicts(df: DataFrame, prefer_remote: bool = False, json_base: bool = False) -> DataFrame:
    """Merge by file name: `.md` as Markdown, `.json` as JSON, everything else (and JSON that does not
    parse) as text. Endings are case-sensitive.

    One pass over the input: only `.json` rows hand text to the Arrow function, all others pass nulls.
    JSON is merged without a base unless `json_base` is set, so any scalar difference is a conflict.
    """
    is_json = F.col("path").endswith(".json")
    base, local, remote = F.col("base"), F.col("local"), F.col("remote")
    masked = [F.when(is_json, c) for c in (local, remote)]
    masked.append(F.when(is_json & F.lit(json_base), base))
    staged = df.withColumn("_json", json_merge_column(*masked, prefer_remote=prefer_remote))
    as_json = F.struct(
        F.col("_json.merged").alias("merged"), (F.size("_json.conflicts") > 0).alias("conflict")
    )
    result = (
        F.when(F.col("path").endswith(".md"), M.three_way_markdown(base, local, remote))
        .when(F.col("_json.merged").isNotNull(), as_json)
        .otherwise(M.three_way(base, local, remote))
    )
    return _with_result(staged, result).drop("_json")
