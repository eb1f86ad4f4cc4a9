"""Sharding by sampled splitters: quantile ranges of a size-weighted key sample, overfull ranges subdivided."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import Query, columns_of, own_names, settled, table, text_hash

SHARDS, OVERHEAD = 40, 16
# Ranges per shard at least; at large scale as many as keep a range at about RANGE_BYTES, up to MAX_RANGES.
RANGES, RANGE_BYTES, MAX_RANGES = 64, 512 << 20, 250_000
# Expected keys drawn for each range. Their number does not grow with the rows, only with the ranges.
DRAWS = 8
_OUT = T.StructType([T.StructField(n, T.LongType()) for n in ("piece", "shard", "base")])
COLUMNS = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")


def _keyed(docs: DataFrame, doc_id: str, text: str, group: str, tie: str, *number: str) -> DataFrame:
    """The rows with their size, checksum and place in key order: copies of a text are neighbours."""
    return docs.withColumns({
        "size": (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long"),
        "text_crc32": F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")),
        group: text_hash(text),
        tie: F.xxhash64(F.col(doc_id).isNull(), F.col(doc_id), F.lit("tie"), *number),
    })


@dataclass
class Splitters:
    """Ranges of the key and, for each range, its pieces. All arrays are as long as the ranges or pieces are many."""

    bounds: np.ndarray  # first key of each range but the first
    parts: np.ndarray  # pieces of each range
    first: np.ndarray  # number of the first piece of each range
    shard: np.ndarray | None = None  # of each piece
    base: np.ndarray | None = None  # rows of the shard before each piece
    crowded: bool = False  # a piece of several rows is far over its size after the cut

    def ranges(self, group: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.bounds, group, side="right")

    def pieces(self, group: np.ndarray, tie: np.ndarray) -> np.ndarray:
        """Equal slices of the range's keys; a range of one key is sliced by the tie hash."""
        at = self.ranges(group)
        low = np.concatenate(([-(2.0**63)], self.bounds.astype(float)))[at]
        high = np.concatenate((self.bounds.astype(float), [2.0**63]))[at]
        single = np.concatenate(([False], np.diff(self.bounds) == 1, [False]))[at]
        share = np.where(single, (tie.astype(float) + 2.0**63) / 2.0**64, (group - low) / np.maximum(high - low, 1.0))
        parts = self.parts[at]
        return self.first[at] + np.clip((share * parts).astype(np.int64), 0, parts - 1)


def boundaries(drawn: np.ndarray, ranges: int) -> np.ndarray:
    """Quantiles of the sorted sample. A key drawn for two quantiles or more is hot and gets a range of its own."""
    if not len(drawn):
        return np.zeros(0, np.int64)
    picks = drawn[np.linspace(0, len(drawn) - 1, num=ranges + 1).astype(np.int64)[1:-1]]
    keys, times = np.unique(picks, return_counts=True)
    hot = keys[(times > 1) & (keys < np.iinfo(np.int64).max)]
    return np.unique(np.concatenate((keys, hot + 1)))


def _totals(slim: DataFrame, number, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and rows by range or piece; one row for each comes to the driver."""
    sizes, rows = np.zeros(count, np.int64), np.zeros(count, np.int64)
    for at, size, n in slim.groupBy(number.alias("at")).agg(F.sum("size"), F.count("*")).collect():
        sizes[at], rows[at] = size, n
    return sizes, rows


def splitters(slim: DataFrame, shards: int) -> Splitters:
    """Splitters for rows `(_group, _tie, size)`: sample, quantiles, exact range sizes, subdivision, shards by running size."""
    total = slim.agg(F.sum("size")).first()[0] or 0
    ranges = min(max(shards * RANGES, math.ceil(total / RANGE_BYTES)), MAX_RANGES)
    chance = F.col("size") * F.lit(DRAWS * ranges / max(total, 1))
    drawn = slim.filter(F.shiftrightunsigned(F.xxhash64("_group", "_tie"), 11) / F.lit(float(1 << 53)) < chance).select("_group")
    bounds = boundaries(np.sort(np.array([r[0] for r in drawn.collect()], dtype=np.int64)), ranges)
    found = Splitters(bounds, np.ones(len(bounds) + 1, np.int64), np.arange(len(bounds) + 1))

    @F.pandas_udf(T.LongType())
    def range_of(group: pd.Series) -> pd.Series:
        return pd.Series(found.ranges(group.to_numpy()))

    sizes, rows = _totals(slim, range_of("_group"), len(bounds) + 1)
    target = max(total / ranges, 1.0)
    overfull = (sizes > 2 * target) & (rows > 1)
    found.parts = np.where(overfull, np.minimum(np.ceil(sizes / target), rows), 1).astype(np.int64)
    found.first = np.cumsum(found.parts) - found.parts

    @F.pandas_udf(T.LongType())
    def piece_of(group: pd.Series, tie: pd.Series) -> pd.Series:
        return pd.Series(found.pieces(group.to_numpy(), tie.to_numpy()))

    sizes, rows = _totals(slim, piece_of("_group", "_tie"), int(found.parts.sum()))
    found.crowded = bool(np.any((sizes > 2 * target) & (rows > 1)))
    middle = np.cumsum(sizes) - sizes / 2
    found.shard = np.minimum((middle * shards / max(total, 1)).astype(np.int64), shards - 1)
    before = np.cumsum(rows) - rows
    found.base = before - before[np.searchsorted(found.shard, found.shard)]
    return found


def _repeated(slim: DataFrame) -> bool:
    """Whether several rows have the same key and tie, which no cut of the keys can part."""
    return bool(slim.groupBy("_group", "_tie").count().filter("count > 1").head(1))


def shard(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shards: int = SHARDS) -> DataFrame:
    """`docs` with `(size, text_crc32, law, shard, slot, grown_shard)`; columns of those names are replaced.

    `size` is the text's UTF-8 bytes plus 16, `text_crc32` the unsigned checksum of those bytes (0 without any), `law` is
    `bytes`: shards have near equal sizes. `slot` counts the rows of a shard from 0 without gaps; `grown_shard` is null.
    Rows are ordered by a hash of the text and, within equal texts, by one of doc_id, so copies of a text are
    neighbours and share a shard unless a shard ends among them. A null text is a text of its own; null ids
    are placed like others, and so are repeated rows. An empty table gives no rows.

    A slim table of keys and sizes is written once. From it come a sample whose expected length is eight keys
    for a range, and the exact size of each range and piece. The rows then move once, by piece, and are numbered
    inside it. A text that holds much of the data fills a range of its own, which is cut by the hash of doc_id. Only where equal
    rows of one id and text overfill a piece are the rows written once with a number each, which then enters that hash.
    """
    given = docs.select(columns_of(docs, *COLUMNS))
    group, tie, at, piece, number = own_names(given, "_group", "_tie", "_at", "_piece", "_number")

    def slim_of(rows: DataFrame) -> DataFrame:
        return settled(rows.select(F.col(group).alias("_group"), F.col(tie).alias("_tie"), "size"), "shard-keys")

    keyed = _keyed(given, doc_id, text, group, tie)
    slim = slim_of(keyed)
    found = splitters(slim, shards)
    if found.crowded and _repeated(slim):
        numbered = settled(given.withColumn(number, F.monotonically_increasing_id()), "shard-rows")
        keyed = _keyed(numbered, doc_id, text, group, tie, number)
        found = splitters(slim_of(keyed), shards)

    @F.pandas_udf(_OUT)
    def placed(groups: pd.Series, ties: pd.Series) -> pd.DataFrame:
        pieces = found.pieces(groups.to_numpy(), ties.to_numpy())
        return pd.DataFrame({"piece": pieces, "shard": found.shard[pieces], "base": found.base[pieces]})

    put = keyed.withColumn(at, placed(group, tie)).withColumn(piece, F.col(f"{at}.piece"))
    within = F.row_number().over(W.partitionBy(piece).orderBy(group, tie, doc_id))
    return put.select(
        *columns_of(given), "size", "text_crc32", F.lit("bytes").alias("law"), F.col(f"{at}.shard").cast("int").alias("shard"),
        (F.col(f"{at}.base") + within - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(sharded: DataFrame, folder: str) -> None:
    """One folder `shard=N` for each shard, rows sorted by slot in files of whole ranges of slots."""
    sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(folder)


def op1_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of near equal bytes."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return shard(docs).select("doc_id", *COLUMNS)


QUERIES: dict[str, Query] = {"op1_sampled_splitters": op1_sampled_splitters}
SQL: dict[str, str] = {}
