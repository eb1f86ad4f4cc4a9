"""Comparing huge listings by trees of digests, so that what is read follows what changed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.diff import detect_changes
from tidemark.session import cut_lineage

DEPTH = 2  # folders of a path that are levels of the tree
PARTS = 16  # leaves that each folder is split into by a hash of the path, so that no folder is one hot leaf
MAX_LISTED_LEAVES = 1_000  # differing leaves that are written into the scans' filters
ROW_GROUP_BYTES = 8 << 20


def _segments(path: Column, depth: int) -> Column:
    """The first folders of a path, at most `depth`."""
    parts = F.split(path, "/")
    return F.slice(parts, 1, F.least(F.size(parts) - 1, F.lit(depth)))


def with_leaf(listing: DataFrame, depth: int = DEPTH, parts: int = PARTS) -> DataFrame:
    """Adds `leaf`: the first folders of the path and a number by its hash, the unit in which listings are compared and read."""
    part = F.pmod(F.xxhash64("path"), F.lit(parts)).cast("string")
    return listing.withColumn("leaf", F.concat_ws("/", _segments(F.col("path"), depth), F.concat(F.lit("#"), part)))


def digest_tree(listing: DataFrame, depth: int = DEPTH, parts: int = PARTS) -> DataFrame:
    """`(level, node, parent, files, unhashed, digest, mix)` for the root (level 0), each folder and each leaf of a listing `(path, hash, mtime)`.

    `digest` and `mix` are two sums of independent hashes over the files below a node, so they do not depend on order and those of a
    folder add up from its leaves. The listing is grouped once, inside each task first; folders are summed from the leaves.
    """
    leaf = listing if "leaf" in listing.columns else with_leaf(listing, depth, parts)
    row = [F.col("path"), F.col("hash"), F.unix_micros("mtime")]
    # Nulls must count by their place, as the hash passes over them.
    told = [F.coalesce(c.cast("string"), F.lit("\0")) for c in row]
    wide = lambda c: F.sum(c.cast("decimal(38,0)")).cast("decimal(38,0)")
    leaves = leaf.groupBy("leaf").agg(
        F.count("*").alias("files"), F.count_if(F.coalesce("hash", F.lit("")) == "").alias("unhashed"),
        wide(F.xxhash64(*told)).alias("digest"), wide(F.xxhash64(F.lit("mix"), *told)).alias("mix"),
    )
    steps = F.split("leaf", "/")
    # A leaf below few folders stands on the same level as all others.
    up_to = lambda k: F.when(k <= depth, F.array_join(F.slice(steps, 1, F.least(k, F.size(steps) - 1)), "/")).otherwise(F.col("leaf"))
    nodes = leaves.select("*", F.explode(F.sequence(F.lit(0), F.lit(depth + 1))).alias("level")).withColumns({
        "node": up_to(F.col("level")), "parent": up_to(F.greatest(F.col("level") - 1, F.lit(0)))})
    return nodes.groupBy("level", "node", "parent").agg(
        F.sum("files").alias("files"), F.sum("unhashed").alias("unhashed"), wide(F.col("digest")).alias("digest"), wide(F.col("mix")).alias("mix"))


def changed_leaves(prev: DataFrame, curr: DataFrame, depth: int = DEPTH) -> DataFrame:
    """`leaf` of every leaf in which two trees differ, compared from the root: only children of differing nodes are met.

    A file without a previous hash counts as added even if nothing else differs, so leaves with one always count as differing.
    """
    differing: DataFrame | None = None
    for level in range(depth + 2):
        sides = []
        for tree, name in ((prev, "_p"), (curr, "_c")):
            nodes = tree.filter(F.col("level") == level)
            if differing is not None:
                nodes = nodes.join(differing, F.col("parent") == F.col("_at"), "left_semi")
            sides.append(nodes.select("node", F.struct("files", "digest", "mix").alias(name), F.col("unhashed").alias(f"{name}u")))
        open_ = F.coalesce("_pu", F.lit(0)) > 0
        differing = sides[0].join(sides[1], "node", "full_outer").filter(open_ | ~F.col("_p").eqNullSafe(F.col("_c"))).select(F.col("node").alias("_at"))
    return differing.withColumnRenamed("_at", "leaf")


def detect_changes_tree(prev: DataFrame, curr: DataFrame, prev_tree: DataFrame | None = None, curr_tree: DataFrame | None = None,
                        depth: int = DEPTH, unchanged: bool = False) -> DataFrame:
    """`detect_changes` of two listings with a `leaf` column, by reading only the leaves that differ.

    Trees that were stored with the listings (see `write_listing`) spare reading the rest; missing ones are computed. The
    differing leaves are found first (this acts): a few become filters of the scans, which sorted leaves answer by row group; more
    are joined. `unchanged` adds the rows of equal leaves, which reads the current listing whole.
    """
    # Both sides must be cut into leaves alike, so a side without them gets those of this depth.
    prev, curr = [side if "leaf" in side.columns else with_leaf(side, depth) for side in (prev, curr)]
    # A tree is read once for each level, so one that is not stored is kept.
    prev_tree, curr_tree = [stored or cut_lineage(digest_tree(side, depth)) for stored, side in ((prev_tree, prev), (curr_tree, curr))]
    leaves = changed_leaves(prev_tree, curr_tree, depth)
    few = [r[0] for r in leaves.limit(MAX_LISTED_LEAVES + 1).collect()]
    if len(few) <= MAX_LISTED_LEAVES:
        found = detect_changes(*[side.filter(F.col("leaf").isin(few)) for side in (prev, curr)])
        rest = curr.filter(~F.col("leaf").isin(few)) if few else curr
    else:
        leaves = cut_lineage(leaves)
        found = detect_changes(*[side.join(leaves, "leaf", "left_semi") for side in (prev, curr)])
        rest = curr.join(leaves, "leaf", "left_anti")
    if not unchanged:
        return found.filter(F.col("status") != "unchanged")
    return found.unionByName(rest.select("path", F.lit("unchanged").alias("status"), "hash", "mtime"))


def write_listing(listing: DataFrame, path: str, depth: int = DEPTH, parts: int = PARTS) -> None:
    """Writes a listing `(path, hash, mtime)` sorted by leaf, in small row groups, and its tree beside it."""
    rows = with_leaf(listing.select("path", "hash", "mtime"), depth, parts)
    sorted_rows = rows.repartitionByRange("leaf", "path").sortWithinPartitions("leaf", "path")
    sorted_rows.write.mode("overwrite").option("parquet.block.size", ROW_GROUP_BYTES).parquet(f"{path}/files")
    stored, _ = read_listing(listing.sparkSession, path, tree=False)
    digest_tree(stored, depth, parts).write.mode("overwrite").parquet(f"{path}/tree")


def read_listing(spark: SparkSession, path: str, tree: bool = True) -> tuple[DataFrame, DataFrame | None]:
    """A written listing `(path, hash, mtime, leaf)` and its tree."""
    files = spark.read.schema("path string, hash string, mtime timestamp, leaf string").parquet(f"{path}/files")
    return files, spark.read.parquet(f"{path}/tree") if tree else None
