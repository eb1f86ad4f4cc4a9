"""Connected components of a large edge list, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import dropped, settled


def _with_least(pairs: DataFrame) -> DataFrame:
    """`(u, v, least)`: each neighbour pair with the least of `u` and all its neighbours."""
    least = pairs.groupBy("u").agg(F.min("v").alias("least")).select("u", F.least("u", "least").alias("least"))
    return pairs.join(least, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_least(both).filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("least").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    joined = _with_least(down)
    children = joined.select(F.col("v").alias("u"), F.col("least").alias("v"))
    own = joined.select("u", F.col("least").alias("v"))
    return children.unionByName(own).filter(F.col("u") > F.col("v"))


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """`(node, root)` for every node of `edges (u long, v long)` that is not itself the least of its component.

    Each round is two grouped minima and two joins on a node; the table is written after each round, so
    lineage stays short. It ends when a round changes nothing: a star for each component. Rounds grow
    with the logarithm of the longest path. Loops, repeated and reversed edges are allowed; no edges give
    no rows.
    """
    now = settled(edges.filter(F.col("u") != F.col("v")).select("u", "v").distinct(), name)
    mark = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == mark or not state[0]:
            break
        mark = tuple(state)
        after = settled(_small_star(_large_star(now).distinct()).distinct(), name)
        dropped(now)
        now = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
