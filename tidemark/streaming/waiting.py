"""Files that wait for their chunks, as a join of two streams with bounded state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def resolve_refs(files: DataFrame, chunks: DataFrame, patience: str = "1 hour") -> DataFrame:
    """`(doc_id, asked, pos, n, chunk_id, found)`: the fate of each chunk that a stream of files lists.

    `files (doc_id, children, ts)` and `chunks (chunk_id, ts)` come in any order. A chunk is found if it comes at most `patience`
    before or after the file that lists it, and given up, with `found` false, when the watermark says that it no longer can. A file without
    children has one row without a chunk, found. Ids alone are kept as state, on both sides for as long as `patience`
    lasts; a chunk that comes again within that time is kept once.
    """
    span = F.expr(f"INTERVAL {patience}")
    refs = files.withWatermark("ts", patience).select(
        "doc_id", F.col("ts").alias("asked"), F.coalesce(F.size("children"), F.lit(0)).alias("n"), F.posexplode_outer("children").alias("pos", "wanted")
    )
    came = chunks.withWatermark("ts", patience).select("chunk_id", F.col("ts").alias("came")).dropDuplicatesWithinWatermark(["chunk_id"])
    near = (F.col("wanted") == F.col("chunk_id")) & (F.col("came") >= F.col("asked") - span) & (F.col("came") <= F.col("asked") + span)
    return refs.join(came, near, "left_outer").select(
        "doc_id", "asked", "pos", "n", F.col("wanted").alias("chunk_id"), (F.col("chunk_id").isNotNull() | F.col("wanted").isNull()).alias("found")
    )


def completeness(resolved: DataFrame) -> DataFrame:
    """`(doc_id, asked, n, found, lost)` of what `resolve_refs` has told so far; a file with neither all found nor any lost is still waiting.

    A chunk that came twice, longer apart than a stream keeps copies, tells its reference twice and counts once.
    """
    refs = resolved.groupBy("doc_id", "asked", "n", "pos").agg(F.max("found").alias("found"))
    chunk = F.col("pos").isNotNull()
    return refs.groupBy("doc_id", "asked", "n").agg(
        F.count_if(chunk & F.col("found")).alias("found"), F.count_if(chunk & ~F.col("found")).alias("lost")
    )
