"""Counts, sync outcomes, retry backlog and batch numbers. Counts reduce before they shuffle."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.functions import paths as P
from tidemark.functions.core import epoch_ms
from tidemark.operators.filters import effective_path
from tidemark.operators.scopes import Rules, scope_verdict
from tidemark.session import cut_lineage


def type_counts(df: DataFrame) -> DataFrame:
    """Documents per type; a missing or empty type counts as unknown."""
    kind = F.coalesce(F.nullif(F.col("type"), F.lit("")), F.lit("unknown"))
    return df.groupBy(kind.alias("type")).agg(F.count("*").alias("docs"))


def pull_outcomes(
    files: DataFrame,
    restored: DataFrame,
    rules: Rules = K.DEFAULT_SCOPES,
    agent: str = K.DEFAULT_AGENT,
    enforce: bool = True,
) -> DataFrame:
    """`(doc_id, path, outcome)` of a pull: written, bad_path, denied, deleted or no_content."""
    gone = F.coalesce(F.col("deleted"), F.lit(False)) if "deleted" in files.columns else F.lit(False)
    listed = files.select("doc_id", effective_path(files).alias("path"), gone.alias("_gone"))
    judged = scope_verdict(listed, rules, agent, enforce=enforce)
    done = restored.select("doc_id", F.lit(True).alias("_done"))
    bad = F.col("path").isNull() | (F.col("path") == "") | F.col("path").startswith("_") | ~P.stays_inside("path")
    outcome = (
        F.when(bad, "bad_path")
        .when(~F.col("allowed"), "denied")
        .when(F.col("_gone"), "deleted")
        .when(F.col("_done"), "written")
        .otherwise("no_content")
    )
    return judged.join(done, "doc_id", "left").select("doc_id", "path", outcome.alias("outcome"))


def pull_report(outcomes: DataFrame, chunks: DataFrame) -> DataFrame:
    """One row: chunks decoded and failed, files by outcome. A chunk whose `data` is null has failed."""
    files = outcomes.agg(
        *[
            F.count_if(F.col("outcome") == o).alias(f"files_{o}")
            for o in ("written", "bad_path", "denied", "deleted", "no_content")
        ]
    )
    totals = F.struct(F.count("data").alias("ok"), F.count_if(F.col("data").isNull()).alias("failed"))
    found = chunks.agg(totals).scalar()
    return files.withColumn("_c", found).select(
        F.col("_c.ok").alias("chunks_decoded"), F.col("_c.failed").alias("chunks_failed"), *files.columns
    )


def push_report(df: DataFrame, dry_run: bool = False) -> DataFrame:
    """One row from `(chunks, unchanged, error)` rows: pushed, unchanged, failed, total chunks.

    A dry run does not compare with the store, so every file that can be read counts as pushed.
    """
    failed = F.col("error").isNotNull()
    same = F.lit(False) if dry_run else F.coalesce(F.col("unchanged"), F.lit(False))
    return df.agg(
        F.count_if(~failed & ~same).alias("pushed"),
        F.count_if(~failed & same).alias("unchanged"),
        F.count_if(failed).alias("failed"),
        F.coalesce(F.sum(F.when(~failed, F.col("chunks"))), F.lit(0)).cast("long").alias("total_chunks"),
    )


def batch_outcome(
    batch: DataFrame, rules: Rules = K.DEFAULT_SCOPES, agent: str = K.DEFAULT_AGENT, enforce: bool = True
) -> DataFrame:
    """`(path, outcome, error)` of a batch whose `error` is null where the sync worked."""
    judged = scope_verdict(batch.select("path", "error"), rules, agent, enforce=enforce)
    outcome = F.when(~F.col("allowed"), "skipped").when(F.col("error").isNotNull(), "failed").otherwise("synced")
    return judged.select("path", outcome.alias("outcome"), F.when(F.col("allowed"), F.col("error")).alias("error"))


def batch_report(outcomes: DataFrame) -> DataFrame:
    """One row: synced, failed and skipped, and status error if anything failed."""
    counts = outcomes.agg(
        *[F.count_if(F.col("outcome") == o).alias(o) for o in ("synced", "failed", "skipped")]
    )
    return counts.withColumn("status", F.when(F.col("failed") > 0, "error").otherwise("success"))


@dataclass(frozen=True)
class RetryPolicy:
    max_retries: int = K.MAX_RETRIES
    initial_ms: float = K.RETRY_INITIAL_MS
    max_ms: float = K.RETRY_MAX_MS
    multiplier: float = K.RETRY_MULTIPLIER
    jitter: float = K.RETRY_JITTER


def retry_backlog(attempts: DataFrame, policy: RetryPolicy = RetryPolicy(), key: str = "key", ts: str = "ts") -> DataFrame:
    """`(key, attempts, last_ms, wait_ms, next_ms, exhausted)` from rows of failed attempts.

    The delay doubles with every attempt up to the maximum, jitter is added before the cap, and a
    key is given up after `max_retries + 1` attempts. The jitter of a key is drawn from a hash of key
    and attempt, so a task that runs again gives the same value.
    """
    seen = attempts.groupBy(key).agg(F.count("*").alias("attempts"), F.max(epoch_ms(ts)).alias("last_ms"))
    growth = F.pow(F.lit(float(policy.multiplier)), F.col("attempts") - 1)
    delay = F.least(F.lit(float(policy.initial_ms)) * growth, F.lit(float(policy.max_ms)))
    draw = F.pmod(F.xxhash64(F.col(key), "attempts"), F.lit(1_000_000)) / F.lit(1_000_000.0)
    wait = F.least(delay * (1 + F.lit(float(policy.jitter)) * draw), F.lit(float(policy.max_ms)))
    spent = F.col("attempts") > policy.max_retries
    return seen.select(
        key,
        "attempts",
        "last_ms",
        F.when(~spent, wait).alias("wait_ms"),
        F.when(~spent, F.col("last_ms") + F.round(wait).cast("long")).alias("next_ms"),
        spent.alias("exhausted"),
    )


def assign_batches(df: DataFrame, size: int, order: Sequence[str]) -> DataFrame:
    """Adds `row_no` (from 1, in the given order) and `batch` (from 0) over the whole table.

    `order` must identify a row. Rows are range-partitioned and sorted, the position inside each
    partition is taken, and partition sizes give the offsets, so no task sees more than its own range.
    The sorted rows are checkpointed first: sizes and rows must come from one and the same
    partitioning, also after an executor is lost.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = cut_lineage(
        ranged.withColumn("_part", F.spark_partition_id()).withColumn(
            "_at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
        )
    )
    # One row per partition, so this running sum is as short as the partition list.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    numbered = placed.join(offsets, "_part").withColumn("row_no", F.col("_offset") + F.col("_at") + 1)
    return numbered.withColumn("batch", F.floor((F.col("row_no") - 1) / size)).select(*df.columns, "row_no", "batch")
