"""From raw documents to training shards: toxic ones go, copies go, contaminated ones go, sources are mixed, rows are sharded."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, mixing, shards, simhash, toxicity
from tidemark.llm.common import dropped, settled, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under one half, by a scorer learned from the labelled documents."""
    scorer = toxicity.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, scorer)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: that of the smallest doc_id."""
    return simhash.dedupe(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by a benchmark item, as they are."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its Poisson count says, in shuffled order; sources weigh as the root of their rows."""
    return mixing.mixed(docs)


def place_in_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows with their shard and slot."""
    return shards.shard(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", place_in_shards),
]

# The scores of the first stage come from a fitted model, which SQL cannot state.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of all stages on the documents of `sf_dir`; each stage is written before the next reads it, and removed when the next is written."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = settled(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if before is not None:
            dropped(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
