"""Access by folder prefix.

Rules come as a mapping (`agent -> prefixes`, the usual configuration) or as a table
`(agent, prefix)`. A mapping of up to `MAX_LITERAL_PREFIXES` prefixes becomes a plain predicate that
is evaluated in the scan. A longer mapping or a table takes the join form: the distinct first
segments of the data (few next to its rows, reduced before the shuffle) are matched to the rules by
an equality join on their own prefixes, and the data is then joined to the allowed segments, where
adaptive execution splits the tasks of a hot folder.

Prefixes and paths are both compared in lower case. A table row with a null prefix declares an agent
that may see nothing.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark import schemas
from tidemark.functions.paths import doc_key, first_segment
from tidemark.session import cut_lineage

MAX_LITERAL_PREFIXES = 256

Rules = Mapping[str, Sequence[str]] | DataFrame


def scopes_table(spark: SparkSession, rules: Mapping[str, Sequence[str]]) -> DataFrame:
    """The mapping as a table."""
    rows = []
    for agent, prefixes in rules.items():
        rows += [(agent, str(p)) for p in prefixes] or [(agent, None)]
    return spark.createDataFrame(rows, schemas.SCOPES)


def effective_scopes(defaults: DataFrame, custom: DataFrame) -> DataFrame:
    """Default rules, with every agent named in `custom` taking its rules from there alone."""
    return defaults.join(custom, "agent", "left_anti").unionByName(custom)


def _literal_rule(rules: Rules, agent: str) -> list[str] | None:
    """The agent's prefixes if they are few enough to stand in the plan, else None."""
    if isinstance(rules, DataFrame):
        return None
    prefixes = [str(p).lower() for p in rules.get(agent, ())]
    return prefixes if len(prefixes) <= MAX_LITERAL_PREFIXES else None


def _starts_with_any(segment: Column, prefixes: Sequence[str]) -> Column:
    """False for a null segment, as in the join form."""
    test = F.lit(False)
    for prefix in prefixes:
        test = test | segment.startswith(prefix)
    return F.coalesce(test, F.lit(False))


def _allowed_segments(df: DataFrame, rules: DataFrame, agent: str, path_col: str) -> DataFrame:
    """Distinct first segments of `df` that begin with one of the agent's prefixes."""
    own = rules.filter((F.col("agent") == agent) & F.col("prefix").isNotNull()).select(
        F.lower("prefix").alias("_prefix")
    )
    segments = df.select(first_segment(doc_key(path_col)).alias("_segment")).distinct()
    prefixes = segments.select(
        "_segment",
        F.explode(
            F.transform(
                F.sequence(F.lit(0), F.length("_segment")),
                lambda n: F.substring(F.col("_segment"), F.lit(1), n),
            )
        ).alias("_prefix"),
    )
    return prefixes.join(own, "_prefix", "left_semi").select("_segment").distinct()


def _as_table(df: DataFrame, rules: Rules) -> DataFrame:
    return rules if isinstance(rules, DataFrame) else scopes_table(df.sparkSession, rules)


def scope_filter(
    df: DataFrame,
    rules: Rules = K.DEFAULT_SCOPES,
    agent: str = K.DEFAULT_AGENT,
    path_col: str = "path",
    enforce: bool = True,
) -> DataFrame:
    """Rows whose first path segment begins with a prefix of the agent."""
    if not enforce:
        return df
    segment = first_segment(doc_key(path_col))
    prefixes = _literal_rule(rules, agent)
    if prefixes is not None:
        return df.filter(_starts_with_any(segment, prefixes))
    allowed = _allowed_segments(df, _as_table(df, rules), agent, path_col)
    return df.withColumn("_segment", segment).join(allowed, "_segment", "left_semi").select(*df.columns)


def scope_verdict(
    df: DataFrame,
    rules: Rules = K.DEFAULT_SCOPES,
    agent: str = K.DEFAULT_AGENT,
    path_col: str = "path",
    enforce: bool = True,
) -> DataFrame:
    """Every row with `allowed`, `scope` (the first segment, where allowed) and `reason`."""
    if not enforce:
        return df.select(
            "*",
            F.lit(True).alias("allowed"),
            F.lit(K.ROOT_SCOPE).alias("scope"),
            F.lit(None).cast("string").alias("reason"),
        )
    segment = first_segment(doc_key(path_col))
    prefixes = _literal_rule(rules, agent)
    if prefixes is not None:
        known = F.lit(agent in rules)
        marked = df.withColumn("_segment", segment).withColumn(
            "_allowed", _starts_with_any(F.col("_segment"), prefixes)
        )
    else:
        table = _as_table(df, rules)
        known = table.filter(F.col("agent") == agent).agg(F.count("*") > 0).scalar()
        allowed = _allowed_segments(df, table, agent, path_col).withColumn("_hit", F.lit(True))
        marked = (
            df.withColumn("_segment", segment)
            .join(allowed, "_segment", "left")
            .withColumn("_allowed", F.coalesce("_hit", F.lit(False)))
            .drop("_hit")
        )
    return marked.select(
        *df.columns,
        F.col("_allowed").alias("allowed"),
        F.when(F.col("_allowed"), F.col("_segment")).alias("scope"),
        F.when(F.col("_allowed"), F.lit(None).cast("string"))
        .when(~known, F.lit("unknown agent"))
        .otherwise(F.lit("path not allowed"))
        .alias("reason"),
    )


def _placed(segments: DataFrame, prefixes: DataFrame) -> DataFrame:
    """`(_segment, _near)`: each segment beside the greatest prefix that is not greater, if there is one.

    Both are sorted together by ranges, so that segments with a long common head are spread as well, and every range is
    filled from its own prefixes; the last prefix of the ranges before is one row for each range. The sorted rows are
    checkpointed, since the number of a range must not change under what is built on it.
    """
    both = prefixes.select(F.col("_prefix").alias("_key"), F.lit(0).alias("_kind")).unionByName(
        segments.select(F.col("_segment").alias("_key"), F.lit(1).alias("_kind"))
    )
    ranged = cut_lineage(both.repartitionByRange("_key", "_kind").withColumn("_part", F.spark_partition_id()))
    own = F.when(F.col("_kind") == 0, F.col("_key"))
    last = ranged.groupBy("_part").agg(F.max(own).alias("_last"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select("_part", F.max("_last").over(before).alias("_carried"))
    upto = Window.partitionBy("_part").orderBy("_key", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    filled = ranged.withColumn("_own", F.last(own, ignorenulls=True).over(upto)).filter(F.col("_kind") == 1)
    return filled.join(carried, "_part", "left").select(F.col("_key").alias("_segment"), F.coalesce("_own", "_carried").alias("_near"))


def _chains(prefixes: DataFrame) -> DataFrame:
    """`(_near, _chain)`: each prefix and those of the prefixes that it begins with, itself included."""
    heads = F.transform(F.sequence(F.lit(0), F.length("_prefix")), lambda n: F.substring(F.col("_prefix"), F.lit(1), n))
    cut = prefixes.select(F.col("_prefix").alias("_near"), F.explode(heads).alias("_prefix"))
    return cut.join(prefixes, "_prefix").groupBy("_near").agg(F.collect_list("_prefix").alias("_chain"))


def scope_matrix(df: DataFrame, rules: Rules = K.DEFAULT_SCOPES, path_col: str = "path") -> DataFrame:
    """Every row once for each agent that may see it, with `agent` and `scope`, the first segment: all agents' `scope_filter` at once.

    The prefixes of all agents are sorted with the distinct first segments, so that a segment finds the greatest prefix not above
    it. Whatever prefixes it begins with, that one begins with them too: strings with a common head are
    neighbours. So a segment takes part in one row of that search and tests the few heads of its neighbour, and no segment is unfolded into
    its own heads. A row that no agent may see, and a null path, is in no row of the result. Columns `agent` and `scope` of `df` are replaced.

    This acts: the distinct segments and prefixes are checkpointed, and the agents of each segment are written before the rows meet them.
    """
    own = df.drop("agent", "scope")
    table = _as_table(df, rules).filter(F.col("prefix").isNotNull()).select("agent", F.lower("prefix").alias("_prefix")).distinct()
    prefixes = table.select("_prefix").distinct()
    segment = first_segment(doc_key(path_col))
    segments = own.select(segment.alias("_segment")).filter(F.col("_segment").isNotNull()).distinct()
    near = _placed(segments, prefixes).filter(F.col("_near").isNotNull()).join(_chains(prefixes), "_near")
    heads = near.select("_segment", F.explode(F.filter("_chain", lambda p: F.startswith(F.col("_segment"), p))).alias("_prefix"))
    seen = cut_lineage(heads.join(table, "_prefix").select("_segment", "agent").distinct())
    return own.withColumn("_segment", segment).join(seen, "_segment").select(*own.columns, "agent", F.col("_segment").alias("scope"))
