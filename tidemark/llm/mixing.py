"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import Query, columns_of, own_names, settled, table

SEED = 17
# Sources weigh as the square root of their rows, and the mix has about as many rows as its input.
TEMPERATURE = 0.5
_UNIT = float(1 << 52)
# A count beyond this many standard deviations over the mean has a chance under 2 ** -52.
_TAIL, _LEAST = 10.0, 20.0
_FEW = 6
MAX_SOURCES = 10_000  # sources whose table may be broadcast


def _number(text: Column) -> Column:
    """A number from 0 to 2 ** 52 - 1, spread evenly by a hash of the text."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long")


def _uniform(text: Column) -> Column:
    return _number(text) / F.lit(_UNIT)


def poisson_steps(rate: Column) -> Column:
    """Cumulative chances of 0, 1, 2, ... for a Poisson count, as far as a hash of 52 bits can reach."""
    last = F.ceil(rate + F.lit(_TAIL) * F.sqrt(rate) + F.lit(_LEAST)).cast("int")
    start = F.struct((-rate).alias("log_chance"), F.exp(-rate).alias("total"), F.array(F.exp(-rate)).alias("steps"))

    def walk(a: Column, k: Column) -> Column:
        # In logarithms, so that a rate of thousands does not vanish at count 0. A rate of 0 has no logarithm.
        log_chance = a.log_chance + F.ln(rate) - F.ln(k)
        total = a.total + F.coalesce(F.exp(log_chance), F.lit(0.0))
        return F.struct(log_chance.alias("log_chance"), total.alias("total"), F.concat(a.steps, F.array(total)).alias("steps"))

    walked = F.aggregate(F.sequence(F.lit(1), last), start, walk)
    return walked.getField("steps")


def _count(steps: Column, at: Column) -> Column:
    """Steps that do not exceed `at`. Nearly all counts are small, and the first steps are compared in generated code."""
    few = sum(((F.get(steps, F.lit(k)) <= at).cast("long") for k in range(_FEW)), F.lit(0).cast("long"))
    return F.when(F.get(steps, F.lit(_FEW - 1)) > at, few).otherwise(F.size(F.filter(steps, lambda s: s <= at)).cast("long"))


def rates(docs: DataFrame, source: str = "source", weights: DataFrame | None = None, total: int | None = None,
          temperature: float = TEMPERATURE) -> DataFrame:
    """`(mix_source, n_docs, weight, rate)` for each source: the mean number of times that a document of it is wanted.

    `weights (mix_source, weight)` need not sum to one; a source without a weight gets none of the mix. Without
    `weights`, a source weighs as its rows to the power `temperature`. `total` is the wanted number of rows,
    that of the input by default. The null source is the source ``''``.
    """
    name = F.coalesce(F.col(source), F.lit("")).alias("mix_source")
    counts = docs.groupBy(name).agg(F.count("*").alias("n_docs"))
    if weights is None:
        weighed = counts.withColumn("weight", F.pow(F.col("n_docs").cast("double"), F.lit(temperature)))
    else:
        weighed = counts.join(weights.select("mix_source", F.col("weight").cast("double")), "mix_source", "left").withColumn("weight", F.coalesce("weight", F.lit(0.0)))
    sums = weighed.agg(F.sum("weight").alias("weights"), F.sum("n_docs").alias("rows"))
    rows = F.lit(total) if total is not None else F.col("rows")
    share = F.col("weight") * rows / (F.col("weights") * F.col("n_docs"))
    # One row beside a few: written as two scalars of the same small table.
    out = weighed.withColumn("weights", sums.select("weights").scalar()).withColumn("rows", sums.select("rows").scalar())
    return out.select("mix_source", "n_docs", "weight", F.coalesce(share, F.lit(0.0)).alias("rate"))


def mix(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", wanted: DataFrame | None = None, seed: int = SEED) -> DataFrame:
    """Each document as often as its hash-seeded Poisson count says, in globally shuffled order.

    Adds `n_copies` (the document's count), `copy` (1 to that) and `mix_key` (the hash that rows are sorted by);
    columns of those names are replaced. The count inverts the Poisson distribution of the source's `rate` (of
    `wanted`, see `rates`) at a uniform number that a hash of seed and doc_id gives, so it is the same on any cluster and
    in any repeated run. Documents with count 0 are left out: that is the method. Rows that repeat a doc_id, or lack
    one, share one number; the text plays no part. An empty table gives no rows.

    The sources' table has one row per source. It is written first; with at most `MAX_SOURCES` rows it is broadcast,
    beyond that joined by source, where adaptive execution splits a source that holds much of the rows. The final sort
    deals rows out by ranges of a hash, so no source and no copied document stays together.
    """
    wanted = rates(docs, source) if wanted is None else wanted
    steps = settled(wanted.select("mix_source", poisson_steps(F.col("rate")).alias("mix_steps")), "mix-steps")
    if steps.count() <= MAX_SOURCES:
        steps = F.broadcast(steps)
    given = docs.select(columns_of(docs, "n_copies", "copy", "mix_key"))
    by, list_, at = own_names(given, "mix_source", "mix_steps", "mix_at")
    seeded = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("null")))
    named = given.withColumn(by, F.coalesce(F.col(source), F.lit("")))
    counted = named.join(steps.withColumnsRenamed({"mix_source": by, "mix_steps": list_}), by).withColumn(at, _uniform(seeded)).withColumn(
        "n_copies", _count(F.col(list_), F.col(at))
    )
    copies = counted.filter("n_copies > 0").select(
        *columns_of(given), "n_copies", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n_copies"))).alias("copy")
    )
    key = _number(F.concat(seeded, F.lit(":"), F.col("copy").cast("string"))).alias("mix_key")
    return copies.select("*", key).orderBy("mix_key", doc_id, "copy")


def mixed(docs: DataFrame, doc_id: str = "doc_id", source: str = "source") -> DataFrame:
    """The mix with the columns of `docs` alone, whatever they are called."""
    given = [c for c in ("n_copies", "copy", "mix_key") if c in docs.columns]
    held = docs.withColumnsRenamed(dict(zip(given, own_names(docs, *given))))
    back = dict(zip(own_names(docs, *given), given))
    return mix(held, doc_id, source).drop("n_copies", "copy", "mix_key").withColumnsRenamed(back).select(columns_of(docs))


def op2_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents, sources weighing as the square root of their rows."""
    return mix(table(spark, sf_dir, "documents").select("doc_id", "source"))


QUERIES: dict[str, Query] = {"op2_poisson_mix": op2_poisson_mix}

#: SQL for the mix of a table or view with doc_id and source; `{columns}` names further columns to carry along.
MIX_VIEWS = f"""
counts AS (SELECT coalesce(source, '') AS mix_source, count(*) AS n_docs FROM {{documents}} GROUP BY 1),
weighed AS (SELECT *, pow(n_docs::DOUBLE, {TEMPERATURE}) AS weight FROM counts),
rated AS (SELECT mix_source, weight * (SELECT sum(n_docs) FROM weighed)::DOUBLE / ((SELECT sum(weight) FROM weighed) * n_docs) AS rate FROM weighed),
steps AS (
  SELECT mix_source, k, CASE WHEN k = 0 THEN exp(-rate) WHEN rate > 0 THEN exp(k * ln(rate) - rate - lgamma(k + 1)) ELSE 0 END AS chance
  FROM rated, unnest(generate_series(0, ceil(rate + {_TAIL} * sqrt(rate) + {_LEAST})::INTEGER)) AS s(k)
),
totals AS MATERIALIZED (SELECT mix_source, k, sum(chance) OVER (PARTITION BY mix_source ORDER BY k) AS total FROM steps),
seeded AS (
  SELECT *, coalesce(source, '') AS mix_source, '{SEED}:' || coalesce(doc_id::VARCHAR, 'null') AS seeded FROM {{documents}}
),
drawn AS (SELECT *, ('0x' || substr(md5(seeded), 1, 13))::BIGINT / {_UNIT!r} AS mix_at FROM seeded),
counted AS (
  SELECT d.*, (SELECT count(*) FROM totals t WHERE t.mix_source = d.mix_source AND t.total <= d.mix_at) AS n_copies FROM drawn d
),
mixed AS (
  SELECT *, ('0x' || substr(md5(seeded || ':' || copy::VARCHAR), 1, 13))::BIGINT AS mix_key
  FROM (SELECT *, unnest(generate_series(1, n_copies)) AS copy FROM counted)
)"""
SQL: dict[str, str] = {
    "op2_poisson_mix": f"WITH {MIX_VIEWS.format(documents='documents')} SELECT doc_id, source, n_copies, copy, mix_key FROM mixed"
}
