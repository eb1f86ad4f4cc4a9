"""Near-duplicate groups by SimHash, with candidates pruned by the pigeonring principle."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import Query, own_names, settled, table, text_hash, words_of
from tidemark.llm.components import components

SHINGLE, SEED, REACH = 3, 42, 2
# The ring: 64 bits in three segments. With at most two differing bits a segment's share is 2/3, so some chain
# has a first segment without difference (0 <= 2/3) and at most one in its first two (1 <= 4/3).
WIDTHS = (22, 21, 21)
_STARTS = (0, 22, 43)


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


_MASKS = tuple(((1 << w) - 1) << s for w, s in zip(WIDTHS, _STARTS))


def fingerprint_of(text: str | None) -> int:
    """The fingerprint of one text as an unsigned number; zero without words."""
    words = words_of(text)
    if not words:
        return 0
    if len(words) < SHINGLE:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(words, words[1:], words[2:]))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, SEED) for s in shingles], dtype=np.uint64)
    counts = np.zeros(64, dtype=np.int64)
    for part in range(0, len(hashes), 65_536):
        octets = hashes[part : part + 65_536].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.uint64)[0])


@F.pandas_udf(T.LongType())
def fingerprint(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """SimHash of a text column as a long that holds the 64 bits; null and empty texts give 0."""
    for texts in batches:
        yield pd.Series(np.fromiter((fingerprint_of(t) for t in texts), np.uint64, len(texts)).view(np.int64))


def _segment(bits: Column, at: int) -> Column:
    """The bits of one segment, in their place."""
    return bits.bitwiseAND(F.lit(_signed(_MASKS[at])))


def _viable(difference: Column, at: int) -> Column:
    """The chain that starts at a segment keeps its budgets: none in the first, at most one in the first two."""
    two = _signed(_MASKS[at] | _MASKS[(at + 1) % 3])
    return (_segment(difference, at) == 0) & (F.bit_count(difference.bitwiseAND(F.lit(two))) <= 1)


def links(prints: DataFrame, fp: str = "fp") -> DataFrame:
    """`(u, v)`, u < v as longs: each pair of different fingerprints at two or fewer differing bits, once.

    A fingerprint stands under the key of each chain (first two segments of the chain, whole) and asks
    under that key and under the keys with one set bit of the chain's second segment cleared: of two
    fingerprints that differ there in one bit, one has it set. So candidates meet in an equality join
    on 42 or 43 bits, 39 rows for a fingerprint, and the join itself tests the whole distance. A fingerprint has at
    most 2,080 others within reach, so no group's pairs grow with its square.
    """
    own = prints.select(F.col(fp).alias("v"))
    keys, asks = [], []
    for at, width in enumerate(WIDTHS):
        after = (at + 1) % 3
        chain = F.col("v").bitwiseAND(F.lit(_signed(_MASKS[at] | _MASKS[after])))
        keys.append(F.struct(F.lit(at).alias("at"), chain.alias("chain")))
        single = F.array(*[F.lit(_signed(1 << (_STARTS[after] + b))) for b in range(WIDTHS[after])])
        cleared = F.transform(
            F.filter(single, lambda bit: F.col("v").bitwiseAND(bit) != 0),
            lambda bit: F.struct(F.lit(at).alias("at"), chain.bitwiseXOR(bit).alias("chain")),
        )
        asks += [F.array(keys[-1]), cleared]
    held = own.select("v", F.inline(F.array(*keys)))
    asked = own.select(F.col("v").alias("u"), F.inline(F.concat(*asks)))
    difference = F.col("u").bitwiseXOR(F.col("v"))
    first = F.when(_viable(difference, 0), 0).when(_viable(difference, 1), 1).otherwise(2)
    equal = F.when(F.col("at") == 0, _segment(difference, 1) == 0).when(
        F.col("at") == 1, _segment(difference, 2) == 0
    ).otherwise(_segment(difference, 0) == 0)
    # Equal chains would show a pair from both sides.
    once = (~equal) | (F.col("u") < F.col("v"))
    near = (F.col("u") != F.col("v")) & (F.bit_count(difference) <= REACH) & (first == F.col("at")) & once
    found = asked.join(held, ["at", "chain"]).filter(near)
    return found.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))


def groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`(doc_id, text_hash, fingerprint, root, component_id)` for each row of `docs`.

    `fingerprint` is a long, `root` the component's least fingerprint, `component_id` the smallest doc_id reachable by links, the row's own
    included; null if no row of the component has an id. Null, empty and blank texts have fingerprint 0
    and are linked like others. Equal texts share a fingerprint, so only different fingerprints are compared.
    Repeated rows stay. Other columns of `docs` are not read. An empty table gives no rows.
    """
    rows = settled(docs.select(F.col(doc_id).alias("doc_id"), text_hash(text).alias("text_hash"), fingerprint(text).alias("fingerprint")), "simhash")
    prints = rows.groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
    found = components(links(prints, "fingerprint"), "simhash-links")
    rooted = prints.join(found, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", "least", F.coalesce("root", "fingerprint").alias("root")
    )
    rooted = settled(rooted, "simhash-roots")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    placed = rooted.join(least, "root").select("fingerprint", "root", "component_id")
    return rows.join(placed, "fingerprint").select("doc_id", "text_hash", "fingerprint", "root", "component_id")


def dedupe(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs`, all columns, with one row left of each group: that of the smallest doc_id.

    Several rows with that id are told apart by their texts; of equal pairs of id and text the row whose JSON is least stays.
    """
    grouped = groups(docs, doc_id, text)
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("k")
    left = settled(grouped.groupBy("root").agg(least).select("k.doc_id", "k.text_hash"), "simhash-kept")
    id_, hash_ = own_names(docs, "_kept_id", "_kept_hash")
    kept = docs.join(
        left.select(F.col("doc_id").alias(id_), F.col("text_hash").alias(hash_)),
        F.col(doc_id).eqNullSafe(F.col(id_)) & (text_hash(text) == F.col(hash_)),
        "left_semi",
    )
    repeats = grouped.groupBy("doc_id", "text_hash").count().filter("count > 1").limit(1).count()
    return _first_of_repeats(kept, doc_id, text) if repeats else kept


def _first_of_repeats(kept: DataFrame, doc_id: str, text: str) -> DataFrame:
    """One row for each pair of id and text."""
    columns = kept.columns
    whole = F.struct(*[F.col(f"`{c}`") for c in columns])
    one = kept.groupBy(F.col(doc_id).alias("_id"), text_hash(text).alias("_hash")).agg(F.min_by(whole, F.to_json(whole)).alias("_row"))
    return one.select(*[F.col("_row").getField(c).alias(c) for c in columns])


def op5_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash components of all documents."""
    found = groups(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id"
    )


QUERIES: dict[str, Query] = {"op5_simhash_groups": op5_simhash_groups}
SQL: dict[str, str] = {}
