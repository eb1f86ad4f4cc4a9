"""Line search for a whole table of queries, by posting lists of n-grams.

A store holds two tables: the texts, in folders by a hash of their path, and the lists, sorted by gram. A query reads the
lists of its rarest grams, intersects them, and then reads the texts they leave; these alone are tested. So what is
read follows what is found, and not the number of queries times the number of texts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import constants as K
from tidemark.operators import chunks as C
from tidemark.operators.scopes import Rules
from tidemark.operators.search import searchable
from tidemark.session import cut_lineage
from tidemark.sources.sinks import ROW_GROUP_BYTES, ROW_GROUP_IDS

N = 3  # characters of a gram
PIECE = 1 << 20  # characters of texts that a task cuts into grams at once, some 60 MB of arrays; a longer text is cut in pieces
RAREST = 3  # grams of a query whose lists are intersected
LIST_DOCS = 1 << 17  # texts of one block of lists at most, on average: a list is at most about a megabyte
MAX_LISTED_GRAMS = 1_000  # grams that are written into the scan's filter
ASKED_AT_ONCE = 1_000  # queries that are held beside one text, on average
FOUND_AT_ONCE = 1 << 24  # characters of hits that a task gives on at once
_TEXTS = "chunk_id string, path string, content string, bucket string"
_MATCHES = T.ArrayType(T.StructType([T.StructField("line", T.IntegerType()), T.StructField("text", T.StringType())]))


_LISTS = pa.schema([("gram", pa.string()), ("block", pa.int32()), ("docs", pa.list_(pa.int64()))])


@F.pandas_udf(T.ArrayType(T.StringType()))
def _grams(needles: pd.Series) -> pd.Series:
    """The distinct grams of needles without a line break, none of those shorter than a gram."""
    return needles.map(lambda text: list(dict.fromkeys(text[i : i + N] for i in range(len(text) - N + 1))))


def _lists(held: list[tuple[int, str]], blocks: int) -> pa.RecordBatch:
    """The lists of a few texts `(doc, text)`: for each gram and block the distinct docs that have it.

    A gram goes from each character of a line on, `N` characters or what the line has left. Grams become numbers by the rank of
    their characters, 0 beyond the line; sorting pairs of gram and doc, as one number, brings the lists together.
    """
    docs = np.array([doc for doc, _ in held], np.int64)
    order = np.lexsort((docs, docs % blocks))
    docs = docs[order]
    first = np.append(True, docs[1:] != docs[:-1])
    doc_of = docs[first]
    lengths = np.array([len(held[i][1]) + 1 for i in order])
    number = np.repeat(np.cumsum(first) - 1, lengths)
    codes = np.frombuffer("".join(held[i][1] + "\n" for i in order).encode("utf-32-le"), np.uint32)
    seen = np.bincount(codes)
    seen[ord("\n")] = 0
    letters = np.flatnonzero(seen)
    rank = np.zeros(len(seen), np.int64)
    rank[letters] = np.arange(1, len(letters) + 1)
    base = len(letters) + 1
    ranks = np.append(rank[codes], np.zeros(N - 1, np.int64))
    key = ranks[: len(codes)]
    inside = more = key > 0
    for i in range(1, N):
        step = ranks[i : i + len(codes)] * more
        more = step > 0
        key = key * base + step
    names = None
    if base**N * len(doc_of) >= 1 << 63:
        names, key = np.unique(key, return_inverse=True)
    pairs = np.sort((key * len(doc_of) + number)[inside])
    pairs = pairs[np.append(True, pairs[1:] != pairs[:-1])] if len(pairs) else pairs
    key, number = np.divmod(pairs, len(doc_of))
    block = (doc_of % blocks)[number]
    starts = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (block[1:] != block[:-1]))) if len(key) else np.zeros(0, np.int64)
    gram = key[starts] if names is None else names[key[starts]]
    ranks = np.stack([gram // base ** (N - 1 - i) % base for i in range(N)], 1)
    text = np.append(0, letters)[ranks[ranks > 0]].astype(np.uint32).tobytes().decode("utf-32-le")
    ends = np.cumsum((ranks > 0).sum(1)).tolist()
    grams = [text[i:j] for i, j in zip([0, *ends], ends)]
    lists = pa.ListArray.from_arrays(np.append(starts, len(number)).astype(np.int32), pa.array(doc_of[number]))
    return pa.record_batch([pa.array(grams, pa.string()), pa.array(block[starts].astype(np.int32)), lists], schema=_LISTS)


def _doc_id(path: str = "path") -> Column:
    return F.xxhash64(path)


def _hex(doc: Column) -> Column:
    return F.lower(F.lpad(F.hex(doc), 16, "0"))


def posting_lists(texts: DataFrame, blocks: int = 1) -> DataFrame:
    """`(gram, block, n, docs)`: for each gram the hashes of the paths of `texts (path, content)` that have it, `n` in each block.

    Grams are of lower-cased lines. A gram that is in every text is no hot key: blocks by the path's hash split its list, and each task makes
    lists of `PIECE` characters of its own texts first. Texts of any length are cut in pieces that overlap by a gram.
    """
    piece = PIECE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                for start in range(0, len(text), piece):
                    held.append((doc, text[start : start + piece + N - 1]))
                    size += len(held[-1][1])
                    if size >= piece:
                        yield _lists(held, blocks)
                        held, size = [], 0
        if held:
            yield _lists(held, blocks)

    lower = texts.select(_doc_id().alias("doc"), F.lower("content").alias("text")).filter(F.col("text").isNotNull())
    some = lower.mapInArrow(run, "gram string, block int, docs array<bigint>").repartition("gram", "block")
    lists = some.groupBy("gram", "block").agg(F.array_distinct(F.flatten(F.collect_list("docs"))).alias("docs"))
    return lists.select("gram", "block", F.size("docs").alias("n"), "docs")


def write_index(texts: DataFrame, path: str, blocks: int | None = None) -> None:
    """Writes the texts that can be searched, by the hash of their path, and their posting lists, sorted by gram.

    Paths are taken as unique. Without `blocks`, their number follows the number of texts (this counts them).
    """
    own = searchable(texts, enforce=False).filter(F.col("content").isNotNull())
    keyed = C.bucketed(own.select(_hex(_doc_id()).alias("chunk_id"), "path", "content"))
    out = keyed.hint("rebalance", "bucket").sortWithinPartitions("bucket", "chunk_id").write.mode("overwrite").partitionBy("bucket")
    out.option("parquet.block.size", ROW_GROUP_BYTES).option("parquet.bloom.filter.enabled#chunk_id", "true").option(
        "parquet.bloom.filter.expected.ndv#chunk_id", ROW_GROUP_IDS
    ).parquet(f"{path}/texts")
    stored, _ = read_index(texts.sparkSession, path, lists=False)
    blocks = blocks or max(stored.count() // LIST_DOCS, 1)
    lists = posting_lists(stored.select("path", "content"), blocks)
    lists.repartitionByRange("gram", "block").sortWithinPartitions("gram", "block").write.mode("overwrite").option(
        "parquet.block.size", ROW_GROUP_BYTES
    ).parquet(f"{path}/lists")


def read_index(spark: SparkSession, path: str, lists: bool = True) -> tuple[DataFrame, DataFrame | None]:
    """The stored texts `(chunk_id, path, content, bucket)` and the posting lists."""
    return spark.read.schema(_TEXTS).parquet(f"{path}/texts"), spark.read.parquet(f"{path}/lists") if lists else None


def _named(lists: DataFrame, wanted: DataFrame, column: str) -> DataFrame:
    """The lists of the wanted grams, or of grams with a wanted `head`; a few are a filter of the scan (this acts)."""
    few = [r[0] for r in wanted.select(column).distinct().limit(MAX_LISTED_GRAMS + 1).collect()]
    if len(few) > MAX_LISTED_GRAMS:
        return lists
    if column == "gram":
        return lists.filter(F.col("gram").isin(few))
    test = F.lit(False)
    for head in few:
        test = test | F.col("gram").startswith(head)
    return lists.filter(test)


def candidates(lists: DataFrame, queries: DataFrame) -> DataFrame:
    """`(query_id, needle, doc)`: the texts that have the rarest grams of each lower-cased needle, a superset of those that have the needle.

    A needle shorter than a gram is the head of one wherever it stands. Lists are intersected block by block inside a row, so a common gram's list is
    neither unfolded nor gathered.
    """
    grams = cut_lineage(queries.select("query_id", "needle", F.explode(_grams(F.col("needle"))).alias("gram")))
    near = _named(lists, grams, "gram")
    counts = near.groupBy("gram").agg(F.sum("n").alias("n"))
    # A gram without a list ends its query; a join that keeps it tells so.
    rated = grams.join(counts, "gram", "left").groupBy("query_id", "needle").agg(
        F.count_if(F.col("n").isNull()).alias("none"), F.slice(F.array_sort(F.collect_list(F.struct("n", "gram"))), 1, RAREST).alias("rare")
    )
    chosen = rated.filter("none = 0").select("query_id", "needle", F.size("rare").alias("k"), F.explode("rare.gram").alias("gram"))
    chosen = cut_lineage(chosen)
    met = chosen.join(_named(lists, chosen, "gram").select("gram", "block", "docs"), "gram")
    blocks = met.groupBy("query_id", "needle", "k", "block").agg(F.collect_list("docs").alias("lists")).filter(F.size("lists") == F.col("k"))
    shared = F.aggregate(F.slice("lists", 2, RAREST), F.get("lists", F.lit(0)), F.array_intersect)
    long = blocks.select("query_id", "needle", F.explode(shared).alias("doc"))
    heads = queries.filter(F.length("needle") < N).select("query_id", "needle", F.col("needle").alias("head"))
    cut = _named(lists, heads, "head").select(F.explode(F.array(*[F.left("gram", F.lit(k)) for k in range(1, N)])).alias("head"), "docs")
    short = cut.join(heads, "head").select("query_id", "needle", F.explode("docs").alias("doc")).distinct()
    return long.unionByName(short)


def _tested(max_lines: int | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows `(path, low, lines, ids, needles)` to `(query_id, path, matches)` for those needles that stand in the lowered text.

    Only lowered texts and needles become Python strings; what is given on is taken from the columns.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            path, low, lines, ids, asked = batch.columns
            line_at, asked_at, needles = lines.offsets.to_numpy(), asked.offsets.to_numpy(), asked.values.to_pylist()
            rows, queries, numbers, ends, size = [], [], [], [0], 0

            def told() -> pa.RecordBatch:
                at = np.repeat(line_at[rows], np.diff(ends)) + np.array(numbers, np.int64)
                hits = pa.StructArray.from_arrays([pa.array(numbers, pa.int32()), lines.values.take(pa.array(at - 1))], ["line", "text"])
                matches = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), hits)
                return pa.record_batch([ids.values.take(pa.array(queries)), path.take(pa.array(rows)), matches], ["query_id", "path", "matches"])

            for row, text in enumerate(low):
                text = text.as_py()
                own = None
                for query in range(asked_at[row], asked_at[row + 1]):
                    needle = needles[query]
                    if needle not in text:
                        continue
                    own = own or text.split("\n")
                    hits = list(islice((i for i, line in enumerate(own, 1) if needle in line), max_lines))
                    rows.append(row)
                    queries.append(query)
                    numbers += hits
                    ends.append(len(numbers))
                    size += sum(len(own[i - 1]) for i in hits)
                    if size >= FOUND_AT_ONCE:
                        yield told()
                        rows, queries, numbers, ends, size = [], [], [], [0], 0
            if rows:
                yield told()

    return run


def search_many(
    texts: DataFrame,
    lists: DataFrame,
    queries: DataFrame,
    scope: str | None = None,
    rules: Rules = K.DEFAULT_SCOPES,
    agent: str = K.DEFAULT_AGENT,
    enforce: bool = True,
    max_lines: int | None = K.SEARCH_MAX_LINES,
) -> DataFrame:
    """`(query_id, path, matches)`: for each row of `queries (query_id, query)` what `search_all` finds in an index.

    Null and blank queries have no rows, nor have those with a line break, which no line holds. A query given twice under one id counts
    once. Candidates are found first (this acts); then the texts of candidates are fetched by id and tested for their own queries alone. A text is
    lowered and cut into lines once for `ASKED_AT_ONCE` of its queries. A query that most texts answer costs as much as its answer.
    """
    own = queries.filter(F.col("query").rlike(r"\S") & ~F.col("query").contains("\n"))
    own = own.select("query_id", F.lower("query").alias("needle")).distinct()
    found = candidates(lists, own).select("query_id", "needle", _hex(F.col("doc")).alias("chunk_id"))
    found = cut_lineage(found)
    on = ["bucket", "chunk_id"]  # as in `fetch`, so that texts move once
    fetched = searchable(C.fetch(texts, found), scope, rules, agent, enforce).select(*on, "path", "content")
    part = F.pmod(F.xxhash64("query_id", "needle"), F.lit(own.count() // ASKED_AT_ONCE + 1))
    moved = C.bucketed(found).repartition(*on)
    asked = moved.groupBy(*on, part.alias("part")).agg(F.collect_list(F.struct("query_id", "needle")).alias("asked"))
    met = fetched.join(asked, on).select(
        "path", F.lower("content").alias("low"), F.split("content", "\n", -1).alias("lines"), F.col("asked.query_id").alias("ids"), F.col("asked.needle").alias("needles")
    )
    schema = T.StructType([own.schema["query_id"], T.StructField("path", T.StringType()), T.StructField("matches", _MATCHES)])
    return met.mapInArrow(_tested(max_lines), schema)
