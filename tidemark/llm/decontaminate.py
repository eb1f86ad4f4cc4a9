"""Benchmark decontamination: documents streamed through a suffix automaton of all test items."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import Query, own_names, settled, table

WINDOW, COVER_PERCENT = 13, 5
# Item words per automaton. A larger benchmark is met block by block.
BLOCK_WORDS = 500_000

# Keeps 0-9, a-z and all bytes beyond ASCII, lower-cases A-Z, and makes any other byte a blank.
_PLAIN = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
_SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
_OUT = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
    T.StructField("items", T.ArrayType(T.StringType())), T.StructField("spans", _SPANS),
])


def item_words(text: str | None) -> list[bytes]:
    """Words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` in UTF-8 after lower-casing A-Z; none for null."""
    return text.encode("utf-8", "surrogatepass").translate(_PLAIN).split() if text else []


class Automaton:
    """Generalised suffix automaton over the words of test items.

    A state stands for word sequences that end at the same places of the items. `owners[s]` names the items
    with the window of `WINDOW` words that state s holds; `short[s]` the whole items shorter than that.
    """

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.words: dict[bytes, int] = {}
        self.step: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = []
        for name, words in items:
            if words:
                coded.append((name, [self.words.setdefault(w, len(self.words)) for w in words]))
        for _, ids in coded:
            last = 0
            for w in ids:
                last = self._extend(last, w)
        self._mark(coded)
        self.least = min([window, *(len(ids) for _, ids in coded)])

    def _new(self, step: dict[int, int], link: int, length: int) -> int:
        self.step.append(step)
        self.link.append(link)
        self.length.append(length)
        return len(self.length) - 1

    def _split(self, before: int, word: int, target: int) -> int:
        """A state of its own for the part of `target` that is reached from `before`."""
        copy = self._new(dict(self.step[target]), self.link[target], self.length[before] + 1)
        self.link[target] = copy
        while before >= 0 and self.step[before].get(word) == target:
            self.step[before][word] = copy
            before = self.link[before]
        return copy

    def _extend(self, last: int, word: int) -> int:
        """Adds a word after the sequence of state `last`; gives the state of the longer sequence."""
        target = self.step[last].get(word)
        if target is not None:
            return target if self.length[target] == self.length[last] + 1 else self._split(last, word, target)
        added = self._new({}, 0, self.length[last] + 1)
        at = last
        while at >= 0 and word not in self.step[at]:
            self.step[at][word] = added
            at = self.link[at]
        if at >= 0:
            target = self.step[at][word]
            whole = self.length[target] == self.length[at] + 1
            self.link[added] = target if whole else self._split(at, word, target)
        return added

    def _mark(self, coded: list[tuple[str, list[int]]]) -> None:
        owners: dict[int, set[str]] = {}
        short: dict[int, list[tuple[int, str]]] = {}
        for name, ids in coded:
            state = held = 0
            for w in ids:
                state, held = self.step[state][w], held + 1
                if held > self.length[state]:
                    raise AssertionError("an item is a path of its automaton")
                if held >= self.window:
                    owners.setdefault(self.at_window(state), set()).add(name)
            if len(ids) < self.window:
                short.setdefault(state, []).append((len(ids), name))
        self.owners = {s: tuple(sorted(names)) for s, names in owners.items()}
        self.short = short
        # The nearest state on the way to the root, itself included, that ends a short item.
        self.up = [-1] * len(self.length)
        for s in sorted(range(len(self.length)), key=self.length.__getitem__):
            self.up[s] = s if s in short else self.up[self.link[s]] if s else -1

    def at_window(self, state: int) -> int:
        """The state of the last `window` words, for a state of at least as many."""
        while self.length[self.link[state]] >= self.window:
            state = self.link[state]
        return state

    def scan(self, words: list[bytes]) -> tuple[list[list[int]], set[str]]:
        """Word intervals `[start, end)` inside occurrences of windows, merged, and the items they belong to."""
        spans: list[list[int]] = []
        found: set[str] = set()
        ids = np.fromiter(map(self.words.get, words, repeat(-1)), np.int64, len(words))
        # Only runs of item words can hold a window.
        edges = np.flatnonzero(np.diff(np.concatenate(([0], (ids >= 0).view(np.int8), [0]))))
        for start, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if end - start >= self.least:
                self._run(ids[start:end].tolist(), start, spans, found)
        return spans, found

    def _run(self, ids: list[int], offset: int, spans: list[list[int]], found: set[str]) -> None:
        step, link, length, up, window = self.step, self.link, self.length, self.up, self.window
        state = held = 0
        for end, w in enumerate(ids, offset + 1):
            while (after := step[state].get(w)) is None and state:
                state = link[state]
                held = length[state]
            if after is None:
                held = 0
                continue
            state, held, widest = after, held + 1, 0
            if held >= window:
                widest = window
                found.update(self.owners[self.at_window(state)])
            at = up[state]
            while at >= 0:
                for size, name in self.short[at]:
                    if size <= held:
                        widest = max(widest, size)
                        found.add(name)
                at = up[link[at]] if at else -1
            if widest:
                begin = end - widest
                while spans and begin <= spans[-1][0]:
                    spans.pop()
                if spans and begin <= spans[-1][1]:
                    spans[-1][1] = end
                else:
                    spans.append([begin, end])


def _judge(automaton):
    """Column function over texts for one broadcast automaton."""

    @F.pandas_udf(_OUT)
    def judged(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        machine = automaton.value
        for texts in batches:
            rows = []
            for text in texts:
                words = item_words(text)
                spans, found = machine.scan(words)
                rows.append((len(words), sum(e - s for s, e in spans), sorted(found), [{"start": s, "end": e} for s, e in spans]))
            yield pd.DataFrame(rows, columns=["n_words", "n_hit", "items", "spans"])

    return judged


def _merged(one: Column, other: Column) -> Column:
    """Sorted disjoint intervals that cover what either list covers."""
    every = F.array_sort(F.concat(one, other))
    whole = F.aggregate(
        every,
        F.array().cast("array<struct<start:int, end:int>>"),
        lambda kept, x: F.when(
            (F.size(kept) > 0) & (x.start <= F.element_at(kept, -1).end),
            F.concat(
                F.slice(kept, 1, F.size(kept) - 1),
                F.array(F.struct(F.element_at(kept, -1).start.alias("start"), F.greatest(F.element_at(kept, -1).end, x.end).alias("end"))),
            ),
        ).otherwise(F.concat(kept, F.array(x))),
    )
    return whole


def judge(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
          result: str = "contamination", block_words: int = BLOCK_WORDS) -> DataFrame:
    """`docs` with a struct column `result` of `(n_words, n_hit, items, spans, contaminated)`; it replaces one of that name.

    A window is 13 consecutive item words, or a shorter item as a whole. Words inside any occurrence are
    hit: `spans` gives them as word intervals, `items` the ids (as strings, sorted) of the items met. A
    document is contaminated if a word is hit and the hit words are 5 % or more of its words. Null, empty
    and wordless texts have no words and are clean; so is everything beside an empty benchmark. Null items and
    items without words have no window; a null item id counts as the text `null`. Repeated rows are judged alike.

    The automata are broadcast. One holds the items of at most about `block_words` words (the items are dealt to blocks by
    hash; an item is never split); with several blocks the documents are written between them, so a
    worker never holds more than one automaton.
    """
    items = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("item"), F.col(item_text).alias("words_of"))
    size = items.agg(F.sum(F.octet_length("words_of"))).first()[0] or 0
    blocks = 1 + int(size // (6 * block_words))
    spark = docs.sparkSession
    none = F.array().cast("array<string>")
    out, one = docs, own_names(docs, "_found")[0]
    for block in range(blocks):
        part = items if blocks == 1 else items.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block)
        held = [(r[0], item_words(r[1])) for r in part.toLocalIterator()]
        found = _judge(spark.sparkContext.broadcast(Automaton(held)))(F.col(text))
        if blocks == 1:
            out = out.withColumn(result, found)
            break
        out = out.withColumn(one, found)
        earlier = F.col(result) if block else F.struct(none.alias("items"), F.array().cast("array<struct<start:int, end:int>>").alias("spans"))
        spans = _merged(earlier.getField("spans"), F.col(f"{one}.spans"))
        out = out.withColumn(
            result,
            F.struct(
                F.col(f"{one}.n_words").alias("n_words"),
                F.aggregate(spans, F.lit(0).cast("long"), lambda n, x: n + x.end - x.start).alias("n_hit"),
                F.array_sort(F.array_union(earlier.getField("items"), F.col(f"{one}.items"))).alias("items"),
                spans.alias("spans"),
            ),
        ).drop(one)
        out = settled(out, "contamination")
    hit, words = F.col(f"{result}.n_hit"), F.col(f"{result}.n_words")
    return out.withColumn(result, F.col(result).withField("contaminated", (hit > 0) & (hit * (100 // COVER_PERCENT) >= words)))


def cut_spans(text: str | None, spans, longest: int = WINDOW) -> str | None:
    """The text without its hit spans of at least `longest` words, from the first to the last byte of their words."""
    if not text or not len(spans):
        return text
    plain = text.encode("utf-8", "surrogatepass")
    mask = np.frombuffer(plain.translate(_PLAIN), np.uint8) != 32
    edges = np.flatnonzero(np.diff(np.concatenate(([0], mask.view(np.int8), [0]))))
    starts, ends = edges[::2], edges[1::2]
    left, at = [], 0
    for span in spans:
        if span["end"] - span["start"] >= longest:
            left.append(plain[at : starts[span["start"]]])
            at = ends[span["end"] - 1]
    return (b"".join(left) + plain[at:]).decode("utf-8", "surrogatepass")


@F.pandas_udf(T.StringType())
def _cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
    return pd.Series([cut_spans(t, s) for t, s in zip(texts, spans)], dtype=object)


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", cut: bool = False) -> DataFrame:
    """The documents that are not contaminated, all columns as they were.

    With `cut`, the remaining documents also lose their hit spans of 13 words or more; without it, what
    stays below the coverage limit is left alone.
    """
    found = own_names(docs, "_contamination")[0]
    kept = judge(docs, benchmark, text, result=found).filter(~F.col(f"{found}.contaminated"))
    if cut:
        kept = kept.withColumn(text, F.when(F.size(f"{found}.spans") > 0, _cut(text, f"{found}.spans")).otherwise(F.col(text)))
    return kept.drop(found)


def op6_benchmark_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contamination of all documents by all benchmark items."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = judge(docs, table(spark, sf_dir, "benchmark")).select("doc_id", "contamination.*")
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _sql_words(column: str) -> str:
    return rf"regexp_extract_all(translate(coalesce({column}, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


QUERIES: dict[str, Query] = {"op6_benchmark_contamination": op6_benchmark_contamination}
CONTAMINATION_VIEWS = f"""
item_words AS MATERIALIZED (SELECT item_id, {_sql_words("text")} AS w FROM benchmark),
sizes AS (SELECT *, len(w) AS n FROM item_words WHERE len(w) > 0),
starts AS (SELECT item_id, w, least(n, {WINDOW}) AS k, unnest(generate_series(1, greatest(n - {WINDOW - 1}, 1))) AS i FROM sizes),
windows AS MATERIALIZED (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS s FROM starts),
doc_words AS MATERIALIZED (SELECT doc_id, {_sql_words("text")} AS w FROM {{documents}}),
doc_starts AS (
  SELECT doc_id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i
  FROM doc_words CROSS JOIN (SELECT DISTINCT k FROM windows)
),
met AS MATERIALIZED (
  SELECT d.doc_id, d.i, d.k, v.item_id
  FROM (SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS s FROM doc_starts) d JOIN windows v USING (k, s)
),
hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + k - 1)) AS p FROM met) GROUP BY doc_id
),
item_lists AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM met) GROUP BY doc_id
),
contamination AS (
  SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
  FROM doc_words LEFT JOIN hit USING (doc_id) LEFT JOIN item_lists USING (doc_id)
)"""
SQL: dict[str, str] = {
    "op6_benchmark_contamination": f"WITH {CONTAMINATION_VIEWS.format(documents='documents')} SELECT * FROM contamination"
}
