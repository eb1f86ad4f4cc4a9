"""Quality rules as a short-circuit cascade, ordered by what each rejects for its cost on a sample."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import Query, table

WINDOW = 8
SAMPLE = 2_000  # documents on which costs and rejections are measured; they decide the order alone
# Fixed values of the rules.
LEAST_WORDS, REPEAT_PERCENT = 20, 30
SYMBOL_PERCENT, LINE_PERCENT, LETTER_PERCENT, LEAST_MEAN, MOST_MEAN, TOP_PERCENT, ECHO_PERCENT = 10, 50, 80, 2, 14, 30, 30
_SYMBOLS, _BLANKS = b"#*$%&|<>", b"\x20\x09\x0a\x0b\x0c\x0d"
_LETTER = bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256))
_MIX = np.array([pow(0x9E3779B97F4A7C15, k, 1 << 64) for k in range(1, WINDOW + 1)], dtype=np.uint64)


@dataclass
class Doc:
    """A text and what rules have derived from it, each at most once."""

    text: str
    known: dict[str, object] = field(default_factory=dict)

    def get(self, name: str):
        if name not in self.known:
            self.known[name] = _DERIVED[name](self)
        return self.known[name]


def _repeated_words(doc: Doc) -> int:
    """Words in windows of eight words that occur twice or more, the first occurrence included."""
    words = doc.get("words")
    if len(words) <= WINDOW:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.uint64, len(words)) + np.uint64(1)
    count = len(ids) - WINDOW + 1
    mixed = np.zeros(count, np.uint64)
    for k in range(WINDOW):
        mixed += ids[k : k + count] * _MIX[k]
    mixed ^= mixed >> np.uint64(29)
    ordered = np.sort(mixed)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    # Equal hashes only say where to look; the windows themselves are compared.
    at = np.flatnonzero(np.isin(mixed, twice))
    seen: dict[bytes, int] = {}
    windows = [ids[i : i + WINDOW].tobytes() for i in at.tolist()]
    for w in windows:
        seen[w] = seen.get(w, 0) + 1
    starts = np.array([i for i, w in zip(at.tolist(), windows) if seen[w] > 1], dtype=np.int64)
    change = np.zeros(len(ids) + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + WINDOW, -1)
    return int((np.cumsum(change) > 0).sum())


def _duplicate_lines(doc: Doc) -> int:
    lines = [line for line in doc.get("bytes").split(b"\n") if line.strip(_BLANKS)]
    return len(lines) - len(set(lines))


def _top_count(doc: Doc) -> int:
    counts: dict[bytes, int] = {}
    for w in doc.get("words"):
        counts[w] = counts.get(w, 0) + 1
    return max(counts.values(), default=0)


_DERIVED: dict[str, Callable[[Doc], object]] = {
    "bytes": lambda d: d.text.encode("utf-8", "surrogatepass"),
    "words": lambda d: d.get("bytes").split(),
    "n_words": lambda d: len(d.get("words")),
    "word_chars": lambda d: len(d.text) - len(d.get("bytes")) + len(d.get("bytes").translate(None, _BLANKS)),
    "n_symbols": lambda d: len(d.get("bytes")) - len(d.get("bytes").translate(None, _SYMBOLS)),
    "n_dup_lines": _duplicate_lines,
    "n_repeat_words": _repeated_words,
    "n_lines": lambda d: sum(1 for line in d.get("bytes").split(b"\n") if line.strip(_BLANKS)),
    "n_lettered": lambda d: sum(1 for w in d.get("words") if len(w.translate(None, _LETTER)) < len(w)),
    "n_top": _top_count,
    "n_echoes": lambda d: sum(map(eq, d.get("words"), d.get("words")[1:])),
}
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def base_failed(d: Doc) -> bool:
    return d.get("n_words") < LEAST_WORDS or 100 * d.get("n_repeat_words") > REPEAT_PERCENT * d.get("n_words")


# A rule is true for what it rejects.
RULES: dict[str, Callable[[Doc], bool]] = {
    "symbols": lambda d: 100 * d.get("n_symbols") > SYMBOL_PERCENT * d.get("n_words"),
    "lines": lambda d: 100 * d.get("n_dup_lines") > LINE_PERCENT * d.get("n_lines"),
    "short_words": lambda d: d.get("word_chars") < LEAST_MEAN * d.get("n_words"),
    "long_words": lambda d: d.get("word_chars") > MOST_MEAN * d.get("n_words"),
    "letters": lambda d: 100 * d.get("n_lettered") < LETTER_PERCENT * d.get("n_words"),
    "echoes": lambda d: 100 * d.get("n_echoes") > ECHO_PERCENT * d.get("n_words"),
    "top_word": lambda d: 100 * d.get("n_top") > TOP_PERCENT * d.get("n_words"),
}
_COSTS = T.StructType([T.StructField("rule", T.StringType()), T.StructField("rejected", T.LongType()), T.StructField("nanos", T.LongType())])
_VERDICT = T.StructType(
    [T.StructField(n, T.LongType()) for n in BASE]
    + [T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType()), T.StructField("rejected_by", T.StringType())]
)


def measured(sample: DataFrame, text: str) -> DataFrame:
    """`(rule, rejected, nanos)`: what each rule rejects of the sample and how long it takes, features it needs included.

    What the base has derived anyway costs a rule nothing.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals = {name: [0, 0] for name in RULES}
        for batch in batches:
            for value in batch.iloc[:, 0]:
                doc = Doc(value or "")
                base_failed(doc)
                for name in BASE:
                    doc.get(name)
                for name, rule in RULES.items():
                    fresh = Doc(doc.text, dict(doc.known))
                    start = time.perf_counter_ns()
                    totals[name][0] += bool(rule(fresh))
                    totals[name][1] += time.perf_counter_ns() - start
        yield pd.DataFrame([(k, *v) for k, v in totals.items()], columns=["rule", "rejected", "nanos"])

    parts = sample.select(text).mapInPandas(run, _COSTS)
    return parts.groupBy("rule").agg(F.sum("rejected").alias("rejected"), F.sum("nanos").alias("nanos"))


def order(costs: DataFrame) -> list[str]:
    """The rules by rejections per nanosecond, best first; a rule that was not seen comes last, ties by name."""
    seen = {r["rule"]: r["rejected"] / max(r["nanos"], 1) for r in costs.collect()}
    return sorted(RULES, key=lambda name: (-seen.get(name, -1.0), name))


def verdicts(docs: DataFrame, text: str = "text", result: str = "quality", sample: int = SAMPLE) -> DataFrame:
    """`docs` with a struct column `result`: the base features, `base_failed`, `kept` and `rejected_by`.

    The rules run in the order that a sample of about `sample` rows suggests and stop at the first that rejects:
    its name is `rejected_by` (`base` for the base; null if kept). `kept` does not depend on the order, as
    a document is kept if no rule rejects it. A null text is an empty one: it has no words and fails the base.
    Repeated rows get equal verdicts; a column named `result` is replaced; an empty table gives no rows.
    """
    rows = docs.count()
    ranked = order(measured(docs.sample(min(1.0, sample / rows), seed=7) if rows else docs, text))

    @F.pandas_udf(_VERDICT)
    def judged(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            out = []
            for value in texts:
                doc = Doc(value or "")
                failed = base_failed(doc)
                by = "base" if failed else next((name for name in ranked if RULES[name](doc)), None)
                out.append((*(doc.get(n) for n in BASE), failed, by is None, by))
            yield pd.DataFrame(out, columns=[f.name for f in _VERDICT])

    return docs.withColumn(result, judged(text))


def op3_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base features and verdicts of all documents."""
    judged = verdicts(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", *[f"quality.{n}" for n in (*BASE, "base_failed", "kept")])


QUERIES: dict[str, Query] = {"op3_quality_cascade": op3_quality_cascade}
SQL: dict[str, str] = {
    "op3_quality_cascade": rf"""
WITH docs AS MATERIALIZED (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines
  FROM documents
),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS s
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - {WINDOW - 1})) AS i FROM docs)
),
twice AS (SELECT doc_id, s FROM windows GROUP BY ALL HAVING count(*) > 1),
repeats AS (
  SELECT doc_id, count(DISTINCT p) AS n
  FROM (SELECT doc_id, unnest(generate_series(i, i + {WINDOW - 1})) AS p FROM windows JOIN twice USING (doc_id, s)) GROUP BY doc_id
),
features AS (
  SELECT doc_id, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words, len(lines) AS n_lines,
    len([x FOR x IN w IF regexp_matches(x, '[^\x00-\x40\x5B-\x60\x7B-\x7F]')]) AS n_lettered,
    coalesce(list_max(map_values(histogram_w)), 0) AS n_top, len([x FOR x, i IN w IF w[i - 1] = x AND i > 1]) AS n_echoes
  FROM docs LEFT JOIN repeats USING (doc_id)
  LEFT JOIN (SELECT doc_id, histogram(x) AS histogram_w FROM (SELECT doc_id, unnest(w) AS x FROM docs) GROUP BY doc_id) USING (doc_id)
),
based AS (SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words AS base_failed FROM features)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 100 * n_symbols > {SYMBOL_PERCENT} * n_words OR 100 * n_dup_lines > {LINE_PERCENT} * n_lines
    OR word_chars < {LEAST_MEAN} * n_words OR word_chars > {MOST_MEAN} * n_words
    OR 100 * n_lettered < {LETTER_PERCENT} * n_words OR 100 * n_top > {TOP_PERCENT} * n_words
    OR 100 * n_echoes > {ECHO_PERCENT} * n_words) AS kept
FROM based"""
}
