"""Toxicity: a conditional random field tags toxic spans; its marginals give document scores and offsets."""

from __future__ import annotations

import pickle
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import crf
from tidemark.llm.common import Query, id_remainder, own_names, table

# Labels are learned from at most so many documents of either label, none longer than SAMPLE_CHARS. They bound
# the fit alone; every document is scored whole.
SAMPLE_TOXIC, SAMPLE_CLEAN, SAMPLE_CHARS = 2_000, 4_000, 20_000
FOLDS, HELD_OUT, CALIBRATION = 5, 0, 4
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_GROUP_WORDS = 100_000
_SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
_OUT = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("spans", _SPANS)])


def _words(text: str | None) -> list[str]:
    return _WORD.findall(text) if text else []


def _unlike(texts: list[list[str]]) -> list[int]:
    """Positions of texts that share none of four least shingle hashes with an earlier one: copies would pass for evidence."""
    seen, left = set(), []
    factors = np.array([1, 0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint64)
    for at, words in enumerate(texts):
        codes = np.array([zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in words] or [0], np.uint64)
        grams = codes if len(codes) < 3 else codes[:-2] * np.uint64(3) + codes[1:-1] * np.uint64(5) + codes[2:] * np.uint64(7)
        least = [(k, int((grams * f % np.uint64(4294967291)).min())) for k, f in enumerate(factors)]
        if not seen.intersection(least):
            left.append(at)
        seen.update(least)
    return left


def _shapes(field: crf.Field, texts: list[list[str]]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Per text the two numbers a score is made of, and the marginals of its words; texts are taken in groups."""
    sums, marginals, at = [], [], 0
    while at < len(texts):
        group, size = [], 0
        while at < len(texts) and (not group or size + len(texts[at]) <= _GROUP_WORDS):
            group.append(texts[at])
            size += len(texts[at])
            at += 1
        lengths = np.array([len(g) for g in group], np.int64)
        emissions = np.array([e for g in group for e in field.emissions(g)])
        chances = field.marginals(emissions, lengths)
        ends = np.cumsum(lengths)
        marginals += [chances[e - n : e] for e, n in zip(ends, lengths)]
    for chances in marginals:
        total = float(chances.sum())
        sums.append((np.log(total + 0.01), np.log(total / (len(chances) + 20) + 1e-4)))
    return np.array(sums).reshape(-1, 2), marginals


@dataclass
class Scorer:
    """The field, and the weights of a logistic map from its marginals to the chance of label 1."""

    field: crf.Field | None
    weights: np.ndarray

    def scores(self, texts: list[list[str]]) -> tuple[np.ndarray, list[np.ndarray]]:
        if self.field is None:
            return np.full(len(texts), self.weights[0]), [np.zeros(len(t)) for t in texts]
        shapes, marginals = _shapes(self.field, texts)
        return 1.0 / (1.0 + np.exp(-(self.weights[0] + shapes @ self.weights[1:]))), marginals


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted logistic regression by Newton steps with a weak penalty."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (y - p)) - 0.01 * w
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w = w + step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-9))
    return w


def fit(rows: list[tuple[str, bool, bool]], share: float) -> Scorer:
    """Fits rows `(text, toxic, for_calibration)`; `share` is that of toxic documents among all labelled ones.

    Without rows of both labels every score is `share`.
    """
    field_rows = [(_words(t), y) for t, y, c in rows if not c]
    left = _unlike([w for w, _ in field_rows])
    texts, toxic = [field_rows[i][0] for i in left], np.array([field_rows[i][1] for i in left], bool)
    if not toxic.any() or toxic.all():
        return Scorer(None, np.array([share]))
    field = crf.trained(texts, toxic)
    held = [(_words(t), y) for t, y, c in rows if c]
    if len({y for _, y in held}) < 2:
        held = list(zip(texts, toxic.tolist()))
    y = np.array([v for _, v in held], float)
    weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    return Scorer(field, _logistic(_shapes(field, [w for w, _ in held])[0], y, weight))


def train(docs: DataFrame, labels: DataFrame) -> Scorer:
    """Learns from the labelled documents outside the held-out fold (crc32 of doc_id as text, modulo 5, is 0).

    Rows without a label of 0 or 1 are left out; an id with several labels counts with each. The sample is
    chosen on the labels alone, by a hash of the id, and its size bounds the ids that are broadcast.
    """
    known = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & (id_remainder("doc_id", FOLDS) != HELD_OUT))
    known = known.select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("_toxic"))
    total, toxic = known.agg(F.count("*"), F.sum("_toxic")).first()
    if not total:
        return Scorer(None, np.array([0.0]))
    parts = [
        known.filter(F.col("_toxic") == label).orderBy(F.xxhash64("_id"), "_id").limit(most)
        for label, most in ((1, SAMPLE_TOXIC), (0, SAMPLE_CLEAN))
    ]
    chosen = F.broadcast(parts[0].unionByName(parts[1]))
    texts = docs.select("doc_id", "text").join(chosen, F.col("doc_id") == F.col("_id")).filter(F.length("text") <= SAMPLE_CHARS)
    rows = texts.select("text", (F.col("_toxic") == 1).alias("toxic"), (id_remainder("doc_id", FOLDS) == CALIBRATION).alias("later"), "doc_id")
    share = (toxic or 0) / total

    def fitted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = sorted(row for batch in batches for row in batch.itertuples(index=False, name=None))
        yield pd.DataFrame({"model": [pickle.dumps(fit([r[:3] for r in found], share))]})

    # The sample is bounded, so one task fits it; the model alone comes to the driver.
    models = rows.repartition(1).mapInPandas(fitted, "model binary").collect()
    return pickle.loads(models[0]["model"]) if models else Scorer(None, np.array([share]))


def scored(docs: DataFrame, scorer: Scorer, text: str = "text", result: str = "toxicity") -> DataFrame:
    """`docs` with a struct column `result` of `(score, spans)`; it replaces one of that name.

    `score` is the chance of label 1, from the text alone; `spans` are code-point offsets of words that are
    toxic with a marginal of one half or more, neighbours merged. Null and empty texts have no words: their
    score is that of a text without evidence. Equal texts get equal scores, rows repeat, and an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(scorer)

    @F.pandas_udf(_OUT)
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for texts in batches:
            values, spans = [], []
            for at in range(0, len(texts), 200):
                part = texts.iloc[at : at + 200].tolist()
                found, marginals = model.scores([_words(t) for t in part])
                values += found.tolist()
                spans += [_offsets(t, m) for t, m in zip(part, marginals)]
            yield pd.DataFrame({"score": values, "spans": spans})

    return docs.withColumn(result, score(text))


def without_toxic(docs: DataFrame, scorer: Scorer, text: str = "text") -> DataFrame:
    """The rows of `docs`, all columns, whose texts score under one half."""
    result = own_names(docs, "_toxicity")[0]
    return scored(docs, scorer, text, result).filter(F.col(f"{result}.score") < 0.5).drop(result)


def _offsets(text: str | None, marginals: np.ndarray) -> list[dict]:
    if not len(marginals) or marginals.max() < 0.5:
        return []
    spans, last = [], -2
    for at, match in enumerate(_WORD.finditer(text)):
        if marginals[at] >= 0.5:
            if last == at - 1:
                spans[-1]["end"] = match.end()
            else:
                spans.append({"start": match.start(), "end": match.end()})
            last = at
    return spans


def op7_toxic_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learned from the labels outside the held-out fold."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scored(docs, train(docs, table(spark, sf_dir, "labels")))
    return found.select(
        "doc_id", (id_remainder("doc_id", FOLDS) == HELD_OUT).alias("held_out"), F.col("toxicity.score").alias("score"),
        F.when(F.col("toxicity.score") >= 0.5, 1).otherwise(0).alias("predicted"),
        F.size("toxicity.spans").cast("long").alias("n_spans"),
    )


QUERIES: dict[str, Query] = {"op7_toxic_spans": op7_toxic_spans}
SQL: dict[str, str] = {}
