"""Hashed maximum-entropy language model: class-factored softmax over n-gram and skip features."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import Query, id_remainder, settled, table, text_hash, words_of

FOLDS, HELD_OUT = 7, 2
END = b"\n"  # the end token; no word can be it
HEAD = 200_000  # most frequent words at most that every worker knows by heart; all others meet their counts in a join
LONGEST = 64  # bytes of a head word, so that the head has a greatest size
CLASSES, MEMBERS = 32, 32  # frequent words: classes of so many words each
RARE = 32  # classes of all other words, by a hash of their last two bytes
ROWS, MOST_ROWS = 1 << 12, 1 << 16  # hashed feature rows of either table, a power of two: the least, and the most that each worker holds
TOKENS_A_ROW = 1 << 13  # training tokens for each row between these bounds
ROUNDS = (1, 3, 12)  # sixteenths of the training documents in each round of gradient updates
RATE, BATCH = 0.15, 8_192
_BOUND = np.float32(60.0)  # of logits; those of trained weights lie far inside
_BOS = CLASSES * MEMBERS + RARE
_OUT = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("n_tokens", "head_known")]
    + [T.StructField(n, T.DoubleType()) for n in ("head_log", "model_log")]
    + [T.StructField("tail", T.ArrayType(T.StructType([T.StructField("word", T.BinaryType()), T.StructField("times", T.IntegerType())])))]
)


def rare_class(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % RARE


def _rare_class(word: Column) -> Column:
    return F.crc32(F.substring(word, -2, 2)) % RARE


def word_counts(docs: DataFrame, text: str) -> DataFrame:
    """`(word binary, n)` over all texts, each with one end token. Words are counted inside each task before they move."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter[bytes] = Counter()

        def flushed() -> pd.DataFrame:
            out = pd.DataFrame({"word": list(counts.keys()), "n": list(counts.values())}, columns=["word", "n"])
            counts.clear()
            return out

        for batch in batches:
            for value in batch.iloc[:, 0]:
                counts.update(words_of(value))
                counts[END] += 1
                if len(counts) > 400_000:
                    yield flushed()
        if counts:
            yield flushed()

    return docs.select(text).mapInPandas(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """The head words and what the factored model knows of them; totals of the whole training corpus."""

    index: dict[bytes, int]  # head word -> its place in the arrays
    symbol: np.ndarray  # frequent words: class * MEMBERS + member; others: CLASSES * MEMBERS + rare class
    log_count: np.ndarray  # log10(c + 1)
    tokens: int
    distinct: int
    class_bias: np.ndarray  # logarithm of each class's share
    member_bias: np.ndarray  # of each member inside its class
    rare_total: np.ndarray  # log10 of counts plus distinct words plus one, by rare class

    def symbols(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Symbol of each word, and its place in the head or -1."""
        at = np.fromiter(map(self.index.get, words, repeat(-1)), np.int64, len(words))
        out = self.symbol[at] if len(self.symbol) else np.zeros(len(words), np.int64)
        away = np.flatnonzero(at < 0)
        out[away] = CLASSES * MEMBERS + np.array([rare_class(words[i]) for i in away.tolist()], np.int64)
        return out, at


def vocabulary(counts: DataFrame) -> Vocabulary:
    """Head words and class statistics. The head has the HEAD most frequent short words; of words about as frequent as the last, the first by word."""
    totals = counts.agg(F.sum("n"), F.count("*")).first()
    tokens, distinct = int(totals[0] or 0), int(totals[1])
    level = F.floor(F.log2(F.col("n").cast("double")) * 16).cast("int")
    short = counts.filter(F.octet_length("word") <= LONGEST)
    least, room = 1 << 30, HEAD
    part = None
    for at, words in sorted((tuple(r) for r in short.groupBy(level.alias("l")).count().collect()), reverse=True):
        if words > room:
            part = at
            break
        least, room = at, room - words
    chosen = short.filter(level >= least).select("word", "n")
    if part is not None and room:
        chosen = chosen.unionByName(short.filter(level == part).orderBy(F.desc("n"), "word").limit(room).select("word", "n"))
    head = sorted(((int(r[1]), bytes(r[0])) for r in chosen.toLocalIterator()), key=lambda x: (-x[0], x[1]))
    n = np.array([c for c, _ in head], np.float64)
    frequent = min(len(head), CLASSES * MEMBERS)
    symbol = np.zeros(len(head), np.int64)
    # Classes of near equal mass: words are dealt out in order of frequency, back and forth.
    rank = np.arange(frequent)
    lap, seat = rank // CLASSES, rank % CLASSES
    symbol[:frequent] = np.where(lap % 2 == 0, seat, CLASSES - 1 - seat) * MEMBERS + lap
    for i in range(frequent, len(head)):
        symbol[i] = CLASSES * MEMBERS + rare_class(head[i][1])
    mass = np.bincount(symbol[:frequent], n[:frequent], CLASSES * MEMBERS).reshape(CLASSES, MEMBERS)
    rare_n, rare_v = np.zeros(RARE), np.zeros(RARE)
    rare = counts.groupBy(_rare_class(F.col("word")).alias("r")).agg(F.sum("n").alias("n"), F.count("*").alias("v"))
    for r, c, v in rare.collect():
        rare_n[r], rare_v[r] = c, v
    for c, word in head[:frequent]:
        rare_n[rare_class(word)] -= c
        rare_v[rare_class(word)] -= 1
    share = np.concatenate((mass.sum(axis=1), rare_n)) + 1.0
    return Vocabulary(
        {w: i for i, (_, w) in enumerate(head)}, symbol, np.log10(n + 1.0), tokens, distinct,
        np.log(share / share.sum()).astype(np.float32), np.log((mass + 0.1) / (mass + 0.1).sum(axis=1, keepdims=True)).astype(np.float32),
        np.log10(rare_n + rare_v + 1.0),
    )


@dataclass
class Weights:
    """Hashed rows of the two softmax layers: over classes, and over the members of a frequent class."""

    classes: np.ndarray
    members: np.ndarray

    @classmethod
    def zero(cls, rows: int = ROWS) -> Weights:
        return cls(np.zeros((rows, CLASSES + RARE), np.float32), np.zeros((rows, MEMBERS), np.float32))


def table_rows(tokens: int) -> int:
    """Rows of either table for so many training tokens: they grow with the corpus, so contexts share a row no more often."""
    return min(max(1 << max(tokens // TOKENS_A_ROW, 1).bit_length() - 1, ROWS), MOST_ROWS)


def _row(size: int, kind: int, *parts) -> np.ndarray:
    value = np.uint64(kind * 0x9E3779B97F4A7C15 & (2**64 - 1))
    for p in parts:
        value = (value ^ p.astype(np.uint64)) * np.uint64(0xD6E8FEB86659FD93)
        value = value ^ (value >> np.uint64(32))
    return (value & np.uint64(size - 1)).astype(np.int64)


def contexts(symbols: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The symbols one, two and three places before each token; a mark where the text does not reach back so far."""
    since = np.arange(len(symbols)) - np.repeat(starts, np.diff(np.append(starts, len(symbols))))
    out = []
    for back in (1, 2, 3):
        before = np.full(len(symbols), _BOS, np.int64)
        before[back:] = symbols[:-back]
        before[since < back] = _BOS
        out.append(before)
    return tuple(out)


def _class_rows(size: int, one: np.ndarray, two: np.ndarray, three: np.ndarray) -> np.ndarray:
    """Feature rows of each token: word before, both words before, the second before (skip), first and third (skip)."""
    return np.stack([_row(size, 1, one), _row(size, 2, one, two), _row(size, 3, two), _row(size, 4, one, three)])


def _member_rows(size: int, cls: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """The same for a member inside its class: the class with the word before, and with the second before (skip)."""
    return np.stack([_row(size, 5, cls, one), _row(size, 6, cls, two)])


def _logits(table: np.ndarray, rows: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Sums of feature rows, held between bounds whose exponentials add up without overflow."""
    logits = np.take(table, rows[0], axis=0, mode="clip")
    logits += bias
    more = np.empty_like(logits)
    for r in rows[1:]:
        np.take(table, r, axis=0, out=more, mode="clip")
        logits += more
    return np.clip(logits, -_BOUND, _BOUND, out=logits)


def _row_sums(values: np.ndarray) -> np.ndarray:
    return values @ np.ones(values.shape[1], values.dtype)


def _chances(logits: np.ndarray) -> np.ndarray:
    np.exp(logits, out=logits)
    logits *= (1.0 / _row_sums(logits))[:, None]
    return logits


def _log_chance(logits: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Natural logarithm of the chance of one column in each row."""
    own = logits[np.arange(len(at)), at].astype(np.float64)
    return own - np.log(_row_sums(np.exp(logits, out=logits)))


def _updated(table: np.ndarray, squares: np.ndarray, rows: np.ndarray, gradient: np.ndarray) -> None:
    """Adds a batch's gradient to the feature rows it touches, and to these alone; steps shrink with a row's past gradients."""
    there = np.zeros(len(table), bool)
    there[rows] = True
    touched = np.flatnonzero(there)
    place = np.empty(len(table), np.int64)
    place[touched] = np.arange(len(touched))
    flat = place[rows].reshape(-1)
    summed, repeated = np.empty((gradient.shape[1], len(touched)), np.float32), np.empty(rows.shape)
    for at, column in enumerate(np.ascontiguousarray(gradient.T)):
        repeated[:] = column
        summed[at] = np.bincount(flat, repeated.reshape(-1), len(touched))
    past = squares[touched] + np.square(summed).mean(axis=0)
    squares[touched] = past
    summed *= RATE / np.sqrt(past + 1.0)
    table[touched] -= summed.T


def _batches(texts: Iterator[str | None], known: Vocabulary, size: int):
    """Groups of whole texts: words of each, symbols and head places of all, where texts start."""
    group, count = [], 0
    for text in texts:
        words = words_of(text)
        words.append(END)
        group.append(words)
        count += len(words)
        if count >= size:
            yield group
            group, count = [], 0
    if group:
        yield group


def _symbols(group: list[list[bytes]], known: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    flat = [w for words in group for w in words]
    lengths = np.array([len(words) for words in group], np.int64)
    return (*known.symbols(flat), np.cumsum(lengths) - lengths)


def learn(texts: Iterator[str | None], known: Vocabulary, weights: Weights) -> int:
    """Gradient updates over the texts, in place; gives the number of tokens."""
    seen = 0
    size = len(weights.classes)
    squares = np.zeros(size, np.float32), np.zeros(size, np.float32)
    for group in _batches(texts, known, 4 * BATCH):
        symbols, _, starts = _symbols(group, known)
        one, two, three = contexts(symbols, starts)
        seen += len(symbols)
        for at in range(0, len(symbols), BATCH):
            part = slice(at, at + BATCH)
            s = symbols[part]
            often = s < CLASSES * MEMBERS
            cls = np.where(often, s // MEMBERS, s - CLASSES * MEMBERS + CLASSES)
            rows = _class_rows(size, one[part], two[part], three[part])
            chance = _chances(_logits(weights.classes, rows, known.class_bias))
            chance[np.arange(len(s)), cls] -= 1.0
            _updated(weights.classes, squares[0], rows, chance)
            if often.any():
                c, m = cls[often], s[often] % MEMBERS
                rows = _member_rows(size, c, one[part][often], two[part][often])
                chance = _chances(_logits(weights.members, rows, known.member_bias[c]))
                chance[np.arange(len(c)), m] -= 1.0
                _updated(weights.members, squares[1], rows, chance)
    return seen


def log_chances(symbols: np.ndarray, starts: np.ndarray, known: Vocabulary, weights: Weights) -> np.ndarray:
    """Decimal logarithm of each token's class, and of its member if frequent; without the word inside a rare class."""
    one, two, three = contexts(symbols, starts)
    out, size = np.empty(len(symbols)), len(weights.classes)
    for at in range(0, len(symbols), BATCH):
        part = slice(at, at + BATCH)
        s = symbols[part]
        often = s < CLASSES * MEMBERS
        cls = np.where(often, s // MEMBERS, s - CLASSES * MEMBERS + CLASSES)
        got = _log_chance(_logits(weights.classes, _class_rows(size, one[part], two[part], three[part]), known.class_bias), cls)
        if often.any():
            c = cls[often]
            inner = _logits(weights.members, _member_rows(size, c, one[part][often], two[part][often]), known.member_bias[c])
            got[often] += _log_chance(inner, s[often] % MEMBERS)
        out[part] = got
    return out / np.log(10.0)


def train(docs: DataFrame, known: Vocabulary, text: str) -> Weights:
    """Rounds of distributed gradient updates; together they go over every training document once.

    In a round each task starts from the shared weights, goes over its documents and gives its changed weights
    times its tokens. These are summed block by block, in streams, and their mean is the next start. The sums of many
    tasks are made in two levels, so that no task reads more than about `_FAN_IN` pieces.
    """
    spark = docs.sparkSession
    rows = table_rows(known.tokens)
    blocks = _BLOCKS * rows // ROWS  # larger tables have more blocks, not larger ones
    shared, weights, begin = spark.sparkContext.broadcast(known), Weights.zero(rows), 0
    slices = F.pmod(F.xxhash64(text, F.lit("round")), F.lit(sum(ROUNDS)))
    for width in ROUNDS:
        start = spark.sparkContext.broadcast(weights)
        part = docs.filter((slices >= begin) & (slices < begin + width)).select(text)
        begin += width

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            own = Weights(start.value.classes.copy(), start.value.members.copy())
            seen = learn((t for b in batches for t in b.iloc[:, 0]), shared.value, own)
            if seen:
                flat = np.concatenate((own.classes.ravel(), own.members.ravel())).reshape(blocks, -1)
                for block, values in enumerate(flat):
                    yield pd.DataFrame({"block": [block], "team": TaskContext.get().partitionId(), "tokens": seen, "sums": [values.tobytes()]})

        def adder(kind: type, weighted: bool):
            def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
                sums: dict[tuple[int, int], list] = {}
                for batch in batches:
                    for block, team, tokens, values in batch.itertuples(index=False):
                        held = sums.setdefault((block, team), [0, 0.0])
                        held[0] += tokens
                        held[1] = held[1] + (tokens if weighted else 1.0) * np.frombuffer(values, kind).astype(np.float64)
                yield pd.DataFrame([(b, g, t, v.tobytes()) for (b, g), (t, v) in sums.items()], columns=["block", "team", "tokens", "sums"])

            return add

        parts = part.mapInPandas(run, _SUMS)
        teams = max(1, -(-part.rdd.getNumPartitions() // _FAN_IN))  # an empty table may have no partition
        parts = parts.withColumn("team", F.col("team") % teams).repartition(blocks * teams, "block", "team").mapInPandas(adder(np.float32, True), _SUMS)
        if teams > 1:
            parts = parts.withColumn("team", F.lit(0)).repartition(blocks, "block").mapInPandas(adder(np.float64, False), _SUMS)
        merged = parts.collect()
        if merged:
            flat = np.concatenate([(np.frombuffer(r["sums"], np.float64) / r["tokens"]).astype(np.float32) for r in sorted(merged, key=lambda r: r["block"])])
            cut = rows * (CLASSES + RARE)
            weights = Weights(flat[:cut].reshape(rows, -1), flat[cut:].reshape(rows, -1))
        start.unpersist()
    return weights


_BLOCKS, _FAN_IN = 16, 512  # blocks of tables of `ROWS` rows
_SUMS = "block int, team int, tokens long, sums binary"


def score(docs: DataFrame, training: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`(doc_id, n_tokens, n_known, train_tokens, base_score, score)` for every row of `docs`.

    `base_score` is the add-one unigram logarithm of the text over all counts of `training`; `score` is the model's
    decimal logarithm of its probability: class by context, then the member of a frequent class by context, or the word of a
    rare class by its add-one count there, unseen words together being one more word of their class. A null or empty text has
    the end token alone. Rows with a null id are kept, repeated rows get equal scores, other columns are not read; without
    training texts every base score is 0. An empty table gives no rows.

    Counts cover all training documents and all words. Workers hold the head words; every other word of a document is sent,
    once with its number, to its count, by the word. Those words are rare or longer than `LONGEST` bytes; a long word that
    much of the rows holds is a hot key of that join alone, which adaptive execution splits.
    """
    counts = settled(word_counts(training, text), "maxent-counts")
    known = vocabulary(counts)
    weights = train(training, known, text)
    spark = docs.sparkSession
    shared, trained = spark.sparkContext.broadcast(known), spark.sparkContext.broadcast(weights)

    @F.pandas_udf(_OUT)
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        v, w = shared.value, trained.value
        for texts in batches:
            rows = []
            for group in _batches(iter(texts), v, 8 * BATCH):
                symbols, at, starts = _symbols(group, v)
                inside = at >= 0
                log_count = np.where(inside, v.log_count[at] if len(v.log_count) else 0.0, 0.0)
                rare = symbols >= CLASSES * MEMBERS
                model = log_chances(symbols, starts, v, w) + np.where(rare, log_count, 0.0)
                model -= np.where(rare, v.rare_total[np.maximum(symbols - CLASSES * MEMBERS, 0)], 0.0)
                heads, bases, models = (np.add.reduceat(x, starts) for x in (inside.astype(np.int64), log_count, model))
                for words, start, h, b, m in zip(group, starts.tolist(), heads.tolist(), bases.tolist(), models.tolist()):
                    tail = Counter([words[i] for i in np.flatnonzero(~inside[start : start + len(words)]).tolist()])
                    rows.append((len(words), h, b, m, [{"word": k, "times": n} for k, n in tail.items()]))
            yield pd.DataFrame(rows, columns=[f.name for f in _OUT])

    judged = docs.select(F.col(doc_id).alias("doc_id"), text_hash(text).alias("_hash"), judge(text).alias("r"))
    slim = settled(judged.select("doc_id", "_hash", "r.*"), "maxent-read")
    # Rows alike in id and text send their words once each, so their sums are divided by their number.
    words = slim.select("doc_id", "_hash", F.inline("tail"))
    met = words.join(counts, "word").select("doc_id", "_hash", "times", (F.col("times") * F.log10(F.col("n") + 1)).alias("log"))
    sums = met.groupBy("doc_id", "_hash").agg(F.sum("times").alias("_known"), F.sum("log").alias("_log"))
    alike = slim.groupBy("doc_id", "_hash").agg(F.count("*").alias("_rows"))
    id_, hash_ = F.col("doc_id").alias("_id"), F.col("_hash").alias("_at")
    same = lambda other: slim["doc_id"].eqNullSafe(other["_id"]) & (slim["_hash"] == other["_at"])
    sums, alike = sums.select(id_, hash_, "_known", "_log"), alike.filter("_rows > 1").select(id_, hash_, "_rows")
    joined = slim.drop("tail").join(sums, same(sums), "left").drop("_id", "_at").join(alike, same(alike), "left")
    rows = F.coalesce("_rows", F.lit(1))
    tail_log, tail_known = F.coalesce("_log", F.lit(0.0)) / rows, F.coalesce("_known", F.lit(0)) / rows
    per_token = float(np.log10(known.tokens + known.distinct + 1))
    return joined.select(
        "doc_id", "n_tokens", (F.col("head_known") + tail_known).cast("long").alias("n_known"),
        F.lit(known.tokens).cast("long").alias("train_tokens"),
        (F.col("head_log") + tail_log - F.col("n_tokens") * F.lit(per_token)).alias("base_score"),
        (F.col("model_log") + tail_log).alias("score"),
    )


def op10_hashed_maxent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a model of those outside the held-out fold."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = id_remainder("doc_id", FOLDS) == HELD_OUT
    found = score(docs, docs.filter(~held_out))
    return found.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


QUERIES: dict[str, Query] = {"op10_hashed_maxent": op10_hashed_maxent}
SQL: dict[str, str] = {}
