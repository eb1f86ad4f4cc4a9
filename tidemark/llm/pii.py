"""Personal data: fixed patterns find seeds; the contexts of seeds, scored on a graph, find further identifiers."""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from itertools import count, takewhile

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import Query, dropped, settled, table, text_hash

# In the order in which spans with one start are listed; `secret` is a seed kind of the method.
KINDS = ("email", "ip", "card", "phone", "secret")
# A pattern is trusted with this confidence and so many different seeds or trusted instances.
CONFIDENCE, SUPPORT = 0.9, 5
# A word found by its context is given with this score.
LEAST = 0.5
REACH = 60  # characters before a span that belong to its pattern
SLOTS = 1 << 21  # of the tables by hash that workers look words up in
_SPAN = [T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("kind", T.StringType())]
_OUT = T.StructType([
    T.StructField("base", T.ArrayType(T.StructType(_SPAN))),
    T.StructField("seen", T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in ("kind", "pattern", "instance")]))),
])

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# A match can only begin where its run of digits does, so the look-behind changes nothing but the time.
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_SECRET = re.compile(r"(?=[0-9]*[a-f])(?=[a-f]*[0-9])[0-9a-f]{32,}")
_BLANKS = frozenset("\x20\t\n\x0b\x0c\r")
_SIGNS = frozenset("\"'`()[]{}<>.,;:!?#*$%&|=")
_STRIPPED = "".join(_SIGNS)
_CLOSING = frozenset("\"'`)]}>")
_WORD = re.compile(r"[^\x20\t\n\x0b\x0c\r]+")
_INSIDE = re.compile(r"[:=](?=[^\x20\t\n\x0b\x0c\r])")
_NUMBER = re.compile(r"\+?\(?[0-9]+([\x20().-]{1,2}[0-9]+)*")
_NUMERAL = re.compile(r"[0-9]+")
_HEX = re.compile(r"[0-9a-f]{32}")
_INNER = str.maketrans("", "", "'-\u2019")


def luhn(digits: str) -> bool:
    values = [ord(d) - 48 for d in reversed(digits)]
    return (sum(values[0::2]) + sum(2 * v - 9 * (v > 4) for v in values[1::2])) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost, non-overlapping; each `@` is looked at once, with the run of local characters before it."""
    floor, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            yield start, match.end()
            floor = match.end()
        at = text.find("@", max(at + 1, floor))


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """`(start, kind, end)` of the fixed patterns, by start, then kind as listed."""
    found = [(start, 0, end) for start, end in _emails(text)]
    if _DIGIT.search(text):
        for match in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in match.group().split(".")):
                found.append((match.start(), 1, match.end()))
        for match in _CARD.finditer(text):
            digits = match.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((match.start(), 2, match.end()))
        for match in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in match.group()) <= 15:
                found.append((match.start(), 3, match.end()))
    return [(start, KINDS[kind], end) for start, kind, end in sorted(found)]


def plain(instance: str) -> bool:
    """Whether a word looks like language, not like an identifier: short, or letters with inner hyphens and apostrophes alone."""
    return len(instance) < 6 or instance.translate(_INNER).isalpha()


def _pattern(text: str, start: int, end: int) -> str:
    """Lexical pattern around a span, whatever it holds: the two words before it and signs that touch it on either side.

    The words are those of the REACH characters before the signs: a word that begins farther off counts from there.
    """
    left = start
    while left and text[left - 1] in _SIGNS:
        left -= 1
    words = _NUMERAL.sub("0", text[max(0, left - REACH) : left].lower()).split()[-2:]
    right = text[end : end + 1]
    words.append(text[left:start] + "_" + (right if right in _CLOSING else ""))
    return " ".join(words)


def free_words(text: str, base: list[tuple[int, str, int]]) -> Iterator[tuple[int, int, str | None]]:
    """`(start, end, before)` of all words that touch no base span, without the signs around them; `before` is the word before if it is plain to see.

    Groups of digits that follow each other are one word, a parenthesis around the first of them included. What stands
    behind a colon or an equals sign inside a word is a word too.
    """
    taken = sorted((s, e) for s, _, e in base)
    behind, nth, last = 0, 0, -1

    def touched(start: int, end: int) -> bool:
        return any(s < end and start < e for s, e in takewhile(lambda span: span[0] < end, taken[nth:])) if nth < len(taken) else False

    word = ""
    for match in _WORD.finditer(text):
        at, stop = match.span()
        before, word = word, match.group()
        if at < behind:
            continue
        core = word if word.isalpha() else word.strip(_STRIPPED)
        if core.isalpha():  # touches no base span, which have other characters
            last = at + word.index(core)
            yield last, last + len(core), before
            continue
        starts = [at, *(m.end() for m in _INSIDE.finditer(text, at, stop))]
        for start in starts:
            end = stop
            number = _NUMBER.match(text, start)
            if not number or ")" not in number.group():
                while start < end and text[start] in _SIGNS:
                    start += 1
                number = _NUMBER.match(text, start) if start < end else None
            while nth < len(taken) and taken[nth][1] <= at:
                nth += 1
            if number and (number.end() == len(text) or text[number.end()] in _BLANKS or text[number.end()] in _SIGNS) and not touched(start, number.end()):
                end = number.end()
                behind = max(behind, end)
            else:
                while end > start and text[end - 1] in _SIGNS:
                    end -= 1
            if last < start < end and not touched(start, end):
                last = start
                yield start, end, None


def seeds(text: str, base: list[tuple[int, str, int]]) -> list[tuple[str, str, str]]:
    """`(kind, pattern, instance)` of base spans and of long hexadecimal words, whose kind is `secret`."""
    rows = [(kind, _pattern(text, s, e), text[s:e]) for s, kind, e in base]
    if _HEX.search(text):
        rows += [("secret", _pattern(text, s, e), text[s:e]) for s, e, _ in free_words(text, base) if _SECRET.fullmatch(text, s, e)]
    return rows


@F.pandas_udf(_OUT)
def _read(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for texts in batches:
        rows = []
        for text in texts:
            text = text or ""
            base = base_spans(text)
            rows.append((
                [{"start": s, "end": e, "kind": k} for s, k, e in base],
                [{"kind": k, "pattern": p, "instance": i} for k, p, i in seeds(text, base)],
            ))
        yield pd.DataFrame(rows, columns=["base", "seen"])


def _slot(text: str) -> int:
    return zlib.crc32(text.encode("utf-8", "surrogatepass")) & SLOTS - 1


def _limits(wanted: DataFrame, key: str) -> array:
    """Greatest limit plus one of the keys of each slot, from `(key, limit)`; 0 where there is none. Its size does not grow."""
    slot = F.crc32(F.col(key).cast("binary")).bitwiseAND(SLOTS - 1)
    found = wanted.groupBy(slot.alias("slot")).agg(F.least(F.max("limit"), F.lit(1 << 30)).alias("most")).toArrow()
    out = np.zeros(SLOTS, np.int32)
    out[found["slot"].to_numpy()] = found["most"].to_numpy() + 1
    return array("i", out.tobytes())


def _scan(docs: DataFrame, wanted: DataFrame, key: str, exempt: DataFrame | None = None) -> DataFrame:
    """`(_id, _hash, start, end, pattern, instance)` of all free words whose pattern, or instance, is in `wanted`.

    A key with more different partners in one task than its limit is given up: it has a row with a null partner and
    need not have its others. Partners in `exempt` do not count. The workers hold tables of fixed size by hash; a join
    sets right what shares a slot.
    """
    spark, by_pattern = docs.sparkSession, key == "pattern"
    limits = spark.sparkContext.broadcast(_limits(wanted, key))
    spared = spark.sparkContext.broadcast(_limits(exempt.select("instance", F.lit(0).alias("limit")), "instance") if exempt is not None else None)

    before = F.try_element_at(F.split("pattern", " "), F.lit(-2))
    words = spark.sparkContext.broadcast(_limits(wanted.select(before.alias("w"), F.lit(0).alias("limit")).filter("w IS NOT NULL"), "w") if by_pattern else None)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        limit, free, near, met = limits.value, spared.value, words.value, {}
        likely: dict[str, bool] = {}  # words seen before others, and whether a wanted pattern may end in them
        for batch in batches:
            rows = []
            for id_, hash_, text in batch.itertuples(index=False, name=None):
                text = text or ""
                for start, end, before in free_words(text, base_spans(text)):
                    if by_pattern and before:
                        may = likely.get(before)
                        if may is None:
                            if len(likely) > 200_000:
                                likely.clear()
                            ends = _NUMERAL.sub("0", before.lower()).split()[-1:]
                            may = likely[before] = len(before) > 25 or not ends or bool(near[_slot(ends[0])])
                        if not may:
                            continue
                    one = _pattern(text, start, end) if by_pattern else text[start:end]
                    most = limit[_slot(one)]
                    if not most:
                        continue
                    other = text[start:end] if by_pattern else _pattern(text, start, end)
                    partners = met.setdefault(one, set())
                    if partners is None:
                        continue
                    if free is None or not free[_slot(other)]:
                        if not by_pattern and other in partners:
                            continue
                        partners.add(other)
                        if len(partners) >= most:
                            met[one], other = None, None
                    rows.append((id_, hash_, start, end, *((one, other) if by_pattern else (other, one))))
            yield pd.DataFrame(rows, columns=["_id", "_hash", "start", "end", "pattern", "instance"])

    return settled(docs.mapInPandas(run, "_id string, _hash long, start int, end int, pattern string, instance string").join(wanted.select(key), key, "left_semi"), f"pii-{key}s")


def _trusted_patterns(pairs: DataFrame, scores: DataFrame) -> DataFrame:
    """`(pattern, kind, confidence)`: patterns whose instances are mostly of one kind, by the instances' scores."""
    sizes = pairs.groupBy("pattern").agg(F.count("*").alias("size"))
    hits = pairs.join(scores, "instance").groupBy("pattern", "kind").agg(F.sum("score").alias("hits"))
    rated = hits.join(sizes, "pattern").withColumn("confidence", F.col("hits") / F.col("size"))
    return rated.filter((F.col("hits") >= SUPPORT) & (F.col("confidence") >= CONFIDENCE)).select("pattern", "kind", "confidence")


def _scored(fresh: DataFrame, pairs: DataFrame) -> DataFrame:
    """`(instance, kind, score)` from `(instance, kind, confidence, n, plain)`, with n trusted patterns, and all patterns of the instances.

    An instance takes the best confidence. One that looks like language keeps the share of it that its trusted patterns
    are of all its patterns: a word that stands elsewhere too is no identifier. Scores under LEAST are left out.
    """
    sizes = pairs.groupBy("instance").agg(F.count("*").alias("all"))
    score = F.col("confidence") * F.when(F.col("plain"), F.col("n") / F.col("all")).otherwise(1.0)
    return fresh.join(sizes, "instance").select("instance", "kind", score.alias("score")).filter(F.col("score") >= LEAST)


@F.pandas_udf(T.BooleanType())
def _plain(instances: pd.Series) -> pd.Series:
    return instances.map(plain).astype(bool)


def bootstrap(docs: DataFrame, seen: DataFrame, rounds: int | None = None) -> DataFrame | None:
    """`(_id, _hash, start, end, kind)` of the words that the seeds' contexts lead to; None if they lead nowhere.

    `docs` has `_id` as a text, `_hash` and the text, `seen` the seeds `(kind, pattern, instance)`, of score 1. In each round a pattern's
    confidence is the share of its different instances that are trusted, weighed by their scores. Words in trusted patterns
    get scores; those of LEAST or more are given, and may make further patterns trusted. Each step is written before the next
    and removed at the end. Rounds go on until no pattern that is not trusted has gained an instance, or for `rounds` rounds at most.

    Only a pattern with SUPPORT trusted instances can be trusted, so the texts are gone over for such patterns alone and
    then for the words found, whose other patterns rate them and lead on. A pattern with too many other words for its
    confidence, and a plain word with too many patterns for its score, are given up as soon as a task sees that.
    """
    written: list[DataFrame] = []

    def kept(df: DataFrame) -> DataFrame:
        written.append(df)
        return df

    pairs = kept(settled(seen.select("pattern", "instance").distinct(), "pii-pairs"))
    scores = kept(settled(seen.groupBy("instance", "kind").agg(F.lit(1.0).alias("score")), "pii-scores"))
    trusted = found = last = spans = None
    for _ in count() if rounds is None else range(rounds):
        known = pairs.join(scores.select("instance").distinct(), "instance", "left_semi")
        support = kept(settled(known.groupBy("pattern").agg(F.count("*").alias("n")).filter(F.col("n") >= SUPPORT), "pii-support"))
        wanted = support
        if last is not None:  # what has gained nothing since it was looked at stays as it is
            wanted = wanted.join(last.select("pattern", F.col("n").alias("_n")), "pattern", "left").filter(F.coalesce("_n", F.lit(0)) < F.col("n"))
            wanted = wanted.join(trusted, "pattern", "left_anti")
        last = support
        wanted = kept(settled(wanted.select("pattern", (F.floor(F.col("n") * (1 / CONFIDENCE - 1)).cast("int") + 1).alias("limit")), "pii-wanted"))
        if not wanted.head(1):
            break
        rows = kept(_scan(docs, wanted, "pattern", scores))
        whole = wanted.join(rows.filter(F.col("instance").isNull()), "pattern", "left_anti").select("pattern")
        around = rows.select("pattern", "instance").union(pairs.select("pattern", "instance")).join(whole, "pattern", "left_semi").distinct()
        new = kept(settled(_trusted_patterns(around, scores), "pii-patterns"))
        if not new.head(1):
            break
        met = kept(settled(rows.join(new, "pattern"), "pii-found"))
        trusted, found = (new, met) if trusted is None else (trusted.unionByName(new), found.unionByName(met))
        best = found.groupBy("instance", "kind").agg(F.max("confidence").alias("confidence"), F.count_distinct("pattern").alias("n"))
        fresh = kept(settled(best.join(scores, ["instance", "kind"], "left_anti").withColumn("plain", _plain("instance")), "pii-fresh"))
        if not fresh.head(1):
            break
        most = F.when(F.col("plain"), F.floor(F.col("n") / LEAST).cast("int")).otherwise(1 << 30)
        rows = kept(_scan(docs, fresh.groupBy("instance").agg(F.max(most).alias("limit")), "instance"))
        given_up = rows.filter(F.col("pattern").isNull()).select("instance")
        others = kept(settled(rows.join(given_up, "instance", "left_anti").select("pattern", "instance").distinct(), "pii-pairs"))
        scores = kept(settled(scores.unionByName(_scored(fresh, others)), "pii-scores"))
        pairs = kept(settled(pairs.unionByName(others).distinct(), "pii-pairs"))
    if found is not None:
        placed = found.join(scores.select("instance", "kind"), ["instance", "kind"], "left_semi")
        best = placed.groupBy("_id", "_hash", "start", "end").agg(F.max(F.struct("confidence", "kind")).alias("b"))
        spans = settled(best.select("_id", "_hash", "start", "end", F.col("b.kind").alias("kind")), "pii-spans")
    for step in written:
        dropped(step)
    return spans


def _listed(spans: Column) -> Column:
    """`kind:start:end` of spans, by start, then kind as listed."""
    place = lambda s: F.array_position(F.array(*[F.lit(k) for k in KINDS]), s.kind)
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s.start.alias("start"), place(s).alias("place"), s.end.alias("end"), s.kind.alias("kind"))))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rounds: int | None = None) -> DataFrame:
    """`(doc_id, base, added)` for each row: spans `(start, end, kind)` in code points, end exclusive.

    `base` has the fixed patterns' spans: emails, addresses, payment cards and phone numbers. `added` has the
    words that a trusted pattern surrounds and that touch no base span. A null text is an empty one and
    has no spans. Repeated rows get equal spans; a null id stays null. Other columns are not read. An empty table gives no rows.

    The texts are read once for the spans and seeds, which are written as a slim table, and twice a round at most for the
    words around which the graph has grown; they are never moved. Rounds end when no pattern has gained an instance, or after `rounds`.
    """
    texts = docs.select(F.col(doc_id).alias("doc_id"), text_hash(text).alias("_hash"), F.col(text).alias("_text"))
    slim = settled(texts.select("doc_id", "_hash", _read("_text").alias("r")).select("doc_id", "_hash", "r.*"), "pii-read")
    spans = bootstrap(texts.select(F.col("doc_id").cast("string").alias("_id"), "_hash", "_text"), slim.select(F.inline("seen")), rounds)
    none = F.array().cast("array<struct<start:int, end:int, kind:string>>")
    if spans is None:
        return slim.select("doc_id", "base", none.alias("added"))
    added = spans.groupBy("_id", "_hash").agg(F.array_sort(F.collect_set(F.struct("start", "end", "kind"))).alias("added"))
    other = added.withColumnRenamed("_hash", "_at")
    same = slim["doc_id"].cast("string").eqNullSafe(other["_id"]) & (slim["_hash"] == other["_at"])
    return slim.join(other, same, "left").select("doc_id", "base", F.coalesce("added", none).alias("added"))


def op9_bootstrapped_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents."""
    found = find(table(spark, sf_dir, "documents"))
    number = lambda kind: F.size(F.filter("base", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *[number(kind) for kind in KINDS[:4]], F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
        _listed(F.concat("base", "added")).alias("spans"),
    )


QUERIES: dict[str, Query] = {"op9_bootstrapped_pii": op9_bootstrapped_pii}
SQL: dict[str, str] = {}
