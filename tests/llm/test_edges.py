"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing names for every operator."""

import zlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tidemark.llm import cascade, decontaminate, maxent, mixing, pii, shards, simhash, toxicity, warc, wavelet
from tidemark.session import work_dir

LONG = "word other " * 30_000
CLASHES = (
    "_group", "_tie", "_at", "_piece", "mix_source", "mix_steps", "mix_at", "_found", "_contamination", "_toxicity",
    "_kept_id", "_kept_hash", "node", "root", "fp", "_hash", "_id", "tail", "word", "strange.name",
)
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def odd(spark):
    rows = [
        (1, "a quiet text about nothing in particular", "en", "a", 1),
        (1, "a quiet text about nothing in particular", "en", "a", 1),
        (1, "another text with the same number", "en", None, None),
        (2, None, None, "b", None),
        (3, "", "en", "b", 0),
        (4, " \n\t ", "en", "b", 0),
        (None, "a text without a number", None, None, None),
        (None, "a text without a number", None, None, None),
        (None, None, None, None, None),
        (5, LONG, "en", "a", len(LONG)),
        (6, "x" * 200_000, "en", "a", 200_000),
        (7, "İstanbul ΑΣ 😀 ́a \x00 <|endoftext|>", "tr", "a", 7),
        (-8, "negative number", "en", "a", 7),
    ]
    return spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit("kept").alias(c) for c in CLASHES])


@pytest.fixture(scope="module")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, "nothing in particular"), (2, None), (3, ""), (None, "without a number")], "item_id long, text string")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 0, 1), (2, 1, 0), (None, 1, 1), (9, 0, None)], "doc_id long, quality int, toxic int")


def test_shards(odd, none):
    rows = shards.shard(odd, shards=4).collect()
    assert len(rows) == odd.count() and all(r["_group"] == "kept" and r["strange.name"] == "kept" for r in rows)
    for s in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
    nulls = [r for r in rows if r.text is None]
    assert {(r.size, r.text_crc32, r.law, r.grown_shard) for r in nulls} == {(16, 0, "bytes", None)}
    assert shards.shard(none).count() == 0


def test_clashing_result_columns_are_replaced(odd):
    rows = shards.shard(odd.withColumn("slot", F.lit("mine")).withColumn("shard", F.lit("mine")), shards=2)
    assert dict(rows.dtypes)["slot"] == "bigint" and dict(rows.dtypes)["shard"] == "int"
    mixed = mixing.mixed(odd.withColumn("copy", F.lit("mine")))
    assert set(mixed.columns) == {*odd.columns, "copy"} and {r.copy for r in mixed.select("copy").collect()} <= {"mine"}


def test_mix(odd, none):
    rows = mixing.mix(odd).collect()
    assert all(r["mix_source"] == "kept" and 1 <= r.copy <= r.n_copies for r in rows)
    assert [r.mix_key for r in rows] == sorted(r.mix_key for r in rows)
    assert mixing.mix(none).count() == 0
    again = mixing.mix(odd.repartition(3)).collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, again))


def test_cascade(odd, none):
    rows = cascade.verdicts(odd).select("text", "quality.*").collect()
    assert len(rows) == odd.count()
    empty = [r for r in rows if not (r.text or "").strip()]
    assert empty and all(r.n_words == 0 and r.word_chars == 0 and r.base_failed and not r.kept and r.rejected_by == "base" for r in empty)
    assert cascade.verdicts(none).count() == 0


def test_wavelet(spark, odd, none):
    path = public_tokenizers.path(wavelet.TOKENIZER)
    rows = wavelet.read(wavelet.write(odd, work_dir(spark, "t"), path, shard_tokens=50)).orderBy("start").collect()
    assert len(rows) == odd.count() and rows[0].start == 0
    assert all(a.start + a.n_tokens == b.start for a, b in zip(rows, rows[1:]))
    assert [r.doc_id for r in rows] == sorted((r.doc_id for r in rows), key=lambda x: (x is not None, x or 0))
    end = zlib.crc32((1).to_bytes(4, "little"))
    assert sum(r.ids_crc32 == end and r.n_tokens == 1 for r in rows) == 4  # two nulls, an empty and a blank text
    assert wavelet.read(wavelet.write(none, work_dir(spark, "t"), path)).count() == 0


def test_simhash(odd, none):
    rows = simhash.groups(odd).collect()
    assert len(rows) == odd.count()
    zero = [r for r in rows if r.fingerprint == 0]
    assert len(zero) == 4 and {r.component_id for r in zero} == {2}
    assert {r.component_id for r in rows if r.doc_id is None and r.fingerprint} == {None}
    kept = simhash.dedupe(odd).collect()
    assert len(kept) == len({r.root for r in rows}) and all(r["_kept_id"] == "kept" for r in kept)
    assert simhash.groups(none).count() == 0 and simhash.dedupe(none).count() == 0


def test_decontaminate(spark, odd, none, benchmark):
    rows = decontaminate.judge(odd, benchmark).collect()
    assert len(rows) == odd.count() and all(r["_found"] == "kept" for r in rows)
    met = {r.text: (r.contamination["items"], r.contamination.contaminated) for r in rows}
    assert met["a quiet text about nothing in particular"] == (["1"], True)
    assert met["a text without a number"] == (["null"], True)
    assert met[None] == ([], False) and met[""] == ([], False)
    left = decontaminate.decontaminate(odd, benchmark)
    assert left.columns == odd.columns and left.count() == odd.count() - 4
    assert decontaminate.judge(none, benchmark).count() == 0
    assert decontaminate.judge(odd, benchmark.limit(0)).filter("contamination.contaminated").count() == 0
    parts = decontaminate.judge(odd, benchmark, block_words=1).collect()
    assert sorted(map(repr, parts)) == sorted(map(repr, rows))


def test_toxicity(odd, none, labels):
    for marks in (labels, labels.limit(0)):
        scorer = toxicity.train(odd, marks)
        rows = toxicity.scored(odd, scorer).collect()
        assert len(rows) == odd.count() and all(0.0 <= r.toxicity.score <= 1.0 for r in rows)
        assert toxicity.scored(none, scorer).count() == 0
    assert toxicity.without_toxic(odd, scorer).columns == odd.columns


def test_warc(spark, none):
    pages = spark.createDataFrame(
        [(1, "http://a/%41 b\r\nc", "same"), (2, None, "same"), (2, "http://b", "same"), (3, "http://c", None), (4, "http://d", ""),
         (None, "http://e", "x"), (None, "http://f", "x"), (5, "http://g", "ü" * 100_000)],
        "page_id long, url string, html string",
    ).select("*", *[F.lit("kept").alias(c) for c in CLASHES])
    rows = warc.read(warc.write(pages, work_dir(spark, "t"))).collect()
    found = sorted(((r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in rows), key=repr)
    assert found == sorted([
        (1, "revisit", 2, 4), (2, "response", None, 4), (2, "revisit", 2, 4), (3, "revisit", 4, 0), (4, "response", None, 0),
        (None, "response", None, 1), (None, "revisit", None, 1), (5, "response", None, 200_000)], key=repr)
    assert {r.url for r in rows if r.page_id == 1} == {"http://a/%41 b\r\nc"}
    assert warc.read(warc.write(pages.limit(0), work_dir(spark, "t"))).count() == 0


def test_pii(odd, none):
    rows = pii.find(odd).collect()
    assert len(rows) == odd.count() and all(r.base == [] and r.added == [] for r in rows)
    assert pii.find(none).count() == 0


def test_pii_repeats_null_ids_and_ties(spark):
    rows = [*[(i, f"call me at +1 (212) 555-02{i} today") for i in range(10, 70)], *[(None, "call me at (212) 555-0199 now")] * 2, (7, "a@b.de, a@b.de"), (7, "a@b.de, a@b.de"), (7, None)]
    found = pii.find(spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, base string, _hash int")).collect()
    assert len(found) == len(rows)
    assert [[tuple(s) for s in r.added] for r in found if r.doc_id is None] == [[(11, 25, "phone")]] * 2
    assert sorted([tuple(s) for s in r.base] for r in found if r.doc_id == 7) == [[], *[[(0, 6, "email"), (8, 14, "email")]] * 2]


def test_maxent(odd, none):
    rows = maxent.score(odd, odd).collect()
    assert len(rows) == odd.count() and all(r.score < 0 and r.base_score < 0 for r in rows)
    assert {r.n_tokens for r in rows} >= {1, 8, 60_001}
    twice = [r for r in rows if r.n_tokens == 8 and r.doc_id == 1]
    assert len(twice) == 2 and twice[0] == twice[1] and twice[0].n_known == 8
    blind = maxent.score(odd, none).collect()
    assert all(r.base_score == 0.0 and r.n_known == 0 and r.train_tokens == 0 for r in blind)
    assert maxent.score(none, odd).count() == 0


def test_identical_rows_spread_over_shards(spark):
    same = spark.range(60_000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("the same row").alias("text"), F.lit("x").alias("_number"))
    found = shards.shard(same, shards=8)
    counts = {r["shard"]: (r["count"], r["slots"], r["last"]) for r in found.groupBy("shard").agg(
        F.count("*").alias("count"), F.count_distinct("slot").alias("slots"), F.max("slot").alias("last")).collect()}
    assert len(counts) == 8 and all(abs(n - 7_500) < 375 and slots == n and last == n - 1 for n, slots, last in counts.values())
    assert found.columns == ["doc_id", "text", "_number", *shards.COLUMNS]


def test_the_same_repeat_stays_under_any_partitioning(spark):
    rows = spark.createDataFrame([(1, "some text of words", tag, {tag: 1}) for tag in "dbca"], "doc_id long, text string, tag string, more map<string, int>")
    kept = {tuple(simhash.dedupe(rows.repartition(n, *by)).select("doc_id", "tag").collect()[0]) for n, by in ((1, ()), (3, ("tag",)), (4, ()))}
    assert kept == {(1, "a")}
