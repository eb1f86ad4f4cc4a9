"""License phrases, notices and their edits."""

import re

import pytest
from pyspark.sql import functions as F

from tidemark.llm import licenses

MIT = dict((label, text) for label, text in licenses.NOTICES if text.startswith("Permission is hereby"))["mit"]
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def phrases(text):
    """Places of the base phrases, by looking at every word."""
    w = words(text)
    return sorted((i, label) for label, phrase in licenses.PHRASES for i in range(len(w)) if w[i : i + len(phrase.split())] == phrase.split())


@pytest.fixture(scope="module")
def scan(spark):
    def run(texts, **settings):
        df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        return [r.licenses for r in licenses.scan(df, **settings).orderBy("doc_id").collect()]

    return run


ODD = [
    None, "", " \n", "mit", "MIT License", "mit-license, MIT LICENSE; mit\nlicense", "GNU General Public", "the GNU General Public License and the Apache License",
    "cc by cc by cc", "Ｍit license", "mİt license", "mit licenses", "apache license " * 9_000, "x" * 100_000, "word " * 4_095 + "mit license", "word " * 4_096 + "cc by",
]


def test_base_is_that_of_a_look_at_every_word(scan):
    for text, r in zip(ODD, scan(ODD)):
        at = phrases(text)
        assert (r.n_words, r.n_base) == (len(words(text)), len(at)), text
        assert (r.first_word, r.last_word) == ((at[0][0], at[-1][0]) if at else (None, None))
        assert r.base_labels == ",".join(sorted({label for _, label in at}))
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0.0 <= r.score <= 1.0
        assert (r.score == 1.0) == bool(at) or r.labels


def test_notices_stand_edits_and_neighbours(scan):
    w = MIT.split()
    edited = " ".join("changed" if i in (10, 40, 70) else x for i, x in enumerate(w))
    inserted = " ".join(w[:30] + ["one", "two", "more"] + w[30:60] + w[62:])
    half = " ".join(w[: len(w) // 2])
    found = scan([MIT, f"before {MIT.lower()} after", edited, inserted, half, f"{MIT} {MIT}", "all about nothing in particular " * 40])
    assert [r.labels for r in found] == ["mit", "mit", "mit", "mit", "", "mit", ""]
    assert found[0].score == found[1].score == 1.0 and 0.9 < found[2].score < 1.0 and 0.9 < found[3].score < 1.0 and 0.4 < found[4].score < 0.6 and found[6].score == 0.0
    assert all(r.n_base == 0 for r in found)


def test_spans_tell_places(spark):
    text = "one two three " + MIT + " and then the mit license"
    found = licenses.spans(spark.createDataFrame([(1, text), (2, text)], "doc_id long, text string")).collect()
    assert sorted((r.label, r.base, r.first_word, r.n_words, r.score) for r in found if r.score == 1.0) == [
        ("mit", False, 3, len(words(MIT)), 1.0), ("mit", True, len(words(text)) - 2, 2, 1.0)]


def test_every_notice_finds_itself(scan):
    for (label, _), r in zip(licenses.NOTICES, scan([text for _, text in licenses.NOTICES])):
        assert label in r.labels.split(","), label


def test_own_templates(scan):
    mine = (licenses.Template("mine", "all rights reserved by nobody", True), licenses.Template("one", "word"))
    found = scan(["All rights reserved by nobody, word.", "mit license"], templates=mine)
    assert [(r.n_base, r.labels) for r in found] == [(1, "mine"), (0, "")]


def test_rows_and_names(spark):
    names = ("licenses", "_key", "_words", "_told", "text_key", "label", "score", "strange.name", "words", "hash", "at")
    df = spark.createDataFrame([(1, "mit license"), (1, "mit license"), (1, None), (None, "mit license"), (None, None)], "doc_id long, text string")
    rows = licenses.scan(df.select("*", *[F.lit("kept").alias(n) for n in names])).collect()
    assert sorted((r.doc_id is None, r.licenses.n_base) for r in rows) == [(False, 0), (False, 1), (False, 1), (True, 0), (True, 1)]
    assert all(r[n] == "kept" for r in rows for n in names if n != "licenses")
    assert licenses.scan(df.limit(0)).count() == 0
    none = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert [tuple(r.licenses) for r in licenses.scan(none).collect()] == [(0, 0, None, None, "", "", 0.0)] * 2
