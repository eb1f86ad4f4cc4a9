import pytest
from pyspark.sql import functions as F

from tidemark.operators import filters as L
from tidemark.operators import scopes as S
from tidemark.sources import payload

PATHS = ["100/a.md", "1001/b.md", "200\\c.md", "ABC/d.md", "abd", "099/e.md", ""]


@pytest.fixture
def paths(spark):
    return spark.createDataFrame([(p,) for p in PATHS], "path string")


def _kept(df):
    return sorted(r.path for r in df.collect())


def test_prefix_matches_longer_folder_names(paths):
    assert _kept(S.scope_filter(paths, agent="assistant")) == ["100/a.md", "1001/b.md"]
    assert _kept(S.scope_filter(paths, agent="shared")) == ["200\\c.md"]
    assert len(_kept(S.scope_filter(paths, agent="nobody", enforce=False))) == len(PATHS)


def test_rules_in_capitals_match(paths):
    assert _kept(S.scope_filter(paths, {"x": ["AB"]}, "x")) == ["ABC/d.md", "abd"]


@pytest.mark.parametrize("agent", ["a", "b", "c", "nobody"])
def test_table_and_mapping_agree(spark, paths, rows, agent, monkeypatch):
    rules = {"a": ["1", "Ab", "100"], "b": ["", "2"], "c": []}
    literal = S.scope_verdict(paths, rules, agent)
    table = S.scope_verdict(paths, S.scopes_table(spark, rules), agent)
    assert rows(literal) == rows(table)
    kept = _kept(S.scope_filter(paths, rules, agent))
    assert kept == _kept(S.scope_filter(paths, S.scopes_table(spark, rules), agent))
    monkeypatch.setattr(S, "MAX_LITERAL_PREFIXES", 1)
    assert kept == _kept(S.scope_filter(paths, rules, agent))


def test_verdict_reasons(paths):
    got = {r.path: (r.allowed, r.scope, r.reason) for r in S.scope_verdict(paths).collect()}
    assert got["1001/b.md"] == (True, "1001", None)
    assert got["099/e.md"] == (False, None, "path not allowed")
    assert S.scope_verdict(paths, agent="nobody").first().reason == "unknown agent"
    assert S.scope_verdict(paths, enforce=False).first().scope == "root"


def test_custom_scopes_replace_an_agents_defaults(spark, rows):
    defaults = S.scopes_table(spark, {"a": ["1", "2"], "b": ["3"]})
    custom = S.scopes_table(spark, {"a": ["9"], "c": ["7"]})
    assert rows(S.effective_scopes(defaults, custom)) == [("a", "9"), ("b", "3"), ("c", "7")]


def test_watched_folders_are_exact(paths):
    assert _kept(L.watched_filter(paths)) == ["100/a.md"]


def test_valid_paths(spark):
    good = ["a/b", "a/../b", "a/./b", "a//b", ".x"]
    bad = ["", "_x", "../a", "a/../../b", "/a", "\\a", "C:\\a", "a/../.."]
    df = spark.createDataFrame([(p,) for p in good + bad], "path string")
    assert _kept(L.valid_paths(df)) == sorted(good)


def test_key_stands_in_for_a_missing_path(spark):
    df = spark.createDataFrame([("k", None), ("_k", None), ("k", "_p")], "doc_id string, path string")
    assert [tuple(r) for r in L.valid_paths(df).collect()] == [("k", None)]


def test_ignored_paths(spark):
    keep = ["a/distance/b", "env", "a.tmp/b", "tmp"]
    drop = ["a/node_modules/b", "dist/a", "a/.git/b", "x.tmp", ".env", "a/.hidden", "build/x"]
    df = spark.createDataFrame([(p,) for p in keep + drop], "path string")
    assert _kept(L.ignore_filter(df)) == sorted(keep)


def test_binary_by_type_or_extension(spark):
    df = spark.createDataFrame(
        [("a.PNG", "plain"), ("a.md", "newnote"), ("a.md", None), ("png", "plain"), ("a.7z", "x")], "path string, type string"
    )
    assert [r.is_binary for r in L.with_is_binary(df).collect()] == [True, True, False, False, True]


def test_prefix_filter_is_case_sensitive(spark):
    df = spark.createDataFrame([("Ab",), ("ab",)], "path string")
    assert _kept(L.prefix_filter(df, "A")) == ["Ab"]


def test_tombstones(spark):
    df = spark.createDataFrame(
        [("a", "a", True), ("b", "b", None), ("c", "c", False), ("_d", "_d", True)], "doc_id string, path string, deleted boolean"
    )
    assert _kept(L.tombstones(df)) == ["a"]
    assert _kept(L.live_docs(df)) == ["b", "c"]


def test_read_file(spark):
    df = spark.createDataFrame([("100/a.md", "né"), ("100/a.png", "xx"), ("200/a.md", "s")], "path string, content string")
    df = df.withColumn("mtime", F.timestamp_millis(F.lit(1500)))
    text = L.read_file(df, "100/a.md").first()
    assert (text.content, text.size_bytes, text.modified_at) == ("né", 3, "1970-01-01T00:00:01.500Z")
    image = L.read_file(df, "100/a.png").first()
    assert (image.binary, image.content, image.size_bytes, image.modified_at) == (True, None, 2, None)
    assert L.read_file(df, "200/a.md").count() == 0


def test_payload_kinds(spark):
    df = spark.createDataFrame([("%=x",), ("%$x",), ("x%=",), ("%x",), ("",), (None,)], "data string")
    kinds = [r.payload_kind for r in payload.payload_kind(df).collect()]
    assert kinds == ["static", "ephemeral", "plain", "undecodable", "empty", "empty"]


def test_decode_payload(spark):
    df = spark.createDataFrame([("aGk=", True), ("aGk=", False), ("!", True)], "data string, is_binary boolean")
    assert [r.data for r in payload.decode_payload(df).collect()] == [b"hi", b"aGk=", None]
    assert payload.decode_payload(df.limit(1), encoding="base64").first().data == b"hi"
    with pytest.raises(ValueError):
        payload.decode_payload(df, encoding="hex")


def test_key_ring(spark):
    keys = [b"a" * 16, b"b" * 16, b"c" * 16]
    df = spark.createDataFrame([("secret",)], "data string")
    locked = payload.encrypt_col(df, "data", keys[1])
    assert payload.decrypt_col(locked, "data", keys[:2]).first().data == b"secret"
    assert payload.decrypt_col(locked, "data", [keys[0], keys[2], keys[0]]).first().data is None
    assert payload.decrypt_col(df.selectExpr("CAST(NULL AS BINARY) AS data"), "data", keys).first().data is None
    with pytest.raises(ValueError):
        payload.decrypt_col(locked, "data", [])
