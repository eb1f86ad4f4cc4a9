import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import merge as M
from tidemark.operators import merge_json as J
from tidemark.plans import pipelines

SIDES = "base string, local string, remote string"


def _text(spark, base, local, remote):
    r = M.merge_text(spark.createDataFrame([(base, local, remote)], SIDES)).first()
    return r.merged, r.has_conflicts


def test_disjoint_edits(spark):
    got = _text(spark, "line1\nline2\nline3", "line1\nmine\nline3", "line1\nline2\ntheirs")
    assert got == ("line1\nmine\ntheirs", False)


def test_same_line_is_a_marked_conflict(spark):
    got = _text(spark, "a\nb\nc", "a\nmine\nc", "a\ntheirs\nc")
    assert got == ("a\n<<<<<<< LOCAL\nmine\n=======\ntheirs\n>>>>>>> REMOTE\nc", True)


@pytest.mark.parametrize("other", ["x", "", "line1\nmore\n\n", "\n"])
def test_one_changed_side_wins_whole(spark, other):
    assert _text(spark, "line1\nline2", other, "line1\nline2") == (other, False)
    assert _text(spark, "line1\nline2", "line1\nline2", other) == (other, False)


def test_null_base_is_empty(spark):
    assert _text(spark, None, "a", "a") == ("a", False)
    assert _text(spark, None, "a", "b")[1] is True


def test_markers_inside_a_text_are_no_conflict(spark):
    marked = "<<<<<<< LOCAL\nx"
    assert _text(spark, "a", marked, marked) == (marked, False)


def _by_position(base, local, remote):
    """Line i of each side decides line i of the result; absent lines are blank."""
    if base == local:
        return remote, False
    if base == remote:
        return local, False
    sides = [t.split("\n") for t in (base, local, remote)]
    out, clash = [], False
    for i in range(max(len(sides[1]), len(sides[2]))):
        b, mine, theirs = (s[i] if i < len(s) else "" for s in sides)
        choice = {mine, theirs} - {b} if mine != theirs else {mine}
        if len(choice) == 1:
            out.append(choice.pop())
        else:
            clash = True
            out.append(f"<<<<<<< LOCAL\n{mine}\n=======\n{theirs}\n>>>>>>> REMOTE")
    return "\n".join(out), clash


def test_random_texts_against_a_plain_loop(spark):
    rng = random.Random(7)
    word = lambda: "\n".join(rng.choice(["", "a", "b", "cc"]) for _ in range(rng.randint(0, 6)))
    cases = [(i, word(), word(), word()) for i in range(400)]
    df = spark.createDataFrame(cases, "i int, " + SIDES)
    got = {r.i: (r.merged, r.has_conflicts) for r in M.merge_text(df).collect()}
    want = {i: _by_position(b, l, r) for i, b, l, r in cases}
    assert got == want
    assert 20 < sum(c for _, c in want.values()) < 400


def _fm(title, body, extra=""):
    return f"---\ntitle: {title}\n{extra}---\n{body}"


def _markdown(spark, base, local, remote):
    r = M.merge_markdown(spark.createDataFrame([(base, local, remote)], SIDES)).first()
    return r.merged, r.has_conflicts


def test_title_from_remote_and_body_from_local(spark):
    base = _fm("Doc", "\nContent here")
    got = _markdown(spark, base, _fm("Doc", "\nContent here, mine"), _fm("Theirs", "\nContent here"))
    # The body keeps its own blank line after the one that the rendering adds.
    assert got == ("---\ntitle: Theirs\n---\n\n\nContent here, mine", False)


def test_front_matter_rules(spark):
    base = _fm("B", "x", "dropped: 1\n")
    local = _fm("L", "x", "mine: a:b: c\nno colon\n: empty\n mine :  last\t\n")
    remote = _fm("R", "x", "theirs: 2\n10: n\n2: m\n")
    merged, conflict = _markdown(spark, base, local, remote)
    assert merged == "---\n2: m\n10: n\ntitle: L\ndropped: 1\nmine: last\ntheirs: 2\n---\n\nx"
    assert conflict is False


@pytest.mark.parametrize(
    "text,front,body",
    [
        ("---\na: b\n---\nx", {"a": "b"}, "x"),
        ("---\n\n---\n", {}, ""),
        ("---\n---\nx", {}, "---\n---\nx"),
        ("---\n---\n---\nx", {}, "x"),
        ("x\n---\na: b\n---\n", {}, "x\n---\na: b\n---\n"),
        ("---\na: b\n---", {}, "---\na: b\n---"),
        ("---\na: b: c\n---\n---\n", {"a": "b: c"}, "---\n"),
    ],
)
def test_front_matter_extraction(spark, text, front, body):
    df = spark.createDataFrame([("p", text)], "path string, content string")
    r = M.extract_frontmatter(df).first()
    assert ({e.key: e.value for e in r.front_matter}, r.body) == (front, body)
    assert {r.key: r.value for r in M.frontmatter_rows(df).collect()} == front


def _json(spark, local, remote, base=None, prefer_remote=False):
    texts = [None if v is None else v if isinstance(v, str) else json.dumps(v) for v in (base, local, remote)]
    r = J.merge_json(spark.createDataFrame([tuple(texts)], SIDES), prefer_remote).first()
    return r.merged and json.loads(r.merged), r.conflicts


def test_json_two_way(spark):
    merged, conflicts = _json(spark, {"a": 1, "b": 2, "list": ["x", "y"]}, {"a": 1, "b": 3, "list": ["x", "z"]})
    assert merged == {"a": 1, "b": 2, "list": ["x", "y", "z"]}
    assert conflicts == ["b: local=2, remote=3"]


def test_json_prefer_remote(spark):
    assert _json(spark, {"x": 1}, {"x": 2}, prefer_remote=True)[0] == {"x": 2}


def test_json_with_base(spark):
    got = _json(
        spark, {"a": 1, "b": 9, "c": 8, "o": {"p": 1, "q": 5}}, {"a": 7, "b": 2, "c": 9, "o": {"p": 2, "q": 5}, "n": None},
        {"a": 1, "b": 2, "c": 3, "o": {"p": 1}},
    )
    assert got == (
        {"a": 7, "b": 9, "c": 8, "o": {"p": 2, "q": 5}, "n": None}, ["c: local=8, remote=9, base=3"]
    )


def test_json_kinds(spark):
    assert _json(spark, '{"a": 1}', '{"a": 1.0}') == ({"a": 1}, [])
    assert _json(spark, {"a": True}, {"a": 1})[1] == ["a: local=true, remote=1"]
    assert _json(spark, {"a": [1, [2, None]]}, {"a": {"b": 1}})[1] == ["a: local=1,2,, remote=[object Object]"]
    assert _json(spark, {"a": None}, {"a": {}})[1] == ["a: local=null, remote=[object Object]"]
    assert _json(spark, {"a": [1, 1]}, {"a": [2, 2, 1]})[0] == {"a": [1, 1, 2]}
    assert _json(spark, {"o": {"k": "x"}}, {"o": {"k": "y"}})[1] == ["o.k: local=x, remote=y"]


def test_json_rendering(spark):
    df = spark.createDataFrame([(None, '{"b":[],"10":{},"2":[{"x":1.50}]}', '{"é":"\\n"}')], SIDES)
    assert J.merge_json(df).first().merged == (
        '{\n  "2": [\n    {\n      "x": 1.5\n    }\n  ],\n  "10": {},\n  "b": [],\n  "é": "\\n"\n}'
    )


def test_json_that_does_not_parse(spark):
    assert _json(spark, "{", "{}") == (None, [])
    assert _json(spark, "null", '{"a": 1}') == (None, [])
    assert _json(spark, "5", "{}") == ({}, [])


def test_routing(spark):
    rows = [
        ("a.md", _fm("B", "x"), _fm("B", "y"), _fm("R", "x")),
        ("a.json", None, '{"a":1}', '{"b":2}'),
        ("b.json", "l1", "l1\nl2", "l1"),
        ("c.JSON", "{}", '{"a":1}', '{"b":2}'),
        ("d.txt", "a", "b", "c"),
    ]
    got = {r.path: (r.merged, r.has_conflicts) for r in M.merge_conflicts(spark.createDataFrame(rows, "path string, " + SIDES)).collect()}
    assert got["a.md"] == ("---\ntitle: R\n---\n\ny", False)
    assert got["a.json"] == ('{\n  "a": 1,\n  "b": 2\n}', False)
    assert got["b.json"] == ("l1\nl2", False)
    assert got["c.JSON"][1] is True and got["d.txt"][1] is True


def test_leaf_rows_agree_with_the_document_merge(spark):
    rng = random.Random(3)

    def doc(depth):
        return {
            rng.choice("abcd"): rng.choice([1, 2, "x", None, True, [1], [2, "y"]]) if depth == 0 or rng.random() < 0.6 else doc(depth - 1)
            for _ in range(rng.randint(0, 4))
        }

    cases = [(i, json.dumps(doc(2)), json.dumps(doc(2))) for i in range(120)]
    df = spark.createDataFrame(cases, "id int, local string, remote string")
    leaves = J.merge_json_leaves(J.json_leaves(df, "id", "local"), J.json_leaves(df, "id", "remote"), "id")
    clashes = {(r.id, r.json_path) for r in leaves.filter("conflict").collect()}
    noted = {
        (r.id, c.split(":")[0]) for r in J.merge_json(df).select("id", "conflicts").collect() for c in r.conflicts
    }
    # A field that is an object on one side only has no leaf of its own there.
    mixed = {n for n in noted - clashes}
    assert clashes <= noted
    texts = {c[0]: (json.loads(c[1]), json.loads(c[2])) for c in cases}

    def at(value, path):
        for step in path.split("."):
            value = value[step]
        return value

    assert all(isinstance(at(texts[i][0], p), dict) != isinstance(at(texts[i][1], p), dict) for i, p in mixed)


def test_sync_with_merge_outcomes(spark):
    def side(rows, schema):
        return spark.createDataFrame(rows, schema).withColumn("mtime", F.timestamp_millis("ms")).drop("ms")

    local = side(
        [("new", "new", "n", 1), ("same", "same", "s", 1), ("clean", "clean", "A\nb", 1), ("mine", "mine", "X", 9), ("theirs", "theirs", "X", 1)],
        "doc_id string, path string, content string, ms long",
    )
    remote = side(
        [("same", "s", 5, 4), ("clean", "a\nB", 5, 4), ("mine", "Y", 5, 4), ("theirs", "Y", 5, 4)],
        "doc_id string, content string, ms long, version int",
    )
    base = spark.createDataFrame([("clean", "a\nb")], "doc_id string, content string")
    got = {r.doc_id: r for r in pipelines.sync_with_merge(local, remote, base).collect()}
    assert {k: (r.outcome, r.content, r.version, [v.version for v in r.versions]) for k, r in got.items()} == {
        "new": ("new", None, 1, []), "same": ("unchanged", None, 5, []), "clean": ("merged", "A\nB", 5, [4]),
        "mine": ("local", None, 5, [4]), "theirs": ("remote", "Y", 4, []),
    }
    for name, text in {"new": "n", "mine": "X", "theirs": "Y", "clean": "A\nB"}.items():
        digest = hashlib.sha256(text.encode()).hexdigest()
        assert (got[name].hash, got[name].size, got[name].children) == (digest, len(text), [digest])
    plain = {r.doc_id: r.outcome for r in pipelines.sync_with_merge(local, remote, base, "keep-both", auto_merge=False).collect()}
    assert plain == {"new": "new", "same": "unchanged", "clean": "both", "mine": "both", "theirs": "both"}


_PAIRS = [
    (1, '{"a.b":1,"a":{"b":2,"c":null},"t":[1,{"x":1}],"":{"":1}}', '{"a":{"b":2.0,"c":1},"t":[{"x":1},3],"a.b":"1"}'),
    (2, '{"a":{"b":{"c":1}},"x":{}}', '{"a":5,"x":{"y":true}}'),
    (3, '{"a":[1]}', '{"a":{"b":{"c":{"d":"}{"}}}}'),
    (4, "no json", '{"a":1}'), (5, '{"a":1}', None), (6, "[1]", '"text"'), (7, None, None), (8, "{}", "{}"),
    (9, '{"a":{"b":1}}', '{"a":{"b":"1"}}'), (10, '{"q":"a\\\\","r":{"s":"\\"{{{"}}', '{"q":"a","r":{"s":1}}'),
]


def _plain_leaves(value, at=None):
    for key, inner in value.items():
        step = key.replace("\\", "\\\\").replace(".", "\\.")
        path = step if at is None else f"{at}.{step}"
        if isinstance(inner, dict):
            yield from _plain_leaves(inner, path)
        else:
            yield path


def test_leaves_are_those_of_a_plain_walk_and_kinds_are_read_once(spark):
    df = spark.createDataFrame(_PAIRS, "id int, local string, remote string")
    for side, at in (("local", 1), ("remote", 2)):
        want = []
        for row in _PAIRS:
            try:
                value = json.loads(row[at] or "")
            except ValueError:
                continue
            want += [(row[0], path) for path in _plain_leaves(value)] if isinstance(value, dict) else []
        found = J.json_leaves(df, "id", side)
        assert sorted((r.id, r.json_path) for r in found.collect()) == sorted(want)
        assert {r.kind for r in found.collect()} <= {"string", "number", "boolean", "null", "array"}
        assert "schema_of_variant(value" not in found._jdf.queryExecution().analyzed().toString()
    whole = J.json_leaves(df, "id", "remote", 1).filter("id = 2").collect()
    assert sorted((r.json_path, r.kind) for r in whole) == [("a", "number"), ("x", "object")]


def test_depth_of_long_strings(spark):
    long = '{"a":"' + '\\\\\\"{' * 40_000 + '","b":{"c":{}}}'
    df = spark.createDataFrame([(1, long, '{"a":1}')], "id int, local string, remote string")
    assert J.json_depth(df, "local") == 3 and J.json_depth(df, "remote") == 1 and J.json_depth(df, "local", "remote") == 3


def test_a_row_needs_no_decoder_of_its_own(monkeypatch):
    def refused(*args, **settings):
        raise AssertionError("a decoder for one row")

    monkeypatch.setattr(json, "JSONDecoder", refused)
    local, remote = '{"b":"\\u2028\\"","10":1,"9":{"x":1e30},"n":1.0}', '{"n":1,"9":{"y":null,"x":1},"new":[true]}'
    text, log = J._merge_pair(local, remote, None, True)
    assert text.index('"9"') < text.index('"10"') < text.index('"b"') < text.index('"new"')
    assert log == ["9.x: local=1e+30, remote=1"]
