import hashlib

import pytest
from pyspark.sql import functions as F

from tidemark.operators import chunks as C
from tidemark.session import work_dir
from tidemark.sources import sinks

FILES = "doc_id string, path string, children array<string>, size bigint, data binary"


def _raw(spark):
    return spark.createDataFrame(
        [("empty", b""), ("exact", b"abcd"), ("over", b"abcde"), ("twice", b"abcdabcd")], "doc_id string, content binary"
    )


def test_split_boundaries(spark, rows):
    assert rows(C.chunk_files(_raw(spark), 4)) == [
        ("empty", 0, b""), ("exact", 0, b"abcd"), ("over", 0, b"abcd"), ("over", 1, b"e"), ("twice", 0, b"abcd"),
        ("twice", 1, b"abcd"),
    ]


def test_empty_file_can_give_no_chunk(spark):
    assert C.chunk_files(_raw(spark), 4, empty="none").filter("doc_id = 'empty'").count() == 0
    with pytest.raises(ValueError):
        C.chunk_files(_raw(spark), 4, empty="some")
    with pytest.raises(ValueError):
        C.chunk_files(_raw(spark), 0)


def test_chunk_ids(spark):
    made = C.with_chunk_id(C.chunk_files(_raw(spark), 4)).collect()
    assert all(r.chunk_id == hashlib.sha256(r.data).hexdigest() for r in made)
    short = C.with_chunk_id(C.chunk_files(_raw(spark), 4), algo="xxh64").collect()
    assert all(r.chunk_id.startswith("h:+") for r in short)
    assert len({r.chunk_id for r in short}) == len({r.data for r in short})
    with pytest.raises(ValueError):
        C.with_chunk_id(_raw(spark), algo="md5", data="content")


def test_children_match_the_listing_made_in_place(spark, rows):
    pieces = C.with_chunk_id(C.chunk_files(_raw(spark), 4))
    listed = C.children(pieces)
    in_place = _raw(spark).select("doc_id", C.child_ids(F.col("content"), 4).alias("children"))
    assert rows(listed) == rows(in_place)
    none = _raw(spark).select("doc_id", C.child_ids(F.col("content"), 4, empty="none").alias("children"))
    assert none.filter("doc_id = 'empty'").first().children == []


def test_new_chunks_are_idempotent(spark):
    pieces = C.with_chunk_id(C.chunk_files(_raw(spark), 4))
    store = pieces.limit(0)
    first = C.new_chunks(pieces, store)
    assert first.count() == 3
    assert C.new_chunks(pieces, first).count() == 0
    held = C.bucketed(first.filter("data = X'65'"))
    assert C.new_chunks(pieces, held).count() == 2


def test_store_totals(spark):
    total = C.store_totals(C.with_chunk_id(C.chunk_files(_raw(spark), 4))).first()
    assert total.asDict() == {
        "chunks": 6, "distinct_chunks": 3, "bytes": 17, "distinct_bytes": 5, "saved_bytes": 12
    }
    assert C.store_totals(C.with_chunk_id(C.chunk_files(_raw(spark).limit(0), 4))).first().chunks == 0


def test_sync_totals_count_what_the_store_lacks(spark, rows):
    pieces = C.with_chunk_id(C.chunk_files(_raw(spark), 4))
    store = pieces.filter("data = X'61626364'")
    assert rows(C.sync_totals(pieces, store)) == [
        ("empty", 1, 0, 1), ("exact", 1, 4, 0), ("over", 2, 5, 1), ("twice", 2, 8, 0)
    ]


def _store(spark):
    return spark.createDataFrame([("a", b"AA"), ("b", b"BB"), ("e", b"")], "chunk_id string, data binary")


def _files(spark):
    return spark.createDataFrame(
        [
            ("whole", "whole", ["a", "b", "a"], 6, None),
            ("part", "part", ["a", "x", "b"], 6, b"inline"),
            ("lost", "lost", ["x", "y"], 4, b"inline"),
            ("blank", "blank", ["e"], 0, None),
            ("inline", "inline", [], 6, b"inline"),
            ("void", "void", [], 0, None),
            ("nothing", "nothing", None, 5, None),
        ],
        FILES,
    )


def _by_id(df):
    return {r.doc_id: (bytes(r.content), r.missing_chunks) for r in df.collect()}


def test_reassemble(spark):
    assert _by_id(C.reassemble(_files(spark), _store(spark))) == {
        "whole": (b"AABBAA", 0), "part": (b"AABB", 1), "blank": (b"", 0), "inline": (b"inline", 0), "void": (b"", 0)
    }


def test_reassemble_options(spark):
    files, store = _files(spark), _store(spark)
    assert "part" not in _by_id(C.reassemble(files, store, strict=True))
    assert "void" not in _by_id(C.reassemble(files, store, empty_ok=False))
    feed = _by_id(C.reassemble(files, store, inline="unresolved"))
    assert feed["lost"] == (b"inline", 2) and feed["part"] == (b"AABB", 1)
    assert _by_id(C.reassemble(files, C.bucketed(store))) == _by_id(C.reassemble(files, store))


def test_round_trip_of_every_length(spark):
    raw = spark.createDataFrame([(f"f{n}", f"f{n}", bytes(range(n))) for n in range(20)], "path string, p string, content binary")
    docs = C.file_documents(raw.withColumn("mtime", F.timestamp_seconds(F.lit(0))), 3)
    pieces = C.with_chunk_id(C.chunk_files(raw, 3, key="path")).dropDuplicates(["chunk_id"])
    back = {r.doc_id: bytes(r.content) for r in C.reassemble(docs, pieces).collect()}
    assert back == {f"f{n}": bytes(range(n)) for n in range(20)}


@pytest.fixture(scope="module")
def big_store(spark):
    """Four thousand chunks in sixteen folders, in row groups of a few each."""
    path = work_dir(spark, "store")
    rows = spark.range(4_000).select(F.concat(F.lit("x"), F.col("id").cast("string"), F.repeat(F.lit("y"), 2_000)).cast("binary").alias("data"))
    kept, sinks.ROW_GROUP_BYTES = sinks.ROW_GROUP_BYTES, 1 << 14
    try:
        sinks.write_chunks(C.with_chunk_id(rows), path, digits=1)
    finally:
        sinks.ROW_GROUP_BYTES = kept
    return sinks.read_chunks(spark, path)


def _scanned(df):
    """Rows that the scans of an executed plan gave out."""
    df._jdf.queryExecution().executedPlan().execute().count()
    leaves, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        below = node.children()
        todo += [below.apply(i) for i in range(below.size())]
        if node.nodeName().startswith("Scan parquet"):
            leaves.append(node.metrics().apply("numOutputRows").value())
    return sum(leaves)


def test_fetch_reads_what_is_wanted(spark, big_store):
    all_ids = sorted(r[0] for r in big_store.select("chunk_id").collect())
    wanted = spark.createDataFrame([(i,) for i in (*all_ids[:3], all_ids[7], all_ids[7], "absent", None)], "chunk_id string")
    few = C.fetch(big_store, wanted, digits=1)
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and "In(chunk_id" in plan
    assert sorted(r.chunk_id for r in few.collect()) == [*all_ids[:3], all_ids[7]]
    assert 4 <= _scanned(few) < 1_000
    assert C.fetch(big_store, wanted.limit(0), digits=1).count() == 0
    assert C.fetch(big_store.drop("bucket"), wanted).count() == 4


@pytest.mark.parametrize("most,groups", [(500_000, 32), (700, 32), (700, 2), (10, 32)])
def test_fetch_of_many_moves_no_bytes_before_it_knows(spark, big_store, monkeypatch, most, groups):
    monkeypatch.setattr(C, "MAX_LISTED_IDS", 50)
    monkeypatch.setattr(C, "MAX_BROADCAST_IDS", most)
    monkeypatch.setattr(C, "MAX_GROUPS", groups)
    wanted = big_store.select("chunk_id").filter("chunk_id < '8'").unionByName(spark.createDataFrame([("absent",)], "chunk_id string"))
    found = C.fetch(big_store, wanted, digits=1)
    assert found.columns == big_store.columns and found.count() == found.distinct().count() == wanted.count() - 1
    if most >= 700 and groups == 32:
        lines = found._jdf.queryExecution().executedPlan().toString().split("\n")
        assert not any("data#" in lines[i + 1] for i, line in enumerate(lines) if "Exchange" in line)


def test_fetch_sends_few_ids_through_the_driver(spark, big_store, monkeypatch):
    assert C.MAX_BROADCAST_IDS * C.MAX_GROUPS * 80 <= 16 << 20  # bytes of ids that one fetch may broadcast
    scale = C.MAX_BROADCAST_IDS // 200
    monkeypatch.setattr(C, "MAX_LISTED_IDS", 50)
    monkeypatch.setattr(C, "MAX_BROADCAST_IDS", C.MAX_BROADCAST_IDS // scale)
    wanted = big_store.select("chunk_id")
    assert wanted.count() > C.MAX_BROADCAST_IDS * C.MAX_GROUPS
    found = C.fetch(big_store, wanted, digits=1)
    assert "rightHint=(strategy=broadcast)" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert found.count() == wanted.count()


def test_new_chunks_against_a_fetched_store(spark, big_store):
    known = [r[0] for r in big_store.select("chunk_id").limit(20).collect()]
    mine = spark.createDataFrame([(i, b"a") for i in (*known, "new", "new")], "chunk_id string, data binary")
    ids = C.fetch(big_store.select("bucket", "chunk_id"), mine, digits=1)
    assert [r.chunk_id for r in C.new_chunks(mine, ids, digits=1).collect()] == ["new"]


def _moved(df):
    """What each exchange of a plan moves, as schemas; joins of small sides are taken for joins of large ones."""
    spark = df.sparkSession
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        todo, found = [df.select("*")._jdf.queryExecution().executedPlan()], []
        while todo:
            node = todo.pop()
            below = node.children()
            todo += [below.apply(i) for i in range(below.size())]
            if node.nodeName() == "Exchange":
                found.append(node.schema().simpleString())
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    return found


def test_bytes_of_new_chunks_move_once(spark, big_store, tmp_path):
    big_store.filter("chunk_id < '8'").select("chunk_id", "data").write.parquet(str(tmp_path / "own"))
    own = spark.read.parquet(str(tmp_path / "own"))
    fresh = C.new_chunks(own, big_store.filter("chunk_id < '4'"), digits=1)
    assert sum("binary" in moved for moved in _moved(fresh)) == 1
    assert fresh.count() == own.filter("chunk_id >= '4'").count() > 0


def test_bytes_of_files_move_twice_and_rest_between(spark, tmp_path):
    _files(spark).write.parquet(str(tmp_path / "files"))
    _store(spark).write.parquet(str(tmp_path / "store"))
    files, store = spark.read.parquet(str(tmp_path / "files")).drop("data"), spark.read.parquet(str(tmp_path / "store"))
    assert sum("binary" in moved for moved in _moved(C.reassemble(files, store))) == 2
    held = []

    def hold(found):
        held.append(found.columns)
        found.write.parquet(str(tmp_path / "held"))
        return spark.read.schema(found.schema).parquet(str(tmp_path / "held"))

    again = C.reassemble(files, store, hold=hold)
    assert sum("binary" in moved for moved in _moved(again)) == 1 and held == [["doc_id", "path", "pos", "data"]]
    assert _by_id(again) == _by_id(C.reassemble(files, store))


def test_files_without_a_path_or_a_key_get_their_bytes(spark):
    files = spark.createDataFrame(
        [("x", None, ["1"], 1, None), (None, "x", ["2"], 1, None), (None, None, ["1", "2"], 2, None), ("x", "x", ["2", "1"], 2, None)], FILES)
    store = spark.createDataFrame([("1", b"A"), ("2", b"B")], "chunk_id string, data binary")
    out = {(r.doc_id, r.path): bytes(r.content) for r in C.reassemble(files, store).collect()}
    assert out == {("x", None): b"A", (None, "x"): b"B", (None, None): b"AB", ("x", "x"): b"BA"}
