import pytest
from pyspark.sql import functions as F

from tidemark.operators import conflict as X
from tidemark.operators import diff as D
from tidemark.operators import versions as V

SIDE = "doc_id string, path string, ms long, hash string, size long, version int"


def _side(spark, rows):
    return spark.createDataFrame(rows, SIDE).withColumn("mtime", F.timestamp_millis("ms")).drop("ms")


def _listing(spark, rows):
    return spark.createDataFrame(rows, "path string, hash string, ms long").withColumn("mtime", F.timestamp_millis("ms"))


def _pair(spark, local, remote):
    return D.pair_replicas(
        _side(spark, [("d", "d", local[0], local[1], 100, 1)]), _side(spark, [("d", "d", remote[0], remote[1], 100, 1)])
    )


def _winner(spark, local, remote, strategy="last-write-wins"):
    r = X.resolve(_pair(spark, local, remote), strategy).first()
    return r.conflict, r.winner, r.action


def test_newer_local_wins(spark):
    assert _winner(spark, (1000, "local-hash"), (900, "remote-hash")) == (True, "local", "local is newer")


def test_same_time_different_hash_is_a_conflict(spark):
    assert _winner(spark, (1000, "hash1"), (1000, "hash2")) == (True, "local", "same mtime, local wins (tiebreaker)")


def test_same_hash_is_no_conflict(spark):
    assert _winner(spark, (1000, "same-hash"), (1000, "same-hash")) == (False, "local", "no conflict")
    assert _winner(spark, (1, "same-hash"), (1000, "same-hash"))[0] is False


def test_other_strategies(spark):
    old_remote = ((1000, "l"), (900, "r"))
    assert _winner(spark, *old_remote, "remote-wins")[1] == "remote"
    assert _winner(spark, (900, "l"), (1000, "r"), "local-wins")[1] == "local"
    assert _winner(spark, (900, "l"), (1000, "r"))[1:] == ("remote", "remote is newer")
    assert _winner(spark, *old_remote, "keep-both")[1:] == ("both", "keeping both versions")
    assert _winner(spark, *old_remote, "?")[1:] == ("local", "unknown strategy, defaulting to local")


def test_missing_remote_is_no_conflict_and_missing_hash_is_one(spark):
    local = _side(spark, [("d", "d", 1, "h", 1, 1)])
    assert X.resolve(D.pair_replicas(local, _side(spark, []))).first().conflict is False
    assert _winner(spark, (1000, "h"), (None, None)) == (True, "local", "local is newer")


def test_survivor_and_archive(spark):
    def run(strategy):
        resolved = X.resolve(_pair(spark, (1000, "l"), (900, "r")), strategy)
        archived = [(r.doc_id, r.hash, r.archived) for r in X.archive_rows(resolved).collect()]
        return X.apply_resolution(resolved).first().hash, archived

    assert run("local-wins") == ("l", [("d.v1", "r", True)])
    assert run("keep-both") == ("l", [("d.v1", "r", True)])
    assert run("remote-wins") == ("r", [])


def test_latest_of_many_replicas(spark):
    df = spark.createDataFrame(
        [("k", 1, "a", False), ("k", 3, "b", False), ("k", 3, "c", True), ("j", 2, "z", False)],
        "key string, ts long, who string, local boolean",
    )
    newest = X.latest_write(df, "key", "ts", F.col("local"), "who")
    assert sorted(r.who for r in newest.collect()) == ["c", "z"]


def test_diff_statuses(spark):
    prev = _listing(spark, [("same", "h", 1), ("hash", "h", 1), ("time", "h", 1), ("gone", "h", 1), ("blank", "", 1)])
    curr = _listing(spark, [("same", "h", 1), ("hash", "x", 1), ("time", "h", 2), ("new", "h", 1), ("blank", "h", 1)])
    changes = D.detect_changes(prev, curr)
    assert {r.path: r.status for r in changes.collect()} == {
        "same": "unchanged", "hash": "modified", "time": "modified", "gone": "deleted", "new": "added", "blank": "added"
    }
    assert D.change_summary(changes).first().asDict() == {
        "added": 2, "modified": 2, "deleted": 1, "unchanged": 1, "total_files": 5
    }
    batch = [r.path for r in D.next_batch(changes, 5000, 4000, 3).collect()]
    assert batch == ["blank", "new", "hash"]
    assert D.next_batch(changes, 4999, 4000).count() == 0
    after = D.mark_synced(prev, curr, changes.filter("status = 'modified'"))
    left = D.detect_changes(after, curr)
    assert left.filter("status = 'modified'").count() == 0
    assert left.filter("status = 'deleted'").count() == 1
    assert D.detect_changes(D.update_state(curr), curr).filter("status <> 'unchanged'").count() == 0


def test_skip_unchanged(spark):
    store = _side(spark, [("a", "a", 1000, "h", 5, 1), ("b", "b", 1000, "h", 5, 1), ("c", "c", 1000, "h", 5, 1)])
    curr = _side(spark, [("a", "a", 1000, "x", 5, 1), ("b", "b", 1001, "h", 5, 1), ("c", "c", 1000, "h", 6, 1), ("d", "d", 1, "h", 1, 1)])
    part = curr.withColumn("mtime", F.col("mtime") + F.expr("INTERVAL 0.0005 SECOND"))
    assert sorted(r.doc_id for r in D.skip_unchanged(part, store).collect()) == ["b", "c", "d"]


def test_upsert_keeps_what_the_new_row_lacks(spark):
    current = spark.createDataFrame([("a", 3, 10, "keep", "old"), ("b", 1, 11, "stay", "old")], "doc_id string, version int, ctime long, extra string, hash string")
    incoming = spark.createDataFrame([("a", 99, "new"), ("c", 98, "new")], "doc_id string, ctime long, hash string")
    got = {r.doc_id: (r.version, r.ctime, r.extra, r.hash) for r in D.upsert_docs(current, incoming).collect()}
    assert got == {"a": (4, 10, "keep", "new"), "b": (1, 11, "stay", "old"), "c": (1, 98, None, "new")}


def _with_history(spark, n):
    base = _side(spark, [("d", "d", 1000, f"h{n + 1}", 1, n + 1)])
    entries = [F.struct(
        F.lit(i).alias("version"), F.timestamp_millis(F.lit(i)).alias("mtime"), F.lit(f"h{i}").alias("hash"),
        F.lit(f"d.v{i}").alias("doc_id"), F.lit("local").alias("source"), F.lit(False).alias("conflict"),
    ) for i in range(1, n + 1)]
    return base.withColumn("versions", F.array(*entries) if entries else F.lit(None))


def test_first_version_is_recorded(spark):
    seed = _side(spark, [("d", "d", 1, "hash1", 1, 1)])
    history = V.record_version(seed, "local").first().versions
    assert len(history) == 1 and history[0].version == 1 and history[0].doc_id == "d.v1"


@pytest.mark.parametrize("n", [0, 8, 9, 10, 11])
def test_history_is_cut_to_ten(spark, n):
    history = V.record_version(_with_history(spark, n), "remote", True).first().versions
    assert [v.version for v in history] == list(range(max(1, n + 2 - 10), n + 2))
    assert history[-1].conflict is True and history[-1].source == "remote"


def test_retention_forms_agree(spark):
    nested = V.retain_versions(_with_history(spark, 11), 4).first().versions
    assert [v.version for v in nested] == [8, 9, 10, 11]
    rows = spark.createDataFrame([("d", i) for i in range(1, 12)], "doc_id string, version int")
    kept = V.retain_version_rows(rows, 4)
    assert sorted(r.version for r in kept.collect()) == [8, 9, 10, 11]
    assert V.retain_version_rows(kept, 4).count() == 4


def test_version_history_lookup(spark):
    store = _with_history(spark, 2).unionByName(_side(spark, [("e", "E", 1, "h", 1, None)]).withColumn("versions", F.lit(None)))
    asked = spark.createDataFrame([("D",), ("E",), ("none",)], "path string")
    got = {r.path: (r.found, r.version, r.versions and len(r.versions)) for r in V.version_history(store, asked).collect()}
    assert got == {"D": (True, 3, 2), "E": (True, 1, []), "none": (False, None, None)}


def test_revert_in_place(spark):
    back = V.revert_meta(_with_history(spark, 3), 2).first()
    assert (back.version, back.hash) == (2, "h2")
    assert V.revert_meta(_with_history(spark, 3), 7).count() == 0


def test_revert_as_new_version(spark):
    store = spark.createDataFrame(
        [("100/a", "100/A", ["c3"], "h3", 3, False), ("100/a.v1", "100/A", ["c1"], "h1", 1, True),
         ("300/b", "300/b", ["c3"], "h3", 3, False), ("300/b.v1", "300/b", ["c1"], "h1", 1, True)],
        "doc_id string, path string, children array<string>, hash string, version int, archived boolean",
    ).withColumn("mtime", F.timestamp_millis(F.lit(1)))
    asked = spark.createDataFrame([("100/A", 1), ("100/A", 9), ("300/b", 1)], "path string, to_version int")
    back = V.revert_to(store, asked, 5000).collect()
    assert [(r.doc_id, r.children, r.hash, r.version, r.reverted_from) for r in back] == [("100/a", ["c1"], "h1", 4, 1)]
