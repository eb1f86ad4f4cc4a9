"""Repairs of conversations: least costs and least audits, against all repairs of short ones."""

import hashlib
import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from tidemark.llm import conversations as conv

SCHEMA = "conv_id long, turn long, role string, text string"
ALLOWED = re.compile(r"(s?(ua)+)?")


def every_repair(symbols, most_inserts):
    """All edit texts with at most so many inserts at any place, with their costs; roles by trying both."""
    spots = [""] + ["I" * n for n in range(1, most_inserts + 1)]
    for choice in itertools.product("DKR", repeat=len(symbols)):
        for gaps in itertools.product(spots, repeat=len(symbols) + 1):
            yield "".join(g + c for g, c in zip(gaps, choice)) + gaps[-1]


def price(symbols, audit):
    """Least cost over all roles that rerole and insert may give; None if none is allowed."""
    options, cost, left = [], 0, iter(symbols)
    for edit in audit:
        if edit == "I":
            options.append("ua")
            cost += conv.INSERT
            continue
        symbol = next(left)
        if edit == "D":
            cost += conv.DELETE
            continue
        if symbol is None:
            return None
        cost += (conv.REROLE if edit == "R" else 0) + (conv.TRUNCATED if symbol[1] else 0)
        options.append("ua" if edit == "R" else symbol[0] or "?")
    return cost if any(ALLOWED.fullmatch("".join(o)) for o in itertools.product(*options)) else None


SYMBOLS = [None] + [(i, t) for i in ("s", "u", "a", "") for t in (False, True)]


@pytest.mark.parametrize("size", [0, 1, 2, 3])
def test_cheapest_of_all_repairs(size):
    chance = random.Random(size)
    cases = list(itertools.product(SYMBOLS, repeat=size)) if size < 3 else [tuple(chance.choices(SYMBOLS, k=size)) for _ in range(60)]
    for symbols in cases:
        priced = ((price(symbols, audit), audit) for audit in every_repair(symbols, 2))
        assert conv.cheapest(symbols) == min(p for p in priced if p[0] is not None), symbols


def test_powers_are_steps_taken_one_by_one():
    for symbol in SYMBOLS:
        for times in (0, 1, 2, 7, 64, 1_000):
            after = conv.FINISH
            for _ in range(times):
                after = conv.applied(conv.transition(symbol), after)
            assert conv.advanced(symbol, times, conv.FINISH) == after
    cost, audit = conv.cheapest((("u", False),) * 1_000)
    roles = [r for r, _ in conv.repaired([("user", "x")] * 1_000, audit)]
    assert re.fullmatch("(ua)+", "".join(r[0] for r in roles)) and price((("u", False),) * 4, conv.cheapest((("u", False),) * 4)[1]) == conv.cheapest((("u", False),) * 4)[0]
    assert cost == 3 * 500


def plain(rows):
    """One conversation, row by row: `rows (turn, role, text)` in order."""
    counts, symbols, seen = [0, 0, 0], [], set()
    for _, role, text in rows:
        solid = text.strip(conv.BLANKS)
        fault = 0 if not solid else 1 if (role, text) in seen else 2 if solid[-1] not in ".!?" else 3
        if fault < 3:
            counts[fault] += 1
        symbols.append(None if fault < 2 else (role[:1] if role[:1] in ("s", "u", "a") else "", fault == 2))
        seen.add((role, text))
    cost, audit = conv.cheapest(tuple(symbols))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + "-" + b[1][:1] not in ("s-u", "u-a", "a-u") for a, b in zip(rows, rows[1:]))
    text = "\n".join(f"{r}:{t}" for r, t in conv.repaired([(r, t) for _, r, t in rows], audit))
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())


def answers(df, gone=None):
    found = conv.repair(df, gone=gone)
    hashed = {r[0]: r[1] for r in conv.digests(found.pieces).collect()}
    return {r.conv_id: (*r[1:], hashed[r.conv_id]) for r in found.told.collect()}


def expected(rows):
    by = {}
    for c, t, r, x in rows:
        by.setdefault(c, []).append((t, " " if r is None else r, " " if x is None else x))
    mark = lambda z: (z[0] is not None, z[0] or 0, z[1], hashlib.sha256(z[2].encode()).hexdigest())
    return {c: plain(sorted(v, key=mark)) for c, v in by.items()}


ODD = [
    (1, 0, "user", "Why?"), (1, 1, "assistant", "So."), (1, 1, "assistant", "So."), (1, None, "system", "Be kind."), (1, 9, "user", None),
    (2, None, None, None), (2, None, "user", "no end"), (3, 0, "", "x."), (3, 0, "Tool", "y."), (4, 5, "assistant", " \t\n"), (None, 1, "user", "A."),
    (None, 1, "user", "A."), (None, 2, "assistant", "B. \n"), (5, 0, "user", "long " * 40_000 + "."), (6, 0, "usher", "a\x00b."), (6, 1, "a", "ü! "),
]


def test_odd_rows(spark):
    df = spark.createDataFrame(ODD, SCHEMA).select("*", *[F.lit("kept").alias(n) for n in ("part", "at", "key", "raw", "told", "gone", "mark", "nth", "strange.name")])
    assert answers(df) == expected(ODD)
    assert answers(df.limit(0)) == {}


@pytest.mark.parametrize("ranges", ["3", "17"])
def test_a_hot_conversation_is_cut_and_mended(spark, ranges):
    chance = random.Random(3)
    rows = [(7, chance.choice([None, *range(300)]), chance.choice(["user", "assistant", "system", "tool"]), chance.choice(["One.", "two", "", f"No {i}."])) for i in range(1_200)]
    rows += [(8, i // 2, ("user", "assistant")[i % 2], f"Turn {i}.") for i in range(300)] + [(9, 1, "user", "alike.")] * 400 + [(i, 0, "user", "A?") for i in range(20, 60)]
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", ranges)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        df = spark.createDataFrame(rows, SCHEMA).repartition(5)
        found = conv.repair(df)
        assert found.pieces.filter("cut AND conv_id = 7").count() > 1
        assert answers(df) == expected(rows)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_rows_that_are_gone_leave_their_conversation(spark):
    df = spark.createDataFrame([(1, 0, "user", "A."), (2, 0, "user", "B?")], SCHEMA).withColumn("gone", F.col("conv_id") == 1)
    assert answers(df, "gone")[1] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_damage(spark):
    rows = [(c, t, "assistant", "A. B! C?") for c in range(40) for t in range(20)] + [(None, None, None, None)]
    found = conv.damaged(spark.createDataFrame(rows, SCHEMA)).collect()
    import zlib

    fates = [zlib.crc32(f"{c}:{t}".encode()) % 20 for c, t, _, _ in rows[:-1]]
    assert len(found) == len(rows) + fates.count(3) and sum(r.gone for r in found) == fates.count(0)
    assert sum(r.text == "A B C" for r in found) == fates.count(2) and sum(r.text == "" for r in found) == fates.count(1)
    assert sum(r.role == "user" for r in found) == fates.count(4)
