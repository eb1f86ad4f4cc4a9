"""Repair of conversation structure by run-length dynamic programming over min-plus transitions."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import Query, settled, table

# Prices of the edits, the roles that they give, and what counts as blank or as an end.
DELETE, REROLE, INSERT, TRUNCATED = 4, 3, 3, 3
USER, ASSISTANT = "user", "assistant"
BLANKS, ENDS = " \t\n\x0b\x0c\r", ".!?"
_BLANK = r"[\x20\x09-\x0D]"

# What has been given out so far: nothing, a system row, a last row of the user, a last row of the assistant.
NOTHING, SYSTEM, ASKED, ANSWERED = range(4)
STATES = range(4)
NEXT = (ASKED, ASKED, ANSWERED, ASKED)  # the state after one more row of the role that must follow
FINISH = (0, 2 * INSERT, INSERT, 0)  # cheapest inserts from each state to an allowed end
FAR = 1 << 60
_KEPT = {"s": {NOTHING: SYSTEM}, "u": {NOTHING: ASKED, SYSTEM: ASKED, ANSWERED: ASKED}, "a": {ASKED: ANSWERED}}

#: A row as the transitions see it: its role's initial (or "" for any other) and whether it is truncated; None must be deleted.
Symbol = tuple[str, bool] | None
Vector = tuple[int, int, int, int]
Matrix = tuple[Vector, Vector, Vector, Vector]


@lru_cache(maxsize=None)
def edits(symbol: Symbol) -> tuple[tuple[tuple[str, int, int], ...], ...]:
    """From each state, the edits of one row as (initial, next state, cost), by initial."""
    out = []
    for state in STATES:
        found = [("D", state, DELETE)]
        if symbol is not None:
            initial, truncated = symbol
            more = TRUNCATED if truncated else 0
            kept = _KEPT.get(initial, {}).get(state)
            if kept is not None:
                found.append(("K", kept, more))
            found.append(("R", NEXT[state], REROLE + more))
        out.append(tuple(found))
    return tuple(out)


@lru_cache(maxsize=None)
def transition(symbol: Symbol) -> Matrix:
    """Least cost from state to state by any inserts and then one row."""
    rows = []
    for start in STATES:
        row, state, paid = [FAR] * 4, start, 0
        for _ in range(4):  # after three inserts states repeat
            for _, after, cost in edits(symbol)[state]:
                row[after] = min(row[after], paid + cost)
            state, paid = NEXT[state], paid + INSERT
        rows.append(tuple(row))
    return tuple(rows)


def product(a: Matrix, b: Matrix) -> Matrix:
    columns = tuple(zip(*b))
    return tuple(tuple(min(FAR, *map(int.__add__, row, column)) for column in columns) for row in a)


def applied(a: Matrix, v: Vector) -> Vector:
    return tuple(min(FAR, *map(int.__add__, row, v)) for row in a)


@lru_cache(maxsize=None)
def power(symbol: Symbol, exponent: int) -> Matrix:
    """The transition of 2 ** exponent rows alike. There are nine symbols and few exponents: all are remembered."""
    if not exponent:
        return transition(symbol)
    half = power(symbol, exponent - 1)
    return product(half, half)


def advanced(symbol: Symbol, times: int, after: Vector) -> Vector:
    """Costs to the end before a run of rows alike, from those after it: one step for each binary digit of its length."""
    exponent = 0
    while times:
        if times & 1:
            after = applied(power(symbol, exponent), after)
        times, exponent = times >> 1, exponent + 1
    return after


def runs(symbols: Iterable[Symbol]) -> list[tuple[Symbol, int]]:
    return [(s, sum(1 for _ in same)) for s, same in groupby(symbols)]


def boundaries(of: list[tuple[Symbol, int]], end: Vector) -> list[Vector]:
    """Costs to the end at the start of each run, and at the end of the last."""
    out = [end]
    for symbol, times in reversed(of):
        out.append(advanced(symbol, times, out[-1]))
    return out[::-1]


def _unrolled(symbol: Symbol, times: int, after: Vector, state: int, out: list[str]) -> int:
    """Appends the edits of one run, the least initial of all that keep the cost least; gives the state after it."""
    if times > 32:  # by halves, so that only a few vectors are held however long the run is
        rest = times // 2
        state = _unrolled(symbol, times - rest, advanced(symbol, rest, after), state, out)
        return _unrolled(symbol, rest, after, state, out)
    costs = [after]
    for _ in range(times):
        costs.append(applied(transition(symbol), costs[-1]))
    for i in range(times, 0, -1):
        done = False
        while not done:
            choices = [("I", NEXT[state], INSERT + costs[i][NEXT[state]])]
            choices += [(initial, to, cost + costs[i - 1][to]) for initial, to, cost in edits(symbol)[state]]
            initial, state = min((c, to) for c, to, cost in choices if cost == costs[i][state])
            out.append(initial)
            done = initial != "I"
    return state


def unroll(of: list[tuple[Symbol, int]], bounds: list[Vector], start: int) -> tuple[str, int]:
    """The cheapest edits from `start`, of those the least as text, and the state after the last row."""
    out: list[str] = []
    for (symbol, times), after in zip(of, bounds[1:]):
        start = _unrolled(symbol, times, after, start, out)
    return "".join(out), start


def finished(state: int) -> str:
    return "I" * (FINISH[state] // INSERT)


@lru_cache(maxsize=20_000)
def _cheapest(symbols: tuple[Symbol, ...]) -> tuple[int, str]:
    of = runs(symbols)
    bounds = boundaries(of, FINISH)
    audit, state = unroll(of, bounds, NOTHING)
    return bounds[0][NOTHING], audit + finished(state)


def cheapest(symbols: tuple[Symbol, ...]) -> tuple[int, str]:
    """Least cost of a repair, and its edits' initials; of several cheapest ones, the least as text."""
    return _cheapest(symbols) if len(symbols) <= 64 else _cheapest.__wrapped__(symbols)


def repaired(rows: Iterable[tuple[str, str]], audit: str, state: int = NOTHING) -> Iterator[tuple[str, str]]:
    """The rows `(role, text)` after the edits."""
    left = iter(rows)
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(left)
        if edit == "D":
            continue
        after = _KEPT[role[:1]][state] if edit == "K" else NEXT[state]
        yield (role if edit == "K" else ASSISTANT if after == ANSWERED else USER), text
        state = after


@dataclass
class Facts:
    """Counts of a stretch of rows, and what is needed to add the next stretch."""

    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    distinct: int = 0
    first: str | None = None  # initial of the first row
    last: str | None = None
    least: int | None = None  # first turn that is not null; rows come in order of turns
    most: int | None = None

    def row(self, turn: int | None, initial: str, blank: bool, duplicate: bool, truncated: bool) -> Symbol:
        """Counts one row by its first fault; gives its symbol."""
        self.add(Facts(first=initial, last=initial, distinct=turn is not None, least=turn, most=turn))
        if blank or duplicate:
            self.blank += blank
            self.duplicate += not blank
            return None
        self.truncated += truncated
        return (initial if initial in _KEPT else "", truncated)

    def add(self, next_: Facts) -> None:
        if next_.first is None:
            return
        for name in ("blank", "duplicate", "truncated", "illegal", "distinct"):
            setattr(self, name, getattr(self, name) + getattr(next_, name))
        self.illegal += self.last is not None and (self.last, next_.first) not in (("s", "u"), ("u", "a"), ("a", "u"))
        self.distinct -= self.most is not None and self.most == next_.least
        self.first = next_.first if self.first is None else self.first
        self.last = next_.last
        self.least = next_.least if self.least is None else self.least
        self.most = self.most if next_.most is None else next_.most

    def told(self) -> dict:
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.distinct
        return {"gaps": gaps, "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated, "illegal": self.illegal}


def faults(text: str) -> tuple[bool, bool]:
    """Blank, and not blank but without an end."""
    solid = text.rstrip(BLANKS)
    return not solid, bool(solid) and solid[-1] not in ENDS


_TURNS = "array<struct<role string, text string>>"
_TOLD = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_RAW = "struct<part long, at long, turn long, role string, text string, gone boolean>"


def _whole(conv, rows: list[tuple]) -> dict:
    facts, symbols, seen = Facts(), [], set()
    kept = [(turn, role, text) for turn, role, text, gone in rows if not gone]
    for turn, role, text in kept:
        blank, truncated = faults(text)
        symbols.append(facts.row(turn, role[:1], blank, (role, text) in seen, truncated))
        seen.add((role, text))
    cost, audit = cheapest(tuple(symbols))
    turns = [{"role": r, "text": t} for r, t in repaired(((r, t) for _, r, t in kept), audit)]
    return {"conv_id": conv, "told": facts.told() | {"cost": cost, "audit": audit}, "turns": turns, "raw": None}


def _arrow(kind: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(kind)


def _first_pass(kind: T.StructType):
    """Repairs the conversations inside a range; gives back the rows of its first and last one, which may go on beyond it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, out = _arrow(kind), []
        now, rows, in_first, size = object(), [], True, 0

        def raw(conv, row: tuple) -> dict:
            part, at, turn, role, text, gone = row
            return {"conv_id": conv, "told": None, "turns": None, "raw": {"part": part, "at": at, "turn": turn, "role": role, "text": text, "gone": gone}}

        begun = False
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(7)]
            for conv, *row in zip(*columns):
                if not begun:
                    now, begun = conv, True
                elif conv != now:
                    if not in_first:
                        out.append(_whole(now, [r[2:] for r in rows]))
                    now, rows, in_first = conv, [], False
                if in_first:
                    out.append(raw(conv, tuple(row)))
                else:
                    rows.append(tuple(row))
                size += len(row[4])
                if len(out) >= 2_000 or size > 1 << 24:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out, size = [], 0
        out += [raw(now, row) for row in rows]
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    return run


@dataclass
class Repairs:
    """`told`: one row for each conversation with its counts, cost and audit. `pieces (conv_id, part, cut, turns)`: its repaired
    rows in order, in one piece for all but conversations that range boundaries cut."""

    told: DataFrame
    pieces: DataFrame


def repair(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", gone: str | None = None) -> Repairs:
    """The cheapest repair of every conversation to the roles `(s?(ua)+)?`.

    Rows come in order of turns (nulls first); rows of one turn by role, then by the SHA-256 of their text. Null roles and texts are
    one space, and a null conversation is a conversation. Rows with a true `gone` are not there, but their conversation is: without
    any other row it has zeros and an empty audit. Repeated rows are duplicates; an empty table gives no rows; other columns, whatever
    they are called, are not read. Turns must be whole numbers.

    Rows are sorted by range, so a conversation of a third of all rows is spread over a third of all tasks. Each task repairs
    the conversations inside its range. The first and the last one of each range may be cut: their duplicates are found by key, each
    piece is reduced to a four by four matrix of costs with its edits, these meet by conversation, and each piece is edited by itself.
    """
    given = conversations.select(
        F.col(f"`{conv_id}`").alias("conv_id"), F.col(f"`{turn}`").cast("long").alias("turn"), F.coalesce(F.col(f"`{role}`"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(f"`{text}`"), F.lit(" ")).alias("text"), (F.coalesce(F.col(f"`{gone}`"), F.lit(False)) if gone else F.lit(False)).alias("gone"),
    )
    # Rows alike in all of these may stand in any order, and the last number keeps them from being one hot key.
    keys = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("mark"), F.asc("nth")]
    marked = given.select("*", F.sha2("text", 256).alias("mark"), F.monotonically_increasing_id().alias("nth"))
    ranged = marked.repartitionByRange(*keys).sortWithinPartitions(*keys).select(
        "conv_id", F.spark_partition_id().cast("long").alias("part"), F.monotonically_increasing_id().alias("at"), "turn", "role", "text", "gone"
    )
    id_type = given.schema["conv_id"].dataType.simpleString()
    kind = f"conv_id {id_type}, told struct<{_TOLD.replace(' ', ':').replace(',:', ', ')}>, turns {_TURNS}, raw {_RAW}"
    schema = T.StructType.fromDDL(kind)
    read = settled(ranged.mapInArrow(_first_pass(schema), schema), "conversations-ranges")
    inside, open_ = read.filter("raw IS NULL"), read.filter("raw IS NOT NULL").select("conv_id", "raw.*")
    cut = _cut(open_, id_type)
    return Repairs(
        inside.select("conv_id", "told.*").unionByName(cut.told),
        inside.select("conv_id", F.lit(0).cast("long").alias("part"), F.lit(False).alias("cut"), "turns").unionByName(cut.pieces),
    )


_KINDS = {
    "string": pa.string(), "long": pa.int64(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string()),
    _TURNS: pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())])),
}


def _fields(kinds: str) -> pa.Schema:
    """The Arrow form of a flat list of columns, also where there is no session."""
    return pa.schema([(f.split(" ", 1)[0], _KINDS[f.split(" ", 1)[1]]) for f in re.split(r", (?![^<]*>)", kinds)])


def _named(conv: str = "conv_id") -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(conv).cast("string")), F.lit("null")).alias("key")


_PIECE = ("key string, part long, blank long, duplicate long, truncated long, illegal long, distinct long, first string, last string, least long, most long, "
          "costs array<long>, audits array<string>")


def _reduced(group: pa.Table) -> pa.Table:
    """A piece of a conversation as a matrix: cost and edits from every state to every other."""
    rows = sorted(group.to_pylist(), key=lambda r: r["at"])
    facts = Facts()
    of = runs([facts.row(r["turn"], r["initial"], r["blank"], r["duplicate"], r["truncated"]) for r in rows if not r["gone"]])
    costs, audits = [], []
    ends = [boundaries(of, tuple(0 if q == end else FAR for q in STATES)) for end in STATES]
    for start in STATES:
        for bounds in ends:
            costs.append(bounds[0][start])
            audits.append(unroll(of, bounds, start)[0] if bounds[0][start] < FAR else None)
    out = {"key": rows[0]["key"], "part": rows[0]["part"], **vars(facts), "costs": costs, "audits": audits}
    return pa.Table.from_pylist([out], _fields(_PIECE))


_EDITED = f"key string, part long, turns {_TURNS}"
_CHOSEN = f"key string, part long, start long, edits string, final boolean, {_TOLD}"


def _chosen(group: pa.Table) -> pa.Table:
    """The edits of each piece on the cheapest way through all of them; the last row also tells the whole conversation."""
    pieces = sorted(group.to_pylist(), key=lambda r: r["part"])
    facts, after = Facts(), [FINISH]
    for p in pieces:
        facts.add(Facts(**{n: p[n] for n in vars(facts)}))
    for p in reversed(pieces):
        after.append(applied(tuple(tuple(p["costs"][4 * s : 4 * s + 4]) for s in STATES), after[-1]))
    after.reverse()
    state, out = NOTHING, []
    for p, here, there in zip(pieces, after, after[1:]):
        # Pieces of equal cost that end differently differ in some letter, so that the least text is the least of the whole.
        edits_, end = min((p["audits"][4 * state + q], q) for q in STATES if p["costs"][4 * state + q] + there[q] == here[state] and there[q] < FAR)
        out.append({"key": p["key"], "part": p["part"], "start": state, "edits": edits_, "final": False})
        state = end
    out[-1] |= {"edits": out[-1]["edits"] + finished(state), "final": True}
    out[-1] |= facts.told() | {"cost": after[0][NOTHING], "audit": "".join(r["edits"] for r in out)}
    return pa.Table.from_pylist(out, _fields(_CHOSEN))


def _edited(rows: pa.Table, chosen: pa.Table) -> pa.Table:
    """One piece of a conversation after its edits."""
    (how,) = chosen.to_pylist()
    kept = [(r["role"], r["text"]) for r in sorted(rows.to_pylist(), key=lambda r: r["at"]) if not r["gone"]]
    turns = [{"role": r, "text": t} for r, t in repaired(kept, how["edits"], how["start"])]
    return pa.Table.from_pylist([{"key": how["key"], "part": how["part"], "turns": turns}], _fields(_EDITED))


def _cut(rows: DataFrame, id_type: str) -> Repairs:
    """Repairs of conversations whose rows lie in several ranges, each range's piece by itself."""
    solid = F.regexp_replace("text", f"{_BLANK}+$", "")
    named = rows.withColumns({"key": _named(), "same": F.sha2(F.concat(_named(), F.lit("\n"), F.length("role").cast("string"), F.lit("\n"), "role", "text"), 256)})
    slim = named.select(
        "key", "part", "at", "turn", "gone", "same", F.substring("role", 1, 1).alias("initial"), (solid == "").alias("blank"),
        ((solid != "") & ~F.substring(solid, -1, 1).isin(*ENDS)).alias("truncated"),
    )
    first = slim.filter(~F.col("gone")).groupBy("same").agg(F.min("at").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    judged = slim.join(first, "same", "left").withColumn("duplicate", F.coalesce(F.col("at") > F.col("first"), F.lit(False))).drop("same", "first")
    reduced = judged.groupBy("key", "part").applyInArrow(_reduced, _PIECE)
    chosen = settled(reduced.groupBy("key").applyInArrow(_chosen, _CHOSEN), "conversations-cut")
    ids = rows.groupBy("conv_id").agg(F.lit(1).alias("_one")).select("conv_id", _named())
    told = chosen.filter("final").join(ids, "key").select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    texts = named.select("key", "part", "at", "role", "text", "gone").groupBy("key", "part")
    edited = texts.cogroup(chosen.select("key", "part", "start", "edits").groupBy("key", "part")).applyInArrow(_edited, _EDITED)
    return Repairs(told, edited.join(ids, "key").select("conv_id", "part", F.lit(True).alias("cut"), "turns"))


def digests(pieces: DataFrame) -> DataFrame:
    """`(conv_id, repaired_sha256)` of the repaired rows `role:text`, joined by newlines.

    The pieces of a cut conversation pass through one hash in order, a piece at a time: SHA-256 cannot be computed in parts.
    """
    joined = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit(":"), t.text)), "\n")
    whole = pieces.filter("NOT cut").select("conv_id", F.sha2(joined, 256).alias("repaired_sha256"))
    schema = T.StructType([pieces.schema["conv_id"], T.StructField("repaired_sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, begun, hashed, out = None, False, hashlib.sha256(), []
        started = False
        for batch in batches:
            for conv, used, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if begun and conv != now:
                    out.append({"conv_id": now, "repaired_sha256": hashed.hexdigest()})
                    hashed, started = hashlib.sha256(), False
                now, begun = conv, True
                if used:
                    hashed.update(("\n" if started else "").encode() + text.encode())
                    started = True
        if begun:
            out.append({"conv_id": now, "repaired_sha256": hashed.hexdigest()})
        yield pa.RecordBatch.from_pylist(out, _arrow(schema))

    parts = pieces.filter("cut").select("conv_id", "part", (F.size("turns") > 0).alias("used"), joined.alias("text"))
    ordered = parts.repartition("conv_id").sortWithinPartitions(F.asc_nulls_first("conv_id"), "part").select("conv_id", "used", "text")
    return whole.unionByName(ordered.mapInArrow(run, schema))


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows `(conv_id, turn, role, text, gone)` with faults put in by crc32(`conv_id:turn`) % 20; nulls count as one space."""
    spaced = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    held = conversations.select("conv_id", "turn", spaced("role").alias("role"), spaced("text").alias("text"), fate.alias("fate"))
    return held.withColumn("copy", F.explode(F.sequence(F.lit(1), F.when(F.col("fate") == 3, 2).otherwise(1)))).select(
        "conv_id", "turn", F.when(F.col("fate") == 4, USER).otherwise(F.col("role")).alias("role"),
        F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        (F.col("fate") == 0).alias("gone"),
    )


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repairs of all conversations after damage."""
    found = repair(damaged(table(spark, sf_dir, "conversations")), gone="gone")
    told, hashed = found.told, digests(found.pieces).withColumnRenamed("conv_id", "_conv")
    met = told.join(hashed, told["conv_id"].eqNullSafe(hashed["_conv"]))
    return met.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


QUERIES: dict[str, Query] = {"op13_conversation_repair": op13_conversation_repair}


def _sql() -> str:
    """Costs and audits as one text, cost first in twelve digits, so that the least text is the cheapest and then the least repair."""
    plus = lambda x, cost, edit: f"(lpad((substr({x}, 1, 12)::BIGINT + {cost})::VARCHAR, 12, '0') || substr({x}, 13) || '{edit}')"
    inserted = lambda x, times=1: plus(x, INSERT * times, "I" * times)
    asked = f"least(asked, {inserted('nothing')}, {inserted('system')}, {inserted('answered')})"
    answered = f"least(answered, {inserted('asked')}, {inserted('nothing', 2)}, {inserted('system', 2)})"
    before_user = "least(nothing, system, near_answered)"
    kept = lambda sign, x: f"CASE WHEN sign = '{sign}' THEN {plus(x, 'more', 'K')} END"
    given = lambda x: f"CASE WHEN sign <> 'x' THEN {plus(x, f'{REROLE} + more', 'R')} END"
    return f"""WITH RECURSIVE crc_steps(i, c, k) AS (
  SELECT i, i, 0 FROM range(256) r(i)
  UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM crc_steps WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY i) AS crc FROM crc_steps WHERE k = 8),
given AS (
  SELECT row_number() OVER () AS rid, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce('=' || conv_id::VARCHAR, 'null') AS key,
    string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), '') AS letters FROM conversations),
fated AS (
  SELECT *, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(letters, lambda x: ascii(x)::BIGINT)),
    lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1]))) % 20 AS fate FROM given, crc_table),
damaged AS (
  SELECT rid, key, turn, CASE WHEN fate = 4 THEN '{USER}' ELSE role END AS role,
    CASE WHEN fate = 1 THEN '' WHEN fate = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(generate_series(1, CASE WHEN fate = 3 THEN 2 ELSE 1 END)) AS copy
  FROM fated WHERE fate <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY turn NULLS FIRST, role, sha256(text), rid, copy) AS n FROM damaged),
seen AS (
  SELECT *, left(role, 1) AS initial, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS solid,
    row_number() OVER (PARTITION BY key, role, text ORDER BY n) > 1 AS again, lag(left(role, 1)) OVER (PARTITION BY key ORDER BY n) AS prior FROM placed),
judged AS MATERIALIZED (
  SELECT *, solid = '' AS blank, solid <> '' AND again AS duplicate, solid <> '' AND NOT again AND right(solid, 1) NOT IN ('.', '!', '?') AS truncated,
    prior IS NOT NULL AND NOT (prior || '-' || initial IN ('s-u', 'u-a', 'a-u')) AS illegal FROM seen),
signed AS MATERIALIZED (
  SELECT key, n, CASE WHEN blank OR duplicate THEN 'x' WHEN initial IN ('s', 'u', 'a') THEN initial ELSE 'o' END AS sign,
    CASE WHEN truncated THEN {TRUNCATED} ELSE 0 END AS more FROM judged),
walk(key, n, nothing, system, asked, answered) AS (
  SELECT DISTINCT key, 0::BIGINT, '000000000000', NULL::VARCHAR, NULL::VARCHAR, NULL::VARCHAR FROM given
  UNION ALL
  SELECT key, n, {plus("nothing", DELETE, "D")}, least({plus("system", DELETE, "D")}, {kept("s", "nothing")}),
    least({plus("near_asked", DELETE, "D")}, {kept("u", before_user)}, {given(before_user)}),
    least({plus("near_answered", DELETE, "D")}, {kept("a", "near_asked")}, {given("near_asked")})
  FROM (
    SELECT s.key, s.n, s.sign, s.more, w.nothing, w.system, {asked} AS near_asked, {answered} AS near_answered
    FROM walk w JOIN signed s ON w.key = s.key AND s.n = w.n + 1)),
ended AS (
  SELECT key, least(nothing, answered, {inserted("asked")}, {inserted("system", 2)}) AS best, n, max(n) OVER (PARTITION BY key) AS rows FROM walk),
told AS MATERIALIZED (SELECT key, substr(best, 1, 12)::BIGINT AS cost, substr(best, 13) AS audit FROM ended WHERE n = rows),
steps AS (SELECT key, unnest(generate_series(1, len(audit))) AS place, audit FROM told),
edits AS (
  SELECT key, place, substr(audit, place, 1) AS edit, sum(CASE WHEN substr(audit, place, 1) <> 'I' THEN 1 ELSE 0 END) OVER w AS n,
    sum(CASE WHEN substr(audit, place, 1) <> 'D' THEN 1 ELSE 0 END) OVER w AS given
  FROM steps WINDOW w AS (PARTITION BY key ORDER BY place)),
met AS (
  SELECT e.*, j.role, j.text, max(CASE WHEN e.given = 1 AND e.edit = 'K' AND j.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY e.key) AS system
  FROM edits e LEFT JOIN judged j ON e.key = j.key AND e.n = j.n AND e.edit <> 'I'),
texts AS (
  SELECT key, string_agg(CASE WHEN edit = 'K' THEN role WHEN (given - system) % 2 = 1 THEN '{USER}' ELSE '{ASSISTANT}' END || ':' || coalesce(text, ''), chr(10) ORDER BY place) AS repaired
  FROM met WHERE edit <> 'D' GROUP BY key),
counts AS (
  SELECT key, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, sum(blank::INTEGER) AS blank, sum(duplicate::INTEGER) AS duplicate,
    sum(truncated::INTEGER) AS truncated, sum(illegal::INTEGER) AS illegal FROM judged GROUP BY key),
ids AS (SELECT DISTINCT key, conv_id FROM given)
SELECT i.conv_id, coalesce(c.gaps, 0)::BIGINT AS gaps, coalesce(c.blank, 0)::BIGINT AS blank, coalesce(c.duplicate, 0)::BIGINT AS duplicate,
  coalesce(c.truncated, 0)::BIGINT AS truncated, coalesce(c.illegal, 0)::BIGINT AS illegal, t.cost, t.audit, sha256(coalesce(x.repaired, '')) AS repaired_sha256
FROM ids i JOIN told t ON i.key = t.key LEFT JOIN counts c ON i.key = c.key LEFT JOIN texts x ON i.key = x.key"""


SQL: dict[str, str] = {"op13_conversation_repair": _sql()}
