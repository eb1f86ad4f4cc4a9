"""JSON merge.

`merge_json` gives the merged document as text. Its Python part is one small Arrow function, since
rebuilding JSON of any depth is not a built-in; Spark spreads the rows. `merge_json_leaves` is the
same comparison as a join of leaf rows, entirely inside the JVM, for reports on large tables.
"""

from __future__ import annotations

import json
from decimal import Decimal
from json.encoder import encode_basestring

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import constants as K

_RESULT = "merged string, conflicts array<string>"
_EXACT = 2**53


def _number(text: str):
    """JSON numbers are doubles: whole values print without a fraction, so 1 and 1.0 are one value."""
    value = float(text)
    if value.is_integer() and abs(value) < 1e21:
        return int(text) if "." not in text and "e" not in text.lower() and abs(int(text)) <= _EXACT else int(value)
    return value


def _no_constant(name):
    raise ValueError(name)


_load = json.JSONDecoder(parse_int=_number, parse_float=_number, parse_constant=_no_constant).decode
_quote = json.JSONEncoder(ensure_ascii=False).encode


def _keys_in_order(fields: dict):
    """Whole-number keys come first, ascending, as in every JSON object that was parsed."""
    if len(fields) < 2:
        return fields
    for k in fields:
        if k[:1].isdecimal():
            break
    else:
        return fields
    numeric = sorted((k for k in fields if k.isdecimal() and str(int(k)) == k and int(k) <= K.MAX_INDEX_KEY), key=int)
    taken = set(numeric)
    return numeric + [k for k in fields if k not in taken]


def _scalar(value) -> str:
    """JSON text of a scalar; numbers are plain from 1e-6 to below 1e21, else with the shortest exponent."""
    if isinstance(value, str):
        return encode_basestring(value)
    if not isinstance(value, float):
        return _quote(value)
    digits, _, power = repr(value).partition("e")
    if not power:
        return digits
    return f"{Decimal(repr(value)):f}" if 1e-6 <= abs(value) < 1e21 else f"{digits.removesuffix('.0')}e{int(power):+d}"


def _text(value, indent: str | None = None) -> str:
    """JSON text: on one line without blanks, or with two blanks per level from `indent` on."""
    if isinstance(value, dict):
        colon = ":" if indent is None else ": "
        inner = None if indent is None else indent + "  "
        items = [f"{encode_basestring(k)}{colon}{_text(value[k], inner)}" for k in _keys_in_order(value)]
        ends = "{}"
    elif isinstance(value, list):
        inner = None if indent is None else indent + "  "
        items = [_text(v, inner) for v in value]
        ends = "[]"
    else:
        return _scalar(value)
    if indent is None or not items:
        return ends[0] + ",".join(items) + ends[1]
    return ends[0] + inner + f",{inner}".join(items) + indent + ends[1]


def _shown(value) -> str:
    """How a value reads inside a conflict message."""
    if isinstance(value, list):
        return ",".join("" if v is None else _shown(v) for v in value)
    if isinstance(value, dict):
        return "[object Object]"
    return value if isinstance(value, str) else _scalar(value)


def _same_scalar(a, b) -> bool:
    """Equal values of one kind; objects and arrays are never equal here."""
    if isinstance(a, (dict, list)) or isinstance(b, (dict, list)):
        return False
    return isinstance(a, bool) == isinstance(b, bool) and isinstance(a, str) == isinstance(b, str) and a == b


def _union(local: list, remote: list) -> list:
    """The local items, then the remote items whose JSON text is not there yet."""
    seen = {_text(v) for v in local}
    extra = {}
    for item in remote:
        text = _text(item)
        if text not in seen:
            extra.setdefault(text, item)
    return local + list(extra.values())


def _merge_objects(local: dict, remote: dict, base, prefer_remote: bool, at: str, log: list[str]) -> dict:
    known = base if isinstance(base, dict) else None

    def pick(key):
        mine, theirs = local[key], remote[key]
        if isinstance(mine, list) and isinstance(theirs, list):
            return _union(mine, theirs)
        if isinstance(mine, dict) and isinstance(theirs, dict):
            inner = known.get(key) if known else None
            return _merge_objects(mine, theirs, inner, prefer_remote, f"{at}{key}.", log)
        if _same_scalar(mine, theirs):
            return mine
        note = f"{at}{key}: local={_shown(mine)}, remote={_shown(theirs)}"
        if known and key in known:
            if _same_scalar(mine, known[key]):
                return theirs
            if _same_scalar(theirs, known[key]):
                return mine
            note += f", base={_shown(known[key])}"
        log.append(note)
        return theirs if prefer_remote else mine

    # Shared keys are visited in the remote order, which fixes the order of the messages.
    picked = {k: pick(k) for k in _keys_in_order(remote) if k in local}
    return {**local, **picked, **{k: v for k, v in remote.items() if k not in picked}}


def _as_object(value) -> dict:
    """A top-level array or string merges by index; other scalars have no fields."""
    if isinstance(value, dict):
        return value
    return {str(i): v for i, v in enumerate(value)} if isinstance(value, (list, str)) else {}


def _merge_pair(local: str, remote: str, base: str | None, prefer_remote: bool):
    try:
        mine, theirs = _load(local), _load(remote)
        known = _load(base) if base else None
    except (ValueError, RecursionError):
        return None, []
    fields = _as_object(theirs)
    if fields and not isinstance(mine, (dict, list)):
        return None, []
    log: list[str] = []
    return _text(_merge_objects(_as_object(mine), fields, known, prefer_remote, "", log), "\n"), log


def json_merge_column(local: Column, remote: Column, base: Column, prefer_remote: bool = False) -> Column:
    """`struct(merged, conflicts)`; `merged` is null where a side is null or does not parse."""

    @F.pandas_udf(_RESULT)
    def merge(local: pd.Series, remote: pd.Series, base: pd.Series) -> pd.DataFrame:
        rows = [
            (None, []) if mine is None or theirs is None else _merge_pair(mine, theirs, known, prefer_remote)
            for mine, theirs, known in zip(local, remote, base)
        ]
        return pd.DataFrame(rows, columns=["merged", "conflicts"])

    return merge(local, remote, base)


def merge_json(df: DataFrame, prefer_remote: bool = False, with_base: bool = True) -> DataFrame:
    """Adds `merged` (text, null if a side does not parse), `conflicts` and `has_conflicts`.

    Objects merge key by key, arrays become the local items plus the remote items not among them, and
    scalars take the side that changed from the base. Without a base for a key any difference is a
    conflict, and the local value stands unless `prefer_remote`.
    """
    known = F.col("base") if with_base and "base" in df.columns else F.lit(None).cast("string")
    out = df.withColumn("_j", json_merge_column(F.col("local"), F.col("remote"), known, prefer_remote))
    return (
        out.withColumn("merged", F.col("_j.merged"))
        .withColumn("conflicts", F.col("_j.conflicts"))
        .withColumn("has_conflicts", F.size("_j.conflicts") > 0)
        .drop("_j")
    )


def _depth(column: str) -> Column:
    """The deepest nesting of braces in a JSON text, strings aside; no step of it looks back, so long strings are no burden."""
    plain = F.replace(F.replace(F.col(column), F.lit("\\\\"), F.lit("")), F.lit('\\"'), F.lit(""))
    braces = F.regexp_replace(F.regexp_replace(plain, '"[^"]*"', ""), "[^{}]+", "")
    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))

    def step(a: Column, brace: Column) -> Column:
        now = a.now + F.when(brace == "{", 1).when(brace == "}", -1).otherwise(0)
        return F.struct(now.alias("now"), F.greatest(a.most, now).alias("most"))

    return F.aggregate(F.split(braces, ""), start, step).getField("most")


def json_depth(df: DataFrame, *columns: str) -> int:
    """The deepest nesting of braces in columns of JSON texts, strings aside. One number comes to the driver."""
    return max(n or 0 for n in df.agg(*[F.max(_depth(c)) for c in columns]).first())


# A key as one step of a path: dots and backslashes inside it are escaped, so `a.b` is not `b` in `a`.
_STEP = r"replace(replace(key, '\\', '\\\\'), '.', '\\.')"


def json_leaves(df: DataFrame, key: str, column: str, depth: int | None = None) -> DataFrame:
    """`(key, json_path, kind, value)` for every field that is not an object, however deep.

    `json_path` joins keys by dots; a dot or backslash of a key has a backslash before it.
    `kind` is string, number, boolean, null or array. Rows that do not parse as an object give nothing. Numbers
    show their double value, so 1 and 1.0 agree. Each level unfolds what may be an object and passes everything else on, so
    nothing is shuffled; what gave no keys is known as a leaf from then on, so kinds are read once, from leaves alone. The levels are as many as the deepest text needs, which one pass measures first; a
    caller who knows an upper bound passes it as `depth`. Objects below that stay whole, as kind object.
    """
    if depth is None:
        depth = json_depth(df, column)
    unfold = df.sparkSession.tvf.variant_explode_outer(F.col("_object").outer())
    level = df.select(F.col(key), F.lit(None).cast("string").alias("_at"), F.try_parse_json(column).alias("_v"), F.lit(False).alias("_leaf"))
    level = level.filter(F.col("_v").isNotNull() & F.col(column).rlike(r"\A\s*\{"))
    for _ in range(depth):
        level = (
            level.withColumn("_object", F.expr("CASE WHEN NOT _leaf THEN _v END"))
            .lateralJoin(unfold)
            .filter("key IS NOT NULL OR coalesce(pos, 0) = 0")  # an array is a leaf: the first of its items stands for it
            .selectExpr(
                f"`{key}`",
                f"CASE WHEN key IS NULL THEN _at WHEN _at IS NULL THEN {_STEP} ELSE concat(_at, '.', {_STEP}) END AS _at",
                "CASE WHEN key IS NULL THEN _v ELSE value END AS _v",
                "key IS NULL AS _leaf",
            )
        )
    level = level.withColumn("schema", F.schema_of_variant("_v")).filter("NOT (_leaf AND startswith(schema, 'OBJECT'))")  # empty objects
    kind = """CASE WHEN schema = 'VOID' THEN 'null' WHEN schema = 'STRING' THEN 'string' WHEN schema = 'BOOLEAN' THEN 'boolean'
        WHEN schema LIKE 'ARRAY%' THEN 'array' WHEN schema LIKE 'OBJECT%' THEN 'object' ELSE 'number' END"""
    value = "CASE kind WHEN 'number' THEN CAST(try_variant_get(_v, '$', 'double') AS STRING) ELSE to_json(_v) END AS value"
    kinds = level.selectExpr(f"`{key}`", "_at AS json_path", "_v", f"{kind} AS kind")
    return kinds.selectExpr(f"`{key}`", "json_path", "kind", value)


def merge_json_leaves(local: DataFrame, remote: DataFrame, key: str, prefer_remote: bool = False) -> DataFrame:
    """Leaf rows of two documents side by side: `(key, json_path, value, conflict)`.

    Takes frames of `json_leaves`. Without a base, a scalar that differs is a conflict; two arrays are
    united and never conflict.
    """
    mine = local.select(key, "json_path", F.col("kind").alias("_lk"), F.col("value").alias("_lv"))
    theirs = remote.select(key, "json_path", F.col("kind").alias("_rk"), F.col("value").alias("_rv"))
    both = F.col("_lk").isNotNull() & F.col("_rk").isNotNull()
    arrays = (F.col("_lk") == "array") & (F.col("_rk") == "array")
    differs = both & ~arrays & ~(F.col("_lk").eqNullSafe(F.col("_rk")) & F.col("_lv").eqNullSafe(F.col("_rv")))
    items = lambda c: F.from_json(F.col(c), "array<variant>")
    texts = lambda c: F.transform(items(c), lambda v: F.to_json(v))
    mine_items, their_items = texts("_lv"), texts("_rv")
    united = F.concat(
        F.lit("["), F.array_join(F.concat(mine_items, F.array_except(their_items, mine_items)), ","), F.lit("]")
    )
    first, second = ("_rv", "_lv") if prefer_remote else ("_lv", "_rv")
    return mine.join(theirs, [key, "json_path"], "full_outer").select(
        key,
        "json_path",
        F.when(both & arrays, united).otherwise(F.coalesce(first, second)).alias("value"),
        F.coalesce(differs, F.lit(False)).alias("conflict"),
    )
