"""Three-way text and front-matter merge as column expressions.

Each works inside one row, on the lines of one document, so merging needs no shuffle and its memory
is bounded by the document.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.functions.core import let, trim_all

_MERGED = "struct<merged:string,conflict:boolean>"


def _result(text: Column, conflict: Column) -> Column:
    return F.struct(text.alias("merged"), conflict.alias("conflict")).cast(_MERGED)


def _line(base: Column, local: Column, remote: Column) -> Column:
    """One merged line and whether it is a conflict; a missing line counts as a blank one."""
    block = F.concat(
        F.lit(K.CONFLICT_OPEN + "\n"), local, F.lit("\n" + K.CONFLICT_MIDDLE + "\n"), remote,
        F.lit("\n" + K.CONFLICT_CLOSE),
    )
    taken = F.when((local == remote) | (remote == base), local).when(local == base, remote)
    return F.struct(F.coalesce(taken, block).alias("text"), taken.isNull().alias("clash"))


def _merge_lines(base: Column, local: Column, remote: Column) -> Column:
    blank = F.lit("")
    split = [F.split(side, "\n", -1).alias(name) for side, name in ((base, "b"), (local, "l"), (remote, "r"))]

    def lines(s: Column) -> Column:
        longer = F.greatest(F.size(s["l"]), F.size(s["r"]))
        return F.transform(
            F.slice(F.arrays_zip(s["b"], s["l"], s["r"]), F.lit(1), longer),
            lambda z: _line(*[F.coalesce(z.getField(side), blank) for side in ("b", "l", "r")]),
        )

    def joined(merged: Column) -> Column:
        text = F.array_join(F.transform(merged, lambda m: m["text"]), "\n")
        return _result(text, F.exists(merged, lambda m: m["clash"]))

    return let(let(F.struct(*split), lines), joined)


def three_way(base: Column, local: Column, remote: Column) -> Column:
    """`struct(merged, conflict)` by position: line i of one side meets line i of the others.

    A side equal to the base gives way to the other side whole; otherwise each line takes the side
    that changed, and a line both sides changed differently becomes a marked block. The lines of the
    result number as many as those of the longer side, so an insertion moves every later line.
    """
    base, local, remote = [F.coalesce(c, F.lit("")) for c in (base, local, remote)]
    return (
        F.when(local == base, _result(remote, F.lit(False)))
        .when(remote == base, _result(local, F.lit(False)))
        .otherwise(_merge_lines(base, local, remote))
    )


# The first line of front matter, and what ends it.
_OPEN = "---\n"
_CLOSE = "\n---\n"


def parts_of(text: Column) -> Column:
    """`struct(front, body)`: the block between a leading `---` line and the next one, and what follows.

    `front` is null where the text has no such block; the body is then the whole text.
    """

    def cut(end: Column) -> Column:
        found = text.startswith(_OPEN) & (end > 0)
        front = F.substr(text, F.lit(len(_OPEN) + 1), end - (len(_OPEN) + 1))
        return F.struct(
            F.when(found, front).alias("front"),
            F.when(found, F.substr(text, end + len(_CLOSE))).otherwise(text).alias("body"),
        )

    return let(F.locate(_CLOSE, text, len(_OPEN) + 1), cut)


def entries_of(front: Column) -> Column:
    """A front-matter block as an array of `struct(key, value)`, in order, repeated keys included.

    A line splits at its first colon; lines without one, or beginning with it, are dropped.
    """
    lines = F.coalesce(F.split(front, "\n", -1), F.array().cast("array<string>"))
    keyed = F.filter(lines, lambda line: F.locate(":", line) > 1)
    return F.transform(
        keyed,
        lambda line: F.struct(
            trim_all(F.substring_index(line, ":", 1)).alias("key"),
            trim_all(F.substr(line, F.locate(":", line) + 1)).alias("value"),
        ),
    )


def _keys(entries: Column) -> Column:
    return F.transform(entries, lambda e: e["key"])


def _last_value(entries: Column, key: Column) -> Column:
    """Value of the last entry with this key, null if there is none."""
    return F.try_element_at(F.filter(entries, lambda e: e["key"] == key), F.lit(-1))["value"]


def is_index_key(key: Column) -> Column:
    """A whole number in plain digits, up to the largest index."""
    return key.rlike(r"\A(0|[1-9][0-9]{0,9})\z") & (key.try_cast("long") <= K.MAX_INDEX_KEY)


def index_keys_first(keys: Column) -> Column:
    """Keys that are whole numbers come first, ascending; the others keep their order."""
    numbers = F.array_sort(F.transform(F.filter(keys, is_index_key), lambda k: k.cast("long")))
    return F.concat(F.transform(numbers, lambda n: n.cast("string")), F.filter(keys, lambda k: ~is_index_key(k)))


def merge_entries(base: Column, local: Column, remote: Column) -> Column:
    """Front matter of three sides as one array of `struct(key, value)`.

    Base gives way to local and local to remote, the latter only where local lacks the key or left
    it as in the base. A key that a side deleted survives from the base.
    """

    def merged(b: Column, l: Column, r: Column) -> Column:
        keys = index_keys_first(F.array_distinct(F.concat(_keys(b), _keys(l), _keys(r))))

        def value(key: Column) -> Column:
            vb, vl, vr = _last_value(b, key), _last_value(l, key), _last_value(r, key)
            remote_wins = vr.isNotNull() & (vl.isNull() | (vl.eqNullSafe(vb)))
            return F.struct(
                key.alias("key"), F.when(remote_wins, vr).otherwise(F.coalesce(vl, vb)).alias("value")
            )

        return F.transform(keys, value)

    return let(
        F.struct(base.alias("b"), local.alias("l"), remote.alias("r")),
        lambda s: merged(s["b"], s["l"], s["r"]),
    )


def render_entries(entries: Column) -> Column:
    """The front-matter block of the entries, with a blank line after it; empty for none."""
    lines = F.transform(entries, lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return F.when(
        F.size(entries) > 0, F.concat(F.lit("---\n"), F.array_join(lines, "\n"), F.lit("\n---\n\n"))
    ).otherwise(F.lit(""))


def three_way_markdown(base: Column, local: Column, remote: Column) -> Column:
    """`struct(merged, conflict)`: front matter by key, body by line. Only the body can conflict."""
    sides = [parts_of(F.coalesce(c, F.lit(""))).alias(n) for c, n in ((base, "b"), (local, "l"), (remote, "r"))]

    def merged(s: Column) -> Column:
        entries = merge_entries(*[entries_of(s[n]["front"]) for n in ("b", "l", "r")])
        front = let(entries, render_entries)
        body = three_way(*[s[n]["body"] for n in ("b", "l", "r")])
        return let(body, lambda m: _result(F.concat(front, m["merged"]), m["conflict"]))

    return let(F.struct(*sides), merged)
