"""General column helpers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` computed once per row.

    A lambda that mentions an expression computes it again for every element; binding it to a
    one-element array first keeps line and key loops linear.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def as_bytes(column: Column | str) -> Column:
    """UTF-8 bytes of text; binary columns pass unchanged."""
    return (F.col(column) if isinstance(column, str) else column).cast("binary")


# Fixed value: every white-space character of the Unicode standard plus the byte-order mark.
_SPACE = r"[\s\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\ufeff]+"


def trim_all(column: Column) -> Column:
    """Strip every kind of white space, not only blanks."""
    return F.regexp_replace(column, f"^{_SPACE}|{_SPACE}\\z", "")


def epoch_ms(column: Column | str) -> Column:
    return F.unix_millis(column)


def iso_millis(column: Column | str) -> Column:
    """`2024-01-31T12:00:00.000Z` for an instant, whatever the session zone is."""
    ms = F.unix_millis(column)
    wall = F.timestamp_add("SECOND", F.floor(ms / 1000), F.lit("1970-01-01").cast("timestamp_ntz")).cast("string")
    return F.concat(F.replace(wall, F.lit(" "), F.lit("T")), F.lit("."), F.lpad(F.pmod(ms, F.lit(1000)).cast("string"), 3, "0"), F.lit("Z"))


def utc_instant(name: str) -> Column:
    """Instant of a zone-less timestamp column read as UTC, whatever the session zone is."""
    return F.timestamp_micros(F.expr(f"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01', {name})"))


def from_millis(value: int | Column) -> Column:
    return F.timestamp_millis(F.lit(value).cast("long"))
