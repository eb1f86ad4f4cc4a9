"""Cron fields as array expressions.

A field is `*`, a number, a list, a range `a-b` or a step `*/n`. It expands to the sorted values it
stands for; a field that cannot be read is empty and never fires. Of a list, only the readable items
count. Minute, hour and day of month are read, month and weekday on request.

The expressions are long, so they are stated as SQL text, which Spark parses in one call.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lowest and highest value of each field, in order.
FIELD_BOUNDS = {"minutes": (0, 59), "hours": (0, 23), "days": (1, 31), "months": (1, 12), "weekdays": (0, 6)}


def _whole(text: str) -> str:
    """A whole number, 0 for empty text, null for anything else."""
    return rf"(CASE WHEN {text} = '' THEN 0 WHEN {text} RLIKE r'\A\+?[0-9]{{1,9}}\z' THEN CAST({text} AS INT) END)"


def _item(p: str, low: int, high: int) -> str:
    """Values of one item of a list. A step that is no number keeps the lowest value alone."""
    first, last, step = (_whole(f"split_part({p}, '{mark}', {at})") for mark, at in (("-", 1), ("-", 2), ("/", 2)))
    value = _whole(p)
    return f"""CASE
        WHEN {p} = '*' THEN sequence({low}, {high})
        WHEN contains({p}, '-') AND {first} >= {low} AND {last} <= {high} AND {first} <= {last}
          THEN sequence({first}, greatest({first}, {last}))
        WHEN split_part({p}, '/', 1) = '*' AND contains({p}, '/') THEN
          CASE WHEN {step} IS NULL THEN array({low})
               WHEN {step} >= 1 THEN sequence({low}, {high}, greatest({step}, 1)) END
        WHEN NOT contains({p}, '/') AND {value} BETWEEN {low} AND {high} THEN array({value}) END"""


def field_values(fields: str, at: int, low: int, high: int) -> Column:
    """Sorted distinct values of one field of the array column `fields`, empty if it cannot be read."""
    items = f"transform(split(get({fields}, {at}), ',', -1), p -> coalesce({_item('p', low, high)}, array()))"
    return F.expr(f"array_sort(array_distinct(flatten(CAST({items} AS ARRAY<ARRAY<INT>>))))")


def cron_fields(column: str) -> Column:
    """The fields between runs of white space; fewer than five make the expression invalid."""
    return F.expr(rf"split(regexp_replace({column}, r'\A\s+|\s+\z', ''), r'\s+')")
