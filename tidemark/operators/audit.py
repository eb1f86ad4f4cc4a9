"""Audit rows: build, render, trim and read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.functions.core import iso_millis

_COLUMNS = ("ts", "seq", "action", "path", "status", "message", "scope")


def _value(value: str | Column | None) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("string")


def audit_rows(
    df: DataFrame,
    action: str | Column,
    status: str | Column,
    message: str | Column,
    ts: str | Column = "ts",
    seq: str | Column = "seq",
    path: str | Column | None = None,
    scope: str | Column | None = None,
) -> DataFrame:
    """Audit rows of a frame, stamped with its own event time and order number."""
    if isinstance(action, str) and action not in K.AUDIT_ACTIONS:
        raise ValueError(f"unknown action {action!r}")
    if isinstance(status, str) and status not in ("success", "error"):
        raise ValueError(f"unknown status {status!r}")
    stamp, number = [F.col(c) if isinstance(c, str) else c for c in (ts, seq)]
    return df.select(
        stamp.alias("ts"),
        number.cast("long").alias("seq"),
        _value(action).alias("action"),
        _value(path).alias("path"),
        _value(status).alias("status"),
        _value(message).alias("message"),
        _value(scope).alias("scope"),
    )


def audit_lines(df: DataFrame) -> DataFrame:
    """One printed line per row: time, action, scope if any, OK or ERROR, path if any, message."""
    def part(name: str, before: str, after: str = "") -> Column:
        filled = F.coalesce(F.col(name), F.lit("")) != ""
        return F.when(filled, F.concat(F.lit(before), F.col(name), F.lit(after))).otherwise("")

    verdict = F.when(F.col("status") == "error", " ERROR:").otherwise(" OK:")
    line = F.concat(
        F.lit("["), iso_millis("ts"), F.lit("] ["), F.col("action"), F.lit("]"),
        part("scope", " [", "]"), verdict, part("path", " "), F.lit(" "), F.coalesce("message", F.lit("")),
    )
    return df.select("ts", "seq", line.alias("line"))


def retain_audit(df: DataFrame, n: int = K.KEPT_AUDIT_ROWS, per: str | None = None) -> DataFrame:
    """The newest `n` rows, of the whole log or of each value of `per`.

    Both forms cut inside each map task before rows move.
    """
    newest = [F.col("ts").desc(), F.col("seq").desc()]
    if per is None:
        return df.orderBy(*newest).limit(n)
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(per).orderBy(*newest)))
    return ranked.filter(F.col("_rank") <= n).drop("_rank")


def audit_log(df: DataFrame) -> DataFrame:
    """The log in time order."""
    return df.select(*_COLUMNS).orderBy("ts", "seq")
