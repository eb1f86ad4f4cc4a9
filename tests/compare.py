"""Runs a registered query and its SQL side by side."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def plain(value):
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).hex()
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def spark_answer(df):
    return normal(df.columns, [tuple(r) for r in df.collect()])


def sql_answer(con, sql):
    cur = con.execute(sql)
    return normal([c[0] for c in cur.description], cur.fetchall())


# DuckDB type beside the Spark types that carry the same values.
SAME_TYPES = {
    "BIGINT": {"bigint"}, "INTEGER": {"int"}, "VARCHAR": {"string"}, "BOOLEAN": {"boolean"}, "DOUBLE": {"double"},
    "TIMESTAMP": {"timestamp", "timestamp_ntz"},
}


def type_gaps(df, con, sql):
    """Columns whose types differ between the two engines."""
    described = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    return {
        name: (kind, described.get(name))
        for name, kind in df.dtypes
        if kind not in SAME_TYPES.get(described.get(name), {described.get(name, "").lower()})
    }
