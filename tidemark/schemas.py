"""Table schemas."""

from pyspark.sql import types as T

VERSION_ENTRY = T.StructType([
    T.StructField("version", T.IntegerType()),
    T.StructField("mtime", T.TimestampType()),
    T.StructField("hash", T.StringType()),
    T.StructField("doc_id", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("conflict", T.BooleanType()),
])

FILES = T.StructType([
    T.StructField("doc_id", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("children", T.ArrayType(T.StringType())),
    T.StructField("ctime", T.TimestampType()),
    T.StructField("mtime", T.TimestampType()),
    T.StructField("size", T.LongType()),
    T.StructField("hash", T.StringType()),
    T.StructField("version", T.IntegerType()),
    T.StructField("type", T.StringType()),
    T.StructField("deleted", T.BooleanType()),
    T.StructField("archived", T.BooleanType()),
    T.StructField("reverted_from", T.IntegerType()),
    T.StructField("data", T.BinaryType()),
    T.StructField("versions", T.ArrayType(VERSION_ENTRY)),
])

CHUNKS = T.StructType([
    T.StructField("chunk_id", T.StringType()),
    T.StructField("data", T.BinaryType()),
])

SYNC_STATE = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("hash", T.StringType()),
    T.StructField("mtime", T.TimestampType()),
])

CHANGE_EVENTS = T.StructType([
    T.StructField("event", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("seq", T.LongType()),
])

AUDIT = T.StructType([
    T.StructField("ts", T.TimestampType()),
    T.StructField("seq", T.LongType()),
    T.StructField("action", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("scope", T.StringType()),
])

SCOPES = T.StructType([
    T.StructField("agent", T.StringType()),
    T.StructField("prefix", T.StringType()),
])

SCHEDULES = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("interval_ms", T.LongType()),
    T.StructField("cron", T.StringType()),
    T.StructField("enabled", T.BooleanType()),
])
