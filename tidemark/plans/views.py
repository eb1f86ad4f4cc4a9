"""The registered queries' inputs, derived from the given tables.

Documents become files, labels and pages decide what changed between two snapshots, conversations
become version histories and events become change events. Nothing is left out by id: assignments by
number only decide how a row looks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.core import utc_instant
from tidemark.functions.paths import doc_key
from tidemark.operators.audit import audit_rows
from tidemark.operators.chunks import chunk_files, file_documents, with_chunk_id, with_hash
from tidemark.session import spread

BASE_MS = 1_704_067_200_000  # 2024-01-01T00:00:00Z
END_MS = BASE_MS + 31 * 86_400_000
CHUNK = 1_024


def read(spark: SparkSession, sf_dir: str, table: str, *spread_by: str) -> DataFrame:
    """A given table; with `spread_by`, hashed over the cores if its scan has too few tasks."""
    df = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    return spread(df, *spread_by) if spread_by else df


def _stamp(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def _ext(number: Column) -> Column:
    return F.when(number == 0, "md").when(number == 1, "txt").when(number == 2, "json").otherwise("png")


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`(n, doc_id, path, content, mtime, lang, source)` of every document."""
    d = read(spark, sf_dir, "documents", "doc_id")
    n = F.col("doc_id")
    folder = F.lpad(((n * 7) % 230).cast("string"), 3, "0")
    path = F.concat(folder, F.lit("/"), "source", F.lit("/"), n.cast("string"), F.lit("."), _ext(n % 4))
    return d.select(
        n.alias("n"),
        path.alias("path"),
        F.col("text").alias("content"),
        _stamp(F.lit(BASE_MS) + n * 1000).alias("mtime"),
        "lang",
        "source",
    ).select("n", doc_key("path").alias("doc_id"), "path", "content", "mtime", "lang", "source")


def snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Previous and current listings `(path, hash, mtime, content)`.

    Toxic documents are gone, documents of low quality are edited, those of high quality are only
    touched, and every page is new.
    """
    old = files(spark, sf_dir)
    labels = read(spark, sf_dir, "labels").withColumnRenamed("doc_id", "n")
    marked = old.join(labels, "n", "left")
    edited = F.col("quality") == 0
    kept = marked.filter(F.coalesce(F.col("toxic"), F.lit(0)) == 0).select(
        "path",
        F.when(edited, F.concat("content", F.lit("\nedited"))).otherwise(F.col("content")).alias("content"),
        F.when(F.col("quality").isNotNull(), F.col("mtime") + F.expr("INTERVAL 1 HOUR"))
        .otherwise(F.col("mtime"))
        .alias("mtime"),
    )
    pages = read(spark, sf_dir, "pages").select(
        F.concat(F.lit("200/pages/"), F.col("page_id").cast("string"), F.lit(".html")).alias("path"),
        F.col("html").alias("content"),
        _stamp(F.lit(BASE_MS) + F.col("page_id") * 1000).alias("mtime"),
    )
    cols = ["path", "hash", "mtime", "content"]
    return with_hash(old).select(cols), with_hash(kept.unionByName(pages)).select(cols)


def _swap_line(text: Column, which: str, prefix: str) -> Column:
    """The text with a word put before its first or last line."""
    if which == "first":
        return F.concat(F.lit(prefix), text)
    last = F.substring_index(text, "\n", -1)
    return F.concat(F.left(text, F.length(text) - F.length(last)), F.lit(prefix), last)


def merge_sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`(n, doc_id, path, lang, source, base, local, remote, local_mtime, remote_mtime)`.

    Local changes the first line of even documents; remote changes the last line of every third
    document and the first line of every fifteenth, so some edits collide.
    """
    f = files(spark, sf_dir)
    n, text = F.col("n"), F.col("content")
    local = F.when(n % 2 == 0, _swap_line(text, "first", "local ")).otherwise(text)
    remote = F.when(n % 15 == 0, _swap_line(text, "first", "remote ")).when(
        n % 3 == 0, _swap_line(text, "last", "remote ")
    ).otherwise(text)
    return f.select(
        "n",
        "doc_id",
        "path",
        "lang",
        "source",
        text.alias("base"),
        local.alias("local"),
        remote.alias("remote"),
        F.col("mtime").alias("local_mtime"),
        (_stamp(F.lit(BASE_MS) + n * 1000 + ((n % 3) - 1) * 60_000)).alias("remote_mtime"),
    )


def replicas(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Local files and remote documents (with hash, size, version) of the same keys.

    The remote side holds the documents that have a label; the others are new.
    """
    sides = merge_sides(spark, sf_dir)
    local = with_hash(
        sides.select("n", "doc_id", "path", F.col("local").alias("content"), F.col("local_mtime").alias("mtime"))
    )
    labels = read(spark, sf_dir, "labels").select(F.col("doc_id").alias("n"), "quality")
    remote = with_hash(
        sides.select("n", "doc_id", "path", F.col("remote").alias("content"), F.col("remote_mtime").alias("mtime"))
        .join(labels, "n")
        .withColumn("version", (F.col("quality") + 1).cast("int"))
    )
    return local, remote


def front_matter_sides(spark: SparkSession, sf_dir: str, *kept: str) -> DataFrame:
    """Merge sides whose texts begin with front matter that differs from side to side; `kept` names further columns of theirs."""
    sides = merge_sides(spark, sf_dir)
    n = F.col("n")

    def head(title: Column, lang: Column, extra: Column) -> Column:
        return F.concat(F.lit("---\ntitle: "), title, F.lit("\nlang : "), lang, F.lit("\nno colon here\n"), extra, F.lit("---\n"))

    none = F.lit("")
    tag = F.concat(F.lit("link: http://x/"), n.cast("string"), F.lit("\n"))
    base = head(F.col("source"), F.col("lang"), F.when(n % 5 == 0, tag).otherwise(none))
    mine = head(F.when(n % 2 == 0, F.concat(F.lit("my "), "source")).otherwise(F.col("source")), F.col("lang"), none)
    theirs = head(
        F.when(n % 3 == 0, F.concat(F.lit("their "), "source")).otherwise(F.col("source")),
        F.lit("xx"),
        F.concat(F.lit("added: "), n.cast("string"), F.lit("\ntitle2: a: b\n")),
    )
    return sides.select(
        "n", "path", *kept,
        F.concat(base, "base").alias("base"),
        F.concat(mine, "local").alias("local"),
        F.concat(theirs, "remote").alias("remote"),
    )


def json_sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`(o_orderkey, local, remote, base)`: orders with their customer as nested JSON, edited on both sides."""
    o = read(spark, sf_dir, "orders", "o_orderkey")
    c = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    k = F.col("o_orderkey")
    joined = o.join(c, "o_custkey", "left")

    def doc(status: Column, segment: Column, tags: Column, **more: Column) -> Column:
        extra = [v.alias(name) for name, v in more.items()]
        return F.to_json(
            F.struct(
                F.col("o_custkey").alias("cust"),
                status.alias("status"),
                F.struct(F.col("c_name").alias("name"), segment.alias("segment")).alias("customer"),
                tags.alias("tags"),
                *extra,
            )
        )

    status, segment, priority = F.col("o_orderstatus"), F.col("c_mktsegment"), F.col("o_orderpriority")
    return joined.select(
        "o_orderkey",
        doc(status, segment, F.array(status, priority)).alias("base"),
        doc(F.when(k % 2 == 0, F.lit("L")).otherwise(status), segment, F.array(status, priority), mine=k).alias("local"),
        doc(
            F.when(k % 3 == 0, F.lit("R")).otherwise(status),
            F.when(k % 4 == 0, F.lit("moved")).otherwise(segment),
            F.array(priority, F.lit("new")),
            theirs=k,
        ).alias("remote"),
    )


def version_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`(doc_id, path, version, mtime, hash, source, conflict, content)`: each turn is one version of a file."""
    c = read(spark, sf_dir, "conversations")
    path = F.concat(F.lpad((F.col("conv_id") % 210).cast("string"), 3, "0"), F.lit("/Conv-"), F.col("conv_id").cast("string"), F.lit(".md"))
    return with_hash(
        c.select(
            path.alias("path"),
            doc_key(path).alias("doc_id"),
            (F.col("turn") + 1).cast("int").alias("version"),
            _stamp(F.lit(BASE_MS) + F.col("conv_id") * 60_000 + F.col("turn") * 1000).alias("mtime"),
            F.when(F.col("role") == "user", "local").otherwise("remote").alias("source"),
            (F.col("role") == "system").alias("conflict"),
            F.col("text").alias("content"),
        )
    )


def change_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`(path, event, ts, seq, schedule)` of every event."""
    e = read(spark, sf_dir, "events", "event_id")
    user = F.col("user_id")
    kind = F.when(F.col("event_type") == "signup", "add").when(F.col("event_type") == "error", "unlink").otherwise("change")
    path = F.concat(F.lpad((user % 230).cast("string"), 3, "0"), F.lit("/u"), user.cast("string"), F.lit(".md"))
    return e.select(
        path.alias("path"),
        kind.alias("event"),
        utc_instant("ts").alias("ts"),
        F.col("event_id").alias("seq"),
        F.concat(F.lit("s"), user.cast("string")).alias("schedule"),
    )


# One cron form per remainder of the key; the last three can never fire or are invalid.
CRON_FORMS = (
    "0 * * * *", "30 6 * * *", "0 9-17 * * 1-5", "*/15 8,20 * * *", "5,35 */6 1,15 * *",
    "0 0 31 * *", "10 12 * 2 *", "0 25 * * *", "5-1 * * * *", "invalid cron",
)


def _schedules(key: Column, name: Column, df: DataFrame) -> DataFrame:
    form = F.element_at(F.array(*[F.lit(c) for c in CRON_FORMS]), (key % len(CRON_FORMS) + 1).cast("int"))
    is_interval = key % 3 == 0
    return df.select(
        name.alias("name"),
        F.when(is_interval, "interval").otherwise("cron").alias("type"),
        F.when(is_interval, (key % 5 + 1) * 3 * 3_600_000).cast("long").alias("interval_ms"),
        F.when(~is_interval, form).alias("cron"),
        (key % 11 != 5).alias("enabled"),
    )


def user_schedules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A schedule for every user of the events table.

    The key comes out of the grouping as a value, so tests on a schedule run once per user and do not
    move below the grouping to run once per event.
    """
    users = read(spark, sf_dir, "events").groupBy("user_id").agg(F.max("user_id").alias("user"))
    return _schedules(F.col("user"), F.concat(F.lit("s"), F.col("user").cast("string")), users)


def nation_schedules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A schedule for every nation."""
    n = read(spark, sf_dir, "nation")
    return _schedules(F.col("n_nationkey"), F.col("n_name"), n)


def mixed_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mixed dump: file documents, their chunks, and pages that are neither.

    `(doc_id, path, type, children, size, data, deleted, mtime)`; the chunks of a file repeat where
    texts repeat. Toxic documents are tombstones, and pages carry no type.
    """
    f = files(spark, sf_dir)
    labels = read(spark, sf_dir, "labels").select(F.col("doc_id").alias("n"), "toxic")
    docs = file_documents(f, CHUNK).select(
        "doc_id", "path", "type", "children", "size", F.lit(None).cast("binary").alias("data"), "mtime"
    )
    gone = f.join(labels, "n").filter(F.col("toxic") == 1).select("doc_id", F.lit(True).alias("deleted"))
    docs = docs.join(gone, "doc_id", "left").withColumn("deleted", F.coalesce("deleted", F.lit(False)))
    pieces = with_chunk_id(chunk_files(f, CHUNK)).dropDuplicates(["chunk_id"])
    chunks = pieces.select(
        F.col("chunk_id").alias("doc_id"), F.lit(None).cast("string").alias("path"), F.lit("leaf").alias("type"),
        F.lit(None).cast("array<string>").alias("children"), F.lit(None).cast("long").alias("size"), "data",
        F.lit(None).cast("timestamp").alias("mtime"), F.lit(False).alias("deleted"),
    )
    pages = read(spark, sf_dir, "pages").select(
        F.concat(F.lit("page-"), F.col("page_id").cast("string")).alias("doc_id"), F.col("url").alias("path"),
        F.lit(None).cast("string").alias("type"), F.lit(None).cast("array<string>").alias("children"),
        F.octet_length("html").cast("long").alias("size"), F.col("html").cast("binary").alias("data"),
        F.lit(None).cast("timestamp").alias("mtime"), F.lit(False).alias("deleted"),
    )
    return docs.unionByName(chunks).unionByName(pages)


def audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An audit row for every event."""
    e = read(spark, sf_dir, "events").withColumn("at", utc_instant("ts"))
    kind = F.when(F.col("event_type") == "error", "error").when(F.col("event_type") == "signup", "init").when(
        F.col("event_type") == "view", "pull_vault").otherwise("sync_file")
    user = F.col("user_id")
    return audit_rows(
        e,
        action=kind,
        status=F.when(F.col("event_type") == "error", "error").otherwise("success"),
        message=F.concat(F.lit("event "), F.col("event_type")),
        ts="at",
        seq="event_id",
        path=F.when(F.col("event_type") != "view", F.concat(F.lit("u"), user.cast("string"), F.lit(".md"))),
        scope=F.when(user % 7 != 0, F.lpad((user % 230).cast("string"), 3, "0")),
    )
