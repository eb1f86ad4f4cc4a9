"""Chunk store, scans and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog import shared_sql  # noqa: F401
from tidemark.catalog.registry import register
from tidemark.operators import chunks as C
from tidemark.operators import diff as D
from tidemark.operators.filters import with_is_binary
from tidemark.plans import views as W
from tidemark.session import work_dir
from tidemark.sources import payload, scan, sinks


def _pieces(spark, d, key="n"):
    return C.with_chunk_id(C.chunk_files(W.files(spark, d), W.CHUNK, key=key))


def _labelled(spark, d):
    return W.read(spark, d, "labels").select(F.col("doc_id").alias("n"))


def _store(spark, d):
    """Chunks of the labelled documents: a store that holds part of what the files need."""
    some = W.files(spark, d).join(_labelled(spark, d), "n", "left_semi")
    return C.with_chunk_id(C.chunk_files(some, W.CHUNK)).select("chunk_id", "data").dropDuplicates(["chunk_id"])


@register(
    "SELECT n, pos, octet_length(piece)::BIGINT AS bytes, chunk_id FROM v_chunks",
    uses=("v_chunks",),
)
def chunk_files(spark, d):
    return _pieces(spark, d).select(
        "n", F.col("pos").cast("long").alias("pos"), F.octet_length("data").cast("long").alias("bytes"), "chunk_id"
    )


@register(
    "SELECT chunk_id, count(*) AS refs, max(octet_length(piece))::BIGINT AS bytes FROM v_chunks GROUP BY chunk_id",
    uses=("v_chunks",),
)
def chunk_ids(spark, d):
    narrow = _pieces(spark, d).select("chunk_id", F.octet_length("data").cast("long").alias("bytes"))
    return narrow.groupBy("chunk_id").agg(F.count("*").alias("refs"), F.max("bytes").alias("bytes"))


@register(
    "SELECT count(*) AS chunks, count(DISTINCT chunk_id) AS ids, count(*) AS prefixed FROM v_chunks",
    uses=("v_chunks",),
)
def chunk_ids_compact(spark, d):
    ids = C.with_chunk_id(C.chunk_files(W.files(spark, d), W.CHUNK), algo="xxh64").groupBy("chunk_id").agg(
        F.count("*").alias("refs")
    )
    return ids.agg(
        F.sum("refs").cast("long").alias("chunks"),
        F.count("*").alias("ids"),
        F.sum(F.when(F.col("chunk_id").rlike(r"\Ah:\+[0-9a-z]{1,13}\z"), F.col("refs"))).cast("long").alias("prefixed"),
    )


@register(
    """SELECT chunk_id, max(octet_length(piece))::BIGINT AS bytes FROM v_chunks
       WHERE chunk_id NOT IN (SELECT chunk_id FROM v_chunks WHERE n IN (SELECT doc_id FROM labels)) GROUP BY chunk_id""",
    uses=("v_chunks",),
)
def new_chunks(spark, d):
    fresh = C.new_chunks(_pieces(spark, d), _store(spark, d))
    return fresh.select("chunk_id", F.octet_length("data").cast("long").alias("bytes"))


@register(
    "SELECT n, string_agg(chunk_id, ',' ORDER BY pos) AS children, count(*) AS chunks FROM v_chunks GROUP BY n",
    uses=("v_chunks",),
)
def children(spark, d):
    listed = C.children(_pieces(spark, d).select("n", "pos", "chunk_id"), key="n")
    return listed.select(
        "n", F.array_join("children", ",").alias("children"), F.size("children").cast("long").alias("chunks")
    )


@register(
    """SELECT doc_id, path, string_agg(chunk_id, ',' ORDER BY pos) AS children,
         max(octet_length(encode(content)))::BIGINT AS size, max(sha256(content)) AS hash
       FROM v_chunks JOIN v_files USING (n, doc_id) GROUP BY doc_id, path""",
    uses=("v_chunks",),
)
def file_documents(spark, d):
    docs = C.file_documents(W.files(spark, d), W.CHUNK)
    return docs.select("doc_id", "path", F.array_join("children", ",").alias("children"), "size", "hash")


def _summary(restored):
    return restored.select(
        "doc_id",
        F.sha2("content", 256).alias("hash"),
        F.octet_length("content").cast("long").alias("bytes"),
        F.col("n_chunks").cast("long").alias("n_chunks"),
        F.col("missing_chunks").cast("long").alias("missing_chunks"),
    )


@register(
    """SELECT doc_id, sha256(content) AS hash, octet_length(encode(content))::BIGINT AS bytes,
         greatest((octet_length(encode(content)) + 1023) // 1024, 1)::BIGINT AS n_chunks, 0::BIGINT AS missing_chunks
       FROM v_files""",
    uses=("v_files",),
)
def reassemble(spark, d):
    store = _pieces(spark, d).select("chunk_id", "data").dropDuplicates(["chunk_id"])
    return _summary(C.reassemble(C.file_documents(W.files(spark, d), W.CHUNK), store))


_PARTIAL = """
SELECT doc_id, sha256(unhex(string_agg(CASE WHEN held THEN hex(piece) END, '' ORDER BY pos))) AS hash,
  sum(CASE WHEN held THEN octet_length(piece) END)::BIGINT AS bytes, count(*) AS n_chunks,
  count(*) FILTER (NOT held) AS missing_chunks
FROM (SELECT *, chunk_id IN (SELECT chunk_id FROM v_chunks WHERE n IN (SELECT doc_id FROM labels)) AS held FROM v_chunks)
GROUP BY doc_id HAVING """


@register(_PARTIAL + "count(*) FILTER (held) > 0", uses=("v_chunks",))
def reassemble_missing(spark, d):
    return _summary(C.reassemble(C.file_documents(W.files(spark, d), W.CHUNK), _store(spark, d)))


@register(_PARTIAL + "count(*) FILTER (NOT held) = 0", uses=("v_chunks",))
def reassemble_strict(spark, d):
    return _summary(C.reassemble(C.file_documents(W.files(spark, d), W.CHUNK), _store(spark, d), strict=True))


@register(
    """SELECT doc_id, sha256(content) AS hash, octet_length(encode(content))::BIGINT AS bytes FROM v_files
       UNION ALL
       SELECT 'page-' || page_id, sha256(html), octet_length(encode(html))::BIGINT FROM pages""",
    uses=("v_files",),
)
def reassemble_inline(spark, d):
    docs = C.file_documents(W.files(spark, d), W.CHUNK).select(
        "doc_id", "path", "children", "size", F.lit(None).cast("binary").alias("data")
    )
    pages = W.read(spark, d, "pages").select(
        F.concat(F.lit("page-"), F.col("page_id").cast("string")).alias("doc_id"),
        F.col("url").alias("path"),
        F.array().cast("array<string>").alias("children"),
        F.octet_length("html").cast("long").alias("size"),
        F.col("html").cast("binary").alias("data"),
    )
    store = _pieces(spark, d).select("chunk_id", "data").dropDuplicates(["chunk_id"])
    return _summary(C.reassemble(docs.unionByName(pages), store)).select("doc_id", "hash", "bytes")


@register("SELECT n, sha256(content) AS hash FROM v_files", uses=("v_files",))
def decode_payload(spark, d):
    coded = with_is_binary(W.files(spark, d)).withColumn(
        "data",
        F.when(F.col("is_binary"), F.base64(F.encode("content", "UTF-8"))).otherwise(F.col("content")),
    )
    return payload.decode_payload(coded).select("n", F.sha2("data", 256).alias("hash"))


@register("SELECT n, sha256(content) AS hash FROM v_files", uses=("v_files",))
def content_hash(spark, d):
    return C.with_hash(W.files(spark, d)).select("n", "hash")


@register(
    """SELECT n, count(*) AS chunks, sum(octet_length(piece))::BIGINT AS bytes,
         count(*) FILTER (chunk_id NOT IN (SELECT chunk_id FROM v_chunks WHERE n IN (SELECT doc_id FROM labels))) AS new_chunks
       FROM v_chunks GROUP BY n""",
    uses=("v_chunks",),
)
def sync_totals(spark, d):
    return C.sync_totals(_pieces(spark, d), _store(spark, d), key="n")


@register(
    """SELECT sum(refs)::BIGINT AS chunks, count(*) AS distinct_chunks, sum(refs * b)::BIGINT AS bytes,
         sum(b)::BIGINT AS distinct_bytes, sum((refs - 1) * b)::BIGINT AS saved_bytes
       FROM (SELECT chunk_id, count(*) AS refs, max(octet_length(piece)) AS b FROM v_chunks GROUP BY chunk_id)""",
    uses=("v_chunks",),
)
def dedupe_report(spark, d):
    return C.store_totals(_pieces(spark, d))


@register(
    """SELECT count(*) AS chunks, true AS chunks_within, true AS kilobytes_within FROM v_chunks""",
    uses=("v_chunks",),
)
def store_sketch(spark, d):
    """Distinct chunks and kilobytes from sketches made by language and merged, beside the exact counts: within two in a hundred."""
    pieces = C.with_chunk_id(C.chunk_files(W.files(spark, d), W.CHUNK, key="lang"))
    told = C.sketch_totals(C.sketch_chunks(pieces, "lang"))
    exact = pieces.groupBy("chunk_id").agg(F.max(F.greatest(F.ceil(F.octet_length("data") / 1024), F.lit(1))).alias("k")).agg(
        F.count("*").alias("ids"), F.sum("k").alias("k"))
    near = lambda a, b: F.abs(a - b) <= 0.02 * b
    ids, k = exact.select("ids").scalar(), exact.select("k").scalar()
    return told.select("chunks", near(F.col("distinct_chunks"), ids).alias("chunks_within"), near(F.col("distinct_kilobytes"), k).alias("kilobytes_within"))


@register(
    """SELECT 'k=' || (doc_id // 50) AS folder, sha256(string_agg(text, chr(10) ORDER BY doc_id) || chr(10)) AS hash,
         (sum(strlen(text)) + count(*))::BIGINT AS size FROM documents GROUP BY doc_id // 50"""
)
def scan_files(spark, d):
    """A folder of text files, each of fifty documents in order, written and scanned."""
    out = work_dir(spark, "scan")
    texts = W.read(spark, d, "documents").select(F.expr("doc_id DIV 50").alias("k"), "doc_id", F.col("text").alias("value"))
    sorted_texts = texts.repartition("k").sortWithinPartitions("k", "doc_id").drop("doc_id")
    sorted_texts.write.partitionBy("k").text(out)
    found = scan.scan_files(spark, out)
    return found.select(F.split_part("path", F.lit("/"), F.lit(1)).alias("folder"), "hash", F.col("size").cast("long").alias("size"))


@register("SELECT lang, count(*) AS docs, sum(n_chars)::BIGINT AS chars FROM documents GROUP BY lang")
def read_docs(spark, d):
    docs = scan.read_docs(spark, f"{d}/documents.parquet")
    return docs.groupBy("lang").agg(F.count("*").alias("docs"), F.sum("n_chars").cast("long").alias("chars"))


@register(
    """SELECT doc_id, 'file' AS kind FROM v_files UNION ALL SELECT DISTINCT chunk_id, CASE WHEN octet_length(piece) > 0
         THEN 'chunk' ELSE 'ignored' END FROM v_chunks
       UNION ALL SELECT 'page-' || page_id, 'ignored' FROM pages""",
    uses=("v_chunks",),
)
def classify_docs(spark, d):
    return scan.classify_docs(W.mixed_docs(spark, d)).select("doc_id", "kind")


@register("SELECT 'page-' || page_id AS doc_id, 'file' AS kind FROM pages")
def classify_docs_fallback(spark, d):
    pages = W.read(spark, d, "pages").select(
        F.concat(F.lit("page-"), F.col("page_id").cast("string")).alias("doc_id"),
        F.lit(None).cast("string").alias("type"),
        F.lit(None).cast("array<string>").alias("children"),
        F.col("html").cast("binary").alias("data"),
    )
    return scan.classify_docs(pages, fallback=True).select("doc_id", "kind")


@register(
    "SELECT path, split_part(path, '/', 1) AS scope, sha256(content) AS hash FROM v_files", uses=("v_files",)
)
def write_files(spark, d):
    out = work_dir(spark, "files")
    sinks.write_files(W.files(spark, d).select("path", "content"), out)
    back = spark.read.schema("path string, content string, scope string").parquet(out)
    return back.select("path", "scope", F.sha2("content", 256).alias("hash"))


@register(
    "SELECT DISTINCT chunk_id, right(chunk_id, 1) AS bucket, octet_length(piece)::BIGINT AS bytes FROM v_chunks",
    uses=("v_chunks",),
)
def write_chunks(spark, d):
    out = work_dir(spark, "chunks")
    sinks.write_chunks(_pieces(spark, d).select("chunk_id", "data").dropDuplicates(["chunk_id"]), out, digits=1)
    return sinks.read_chunks(spark, out).select("chunk_id", "bucket", F.octet_length("data").cast("long").alias("bytes"))


@register(
    """SELECT coalesce(l.doc_id, r.doc_id) AS doc_id, (coalesce(r.version, 0) + CASE WHEN l.doc_id IS NULL THEN 0 ELSE 1 END)::INTEGER AS version,
         coalesce(r.mtime_ms - 5000, l.mtime_ms) AS ctime_ms, coalesce(l.mtime_ms, r.mtime_ms) AS mtime_ms,
         coalesce(l.hash, r.hash) AS hash, r.lang AS lang
       FROM (SELECT p.path AS doc_id, hash, mtime_ms FROM v_curr p) l
       FULL OUTER JOIN (SELECT v.path AS doc_id, v.version, v.mtime_ms, v.hash, f.lang FROM v_remote v JOIN v_files f USING (n)) r
         ON l.doc_id = r.doc_id""",
    uses=("v_curr", "v_remote"),
)
def upsert_docs(spark, d):
    _, remote = W.replicas(spark, d)
    lang = W.files(spark, d).select("n", "lang")
    current = remote.join(lang, "n").select(
        F.col("path").alias("doc_id"), "version", (F.col("mtime") - F.expr("INTERVAL 5 SECOND")).alias("ctime"),
        "mtime", "hash", "lang",
    )
    _, curr = W.snapshots(spark, d)
    incoming = curr.select(F.col("path").alias("doc_id"), F.col("mtime").alias("ctime"), "mtime", "hash")
    return D.upsert_docs(current, incoming).select(
        "doc_id", "version", F.unix_millis("ctime").alias("ctime_ms"), F.unix_millis("mtime").alias("mtime_ms"),
        "hash", "lang",
    )


@register("SELECT path, hash, mtime_ms FROM v_curr", uses=("v_curr",))
def update_state(spark, d):
    _, curr = W.snapshots(spark, d)
    return D.update_state(curr).select("path", "hash", F.unix_millis("mtime").alias("mtime_ms"))


@register("SELECT path, hash, mtime_ms FROM v_curr", uses=("v_curr",))
def save_and_load_state(spark, d):
    prev, curr = W.snapshots(spark, d)
    out = work_dir(spark, "state")
    sinks.save_state(prev, out, 1, W.BASE_MS)
    sinks.save_state(D.update_state(curr), out, 2, W.END_MS)
    return sinks.load_state(spark, out).select("path", "hash", F.unix_millis("mtime").alias("mtime_ms"))


@register("SELECT doc_id, path FROM v_files ORDER BY doc_id LIMIT 10", uses=("v_files",))
def preview_docs(spark, d):
    return scan.preview_docs(W.files(spark, d).select("doc_id", "path"))
