"""Content-addressed chunk store.

Bytes cross the network once per step that cannot avoid it: chunking is map-only, dedupe and the
check against the store share one hash partitioning on `chunk_id`, and reassembly moves bytes once
to meet the references and once to their file.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.functions.core import as_bytes, let
from tidemark.functions.paths import doc_key
from tidemark.session import cut_lineage


# Folders of a stored chunk table are named by this many last digits of the chunk id.
BUCKET_DIGITS = 2


# Wanted ids up to the first number are written into the scan's own filter; up to the second they are broadcast, for up to
# so many groups of folders one after the other. So a fetch sends at most some twelve megabytes through the driver, whatever is wanted.
MAX_LISTED_IDS, MAX_BROADCAST_IDS, MAX_GROUPS = 1_000, 50_000, 2


def bucketed(df: DataFrame, digits: int = BUCKET_DIGITS) -> DataFrame:
    """Adds `bucket`, the last digits of the chunk id: the folder of a stored chunk."""
    return df.withColumn("bucket", F.right("chunk_id", F.lit(digits)))


def with_hash(df: DataFrame, content: str = "content") -> DataFrame:
    """Adds the SHA-256 of the whole content as `hash`."""
    return df.withColumn("hash", F.sha2(as_bytes(content), 256))


def chunk_files(
    df: DataFrame, size: int = K.CHUNK_BYTES, empty: str = "one", key: str = "doc_id", content: str = "content"
) -> DataFrame:
    """`(key, pos, data)` in pieces of `size` bytes.

    An empty file gives one empty chunk, or none with `empty="none"`. Only the key travels beside
    the pieces, so the full content is not copied into each output row.
    """
    if size < 1:
        raise ValueError("size must be at least 1")
    if empty not in ("one", "none"):
        raise ValueError("empty must be 'one' or 'none'")
    narrow = df.select(F.col(key), F.coalesce(as_bytes(content), F.lit(b"")).alias("_bytes"))
    if empty == "none":
        narrow = narrow.filter(F.octet_length("_bytes") > 0)
    last = F.greatest(F.ceil(F.octet_length("_bytes") / F.lit(size)).cast("int") - 1, F.lit(0))
    pieces = F.transform(
        F.sequence(F.lit(0), last),
        lambda i: F.substring(F.col("_bytes"), i * F.lit(size) + 1, F.lit(size)),
    )
    return narrow.select(key, F.posexplode(pieces).alias("pos", "data"))


def chunk_id(data: Column, algo: str = "sha256") -> Column:
    """SHA-256 of the bytes, or with `algo="xxh64"` a prefixed 64-bit hash in base 36."""
    if algo == "sha256":
        return F.sha2(data, 256)
    if algo == "xxh64":
        return F.concat(F.lit(K.CHUNK_ID_PREFIX), F.lower(F.conv(F.hex(F.xxhash64(data)), 16, 36)))
    raise ValueError(f"unknown chunk id algorithm {algo!r}")


def with_chunk_id(df: DataFrame, algo: str = "sha256", data: str = "data") -> DataFrame:
    """Adds `chunk_id`, the content address of each chunk."""
    return df.withColumn("chunk_id", chunk_id(F.col(data), algo))


def new_chunks(chunks: DataFrame, store: DataFrame, digits: int = BUCKET_DIGITS) -> DataFrame:
    """One row for each chunk the store does not hold yet; a chunk already held is simply left out.

    Copies are dropped inside each map task before the shuffle, so a chunk that makes up a third of
    the input ships once per task. The anti join then needs the ids of the store only, and where the
    store has a `bucket` (of `digits` digits), the folders of those buckets. Copies meet by the keys of
    that join, which so finds the bytes where they are.
    """
    on = ["bucket", "chunk_id"] if "bucket" in store.columns else ["chunk_id"]
    own = chunks.select("chunk_id", "data")
    unique = (bucketed(own, digits) if "bucket" in on else own).dropDuplicates(on)
    return unique.join(store.select(*on), on, "left_anti").select("chunk_id", "data")


def fetch(store: DataFrame, wanted: DataFrame, digits: int = BUCKET_DIGITS) -> DataFrame:
    """The rows of a stored chunk table whose `chunk_id` is wanted, in two steps: ids first, bytes for hits alone.

    The wanted ids are gathered first (this acts), up to `MAX_BROADCAST_IDS` in the driver. A few of them become a filter of the scan, which sorted ids
    and bloom filters answer without reading other row groups (see `sinks.write_chunks`). More are broadcast, those of a group of folders
    to the scan of these folders, so stored bytes are never shuffled before they are known to be wanted. Beyond
    `MAX_GROUPS` such groups the ids are joined, by folder and id, and the stored bytes of the wanted folders are shuffled for it. Folders without a wanted id are not read.
    A store without `bucket` is one folder.

    Meant for stored tables: a store or files that are still to be computed are computed for the ids as well.
    """
    if digits > 3:
        raise ValueError("at most three digits name a folder")
    has_folders = "bucket" in store.columns
    on = ["bucket", "chunk_id"] if has_folders else ["chunk_id"]
    ids = wanted.select("chunk_id").filter(F.col("chunk_id").isNotNull()).distinct()
    some = ids.limit(MAX_BROADCAST_IDS + 1).toArrow()  # at most some four megabytes
    if some.num_rows <= MAX_BROADCAST_IDS:
        known = some.column(0).to_pylist()
        named = store.filter(F.col("bucket").isin(sorted({i[-digits:] for i in known}))) if has_folders else store
        if len(known) <= MAX_LISTED_IDS:
            return named.filter(F.col("chunk_id").isin(known))
        return named.join(F.broadcast(store.sparkSession.createDataFrame(some)), "chunk_id", "left_semi").select(store.columns)
    ids = bucketed(ids, digits) if has_folders else ids
    by_folder = ids.groupBy("bucket" if has_folders else F.lit("").alias("bucket")).count().orderBy("bucket").collect()
    groups, room = [], 0
    for r in by_folder:
        if r["count"] > room:
            groups.append([])
            room = MAX_BROADCAST_IDS
        groups[-1].append(r["bucket"])
        room -= r["count"]
    if len(groups) > MAX_GROUPS or max(r["count"] for r in by_folder) > MAX_BROADCAST_IDS:
        there = store.filter(F.col("bucket").isin([r["bucket"] for r in by_folder])) if has_folders else store
        return there.join(ids, on, "left_semi").select(store.columns)
    ids, found = cut_lineage(ids), None
    for group in groups:
        own = F.col("bucket").isin(group) if has_folders else F.lit(True)
        part = store.filter(own).join(F.broadcast(ids.filter(own)), on, "left_semi").select(store.columns)
        found = part if found is None else found.unionByName(part)
    return found


def listed_ids(files: DataFrame) -> DataFrame:
    """`chunk_id` of every chunk that files list as their children."""
    return files.select(F.explode("children").alias("chunk_id"))


def children(df: DataFrame, key: str = "doc_id") -> DataFrame:
    """`(key, children)`: the ordered chunk ids of each file. A list is bounded by its file's size."""
    ordered = F.array_sort(F.collect_list(F.struct("pos", "chunk_id")))
    return df.groupBy(key).agg(F.transform(ordered, lambda c: c["chunk_id"]).alias("children"))


def child_ids(content: Column, size: int = K.CHUNK_BYTES, empty: str = "one", algo: str = "sha256") -> Column:
    """Ordered chunk ids of one content, computed in place, so listing children needs no shuffle."""

    def ids(raw: Column) -> Column:
        count = F.ceil(F.octet_length(raw) / F.lit(size)).cast("int")
        listed = F.transform(
            F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0))),
            lambda i: chunk_id(F.substring(raw, i * F.lit(size) + 1, F.lit(size)), algo),
        )
        return listed if empty == "one" else F.when(count > 0, listed).otherwise(F.array().cast("array<string>"))

    return let(F.coalesce(as_bytes(content), F.lit(b"")), ids)


def file_documents(
    files: DataFrame, size: int = K.CHUNK_BYTES, empty: str = "one", algo: str = "sha256"
) -> DataFrame:
    """File documents of raw files `(path, content, mtime)`, map-only."""
    raw = as_bytes("content")
    return files.select(
        doc_key("path").alias("doc_id"),
        "path",
        child_ids(raw, size, empty, algo).alias("children"),
        F.col("mtime").alias("ctime"),
        "mtime",
        F.octet_length(raw).cast("long").alias("size"),
        F.sha2(raw, 256).alias("hash"),
        F.lit("plain").alias("type"),
    )


def reassemble(
    files: DataFrame,
    chunks: DataFrame,
    strict: bool = False,
    empty_ok: bool = True,
    inline: str = "no_children",
    digits: int = BUCKET_DIGITS,
    hold: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """`(doc_id, path, content, n_chunks, missing_chunks)` for every file that has content.

    Chunks missing from the store are passed over and counted; `strict` drops such files instead.
    Inline `data` stands in for files without children or, with `inline="unresolved"`, for files of
    which no chunk was found. `empty_ok` restores a file of size 0 that has neither. A file is told by its
    key and path, so two files that share a key keep their own bytes (see `conflict.newest_docs` for one row per key).

    A chunk shared by many files is a hot key on the reference side. The references are computed once, and adaptive
    execution splits the tasks of such a key: the grouping by file shuffles anyway. Where the store has a `bucket` column (see `bucketed`) it
    joins the condition, so that only the folders of the wanted chunks are read. `hold` may store the references with their
    bytes and read them again, so that what the join has shuffled can go before the grouping shuffles in its turn.
    """
    if inline not in ("no_children", "unresolved"):
        raise ValueError("inline must be 'no_children' or 'unresolved'")
    on = ["bucket", "chunk_id"] if "bucket" in chunks.columns else ["chunk_id"]
    # The outer form, since the inner one adds a test on `children` that would compute them again.
    refs = files.select("doc_id", "path", F.posexplode_outer("children").alias("pos", "chunk_id"))
    refs = refs.filter(F.col("chunk_id").isNotNull())
    if "bucket" in on:
        refs = bucketed(refs, digits)
    found = refs.join(chunks.select(*on, "data"), on, "left").select("doc_id", "path", "pos", "data")
    found = hold(found) if hold else found
    # One struct, in which nulls are equal: a null-safe comparison would join by other keys than those of the grouping and move the bytes again.
    bodies = found.groupBy(F.struct("doc_id", "path").alias("_file")).agg(
        F.expr("listagg(data) WITHIN GROUP (ORDER BY pos)").alias("_joined"),
        F.count("*").alias("n_chunks"),
        F.count_if(F.col("data").isNull()).alias("missing_chunks"),
    )
    has = set(files.columns)
    head = files.select(
        F.struct("doc_id", "path").alias("_file"),
        "doc_id",
        "path",
        F.coalesce(F.size("children"), F.lit(0)).alias("_n"),
        (F.col("data") if "data" in has else F.lit(None).cast("binary")).alias("_inline"),
        (F.col("size") if "size" in has else F.lit(None).cast("long")).alias("_size"),
    )
    no_children = F.col("_n") <= 0
    fallback = F.when(no_children if inline == "no_children" else F.lit(True), F.col("_inline"))
    content = F.coalesce("_joined", fallback)
    if empty_ok:
        content = F.coalesce(
            content, F.when(no_children & (F.col("_size") == 0) & F.col("_inline").isNull(), F.lit(b""))
        )
    out = head.join(bodies, "_file", "left").select(
        "doc_id",
        "path",
        content.alias("content"),
        F.coalesce("n_chunks", F.lit(0)).alias("n_chunks"),
        F.coalesce("missing_chunks", F.lit(0)).alias("missing_chunks"),
    )
    out = out.filter(F.col("content").isNotNull())
    return out.filter(F.col("missing_chunks") == 0) if strict else out


def sync_totals(chunks: DataFrame, store: DataFrame | None = None, key: str = "doc_id") -> DataFrame:
    """Per file: chunks referenced, bytes, and how many of the chunks the store does not hold."""
    narrow = chunks.select(key, "chunk_id", F.octet_length("data").alias("_bytes"))
    if store is not None:
        known = store.select("chunk_id").distinct().withColumn("_known", F.lit(True))
        narrow = narrow.join(known, "chunk_id", "left")
    else:
        narrow = narrow.withColumn("_known", F.lit(None).cast("boolean"))
    return narrow.groupBy(key).agg(
        F.count("*").alias("chunks"),
        F.sum("_bytes").cast("long").alias("bytes"),
        F.count_if(F.col("_known").isNull()).alias("new_chunks"),
    )


def store_totals(chunks: DataFrame) -> DataFrame:
    """One row: chunks and bytes referenced, distinct chunks and bytes, bytes saved by sharing."""
    per_chunk = chunks.select("chunk_id", F.octet_length("data").alias("_bytes")).groupBy("chunk_id").agg(
        F.count("*").alias("_refs"), F.max("_bytes").alias("_bytes")
    )
    total = F.coalesce(F.sum(F.col("_refs") * F.col("_bytes")), F.lit(0)).cast("long")
    kept = F.coalesce(F.sum("_bytes"), F.lit(0)).cast("long")
    return per_chunk.agg(
        F.coalesce(F.sum("_refs"), F.lit(0)).cast("long").alias("chunks"),
        F.count("*").alias("distinct_chunks"),
        total.alias("bytes"),
        kept.alias("distinct_bytes"),
        (total - kept).alias("saved_bytes"),
    )


def sketch_chunks(chunks: DataFrame, *by: str, bits: int = 14) -> DataFrame:
    """`(*by, refs, ids, bytes)`: references of each group, and mergeable sketches of its distinct chunks and of their bytes.

    `ids` is a HyperLogLog sketch of chunk ids. `bytes` is one of (chunk, kilobyte) pairs, whose number tells distinct bytes rounded
    up to kilobytes. A group's row is some tens of kilobytes at most, made inside each task, so no id is shuffled.
    """
    kilobytes = F.greatest(F.ceil(F.octet_length("data") / 1024).cast("int"), F.lit(1))
    narrow = chunks.select(*by, "chunk_id", kilobytes.alias("_k"))
    pairs = narrow.select(*by, "chunk_id", F.explode(F.sequence(F.lit(1), F.col("_k"))).alias("_k"))
    first = F.col("_k") == 1
    return pairs.groupBy(*by).agg(
        F.count_if(first).alias("refs"), F.hll_sketch_agg(F.when(first, F.col("chunk_id")), bits).alias("ids"),
        F.hll_sketch_agg(F.xxhash64("chunk_id", "_k"), bits).alias("bytes"),
    )


def sketch_totals(sketches: DataFrame, *by: str) -> DataFrame:
    """`(*by, chunks, distinct_chunks, distinct_kilobytes)` of any union of sketched groups: estimates, within about 2 % at 14 bits."""
    return sketches.groupBy(*by).agg(
        F.sum("refs").alias("chunks"), F.hll_sketch_estimate(F.hll_union_agg("ids")).alias("distinct_chunks"),
        F.hll_sketch_estimate(F.hll_union_agg("bytes")).alias("distinct_kilobytes"),
    )
