"""Web archives in WARC with Zstandard: dictionary in a leading skippable frame, one frame for each record."""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import Query, file_store, settled, table
from tidemark.session import work_dir

ARCHIVE_BYTES = 32 << 20  # a task closes an archive when it holds this many compressed bytes
# The dictionary is trained on at most so many pages of at most so many characters.
SAMPLE_PAGES, SAMPLE_CHARS, DICTIONARY_BYTES = 400, 20_000, 32 << 10
# Fixed values of the formats.
_SKIPPABLE, _FRAME = 0x184D2A5D, 0xFD2FB528
_DATE, _PROFILE = "2024-01-01T00:00:00Z", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_RECORD_ID = "<urn:x-page:{}>"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
_END = b"\r\n\r\n"


def record(page_id: int | None, url: str | None, digest: str, payload: bytes | None, size: int, refers_to: int | None) -> bytes:
    """One WARC record: a response with its payload or, with `payload` None, a revisit with the HTTP head alone."""
    block = _HTTP.format(size).encode() + (payload or b"")
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if payload is None else 'response'}",
        f"WARC-Record-ID: {_RECORD_ID.format('' if page_id is None else page_id)}", f"WARC-Date: {_DATE}",
        f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {quote(url, safe=_URL_SAFE)}")
    if payload is None:
        lines += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {_RECORD_ID.format('' if refers_to is None else refers_to)}"]
    return "\r\n".join(lines).encode() + _END + block + _END


_URL_SAFE = "".join(chr(c) for c in range(33, 127) if chr(c) != "%")


def _heads(data: bytes, first: str) -> tuple[dict[str, str], bytes]:
    """Named fields up to the blank line, and what follows it."""
    head, gap, rest = data.partition(_END)
    lines = head.decode("utf-8").split("\r\n")
    if not gap or not lines[0].startswith(first):
        raise ValueError(f"record without a head {first!r}")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or not name or name != name.strip():
            raise ValueError(f"malformed field {line!r}")
        fields[name.lower()] = value.strip()
    return fields, rest


def parsed(data: bytes) -> dict:
    """A record's values; ValueError if heads, lengths or the digest do not fit."""
    fields, rest = _heads(data, "WARC/1.")
    kind, length = fields["warc-type"], int(fields["content-length"])
    if len(rest) != length + len(_END) or rest[length:] != _END:
        raise ValueError("Content-Length differs from the block")
    http, payload = _heads(rest[:length], "HTTP/1.")
    scheme, _, digest = fields["warc-payload-digest"].partition(":")
    size = int(http["content-length"])
    if kind == "response":
        if len(payload) != size or scheme != "sha1" or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
            raise ValueError("payload differs from its length or digest")
    elif kind != "revisit" or payload or fields.get("warc-profile") != _PROFILE:
        raise ValueError(f"unexpected record of type {kind!r}")

    def page(name: str) -> int | None:
        text = fields[name].removeprefix("<urn:x-page:").removesuffix(">") if name in fields else ""
        return int(text) if text else None

    return {
        "page_id": page("warc-record-id"), "url": unquote(fields["warc-target-uri"]) if "warc-target-uri" in fields else None,
        "record_type": kind, "payload": payload if kind == "response" else None, "payload_bytes": size,
        "payload_digest": digest, "refers_to": page("warc-refers-to"),
    }


def opening(dictionary: bytes) -> bytes:
    """The leading skippable frame, with the dictionary compressed."""
    held = zstandard.ZstdCompressor(level=19).compress(dictionary)
    return struct.pack("<II", _SKIPPABLE, len(held)) + held


def frames(source, chunk: int = 1 << 16) -> Iterator[bytes]:
    """The records of an archive, one decoded frame each; ValueError if it is cut off or begins otherwise."""

    def exactly(count: int) -> bytes:
        got = source.read(count)
        if len(got) != count:
            raise ValueError("archive cut off")
        return got

    magic, size = struct.unpack("<II", exactly(8))
    if magic != _SKIPPABLE:
        raise ValueError("no dictionary frame")
    held = exactly(size)
    if held[:4] == struct.pack("<I", _FRAME):
        held = zstandard.ZstdDecompressor().decompress(held)
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(held))
    waiting = b""
    while waiting or (waiting := source.read(chunk)):
        frame, out = reader.decompressobj(), []
        while True:
            out.append(frame.decompress(waiting))
            if frame.eof:
                waiting = frame.unused_data
                break
            waiting = source.read(chunk)
            if not waiting:
                raise ValueError("archive cut off inside a frame")
        yield b"".join(out)


def dictionary(pages: DataFrame, html: str) -> bytes:
    """A Zstandard dictionary from a bounded sample of short pages; a record's fixed lines where that is too little."""
    short = pages.select(F.col(html).alias("html")).filter(F.length("html").between(1, SAMPLE_CHARS))
    sample = [r[0].encode("utf-8") for r in short.limit(SAMPLE_PAGES).collect()]
    plain = record(0, "http://example.com/", "A" * 32, b"<!DOCTYPE html><html><head></head><body></body></html>", 54, None)
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, [record(0, "http://example.com/", "A" * 32, s, len(s), None) for s in sample]).as_bytes()
    except zstandard.ZstdError:
        return plain


def resolved(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", least_bytes: int = 0) -> DataFrame:
    """`(page_id, url, html, digest, size, refers_to, revisit)`: which pages repeat another's payload.

    Of pages with equal payloads of `least_bytes` or more, the one with the largest page_id is the response. Ids
    are compared as they are, null as the smallest; of rows that repeat that id one is the response, the first by url.
    The payload's owner comes from a grouped maximum and an equality join, whose hot payloads adaptive
    execution splits.
    """
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), F.coalesce(F.col(html), F.lit("")).alias("html")
    ).withColumns({"digest": F.sha1(F.col("html").cast("binary")), "size": F.octet_length("html").cast("long")})
    order = F.coalesce(F.col("page_id"), F.lit(-(1 << 63)))
    seen = rows.groupBy("digest", order.alias("order")).agg(F.count("*").alias("n"))
    owners = settled(seen.groupBy("digest").agg(F.max("order").alias("owner"), F.max("n").alias("repeats")), "warc-owners")
    if owners.filter("repeats > 1").limit(1).count():
        nth = F.row_number().over(W.partitionBy("page_id", "digest").orderBy("url"))
        rows = rows.withColumn("nth", nth)
    else:
        rows = rows.withColumn("nth", F.lit(1))
    joined = rows.join(owners.select("digest", "owner"), "digest")
    revisit = (F.col("size") >= least_bytes) & ~((order == F.col("owner")) & (F.col("nth") == 1))
    refers = F.when(F.col("revisit") & (F.col("owner") > -(1 << 63)), F.col("owner"))
    return joined.withColumn("revisit", revisit).select("page_id", "url", "html", "digest", "size", refers.alias("refers_to"), "revisit")


def write(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html",
          least_bytes: int = 0) -> DataFrame:
    """Writes every page as a WARC record to archives `*.warc.zst` in `folder`; gives `(path, n_records)` for each.

    A null html is an empty payload. The first of equal payloads' owners is written whole, the others as
    revisits without payload. Archives are named anew in each attempt and only those of finished tasks are
    listed. An empty table writes none.
    """
    folder, shared = folder.rstrip("/"), dictionary(pages, html)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = file_store(folder)
        store.create_dir(base, recursive=True)
        squeeze = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(shared), write_checksum=True).compress
        made, out, written, records = [], None, 0, 0
        for batch in batches:
            for page, known, link, text, digest, size, refers, again in batch.itertuples(index=False):
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc.zst"
                    out, written, records = store.open_output_stream(f"{base}/{name}"), 0, 0
                    out.write(opening(shared))
                whole = None if again else text.encode("utf-8", "surrogatepass")
                code = base64.b32encode(bytes.fromhex(digest)).decode()
                frame = squeeze(record(page if known else None, link, code, whole, size, int(refers) if refers else None))
                out.write(frame)
                written, records = written + len(frame), records + 1
                if written >= ARCHIVE_BYTES:
                    out.close()
                    made.append((f"{folder}/{name}", records))
                    out = None
        if out is not None:
            out.close()
            made.append((f"{folder}/{name}", records))
        yield pd.DataFrame(made, columns=["path", "n_records"])

    # Ids travel as text or with a flag: a null would make a whole column of them floating-point numbers.
    rows = resolved(pages, page_id, url, html, least_bytes).select(
        F.coalesce("page_id", F.lit(0)).alias("page_id"), F.col("page_id").isNotNull().alias("known"), "url",
        F.when(F.col("revisit"), F.lit("")).otherwise(F.col("html")).alias("html"), "digest", "size",
        F.col("refers_to").cast("string").alias("refers_to"), "revisit",
    )
    return settled(rows.mapInPandas(run, "path string, n_records long"), "warc-manifest")


_READ = "page_id string, url string, record_type string, payload binary, payload_bytes long, payload_digest string, refers_to string"


def read(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """`(page_id, url, record_type, payload, payload_bytes, payload_digest, refers_to)` of every record of the archives.

    `payload` is null for revisits, and for all with `payloads` false. Each task streams whole archives, a frame at
    a time. A record whose head, lengths or digest do not fit, and an archive that is cut off, raise an error.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [c.split(" ")[0] for c in _READ.split(", ")]
        for batch in batches:
            for path in batch["path"]:
                store, at = file_store(path)
                with store.open_input_stream(at) as source:
                    rows, held = [], 0
                    for data in frames(source):
                        row = parsed(data)
                        if not payloads:
                            row["payload"] = None
                        for name in ("page_id", "refers_to"):
                            row[name] = None if row[name] is None else str(row[name])
                        rows.append(row)
                        held += len(data)
                        if held >= 8 << 20 or len(rows) >= 5_000:
                            yield pd.DataFrame(rows, columns=columns)
                            rows, held = [], 0
                    if rows:
                        yield pd.DataFrame(rows, columns=columns)

    files = archives.count()
    rows = archives.select("path").repartition(max(files, 1)).mapInPandas(run, _READ)
    return rows.withColumns({c: F.col(c).cast("long") for c in ("page_id", "refers_to")})


def op8_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC archives and read back."""
    archives = write(table(spark, sf_dir, "pages"), work_dir(spark, "warc"))
    return read(archives, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


_DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
QUERIES: dict[str, Query] = {"op8_warc_round_trip": op8_warc_round_trip}
SQL: dict[str, str] = {
    # Eight base32 digits stand for ten hexadecimal ones.
    "op8_warc_round_trip": f"""
WITH digests AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
owners AS (SELECT hex, max(page_id) AS owner FROM digests GROUP BY hex)
SELECT page_id, payload_bytes,
  array_to_string([substr('{_DIGITS}', ((('0x' || substr(hex, 1 + 10 * (i // 8), 10))::BIGINT >> (35 - 5 * (i % 8))) % 32)::INTEGER + 1, 1)
    FOR i IN generate_series(0, 31)], '') AS payload_digest,
  CASE WHEN page_id = owner THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> owner THEN owner END AS refers_to
FROM digests JOIN owners USING (hex)"""
}
