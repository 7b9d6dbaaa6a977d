"""WARC archives with revisit resolution.

``archive`` digests payloads, stores the headers alone and shuffles those by payload digest: the first capture of each
payload is its response, later ones become ``revisit`` records with fresh headers, written from headers without
payload.  Payloads never move by digest, where a payload of a third of the pages would be one group: the responses'
are found by page_id and digest.  ``deduplicated`` does the same to archives that exist; there only a record that has
its payload can be an original.  Archives are written by Spark's text writer (records end with the blank lines that
WARC asks for; gzip) and read back file by file; a file holds at most ``RECORDS_PER_FILE`` records, so a task's memory
is bounded by that.

Defined cases: a null payload is empty; a null or empty url gives no WARC-Target-URI, control characters and spaces
in it are percent-encoded; a null page_id gives no X-Page-ID and is read back as null, never as an original while
another capture has an id; rows that repeat a page_id and payload are the same capture and all of them original if
one is; an empty table gives an empty archive and result; other columns are ignored."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabscope.llm.common import narrow, stored
from tabscope.session import scratch_path

RECORDS_PER_FILE = 2000
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = "\r\n"

# The digits of base 32 as conv() and as RFC 4648 write them.
CONV_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
RFC_DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: str) -> Column:
    """The upper-case base32 SHA-1 of a string's UTF-8 bytes: four groups of ten hex digits, eight letters each."""
    hexed = F.sha1(F.col(payload).cast("binary"))
    parts = [F.lpad(F.conv(F.substring(hexed, 10 * i + 1, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), CONV_DIGITS, RFC_DIGITS)


def captures(pages: DataFrame) -> DataFrame:
    """``(page_id, url, payload, payload_bytes, payload_digest)``."""
    p = narrow(pages, "page_id", "url", "html").withColumn("payload", F.coalesce("html", F.lit("")))
    return p.select("page_id", "url", "payload", F.octet_length("payload").cast("long").alias("payload_bytes"),
                    base32_sha1("payload").alias("payload_digest"))


def originals(headers: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``(digest, bytes, first)`` of each payload of at least ``least_bytes``: the smallest page_id of a record that has
    it, null if none of these has a page_id.  A hot digest is one row per task before the shuffle."""
    return headers.where((F.col("payload_bytes") >= least_bytes) & F.col("refers_to").isNull()).groupBy(
        F.col("payload_digest").alias("digest"), F.col("payload_bytes").alias("bytes")).agg(F.min("page_id").alias("first"))


def revisits(headers: DataFrame, first: DataFrame) -> DataFrame:
    """The records that need no payload, with ``refers_to``: later captures of an original, and revisits of before."""
    met = headers.join(first.hint("merge"), (F.col("payload_digest") == F.col("digest")) & (
        F.col("payload_bytes") == F.col("bytes")), "left")
    later = F.col("digest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return met.where(later | F.col("refers_to").isNotNull()).withColumn("refers_to", F.coalesce("first", "refers_to")).drop(*first.columns)


def responses(records: DataFrame, first: DataFrame, least_bytes: int = 0) -> DataFrame:
    """The records that keep their payload: the originals, and all payloads under ``least_bytes``."""
    whole = records.where(F.col("refers_to").isNull())
    kept = whole.where(F.col("payload_bytes") >= least_bytes).join(
        first.hint("merge"), F.col("page_id").eqNullSafe(F.col("first")) & (F.col("payload_digest") == F.col("digest")) & (
            F.col("payload_bytes") == F.col("bytes")), "left_semi")
    return kept.unionByName(whole.where(F.col("payload_bytes") < least_bytes)) if least_bytes > 0 else kept


def write_resolved(records: DataFrame, headers: DataFrame, path: str, least_bytes: int = 0) -> None:
    """Archives of ``records`` with equal payloads stored once; ``headers`` are the same records without payload."""
    headers = stored(headers, "headers")
    first = stored(originals(headers, least_bytes), "originals")
    bare = revisits(headers, first).withColumn("payload", F.lit(None).cast("string"))
    write_archives(responses(records, first, least_bytes).unionByName(bare), path)


def write_archives(records: DataFrame, path: str) -> None:
    """One WARC record for each row: a revisit if ``refers_to`` is given, else a response."""
    revisit = F.col("refers_to").isNotNull()
    url = F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20")
    body = F.when(revisit, "").otherwise(F.col("payload"))
    lines = F.concat_ws(
        CRLF, F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: <urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("none")), F.lit(">")),
        F.concat(F.lit("X-Page-ID: "), F.col("page_id").cast("string")),
        F.when(F.length("url") > 0, F.concat(F.lit("WARC-Target-URI: "), url)),
        F.lit(f"WARC-Date: {DATE}"), F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("payload_digest")),
        F.concat(F.lit("X-Payload-Length: "), F.col("payload_bytes").cast("string")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: <urn:page:"), F.col("refers_to").cast("string"), F.lit(">"))),
        F.when(revisit, F.lit(f"WARC-Profile: {PROFILE}")),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.octet_length(body).cast("string")))
    record = F.concat(lines, F.lit(CRLF * 2), body)
    records.select(record.alias("value")).write.option("lineSep", CRLF * 2).option("compression", "gzip").option(
        "maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def parsed(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of an uncompressed archive."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record begins with {line[:40]!r}")
        headers = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode().partition(":")
            headers[name.strip().lower()] = value.strip()
        block = stream.read(int(headers["content-length"]))
        if len(block) != int(headers["content-length"]):
            raise ValueError("an archive ends within a record")
        yield headers, block


def _page(urn: str | None) -> int | None:
    return int(urn[len("<urn:page:"):-1]) if urn else None


RECORD = "page_id long, url string, payload string, payload_bytes long, payload_digest string, refers_to long"


def _records(with_payload: bool, rows: int = 256):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in RECORD.split(", ")]
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        out: list[list] = [[] for _ in names]
        for b in batches:
            for content in b.column(0):
                raw = content.as_buffer()
                zipped = raw[:2].to_pybytes() == b"\x1f\x8b"
                stream = pa.BufferReader(raw)
                for h, block in parsed(io.BufferedReader(gzip.GzipFile(fileobj=stream)) if zipped else stream):
                    digest, size = h["warc-payload-digest"].removeprefix("sha1:"), int(h["x-payload-length"])
                    refers = _page(h.get("warc-refers-to"))
                    if refers is None and (len(block) != size or base64.b32encode(hashlib.sha1(block).digest()).decode() != digest):
                        raise ValueError(f"payload of {h['warc-record-id']} doesn't have its digest")
                    row = (int(h["x-page-id"]) if "x-page-id" in h else None, h.get("warc-target-uri"),
                           block.decode() if with_payload else None, size, digest, refers)
                    for column, v in zip(out, row, strict=True):
                        column.append(v)
                    if len(out[0]) == rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names=names)
                        out = [[] for _ in names]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names=names)
    return run


def read_archives(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """``(page_id, url, payload, payload_bytes, payload_digest, refers_to)`` of each record; the payloads of
    responses are checked against their digests, and returned if wanted."""
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(_records(with_payload, 256 if with_payload else 8192), RECORD)


def archive(pages: DataFrame, path: str, least_bytes: int = 0) -> None:
    """Write ``pages`` as archives in which equal payloads are stored once."""
    records = captures(pages).withColumn("refers_to", F.lit(None).cast("long"))
    write_resolved(records, records.drop("payload"), path, least_bytes)


def deduplicated(spark: SparkSession, source: str, target: str, least_bytes: int = 0) -> None:
    """Read archives, resolve their revisits anew and write archives with fresh headers.  Revisit records of the
    source keep the payload's digest and length and stay revisits, of the first record that holds the payload."""
    records = read_archives(spark, source, with_payload=True)
    write_resolved(records, read_archives(spark, source).drop("payload"), target, least_bytes)


def digest_rows(pages: DataFrame, least_bytes: int = 0, path: str | None = None) -> DataFrame:
    """Write the archives, read them back: ``(page_id, payload_bytes, payload_digest, record_type, refers_to)``."""
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    archive(pages, path, least_bytes)
    return read_archives(spark, path).select(
        "page_id", "payload_bytes", "payload_digest",
        F.when(F.col("refers_to").isNull(), "response").otherwise("revisit").alias("record_type"), "refers_to")


ROWS_SQL = f"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload FROM pages),
d AS (
  SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes, sha1(payload) AS h FROM p),
b AS (
  SELECT page_id, payload_bytes, list_aggregate(list_transform(range(0, 32), lambda i:
    substr('{RFC_DIGITS}', 1 + CAST(((CAST('0x' || substr(h, 1 + 10 * CAST(i // 8 AS INTEGER), 10) AS BIGINT)
      >> CAST(35 - 5 * (i % 8) AS INTEGER)) & 31) AS INTEGER), 1)), 'string_agg', '') AS payload_digest FROM d),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS first FROM b)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM f
"""
