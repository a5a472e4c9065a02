"""WARC archives of pages, written and read as tables of chunked records.

A payload is written in segments of at most ``chunk`` bytes: the first in the record itself,
each other one in a continuation record with its segment number. Writing and reading are
Spark's own text source with the version line as separator, so archives may be in any
store, and readers hold one segment at a time. A payload that contains the version line is cut
inside it. On reading, the segments of a record are rows (record, segment number, bytes);
their SHA-1 is carried on from one to the next, in order, and compared with the one the
archive states. The payload as a whole is never put together.

Of pages with equal payloads, the one with the largest id is stored (response); the others
are revisits of it and have no payload of their own.

Defined cases: a null payload is empty. A null address is left out of the record. A page
without an id has no record. Rows that repeat a page's id and payload are one page. An
empty table gives an empty archive. Further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mediacat.session import shared_folder

CHUNK = 64 << 10
# Fixed values of the format.
VERSION = "WARC/1.1\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"


def segments(payload: memoryview | bytes, chunk: int) -> list[tuple[int, int]]:
    """First and end byte of each segment: no longer than ``chunk``, and none holds the version line or ends in the version."""
    raw, mark = bytes(payload), VERSION.encode()
    cuts, at = [0], raw.find(mark)
    while at >= 0:
        cuts.append(at + 1)
        at = raw.find(mark, at + 1)
    cuts.append(len(raw))
    spans = [(a, min(a + chunk, end)) for start, end in zip(cuts, cuts[1:]) for a in range(start, end, chunk)]
    out = []
    for a, b in spans:
        # The record's closing line would complete a version at the end.
        if raw[a:b].endswith(mark[:-2]):
            out.append((a, b - 1))
            a = b - 1
        out.append((a, b))
    return out or [(0, 0)]


def record(kind: str, page: int, digest: str, length: int, url: str | None, payload: bytes, segment: int = 1,
           segments: int = 1, refers_to: int | None = None) -> bytes:
    head = [f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{page}:{digest}:{segment}>", f"WARC-Date: {DATE}",
            f"WARC-Payload-Digest: sha1:{digest}", f"Page-ID: {page}"]
    if url is not None:
        safe = "".join(f"%{ord(c):02X}" if c in "\r\n" else c for c in url)
        # With the line end after it, a version in the address would begin a record.
        head.append("WARC-Target-URI: " + safe.replace(VERSION[:-2], f"%{ord(VERSION[0]):02X}{VERSION[1:-2]}"))
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}:{digest}:1>", f"WARC-Profile: {PROFILE}"]
    if segments > 1:
        head.append(f"WARC-Segment-Number: {segment}")
        if segment > 1:
            head.append(f"WARC-Segment-Origin-ID: <urn:page:{page}:{digest}:1>")
        if segment == segments:
            head.append(f"WARC-Segment-Total-Length: {length}")
    head += ["Content-Type: text/html", f"Content-Length: {len(payload)}"]
    # The text writer ends the row with the version line of the next record.
    return "\r\n".join(head).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n"


def base32_sha1(digest) -> str:
    return base64.b32encode(digest.digest()).decode()


def write(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", payload: str = "html", chunk: int = CHUNK) -> None:
    """Write gzip archives to ``folder``, one for each task."""
    rows = pages.where(F.col(page_id).isNotNull()).select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(payload).cast("binary"), F.lit(b"")).alias("payload"))
    keys = rows.select("page_id", F.sha1("payload").alias("sha1"))
    newest = keys.groupBy("sha1").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1")
    revisits = (keys.join(newest.select("sha1", "refers_to"), "sha1").where("page_id <> refers_to")
                .select(F.col("page_id").alias("id"), F.col("sha1").alias("known"), "refers_to").distinct())
    rows = rows.join(revisits, (F.col("page_id") == F.col("id")) & (F.sha1("payload") == F.col("known")), "left")
    rows = rows.select("page_id", "url", "payload", "refers_to")

    def run(batches):
        start = [b""]
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part, out, start = batch.slice(at, 64), start, []
                for page, address, body, refers_to in zip(*(c.to_pylist() for c in part.columns)):
                    digest = base32_sha1(hashlib.sha1(body))
                    if refers_to is not None:
                        out.append(record("revisit", page, digest, 0, address, b"", refers_to=refers_to))
                        continue
                    spans = segments(body, chunk)
                    for number, (a, b) in enumerate(spans, 1):
                        kind = "response" if number == 1 else "continuation"
                        out.append(record(kind, page, digest, len(body), address, body[a:b], number, len(spans)))
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    # A row holds a record up to the version line of the next one, so a file starts with an empty row.
    written = rows.mapInArrow(run, "value binary").select(F.col("value").cast("string").alias("value"))
    written.write.option("lineSep", VERSION).option("compression", "gzip").text(folder)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """The chunk table: (page_id, kind, digest, refers_to, segment, last, length, payload) for each segment."""
    value = F.col("value")
    rows = spark.read.option("lineSep", VERSION).schema("value string").text(folder).where(F.length(value) > 0)
    head = F.concat(F.substring_index(value, "\r\n\r\n", 1), F.lit("\r\n"))
    rows = rows.select(head.alias("head"), value.cast("binary").alias("body"))

    def header(name: str, pattern: str):
        return F.nullif(F.regexp_extract("head", rf"\r\n{name}: {pattern}\r\n", 1), F.lit(""))

    rows = rows.withColumn("head", F.concat(F.lit("\r\n"), "head"))
    size = header("Content-Length", "([0-9]+)").cast("int")
    number = header("WARC-Segment-Number", "([0-9]+)").cast("int")
    return rows.select(
        header("Page-ID", "(-?[0-9]+)").cast("long").alias("page_id"),
        header("WARC-Type", "([a-z]+)").alias("kind"),
        header("WARC-Payload-Digest", "sha1:([A-Z2-7]+)").alias("digest"),
        header("WARC-Refers-To", "<urn:page:(-?[0-9]+):.*>").cast("long").alias("refers_to"),
        F.coalesce(number, F.lit(1)).alias("segment"),
        (number.isNull() | header("WARC-Segment-Total-Length", "([0-9]+)").isNotNull()).alias("last"),
        F.substring(F.col("body"), F.octet_length("head") + 1, size).alias("payload"),
    )


def digests(chunks: DataFrame) -> DataFrame:
    """(page_id, kind, digest, refers_to, payload_bytes, computed) for each record of a chunk table.

    ``computed`` is the digest of the bytes that were read; it is null, as the length is, where
    a segment is missing. Only records of several segments are shuffled.
    """
    single = (F.col("segment") == 1) & F.col("last")
    many = chunks.where(~single).dropDuplicates(["page_id", "digest", "segment"])
    many = many.repartition("page_id", "digest").sortWithinPartitions("page_id", "digest", "segment")
    schema = "page_id long, kind string, digest string, refers_to long, payload_bytes long, computed string"
    columns = ["page_id", "kind", "digest", "refers_to", "segment", "last", "payload"]

    def run(batches):
        names = schema_names
        sha, length, key, expected, first, out = None, 0, None, 1, None, []

        def closed(whole):
            page, kind, digest, refers_to = first
            out.append((page, "response" if kind == "continuation" else kind, digest, refers_to,
                        length if whole else None, base32_sha1(sha) if whole else None))

        done = True
        for batch in batches:
            held = [c.to_pylist() for c in batch.columns[:6]]
            body = batch.column(6)
            for i, (page, kind, digest, refers_to, segment, last) in enumerate(zip(*held)):
                if (page, digest) != key or segment == 1:
                    if not done:
                        closed(False)
                    sha, length, key, expected, first, done = hashlib.sha1(), 0, (page, digest), 1, (page, kind, digest, refers_to), False
                part = body[i].as_buffer()  # null where a record was cut off
                good = segment == expected and part is not None
                if part is not None:
                    sha.update(part)
                    length += part.size
                expected = segment + 1 if good else -1
                if last:
                    closed(expected > 0)
                    done = True
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), names.values())], list(names))
                out.clear()
        if not done:
            closed(False)
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), names.values())], list(names))

    schema_names = {"page_id": pa.int64(), "kind": pa.string(), "digest": pa.string(), "refers_to": pa.int64(),
                    "payload_bytes": pa.int64(), "computed": pa.string()}
    return (chunks.where(single).select(*columns).mapInArrow(run, schema)
            .union(many.select(*columns).mapInArrow(run, schema)))


def archived(pages: DataFrame, chunk: int = CHUNK, folder: str | None = None) -> DataFrame:
    """Write ``pages`` to an archive, read it back, and give a row for each page:
    (page_id, payload_bytes, payload_digest, record_type, refers_to)."""
    spark = pages.sparkSession
    folder = folder or f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    write(pages, folder, chunk=chunk)
    found = digests(read(spark, folder)).distinct()
    whole = found.where("kind = 'response'").select(F.col("page_id").alias("to"), F.col("computed").alias("payload_digest"), F.col("payload_bytes").alias("bytes"))
    visits = found.where("kind = 'revisit'").join(whole, (F.col("refers_to") == F.col("to")) & (F.col("digest") == F.col("payload_digest")), "left")
    return found.where("kind = 'response'").select(
        "page_id", "payload_bytes", F.col("computed").alias("payload_digest"), F.col("kind").alias("record_type"), F.lit(None).cast("long").alias("refers_to"),
    ).union(visits.select("page_id", "bytes", "payload_digest", "kind", "refers_to"))


SQL = """
with pages_as as (
    select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, coalesce(html, '') as html, sha1(coalesce(html, '')) as hex from pages),
coded as (
    select *, list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        1 + ((('0x' || substr(hex, 1 + 5 * (i // 4), 5))::bigint >> (15 - 5 * (i % 4))) & 31)::integer, 1)), 'string_agg', '') as payload_digest
    from pages_as),
newest as (select html as body, max(page_id) as newest from pages_as group by html)
select page_id, payload_bytes::bigint as payload_bytes, payload_digest,
    case when page_id = newest then 'response' else 'revisit' end as record_type,
    case when page_id <> newest then newest end as refers_to
from coded join newest on html = body
"""
