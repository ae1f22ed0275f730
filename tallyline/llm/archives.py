"""WARC archives with revisit records.

Payload digests are SHA-1 in base 32.  Headers (page, digest, length; no
payload) are grouped by digest; the row with the smallest page id is the
response, others of the same digest become revisit records that refer to it.
Payloads shorter than ``min_bytes`` are always responses.

Records are built as strings and written by Spark's text writer, whose line
separator is the blank lines that end a WARC record, so a lost or repeated task
leaves no half archive.  An archive holds records of one task; the number is
bounded by the size of their payloads (``ARCHIVES``), and so are an archive's
bytes.  Record ids are made from page id and digest:
a rerun writes the same records.

Reading goes by Content-Length, record by record, so payloads may hold
anything, record separators included.

Nulls and edges: a null payload is empty; a null url leaves its header out; a
null page id comes after all others; rows that repeat the response's page id and
payload are responses too; line ends in urls are percent-encoded.
"""

from __future__ import annotations

import gzip
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans import Staging

# The WARC record separator, field names and the profile of identical payloads.
SEPARATOR = "\r\n\r\n"
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# An archive holds so many records whose payloads have at most so many bytes; larger ones are alone.
ARCHIVES = ((1 << 16, 2_000), (1 << 20, 128), (1 << 24, 8))


def base32(hex_digest: Column) -> Column:
    """Base 32 of a digest whose length is a multiple of five hex digits: four letters for five digits."""
    groups = [
        F.lpad(F.conv(F.substring(hex_digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)
    ]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def record_id(page_id: Column, digest: Column) -> Column:
    h = F.md5(F.concat_ws("|", F.coalesce(page_id.cast("string"), F.lit("")), digest))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _safe(url: Column) -> Column:
    for code in (0x0D, 0x0A, 0x00):
        url = F.replace(url, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return url


def resolve(pages: DataFrame, id_col: str, url_col: str, payload_col: str, min_bytes: int = 0) -> DataFrame:
    """(page_id, url, payload, digest, bytes, original, original_url); original is the response's page id."""
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), _safe(F.col(url_col).cast("string")).alias("url"),
        payload.alias("payload"),
    ).select("*", base32(F.sha1(F.col("payload").cast("binary"))).alias("digest"), F.octet_length("payload").cast("long").alias("bytes"))
    headers = rows.where(F.col("bytes") >= min_bytes).select("digest", "page_id", "url")
    first = headers.groupBy("digest").agg(
        F.min("page_id").alias("original"), F.min_by("url", F.struct(F.col("page_id").isNull(), "page_id", "url")).alias("original_url"),
        F.count("*").alias("_n"),
    )
    several = first.where("_n > 1").drop("_n").withColumnRenamed("digest", "_digest")
    big = F.col("bytes") >= min_bytes
    return rows.join(several, (rows["digest"] == several["_digest"]) & big, "left").drop("_digest")


def _field(name: str, value: Column) -> Column:
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def records(resolved: DataFrame, date: str) -> DataFrame:
    """One column ``value``: a whole record without the separator at its end."""
    revisit = F.col("original").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("original"))
    status = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"),
        F.lit("\r\n\r\n"),
    )
    block = F.when(revisit, status).otherwise(F.concat(status, F.col("payload")))
    header = F.concat(
        F.lit(f"{VERSION}\r\n"),
        _field("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _field("WARC-Record-ID", record_id(F.col("page_id"), F.col("digest"))),
        F.lit(f"WARC-Date: {date}\r\n"),
        _field("WARC-Target-URI", F.col("url")),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        _field("X-Page-ID", F.col("page_id").cast("string")),
        _field("WARC-Refers-To", F.when(revisit, record_id(F.col("original"), F.col("digest")))),
        _field("WARC-Refers-To-Target-URI", F.when(revisit, F.col("original_url"))),
        F.when(revisit, F.lit(f"WARC-Refers-To-Date: {date}\r\nWARC-Profile: {PROFILE}\r\n")).otherwise(F.lit("")),
        F.lit("Content-Type: application/http;msgtype=response\r\n"),
        _field("Content-Length", F.octet_length("_block").cast("string")),
        F.lit("\r\n"), F.col("_block"),
    )
    return resolved.withColumn("_block", block).select(header.alias("value"))


def write_archives(
    pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
    min_bytes: int = 0, date: str = "2000-01-01T00:00:00Z", compression: str = "gzip",
) -> None:
    """Writes each class of sizes by itself: equal payloads have equal sizes, so none refers to another class."""
    size = F.coalesce(F.octet_length(F.col(payload_col).cast("string")), F.lit(0))
    of = F.lit(len(ARCHIVES))
    for i, (most, _) in reversed(list(enumerate(ARCHIVES))):
        of = F.when(size <= most, F.lit(i)).otherwise(of)
    there = sorted(r[0] for r in pages.select(of.alias("class")).distinct().collect())  # as many as there are classes
    for i in there or [0]:
        lines = records(resolve(pages.where(of == i), id_col, url_col, payload_col, min_bytes), date)
        n = ARCHIVES[i][1] if i < len(ARCHIVES) else 1
        options = {"lineSep": SEPARATOR, "compression": compression, "maxRecordsPerFile": n}
        lines.write.mode("append").options(**options).text(folder)


def _records_of(content: pa.Buffer) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields, block) of each record of an archive, compressed or not, one record in memory at a time."""
    stream = pa.BufferReader(content)
    if content[:2].to_pybytes() == b"\x1f\x8b":
        stream = gzip.GzipFile(fileobj=stream)
    stream = io.BufferedReader(stream, 1 << 20)
    while version := stream.readline():
        if version.rstrip().decode() != VERSION:
            raise ValueError(f"not a WARC record: {version[:80]!r}")
        fields = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, value = line[:-2].decode("utf-8", "surrogateescape").split(": ", 1)
            fields[name] = value
        block = stream.read(int(fields["Content-Length"]))
        if stream.read(len(SEPARATOR)) != SEPARATOR.encode():
            raise ValueError(f"record {fields.get('WARC-Record-ID')} does not end where it should")
        yield fields, block


_READ = pa.schema([
    ("record_id", pa.string()), ("record_type", pa.string()), ("page_id", pa.int64()), ("url", pa.string()),
    ("payload_digest", pa.string()), ("refers_to_record", pa.string()), ("payload", pa.binary()),
])
READ = "record_id string, record_type string, page_id long, url string, payload_digest string, refers_to_record string, payload binary"


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _READ.types)], schema=_READ)

    for batch in batches:
        for cell in batch.column("content"):
            rows, size = [], 0
            for fields, block in _records_of(cell.as_buffer()):
                kind = fields["WARC-Type"]
                payload = block.split(b"\r\n\r\n", 1)[1] if kind == "response" else None
                page = fields.get("X-Page-ID")
                rows.append((
                    fields["WARC-Record-ID"], kind, None if page is None else int(page), fields.get("WARC-Target-URI"),
                    fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields.get("WARC-Refers-To"), payload,
                ))
                size += len(block)
                if size > 8 << 20:
                    yield batch_of(rows)
                    rows, size = [], 0
            if rows:
                yield batch_of(rows)


def read_archives(spark, folder: str) -> DataFrame:
    """(record_id, record_type, page_id, url, payload_digest, refers_to_record, payload); revisits have no payload."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("content")
    return files.mapInArrow(_parse, READ)


def resolved_records(staging: Staging, read: DataFrame) -> DataFrame:
    """Every record with the size and digest of its full payload, and for revisits the response's page id.

    Digests of responses are taken from the payload that was read.
    """
    digest = F.when(F.col("payload").isNotNull(), base32(F.sha1("payload"))).otherwise(F.col("payload_digest"))
    rows = staging.keep(
        read.select(
            "record_id", "record_type", "page_id", "refers_to_record", digest.alias("payload_digest"),
            F.octet_length("payload").cast("long").alias("payload_bytes"),
        ),
        "records",
    )
    responses = rows.where("record_type = 'response'")
    wanted = rows.where("record_type = 'revisit'").drop("payload_bytes", "payload_digest")
    # rows that repeat a response share its record id
    target = responses.groupBy("record_id").agg(
        F.min("page_id").alias("refers_to"), F.first("payload_digest").alias("payload_digest"),
        F.first("payload_bytes").alias("payload_bytes"),
    ).withColumnRenamed("record_id", "refers_to_record")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    found = wanted.join(target, "refers_to_record").select(*columns)
    return responses.withColumn("refers_to", F.lit(None).cast("long")).select(*columns).unionAll(found)
