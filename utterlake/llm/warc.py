"""WARC archives with repeated payloads resolved into revisit records.

Only headers (page id, digest, length) are shuffled by payload digest to find the first page of each payload, after each task has
added up its own; payloads move once, by page, to be written. An archive is a WARC/1.1 file with a gzip member for each record, the
first a warcinfo record, so that any record can be read alone from its offset.

Archives are written through Spark's text writer, to any store, and a lost executor only repeats its own files. A row of that
writer is a run of members of some BLOCK bytes; its line separator is a gzip member without content, which readers pass over.
BLOCKS rows make an archive, then the next begins, so archives stay near BLOCK * BLOCKS bytes whatever the table's size (or one
longer record's). The writer names them part-*; their content is that of .warc.gz files.

Defined cases: a null html is an empty payload, a null url gives no target URI, line breaks in a url are percent-encoded;
of several rows with the same page_id and payload the first is the response (if the page is) and the rest revisit it;
payloads shorter than min_bytes are always responses; pages with a null page_id come last among equal payloads, and a
revisit of such a page has a null refers_to; an empty table gives no records; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from utterlake.llm.common import cut, text_slices

#: Bytes of members in a row of the writer, and rows in an archive.
BLOCK, BLOCKS = 4 << 20, 256

CRLF, RECORD_END = "\r\n", "\r\n\r\n"
#: Fixed values of the WARC 1.1 standard.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def resolve(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = 100) -> DataFrame:
    """A row for each page: page_id, url, payload, digest, n_bytes, copy (from 1), record_type, refers_to, refers_url."""
    own = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(html).cast("string"), F.lit("")).alias("payload"))
    own = own.withColumns({"digest": F.sha2("payload", 256), "n_bytes": F.octet_length("payload").cast("long"), "unnamed": F.col("page_id").isNull(), "id": F.coalesce("page_id", F.lit(0).cast("long"))})
    heads = own.select("unnamed", "id", "page_id", "url", "digest", "n_bytes").where(F.col("n_bytes") >= min_bytes)
    origins = heads.groupBy("digest").agg(F.count("*").alias("n"), F.min(F.struct("unnamed", "page_id", "url")).alias("first")).where("n > 1").select("digest", "first")
    origins = cut(origins, "warc-origins")  # a table to join with, so that Spark can split the pages of a frequent payload
    repeats = heads.select("unnamed", "id", "digest").distinct().join(origins, "digest")
    # join and window share their keys, so payloads are shuffled once
    page = ["unnamed", "id", "digest"]
    rows = own.join(repeats, page, "left").withColumn("copy", F.row_number().over(W.partitionBy(*page).orderBy("url")))
    revisit = F.col("first").isNotNull() & ~(F.col("first.page_id").eqNullSafe(F.col("page_id")) & (F.col("copy") == 1))
    return rows.select(
        "page_id", "url", "payload", "digest", "n_bytes", "copy",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first.page_id")).alias("refers_to"),
        F.when(revisit, F.col("first.url")).alias("refers_url"),
    )


def _name(page: Column, copy: Column, digest: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("")), F.lit(":"), copy.cast("string"), F.lit(":"), F.substring(digest, 1, 16), F.lit(">"))


def _line(key: str, value: Column) -> Column:
    """A header line, or nothing where value is null."""
    return F.coalesce(F.concat(F.lit(key + ": "), value, F.lit(CRLF)), F.lit(""))


def _uri(url: Column) -> Column:
    return F.replace(F.replace(url, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def record(date: str) -> Column:
    """A row of resolve() as a WARC record."""
    revisit = F.col("record_type") == "revisit"
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("n_bytes").cast("string"), F.lit(RECORD_END))
    length = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("n_bytes"))
    return F.concat(
        F.lit(f"{VERSION}\r\nWARC-Type: "), F.col("record_type"), F.lit(CRLF),
        _line("WARC-Record-ID", _name(F.col("page_id"), F.col("copy"), F.col("digest"))),
        F.lit(f"WARC-Date: {date}\r\n"),
        _line("WARC-Target-URI", _uri(F.col("url"))),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        _line("WARC-Profile", F.when(revisit, PROFILE)),
        _line("WARC-Refers-To", F.when(revisit, _name(F.col("refers_to"), F.lit(1), F.col("digest")))),
        _line("WARC-Refers-To-Target-URI", F.when(revisit, _uri(F.col("refers_url")))),
        _line("WARC-Refers-To-Date", F.when(revisit, F.lit(date))),
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "), length.cast("string"), F.lit(RECORD_END),
        http, F.when(revisit, "").otherwise(F.col("payload")), F.lit(RECORD_END),
    )


def member(data: bytes) -> bytes:
    """data as a gzip member without name or time, so that equal data give equal bytes."""
    press = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = press.compress(data) + press.flush()
    return b"\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\xff" + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


#: A member without content: what the writer puts behind each row.
EMPTY = member(b"")


def info(date: str) -> bytes:
    """The record that opens each archive."""
    fields = b"software: utterlake\r\nformat: WARC File Format 1.1\r\n"
    name = hashlib.sha256(fields + date.encode()).hexdigest()[:16]
    head = f"{VERSION}\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:info:{name}>\r\nWARC-Date: {date}\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(fields)}"
    return head.encode() + b"\r\n\r\n" + fields + b"\r\n\r\n"


def write_warc(pages: DataFrame, out: str, *, date: str = "1970-01-01T00:00:00Z", block: int | None = None, blocks: int | None = None, **options) -> None:
    """Write pages as WARC files under out; options are those of resolve()."""
    block, blocks = block or BLOCK, blocks or BLOCKS
    rows = resolve(pages, **options).select(record(date).cast("binary").alias("value"))

    def pack(batches):
        opening, held, size, row = member(info(date)), [], 0, 0
        for batch in batches:
            for a, b in text_slices(batch.column(0), block):
                for data in batch.column(0).slice(a, b - a).to_pylist():
                    if not held and row % blocks == 0:
                        held, size = [opening], len(opening)
                    held.append(member(data))
                    size += len(held[-1])
                    if size >= block:
                        yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], ["value"])
                        held, size, row = [], 0, row + 1
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], ["value"])

    packed = rows.mapInArrow(pack, "value binary").select(F.col("value").cast("string").alias("value"))
    packed.write.option("encoding", "ISO-8859-1").option("lineSep", EMPTY.decode("latin-1")).option("maxRecordsPerFile", blocks).text(out)


def _members(content: bytes):
    """(offset, data) of each gzip member, in pieces of a bounded size: a new offset opens a member."""
    at = 0
    while at < len(content):
        feed, begin = zlib.decompressobj(31), at
        while not feed.eof:
            piece = feed.unconsumed_tail or content[at : at + 65_536]
            if not piece:
                raise ValueError("a WARC file ends within a gzip member")
            if not feed.unconsumed_tail:
                at += len(piece)
            yield begin, feed.decompress(piece, 1 << 20)
        at -= len(feed.unused_data)


def records(content: bytes):
    """The records of a gzipped WARC file, one at a time: (headers, block, offset of the member that it begins in)."""
    feed, held = _members(content), bytearray()
    starts: list[tuple[int, int]] = []  # where in held a member begins, and its offset

    def more() -> bool:
        offset, data = next(feed, (None, None))
        if data is None:
            return False
        if data and (not starts or starts[-1][1] != offset):
            starts.append((len(held), offset))
        held.extend(data)
        return True

    while True:
        while (end := held.find(b"\r\n\r\n")) < 0:
            if not more():
                if held:
                    raise ValueError("a WARC file ends within a header")
                return
        lines = held[:end].decode("utf-8", "surrogatepass").split(CRLF)
        if lines[0] != VERSION:
            raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
        head = dict(x.split(": ", 1) for x in lines[1:])
        stop = end + 4 + int(head["Content-Length"])
        while len(held) < stop + 4:
            if not more():
                raise ValueError("a WARC file ends within a record")
        yield head, bytes(held[end + 4 : stop]), [o for at, o in starts if at <= 0][-1]
        del held[: stop + 4]
        last = [x for x in starts if x[0] <= stop + 4][-1:]
        starts = [(at - stop - 4, o) for at, o in [*last, *[x for x in starts if x[0] > stop + 4]]]


def record_at(content: bytes, offset: int) -> tuple[dict, bytes]:
    """The one record whose member begins at offset; nothing before it is read."""
    head, block, _ = next(records(content[offset:]))
    return head, block


def read_warc(spark: SparkSession, out: str) -> DataFrame:
    """A row for each page's record under out: page_id, payload_bytes, payload_digest, record_type, refers_to, url, and file and offset.

    Of responses, length and digest are those of the payload as read, and a digest unlike the header's is an error.
    """
    files = spark.read.format("binaryFile").load(out).select("path", "content")
    fields = [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()), ("file", pa.string()), ("offset", pa.int64())]

    def page(name: str | None) -> int | None:
        found = re.match(r"<urn:page:(-?\d+):", name or "")
        return int(found[1]) if found else None

    def rows(file: str, content: bytes):
        for head, block, offset in records(content):
            if head["WARC-Type"] == "warcinfo":
                continue
            http, _, payload = block.partition(b"\r\n\r\n")
            n = int(re.search(rb"Content-Length: (\d+)", http)[1])
            digest = head["WARC-Payload-Digest"].removeprefix("sha256:")
            if head["WARC-Type"] == "response" and (len(payload) != n or hashlib.sha256(payload).hexdigest() != digest):
                raise ValueError(f"{head['WARC-Record-ID']}: the payload differs from its digest")
            yield page(head["WARC-Record-ID"]), n, digest, head["WARC-Type"], page(head.get("WARC-Refers-To")), head.get("WARC-Target-URI"), file, offset

    def read(batches):
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = []
                for row in rows(path.rsplit("/", 1)[-1], content.as_py()):
                    found.append(row)
                    if len(found) == 10_000:
                        yield _batch(found, fields)
                        found = []
                if found:
                    yield _batch(found, fields)

    return files.mapInArrow(read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, file string, offset long")


def _batch(rows: list, fields: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), fields)], [n for n, _ in fields])
