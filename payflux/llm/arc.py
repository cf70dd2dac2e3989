"""Operator 4: legacy archive converter, ARC to WARC.

ARC files of versions 1 and 2 are read by their header lines and declared
lengths. Every record becomes a WARC/1.1 record with an identifier made from its
content and key, an ISO date from its 14 digits, a type (warcinfo, response,
revisit, resource) and SHA-1 digests in base 32. Files are gzip; they are read as
streams, so a task holds one compressed file and one record.

Of records with equal payloads (of at least ``least`` bytes) the one with the
largest key is the response and the others revisit it.

Defined results: a null payload is empty; a null or empty address is
``about:blank``, white space in it is percent-encoded; a null key is below all
others; records that repeat the largest key are all responses; an empty table
gives no file and no rows; a record cut off by its file's end, or a header line
that does not fit its version, ends the file with a row that holds the error, and
``convert`` fails on such a row. Only the first record of a file may be its version
block; a later url that begins with ``filedesc:`` is a page. Payloads are read whole,
one record at a time. Extra columns of the pages are not written, whatever their names.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator
from functools import partial
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The field lines of the two versions.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
KEY_HEADER = "X-Page-Id"
#: First second of the dates given to pages, which have none.
EPOCH = 946684800


def digest32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# ---- writing ARC (the pages as a legacy crawl would have left them)

def write_arc(pages: DataFrame, path: str, key_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """Write pages as gzip ARC files, one per partition, of version 1 and 2 in turn; no shuffle.

    Partitions begin with their version block, every record with its header line.
    """
    url = F.coalesce(F.nullif(F.regexp_replace(url_col, r"[\x00-\x20\x7F]", "%20"), F.lit("")), F.lit("about:blank"))
    key = F.coalesce(F.col(key_col).cast("string"), F.lit(""))
    html = F.coalesce(F.col(html_col), F.lit(""))
    date = F.date_format(F.timestamp_seconds(F.lit(EPOCH) + F.pmod(F.coalesce(F.col(key_col), F.lit(0)), F.lit(10**9))), "yyyyMMddHHmmss")
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n" + KEY_HEADER + ": "), key,
                    F.lit("\r\nContent-Length: "), F.octet_length(html).cast("string"), F.lit("\r\n\r\n"))
    length = (F.octet_length(head) + F.octet_length(html)).cast("string")
    second = F.spark_partition_id() % 2 == 1
    line = F.concat(url, F.lit(" 0.0.0.0 "), date, F.lit(" text/html "),
                    F.when(second, F.lit("200 - - 0 - ")).otherwise(F.lit("")), length)
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    opening = F.when(first, F.when(second, F.lit(_opening(2))).otherwise(F.lit(_opening(1)))).otherwise(F.lit(""))
    (pages.select(F.concat(opening, line, F.lit("\n"), head, html).alias("value"))
     .write.option("lineSep", "\n").option("compression", "gzip").text(path))


def _opening(version: int) -> str:
    """The version block of a file: its header line (always in the first form), version line and field line."""
    body = f"{version} 0 payflux\n{ARC_FIELDS[version]}\n"
    return f"filedesc://pages.arc 0.0.0.0 20000101000000 text/plain {len(body)}\n{body}\n"


# ---- reading ARC

def arc_records(stream: BinaryIO) -> Iterator[dict]:
    """Records of an ARC stream as dicts: url, ip, date, mime, block; the last may hold an error."""
    version, first = 1, True
    while line := stream.readline():
        if line in (b"\n", b"\r\n"):
            continue
        parts = line.rstrip(b"\r\n").decode("utf-8", "replace").split(" ")
        opening, first = first and parts[0].startswith("filedesc:"), False  # a later url may begin so too
        want = 5 if opening and len(parts) == 5 else len(ARC_FIELDS[version].split())
        if len(parts) != want or not parts[-1].isdigit():
            yield {"error": f"version {version} header line of {len(parts)} fields", "url": parts[0][:200]}
            return
        length = int(parts[-1])
        block = stream.read(length)
        if len(block) < length:
            yield {"error": f"{len(block)} of {length} bytes", "url": parts[0]}
            return
        if opening:
            number = block.split(b" ", 1)[0]
            if number not in (b"1", b"2"):
                yield {"error": "unknown version", "url": parts[0]}
                return
            version = int(number)
        yield {"url": parts[0], "ip": parts[1], "date": parts[2], "mime": parts[3], "block": block, "opening": opening}


def split_http(block: bytes) -> tuple[bytes, bytes, dict[str, str]]:
    """HTTP head (with its empty line), payload, and header fields by lower-case name; no head: all is payload."""
    if not block.startswith(b"HTTP/"):
        return b"", block, {}
    for mark in (b"\r\n\r\n", b"\n\n"):
        if (at := block.find(mark)) >= 0:
            head = block[:at + len(mark)]
            fields = (x.decode("utf-8", "replace").split(":", 1) for x in head.splitlines()[1:] if b":" in x)
            return head, block[at + len(mark):], {k.strip().lower(): v.strip() for k, v in fields}
    return block, b"", {}


RECORDS = pa.schema([("kind", pa.string()), ("url", pa.string()), ("ip", pa.string()), ("date", pa.string()),
                     ("mime", pa.string()), ("key", pa.int64()), ("head", pa.binary()), ("payload", pa.binary()),
                     ("payload_digest", pa.string()), ("error", pa.string())])
RECORDS_SQL = ("kind string, url string, ip string, date string, mime string, key bigint, head binary, payload binary, "
               "payload_digest string, error string")
_FLUSH = 8 << 20  # bytes of payload in one Arrow batch


def _batched(rows: Iterator[dict], schema: pa.Schema, size: str) -> Iterator[pa.RecordBatch]:
    held, n = [], 0
    for r in rows:
        held.append(r)
        n += len(r.get(size) or b"") + 500
        if n >= _FLUSH:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held, n = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def _files(batches: Iterator[pa.RecordBatch]) -> Iterator[BinaryIO]:
    for batch in batches:
        for i in range(batch.num_rows):
            data = io.BytesIO(batch.column(0)[i].as_buffer())
            yield io.BufferedReader(gzip.GzipFile(fileobj=data)) if data.getbuffer()[:2] == b"\x1f\x8b" else data


def _parse_arc(batches: Iterator[pa.RecordBatch], key_header: str) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[dict]:
        for stream in _files(batches):
            for r in arc_records(stream):
                if "error" in r:
                    yield {"kind": "error", "url": r["url"], "error": r["error"]}
                    continue
                head, payload, fields = split_http(r["block"])
                key = fields.get(key_header.lower(), "")
                yield {"kind": "warcinfo" if r["opening"] else "response" if head else "resource", "url": r["url"],
                       "ip": r["ip"], "date": r["date"], "mime": r["mime"],
                       "key": int(key) if key.lstrip("-").isdigit() else None, "head": head, "payload": payload,
                       "payload_digest": digest32(payload)}
    return _batched(rows(), RECORDS, "payload")


def read_arc(spark: SparkSession, path: str, key_header: str = KEY_HEADER) -> DataFrame:
    """Records of all ARC files of a folder: kind, url, ip, date, mime, key, head, payload, payload_digest, error."""
    return (spark.read.format("binaryFile").load(path).select("content")
            .mapInArrow(partial(_parse_arc, key_header=key_header), RECORDS_SQL))


# ---- ARC to WARC

def _uuid(*parts) -> F.Column:
    """An identifier made from the SHA-1 of the parts, in the form of a name-based UUID."""
    h = F.sha1(F.concat_ws("|", *parts).cast("binary"))
    return F.concat(F.lit("<urn:uuid:"), F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-5"),
                    F.substring(h, 14, 3), F.lit("-8"), F.substring(h, 18, 3), F.lit("-"), F.substring(h, 21, 12), F.lit(">"))


def convert(records: DataFrame, least: int = 0, skip_errors: bool = False) -> DataFrame:
    """WARC records (``record`` binary, without the last line feed) of ARC records; the job fails on an error row
    (a file that can't be read to its end), unless ``skip_errors`` leaves those out.

    The response of a payload is chosen by a pre-aggregated maximum per digest, joined back.
    """
    key = F.coalesce(F.col("key").cast("string"), F.lit(""))
    bad = F.col("kind") == "error"
    fail = F.raise_error(F.concat(F.lit("unreadable ARC record: "), F.coalesce("error", F.lit("")), F.lit(" at "), F.coalesce("url", F.lit(""))))
    good = records.where(~bad if skip_errors else F.when(bad, fail.cast("boolean")).otherwise(F.lit(True)))
    best = (good.where("kind = 'response'").where(F.octet_length("payload") >= least)
            .groupBy("payload_digest").agg(F.max("key").alias("best")))
    x = good.join(best, "payload_digest", "left")
    revisit = (F.coalesce(F.col("kind") == "response", F.lit(False)) & (F.octet_length("payload") >= least)
               & F.col("best").isNotNull() & (F.col("key").isNull() | (F.col("key") < F.col("best"))))
    kind = F.when(revisit, F.lit("revisit")).otherwise(F.col("kind"))
    own = F.when(kind == "response", _uuid(F.lit("response"), "payload_digest", key)).otherwise(
        _uuid(kind, "payload_digest", key, "url", "date"))
    d = F.col("date")
    cut = lambda a, n: F.substring(d, a, n)
    iso = F.concat(cut(1, 4), F.lit("-"), cut(5, 2), F.lit("-"), cut(7, 2), F.lit("T"), cut(9, 2), F.lit(":"),
                   cut(11, 2), F.lit(":"), cut(13, 2), F.lit("Z"))
    empty = F.lit(b"")
    block = F.concat(F.coalesce("head", empty), F.when(revisit, empty).otherwise(F.col("payload")))
    hexed = F.sha1(block)
    b32 = F.translate(F.concat(*[F.lpad(F.conv(F.substring(hexed, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]),
                      "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    mime = F.when(F.col("kind") == "warcinfo", F.lit("text/plain")).when(
        F.octet_length(F.coalesce("head", empty)) > 0, F.lit("application/http;msgtype=response")).otherwise(F.col("mime"))
    lines = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), kind, F.lit("\r\nWARC-Record-ID: "), own, F.lit("\r\nWARC-Date: "), iso,
        F.when(F.col("kind") == "warcinfo", F.concat(F.lit("\r\nWARC-Filename: "), F.col("url")))
        .otherwise(F.concat(F.lit("\r\nWARC-Target-URI: "), F.col("url"), F.lit("\r\nWARC-IP-Address: "), F.col("ip"),
                            F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("payload_digest"))),
        F.when(revisit, F.concat(
            F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: "),
            _uuid(F.lit("response"), "payload_digest", F.col("best").cast("string")))).otherwise(F.lit("")),
        F.lit("\r\nWARC-Block-Digest: sha1:"), b32, F.lit("\r\nContent-Type: "), mime,
        F.lit("\r\nContent-Length: "), F.octet_length(block).cast("string"), F.lit("\r\n\r\n"))
    return x.select(F.concat(lines.cast("binary"), block, F.lit(b"\r\n\r")).alias("record"))


def write_warc(warc: DataFrame, path: str) -> None:
    """Gzip WARC files, one per partition; the writer's line feed ends a record's two empty lines."""
    warc.select(F.col("record").cast("string").alias("value")).write.option("lineSep", "\n").option("compression", "gzip").text(path)


def warc_records(stream: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields by lower-case name, and block, of every WARC record of a stream."""
    while line := stream.readline():
        if line in (b"\r\n", b"\n"):
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC version line: {line[:80]!r}")
        fields: dict[str, str] = {}
        while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
            k, _, v = line.decode("utf-8", "replace").partition(":")
            fields[k.strip().lower()] = v.strip()
        n = int(fields["content-length"])
        block = stream.read(n)
        if len(block) < n:
            raise ValueError(f"{len(block)} of {n} bytes in {fields.get('warc-record-id')}")
        yield fields, block


WARC_OUT = pa.schema([("record_id", pa.string()), ("record_type", pa.string()), ("url", pa.string()), ("date", pa.string()),
                      ("key", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                      ("refers_to_id", pa.string()), ("payload", pa.binary())])


def _parse_warc(batches: Iterator[pa.RecordBatch], key_header: str, with_payload: bool) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[dict]:
        for stream in _files(batches):
            for f, block in warc_records(stream):
                head, payload, http = split_http(block)
                kind, key = f["warc-type"], http.get(key_header.lower(), "")
                told = f.get("warc-payload-digest", "").removeprefix("sha1:")
                if kind in ("response", "resource") and digest32(payload) != told:
                    raise ValueError(f"digest of {f['warc-record-id']} differs")
                size = int(http.get("content-length", 0)) if kind == "revisit" else len(payload)
                yield {"record_id": f["warc-record-id"], "record_type": kind, "url": f.get("warc-target-uri"),
                       "date": f.get("warc-date"), "key": int(key) if key.lstrip("-").isdigit() else None,
                       "payload_bytes": size, "payload_digest": told or None, "refers_to_id": f.get("warc-refers-to"),
                       "payload": payload if with_payload else None}
    return _batched(rows(), WARC_OUT, "payload")


def read_warc(spark: SparkSession, path: str, key_header: str = KEY_HEADER, with_payload: bool = True) -> DataFrame:
    """Records of all WARC files of a folder, payload digests verified."""
    return (spark.read.format("binaryFile").load(path).select("content")
            .mapInArrow(partial(_parse_warc, key_header=key_header, with_payload=with_payload),
                        "record_id string, record_type string, url string, date string, key bigint, payload_bytes bigint, "
                        "payload_digest string, refers_to_id string, payload binary"))


def resolved(records: DataFrame) -> DataFrame:
    """Responses and revisits with the key that a revisit refers to, found by record id."""
    main = records.where("record_type in ('response', 'revisit')").drop("payload")
    found = (main.where("record_type = 'response'").groupBy(F.col("record_id").alias("refers_to_id"))
             .agg(F.max("key").alias("refers_to")))
    return main.join(found, "refers_to_id", "left")
