"""Legacy archive converter: ARC files to WARC files, and both read back.

Archives are gzipped files that Spark writes, byte for byte, whatever payloads are; each holds about ``ARCHIVE_BYTES``.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator
from datetime import datetime
from itertools import count

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waykit.llm.common import pick, stored
from waykit.session import scratch_dir

ARCHIVE_BYTES = 4 << 20
GZIP_LEVEL = "THREE"  # of nine
FIELDS = {  # header lines of the two versions of the format
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
ORIGINAL_DATE = "20200101000000"
PAGE_HEADER = "X-Page-Id"


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def plain_url(url: str | None) -> str:
    """The URL without characters that would end it in a header line; null is a placeholder."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "") or "about:blank"


# --- writing ARC ---------------------------------------------------------------------------------


def arc_record(version: int, url: str, mime: str, block: bytes, name: str, offset: int) -> bytes:
    known = {
        "URL": url, "IP-address": "0.0.0.0", "Archive-date": ORIGINAL_DATE, "Content-type": mime, "Result-code": "200",
        "Checksum": "-", "Location": "-", "Offset": str(offset), "Filename": name, "Archive-length": str(len(block)),
    }
    return " ".join(known[f] for f in FIELDS[version].split()).encode() + b"\n" + block


def http_response(page_id: int | None, payload: bytes) -> bytes:
    number = f"{PAGE_HEADER}: {page_id}\r\n" if page_id is not None else ""
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{number}Content-Length: {len(payload)}\r\n\r\n".encode() + payload


def _files(values: list[bytes]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(values, pa.binary())], ["value"])


def pack_arc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per archive, of versions 1 and 2 in turn."""
    number, parts, size = count(), [], 0
    for batch in batches:
        for page_id, url, html in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if not parts:
                turn = next(number)
                version, name = 1 + turn % 2, f"legacy-{turn}.arc"
                about = f"{version} 0 waykit\n{FIELDS[version]}\n".encode()
                parts = [arc_record(version, f"filedesc://{name}", "text/plain", about, name, 0)]
                size = len(parts[0]) + 1
            block = http_response(page_id, (html or "").encode())
            parts.append(arc_record(version, plain_url(url), "text/html", block, name, size))
            size += len(parts[-1]) + 1
            if size >= ARCHIVE_BYTES:
                yield _files([b"\n".join(parts)])
                parts = []
    if parts:
        yield _files([b"\n".join(parts)])


def write_archives(rows: DataFrame, path: str, separator: str) -> None:
    """Every binary row as one gzipped file, its records followed by ``separator``; packed at a faster level than the default.

    The text sink writes a string's bytes as they are, and the cast does not look at them.
    """
    writer = rows.select(F.col("value").cast("string")).write.option("maxRecordsPerFile", 1).option("compression", "gzip").option("lineSep", separator)
    writer.option("zlib.compress.level", GZIP_LEVEL).text(path)


def write_arc(pages: DataFrame, path: str) -> None:
    rows = pick(pages, page_id="bigint", url="string", html="string")
    write_archives(rows.mapInArrow(pack_arc, "value binary"), path, "\n")


# --- reading ARC ---------------------------------------------------------------------------------


def parse_arc(data: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, header fields, block) of every record after the version block.

    The version block names the fields of all later header lines. A URL may hold spaces, the other fields may
    not, so lines are split from the right. Blocks have the declared length, whatever they contain. A header line that does
    not fit, or a block that ends early, raises ValueError: nothing after it could be trusted.
    """
    fields: list[str] | None = None
    at = 0
    while True:
        while data[at : at + 1] in (b"\n", b"\r"):
            at += 1
        if at >= len(data):
            return
        end = data.find(b"\n", at)
        line = data[at : end if end >= 0 else len(data)].decode("utf-8", "surrogateescape").rstrip("\r")
        if end < 0 or not line.rpartition(" ")[2].isdigit():
            raise ValueError(f"no ARC header line at byte {at}")
        length = int(line.rpartition(" ")[2])
        block = data[end + 1 : end + 1 + length]
        if len(block) < length:
            raise ValueError(f"ARC record at byte {at} ends early")
        if fields is None:
            about = block.decode().split("\n")
            if not line.startswith("filedesc:") or len(about) < 2 or about[0].split(" ")[0] not in ("1", "2"):
                raise ValueError("no ARC version block")
            fields = about[1].split()
        else:
            values = line.rsplit(" ", len(fields) - 1)
            if len(values) != len(fields):
                raise ValueError(f"ARC header at byte {at} has {len(values)} fields, not {len(fields)}")
            yield at, dict(zip(fields, values, strict=True)), block
        at = end + 1 + length


def split_http(block: bytes) -> tuple[bytes, bytes]:
    head, gap, body = block.partition(b"\r\n\r\n")
    return head + gap, body


def head_value(head: bytes, name: str) -> str | None:
    found = re.search(rb"(?im)^" + name.encode() + rb":[ \t]*([^\r\n]*)", head)
    return found[1].decode("utf-8", "replace").strip() if found else None


def whole_number(text: str | None) -> int | None:
    """A number of the signed 64-bit range, else none."""
    n = int(text) if text and re.fullmatch(r"-?\d{1,19}", text) else None
    return n if n is not None and -(2**63) <= n < 2**63 else None


def warc_date(arc_date: str) -> str:
    """ARC dates have 4 to 14 digits; missing ones are the start of their span. Anything else raises ValueError."""
    d = arc_date + "00000101000000"[len(arc_date) :]
    if not re.fullmatch(r"[0-9]{4,14}", arc_date):
        raise ValueError(f"no date: {arc_date!r}")
    datetime.strptime(d, "%Y%m%d%H%M%S")
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def escaped(text: str) -> str:
    """Bytes of a header line that were not UTF-8, as percent escapes."""
    return re.sub("[\udc80-\udcff]", lambda m: f"%{ord(m[0]) - 0xDC00:02X}", text)


def unpacked(content: bytes) -> bytes:
    """An archive's bytes; legacy files have one gzip member, one per record, or none."""
    return gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content


def record_id(archive: str, offset: int, url: str) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha1(f'{archive} {offset} {url}'.encode('utf-8', 'surrogateescape')).digest()[:16], version=5)}>"


RECORDS = pa.schema(
    [("record_id", pa.string()), ("url", pa.string()), ("date", pa.string()), ("mime", pa.string()),
     ("page_id", pa.int64()), ("digest", pa.string()), ("length", pa.int64())]
)
CONTENT = [("head", pa.binary()), ("body", pa.binary())]
RECORD_COLUMNS = "record_id string, url string, date string, mime string, page_id bigint, digest string, length bigint"


def arc_records(with_content: bool):
    """A map over (path, gzipped archive) to its records, with synthesised identifiers, dates and digests."""
    schema = pa.schema([*RECORDS, *CONTENT]) if with_content else RECORDS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1), strict=True):
                name = path.as_py().rpartition("/")[2]
                rows = []
                for offset, header, block in parse_arc(unpacked(content.as_py())):
                    http = header["URL"].lower().startswith(("http:", "https:")) or block.startswith(b"HTTP/")
                    head, body = split_http(block) if http else (b"", block)
                    try:
                        date = warc_date(header["Archive-date"])
                    except ValueError as e:
                        raise ValueError(f"ARC record at byte {offset} of {name}: {e}") from e
                    row = (
                        record_id(name, offset, header["URL"]), escaped(header["URL"]), date,
                        "application/http; msgtype=response" if http else escaped(header["Content-type"]),
                        whole_number(head_value(head, PAGE_HEADER)), sha1_base32(body), len(body),
                    )
                    rows.append(row + ((head, body) if with_content else ()))
                columns = list(zip(*rows, strict=True)) or [[]] * len(schema)
                yield pa.record_batch([pa.array(list(c), t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)

    return run


def read_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


# --- WARC ----------------------------------------------------------------------------------------


def warc_record(row: dict) -> bytes:
    """A response (resource where it is not HTTP), or a revisit that names the response with the same payload."""
    lines = ["WARC/1.0"]
    block = row["head"] + row["body"]
    kind = "response" if row["mime"].startswith("application/http") else "resource"
    more = []
    if row["keeper_id"] is not None and row["keeper_id"] != row["record_id"]:
        kind, block = "revisit", row["head"]
        more = [
            f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {row['keeper_id']}",
            f"WARC-Refers-To-Target-URI: {row['keeper_url']}", f"WARC-Refers-To-Date: {row['keeper_date']}",
        ]
    lines += [
        f"WARC-Type: {kind}", f"WARC-Record-ID: {row['record_id']}", f"WARC-Date: {row['date']}",
        f"WARC-Target-URI: {row['url']}", f"WARC-Payload-Digest: sha1:{row['digest']}",
        f"WARC-Block-Digest: sha1:{sha1_base32(block)}", *more, f"Content-Type: {row['mime']}", f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(lines).encode("utf-8", "surrogateescape") + b"\r\n\r\n" + block


def pack_warc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    info = b"software: waykit\r\nformat: WARC File Format 1.0\r\n"
    parts, size = [], 0
    for batch in batches:
        names = batch.schema.names
        for values in zip(*(batch.column(i) for i in range(len(names))), strict=True):
            row = {n: v.as_py() for n, v in zip(names, values, strict=True)}
            if not parts:
                about = record_id(row["record_id"], 0, "warcinfo")
                head = f"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: {about}\r\nWARC-Date: {row['date']}\r\n"
                parts = [f"{head}Content-Type: application/warc-fields\r\nContent-Length: {len(info)}\r\n\r\n".encode() + info]
            parts.append(warc_record(row))
            size += len(parts[-1])
            if size >= ARCHIVE_BYTES:
                yield _files([b"\r\n\r\n".join(parts)])
                parts, size = [], 0
    if parts:
        yield _files([b"\r\n\r\n".join(parts)])


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record, by declared length."""
    at = 0
    while at < len(data):
        if data[at : at + 2] == b"\r\n":
            at += 2
            continue
        end = data.find(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8", "surrogateescape").split("\r\n") if end >= 0 else [""]
        headers = dict(line.split(": ", 1) for line in lines[1:])
        if not lines[0].startswith("WARC/") or "Content-Length" not in headers:
            raise ValueError(f"no WARC record at byte {at}")
        length = int(headers["Content-Length"])
        block = data[end + 4 : end + 4 + length]
        if len(block) < length:
            raise ValueError(f"WARC record at byte {at} ends early")
        yield headers, block
        at = end + 4 + length


WARC_ROWS = pa.schema(
    [("record_id", pa.string()), ("record_type", pa.string()), ("url", pa.string()), ("date", pa.string()),
     ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to_id", pa.string())]
)


def warc_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records as read back. Stored payloads are measured and digested anew; a digest that differs raises."""
    for batch in batches:
        for content in batch.column(1):
            rows = []
            for h, block in parse_warc(unpacked(content.as_py())):
                if h["WARC-Type"] == "warcinfo":
                    continue
                head, body = split_http(block) if h["Content-Type"].startswith("application/http") else (b"", block)
                length, digest = len(body), h["WARC-Payload-Digest"].removeprefix("sha1:")
                if h["WARC-Type"] == "revisit":
                    length = whole_number(head_value(head, "Content-Length"))
                elif sha1_base32(body) != digest:
                    raise ValueError(f"payload of {h['WARC-Record-ID']} does not have its digest")
                page = whole_number(head_value(head, PAGE_HEADER))
                rows.append((h["WARC-Record-ID"], h["WARC-Type"], h["WARC-Target-URI"], h["WARC-Date"], page, length, digest, h.get("WARC-Refers-To")))
            columns = list(zip(*rows, strict=True)) or [[]] * len(WARC_ROWS)
            yield pa.record_batch([pa.array(list(c), t) for c, t in zip(columns, WARC_ROWS.types, strict=True)], schema=WARC_ROWS)


def convert(spark: SparkSession, arc_path: str, warc_path: str, dedup_bytes: int = 0) -> None:
    """Write the records of all ARC files below ``arc_path`` as WARC files below ``warc_path``.

    Of records with equal payloads of at least ``dedup_bytes`` bytes the one with the smallest page number (none
    last; then the smallest identifier) is kept, others become revisits of it. Archives are parsed twice: first for digests
    alone, which are combined before the shuffle, then with their content, which is joined to the shared digests.
    Spark splits that join where one payload is very common. Payloads may be any bytes; bytes of a URL that are not
    UTF-8 become percent escapes. A header line, length or date that cannot be read raises an error with the byte offset.
    """
    archives = read_files(spark, arc_path)
    first = F.min(F.struct(F.col("page_id").isNull().alias("no_page"), "page_id", "record_id", "url", "date")).alias("k")
    same = (
        archives.mapInArrow(arc_records(False), RECORD_COLUMNS)
        .where(F.col("length") >= dedup_bytes)
        .groupBy("digest", "length")
        .agg(F.count("*").alias("held"), first)
        .where("held > 1")
        .select("digest", "length", *[F.col(f"k.{c}").alias(f"keeper_{n}") for c, n in (("record_id", "id"), ("url", "url"), ("date", "date"))])
    )
    records = archives.mapInArrow(arc_records(True), RECORD_COLUMNS + ", head binary, body binary")
    write_archives(records.join(same, ["digest", "length"], "left").mapInArrow(pack_warc, "value binary"), warc_path, "\r\n\r\n")


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(record_id, record_type, url, date, page_id, payload_bytes, payload_digest, refers_to_id) of every record."""
    return read_files(spark, path).mapInArrow(
        warc_rows,
        "record_id string, record_type string, url string, date string, page_id bigint, payload_bytes bigint, "
        "payload_digest string, refers_to_id string",
    )


def archive_pages(pages: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, url, date): pages written as ARC, converted
    to WARC, and read back; one row per row of ``pages``.

    Null html is an empty payload, null url a placeholder, a page without page_id is written without number
    and sorts last. Pages that repeat a page_id are records of their own; of equal ones the smallest record
    identifier is the response. Other columns are ignored. An empty table gives no rows.
    """
    spark = pages.sparkSession
    arcs, warcs = scratch_dir(spark, "arc"), scratch_dir(spark, "warc")
    write_arc(pages, arcs)
    convert(spark, arcs, warcs)
    # The narrow rows are stored, since both sides of the join need them: archives are unpacked and digested once.
    records = stored(read_warc(spark, warcs), "warc-records")
    kept = records.where("record_type <> 'revisit'").select(
        F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to")
    )
    return records.join(kept, "refers_to_id", "left").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "date"
    )


def digest(pages: DataFrame) -> DataFrame:
    return archive_pages(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


# The digest's base 32 digits, five bits at a time from the hexadecimal form.
ORACLE = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS b FROM pages),
x AS (SELECT b, min(page_id) AS first_id FROM p GROUP BY b),
k AS (SELECT p.page_id, strlen(p.b) AS n, sha1(p.b) AS hex, x.first_id FROM p JOIN x USING (b)),
d AS (SELECT *, list_aggregate(list_transform(range(0, 32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(hex, 1 + 10 * (i // 8), 10))::BIGINT >> (35 - 5 * (i % 8))) & 31)::INT, 1)),
    'string_agg', '') AS digest FROM k)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM d
"""
