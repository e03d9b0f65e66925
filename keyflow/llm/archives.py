"""Legacy web archives: ARC files are parsed by version and declared lengths and become WARC files.

An ARC file starts with a version block whose number says how many fields the header line of a record has; the last
field is the length of what follows. From each record the converter makes a WARC record: type by the scheme and the
HTTP head, date from the 14 digits, a record id from uri, date and digest, and SHA-256 digests. Of records with equal
payloads of at least ``REVISIT_BYTES`` bytes the first page's is a response and the others revisit it.

Spark's own writer puts the files out, one row a file of about ``FILE_BYTES``, so any store that Spark knows will do,
and a lost task writes its files again. Files are read whole, one at a time.

A null html is an empty payload, a null url ``unknown:``; a null page_id stays null and is never a first page.
Repeated rows are records of their own.
"""

from __future__ import annotations

import datetime
import hashlib
import itertools
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyflow.llm.common import in_batches, shared_folder, table

FILE_BYTES, REVISIT_BYTES = 8 << 20, 100
#: The fields of a header line by version of the ARC format.
ARC_FIELDS = {
    1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    2: ["URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"],
}
RECORD = "uri string, date string, kind string, head binary, payload binary, payload_bytes long, digest string, page_id long"


def _uri(url: str | None) -> str:
    """Without blanks and control characters, which would break a header line."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else "unknown:"


def arc_header(version: int, uri: str, date: str, kind: str, length: int) -> bytes:
    known = {"URL": uri, "IP-address": "0.0.0.0", "Archive-date": date, "Content-type": kind, "Result-code": "200", "Offset": "0", "Archive-length": str(length)}
    return (" ".join(known.get(f, "-") for f in ARC_FIELDS[version]) + "\n").encode()


def arc_file(version: int, records: list[tuple[str, str, str, bytes]]) -> bytes:
    """An ARC file without its last line end. Records: uri, date, type, body."""
    about = f"{version} 0 keyflow\n{' '.join(ARC_FIELDS[version])}\n".encode()
    return b"\n".join(arc_header(version, uri, date, kind, len(body)) + body for uri, date, kind, body in [("filedesc://pages.arc", "20200101000000", "text/plain", about), *records])


def parse_arc(data: bytes) -> Iterator[tuple[str, str, str, bytes]]:
    """(uri, date, type, body) of each record but the version block. A length that runs over the end takes what is there;
    behind a header line whose length is no number nothing can be found, so the file ends there. Unknown versions count as 1."""
    at, fields = 0, None
    while at < len(data):
        end = data.find(b"\n", at)
        if end < 0:
            return
        line = data[at:end].strip()
        at = end + 1
        if not line:
            continue
        # from the right, as a url of old files may hold blanks
        values = line.decode("utf-8", "replace").rsplit(" ", len(fields or ARC_FIELDS[1]) - 1)
        if not re.fullmatch(r"\d+", values[-1]):
            return
        length = int(values[-1])
        body, at = data[at : at + length], at + length
        if fields is None:
            version = body[:1].decode("ascii", "replace")
            fields = ARC_FIELDS[int(version) if version in ("1", "2") else 1]
            continue
        row = dict.fromkeys(fields, "-") | dict(zip(fields, values, strict=False))
        yield row["URL"], row["Archive-date"], row["Content-type"], body


def warc_date(digits: str) -> str:
    """14 digits or fewer, which are filled up with the earliest; anything else, and what is no date, is 1970."""
    if not re.fullmatch(r"[0-9]{4,14}", digits):
        digits = "1970"
    d = (digits + "00000101000000"[len(digits) :])[:14] if len(digits) > 4 else digits + "0101000000"
    try:
        datetime.datetime.strptime(d, "%Y%m%d%H%M%S")
    except ValueError:
        d = "19700101000000"
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def warc_kind(uri: str, body: bytes) -> str:
    """A body with an HTTP head is a response whatever its scheme, as of a proxy; all else is a resource."""
    return "response" if body.startswith(b"HTTP/") and b"\r\n\r\n" in body else "resource"


def record_id(uri: str, date: str, digest: str, page: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{uri} {date} {digest} {page}')}>"


def _page_of(head: bytes) -> int | None:
    m = re.search(rb"(?m)^X-Page-Id: (-?\d+)\r?$", head)
    return int(m[1]) if m else None


def pages_to_arc(pages: DataFrame) -> DataFrame:
    """pages (page_id, url, html) as rows of whole ARC files; versions alternate by task. The page_id travels as an HTTP header."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        version, records, held = 1 + TaskContext.get().partitionId() % 2, [], 0
        put = lambda: pa.RecordBatch.from_arrays([pa.array([arc_file(version, records)], pa.binary())], ["content"])
        for batch in batches:
            for page, url, html in zip(*(batch.column(i) for i in range(3)), strict=True):
                page, html = page.as_py(), (html.as_py() or "").encode()
                head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + (b"X-Page-Id: %d\r\n" % page if page is not None else b"") + b"\r\n"
                second = (page or 0) % 86400
                records.append((_uri(url.as_py()), f"20200101{second // 3600:02d}{second // 60 % 60:02d}{second % 60:02d}", "text/html", head + html))
                held += len(html)
                if held >= FILE_BYTES:
                    yield put()
                    records, held = [], 0
        if records:
            yield put()

    return in_batches(pages.select("page_id", "url", "html")).mapInArrow(pack, "content binary")


def read_arc(files: DataFrame) -> DataFrame:
    """Records of rows that each hold an ARC file in ``content``, with what WARC wants to know of them."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for uri, date, _, body in parse_arc(unzipped(content.as_py())):
                    kind = warc_kind(uri, body)
                    cut = body.find(b"\r\n\r\n") + 4 if kind == "response" else 0
                    head, payload = body[:cut], body[cut:]
                    rows.append((uri, warc_date(date), kind, head, payload, len(payload), hashlib.sha256(payload).hexdigest(), _page_of(head)))
                for i in range(0, len(rows), 500):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows[i : i + 500], strict=True), (pa.string(), pa.string(), pa.string(), pa.binary(), pa.binary(), pa.int64(), pa.string(), pa.int64()), strict=True)],
                        ["uri", "date", "kind", "head", "payload", "payload_bytes", "digest", "page_id"],
                    )

    return files.select("content").mapInArrow(parse, RECORD)


def with_revisits(records: DataFrame) -> DataFrame:
    """records with refers_to: for a payload that a smaller page_id has as well, that page; else null.

    Counting by digest is pre-aggregated in each task, and only digests that occur twice are joined back.
    """
    firsts = (
        records.where((F.col("payload_bytes") >= REVISIT_BYTES) & F.col("page_id").isNotNull())
        .groupBy("digest")
        .agg(F.min(F.struct("page_id", "uri", "date")).alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("digest", "first")
    )
    later = F.when((F.col("payload_bytes") >= REVISIT_BYTES) & (F.col("page_id") > F.col("first.page_id")), F.col("first"))
    return records.join(firsts, "digest", "left").withColumn("first", later)


def warc_record(uri, date, kind, head, payload, size, digest, page, first) -> bytes:
    """A WARC record without the two line ends that close it."""
    lines = ["WARC/1.0", f"WARC-Type: {'revisit' if first else kind}", f"WARC-Record-ID: {record_id(uri, date, digest, page)}", f"WARC-Date: {date}", f"WARC-Target-URI: {uri}", f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {size}"]
    if first:
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest",
            f"WARC-Refers-To: {record_id(first['uri'], first['date'], digest, first['page_id'])}",
            f"WARC-Refers-To-Target-URI: {first['uri']}",
            f"WARC-Refers-To-Date: {first['date']}",
            f"X-Refers-To-Page-Id: {first['page_id']}",
        ]
    block = head if first else head + payload
    lines += [f"Content-Type: {'application/http; msgtype=response' if head else 'application/octet-stream'}", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block


def write_warc(records: DataFrame, folder: str) -> None:
    """Write records (see with_revisits) as gzipped WARC files of about FILE_BYTES before compression."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, files = TaskContext.get().partitionId(), itertools.count()

        def info() -> bytes:
            name = uuid.uuid5(uuid.NAMESPACE_URL, f"{folder} {part} {next(files)}")
            return b"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:%s>\r\nWARC-Date: 2020-01-01T00:00:00Z\r\nContent-Type: application/warc-fields\r\nContent-Length: 18\r\n\r\nsoftware: keyflow\n" % str(name).encode()

        held, size = [info()], 0
        put = lambda: pa.RecordBatch.from_arrays([pa.array([b"\r\n\r\n".join(held)], pa.binary())], ["content"])
        for batch in batches:
            for row in zip(*(batch.column(c) for c in ("uri", "date", "kind", "head", "payload", "payload_bytes", "digest", "page_id", "first")), strict=True):
                held.append(warc_record(*(x.as_py() for x in row)))
                size += len(held[-1])
                if size >= FILE_BYTES:
                    yield put()
                    held, size = [info()], 0
        if len(held) > 1:
            yield put()

    files = records.select("uri", "date", "kind", "head", "payload", "payload_bytes", "digest", "page_id", "first").mapInArrow(pack, "content binary")
    (
        files.select(F.col("content").cast("string").alias("value"))
        .write.option("lineSep", "\r\n\r\n")
        .option("maxRecordsPerFile", 1)
        .option("compression", "gzip")
        .option("zlib.compress.level", "BEST_SPEED")
        .text(folder)
    )


def unzipped(data: bytes) -> bytes:
    """All members of a gzip file; what does not start a member ends it. Bytes that are no gzip are given back."""
    if data[:2] != b"\x1f\x8b":
        return data
    out = []
    while data[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(31)
        out.append(member.decompress(data) + member.flush())
        data = member.unused_data
    return b"".join(out)


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields in lower case, block) of each record, by declared lengths."""
    at = 0
    while (end := data.find(b"\r\n\r\n", at)) >= 0:
        lines = data[at:end].lstrip(b"\r\n").decode("utf-8", "replace").split("\r\n")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        length = int(fields["content-length"])
        yield fields, data[end + 4 : end + 4 + length]
        at = end + 4 + length + 4


PAGE = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, uri string"


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """A row for each response, resource and revisit; size and digest of stored payloads are computed anew."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for fields, block in parse_warc(unzipped(content.as_py())):
                    kind = fields["warc-type"]
                    if kind == "warcinfo":
                        continue
                    http = fields["content-type"].startswith("application/http")
                    cut = block.find(b"\r\n\r\n") + 4 if http else 0
                    size, digest = len(block) - cut, ""
                    if kind == "revisit":
                        size, digest = int(fields["x-payload-length"]), fields["warc-payload-digest"].partition(":")[2]
                    else:
                        digest = hashlib.sha256(memoryview(block)[cut:]).hexdigest()
                    of = fields.get("x-refers-to-page-id")
                    rows.append((_page_of(block[:cut]), size, digest, kind, int(of) if of else None, fields["warc-target-uri"]))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()), strict=True)],
                        ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "uri"],
                    )

    return spark.read.format("binaryFile").load(folder).select("content").mapInArrow(parse, PAGE)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "warc")
    write_warc(with_revisits(read_arc(pages_to_arc(table(spark, sf_dir, "pages")))), folder)
    return read_warc(spark, folder).drop("uri")


ORACLE = f"""
with p as (select page_id, octet_length(encode(coalesce(html, '')))::bigint as n, sha256(coalesce(html, '')) as digest from pages),
f as (select *, case when n >= {REVISIT_BYTES} then min(page_id) over (partition by digest) end as first from p)
select page_id, n as payload_bytes, digest as payload_digest, case when first < page_id then 'revisit' else 'response' end as record_type,
  case when first < page_id then first end as refers_to from f"""
QUERIES = {"op10_warc": op10_warc}
ORACLES = {"op10_warc": ORACLE}
