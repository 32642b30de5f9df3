"""Web archives: legacy ARC files converted to WARC, WARC files written and read through Spark.

An ARC file is a version block and records, each a header line and as many bytes as the line
declares. The version block names the fields of the header lines (five in version 1, ten in version
2); lines are read by those names. Each ARC record becomes a WARC response record with an identifier, timestamp, type
and digests made from what the ARC record holds. Payloads found more than once keep one response;
the others become revisits of it.

Spark's text writer puts down the records' bytes, two line ends after each, so the files are plain WARC.
Files are cut by bytes: pages are written by classes of their size, each with as many records a file as hold FILE_BYTES at most,
and a warcinfo record is put where each file begins.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import UTC, datetime, timedelta

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.shared import by_bytes, fresh_path, settled, table, trimmed

#: Fixed values of the formats.
VERSION_FIELDS = {1: "URL IP-address Archive-date Content-type Archive-length", 2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"
#: Bytes of payload in a file at most, unless a single record has more; a file is read by one task.
FILE_BYTES = 64 << 20
#: Payloads of at most so many bytes are of the smallest class; each class that follows holds four times as large ones.
SMALL = 64 << 10
FIRST_DATE = datetime(2020, 1, 1, tzinfo=UTC)
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # of URLs

ENTRY = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("date", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.large_binary())])
ENTRY_SQL = "page_id long, url string, date string, record_type string, payload_bytes long, payload_digest string, refers_to long"


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


@dataclass
class ArcRecord:
    url: str
    ip: str
    date: str
    mime: str
    body: bytes


def write_arc(records: list[ArcRecord], version: int, name: str = "pages.arc") -> bytes:
    """An ARC file of version 1 or 2."""
    head = f"{version} 0 siltstone\n{VERSION_FIELDS[version]}\n\n".encode()
    stamp = f"{FIRST_DATE:%Y%m%d%H%M%S}"
    extra = b" 200 - -" + f" 0 {name}".encode() if version == 2 else b""
    out = [f"filedesc://{name} 0.0.0.0 {stamp} text/plain".encode() + extra + f" {len(head)}\n".encode(), head]
    at = sum(map(len, out))
    for r in records:
        extra = f" 200 {digest(r.body)} - {at + 1} {name}" if version == 2 else ""
        line = f"\n{r.url} {r.ip} {r.date} {r.mime}{extra} {len(r.body)}\n".encode()
        out += [line, r.body]
        at += len(line) + len(r.body)
    return b"".join([*out, b"\n"])


@dataclass
class BadRecord:
    """Where in a file no ARC record could be read, and why."""

    offset: int
    problem: str


def read_arc(data: bytes, lenient: bool = False) -> Iterator[ArcRecord | BadRecord]:
    """The records of an ARC file, the version block aside. A version block or header line that is not one, or a length beyond the
    file, raises ValueError; lenient, it gives a BadRecord, and reading goes on at the next header line."""
    fields, at = None, 0
    while at < len(data):
        if data[at : at + 1] in (b"\n", b"\r"):
            at += 1
            continue
        try:
            found, end = _arc_record(data, at, fields)
        except (ValueError, KeyError, IndexError) as e:
            if not lenient:
                raise ValueError(f"byte {at}: {e}") from None
            yield BadRecord(at, str(e)[:300])
            if fields is None:
                return
            at = _next_header(data, at, fields)
            continue
        if fields is None:
            fields = found
        else:
            yield found
        at = end


def _arc_record(data: bytes, at: int, fields: list[str] | None) -> tuple:
    """The record at a byte, or, without fields, the fields that the version block names; and where it ends."""
    end = data.find(b"\n", at)
    line = data[at : end if end >= 0 else len(data)].decode("utf-8", "replace").rstrip("\r")
    parts = line.rsplit(" ", len(fields) - 1) if fields else line.split(" ")
    if end < 0 or (fields and len(parts) != len(fields)):
        raise ValueError(f"ARC header line of {len(parts)} fields: {line[:200]}")
    size = int(parts[-1])
    body, stop = data[end + 1 : end + 1 + size], end + 1 + size
    if size < 0 or len(body) != size:
        raise ValueError(f"ARC record cut short: {line[:200]}")
    if fields is None:
        if not line.startswith("filedesc:"):
            raise ValueError("no ARC version block")
        named = body.decode("utf-8", "replace").split("\n")[1].split(" ")
        if named[-1] != "Archive-length":
            raise ValueError(f"unknown ARC fields: {named}")
        return named, stop
    of = dict(zip(fields, parts, strict=True))
    warc_date(of["Archive-date"])
    return ArcRecord(of["URL"], of["IP-address"], of["Archive-date"], of["Content-type"], body), stop


def _next_header(data: bytes, at: int, fields: list[str]) -> int:
    """The next place after `at` where a line begins that is a header of a whole record."""
    while (at := data.find(b"\n", at) + 1) > 0:
        try:
            if b":" in data[at : at + 200].split(b" ", 1)[0]:
                _arc_record(data, at, fields)
                return at
        except (ValueError, KeyError, IndexError):
            continue
    return len(data)


def warc_date(date: str) -> str:
    """An ARC date of 4 to 14 digits as a WARC date."""
    return datetime.strptime((date[:14] + "00000101000000"[len(date[:14]) :]), "%Y%m%d%H%M%S").strftime("%Y-%m-%dT%H:%M:%SZ")


def http_parts(body: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (lower case) and payload of an HTTP response; anything else is payload alone."""
    if not body.startswith(b"HTTP/") or (end := body.find(END)) < 0:
        return {}, body
    lines = body[:end].decode("latin-1").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}, body[end + 4 :]


def record_id(page: str | None, sha: str, url: str = "", date: str = "") -> str:
    """The identifier of a capture: of its page and payload, where it has a page; else of url, date and payload."""
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{page}:{sha}' if page is not None else f'{url} {date} {sha}')}>"


def warc_record(fields: list[tuple[str, object]], block: bytes = b"") -> bytes:
    """A record without the line ends that follow it."""
    head = "\r\n".join(["WARC/1.1", *(f"{k}: {v}" for k, v in fields if v is not None), f"Content-Length: {len(block)}"])
    return head.encode() + END + block


def converted(r: ArcRecord, keep: int | None = None) -> bytes:
    """The WARC record of an ARC record: a response, or, where another page keeps the payload, a revisit of that."""
    date = warc_date(r.date)
    http, payload = http_parts(r.body)
    page, sha = http.get("x-page-id"), digest(payload)
    fields = [("WARC-Record-ID", record_id(page, sha, r.url, date)), ("WARC-Date", date), ("WARC-Target-URI", r.url), ("WARC-IP-Address", r.ip), ("WARC-Payload-Digest", f"sha1:{sha}")]
    if keep is None or page == str(keep):
        kind = "response" if r.body.startswith(b"HTTP/") else "resource"
        mime = "application/http; msgtype=response" if kind == "response" else r.mime
        return warc_record([("WARC-Type", kind), *fields, ("WARC-Block-Digest", f"sha1:{digest(r.body)}"), ("Content-Type", mime)], r.body)
    block = r.body[: len(r.body) - len(payload)]
    refers = [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(str(keep), sha)), ("X-Refers-To-Page-Id", keep), ("X-Payload-Length", len(payload))]
    return warc_record([("WARC-Type", "revisit"), *fields, *refers, ("WARC-Block-Digest", f"sha1:{digest(block)}"), ("Content-Type", "application/http; msgtype=response")], block)


def read_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (lower case) and block of each record, by the declared lengths."""
    at = 0
    while at < len(data):
        if not data.startswith(b"WARC/", at) or (end := data.find(END, at)) < 0:
            raise ValueError(f"no WARC record at byte {at}")
        lines = data[at:end].decode("utf-8", "replace").split("\r\n")[1:]
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        size = int(fields["content-length"])
        if end + 4 + size > len(data):
            raise ValueError("WARC record cut short")
        yield fields, data[end + 4 : end + 4 + size]
        at = end + 4 + size
        while data.startswith(b"\r\n", at):
            at += 2


def page_arc(page_id: int | None, url: str | None, html: str | None) -> ArcRecord:
    """A page as an ARC capture; its id travels in an HTTP header. Blanks in the address are escaped."""
    payload = (html or "").encode()
    named = f"X-Page-Id: {page_id}\r\n" if page_id is not None else ""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{named}Content-Length: {len(payload)}\r\n\r\n".encode()
    where = "".join(c if c.isprintable() and not c.isspace() else f"%{ord(c):02X}" for c in url or "") or "urn:unknown"
    when = FIRST_DATE + timedelta(seconds=(page_id or 0) % 10**8)
    return ArcRecord(where, "0.0.0.0", f"{when:%Y%m%d%H%M%S}", "text/html", head + payload)


def warcinfo() -> bytes:
    return warc_record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", f"{FIRST_DATE:%Y-%m-%dT%H:%M:%SZ}"), ("Content-Type", "application/warc-fields")], b"software: siltstone\r\nformat: WARC File Format 1.1\r\n")


def write_warc(pages: DataFrame, path: str, least_bytes: int = 0, file_bytes: int = FILE_BYTES, compression: str = "none", small: int = SMALL) -> None:
    """Writes a record for each row of pages (page_id, url, html) through the ARC converter. Of equal payloads of at least
    `least_bytes` bytes the one of the largest page_id is a response, the others are revisits of it.

    Null html is an empty payload. Null ids keep no payload for others; where all ids are null, all are
    responses; rows of the largest id itself are all responses. An empty table writes files without a page.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("sha", F.unhex(F.sha1(F.col("html").cast("binary"))))
    several = rows.filter(F.octet_length("html") >= least_bytes).groupBy(F.col("sha").alias("of")).agg(F.max("page_id").alias("keep"), F.count("*").alias("n")).filter("n > 1").drop("n")
    several = settled(several, "payloads")
    known = rows.join(several, F.col("sha") == F.col("of"), "left").select("page_id", "url", "html", "keep")
    size = F.greatest(F.ceil(F.log(4.0, F.greatest(F.octet_length("html"), F.lit(1)) / small)), F.lit(0)).cast("int")
    classes = sorted(r["k"] for r in rows.select(size.alias("k")).distinct().collect()) or [0]  # a row a class, 16 at most

    for k in classes:
        records = max(2, file_bytes // (small * 4**k))
        lines = (known if len(classes) == 1 else known.filter(size == k)).mapInArrow(_records(records), "record binary").select(F.col("record").cast("string").alias("value"))
        lines.write.mode("append").option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", records).option("compression", compression).text(path)


def _records(records: int):
    """The WARC records of pages, with a warcinfo record before each `records - 1` of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        version, since = 1, records
        for batch in batches:
            ids, urls, html, keeps = (batch.column(c).to_pylist() for c in ("page_id", "url", "html", "keep"))
            for a, b in by_bytes(html):
                version = 3 - version
                legacy, out = write_arc([page_arc(*x) for x in zip(ids[a:b], urls[a:b], html[a:b], strict=True)], version), []
                for r, k in zip(read_arc(legacy), keeps[a:b], strict=True):
                    if since == records:
                        out.append(warcinfo())
                        since = 1
                    out.append(converted(r, k))
                    since += 1
                yield pa.record_batch({"record": pa.array(out, pa.binary())})
        trimmed()

    return run


def entries(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """One row for each response, resource or revisit record under path: page_id (null where the record has none),
    url, date, record_type, payload_bytes, payload_digest, refers_to, and the payload if asked for. Payloads are checked
    against their digests, and one that differs ends the job; files may be gzip-compressed; no files, or files without such records, give no rows."""
    schema = ENTRY if with_payload else pa.schema(list(ENTRY)[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        for batch in batches:
            for content in batch.column("content"):
                data, rows = content.as_py(), []
                if data[:2] == b"\x1f\x8b":
                    data = zlib.decompress(data, 31)
                for fields, block in read_warc(data):
                    kind = fields["warc-type"]
                    if kind not in ("response", "resource", "revisit"):
                        continue
                    http, payload = http_parts(block)
                    sha = fields["warc-payload-digest"].removeprefix("sha1:")
                    if kind != "revisit" and digest(payload) != sha:
                        raise ValueError(f"{fields['warc-record-id']}: the payload does not have its digest")
                    page, refers = http.get("x-page-id"), fields.get("x-refers-to-page-id")
                    size = int(fields["x-payload-length"]) if kind == "revisit" and "x-payload-length" in fields else len(payload)
                    rows.append((page and int(page), fields["warc-target-uri"], fields["warc-date"], kind, size, sha, refers and int(refers), payload)[: len(schema)])
                if rows:
                    yield table(schema, **dict(zip(schema.names, map(list, zip(*rows, strict=True)), strict=True)))

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(run, ENTRY_SQL + (", payload binary" if with_payload else ""))


def arc_to_warc(spark: SparkSession, source: str, path: str, compression: str = "none") -> DataFrame:
    """Converts the ARC files (plain or gzip-compressed) under source to WARC files at path, each headed by a warcinfo record, and returns what
    could not be read: file, offset, problem. A bad header, length or date costs its record alone; a file without a version block, or
    one that cannot be decompressed, gives one such row. Empty files give none. Each source file is one output file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import gzip

        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                data, good, bad = content.as_py(), [], []
                try:
                    data = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data
                except (OSError, EOFError) as e:
                    data, bad = b"", [BadRecord(0, str(e)[:300])]
                for r in read_arc(data, lenient=True):
                    (bad if isinstance(r, BadRecord) else good).append(r)
                every = [*good, *bad]
                records = [warcinfo(), *map(converted, good)] if good else []
                yield pa.RecordBatch.from_arrays(
                    [pa.array([*records, *[None] * len(bad)], pa.binary()), pa.array([name] * (len(records) + len(bad))), pa.array([None] * len(records) + [x.offset for x in bad], pa.int64()), pa.array([None] * len(records) + [x.problem for x in bad], pa.string())],
                    names=["record", "file", "offset", "problem"],
                ) if every else pa.RecordBatch.from_arrays([pa.array([], t) for t in (pa.binary(), pa.string(), pa.int64(), pa.string())], names=["record", "file", "offset", "problem"])

    files = spark.read.format("binaryFile").load(source).select("path", "content")
    made = settled(files.mapInArrow(run, "record binary, file string, offset long, problem string"), "converted")
    lines = made.filter("record is not null").select(F.col("record").cast("string").alias("value"))
    lines.write.option("lineSep", "\r\n\r\n").option("compression", compression).text(path)
    return made.filter("record is null").select("file", "offset", "problem")


def archived(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Writes pages as WARC files in the shared folder and reads them back: page_id, payload_bytes,
    payload_digest, record_type, refers_to. Nulls, ties, repeated rows and empty tables as in write_warc(); pages of any size."""
    path = fresh_path(pages.sparkSession, "warc")
    write_warc(pages, path, least_bytes)
    return entries(pages.sparkSession, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
