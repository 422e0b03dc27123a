"""ARC archives of both versions, and their conversion to WARC.

An ARC file opens with a version block whose second line names the version; the
header line of each record then has the five fields of version 1 or the ten of
version 2, and declares how many bytes of the document follow.  The converter
reads these lines, and gives each record what WARC wants besides: an identifier,
a timestamp, a type and digests.  Payloads met before become ``revisit`` records.

Archives are files of the shared folder.  Spark's text writer writes them, an
archive being one value of at most ``archive_bytes`` (or one record, if that is
longer) and the separator of its records the writer's line separator; so a lost
executor's files are written again and only whole ones are committed.  An
archive is one gzip stream.  Readers take plain files, gzip streams and files of
one gzip member a record.

Null payloads are empty ones.  Null urls are written as ``urn:page:`` with the
row's id; bytes that a header line can't hold are percent-encoded.  Ids are kept
in a header of the http response; null ids have none and come back null.
Repeated rows give a record each.  Empty tables give empty archives.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator, Sequence
from datetime import datetime

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import forget, remove, shared_dir, ship, sized, written

#: The field lines of the two ARC versions and the WARC revisit profile.
ARC_FIELDS = {
    1: b"URL IP-address Archive-date Content-type Archive-length",
    2: b"URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_FRONT = rb"([A-Za-z][A-Za-z0-9+.\-]*:.*) (\S+) (\d{8,17}) (\S+(?:; \S+)*) "
HEADERS = {1: re.compile(_FRONT + rb"(\d+)\r?\n?$"), 2: re.compile(_FRONT + rb"(\d+|-) (\S+) (\S+) (\d+|-) (\S+) (\d+)\r?\n?$")}

RECORDS = (
    "archive string, offset long, version int, url string, ip string, arc_date string, mime string, status int, location string, "
    "record_id string, warc_date string, warc_type string, content_type string, head binary, payload binary, payload_bytes long, "
    "payload_sha1 string, payload_sha256 string, error string"
)
#: Up to so many revisits (some 300 bytes each) are broadcast to the records; more are joined by a shuffle of these.
BROADCAST_REVISITS = 200_000
_STREAM_ERRORS = (EOFError, OSError, zlib.error)


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _plain(url: bytes) -> bytes:
    """Without bytes that would end a field or a line."""
    return re.sub(rb"[^\x21-\x7E]", lambda m: b"%%%02X" % m[0][0], url)


def _batches(rows: Iterable[dict], schema: pa.Schema, size, limit: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Arrow batches of about ``limit`` bytes, by what ``size`` says of a row."""
    some, held = [], 0
    for row in rows:
        some.append(row)
        held += size(row)
        if held >= limit or len(some) >= 5000:
            yield pa.RecordBatch.from_pylist(some, schema)
            some, held = [], 0
    if some:
        yield pa.RecordBatch.from_pylist(some, schema)


def _archives(records: Iterable, opening, framed, between: bytes, limit: int) -> Iterator[pa.RecordBatch]:
    """One value an archive: what ``opening`` gives for its number, then ``framed`` records till ``limit`` bytes, ``between`` after each but the last."""
    parts, held, number = [], 0, 0

    def closed() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([between.join(parts)], pa.binary())], names=["value"])

    for record in records:
        line = framed(number, record)
        if parts and held + len(line) > limit:
            yield closed()
            parts, held, number = [], 0, number + 1
            line = framed(number, record)
        if not parts:
            parts = opening(number)
        parts.append(line)
        held += len(line)
    if parts:
        yield closed()


def _write(archives: DataFrame, kind: str, between: str) -> str:
    path = f"{shared_dir(archives.sparkSession).rstrip('/')}/archives/{kind}-{uuid.uuid4().hex}"
    lines = archives.select(F.col("value").cast("string"))
    lines.write.options(lineSep=between, compression="gzip", maxRecordsPerFile=1, **{"zlib.compress.level": "BEST_SPEED"}).text(path)
    return path


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):  # one row at a time: a batch of long texts isn't held twice
            yield {name: column[i].as_py() for name, column in zip(batch.schema.names, batch.columns, strict=True)}


# ---- ARC


def write_arc(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
    versions: Sequence[int] = (1, 2), date: str = "19970101000000", archive_bytes: int = 16 << 20,
) -> str:
    """Write each row as the http response of one ARC record; the folder's path.  Archives take turns with ``versions``."""
    ship(pages.sparkSession)
    rows = pages.select(
        F.col(id_col).cast("string").alias("id"), F.col(url_col).cast("binary").alias("url"), F.col(payload_col).cast("binary").alias("payload")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()

        def header(number: int, url: bytes, mime: bytes, length: int) -> bytes:
            version = versions[(task + number) % len(versions)]
            more = b"200 - - 0 pages-%05d-%05d.arc " % (task, number) if version == 2 else b""
            return b"%s 0.0.0.0 %s %s %s%d\n" % (url, date.encode(), mime, more, length)

        def opening(number: int) -> list[bytes]:
            version = versions[(task + number) % len(versions)]
            block = b"%d 0 voltaweave\n%s\n" % (version, ARC_FIELDS[version])
            return [header(number, b"filedesc://pages-%05d-%05d.arc" % (task, number), b"text/plain", len(block)) + block]

        def framed(number: int, row: dict) -> bytes:
            payload, url = row["payload"] or b"", _plain(row["url"] or b"")
            known = b"" if row["id"] is None else b"X-Page-Id: %s\r\n" % _plain(row["id"].encode())
            if not re.match(rb"[A-Za-z][A-Za-z0-9+.\-]*:", url):
                url = b"urn:page:" + (url or _plain((row["id"] or "").encode()))
            head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: %d\r\n%s\r\n" % (len(payload), known)
            return header(number, url, b"text/html", len(head) + len(payload)) + head + payload

        yield from _archives(_rows(batches), opening, framed, b"\n", archive_bytes)

    return _write(rows.mapInArrow(write, "value binary"), "arc", "\n")


def _stream(content: bytes) -> io.BufferedReader:
    return gzip.GzipFile(fileobj=io.BytesIO(content)) if content[:2] == b"\x1f\x8b" else io.BytesIO(content)


def _iso(digits: str, otherwise: str = "1970-01-01T00:00:00Z") -> str:
    """An ARC date of 8 to 17 digits as a WARC date; one that no calendar has is replaced."""
    try:
        at = datetime.strptime((digits + "000000")[:14], "%Y%m%d%H%M%S")
    except ValueError:
        return otherwise
    part = f".{digits[14:]}" if len(digits) > 14 else ""
    return f"{at:%Y-%m-%dT%H:%M:%S}{part}Z" if at.year > 999 else otherwise


def _typed(url: str, mime: str, block: bytes) -> tuple[str, str, int]:
    """(WARC type, content type, length of the head) of a document that was met at ``url``."""
    if url.startswith("filedesc:"):
        return "warcinfo", "application/warc-fields", 0
    if block.startswith(b"HTTP/"):
        ends = [m.end() for m in (re.search(rb"\r?\n\r?\n", block),) if m]
        return "response", "application/http; msgtype=response", ends[0] if ends else len(block)
    return ("response" if url.startswith("dns:") else "resource"), mime, 0


def _arc_records(path: str, content: bytes) -> Iterator[dict]:
    """All records of one archive; bytes that no header line explains come as a record with ``error``."""
    name = path.rsplit("/", 1)[-1]
    stream, at, version, opened = _stream(content), 0, 0, "1970-01-01T00:00:00Z"

    def made(offset: int, fields: tuple | None, block: bytes, error: str | None) -> dict:
        nonlocal opened
        url, ip, date, mime = (x.decode("utf-8", "replace") for x in fields[:4]) if fields else ("", "", "", "")
        if fields and url.startswith("filedesc:"):
            opened = _iso(date)
        kind, content_type, cut = _typed(url, mime, block) if fields else ("metadata", "application/octet-stream", 0)
        head, payload = block[:cut], block[cut:]
        status = re.match(rb"HTTP/\S+ +(\d{3})\b", head)
        long = fields is not None and len(fields) == 10
        seed = hashlib.sha256(f"{path}\n{offset}\n".encode() + block).digest()
        return {
            "archive": name, "offset": offset, "version": version, "url": url, "ip": ip, "arc_date": date, "mime": mime,
            "status": int(fields[4]) if long and fields[4] != b"-" else int(status[1]) if status else None,
            "location": fields[6].decode("utf-8", "replace") if long and fields[6] != b"-" else None,
            "record_id": f"<urn:uuid:{uuid.UUID(bytes=seed[:16], version=4)}>", "warc_date": _iso(date, opened), "warc_type": kind,
            "content_type": content_type, "head": head, "payload": payload, "payload_bytes": len(payload),
            "payload_sha1": base32_sha1(payload), "payload_sha256": hashlib.sha256(payload).hexdigest(), "error": error,
        }

    def fields_of(line: bytes) -> tuple | None:
        for v in (version,) if version else (2, 1):
            if m := HEADERS[v].match(line):
                return m.groups()
        return None

    lost, lost_at = b"", 0
    try:
        while line := stream.readline():
            start, at = at, at + len(line)
            if (fields := fields_of(line)) is None:
                if line.strip() or lost:  # a blank line parts records; anything else is read over till the next header line
                    lost, lost_at = lost + line, lost_at if lost else start
                continue
            if lost:
                yield made(lost_at, None, lost, "no header line")
                lost = b""
            length = int(fields[-1])
            block = stream.read(length)
            at += len(block)
            if fields[0].startswith(b"filedesc:") and (m := re.match(rb"([12]) ", block)):
                version = int(m[1])
            yield made(start, fields, block, None if len(block) == length else "shorter than declared")
    except _STREAM_ERRORS as e:
        yield made(at, None, lost, f"unreadable from here: {type(e).__name__}")
        return
    if lost:
        yield made(lost_at, None, lost, "no header line")


def _arrow_schema(ddl: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (x.split() for x in ddl.split(", "))])


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")


def _parsed(files: DataFrame, records, ddl: str, blocks: bool) -> DataFrame:
    ship(files.sparkSession)
    ddl = ddl if blocks else ", ".join(x for x in ddl.split(", ") if x != "payload binary")
    schema = _arrow_schema(ddl)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = (r for row in _rows(batches) for r in records(row["path"], row["content"]))
        yield from _batches(found, schema, lambda r: 500 + (len(r["payload"]) if blocks else 0))

    return files.mapInArrow(parse, ddl)


def read_arc(spark: SparkSession, path: str, blocks: bool = True) -> DataFrame:
    """Every record of the ARC files under ``path``, with what WARC wants of it; without ``blocks`` the payload is left out.

    The version block decides how header lines are read (without one, a line
    may be of either version).  Declared lengths are trusted; where no header
    line follows, all up to the next one is a ``metadata`` record with an error.
    A document that ends before its declared length is kept, with an error.
    """
    return _parsed(_files(spark, path), _arc_records, RECORDS, blocks)


# ---- WARC


def revisits(records: DataFrame, least: int = 0, *order: Column) -> DataFrame:
    """(record_id, first_id, first_url, first_date) of each response whose payload, of at least ``least`` bytes, an earlier one has.

    ``order`` (by default archive, offset and identifier) must be total.  One aggregate by
    digest, combined before the shuffle, finds the first; only digests with
    several records are joined back.
    """
    some = records.filter((F.col("warc_type") == "response") & F.col("error").isNull() & (F.col("payload_bytes") >= least))
    key = ["payload_sha256", "payload_bytes"]
    rank = F.struct(*(order or (F.col("archive"), F.col("offset"), F.col("record_id"))))
    some = written(some.select(*key, "record_id", "url", "warc_date", rank.alias("rank")), "digests")
    first = some.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("rank", "record_id", "url", "warc_date")).alias("first"))
    first = first.filter("n > 1").select(*key, F.col("first.record_id").alias("first_id"), F.col("first.url").alias("first_url"), F.col("first.warc_date").alias("first_date"))
    again = some.select("record_id", *key).join(first, key).filter("record_id <> first_id")
    found = written(again.select("record_id", "first_id", "first_url", "first_date"), "revisits")
    forget(some)
    return found


def _warc_record(row: dict) -> bytes:
    head, payload, revisit = row["head"] or b"", row["payload"] or b"", row["first_id"] is not None
    block = head if revisit else head + payload
    if row["warc_type"] == "warcinfo":
        said = payload.splitlines()[0].decode("utf-8", "replace") if payload.strip() else ""
        block = f"software: voltaweave\r\nformat: WARC File Format 1.1\r\nconverted-from: {row['url']} ({said})\r\n".encode()
    lines = [
        ("WARC-Type", "revisit" if revisit else row["warc_type"]), ("WARC-Record-ID", row["record_id"]), ("WARC-Date", row["warc_date"]),
        ("WARC-Filename", row["archive"] if row["warc_type"] == "warcinfo" else None),
        ("WARC-Target-URI", row["url"] if row["warc_type"] not in ("warcinfo", "metadata") else None),
        ("WARC-IP-Address", row["ip"] if row["ip"] not in ("", "0.0.0.0") else None),
        ("WARC-Profile", PROFILE if revisit else None), ("WARC-Refers-To", row["first_id"]), ("WARC-Refers-To-Target-URI", row["first_url"]),
        ("WARC-Refers-To-Date", row["first_date"]), ("WARC-Truncated", "unspecified" if row["error"] == "shorter than declared" else None),
        ("WARC-Payload-Digest", f"sha1:{row['payload_sha1']}" if head else None), ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"),
        ("Content-Type", row["content_type"]), ("Content-Length", str(len(block))),
    ]
    return b"WARC/1.1\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in lines if v is not None) + b"\r\n" + block


def write_warc(records: DataFrame, again: DataFrame | None = None, archive_bytes: int = 16 << 20) -> str:
    """Write records of :func:`read_arc` as WARC archives, those in ``again`` (see :func:`revisits`) as revisits; the folder's path."""
    columns = ["archive", "url", "ip", "record_id", "warc_date", "warc_type", "content_type", "head", "payload", "payload_sha1", "error"]
    firsts = ["first_id", "first_url", "first_date"]
    if again is None:
        rows = records.select(*columns, *(F.lit(None).cast("string").alias(c) for c in firsts))
    else:
        rows = records.join(again, "record_id", "left").select(*columns, *firsts)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _archives(_rows(batches), lambda number: [], lambda number, row: _warc_record(row), b"\r\n\r\n", archive_bytes)

    return _write(rows.mapInArrow(write, "value binary"), "warc", "\r\n\r\n")


WARC_RECORDS = (
    "archive string, offset long, record_id string, warc_type string, warc_date string, url string, refers_to string, "
    "block_digest string, payload_digest string, head binary, payload binary, payload_bytes long, payload_sha1 string, error string"
)


def _warc_records(path: str, content: bytes) -> Iterator[dict]:
    """All records of one WARC archive; digests that the bytes don't have are told in ``error``."""
    name = path.rsplit("/", 1)[-1]
    stream, at = _stream(content), 0
    try:
        while line := stream.readline():
            start, at = at, at + len(line)
            if not line.startswith(b"WARC/"):
                continue
            named = {}
            while (line := stream.readline()).strip():
                at += len(line)
                key, _, value = line.decode("utf-8", "replace").partition(":")
                named[key.strip().lower()] = value.strip()
            length = int(named.get("content-length", "0"))
            block = stream.read(length)
            at += len(line) + len(block)
            http = "application/http" in named.get("content-type", "")
            cut = re.search(rb"\r?\n\r?\n", block) if http else None
            head, payload = (block[: cut.end()], block[cut.end() :]) if cut else (block, b"") if http else (b"", block)
            kind, sha1 = named.get("warc-type", ""), base32_sha1(payload)
            told = named.get("warc-payload-digest", "").removeprefix("sha1:") or None
            error = "shorter than declared" if len(block) < length else None
            if named.get("warc-block-digest", "").removeprefix("sha1:") not in ("", base32_sha1(block)) or (kind != "revisit" and told not in (None, sha1)):
                error = error or "another digest"
            yield {
                "archive": name, "offset": start, "record_id": named.get("warc-record-id"), "warc_type": kind, "warc_date": named.get("warc-date"),
                "url": named.get("warc-target-uri"), "refers_to": named.get("warc-refers-to"), "block_digest": named.get("warc-block-digest"),
                "payload_digest": told or sha1, "head": head, "payload": payload, "payload_bytes": len(payload), "payload_sha1": sha1, "error": error,
            }
    except (*_STREAM_ERRORS, ValueError) as e:
        yield dict.fromkeys(x.split()[0] for x in WARC_RECORDS.split(", ")) | {
            "archive": name, "offset": at, "payload": b"", "payload_bytes": 0, "error": f"unreadable from here: {type(e).__name__}"
        }


def read_warc(spark: SparkSession, path: str, blocks: bool = True) -> DataFrame:
    """Every record of the WARC files under ``path``; without ``blocks`` the payload is left out."""
    return _parsed(_files(spark, path), _warc_records, WARC_RECORDS, blocks)


def page_id(head: Column) -> Column:
    """The id that :func:`write_arc` put in the head of a response, or null."""
    return F.nullif(F.regexp_extract(F.decode(head, "UTF-8"), r"\r\nX-Page-Id: (\S+)\r\n", 1), F.lit("")).try_cast("long")


def convert(pages: DataFrame, least: int = 0) -> DataFrame:
    """Pages as ARC archives, converted to WARC, and each page as its WARC record tells it; the WARC archives stay.

    Of pages with equal payloads of at least ``least`` bytes the one of the
    smallest id is the response that others revisit (null ids come last, then
    the place in the archives decides).
    """
    spark = pages.sparkSession
    arc = write_arc(pages)
    id_ = page_id(F.col("head"))
    again = revisits(read_arc(spark, arc, blocks=False), least, id_.isNull(), id_, F.col("archive"), F.col("offset"))
    warc = write_warc(read_arc(spark, arc), sized(again, BROADCAST_REVISITS))
    forget(again)
    remove(spark, arc)
    told = read_warc(spark, warc, blocks=False).filter(F.col("warc_type").isin("response", "revisit"))
    told = written(told.select("record_id", page_id(F.col("head")).alias("page_id"), "payload_bytes", "payload_digest", "warc_type", "refers_to"), "told")
    first = told.select(F.col("record_id").alias("refers_to"), F.col("page_id").alias("first_page"), F.col("payload_bytes").alias("first_bytes"))
    first = first.join(told.select("refers_to").distinct(), "refers_to", "left_semi")
    return told.join(first, "refers_to", "left").select(
        "page_id",
        F.coalesce("first_bytes", "payload_bytes").alias("payload_bytes"),
        "payload_digest",
        F.col("warc_type").alias("record_type"),
        F.col("first_page").alias("refers_to"),
        "record_id",
    )
