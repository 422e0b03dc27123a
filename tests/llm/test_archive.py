"""ARC archives of both versions, written, damaged and converted."""

import base64
import gzip
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from voltaweave.llm import archive

SCHEMA = "page_id long, url string, html string, offset string, archive string, payload string, record_id long"
RNG = random.Random(5)
TRAP = "<p>\r\n\r\nWARC/1.1\r\nhttp://x.y 1.1.1.1 20010101000000 text/html 5\n"
PAGES = [
    (1, "http://a.b/", "<p>one</p>"), (2, "http://a.b/ c?é", "<p>one</p>"), (3, None, None), (4, "no scheme", ""), (None, "http://n/", "<p>one</p>"),
    (None, None, "only here"), (5, "http://t/", TRAP), (-6, "http://t/2", TRAP), (7, "http://l/", "é" * 40_000), (8, "http://l/", "é" * 40_000 + "x"),
    (9, "http://r/", "twice"), (9, "http://r/", "twice"), (10, "http://w/", "\n"), (11, "dns:a.b", "ü\r\n\r\n"), (12, "http://e/\nx", "HTTP/1.1 404 no"),
]


def sha1(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def rows_of(spark, pages=PAGES):
    return spark.createDataFrame([(*p, "a", "b", "c", 3) for p in pages], SCHEMA)


def test_pages_come_back(spark):
    got = archive.convert(rows_of(spark).repartition(3)).collect()
    assert len(got) == len(PAGES)
    firsts = {}
    for i, _, html in sorted((p for p in PAGES if p[0] is not None), key=lambda p: p[0]):
        firsts.setdefault(html or "", i)
    want = sorted((str(i), len((h or "").encode()), sha1(h)) for i, _, h in PAGES)
    assert sorted((str(r.page_id), r.payload_bytes, r.payload_digest) for r in got) == want
    by_digest = {sha1(h): i for h, i in firsts.items()}
    responses = [r for r in got if r.record_type == "response"]
    assert len({r.payload_digest for r in responses}) == len(responses) == len({r.payload_digest for r in got})
    for r in got:
        first = by_digest.get(r.payload_digest)
        assert (r.refers_to is None and r.page_id == first) if r.record_type == "response" else r.refers_to == first, r
    assert len({r.record_id for r in got}) == len(PAGES)


def test_short_payloads_stay(spark):
    got = archive.convert(rows_of(spark), least=10).collect()
    short = [r for r in got if r.payload_bytes < 10]
    assert short and all(r.record_type == "response" and r.refers_to is None for r in short)
    assert sum(r.record_type == "revisit" for r in got) == 3  # two of "<p>one</p>", which has ten bytes, and one of the trap


def test_no_pages(spark):
    assert archive.convert(rows_of(spark, [])).collect() == []


@pytest.mark.parametrize("versions", [(1,), (2,), (1, 2)])
def test_small_archives(spark, versions):
    path = archive.write_arc(rows_of(spark).repartition(2), versions=versions, archive_bytes=200)
    found = archive.read_arc(spark, path)
    said = found.filter("warc_type = 'warcinfo'")
    assert found.select("archive").distinct().count() == said.count() > len(PAGES) / 2
    assert {r.version for r in said.collect()} == set(versions)
    pages = found.filter("warc_type <> 'warcinfo'").collect()
    assert sorted(bytes(r.payload) for r in pages) == sorted((h or "").encode() for _, _, h in PAGES)
    assert all(r.error is None and r.status == 200 and r.warc_date == "1997-01-01T00:00:00Z" for r in pages)


def file_of(version, records, name=b"x.arc"):
    block = b"%d 0 crawler\n%s\n" % (version, archive.ARC_FIELDS[version])
    more = b"" if version == 1 else b"200 - - 0 x.arc "
    return [b"filedesc://%s 0.0.0.0 20030405060708 text/plain %s%d\n%s\n" % (name, more, len(block), block), *records]


HTTP = b"HTTP/1.0 301 Moved\r\nLocation: /x\r\n\r\n<p>moved"


def record(version, url, block, date=b"20040229010203", mime=b"text/html", length=None):
    more = b"" if version == 1 else b"301 - http://to/ 0 x.arc "
    return b"%s 10.0.0.9 %s %s %s%d\n%s\n" % (url, date, mime, more, len(block) if length is None else length, block)


@pytest.mark.parametrize("version", [1, 2])
@pytest.mark.parametrize("form", ["plain", "stream", "members"])
def test_legacy_files(spark, tmp_path, version, form):
    parts = file_of(version, [
        record(version, b"http://a/", HTTP), record(version, b"http://a b/", HTTP, mime=b"text/html; charset=x"), record(version, b"dns:a", b"20030101\na. 1 IN A 10.0.0.9\n", mime=b"text/dns"),
        record(version, b"ftp://f/", b"plain bytes \xff\x00", date=b"20031340"), record(version, b"http://h/", b"HTTP/1.1 200 OK"), b"some stray\nlines\n",
        record(version, b"http://z/", HTTP, date=b"200402290102", length=len(HTTP)), record(version, b"http://cut/", HTTP, length=10_000),
    ])
    raw = {"plain": b"".join(parts), "stream": gzip.compress(b"".join(parts)), "members": b"".join(map(gzip.compress, parts))}[form]
    (tmp_path / "x.arc").write_bytes(raw)
    found = {r.url: r for r in archive.read_arc(spark, f"file://{tmp_path}").collect()}
    kinds = {u: (r.warc_type, r.warc_date, r.error) for u, r in found.items()}
    leap = "2004-02-29T01:02:03Z"
    assert kinds == {
        "filedesc://x.arc": ("warcinfo", "2003-04-05T06:07:08Z", None), "http://a/": ("response", leap, None), "http://a b/": ("response", leap, None), "dns:a": ("response", leap, None),
        "ftp://f/": ("resource", "2003-04-05T06:07:08Z", None), "http://h/": ("response", leap, None), "": ("metadata", "2003-04-05T06:07:08Z", "no header line"),
        "http://z/": ("response", "2004-02-29T01:02:00Z", None), "http://cut/": ("response", leap, "shorter than declared"),
    }
    assert bytes(found["http://a/"].payload) == b"<p>moved" and found["http://a/"].status == 301
    assert found["http://a/"].location == (None if version == 1 else "http://to/")
    assert bytes(found["http://h/"].payload) == b"" and bytes(found[""].payload) == b"some stray\nlines\n"
    assert bytes(found["ftp://f/"].payload) == b"plain bytes \xff\x00"

    records = archive.read_arc(spark, f"file://{tmp_path}")
    again = archive.revisits(records, 1)
    assert again.count() == 2  # of four whole copies of HTTP's payload: one more is cut off
    told = {r.record_id: r for r in archive.read_warc(spark, archive.write_warc(records, again)).collect()}
    assert len(told) == len(found) and all(r.error is None for r in told.values())
    for r in found.values():
        t = told[r.record_id]
        if t.warc_type == "revisit":
            assert told[t.refers_to].payload_digest == t.payload_digest == r.payload_sha1 and bytes(t.payload) == b"" and bytes(t.head) == bytes(r.head)
        elif t.warc_type != "warcinfo":
            assert (t.warc_type, t.warc_date, bytes(t.payload)) == (r.warc_type, r.warc_date, bytes(r.payload))


def test_unreadable_rest(spark, tmp_path):
    raw = gzip.compress(b"".join(file_of(1, [record(1, b"http://a/", bytes(RNG.randrange(256) for _ in range(5000)))])))
    (tmp_path / "x.arc.gz").write_bytes(raw[: len(raw) // 2])
    (tmp_path / "empty.arc").write_bytes(b"")
    errors = [r.error for r in archive.read_arc(spark, f"file://{tmp_path}").collect()]
    assert any(e and e.startswith("unreadable") for e in errors)


def test_headers_of_warc(spark, tmp_path):
    path = archive.write_warc(archive.read_arc(spark, archive.write_arc(rows_of(spark, PAGES[:1]))))
    raw = gzip.decompress(next(spark.read.format("binaryFile").load(path).filter("length > 60").select("content").toLocalIterator()).content)
    assert raw.endswith(b"\r\n\r\n") and len(re.findall(rb"^WARC/1.1\r$", raw, re.M)) == 2
    one = raw[raw.index(b"WARC-Type: response") :]
    for line in (rb"WARC-Record-ID: <urn:uuid:[0-9a-f-]{36}>", rb"WARC-Date: 1997-01-01T00:00:00Z", rb"WARC-Target-URI: http://a.b/", rb"Content-Type: application/http; msgtype=response"):
        assert re.search(line + rb"\r\n", one)
    (tmp_path / "x.warc").write_bytes(raw.replace(b"<p>one", b"<p>two"))
    assert [r.error for r in archive.read_warc(spark, f"file://{tmp_path}").orderBy("offset").collect()] == [None, "another digest"]


def test_large_and_many_copies(spark):
    pages = spark.range(3000).select(F.col("id").alias("page_id"), F.lit("http://x/").alias("url"), F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.repeat(F.col("id").cast("string"), 50)).alias("html"))
    got = archive.convert(pages.repartition(6))
    assert got.filter("record_type = 'revisit' and refers_to = 1").count() == 1999
    assert got.filter("record_type = 'response'").count() == 1001
