"""WARC archives: exact round trips, members at their offsets, revisits against a plain count."""

import base64
import gzip
import hashlib
import io
import zlib

import pytest
from pyspark.sql import functions as F

from critiq.llm import warc

SCHEMA = "page_id long, url string, html string"
ROWS = [
    (5, "http://a.example/x?q=ü 1", "<p>one</p>"), (3, "http://b.example/", "<p>one</p>"), (9, None, "<p>one</p>"),
    (1, "http://c.example/\r\nX-Bad: 1", None), (2, "", ""), (None, "http://d.example", "<p>one</p>"),
    (None, None, None), (7, "u", "WARC/1.1\r\n\r\nHTTP/1.1 200 OK\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"),
    (8, "u", "ünï 日本 😀 " * 9), (8, "u", "ünï 日本 😀 " * 9), (8, "v", "other"), (11, "long", "x" * 3_000_000),
]


@pytest.fixture(scope="module")
def pages(spark):
    clash = ["archive", "part", "ordinal", "same", "first", "payload", "n", "offset", "record_id"]
    return spark.createDataFrame(ROWS, SCHEMA).select("*", *[F.lit(i).alias(c) for i, c in enumerate(clash)])


def _brute(rows, least=0):
    seen, out = {}, []
    for page, _, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        body = (text or "").encode()
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        first = len(body) >= least and body in seen
        out.append((page, len(body), digest, "revisit" if first else "response", seen[body] if first else None))
        seen.setdefault(body, page)
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 3])
@pytest.mark.parametrize("parts", [1, 5])
def test_report_equals_brute_force(pages, parts, least):
    got = warc.page_report(pages.repartition(parts), least)
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(tuple, got.collect()), key=str) == _brute(ROWS, least)


def test_no_pages(spark):
    assert warc.page_report(spark.createDataFrame([], SCHEMA)).collect() == []


def test_round_trip_of_payloads_urls_and_text_keys(spark, tmp_path):
    keys = ["k\r\n1", "ü %41", "", None, "plain"]
    rows = [(k, f"http://h/{i}", f"text {i}") for i, k in enumerate(keys)]
    pages = spark.createDataFrame(rows, "page_id string, url string, html string")
    got = warc.read_archives(warc.archive_pages(pages, f"file://{tmp_path}")).collect()
    assert sorted((r.page_key, r.url, r.payload.decode()) for r in got if r.page_key is not None) == sorted(
        r for r in rows if r[0] is not None)
    assert {r.payload_digest for r in got} == {
        base64.b32encode(hashlib.sha1(r[2].encode()).digest()).decode() for r in rows}


def test_monoliths_are_one_member_and_results_one_member_per_record(spark, pages, tmp_path):
    manifest = warc.write_monoliths(pages.coalesce(1), f"file://{tmp_path}/m", roll_records=5)
    archives = sorted({r.archive for r in manifest.collect()})
    assert len(archives) == 3                                   # 12 records, five to a file
    for uri in archives:
        data = open(uri.removeprefix("file://"), "rb").read()
        one = zlib.decompressobj(31)
        one.decompress(data)
        assert one.eof and not one.unused_data
    index = warc.normalise(manifest.select("archive"), warc.find_revisits(manifest, "bigint"), f"file://{tmp_path}/n")
    rows = index.collect()
    assert len(rows) == len(ROWS)
    files = {}
    for r in rows:
        data = files.setdefault(r.archive, open(r.archive.removeprefix("file://"), "rb").read())
        record = gzip.decompress(data[r.offset:r.offset + r.length])
        assert record.startswith(b"WARC/1.1\r\nWARC-Type: " + r.record_type.encode())
        assert record.count(b"\r\nWARC-Record-ID: <" + r.record_id.encode()) == 1
    for uri, data in files.items():                             # the members fill the file without gaps
        ends = sorted((r.offset, r.offset + r.length) for r in rows if r.archive == uri)
        assert [0] + [e for _, e in ends] == [s for s, _ in ends] + [len(data)]


def test_records_of_other_writers_pass_unchanged(spark, tmp_path):
    records = [warc._record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", "<urn:x:1>")], b"software: x\r\n"),
               warc.response_record("4", "http://a/", b"body\r\n\r\nWARC/1.1", "urn:x:2")]
    for name, data in [("mono", gzip.compress(b"".join(records))), ("split", b"".join(map(gzip.compress, records)))]:
        path = tmp_path / f"{name}.warc.gz"
        path.write_bytes(data)
        archives = spark.createDataFrame([(f"file://{path}",)], "archive string")
        none = spark.createDataFrame([], "archive string, ordinal long, refers_id string, refers_key string")
        rows = sorted(warc.normalise(archives, none, f"file://{tmp_path}/{name}").collect(), key=lambda r: r.offset)
        out = open(rows[0].archive.removeprefix("file://"), "rb").read()
        assert [gzip.decompress(out[r.offset:r.offset + r.length]) for r in rows] == records
        assert [r.record_type for r in rows] == ["warcinfo", "response"]


def test_damaged_archives_fail():
    whole = gzip.compress(warc.response_record("1", "u", b"x" * 5000, "urn:x:1"))
    assert len(list(warc.iterate_records(io.BytesIO(whole)))) == 1
    with pytest.raises((ValueError, zlib.error)):
        list(warc.iterate_records(io.BytesIO(whole[:len(whole) // 2])))
    with pytest.raises(ValueError):
        warc._read_member(gzip.compress(warc.response_record("1", "u", b"right", "urn:x:1").replace(b"right", b"wrong")),
                          True)
    with pytest.raises(ValueError):
        list(warc.iterate_records(io.BytesIO(gzip.compress(b"HTTP/1.1 200 OK\r\n\r\n"))))


def test_a_payload_held_by_most_pages(spark):
    pages = spark.range(3000).selectExpr("id as page_id", "concat('u', id) as url",
                                         "if(id % 3 = 0, concat('t', id), 'same') as html").repartition(7)
    got = warc.page_report(pages).groupBy("record_type").agg(F.count("*").alias("n"), F.max("refers_to").alias("to"))
    assert {tuple(r) for r in got.collect()} == {("response", 1001, None), ("revisit", 1999, 1)}
