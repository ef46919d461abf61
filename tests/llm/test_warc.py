"""Round trips of archives, assembly through both directions of links, odd rows."""

import gzip
import hashlib

import pytest

from layerworks.llm import warc
from layerworks.llm.queries import QUERIES
from layerworks.session import scratch_path


def page_rows(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, payload string")


def round_trip(spark, rows):
    path = scratch_path(spark, "warc-test")
    warc.write_warc(warc.captures_of_pages(page_rows(spark, rows)), path)
    records = warc.with_digests(warc.read_warc(spark, path))
    return records, warc.with_full_payload_size(warc.assemble(records)).collect()


def model(rows):
    best = {}
    for i, _, html, _ in rows:
        data = (html or "").encode()
        if len(data) >= 1000:
            best[data] = max(best.get(data, -1), -1 if i is None else i)
    out = set()
    for i, _, html, _ in rows:
        data = (html or "").encode()
        first = best.get(data, i)
        revisit = first != (-1 if i is None else i) if data in best else False
        out.add((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return out


def test_round_trip(spark):
    big = "é日" * 400
    rows = [(i, f"http://x/{i}", "page\r\n\r\nWARC/1.1\r\n" + "z" * 1200 * (i % 3), "p") for i in range(40)]
    rows += [(100 + i, "http://same", big, None) for i in range(30)]
    rows += [(200, None, None, None), (201, "a\r\nb", "", None), (202, "u", "\r\n\r\n" * 500, None), (None, "u", big, None), (203, "u", "x" * 3_000_000, None)]
    rows += [(7, rows[7][1], rows[7][2], "p")]  # a row given twice is one capture
    records, got = round_trip(spark, rows)
    assert len(got) == len(rows) - 1
    assert {tuple(r) for r in got} == model(rows)
    assert warc.orphans(records).count() == 0
    nested = warc.assemble(records).where("record_id is not null").collect()
    assert all(r.requests == 1 and r.metadatas == 1 and r.request.http.startswith("GET ") for r in nested)
    assert all((r.type == "revisit") == (r.response.refers_to is not None) for r in nested)


def test_no_rows(spark):
    assert round_trip(spark, [])[1] == []


def test_links_both_ways_and_orphans(spark):
    made = lambda i, kind, to: (i, kind, "u", to, None, None, "d", None, b"x")
    rows = [made("r1", "response", []), made("q1", "request", ["r1"]), made("m1", "metadata", ["r1"]), made("m0", "metadata", ["r1"]), made("m0", "metadata", ["r1"]),
            made("r2", "response", ["q2"]), made("q2", "request", ["r2"]), made("q3", "request", ["gone"]), made("w", "warcinfo", []), made("r3", "response", [])]
    records = spark.createDataFrame(rows, warc.RECORD)
    got = {r.record_id: (r.request and r.request.record_id, r.metadata and r.metadata.record_id, r.requests, r.metadatas) for r in warc.assemble(records).collect()}
    assert got == {"r1": ("q1", "m0", 1, 2), "r2": ("q2", None, 1, 0), "r3": (None, None, 0, 0)}
    assert {r.record_id for r in warc.orphans(records).collect()} == {"q3", "w"}


def test_gzip_members_and_broken_archives():
    one = b"WARC/1.1\r\nWARC-Type: metadata\r\nWARC-Record-ID: <a>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    assert [r["payload"] for r in warc.parse_records(gzip.compress(one) + gzip.compress(one))] == [b"abc", b"abc"]
    for broken in (one[:-6], b"text", b"WARC/1.1\r\nA: b"):
        with pytest.raises(ValueError):
            list(warc.parse_records(broken))


def test_query(spark):
    rows = QUERIES["op1_warc_captures"](spark, "/root/testdata/sf0.01").collect()
    pages = [(r.page_id, r.url, r.html, None) for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()]
    assert {tuple(r) for r in rows} == model(pages) and len(rows) == len(pages)
