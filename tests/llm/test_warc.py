import base64
import gzip
import hashlib
import io

import pytest

from newsloom.llm import warc as W
from newsloom.llm.common import scratch

SCHEMA = "page_id long, url string, html string, payload string, keep_id int"


def archive(spark, rows, **options):
    path = scratch(spark, "warc")
    W.write_pages(spark.createDataFrame(rows, SCHEMA).repartition(3), path, **options)
    return path


def b32(text):
    return base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


def test_round_trip_with_copies_nulls_and_odd_addresses(spark):
    rows = [
        (5, "http://a/é b\nX: y", "<p>é😀</p>", "", 0), (2, None, "<p>é😀</p>", "", 0), (9, "http://c", None, "", 0), (8, "http://d", "", "", 0),
        (7, "u", "WARC/1.1\r\n\r\nWARC-Type: x\r\n\r\n", "", 0), (2, "again", "<p>é😀</p>", "", 0), (None, "n", "<p>é😀</p>", "", 0), (None, "m", "alone", "", 0),
        (11, "long", "x" * 3_000_000, "", 0),
    ]
    found = W.read_warc(spark, archive(spark, rows)).collect()
    got = sorted((r.record_id, r.warc_type, r.refers_to or "", r.payload_bytes, r.payload_digest) for r in found)
    first = lambda i, h: (f"urn:page:{i}", "response", "", len(h.encode()), "sha1:" + b32(h))
    again = lambda i, h, to: (f"urn:page:{i}", "revisit", f"urn:page:{to}", len(h.encode()), "sha1:" + b32(h))
    p = "<p>é😀</p>"
    assert got == sorted([
        first(2, p), first(2, p), again(5, p, 2), again("null", p, 2), first(8, ""), again(9, "", 8), first(7, rows[4][2]), first("null", "alone"),
        first(11, rows[8][2]),
    ])
    assert {bytes(r.payload).decode() for r in found if r.warc_type == "response"} == {p, "", rows[4][2], "alone", rows[8][2]}


def test_least_bytes(spark):
    kinds = [r.warc_type for r in W.read_warc(spark, archive(spark, [(1, "a", "xx", "", 0), (2, "b", "xx", "", 0)], least_bytes=3)).collect()]
    assert kinds == ["response", "response"]


def test_predicates_reach_the_reader(spark):
    path = archive(spark, [(i, f"http://h/{i}", "same" if i % 2 else f"own {i}", "", 0) for i in range(20)])
    df = W.read_warc(spark, path)
    assert df.where("warc_type = 'revisit'").count() == 9
    assert [r.record_id for r in df.where("target_uri in ('http://h/4') and warc_type = 'response'").collect()] == ["urn:page:4"]
    assert df.where("target_uri like 'http://h/1%' and refers_to is null").count() == 6
    plan = df.where("warc_type = 'response'")._jdf.queryExecution().executedPlan().toString()
    assert "Filter (" not in plan and "Filter isnotnull" not in plan
    assert all(r.payload is None for r in W.read_warc(spark, path, payloads="false").collect())


def test_unwanted_records_are_stepped_over():
    rows = [{"warc_type": "response", "record_id": f"r{i}", "payload": bytes([65 + i]) * 500_000, "payload_bytes": 500_000, "payload_digest": "x"} for i in range(4)]
    data = b"".join(W.member(W.record_bytes(r)) for r in rows)
    inflated = []
    real = W._Member.read
    W._Member.read = lambda self, limit: inflated.append(limit) or real(self, limit)
    try:
        got = list(W.read_records(io.BytesIO(data), lambda r: r["record_id"] == "r2", verify=False))
    finally:
        W._Member.read = real
    assert [r["payload"] for r in got] == [rows[2]["payload"]]
    assert inflated.count(1 << 20) == 2  # only the wanted record was read to its end


@pytest.mark.parametrize("pack", [gzip.compress, bytes])
def test_archives_of_other_origin(pack):
    record = b"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <r>\r\nX-Folded: a\r\n b\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    assert gzip.decompress(W.member(record)) == record
    got = list(W.read_records(io.BytesIO(pack(record) * 3)))
    assert [(r["warc_type"], r["record_id"], r["payload"]) for r in got] == [("resource", "r", b"hello")] * 3


def test_damage_is_noticed():
    row = {"warc_type": "response", "record_id": "r", "payload": b"abc", "payload_bytes": 3, "payload_digest": b32("abd")}
    with pytest.raises(ValueError):
        list(W.read_records(io.BytesIO(W.member(W.record_bytes(row)))))
    with pytest.raises(ValueError):
        list(W.read_records(io.BytesIO(W.member(W.record_bytes(row))[:-20]), verify=False))


def test_empty_table(spark):
    assert W.read_warc(spark, archive(spark, [])).collect() == []


def test_members_of_several_records():
    one = b"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:%d>\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n"
    bodies = [b"first", b"", b"\r\n\r\n third" * 1000, b"x" * 3_000_000, b"last"]
    whole = b"".join(one % (i, len(b), b) for i, b in enumerate(bodies))
    for packed in (gzip.compress(whole), gzip.compress(whole) * 2, gzip.compress(whole[:-4]), whole):
        rows = list(W.read_records(io.BytesIO(packed)))
        assert [r["payload"] for r in rows] == bodies * (len(rows) // 5) and len(rows) in (5, 10)
        some = list(W.read_records(io.BytesIO(packed), lambda r: r["record_id"] in ("urn:1", "urn:4")))
        assert [r["payload"] for r in some] == [b"", b"last"] * (len(rows) // 5)
