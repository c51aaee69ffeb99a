"""Archives written and read back; transactions joined through their identifiers."""

import gzip
import hashlib
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from tablesmith.llm import queries, warc

SF = "/root/testdata/sf0.001"
BIG = "<p>" + "é" * 600 + "\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n</p>"
SCHEMA = "page_id long, url string, html string, payload string, digest string, uid long, record_id string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", 1, "x") for r in rows], SCHEMA)


ROWS = [(1, "http://a.example/x?y=1#z", BIG), (2, "http://b.example", BIG), (7, None, BIG), (3, "no url\r\nEvil: 1", "short"), (4, "http://a.example/", "short"),
        (5, "u", None), (6, "", ""), (8, "http://c.example/é", "a" * 999), (9, "u", "a" * 999), (10, "u", "a" * 1000), (11, "u", "a" * 1000),
        (None, "u", "b" * 2000), (12, "u", "b" * 2000), (None, "u", "c" * 2000), (13, "u", "\x00\r\n\r\n" * 300), (14, "u", "d" * 300_000)]


def brute(rows):
    top = {}
    for i, _, h in rows:
        h = (h or "").encode()
        if len(h) >= 1000:
            top[h] = max(top.get(h, -1), -1 if i is None else i)
    out = []
    for i, _, h in rows:
        h = (h or "").encode()
        kept = top.get(h, i)
        response = kept == (-1 if i is None else i) or len(h) < 1000
        out.append((i, len(h), hashlib.sha1(h).hexdigest(), "response" if response else "revisit", None if response else kept))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=str)


def test_report(spark):
    assert rows_of(warc.report(pages(spark, ROWS).repartition(3))) == brute(ROWS)
    assert warc.report(pages(spark, [])).count() == 0


def test_repeated_rows(spark):
    rows = [(1, "u", BIG), (1, "u", BIG), (1, "v", BIG), (0, "u", BIG), (None, "u", "b" * 2000), (None, "u", "b" * 2000), (3, "u", "x"), (3, "u", "x"),
            (None, "w", BIG)]
    assert rows_of(warc.report(pages(spark, rows))) == brute(rows)


def test_table_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SF}/pages.parquet'")
    want = sorted(con.execute(f"SELECT page_id, payload_bytes, payload_digest, record_type, refers_to FROM ({warc.REPORT_SQL})").fetchall(), key=str)
    assert rows_of(queries.op12_warc_transactions(spark, SF)) == want


def test_files_and_nested_rows(spark, scratch_dir):
    path = os.path.join(scratch_dir, "out")
    warc.write_archives(pages(spark, ROWS), path, date="2024-01-02T03:04:05Z")
    files = [os.path.join(path, f) for f in os.listdir(path) if f.endswith(".gz")]
    raw = [gzip.open(f).read() for f in files]
    assert all(r.startswith(b"WARC/1.1\r\nWARC-Type: request\r\n") and r.endswith(b"\r\n\r\n") for r in raw if r)
    assert b"\r\nEvil" not in b"".join(raw)
    records = warc.read_records(spark, path, payloads=True)
    assert {r["type"]: r["count"] for r in records.groupBy("type").count().collect()} == {"request": 16, "metadata": 16, "response": 12, "revisit": 4}
    captures = warc.transactions(records).collect()
    assert len(captures) == len(ROWS)
    for c in captures:
        assert len(c.requests) == len(c.metadata) == 1 and c.response.date == "2024-01-02T03:04:05Z"
        assert c.requests[0].http.startswith("GET /") and c.metadata[0].fields["software"] == "tablesmith"
    by_page = {c.metadata[0].fields.get("page-id"): c for c in captures}
    assert bytes(by_page["13"].response.payload).decode() == ROWS[14][2] and by_page["1"].response.target_uri == ROWS[0][1]
    assert by_page["1"].requests[0].http == "GET /x?y=1 HTTP/1.1" and by_page["3"].response.target_uri == "no url%0D%0AEvil: 1"
    assert by_page["7"].response.target_uri is None and by_page["1"].response.refers_to == by_page["7"].response.record_id
    again = os.path.join(scratch_dir, "plain")
    os.makedirs(again)
    for k, r in enumerate(raw):  # plain files, and gzip files of several members
        with open(os.path.join(again, f"{k}.warc"), "wb") as f:
            f.write(r if k % 2 else gzip.compress(r[:100]) + gzip.compress(r[100:]))
    columns = ["record_id", "type", "target_uri", "payload_bytes", "payload_digest"]
    assert sorted(warc.read_records(spark, again).select(columns).collect(), key=str) == sorted(records.select(columns).collect(), key=str)


def record(kind, identifier, concurrent=(), body=b"", media="text/plain"):
    lines = ["WARC/1.0", f"WARC-Type: {kind}", f"WARC-Record-ID: <{identifier}>", *[f"WARC-Concurrent-To: <{c}>" for c in concurrent],
             f"Content-Type: {media}", f"Content-Length: {len(body)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def test_links_in_any_direction(spark, scratch_dir):
    data = [record("warcinfo", "i"), record("response", "r1", ["q1"], b"HTTP/1.1 404 No\r\nA: b\r\n c\r\n\r\nbody", "application/http; msgtype=response"),
            record("request", "q1", [], b"GET / HTTP/1.0\r\n\r\n", "application/http;msgtype=request"),
            record("metadata", "m1", ["q1"], b"k: v\r\n", "application/warc-fields"), record("metadata", "m2", ["m1"]),
            record("resource", "s1", [], b"plain"), record("metadata", "m3", ["s1", "r1"]), record("metadata", "lost", ["nowhere"]),
            record("request", "alone"), record("metadata", "c1", ["c2"]), record("metadata", "c2", ["c1"])]
    with open(os.path.join(scratch_dir, "x.warc.gz"), "wb") as f:
        f.write(b"".join(map(gzip.compress, data)))
    captures = {c.response.record_id if c.response else tuple(m.record_id for m in [*c.requests, *c.metadata]): c
                for c in warc.transactions(warc.read_records(spark, scratch_dir)).collect()}
    assert set(captures) == {"r1", "s1", ("lost",), ("alone",), ("c1",), ("c2",)}
    r1 = captures["r1"]
    assert [q.record_id for q in r1.requests] == ["q1"] and [m.record_id for m in r1.metadata] == ["m1", "m2", "m3"]
    assert r1.response.fields == {"a": "b c"} and r1.response.payload_bytes == 4 and r1.response.http == "HTTP/1.1 404 No"
    assert r1.metadata[0].fields == {"k": "v"} and captures["s1"].metadata == [] and captures["s1"].response.payload_bytes == 5


@pytest.mark.parametrize("tail", [b"junk that is no record", record("response", "x", body=b"12345")[:-8], gzip.compress(b"WARC/1.1")[:-9]])
def test_damaged_files(spark, scratch_dir, tail):
    with open(os.path.join(scratch_dir, "x.warc"), "wb") as f:
        f.write(gzip.compress(record("response", "a", body=b"1")) + (tail if tail[:2] == b"\x1f\x8b" else gzip.compress(tail)))
    got = warc.read_records(spark, scratch_dir)
    assert [r.type for r in got.orderBy("place").collect()] == ["response", "damaged"]
    assert warc.transactions(got).select(F.col("response.record_id")).collect() == [("a",)]
