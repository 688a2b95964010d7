import base64
import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from tablework.llm import queries, warc
from tablework.session import shared_scratch

TRAP = "x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
PAGES = [(1, "http://a.org/x", "<p>é</p>"), (2, "http://a.org/y?q=1#f", "<p>é</p>"), (3, None, None), (4, "bad\r\nurl", ""),
         (5, "http://b.org", TRAP), (6, "http://b.org/2", TRAP), (None, "http://n.org", TRAP), (7, "u://h", "z" * 300000),
         (8, "u://h", "unique"), (8, "u://h", "unique"), (9, "http://c.org", "日本\n\r\n")]
SCHEMA = "page_id long, url string, html string"


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def test_round_trip_equals_brute_force(spark, monkeypatch):
    pages = spark.createDataFrame(PAGES, SCHEMA).withColumns({"digest": F.lit(1), "copies": F.lit(2), "row": F.lit(3)})
    monkeypatch.setattr(queries, "table", lambda *a: pages)
    got = sorted((tuple(r) for r in queries.op7_warc(spark, "").collect()), key=str)
    want = []
    for i, _, html in PAGES:
        top = max(p for p, _, h in PAGES if (h or "") == (html or "") and p is not None)
        want.append((i, len((html or "").encode()), digest(html), "response" if i == top else "revisit",
                     None if i == top else top))
    assert got == sorted(want, key=str)


def test_records_and_captures(spark):
    path = shared_scratch(spark, "warc-test")
    warc.write_archives(spark.createDataFrame(PAGES, SCHEMA), path, archive_bytes=100000)
    records = warc.read_archives(spark, path).collect()
    assert len(records) == 3 * (len(PAGES) - 1)
    assert len({r.record_id for r in records}) == len(records)
    bodies = sorted(bytes(r.payload) for r in records if r.warc_type == "response")
    assert bodies == sorted({(h or "").encode() for _, _, h in PAGES})
    captures = warc.assemble(warc.read_archives(spark, path)).collect()
    assert len(captures) == len(PAGES) - 1
    assert all(len(c.requests) == 1 and len(c.metadata) == 1 and c.response for c in captures)
    assert all(c.requests[0].concurrent_to == c.response.record_id for c in captures)


def test_min_bytes_and_empty(spark):
    pages = spark.createDataFrame(PAGES, SCHEMA)
    kinds = {(r.response.warc_type, int(r.response.payload_bytes)) for r in warc.round_trip(pages, min_bytes=100000).collect()}
    assert {k for k, _ in kinds} == {"response"}
    assert warc.round_trip(spark.createDataFrame([], SCHEMA)).collect() == []


def test_orphans_stay(spark):
    rows = [("a", "response", None), ("b", "request", "a"), ("c", "metadata", "zz"), ("d", "request", None)]
    df = spark.createDataFrame(rows, "record_id string, warc_type string, concurrent_to string")
    got = {r.capture_id: (r.response is not None, len(r.requests or []), len(r.metadata or [])) for r in warc.assemble(df).collect()}
    assert got == {"a": (True, 1, 0), "zz": (False, 0, 1), "d": (False, 1, 0)}


def test_parser_plain_gzip_and_damage():
    one = b"WARC/1.0\r\nWARC-Type: metadata\r\nContent-Type: application/warc-fields\r\nContent-Length: 6\r\n\r\na: b\r\n\r\n\r\n"
    two = one.replace(b"a: b", b"c: d")
    for content in (one + two, gzip.compress(one + two), gzip.compress(one) + gzip.compress(two)):
        assert [warc.row_of(*r)[9] for r in warc.records_in(content)] == [[("a", "b")], [("c", "d")]]
    assert list(warc.records_in(b"")) == []
    with pytest.raises(ValueError):
        list(warc.records_in(one[:-8]))
    with pytest.raises(ValueError):
        list(warc.records_in(b"garbage\r\n\r\n"))


def test_digest_hashes_a_payload_once(spark):
    texts = [None, "", "a", "é" * 1000]
    df = spark.createDataFrame([(t,) for t in texts], "payload string")
    got = warc.with_digest(df, "digest", F.when(F.col("payload") != "a", F.col("payload")))
    assert [r.digest for r in got.collect()] == [None, digest(""), None, digest("é" * 1000)]
    assert got._jdf.queryExecution().executedPlan().toString().count("sha1(") == 1


def test_archives_are_taken_apart_once(spark, monkeypatch):
    counted, read = spark.sparkContext.accumulator(0), warc.read_archives

    def counting(*args):
        def seen(batches):
            for batch in batches:
                counted.add(batch.num_rows)
                yield batch
        df = read(*args)
        return df.mapInArrow(seen, df.schema)

    monkeypatch.setattr(warc, "read_archives", counting)
    warc.round_trip(spark.createDataFrame(PAGES, SCHEMA)).collect()
    assert counted.value == 3 * (len(PAGES) - 1)
