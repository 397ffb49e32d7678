"""WARC: round trips, segments, chunk framing, revisits and faults."""

import gzip
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001
from tidewater.llm import queries, warc

SCHEMA = "page_id bigint, url string, html string, digest string, payload string"


def back(spark, rows, tmp, payload=True, **kw):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    warc.write_archives(df, f"{tmp}/a", **kw)
    got = warc.reassemble(warc.read_records(spark, f"{tmp}/a", payload), payload)
    return got.withColumn("page_id", warc.page_of(F.col("record_id"))).withColumn(
        "refers_to", warc.page_of(F.col("refers_to"))).collect()


def test_segments_and_chunks_round_trip(spark, tmp):
    texts = ["", "a", "é" * 700, "x\r\n\r\nWARC/1.1\r\n" * 40, "0\r\n\r\n", "long " * 300_000]
    rows = back(spark, [(i, f"http://a/{i}", t) for i, t in enumerate(texts)], tmp, segment=500, chunk=64)
    assert {r.page_id: r.payload.decode() for r in rows} == dict(enumerate(texts))
    assert all(r.fault is None and r.found == r.digest == warc.base32_sha1(r.payload) for r in rows)
    files = [f for f in os.listdir(f"{tmp}/a") if f.endswith(".gz")]
    data = b"".join(gzip.open(f"{tmp}/a/{f}").read() for f in files)
    kinds = [f["warc-type"] for f, _, fault in warc.records_of(data) if not fault]
    assert kinds.count("response") == len(texts) and kinds.count("continuation") > 1000


def test_revisits_ties_nulls_and_repeats(spark, tmp):
    rows = back(spark, [(5, "u", "same"), (3, "u", "same"), (3, "u", "same"), (None, None, "same"), (4, "v", None),
                        (9, "bad \r\n url", ""), (None, "w", "alone"), (None, "w", "alone"), (7, "u", "one")], tmp)
    got = sorted(((r.page_id, r.record_type, r.refers_to, r.payload_bytes, r.digest) for r in rows), key=str)
    d = warc.base32_sha1
    assert got == sorted([
        (5, "revisit", 3, 4, d(b"same")), (3, "response", None, 4, d(b"same")), (3, "response", None, 4, d(b"same")),
        (None, "revisit", 3, 4, d(b"same")), (4, "response", None, 0, d(b"")), (9, "revisit", 4, 0, d(b"")),
        (None, "response", None, 5, d(b"alone")), (None, "response", None, 5, d(b"alone")),
        (7, "response", None, 3, d(b"one"))], key=str)


def test_min_bytes_keeps_small_payloads_as_responses(spark, tmp):
    rows = back(spark, [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], tmp, min_bytes=3)
    assert sorted((r.page_id, r.record_type) for r in rows) == [
        (1, "response"), (2, "response"), (3, "response"), (4, "revisit")]


def test_empty_table(spark, tmp):
    assert back(spark, [], tmp) == []


def test_faults_are_reported(spark, tmp):
    def segment(n, block, total=None, **more):
        return warc.record([("WARC-Type", "response" if n == 1 else "continuation"),
                            ("WARC-Record-ID", f"<urn:x-page:1:{n}>" if n > 1 else "<urn:x-page:1>"),
                            ("WARC-Payload-Digest", "sha1:" + warc.base32_sha1(b"hello") if n == 1 else None),
                            ("WARC-Segment-Number", str(n)), *more.items(),
                            ("WARC-Segment-Total-Length", None if total is None else str(total)),
                            ("WARC-Segment-Origin-ID", None if n == 1 else "<urn:x-page:1>")], block)

    m = warc.http_message(b"hello", 2)
    cases = {
        "ok": [segment(2, m[50:], len(m)), segment(1, m[:50])],
        "missing": [segment(1, m[:50]), segment(3, m[60:], len(m))],
        "repeated": [segment(1, m[:50]), segment(2, m[50:], len(m)), segment(2, m[50:], len(m))],
        "length": [segment(1, m[:50]), segment(2, m[50:], len(m) + 1)],
        "orphan": [segment(2, m[50:], len(m))],
        "framing": [segment(1, m[:50]), segment(2, m[50:-9], len(m) - 9)],
        "digest": [segment(1, warc.http_message(b"other")[:50]),
                   segment(2, warc.http_message(b"other")[50:], len(warc.http_message(b"other")))],
    }
    for name, records in cases.items():
        os.makedirs(f"{tmp}/{name}")
        with gzip.open(f"{tmp}/{name}/x.warc.gz", "wb") as f:
            f.write(b"".join(records))
        rows = warc.reassemble(warc.read_records(spark, f"{tmp}/{name}")).collect()
        assert len(rows) == 1 and (rows[0].fault is None) == (name == "ok"), (name, rows)


def test_unframe():
    for size in (1, 3, 5, 100):
        assert warc.unframe(warc.http_message(b"0\r\n\r\nab", size)) == b"0\r\n\r\nab"
    with pytest.raises(ValueError):
        warc.unframe(b"HTTP/1.1 200 OK")
    with pytest.raises(ValueError):
        warc.unframe(b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n5\r\nab\r\n0\r\n\r\n")


def test_query_equals_oracle(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{SF001}/pages.parquet')")
    got = queries.op2_warc(spark, SF001)
    want = con.sql(queries.SQL["op2_warc"])
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(str, map(tuple, got.select(want.columns).collect()))) == sorted(map(str, want.fetchall()))


def test_oracle_on_shared_payloads(spark, tmp):
    rows = [(5, "u", "same"), (3, "u", "same"), (4, "v", None), (9, "u", ""), (7, "u", "é")]
    spark.createDataFrame(rows, "page_id bigint, url string, html string").write.parquet(f"{tmp}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp}/pages.parquet/*.parquet')")
    want = con.sql(queries.SQL["op2_warc"])
    got = queries.op2_warc(spark, tmp).select(want.columns)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want.fetchall()))


def foreign(kind, ident, payload: bytes, style: int) -> bytes:
    """A record as other writers put it: other case, no space, folded values."""
    digest = warc.base32_sha1(payload)
    block = b"HTTP/1.1 200 OK\r\nContent-Length: %d\r\n\r\n" % len(payload) + payload
    heads = [f"WARC-Type: {kind}\r\nWARC-Record-ID: {ident}\r\nWARC-Payload-Digest: sha1:{digest}\r\nContent-Length: {len(block)}",
             f"warc-type:{kind}\r\nWARC-RECORD-ID:{ident}\r\nwarc-payload-digest:sha1:{digest}\r\ncontent-length:{len(block)}",
             f"WARC-Type:\t{kind}\r\nWARC-Record-ID:\r\n {ident}\r\nWARC-Payload-Digest:\r\n\tsha1:{digest}\r\nno colon\r\nContent-Length : {len(block)}"]
    return b"WARC/1.0\r\n" + heads[style].encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def test_foreign_and_damaged_archives(spark, tmp):
    """A record with a fault costs no other: other header styles, kinds without payload, a
    wrong length, a record cut short, junk between records, a broken gzip member."""
    good = [foreign("response", f"<urn:x-page:{i}>", b"page %d" % i, i % 3) for i in range(9)]
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:info>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    wrong = foreign("response", "<urn:x-page:50>", b"wrong", 0).replace(b"Content-Length: 4", b"Content-Length: 9")
    none = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x-page:51>\r\n\r\nabc\r\n\r\n"
    os.makedirs(f"{tmp}/a")
    z = gzip.compress
    archives = [z(good[0] + info + good[1]), z(good[2]) + z(wrong) + z(good[3]), z(good[4] + none + b"junk\r\n\r\n" + good[5]),
                z(good[6] + foreign("response", "<urn:x-page:52>", b"cut short", 0)[:-9]), z(good[7]) + z(good[8])[:-12], b"no gzip at all", b""]
    for i, data in enumerate(archives):
        with open(f"{tmp}/a/{i}.warc.gz", "wb") as f:
            f.write(data)
    rows = warc.reassemble(warc.read_records(spark, f"{tmp}/a")).withColumn("page_id", warc.page_of(F.col("record_id"))).collect()
    sound = {r.page_id: (r.payload_bytes, r.found) for r in rows if r.fault is None and r.record_type == "response"}
    assert {i: sound.get(i) for i in range(8)} == {i: (6, warc.base32_sha1(b"page %d" % i)) for i in range(8)}
    faults = {r.page_id: r.fault for r in rows if r.fault}
    assert faults[50] == faults[52] == "a record is shorter than its length" and faults[51] == "a record without a length"
    assert None in faults and [r.record_type for r in rows if r.record_id == "<urn:info>"] == ["warcinfo"]
