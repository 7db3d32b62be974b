"""WARC round trips against plain Python, and archives written by hand."""

import gzip
import hashlib
import json

import pytest

from tidemart.llm import warc
from tidemart.llm.queries import op13_warc
from tidemart.session import scratch_dir

SF = "/root/testdata/sf0.001"
PAGES = "page_id long, url string, html string, extra int, `type` string"


def expected(rows, least=100):
    """(id, bytes, digest) -> kinds: the smallest id of equal payloads is the response, the others revisit it."""
    groups = {}
    for i, html in rows:
        groups.setdefault((html or "").encode(), []).append(i)
    out = []
    for payload, ids in groups.items():
        ids = sorted(ids, key=lambda i: (i is None, i or 0))
        for k, i in enumerate(ids):
            revisit = len(payload) >= least and k > 0
            out.append((i, len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if revisit else "response",
                        ids[0] if revisit else None))
    return sorted(out, key=repr)


def result(df):
    return sorted([(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])
                   for r in df.collect()], key=repr)


def test_round_trip_of_the_table(spark):
    rows = [(r["page_id"], r["html"]) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    assert result(op13_warc(spark, SF)) == expected(rows)


INNER = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:0>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
TEXTS = [None, "", "x" * 99, "y" * 100, "é" * 50, "é" * 49, "a\r\n\r\nb" * 40, "ends\r\n\r\n", "\r\n", "WARC/1.", "WARC/1.0\r\n",
         INNER, INNER * 3 + "tail", "WWARC/1.1 " * 30, "\x00\x01\x1f  \U0001F600" * 30, "z" * 300000, INNER * 2000]


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_odd_payloads_and_ids(spark, compression):
    rows = [(i, f"http://h{i}/p q\r\nX: {i}" if i % 3 else None, t, i, "t") for i, t in enumerate(TEXTS * 2)]
    rows += [(5, "u", "y" * 100, 0, None), (3, "u", "y" * 100, 0, None), (None, "u", "y" * 100, 0, None),
             (None, None, "n" * 200, 0, None), (None, None, "n" * 200, 0, None)]
    df = spark.createDataFrame(rows, PAGES)
    path = scratch_dir(spark, "warc-test")
    warc.write_archive(df, path, compression=compression)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")  # records lie across splits
    try:
        captures = warc.assemble(warc.read_archive(spark, path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(captures) == len(rows)
    seen, by_id = [], {c["response"]["record_id"]: c for c in captures}
    for c in captures:
        told = json.loads(bytes(c["metadata"]["block"]))
        r = c["response"]
        of = by_id[r["refers_to"]] if r["refers_to"] else c
        payload = bytes(of["response"]["payload"])  # a revisit's payload is its response's
        assert (r["payload_bytes"], r["payload_digest"]) == (len(payload), hashlib.sha256(payload).hexdigest())
        assert bytes(c["request"]["block"]).startswith(b"GET ") and c["n_requests"] == c["n_metadata"] == 1
        seen.append((told.get("id"), told.get("url"), payload.decode()))
    assert sorted(seen, key=repr) == sorted([(i, u, t or "") for i, u, t, *_ in rows], key=repr)
    if compression == "gzip":
        got = result(warc.round_trip(df, scratch_dir(spark, "warc-test")))
        assert got == expected([(r[0], r[2]) for r in rows])


def test_empty_table(spark):
    empty = spark.createDataFrame([], PAGES)
    assert warc.round_trip(empty, scratch_dir(spark, "warc-test")).count() == 0


def test_hot_payload_is_one_response(spark):
    rows = [(i, "u", "same" * 50 if i % 3 else f"{i}" * 120, 0, None) for i in range(3000)]
    got = result(warc.round_trip(spark.createDataFrame(rows, PAGES), scratch_dir(spark, "warc-test")))
    assert got == expected([(r[0], r[2]) for r in rows])


def by_hand(kind, rid, block, *extra):
    return "\r\n".join([f"WARC/1.0", f"WARC-Type: {kind}", f"WARC-Record-ID: <{rid}>", *extra,
                        f"Content-Length: {len(block.encode())}", "", block, "", ""])


def test_archives_from_elsewhere(spark, tmp_path):
    http = "HTTP/1.1 200 OK\r\nX: y\r\n\r\n"
    one = [by_hand("warcinfo", "i", "software: x"),
           # the response names the request; the metadata names the request: two steps
           by_hand("response", "r1", http + "body one", "WARC-Concurrent-To:\r\n <q1>", "Content-Type: application/http"),
           by_hand("request", "q1", "GET / HTTP/1.1\r\n\r\n"),
           by_hand("metadata", "m1", "k: v WARC/1.0 inside", "warc-concurrent-to: <q1>"),
           # several of a kind; two concurrent-to fields
           by_hand("response", "r2", http + "body two", "Content-Type: application/http"),
           by_hand("metadata", "m3", "b", "WARC-Concurrent-To: <r2>"),
           by_hand("metadata", "m2", "a", "WARC-Concurrent-To: <unknown>", "WARC-Concurrent-To: <r2>")]
    two = [by_hand("resource", "r3", "plain", "Content-Type: text/plain"), by_hand("request", "q9", "lonely"),
           by_hand("response", "r4", "cut off" * 50)[:-200]]
    (tmp_path / "a.warc").write_text("".join(one), newline="")
    (tmp_path / "b.warc.gz").write_bytes(b"".join(gzip.compress(r.encode()) for r in two))  # one member per record
    found = {c["capture_id"]: c for c in warc.assemble(warc.read_archive(spark, f"{tmp_path}")).collect()}
    assert sorted(found) == ["q9", "r1", "r2", "r3", "r4"]
    r1, r2 = found["r1"], found["r2"]
    assert bytes(r1["response"]["payload"]) == b"body one" and r1["request"]["record_id"] == "q1"
    assert bytes(r1["metadata"]["block"]) == b"k: v WARC/1.0 inside"
    assert (r2["metadata"]["record_id"], r2["n_metadata"], r2["request"], r2["n_requests"]) == ("m2", 2, None, 0)
    assert bytes(found["r3"]["response"]["payload"]) == b"plain" and found["r3"]["response"]["complete"]
    assert not found["r4"]["response"]["complete"] and found["q9"]["response"] is None
