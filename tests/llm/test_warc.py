"""Archives: records of any content read back, captures assembled from records in any order."""

from __future__ import annotations

import gzip
import hashlib
from pathlib import Path

import pytest

from orderloom.llm.common import new_folder
from orderloom.llm.warc import archive_captures, assemble, parse_records, read_archive

COLUMNS = "page_id long, url string, html string, payload_bytes string"


def rows():
    long = "<p>" + "words " * 100_000
    same = "equal payload " * 10
    out = [(3, "http://a/x", same, "z"), (1, None, same, "z"), (9, "http://b/\r\ninjected: x", same, "z"),
           (4, "u", "short", "z"), (5, "u", "short", "z"), (6, "u", None, "z"), (7, "u", "", "z"), (8, "u", long, "z"),
           (10, "u", "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nabc" * 3, "z"),
           (11, "u", "é" * 50, "z"), (12, "u", "é" * 50, "z"), (13, "u", "é" * 49 + "a", "z"), (4, "u", "short", "z")]
    return out + [(100 + i, "u", "many copies of this page " * 8, "z") for i in range(60)]


def test_round_trip(spark):
    pages = spark.createDataFrame(rows(), COLUMNS).repartition(5)
    folder = new_folder(spark, "warc-test")
    got = {int(r.capture_id.rsplit(":", 1)[1]): r for r in archive_captures(pages, folder).collect()}
    payloads = {i: (h or "").encode() for i, _, h, _ in rows()}
    assert set(got) == set(payloads)
    for i, data in payloads.items():
        r = got[i]
        first = min(j for j, d in payloads.items() if d == data)
        again = len(data) >= 100 and first != i
        assert (r.payload_bytes, r.payload_digest) == (len(data), hashlib.sha256(data).hexdigest())
        assert r.response.type == ("revisit" if again else "response")
        assert r.response.refers_to == (f"urn:capture:response:{first}" if again else None)
        assert r.request.record_id == f"urn:capture:request:{i}" and len(r.metadata) == 1
    stored = {r.record_id: bytes(r.payload) for r in read_archive(spark, folder, True).filter("type='response'").collect()}
    assert all(payloads[int(k.rsplit(":", 1)[1])] == v for k, v in stored.items())
    assert len(list(Path(folder).glob("*.gz"))) > 0


def test_no_pages_and_null_ids(spark):
    pages = spark.createDataFrame([], COLUMNS)
    assert archive_captures(pages, new_folder(spark, "warc-test")).count() == 0
    pages = spark.createDataFrame([(None, "u", "x" * 200, "z"), (2, "u", "x" * 200, "z")], COLUMNS)
    got = archive_captures(pages, new_folder(spark, "warc-test")).collect()
    assert sorted(r.capture_id for r in got) == ["urn:capture:response:2", "urn:capture:response:null"]
    assert {r.payload_bytes for r in got} == {200}


def test_links_in_either_direction(spark):
    schema = ("record_id string, type string, concurrent_to string, refers_to string, uri string, digest string, "
              "payload_bytes long, payload_sha256 string, fields map<string,string>")

    def row(name, kind, to=None):
        return (name, kind, to, None, "u", None, 1, "s", {"a": "b"} if kind == "metadata" else None)

    records = spark.createDataFrame([
        row("r1", "response"), row("q1", "request", "r1"), row("m1", "metadata", "q1"), row("m1", "metadata", "q1"),
        row("r2", "response", "q2"), row("q2", "request"), row("m2", "metadata", "r2"), row("m3", "metadata", "r2"),
        row("q9", "request", "gone"), row("r3", "revisit"), row("w", "warcinfo")], schema)
    got = {r.capture_id: (r.response and r.response.record_id, r.request and r.request.record_id,
                          [m.record_id for m in r.metadata or []]) for r in assemble(records).collect()}
    assert got == {"r1": ("r1", "q1", ["m1"]), "r2": ("r2", "q2", ["m2", "m3"]), "gone": (None, "q9", []),
                   "r3": ("r3", None, [])}


def test_cut_records_are_an_error():
    record = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 4\r\n\r\nabcd\r\n\r\n"
    assert [b for _, b in parse_records(record * 2)] == [b"abcd"] * 2
    assert [b for _, b in parse_records(gzip.decompress(gzip.compress(record) * 2))] == [b"abcd"] * 2
    for broken in (record[:-6], b"junk" + record, record + b"x"):
        with pytest.raises(ValueError):
            list(parse_records(broken))
