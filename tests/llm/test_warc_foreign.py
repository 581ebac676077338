"""Archives of other makers: uuid ids, warcinfo, request and revisit records, bodies that are no HTTP, damaged files."""

import gzip
import hashlib

import pytest

from lociweave.llm import warc

BIG = b"<p>" + bytes(range(256)) * 6000 + b"\r\n\r\n</p>"  # over one read chunk


def record(kind, urn, body, content="application/http; msgtype=response", more=()):
    head = ["WARC/1.0", f"WARC-Type: {kind}", f"WARC-Record-ID: {urn}", *more, f"Content-Type: {content}", f"content-length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


HTTP = b"HTTP/1.1 200 OK\r\nServer: x\r\n\r\n"
RECORDS = [
    record("warcinfo", "<urn:uuid:00>", b"software: a\r\n\r\nformat: b", "application/warc-fields"),
    record("request", "<urn:uuid:01>", b"GET / HTTP/1.1\r\nHost: a\r\n\r\n", "application/http; msgtype=request"),
    record("response", "<urn:uuid:02>", HTTP + BIG, more=["WARC-Target-URI: http://a/"]),
    record("response", "<urn:uuid:03>", HTTP + BIG, more=["WARC-Target-URI: http://b/"]),
    record("revisit", "<urn:uuid:04>", HTTP, more=["WARC-Refers-To: <urn:uuid:02>", "WARC-Payload-Digest: sha1:AAAQEAYEAUDAOCAJBIFQYDIOB4IBCEQT"]),
    record("resource", "<urn:uuid:05>", b"plain\r\n\r\nbody", "text/plain"),
    record("response", "<urn:uuid:06>", b"HTTP/1.1 204 No Content\r\n\r\n"),
]


@pytest.fixture
def archive(tmp_path):
    path = tmp_path / "other.warc.gz"
    path.write_bytes(gzip.compress(b"".join(RECORDS)))
    return path


def test_records_of_other_makers_keep_their_bytes(spark, tmp_path, archive):
    files = spark.createDataFrame([(archive.as_uri(),)], "file string")
    index = warc.normalise(files, (tmp_path / "out").as_uri())
    rows = sorted(index.collect(), key=lambda r: r.offset)
    raw = (tmp_path / "out" / "other.warc.gz").read_bytes()
    assert [gzip.decompress(raw[r.offset : r.offset + r.length]) for r in rows] == RECORDS
    assert [(r.record_type, r.record_id, r.page_id) for r in rows] == [
        (k, f"<urn:uuid:0{i}>", None) for i, k in enumerate(["warcinfo", "request", "response", "response", "revisit", "resource", "response"])
    ]
    got = {r.record_id: r for r in warc.read_records(index, payloads=True).collect()}
    assert bytes(got["<urn:uuid:02>"].payload) == BIG and bytes(got["<urn:uuid:05>"].payload) == b"plain\r\n\r\nbody"
    assert bytes(got["<urn:uuid:00>"].payload).startswith(b"software") and bytes(got["<urn:uuid:06>"].payload) == b""
    four = got["<urn:uuid:04>"]
    assert (four.refers_to_id, four.refers_to, four.payload, four.payload_bytes) == ("<urn:uuid:02>", None, None, None)
    assert four.payload_digest == bytes(range(20)).hex()


def test_repeated_payloads_of_other_makers_become_revisits(spark, tmp_path, archive):
    files = spark.createDataFrame([(archive.as_uri(),)], "file string")
    again = warc.revisits(warc.recorded_in(files))
    assert [(r.ordinal, r.refers_to_id) for r in again.collect()] == [(2, "<urn:uuid:03>")]
    got = {r.record_id: r for r in warc.read_records(warc.normalise(files, (tmp_path / "out").as_uri(), again)).collect()}
    two = got["<urn:uuid:02>"]
    assert (two.record_type, two.refers_to_id, two.payload_bytes, two.payload_digest) == ("revisit", "<urn:uuid:03>", len(BIG), hashlib.sha1(BIG).hexdigest())
    assert {r.record_type for i, r in got.items() if i != "<urn:uuid:02>"} == {"warcinfo", "request", "response", "revisit", "resource"}


@pytest.mark.parametrize("lost", [4, 8, 3000])
def test_a_file_that_is_cut_short_is_an_error(archive, lost):
    archive.write_bytes(archive.read_bytes()[:-lost])
    with pytest.raises(ValueError, match="ends inside"), open(archive, "rb") as stream:
        list(warc.records(warc.inflated(stream)))


def test_members_and_trailing_zeros_are_read(archive):
    archive.write_bytes(b"".join(map(gzip.compress, RECORDS)) + b"\0" * 10)
    with open(archive, "rb") as stream:
        assert list(warc.records(warc.inflated(stream))) == RECORDS
