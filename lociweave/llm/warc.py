"""WARC archives: writing, the monolithic gzip normaliser, and reading through its index.

A monolithic archive is one gzip stream over all records, which can only be read from its start.  The normaliser
inflates such a file once, as a stream, and rewrites every record as a gzip member of its own, so that a record can be
read alone; a sidecar index beside the archive holds each member's offset and length.  A record that is listed as a
repetition becomes a revisit record on the way; all others, of whatever type and with whatever ids, keep their bytes.

Archives are written under a folder that all executors share (any address pyarrow.fs can open).  A task writes one
file under a name of its own and renames it when it is whole, so lost or repeated tasks leave nothing half done.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociweave.llm.files import Publish, open_file
from lociweave.storage import shared_path, shuffle_width, written

CHUNK = 1 << 20
LEAST_REVISIT_BYTES = 1000
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_ODD = re.compile(r"[\x00-\x20\x7f]")

WRITTEN = "file string, ordinal long, page_id long, payload_bytes long, payload_digest string"
SEEN = "file string, ordinal long, record_id string, record_type string, payload_bytes long, payload_digest string"
INDEX = (
    "file string, offset long, length long, record_id string, page_id long, url string, payload_bytes long, payload_digest string, "
    "record_type string, refers_to_id string"
)
_TYPES = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
_INDEX = pa.schema([(n, _TYPES[t]) for n, t in (c.split(" ") for c in INDEX.split(", "))])
_URN = "<urn:page:"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _urn(page_id: int | None) -> str:
    return f"{_URN}{'' if page_id is None else page_id}>"


def _page(urn: str | None) -> int | None:
    """The page id in a record id that this module gave; null for all other ids."""
    number = urn[len(_URN) : -1] if urn and urn.startswith(_URN) else ""
    return int(number) if number else None


def response(page_id: int | None, url: str | None, payload: bytes, digest: str) -> bytes:
    """One WARC/1.1 response record."""
    body = _HTTP + payload
    head = [
        "WARC/1.1", "WARC-Type: response", f"WARC-Record-ID: {_urn(page_id)}", "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + _ODD.sub(lambda m: f"%{ord(m[0]):02X}", url))
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def revisit_of(raw: bytes, refers_to_id: str) -> bytes:
    """The record as a revisit of another: its own WARC headers and HTTP headers, without the payload."""
    headers, http, payload = parse(raw)
    lines = raw.partition(b"\r\n\r\n")[0].split(b"\r\n")
    own = (b"warc-type:", b"content-length:", b"warc-profile:", b"warc-refers-to:", b"x-payload-length:", b"warc-payload-digest:")
    digest = headers.get("warc-payload-digest") or "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()
    head = [x for x in lines if not x.lower().startswith(own)] + [
        b"WARC-Type: revisit", f"WARC-Payload-Digest: {digest}".encode(), f"X-Payload-Length: {len(payload)}".encode(), f"WARC-Profile: {_PROFILE}".encode(),
        f"WARC-Refers-To: {refers_to_id}".encode(), f"Content-Length: {len(http)}".encode(),
    ]
    return b"\r\n".join(head) + b"\r\n\r\n" + http + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Headers, HTTP headers with their blank line (none where the body is no HTTP message), and payload of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    first, *lines = head.decode("utf-8", "replace").split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError(f"not a WARC record: {first[:40]!r}")
    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    body = rest[: int(headers["content-length"])]
    if not headers.get("content-type", "").lower().startswith("application/http"):
        return headers, b"", body
    http, blank, payload = body.partition(b"\r\n\r\n")
    return headers, http + blank, payload


def records(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """Whole records out of inflated chunks; memory follows the largest record."""
    held = bytearray()
    need = None
    for chunk in chunks:
        held += chunk
        while True:
            if need is None:
                while held[:2] == b"\r\n":  # more blank lines than two between records
                    del held[:2]
                end = held.find(b"\r\n\r\n")
                if end < 0:
                    break
                size = re.search(rb"(?i)\r\ncontent-length:\s*(\d+)", held[: end + 2])
                if not size:
                    raise ValueError(f"a record without a length: {bytes(held[:60])!r}")
                need = end + 4 + int(size[1]) + 4
            if len(held) < need:
                break
            yield bytes(held[:need])
            del held[:need]
            need = None
    if held.strip():
        raise ValueError("the archive ends inside a record")


def inflated(stream) -> Iterator[bytes]:
    """Chunks of a gzip file, whether one member or many; an error where a member is cut short or its checksum fails."""
    engine = None
    while chunk := stream.read(CHUNK):
        while chunk or engine is not None:
            engine = engine or zlib.decompressobj(31)
            out = engine.decompress(chunk, 8 * CHUNK)
            yield out
            if engine.eof:
                chunk, engine = engine.unused_data.lstrip(b"\0"), None
            else:
                chunk = engine.unconsumed_tail
                if not chunk and len(out) < 8 * CHUNK:
                    break
    if engine is not None:
        raise ValueError("the archive ends inside a gzip member")


def write_archives(pages: DataFrame, out: str, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write every row as a response record into one monolithic .warc.gz a task; returns the records written.

    A null payload is empty, a null url is left out, control characters and spaces in a url are %-escaped.
    """
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(html).cast("string"), F.lit("")).cast("binary").alias("payload"),
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        name = f"{out}/raw-{TaskContext.get().partitionId():06d}.warc.gz"
        done: list[tuple] = []
        with Publish(name) as stream:
            engine = zlib.compressobj(1, zlib.DEFLATED, 31)
            batch = first
            while batch is not None:
                for number, address, payload in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    digest = hashlib.sha1(payload).hexdigest()
                    stream.write(engine.compress(response(number, address, payload, digest)))
                    done.append((name, len(done), number, len(payload), digest))
                batch = next(batches, None)
            stream.write(engine.flush())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*done, strict=True), (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True)],
            names=["file", "ordinal", "page_id", "payload_bytes", "payload_digest"],
        )

    return written(rows.mapInArrow(write, WRITTEN), "records")


def recorded_in(files: DataFrame) -> DataFrame:
    """Records of the archives named in files.file: file, ordinal, record_id, record_type, payload_bytes, payload_digest."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                source, path = open_file(name)
                rows = []
                with source.open_input_stream(path, compression=None) as stream:
                    for k, raw in enumerate(records(inflated(stream))):
                        headers, _, payload = parse(raw)
                        rows.append((name, k, headers.get("warc-record-id"), headers.get("warc-type"), len(payload), hashlib.sha1(payload).hexdigest()))
                schema = [c.split(" ") for c in SEEN.split(", ")]
                columns = zip(*rows, strict=True) if rows else [()] * len(schema)
                yield pa.RecordBatch.from_arrays([pa.array(c, _TYPES[t]) for c, (_, t) in zip(columns, schema, strict=True)], names=[n for n, _ in schema])

    return written(_spread(files).mapInArrow(scan, SEEN), "records")


def _spread(files: DataFrame) -> DataFrame:
    """One row a file, a task for each."""
    names = written(files.select("file").distinct(), "files")
    return names.repartition(max(1, names.count()))


def revisits(recorded: DataFrame, least_bytes: int = LEAST_REVISIT_BYTES) -> DataFrame:
    """(file, ordinal, refers_to_id) of the responses that repeat a payload of at least least_bytes.

    recorded: what write_archives or recorded_in gave.  Of equal payloads the record of the largest page_id is kept (a null
    page_id is smallest; of a repeated page_id one); of records without page ids the largest record id.
    """
    if "record_type" in recorded.columns:
        recorded = recorded.where("record_type = 'response'")
        order = [F.col("record_id").alias("by"), "record_id", "file", "ordinal"]
    else:
        number = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
        order = [F.col("page_id").alias("by"), F.concat(F.lit(_URN), number, F.lit(">")).alias("record_id"), "file", "ordinal"]
    large = recorded.where(F.col("payload_bytes") >= least_bytes)
    last = F.max(F.struct(*order)).alias("last")
    groups = written(large.groupBy("payload_digest").agg(last, F.count("*").alias("n")).where("n > 1"), "payloads")
    met = large.join(groups, "payload_digest")
    return met.where("NOT (file = last.file AND ordinal = last.ordinal)").select("file", "ordinal", F.col("last.record_id").alias("refers_to_id"))


def normalise(files: DataFrame, out: str, again: DataFrame | None = None) -> DataFrame:
    """Rewrite every archive named in files.file with one member a record, and a sidecar index; returns the index.

    again: rows of (file, ordinal, refers_to_id) for records to be written as revisits.  A file's list has at most one
    entry a record of that file.  An archive that is cut short or damaged is an error.
    """
    names = _spread(files)
    if again is not None:
        own = written(again.groupBy(F.col("file").alias("_file")).agg(F.collect_list(F.struct("ordinal", "refers_to_id")).alias("again")), "again")
        names = names.join(own, names["file"] == own["_file"], "left").select("file", "again")
        names = names.repartition(max(1, files.select("file").distinct().count()))
    else:
        names = names.withColumn("again", F.lit(None).cast("array<struct<ordinal: long, refers_to_id: string>>"))

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, listed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                known = {x["ordinal"]: x["refers_to_id"] for x in listed or ()}
                target = f"{out}/{name.rpartition('/')[2].replace('raw-', 'part-')}"
                source, path = open_file(name)
                rows, at = [], 0
                with source.open_input_stream(path, compression=None) as stream, Publish(target) as put:
                    for k, raw in enumerate(records(inflated(stream))):
                        headers, _, payload = parse(raw)
                        urn, kind, refers = headers.get("warc-record-id"), headers.get("warc-type"), headers.get("warc-refers-to")
                        size, digest = _payload_of(headers, payload)
                        if k in known:
                            raw, kind, refers = revisit_of(raw, known[k]), "revisit", known[k]
                        engine = zlib.compressobj(5, zlib.DEFLATED, 31)
                        member = engine.compress(raw) + engine.flush()
                        put.write(member)
                        rows.append((target, at, len(member), urn, _page(urn), headers.get("warc-target-uri"), size, digest, kind, refers))
                        at += len(member)
                columns = zip(*rows, strict=True) if rows else [()] * len(_INDEX)
                index = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _INDEX, strict=True)], schema=_INDEX)
                with Publish(f"{target}.index.parquet") as put:
                    pq.write_table(pa.Table.from_batches([index]), put)
                yield index

    return written(names.mapInArrow(rewrite, INDEX), "index")


def _payload_of(headers: dict[str, str], payload: bytes) -> tuple[int | None, str | None]:
    """Length and hexadecimal SHA-1 of a record's full payload; null where a revisit of other makers does not say."""
    if headers.get("warc-type") != "revisit":
        return len(payload), hashlib.sha1(payload).hexdigest()
    kind, _, code = headers.get("warc-payload-digest", "").partition(":")
    size = headers.get("x-payload-length")
    hexadecimal = None
    if kind.lower() == "sha1":
        hexadecimal = base64.b32decode(code.upper()).hex() if len(code) == 32 else code.lower()
    return int(size) if size else None, hexadecimal


def read_records(index: DataFrame, payloads: bool = False) -> DataFrame:
    """Read each indexed record alone, by its offset: what the record itself says, the payload too if asked for.

    record_id, page_id, payload_bytes, payload_digest, record_type, refers_to (a page_id), refers_to_id (and payload, null
    for revisits).  page_id and refers_to are null where the ids are not those of write_archives.  Records of a file are
    read in order of their offsets.
    """
    places = index.select("file", "offset", "length").repartition(shuffle_width(index.sparkSession), "file", F.expr("offset div 16777216"))
    schema = "record_id string, page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, refers_to_id string, payload binary"
    fields = [c.split(" ") for c in schema.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, name = None, None
        for batch in batches:
            rows = []
            for file, offset, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if file != name:
                    if opened is not None:
                        opened.close()
                    source, path = open_file(file)
                    opened, name = source.open_input_file(path), file
                headers, _, payload = parse(zlib.decompress(opened.read_at(length, offset), 31))
                urn, kind, refers = headers.get("warc-record-id"), headers.get("warc-type"), headers.get("warc-refers-to")
                rows.append((urn, _page(urn), *_payload_of(headers, payload), kind, _page(refers), refers, payload if payloads and kind != "revisit" else None))
            columns = list(zip(*rows, strict=True)) or [()] * len(fields)
            yield pa.RecordBatch.from_arrays([pa.array(c, _TYPES[t]) for c, (_, t) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])

    found = places.sortWithinPartitions("file", "offset").mapInArrow(read, schema)
    return found if payloads else found.drop("payload")


def archive_pages(pages: DataFrame, out: str | None = None) -> DataFrame:
    """Write pages into monolithic archives, normalise them with revisits, and read every record back by its index.

    page_id, payload_bytes, payload_digest, record_type, refers_to.  Repeated rows are records of their own; an empty table
    makes no archive and no rows; other columns are ignored.
    """
    out = out or shared_path(pages.sparkSession, "warc")
    recorded = write_archives(pages, f"{out}/raw")
    read = read_records(normalise(recorded, f"{out}/warc", revisits(recorded)))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
