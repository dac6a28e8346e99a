"""WARC archives as chunked record tables.

Writing.  Payloads are first cut into rows (record id, chunk number, bytes) of
at most ``CHUNK`` characters, so no task holds a long payload whole while it
writes: it streams the sorted rows of its records into one gzip member per
record.  Equal payloads share one response record, that of the smallest page
id; the others are revisit records that point to it.  Each task writes a file
of its own under a new name and reports it in a manifest; the manifest is
staged, so files of lost or repeated attempts are never read.

Reading.  A task streams an archive and emits a row per record and chunk:
archive, record number, chunk number, the chunk, and the running size and
SHA-1 of the payload so far.  Only the last chunk's digest is complete; memory
stays at one chunk whatever the record size.

A null page is an empty payload.  Rows with a null page_id are records too;
among equal payloads they come last.  Repeated rows are separate records.
Archives are opened with ``pyarrow.fs``, so the shared folder may be any store
it knows.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintagelake.llm.common import stage, stage_path

CHUNK = 1 << 20
BUFFER = 1 << 18


DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_SAFE = re.compile(r"[\x00-\x20\x7f]")


def _escape(m: re.Match) -> str:
    return f"%{ord(m[0]):02X}"


def _open_store(uri: str):
    """(file system, path) of an archive folder or file, as staged paths or plain paths."""
    if "://" in uri:
        return pyarrow.fs.FileSystem.from_uri(uri)
    return pyarrow.fs.LocalFileSystem(), uri.removeprefix("file:")


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def record_id(number: int) -> str:
    return f"<urn:uuid:{uuid.UUID(int=(1 << 127) | number)}>"


def record_number(text: str) -> int:
    return uuid.UUID(text.strip("<>").removeprefix("urn:uuid:")).int & ((1 << 63) - 1)


def _record(fields: list[tuple[str, str | None]], length: int) -> bytes:
    lines = [f"{k}: {v}" for k, v in [*fields, ("Content-Length", str(length))] if v is not None]
    return ("WARC/1.1\r\n" + "\r\n".join(lines) + "\r\n\r\n").encode()


def plan_chunks(pages: DataFrame, min_bytes: int = 0, chunk: int = CHUNK) -> DataFrame:
    """(rid, page_id, url, bytes, sha1, refers, chunk_no, chunk): the rows of all records.

    ``refers`` is the number of the response that a revisit refers to.  The
    rows with their record numbers are staged, as a number must not change.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce("html", F.lit("")).alias("payload"))
    rows = stage(rows.withColumns({
        "rid": F.monotonically_increasing_id(), "bytes": F.octet_length("payload").cast("long"),
        "sha1": F.sha1(F.col("payload").cast("binary"))}), "records")
    narrow = rows.select("rid", "page_id", "bytes", "sha1")
    order = F.struct(F.col("page_id").isNull(), "page_id", "rid")
    first = narrow.filter(F.col("bytes") >= min_bytes).groupBy("sha1", "bytes").agg(F.min(order)["rid"].alias("first"))
    known = narrow.join(first, ["sha1", "bytes"], "left").select(
        "rid", F.when(F.col("first") != F.col("rid"), F.col("first")).alias("refers"))
    rows = rows.join(known, "rid")
    # a revisit holds no payload; a long payload is cut before any task writes it
    last = F.when(F.col("refers").isNotNull(), F.lit(0)).otherwise(
        F.floor((F.greatest(F.char_length("payload"), F.lit(1)) - 1) / chunk)).cast("int")
    rows = rows.withColumn("chunk_no", F.explode(F.sequence(F.lit(0), last)))
    piece = F.when(F.col("refers").isNotNull(), F.lit("")).when(last == 0, F.col("payload")).otherwise(
        F.substring("payload", F.col("chunk_no") * chunk + 1, F.lit(chunk)))
    return rows.select("rid", "page_id", "url", "bytes", "sha1", "refers", "chunk_no",
                       piece.cast("binary").alias("chunk"))


def write_archives(chunks: DataFrame, uri: str) -> DataFrame:
    """Write the records into gzipped archives below ``uri``; the manifest (archive, records, bytes) is staged."""
    def write(batches):
        store = None
        name, out, gz, n, size = None, None, None, 0, 0

        def put(data):
            nonlocal size
            if packed := gz.compress(data):
                size += out.write(packed)

        def end():
            nonlocal size
            put(b"\r\n\r\n")
            size += out.write(gz.flush())
        current = None
        for b in batches:
            cols = [b.column(i) for i in range(8)]
            for i in range(b.num_rows):
                rid = cols[0][i].as_py()
                if out is None:
                    store, root = _open_store(uri)
                    store.create_dir(root, recursive=True)
                    part = f"{uuid.uuid4().hex}.warc.gz"
                    name = f"{uri.rstrip('/')}/{part}"
                    out = store.open_output_stream(f"{root}/{part}", compression=None)
                if rid != current:
                    if current is not None:
                        end()
                    current, n = rid, n + 1
                    gz = zlib.compressobj(6, zlib.DEFLATED, 31)
                    page, url, length, sha1, refers = (c[i].as_py() for c in cols[1:6])
                    http = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                            f"Content-Length: {length}\r\n\r\n").encode()
                    put(_record([
                        ("WARC-Type", "response" if refers is None else "revisit"), ("WARC-Record-ID", record_id(rid)),
                        ("WARC-Date", DATE), ("WARC-Target-URI", None if url is None else _SAFE.sub(_escape, url)),
                        ("WARC-Payload-Digest", "sha1:" + base32(bytes.fromhex(sha1))),
                        ("WARC-Profile", None if refers is None else PROFILE),
                        ("WARC-Refers-To", None if refers is None else record_id(refers)),
                        ("Page-ID", None if page is None else str(page)),
                        ("Content-Type", "application/http; msgtype=response")],
                        len(http) + (length if refers is None else 0)) + http)
                buf = cols[7][i].as_buffer()
                for at in range(0, buf.size, BUFFER):
                    put(buf.slice(at, min(BUFFER, buf.size - at)))
        if out is not None:
            end()
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n]), pa.array([size])],
                                             ["archive", "records", "bytes"])
    dealt = chunks.repartition("rid").sortWithinPartitions("rid", "chunk_no")
    return stage(dealt.mapInArrow(write, "archive string, records long, bytes long"), "manifest")


class _Stream:
    """Decompressed bytes of a gzip file of many members, a buffer at a time."""

    def __init__(self, source):
        self.source, self.gz, self.held, self.inside = source, zlib.decompressobj(31), bytearray(), False

    def fill(self) -> bool:
        while True:
            if self.gz.eof:
                rest = self.gz.unused_data
                self.gz, self.inside = zlib.decompressobj(31), False
            else:
                rest = self.gz.unconsumed_tail
            rest = rest or self.source.read(BUFFER)
            if not rest:
                if self.inside:
                    raise ValueError("a WARC archive is cut short")
                return False
            self.inside = True
            if got := self.gz.decompress(rest, BUFFER):
                self.held += got
                return True

    def until(self, mark: bytes, limit: int = 1 << 20) -> bytes | None:
        while (at := self.held.find(mark)) < 0:
            if len(self.held) > limit:
                raise ValueError("a WARC header is too long")
            if not self.fill():
                if self.held:
                    raise ValueError("a WARC archive is cut short")
                return None
        out = bytes(self.held[:at])
        del self.held[:at + len(mark)]
        return out

    def take(self, most: int) -> bytes:
        if not self.held and not self.fill():
            raise ValueError("a WARC archive is cut short")
        out = bytes(self.held[:most])
        del self.held[:most]
        return out


def _fields(head: bytes) -> dict[str, str]:
    pairs = (x.split(":", 1) for x in head.decode().split("\r\n")[1:] if ":" in x)
    return {k.strip().lower(): v.strip() for k, v in pairs}


def read_records(source, keep: bool, chunk: int = CHUNK):
    """Rows (rid, chunk_no, page_id, type, refers, chunk, bytes, digest, last) of one archive."""
    s = _Stream(source)
    while (head := s.until(b"\r\n\r\n")) is not None:
        f = _fields(head)
        left = int(f["content-length"])
        http = s.until(b"\r\n\r\n")
        left -= len(http) + 4
        rid, page = record_number(f["warc-record-id"]), f.get("page-id")
        same = (rid, None if page is None else int(page), f["warc-type"])
        if f["warc-type"] == "revisit":
            yield (*same, record_number(f["warc-refers-to"]), 0, b"", int(_fields(http)["content-length"]),
                   f["warc-payload-digest"].removeprefix("sha1:"), True)
        else:
            sha, size, n = hashlib.sha1(), 0, 0
            while True:
                part = bytearray()
                while left and len(part) < chunk:
                    got = s.take(min(left, chunk - len(part)))
                    sha.update(got)
                    left, size = left - len(got), size + len(got)
                    part += got
                yield (*same, None, n, bytes(part) if keep else b"", size, base32(sha.copy().digest()), not left)
                n += 1
                if not left:
                    break
        if s.until(b"\r\n\r\n"):
            raise ValueError("a WARC record is longer than its header says")


def read_archives(manifest: DataFrame, payload: bool = True, chunk: int = CHUNK) -> DataFrame:
    """The chunk rows of all archives of a manifest.

    (archive, rid, page_id, record_type, refers, chunk_no, chunk, bytes, digest,
    last): ``bytes`` and ``digest`` cover the payload up to this chunk.
    ``chunk`` is empty unless ``payload``.
    """
    names = ["archive", "rid", "page_id", "record_type", "refers", "chunk_no", "chunk", "bytes", "digest", "last"]
    types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.binary(), pa.int64(),
             pa.string(), pa.bool_()]

    def run(batches):
        for b in batches:
            for archive in b.column(0).to_pylist():
                store, path = _open_store(archive)
                rows, weight = [], 0
                with store.open_input_stream(path, compression=None) as source:
                    for r in read_records(source, payload, chunk):
                        rows.append((archive, *r))
                        weight += len(r[5]) + 200
                        if weight > 4 << 20:
                            yield _batch(rows)
                            rows, weight = [], 0
                if rows:
                    yield _batch(rows)

    def _batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
    tasks = manifest.select("archive").repartition(max(1, manifest.count()), "archive")
    return tasks.mapInArrow(run, "archive string, rid long, page_id long, record_type string, refers long, chunk_no int, "
                                 "chunk binary, bytes long, digest string, last boolean")


def archive_query(pages: DataFrame, min_bytes: int = 0, chunk: int = CHUNK) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) as read back from the archives written."""
    manifest = write_archives(plan_chunks(pages, min_bytes, chunk), stage_path(pages.sparkSession, "archives"))
    got = stage(read_archives(manifest, payload=False, chunk=chunk).filter("last").select(
        "rid", "page_id", "bytes", "digest", "record_type", "refers"), "read")
    target = got.filter("record_type = 'response'").select(F.col("rid").alias("refers"), F.col("page_id").alias("refers_to"))
    return got.join(target, "refers", "left").select(
        "page_id", F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type", "refers_to")
