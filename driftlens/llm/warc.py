"""Operator 8: WARC archives as a table of chunks.

Writing streams every payload through a fixed-size window into per-record gzip
members; reading streams the archives back as rows (record_id, chunk) that
carry the payload's running length and SHA-256, so neither side ever holds a
record as a whole. A payload that was met before is written as a revisit of
the record that holds it.

Archives go to the shared folder of ``spark.checkpoint.dir``. A task names its
files after its attempt and returns their paths; the list of paths is
checkpointed and only listed archives are read, so what a lost or repeated
attempt wrote is never seen.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftlens.llm.common import checkpoint
from driftlens.session import ensure_checkpoint_dir

CHUNK = 1 << 16
ARCHIVE_BYTES = 64 << 20
MIN_REVISIT = 100
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _filesystem(uri: str):
    """The file system of a Hadoop path and the path in it."""
    from pyarrow import fs

    local = re.match(r"file:/+(.*)", uri)
    return (fs.LocalFileSystem(), "/" + local[1]) if local else fs.FileSystem.from_uri(uri)


def _uri_text(url: str | None) -> str:
    """A URL fit for a header line: no control or space characters."""
    return "".join(c if " " < c < "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url or "")


def windows(payload: memoryview, size: int = CHUNK) -> Iterator[memoryview]:
    for at in range(0, len(payload), size):
        yield payload[at : at + size]


class Writer:
    """Appends records to archives of about ``archive_bytes`` each."""

    def __init__(self, folder: str, stem: str, archive_bytes: int = ARCHIVE_BYTES):
        self.fs, self.folder = _filesystem(folder)
        self.fs.create_dir(self.folder, recursive=True)
        self.stem, self.limit = stem, archive_bytes
        self.out, self.done, self.number, self.records = None, [], 0, 0

    def add(self, page_id: int | None, url: str | None, payload: memoryview, refers_to: int | None) -> None:
        digest = hashlib.sha256()
        for part in windows(payload):
            digest.update(part)
        revisit = refers_to is not None
        http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
        fields = [
            "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
            "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha256:{digest.hexdigest()}", "Content-Type: application/http; msgtype=response",
            f"Content-Length: {len(http) + (0 if revisit else len(payload))}",
        ]
        if url is not None:
            fields.append(f"WARC-Target-URI: {_uri_text(url)}")
        if revisit:
            fields += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
        if self.out is None:
            self.path = f"{self.folder}/{self.stem}-{self.number:05d}.warc.gz"
            self.out = self.fs.open_output_stream(self.path, compression=None)
            self.number, self.records = self.number + 1, 0
        member = zlib.compressobj(1, zlib.DEFLATED, 31)
        self.out.write(member.compress("\r\n".join(fields).encode() + b"\r\n\r\n" + http))
        if not revisit:
            for part in windows(payload):
                self.out.write(member.compress(part))
        self.out.write(member.compress(b"\r\n\r\n") + member.flush())
        self.records += 1
        if self.out.tell() >= self.limit:
            self.close()

    def close(self) -> None:
        if self.out is not None:
            size = self.out.tell()
            self.out.close()
            self.out = None
            self.done.append((self.path, self.records, size))


class _Members:
    """The bytes of an archive, unpacked as they are read."""

    def __init__(self, raw, size: int):
        self.raw, self.size, self.buffer, self.packed = raw, size, b"", b""
        self.unpack = zlib.decompressobj(31)

    def more(self) -> bool:
        while True:
            if self.unpack.eof:
                self.packed = self.unpack.unused_data or self.packed
                self.unpack = zlib.decompressobj(31)
            if not self.packed:
                self.packed = self.raw.read(self.size)
                if not self.packed:
                    return False
            got = self.unpack.decompress(self.packed, self.size)
            self.packed = b"" if self.unpack.eof else self.unpack.unconsumed_tail
            if got:
                self.buffer += got
                return True

    def head(self, end: bytes = b"\r\n\r\n") -> bytes | None:
        """What stands before the next blank line; None at the archive's end."""
        while (at := self.buffer.find(end)) < 0:
            if not self.more():
                return None
        out, self.buffer = self.buffer[:at], self.buffer[at + len(end) :]
        return out

    def take(self, n: int) -> Iterator[bytes]:
        """The next n bytes in parts of at most the window's size."""
        while n:
            if not self.buffer and not self.more():
                raise ValueError("the archive ends within a record")
            part, self.buffer = self.buffer[: min(n, self.size)], self.buffer[min(n, self.size) :]
            n -= len(part)
            yield part


def read_archive(path: str, chunk: int = CHUNK) -> Iterator[dict]:
    """Rows of one archive, see CHUNKS; every record has at least one row."""
    fs, name = _filesystem("file:" + path if path.startswith("/") else path)
    with fs.open_input_stream(name, compression=None) as raw:
        members = _Members(raw, chunk)
        while (head := members.head()) is not None:
            fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
            http = members.head() or b""
            length = int(fields["Content-Length"]) - len(http) - 4
            kind = fields["WARC-Type"]
            row = {
                "record_id": fields["WARC-Record-ID"].strip("<>"), "record_type": kind, "url": fields.get("WARC-Target-URI"),
                "refers_to": fields["WARC-Refers-To"].strip("<>") if kind == "revisit" else None,
            }
            if kind == "revisit":
                size = re.search(rb"\r\nContent-Length: (\d+)", http)
                yield row | {"chunk": 0, "last": True, "running_bytes": int(size[1]), "running_sha256": fields["WARC-Payload-Digest"].removeprefix("sha256:"), "data": b""}
            else:
                digest, done, number = hashlib.sha256(), 0, 0
                for data in members.take(length) if length else [b""]:
                    digest.update(data)
                    done += len(data)
                    yield row | {"chunk": number, "last": done == length, "running_bytes": done, "running_sha256": digest.hexdigest(), "data": data}
                    number += 1
            members.head()  # the blank lines that end a record


CHUNKS = "record_id string, record_type string, url string, refers_to string, chunk int, last boolean, running_bytes long, running_sha256 string, data binary"


def write(records: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes (page_id, url, html, refers_to) rows; returns the checkpointed
    list of archives: path, records, bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = Writer(folder, f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}", archive_bytes)
        for batch in batches:
            ids, urls, html, refers = (batch.column(c) for c in ("page_id", "url", "payload", "refers_to"))
            for i in range(batch.num_rows):
                writer.add(ids[i].as_py(), urls[i].as_py(), memoryview(html[i].as_buffer()), refers[i].as_py())
        writer.close()
        if writer.done:
            yield pa.RecordBatch.from_pylist([{"path": p, "records": n, "bytes": b} for p, n, b in writer.done])

    rows = records.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"), "refers_to")
    return checkpoint(rows.mapInArrow(run, "path string, records long, bytes long"))


def read(archives: DataFrame, with_data: bool = True, chunk: int = CHUNK) -> DataFrame:
    """The chunk table of listed archives. with_data=False leaves ``data`` empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("record_id", pa.string()), ("record_type", pa.string()), ("url", pa.string()), ("refers_to", pa.string()), ("chunk", pa.int32()), ("last", pa.bool_()), ("running_bytes", pa.int64()), ("running_sha256", pa.string()), ("data", pa.binary())])
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, held = [], 0
                for row in read_archive(path, chunk):
                    held += len(row["data"]) if with_data else 0
                    rows.append(row if with_data else row | {"data": b""})
                    if held > 8 << 20 or len(rows) >= 10_000:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return archives.select("path").mapInArrow(run, CHUNKS)


def revisits(pages: DataFrame, least: int = MIN_REVISIT) -> DataFrame:
    """Adds ``refers_to`` to pages: the smallest page_id with an equal payload
    of at least ``least`` bytes, null for that page itself and for others.

    Only ids and digests meet on the digest, so a payload that many pages share
    costs small rows, which the engine splits; the pages meet them by id.
    """
    payload = F.coalesce("html", F.lit("")).cast("binary")
    marked = pages.select("page_id", "url", "html", F.sha2(payload, 256).alias("sha"), F.octet_length(payload).cast("long").alias("n"))
    small = checkpoint(marked.where(F.col("n") >= least).select("page_id", "sha", "n"))
    groups = small.groupBy("sha", "n").agg(F.min("page_id").alias("first"), F.count("*").alias("copies")).where("copies > 1").drop("copies")
    again = small.join(groups, ["sha", "n"]).where(~F.col("page_id").eqNullSafe(F.col("first"))).select("page_id", F.col("sha").alias("r_sha"), F.col("first").alias("refers_to")).distinct()
    same = marked["page_id"].eqNullSafe(again["page_id"]) & (marked["sha"] == again["r_sha"])
    return marked.join(again, same, "left").select(marked["page_id"], "url", "html", "refers_to")


def round_trip(pages: DataFrame) -> DataFrame:
    """Writes a record per page and reads the archives back: page_id,
    payload_bytes, payload_digest, record_type, refers_to.

    Null html is the empty payload, a null URL leaves its header out, a null
    id is read back as null. Rows that share id and payload are alike: both
    are responses if theirs is the smallest id, and revisits otherwise.
    """
    spark = pages.sparkSession
    folder = f"{ensure_checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"
    chunks = read(write(revisits(pages.select("page_id", "url", "html")), folder), with_data=False)

    def page(c: str):
        return F.regexp_extract(c, r"^urn:page:(-?\d+)$", 1).try_cast("long")

    return chunks.where("last").select(
        page("record_id").alias("page_id"), F.col("running_bytes").alias("payload_bytes"), F.col("running_sha256").alias("payload_digest"),
        "record_type", page("refers_to").alias("refers_to"),
    )


ORACLE = f"""
    WITH p AS (SELECT page_id, coalesce(html, '') AS html, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS n FROM pages),
    f AS (SELECT *, sha256(html) AS sha, min(page_id) OVER (PARTITION BY html) AS first FROM p)
    SELECT page_id, n AS payload_bytes, sha AS payload_digest,
           CASE WHEN n >= {MIN_REVISIT} AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN n >= {MIN_REVISIT} AND first <> page_id THEN first END AS refers_to
    FROM f"""
