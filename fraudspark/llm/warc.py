"""WARC archives of pages: written and read as tables of payload chunks.

``chunked`` turns pages into rows of record, chunk number and at most ``CHUNK_BYTES`` of payload. As
the chunks stream through, a SHA-1 goes along: every row carries the digest of the payload up to its
end, so the last one's is the payload's. The table is written once to the shared folder.

``decided`` compares the digests of that table, without reading payloads: of equal payloads of at
least ``least_bytes`` the record with the largest page id is a response, the others revisit it.
Groups are counted before the shuffle, and the few very large ones are broadcast.

``write_archives`` sends decisions and chunks to the tasks that write: a decision sorts in front of
its record's chunks, so a task writes header, then chunk by chunk, and holds one chunk of payload. An
archive is a series of gzip members, one per record. A revisit has no payload; its length is in the
HTTP header. Tasks name their files by attempt, and only files that a finished task reports are in
the manifest, so a task that is lost or run twice leaves no record behind.

``read_chunks`` and ``read_records`` stream the archives of a manifest back, one task per archive,
and compute the digests anew.

Defined cases: a null payload is empty; all rows that share the largest page id of their payload are
responses; rows without page id revisit a row that has one, and are responses if none has. Repeated
rows are records of their own. Null urls have no target header; in urls, characters that a header
can't hold are percent-encoded. Columns other than ``page_id, url, html`` are not read.
"""

from __future__ import annotations

import base64
import hashlib
import math
import urllib.parse
import uuid
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudspark.llm import shared

CHUNK_BYTES = 256 * 1024
#: Payload per archive; a record is never cut, so an archive may be longer by one record.
ARCHIVE_BYTES = 32_000_000
#: Rows or bytes of payload after which a task hands a batch on.
_BATCH_ROWS, _BATCH_BYTES = 4096, 4_000_000
_READ_BYTES = 1 << 20

CHUNKS = "record bigint, chunk int, last boolean, page_id bigint, url string, bytes bigint, data binary, digest string"
MANIFEST = "archive string, records bigint, bytes bigint"
READ = (
    "archive string, number bigint, record_id string, record_type string, page_id bigint, refers_to_record string, "
    "refers_to bigint, url string, payload_bytes bigint, payload_digest string, intact boolean, "
    "chunk int, last boolean, data binary"
)
# Names and marks of the format.
VERSION, PROFILE = "WARC/1.1", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_END = b"\r\n\r\n"


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def _batched(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows as batches of bounded size."""
    held: list[dict] = []
    size = 0
    for row in rows:
        held.append(row)
        size += len(row.get("data") or b"")
        if len(held) >= _BATCH_ROWS or size >= _BATCH_BYTES:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """One row at a time; only a row's own payload is copied out of its batch."""
    for batch in batches:
        names = batch.schema.names
        for k in range(batch.num_rows):
            yield {n: batch.column(i)[k].as_py() for i, n in enumerate(names)}


# ---------------------------------------------------------------- chunks


_CHUNK_SCHEMA = pa.schema(
    [("record", pa.int64()), ("chunk", pa.int32()), ("last", pa.bool_()), ("page_id", pa.int64()), ("url", pa.string()),
     ("bytes", pa.int64()), ("data", pa.binary()), ("digest", pa.string())]
)


def chunked(pages: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The chunk table of the pages, not yet written: ``CHUNKS``."""
    payload = F.coalesce(F.col("html").cast("binary"), F.lit("").cast("binary"))
    records = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload")
    ).withColumns({"record": F.monotonically_increasing_id(), "bytes": F.octet_length("payload").cast("bigint")})
    final = F.greatest(F.lit(0), F.floor((F.col("bytes") - 1) / chunk_bytes)).cast("int")
    chunks = records.withColumn("final", final).select(
        "*", F.explode(F.sequence(F.lit(0), F.col("final"))).alias("chunk")
    )
    piece = F.substring("payload", F.col("chunk") * chunk_bytes + 1, F.lit(chunk_bytes))
    rows = chunks.select(
        "record", "chunk", (F.col("chunk") == F.col("final")).alias("last"), "page_id", "url", "bytes", piece.alias("data")
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The chunks of a record come one after another, out of one input row.
        def digested() -> Iterator[dict]:
            for row in _rows(batches):
                if row["chunk"] == 0:
                    running = hashlib.sha1()
                running.update(row["data"])
                yield row | {"digest": base32(running.digest())}

        yield from _batched(digested(), _CHUNK_SCHEMA)

    return rows.mapInArrow(work, CHUNKS)


def decided(chunks: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Per record of a stored chunk table: type, and the record and page that a revisit refers to."""
    records = chunks.where("last").select("record", "page_id", "url", "bytes", "digest")
    groups = shared.stored(
        records.where(F.col("bytes") >= least_bytes)
        .groupBy(F.col("digest").alias("shared"))
        .agg(F.max(F.struct("page_id", "record")).alias("first"), F.count(F.lit(1)).alias("n")),
        "payloads",
    )
    known = records.withColumn("shared", F.when(F.col("bytes") >= least_bytes, F.col("digest")))
    joined = shared.attach(known, groups, "shared", "n")
    first = F.col("first")
    # Null where the group is of one record, is small, or has no page id at all.
    revisit = F.coalesce(first["page_id"].isNotNull() & ~first["page_id"].eqNullSafe(F.col("page_id")), F.lit(False))
    return joined.select(
        "record", "page_id", "url", "bytes", "digest",
        F.when(revisit, "revisit").otherwise("response").alias("type"),
        F.when(revisit, first["record"]).alias("of_record"),
        F.when(revisit, first["page_id"]).alias("of_page"),
    )


# ---------------------------------------------------------------- writing


def _filesystem(uri: str) -> tuple[pa.fs.FileSystem, str]:
    if "://" in uri or uri.startswith("file:"):
        return pa.fs.FileSystem.from_uri(uri)
    return pa.fs.LocalFileSystem(), uri


def _name(run: str, record: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{run}:{record}')}>"


def _head(row: dict, run: str, date: str) -> bytes:
    """The record header and the HTTP header of a record."""
    http = (
        f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['bytes']}\r\n\r\n"
    ).encode()
    revisit = row["type"] == "revisit"
    fields = [
        ("WARC-Type", row["type"]),
        ("WARC-Record-ID", _name(run, row["record"])),
        ("WARC-Date", date),
        ("WARC-Target-URI", None if row["url"] is None else urllib.parse.quote(row["url"], safe="!#$%&'()*+,/:;=?@[]~")),
        ("WARC-Payload-Digest", f"sha1:{row['digest']}"),
        ("WARC-Profile", PROFILE if revisit else None),
        ("WARC-Refers-To", _name(run, row["of_record"]) if revisit else None),
        ("X-Refers-To-Page-ID", row["of_page"] if revisit else None),
        ("X-Page-ID", row["page_id"]),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", len(http) + (0 if revisit else row["bytes"])),
    ]
    return (VERSION + "".join(f"\r\n{k}: {v}" for k, v in fields if v is not None)).encode() + _END + http


class _Archive:
    """One archive file that is being written."""

    def __init__(self, uri: str):
        fs, path = _filesystem(uri)
        fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
        self.uri, self.out = uri, fs.open_output_stream(path, compression=None)
        self.records = self.bytes = self.payload = 0
        self.member = None

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.bytes += len(data)

    def begin(self, head: bytes) -> None:
        self.member = zlib.compressobj(1, zlib.DEFLATED, 31)
        self._put(self.member.compress(head))

    def add(self, data: bytes) -> None:
        self._put(self.member.compress(data))
        self.payload += len(data)

    def end(self) -> None:
        self._put(self.member.compress(_END) + self.member.flush())
        self.records, self.member = self.records + 1, None

    def close(self) -> dict:
        self.out.close()
        return {"archive": self.uri, "records": self.records, "bytes": self.bytes}


def write_archives(
    chunks: DataFrame, decisions: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES, date: str | None = None
) -> DataFrame:
    """Write every record of a stored chunk table; the result is the manifest, itself stored."""
    run, date = uuid.uuid4().hex, date or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    total = decisions.where("type = 'response'").agg(F.sum("bytes").alias("n")).first()["n"] or 0
    tasks = max(1, math.ceil(total / archive_bytes))
    nothing = F.lit(None)
    ahead = decisions.withColumns({"chunk": F.lit(-1), "last": nothing.cast("boolean"), "data": nothing.cast("binary")})
    behind = chunks.select("record", "chunk", "last", "data")
    rows = (
        ahead.unionByName(behind, allowMissingColumns=True)
        .repartition(tasks, "record")
        .sortWithinPartitions("record", "chunk")
    )
    schema = pa.schema([("archive", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt, at, done = TaskContext.get().taskAttemptId(), None, []
        for row in _rows(batches):
            if row["chunk"] < 0:
                if at is None or at.payload >= archive_bytes:
                    done += [at.close()] if at else []
                    at = _Archive(f"{folder.rstrip('/')}/{run}-{attempt}-{len(done)}.warc.gz")
                skip = row["type"] == "revisit"
                at.begin(_head(row, run, date))
                if skip:
                    at.end()
            elif not skip:
                at.add(row["data"])
                if row["last"]:
                    at.end()
        done += [at.close()] if at else []
        yield pa.RecordBatch.from_pylist(done, schema)

    return shared.stored(rows.mapInArrow(work, MANIFEST), "manifest")


# ---------------------------------------------------------------- reading


class _Stream:
    """Uncompressed bytes of an archive, as many as are asked for."""

    def __init__(self, uri: str):
        fs, path = _filesystem(uri)
        self.file = fs.open_input_stream(path, compression=None)
        self.member, self.tail, self.ahead = zlib.decompressobj(31), b"", b""

    def _more(self) -> bool:
        """Get some bytes more; false at the end."""
        while True:
            if self.member.eof:
                self.tail, self.member = self.member.unused_data or self.tail, zlib.decompressobj(31)
            data = self.tail or self.file.read(_READ_BYTES)
            if not data:
                return False
            made = self.member.decompress(data, _READ_BYTES)
            self.tail = self.member.unconsumed_tail
            if made:
                self.ahead += made
                return True

    def until(self, mark: bytes) -> bytes | None:
        """What stands before the mark, which is passed; none at the end."""
        seen = 0
        while (at := self.ahead.find(mark, seen)) < 0:
            seen = max(0, len(self.ahead) - len(mark) + 1)
            if not self._more():
                if self.ahead:
                    raise ValueError("the archive ends within a record")
                return None
        out, self.ahead = self.ahead[:at], self.ahead[at + len(mark) :]
        return out

    def pieces(self, n: int, most: int) -> Iterator[bytes]:
        """The next n bytes, in pieces of the given size; one empty piece for none."""
        if n == 0:
            yield b""
        while n:
            size = min(n, most)
            while len(self.ahead) < size:
                if not self._more():
                    raise ValueError("the archive ends within a record")
            out, self.ahead = self.ahead[:size], self.ahead[size:]
            n -= size
            yield out


def _fields(head: bytes) -> dict[str, str]:
    pairs = (line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    return {k.lower(): v for k, v in pairs}


def _number(text: str | None) -> int | None:
    return None if text is None else int(text)


def _read(uri: str, payloads: bool, chunk_bytes: int) -> Iterator[dict]:
    """Chunk rows of one archive, or only the last one of each record and without its payload."""
    stream, number = _Stream(uri), 0
    while (head := stream.until(_END)) is not None:
        fields = _fields(head)
        http = stream.until(_END) or b""
        rest = int(fields["content-length"]) - len(http) - len(_END)
        told = fields["warc-payload-digest"].removeprefix("sha1:")
        revisit = fields["warc-type"] == "revisit"
        size = int(_fields(http)["content-length"])
        row = {
            "archive": uri, "number": number, "record_id": fields["warc-record-id"], "record_type": fields["warc-type"],
            "page_id": _number(fields.get("x-page-id")), "refers_to_record": fields.get("warc-refers-to"),
            "refers_to": _number(fields.get("x-refers-to-page-id")), "url": fields.get("warc-target-uri"),
            "payload_bytes": size if revisit else rest,
        }
        running, left = hashlib.sha1(), rest
        for chunk, data in enumerate(stream.pieces(rest, chunk_bytes)):
            running.update(data)
            left -= len(data)
            digest, last = base32(running.digest()), not left
            if payloads or last:
                yield row | {
                    "chunk": chunk, "last": last, "data": data if payloads and not revisit else None,
                    "payload_digest": told if revisit else digest,
                    "intact": (told == digest and size == rest) if last and not revisit else None,
                }
        if stream.until(_END) != b"":
            raise ValueError(f"a record of {uri} is longer than its header says")
        number += 1


_READ_SCHEMA = pa.schema(
    [("archive", pa.string()), ("number", pa.int64()), ("record_id", pa.string()), ("record_type", pa.string()),
     ("page_id", pa.int64()), ("refers_to_record", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()),
     ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("intact", pa.bool_()),
     ("chunk", pa.int32()), ("last", pa.bool_()), ("data", pa.binary())]
)


def _scan(manifest: DataFrame, payloads: bool, chunk_bytes: int) -> DataFrame:
    names = manifest.select("archive")
    n = max(1, names.count())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch["archive"].to_pylist():
                yield from _batched(_read(uri, payloads, chunk_bytes), _READ_SCHEMA)

    return names.repartition(n).mapInArrow(work, READ)


def read_chunks(manifest: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Payload rows of the archives: per record its chunks in order, each with the digest so far."""
    return _scan(manifest, True, chunk_bytes)


def read_records(manifest: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per record; ``intact`` tells whether a response's payload is as long as, and has the
    digest that, its headers say."""
    return _scan(manifest, False, chunk_bytes).drop("chunk", "last", "data")


def archive(pages: DataFrame, least_bytes: int = 0, chunk_bytes: int = CHUNK_BYTES, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write all pages to archives in the shared folder; the result is the manifest."""
    chunks = shared.stored(chunked(pages, chunk_bytes), "warc-chunks", "zstd")
    decisions = shared.stored(decided(chunks, least_bytes), "warc-records", "zstd")
    return write_archives(chunks, decisions, shared.scratch(pages.sparkSession, "warc"), archive_bytes)


def digest(manifest: DataFrame) -> DataFrame:
    return read_records(manifest).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact"
    )


_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
d AS (SELECT page_id, strlen(t) AS payload_bytes, sha1(t) AS h, max(page_id) OVER (PARTITION BY t) AS keep FROM p)
SELECT page_id, payload_bytes,
       list_aggregate(list_transform(range(32), lambda k: substr('{_ALPHABET}', 1 + CAST(
           (CAST('0x' || substr(h, CAST(1 + 5 * (k // 4) AS INTEGER), 5) AS BIGINT) >> CAST(15 - 5 * (k % 4) AS INTEGER)) & 31 AS INTEGER), 1)),
           'string_agg', '') AS payload_digest,
       CASE WHEN keep <> page_id OR (keep IS NOT NULL AND page_id IS NULL) THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN keep <> page_id OR (keep IS NOT NULL AND page_id IS NULL) THEN keep END AS refers_to,
       CASE WHEN NOT (keep <> page_id OR (keep IS NOT NULL AND page_id IS NULL)) OR keep IS NULL THEN true END AS intact
FROM d"""
