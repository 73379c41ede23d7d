"""Large JSON documents read by many tasks: ``{.., "transactions": [{..}, {..}, ..], ..}``.

A document is cut into byte ranges. Whether a range begins within a string, and how deep, depends on
all ranges before it; so a first pass notes of every range, for either beginning, whether its quotes are even
and by how much its brackets change the depth, and running sums over the ranges of a document settle both.
In the second pass a range knows where it stands, finds the records that begin in it, and reads on
past its end to finish the last one. A record belongs to the range that its first byte is in, so each
is read once; a task holds one piece of a range and the record that it is in.

Files are opened by ``pyarrow.fs`` on the executors, so the path must be one that it knows (local,
HDFS with its client library, S3, GCS). Byte order marks and encodings other than UTF-8 are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

RANGE_BYTES, PIECE_BYTES = 64_000_000, 1 << 20
_BATCH_BYTES = 4_000_000
_QUOTE, _BACKSLASH = 34, 92
_STEP = np.zeros(256, np.int8)
_STEP[[ord("{"), ord("[")]], _STEP[[ord("}"), ord("]")]] = 1, -1

# A range seen from either beginning (outside and inside a string): change of depth, lowest depth
# within, and the arrays that follow the wanted key: where, how deep, and the lowest depth after.
_SIDE = "struct<delta:bigint,low:bigint,found:array<struct<at:bigint,depth:bigint,low:bigint>>>"
NOTED = f"path string, start bigint, stop bigint, odd boolean, plain {_SIDE}, quoted {_SIDE}"
_FOUND = pa.list_(pa.struct([("at", pa.int64()), ("depth", pa.int64()), ("low", pa.int64())]))
_SEEN = pa.struct([("delta", pa.int64()), ("low", pa.int64()), ("found", _FOUND)])
_NOTED = pa.schema(
    [("path", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("odd", pa.bool_()), ("plain", _SEEN), ("quoted", _SEEN)]
)
RECORDS = "path string, at bigint, record string"


def _filesystem(uri: str) -> tuple[pa.fs.FileSystem, str]:
    if "://" in uri or uri.startswith("file:"):
        return pa.fs.FileSystem.from_uri(uri)
    return pa.fs.LocalFileSystem(), uri


def _open(uri: str):
    fs, path = _filesystem(uri)
    return fs.open_input_file(path)


def byte_ranges(path: str, range_bytes: int) -> list[tuple[str, int, int]]:
    """Cut every file at the path, a file or a folder, into ranges."""
    fs, inner = _filesystem(path.rstrip("/"))
    info = fs.get_file_info(inner)
    files = [info]
    if info.type == pa.fs.FileType.Directory:
        found = fs.get_file_info(pa.fs.FileSelector(inner, recursive=True))
        files = sorted((f for f in found if f.is_file and f.base_name[:1] not in "._"), key=lambda f: f.path)
    scheme = path.rstrip("/").removesuffix(inner)
    return [(scheme + f.path, a, min(a + range_bytes, f.size)) for f in files for a in range(0, f.size, range_bytes)]


def _unescaped_quotes(data: np.ndarray, escaped: bool) -> tuple[np.ndarray, bool]:
    """Where quotes open or close a string; whether the byte after the piece is escaped."""
    quotes = data == _QUOTE
    slashes = np.flatnonzero(data == _BACKSLASH)
    if escaped and len(data):
        # The first byte is escaped: it neither quotes nor escapes.
        quotes[0] = False
        slashes = slashes[slashes > 0]
    if not len(slashes):
        return quotes, False
    new = np.append(True, np.diff(slashes) != 1)
    begin = slashes[new]
    length = np.diff(np.append(np.flatnonzero(new), len(slashes)))
    after = (begin + length)[length % 2 == 1]
    quotes[after[after < len(data)]] = False
    return quotes, bool(len(after) and after[-1] == len(data))


class _Cursor:
    """Pieces of a file from a position on, with the depth after each byte."""

    def __init__(self, source, at: int, inside: bool, depth: int):
        self.source, self.at, self.inside, self.depth = source, at, inside, depth
        self.escaped = False

    def next(self, stop: int) -> tuple[bytes, np.ndarray, np.ndarray] | None:
        """The next piece before ``stop``: its bytes, brackets that count, and the depth after each byte."""
        data = self.source.read_at(max(0, min(PIECE_BYTES, stop - self.at)), self.at)
        if not data:
            return None
        array = np.frombuffer(data, np.uint8)
        quotes, self.escaped = _unescaped_quotes(array, self.escaped)
        inside = (np.cumsum(quotes) + self.inside) % 2 == 1
        step = np.where(inside, 0, _STEP[array]).astype(np.int64)
        depth = np.cumsum(step) + self.depth
        self.at, self.inside, self.depth = self.at + len(data), bool(inside[-1]), int(depth[-1])
        return data, step, depth


def _settled_start(source, start: int) -> int:
    """The range's first byte that no backslash stands before; neighbours agree on it."""
    while start:
        before = source.read_at(1, start - 1)
        if before != b"\\":
            return start
        start += 1
    return start


def _note(path: str, start: int, stop: int, key: bytes) -> dict:
    """What a range tells without knowing what comes before it."""
    with _open(path) as source:
        begin, end = _settled_start(source, start), _settled_start(source, stop)
        # Of the bytes before an array, so many are looked at for its key.
        reach = len(key) + 64
        ahead = source.read_at(min(reach, begin), begin - min(reach, begin))
        sides = {}
        for name, inside in (("plain", False), ("quoted", True)):
            cursor = _Cursor(source, begin, inside, 0)
            low, found, tail = 0, [], ahead
            while (piece := cursor.next(end)) is not None:
                data, step, depth = piece
                least = int(depth.min())
                low = min(low, least)
                for f in found:
                    f["low"] = min(f["low"], least)
                base = cursor.at - len(data)
                for k in np.flatnonzero((step == 1) & (np.frombuffer(data, np.uint8) == ord("["))):
                    before = (tail[-reach:] + data[max(0, int(k) - reach) : int(k)]).rstrip()
                    own = before[:-1].rstrip() if before.endswith(b":") else b""
                    if own.endswith(key) and not own.endswith(b"\\" + key):
                        found.append({"at": base + int(k), "depth": int(depth[k]), "low": int(depth[k:].min())})
                tail = (tail + data)[-reach:]
            sides[name] = {"delta": cursor.depth, "low": low, "found": found}
        odd = cursor.inside is False
    return {"path": path, "start": begin, "stop": end, "odd": odd, **sides}


def _records(path: str, start: int, stop: int, inside: bool, depth: int, begin: int) -> Iterator[tuple[int, bytes]]:
    """Records that begin in the range, behind ``begin``, while the wanted array is open."""
    with _open(path) as source:
        size = source.size()
        cursor, open_at, held = _Cursor(source, start, inside, depth), None, b""
        while True:
            limit = stop if open_at is None and cursor.at < stop else size if open_at is not None else stop
            if cursor.at >= stop and open_at is None:
                return
            piece = cursor.next(limit)
            if piece is None:
                return
            data, step, depths = piece
            base = cursor.at - len(data)
            marks = np.flatnonzero(((step == 1) & (depths == 3)) | ((step == -1) & (depths <= 2)))
            done = 0
            for k in marks.tolist():
                at = base + k
                if open_at is None and step[k] == 1 and data[k] == ord("{") and begin < at < stop:
                    open_at, held, done = at, b"", k
                elif open_at is not None and step[k] == -1 and depths[k] == 2:
                    yield open_at, held + data[done : k + 1]
                    open_at, held = None, b""
                elif depths[k] < 2 and at > begin:
                    return
                if open_at is None and at >= stop:
                    return
            if open_at is not None:
                held += data[done:]


def _tasks(ranges: list[tuple[str, int, int]], cores: int) -> int:
    """Four tasks a core, or one for every 64 MB if that is more; never more than ranges."""
    size = sum(stop - start for _, start, stop in ranges)
    return min(len(ranges), max(4 * cores, -(-size // RANGE_BYTES)))


def read_records(
    spark: SparkSession, path: str, field: str = "transactions", range_bytes: int = RANGE_BYTES
) -> DataFrame:
    """``path, at, record``: the objects of the array ``field`` of each document, as JSON text."""
    ranges = byte_ranges(path, range_bytes)
    key = f'"{field}"'.encode()
    if not ranges:
        return spark.createDataFrame([], RECORDS)
    # Small ranges share tasks, so that the tasks grow with the bytes and not with the number of cuts.
    n_tasks = _tasks(ranges, spark.sparkContext.defaultParallelism)
    listed = spark.createDataFrame(ranges, "path string, start bigint, stop bigint").repartition(n_tasks)

    def note(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                yield pa.RecordBatch.from_pylist([_note(r["path"], r["start"], r["stop"], key)], _NOTED)

    noted = listed.mapInArrow(note, NOTED)
    line = Window.partitionBy("path").orderBy("start")
    before = line.rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum(F.col("odd").cast("int")).over(before), F.lit(0)) % 2 == 1
    side = F.when(F.col("inside"), F.col("quoted")).otherwise(F.col("plain"))
    placed = noted.withColumn("inside", inside).withColumn("own", side)
    placed = placed.withColumn("depth", F.coalesce(F.sum("own.delta").over(before), F.lit(0)).cast("bigint"))
    # The first array behind the key at the top level of the document, and where it has ended.
    top = F.filter("own.found", lambda f: f["depth"] + F.col("depth") == 2)
    placed = placed.withColumn("first", F.try_element_at(top, F.lit(1)))
    opened = F.min("first.at").over(Window.partitionBy("path"))
    placed = placed.withColumn("begin", opened).where(F.col("begin").isNotNull() & (F.col("stop") > F.col("begin")))
    holds = F.col("begin") >= F.col("start")
    lowest = F.when(holds, F.col("first.low")).otherwise(F.col("own.low")) + F.col("depth")
    placed = placed.withColumn("ended", F.coalesce(F.min(lowest).over(before) < 2, F.lit(False))).where("NOT ended")
    tasks = placed.select("path", "start", "stop", "inside", "depth", "begin").repartition(n_tasks)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                at, texts, size = [], [], 0
                for where, text in _records(r["path"], r["start"], r["stop"], r["inside"], r["depth"], r["begin"]):
                    at.append(where)
                    texts.append(text.decode("utf-8", "replace"))
                    size += len(text)
                    if size >= _BATCH_BYTES:
                        yield pa.RecordBatch.from_pydict({"path": [r["path"]] * len(at), "at": at, "record": texts})
                        at, texts, size = [], [], 0
                if at:
                    yield pa.RecordBatch.from_pydict({"path": [r["path"]] * len(at), "at": at, "record": texts})

    return tasks.mapInArrow(cut, RECORDS)


def read_wrapped(
    spark: SparkSession, path: str, schema: T.StructType, field: str = "transactions", range_bytes: int = RANGE_BYTES
) -> DataFrame:
    """The records as a table; a record that is not of the schema has nulls in its place."""
    records = read_records(spark, path, field, range_bytes)
    return records.select(F.from_json("record", schema).alias("r")).select("r.*")
