"""Publication of micro-batches: records, dead letters and metrics become visible together, once.

A batch is staged: each channel is written to a folder of this attempt, which nobody reads. A
manifest, one small file per (query, batch) that is created by an atomic rename, then publishes all
channels at once. A batch that fails halfway has no manifest, so its replay is staged anew and what
the failed attempt left is never read; a batch that is replayed although its manifest is there (the
stream stopped before its checkpoint) is skipped. Readers see the channels of published batches only.

``compact`` gathers the batches published since the last time into one folder per channel and replaces
their manifests by a snapshot, so the files to read stay few however long the query runs. Readers
take the newest snapshot and the manifests behind it; a manifest that the snapshot covers counts once.
Batches of one query are published in order, so a snapshot needs only the last batch of each query.

The folder may be in any file system of Spark's; where a rename is not atomic, as in some object
stores, only one writer at a time is safe.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from contextlib import suppress

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_QUERY_ID = "sql.streaming.queryId"


class SmallFiles:
    """Small files of a folder, by way of Spark's own file systems."""

    def __init__(self, spark: SparkSession, folder: str):
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self.folder = folder.rstrip("/")
        self.fs = self._path(self.folder).getFileSystem(self.conf)

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def create(self, name: str, text: str) -> bool:
        """Create a file whole or not at all; false if it is there already."""
        options = self.jvm.org.apache.hadoop.fs.Options
        final, draft = self._path(f"{self.folder}/{name}"), self._path(f"{self.folder}/.{uuid.uuid4().hex}")
        out = self.fs.create(draft, False)
        out.write(bytearray(text.encode()))
        out.close()
        self.fs.mkdirs(final.getParent())
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), self.conf)
        none = self.jvm.java.lang.reflect.Array.newInstance(options.Rename.NONE.getClass(), 0)
        try:
            context.rename(draft, final, none)
        except Py4JJavaError as e:
            self.fs.delete(draft, False)
            if "FileAlreadyExists" in str(e.java_exception):
                return False
            raise
        return True

    def read(self, name: str) -> str | None:
        """The text of a file; none if it is gone."""
        try:
            source = self.fs.open(self._path(f"{self.folder}/{name}"))
        except Py4JJavaError as e:
            if "FileNotFound" in str(e.java_exception):
                return None
            raise
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
        finally:
            source.close()

    def names(self, name: str) -> list[str]:
        path = self._path(f"{self.folder}/{name}")
        if not self.fs.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self.fs.listStatus(path))

    def remove(self, name: str) -> None:
        with suppress(Py4JJavaError):
            self.fs.delete(self._path(f"{self.folder}/{name}"), True)


class Publication:
    """A folder of published channels."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._files = SmallFiles(spark, folder)

    # ------------------------------------------------------------ writing

    def publish(self, batch_id: int, channels: Iterable[tuple[str, DataFrame]], query: str | None = None) -> bool:
        """Stage and publish all channels of one batch; false if the batch was published before.

        ``channels`` may be a generator: a channel is computed when its turn comes, and an error in
        any of them leaves the batch unpublished.
        """
        query = query or self.spark.sparkContext.getLocalProperty(_QUERY_ID) or "batch"
        if self.is_published(query, batch_id):
            return False
        staged = f"staged/{query}/{batch_id}-{uuid.uuid4().hex}"
        entries = {}
        for name, df in channels:
            seen = Observation()
            df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(f"{self.folder}/{staged}/{name}")
            entries[name] = {"path": f"{staged}/{name}", "rows": seen.get["rows"], "schema": df.schema.jsonValue()}
        manifest = {"query": query, "batch": batch_id, "channels": entries}
        done = self._files.create(f"published/{query}-{batch_id:020d}.json", json.dumps(manifest))
        if not done:
            self._files.remove(staged)
        return done

    def is_published(self, query: str, batch_id: int) -> bool:
        # The manifest first: it goes only after the snapshot that covers it is there.
        if self._files.read(f"published/{query}-{batch_id:020d}.json") is not None:
            return True
        return batch_id <= self._snapshot()["covered"].get(query, -1)

    # ------------------------------------------------------------ reading

    def _snapshot(self) -> dict:
        for name in reversed(self._files.names("snapshots")):
            text = self._files.read(f"snapshots/{name}")
            if text is not None:
                return json.loads(text)
        return {"number": 0, "covered": {}, "channels": {}}

    def _state(self) -> tuple[dict, list[dict]]:
        """The newest snapshot, and the manifests that it does not cover."""
        while True:
            names = self._files.names("published")
            texts = [self._files.read(f"published/{n}") for n in names]
            snapshot = self._snapshot()
            # A manifest may go while it is listed; its batch is then in a snapshot newer than the list.
            tail = [m for m in (json.loads(t) for t in texts if t) if m["batch"] > snapshot["covered"].get(m["query"], -1)]
            if self._snapshot()["number"] == snapshot["number"]:
                return snapshot, tail

    def _channel(self, name: str, snapshot: dict, tail: list[dict]) -> tuple[list[str], StructType | None]:
        entries = [*snapshot["channels"].get(name, []), *(m["channels"][name] for m in tail if name in m["channels"])]
        schema = StructType.fromJson(entries[-1]["schema"]) if entries else None
        return [f"{self.folder}/{e['path']}" for e in entries if e["rows"]], schema

    def read(self, channel: str, schema: StructType | None = None) -> DataFrame:
        """All rows of a channel in published batches. ``schema`` is needed only before the first one."""
        paths, known = self._channel(channel, *self._state())
        schema = known or schema
        if schema is None:
            raise ValueError(f"nothing is published in {channel}: say its schema")
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def counts(self) -> dict[str, int]:
        """Published rows per channel, from the manifests alone."""
        snapshot, tail = self._state()
        names = {*snapshot["channels"], *(n for m in tail for n in m["channels"])}
        total = {n: sum(e["rows"] for e in snapshot["channels"].get(n, [])) for n in names}
        for m in tail:
            for n, entry in m["channels"].items():
                total[n] += entry["rows"]
        return total

    # ------------------------------------------------------------ upkeep

    def compact(self, tasks: int | None = None) -> int:
        """Gather the batches behind the newest snapshot; the number of batches gathered."""
        snapshot, tail = self._state()
        if not tail:
            return 0
        channels, covered = dict(snapshot["channels"]), dict(snapshot["covered"])
        made = f"gathered/{uuid.uuid4().hex}"
        for name in sorted({n for m in tail for n in m["channels"]}):
            paths, schema = self._channel(name, {"channels": {}}, tail)
            rows = sum(m["channels"][name]["rows"] for m in tail if name in m["channels"])
            entry = {"path": f"{made}/{name}", "rows": rows, "schema": schema.jsonValue()}
            if paths:
                df = self.spark.read.schema(schema).parquet(*paths)
                (df.coalesce(tasks) if tasks else df).write.parquet(f"{self.folder}/{made}/{name}")
            channels[name] = [*channels.get(name, []), entry]
        for m in tail:
            covered[m["query"]] = max(covered.get(m["query"], -1), m["batch"])
        number = snapshot["number"] + 1
        text = json.dumps({"number": number, "covered": covered, "channels": channels})
        if not self._files.create(f"snapshots/{number:020d}.json", text):
            # Someone else gathered the same batches first.
            self._files.remove(made)
            return 0
        for m in tail:
            self._files.remove(f"published/{m['query']}-{m['batch']:020d}.json")
        return len(tail)

    def sweep(self) -> int:
        """Remove staged attempts that no manifest names; only while no query writes here.

        Attempts that a snapshot has gathered go as well. The number of attempts removed.
        """
        _, tail = self._state()
        named = {e["path"].rsplit("/", 1)[0] for m in tail for e in m["channels"].values()}
        gone = 0
        for query in self._files.names("staged"):
            for attempt in self._files.names(f"staged/{query}"):
                if f"staged/{query}/{attempt}" not in named:
                    self._files.remove(f"staged/{query}/{attempt}")
                    gone += 1
        return gone


def publishing(
    publication: Publication, channels: Callable[[DataFrame], Iterable[tuple[str, DataFrame]]]
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that publishes the channels of every micro-batch."""

    def run(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            publication.publish(batch_id, channels(kept))
        finally:
            kept.unpersist()

    return run
