"""Totals over the life of a stream: a snapshot and the batches behind it.

Every micro-batch writes its own rows, one per group: counters, which are added up, and quantile
sketches, which are merged. ``compact`` folds all of them but the newest batch, which may yet be
replayed, into a new snapshot together with the one before, and only then removes them. The snapshot
names the last batch it holds, so a batch counts once whatever is replayed or stopped halfway: rows
of a batch that the snapshot holds are ignored, as is a replay of it. Reading takes one snapshot and
the batches since, not every batch ever written.

One query writes to a folder. Sketches are KLL sketches: quantiles are right up to the rank error
of ``RANK_ERROR``, however many batches were merged.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudspark.config import EngineConfig
from fraudspark.operators import reports
from fraudspark.streaming.publication import SmallFiles

#: Size of a sketch, and the rank error that it keeps with 99 % confidence.
SKETCH_K, RANK_ERROR = 800, 0.0045


class Totals:
    """Counters and sketches per group, in a folder."""

    def __init__(self, spark: SparkSession, folder: str, counters: list[str], sketches: tuple[str, ...] = (), by: str = "provider"):
        self.spark, self.folder, self.by = spark, folder.rstrip("/"), by
        self.counters, self.sketches = counters, sketches
        self._files = SmallFiles(spark, folder)

    def _snapshot(self) -> dict:
        for name in reversed(self._files.names("snapshots")):
            text = self._files.read(f"snapshots/{name}")
            if text is not None:
                return json.loads(text)
        return {"number": 0, "through": -1, "path": None}

    def _tail(self, through: int) -> list[int]:
        """Finished batches behind the snapshot."""
        numbers = [int(n.split("=")[1]) for n in self._files.names("batches")]
        return sorted(n for n in numbers if n > through and "_SUCCESS" in self._files.names(f"batches/batch={n}"))

    def write(self, rows: DataFrame, batch_id: int) -> None:
        """One row per group of a batch; a replay replaces them, or does nothing once they are folded."""
        if batch_id > self._snapshot()["through"]:
            kept = rows.select(self.by, *self.counters, *self.sketches)
            kept.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/batches/batch={batch_id}")

    def _rows(self, snapshot: dict, tail: list[int]) -> DataFrame | None:
        paths = [f"{self.folder}/batches/batch={n}" for n in tail]
        paths += [f"{self.folder}/{snapshot['path']}"] if snapshot["path"] else []
        return self.spark.read.parquet(*paths) if paths else None

    def _folded(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(self.by).agg(
            *[F.sum(c).alias(c) for c in self.counters], *[F.kll_merge_agg_double(s).alias(s) for s in self.sketches]
        )

    def read(self) -> DataFrame | None:
        """One row per group: sums and merged sketches; none before the first batch."""
        snapshot = self._snapshot()
        rows = self._rows(snapshot, self._tail(snapshot["through"]))
        return None if rows is None else self._folded(rows)

    def files(self) -> int:
        """Folders that ``read`` takes rows from."""
        snapshot = self._snapshot()
        return len(self._tail(snapshot["through"])) + (snapshot["path"] is not None)

    def compact(self) -> int:
        """Fold the batches behind the snapshot, without the newest; their number."""
        snapshot = self._snapshot()
        tail = self._tail(snapshot["through"])[:-1]
        if not tail:
            return 0
        path = f"folded/{uuid.uuid4().hex}"
        self._folded(self._rows(snapshot, tail)).coalesce(1).write.parquet(f"{self.folder}/{path}")
        number = snapshot["number"] + 1
        text = json.dumps({"number": number, "through": tail[-1], "path": path})
        if not self._files.create(f"snapshots/{number:020d}.json", text):
            self._files.remove(path)
            return 0
        for n in tail:
            self._files.remove(f"batches/batch={n}")
        return len(tail)


def quantiles(totals: DataFrame, sketch: str, ranks: tuple[float, ...] = (0.5, 0.95, 0.99)) -> DataFrame:
    """Of each group and rank the value, and the number of values seen; groups without values have none."""
    seen = F.kll_sketch_get_n_double(sketch)
    wanted = F.array(*[F.lit(r) for r in ranks])
    # An empty sketch has no quantiles.
    values = F.when(seen > 0, F.kll_sketch_get_quantile_double(sketch, wanted))
    none = F.transform(wanted, lambda r: F.lit(None).cast("double"))
    each = F.explode(F.arrays_zip(wanted.alias("rank"), F.coalesce(values, none).alias("value"))).alias("_q")
    return totals.select(*[c for c in totals.columns if c != sketch], seen.alias("seen"), each).select("*", "_q.*").drop("_q")


def write_life_metrics(totals: Totals, config: EngineConfig = EngineConfig()) -> Callable[[DataFrame, int], None]:
    """A metrics step of ``jobs.start_enrichment``: records, high-risk records and a sketch of the latency.

    ``totals`` has the counters ``records, high_risk`` and the sketch ``latency``.
    """

    def write(df: DataFrame, batch_id: int) -> None:
        sketch = df.groupBy("provider").agg(F.kll_sketch_agg_double(reports.latency_seconds(), SKETCH_K).alias("latency"))
        totals.write(reports.provider_metrics(df, config).join(sketch, "provider"), batch_id)

    return write
