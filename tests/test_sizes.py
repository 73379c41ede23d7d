"""Tasks follow the work: events by rows, ranges of a document by bytes, one task only writes an export."""

import json

from pyspark.sql import functions as F

from checks import workload
from fraudspark.sources import exports, ranges


def test_events_in_few_files_are_spread_by_rows(spark, monkeypatch):
    monkeypatch.setattr(workload, "TASK_ROWS", 100)
    events = spark.range(1_050).select(F.col("id").alias("event_id")).coalesce(1)
    made = workload.spread(events)
    assert made.rdd.getNumPartitions() == 11
    assert sorted(r[0] for r in made.collect()) == list(range(1_050))


def test_small_ranges_share_tasks(monkeypatch):
    many = [("p", a, a + 50_000) for a in range(0, 50_000 * 10_000, 50_000)]
    assert ranges._tasks(many, 4) == 16
    assert ranges._tasks(many[:3], 4) == 3
    monkeypatch.setattr(ranges, "RANGE_BYTES", 1_000_000)
    assert ranges._tasks(many, 4) == 500


def test_a_wrapped_export_keeps_the_order_of_its_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(exports, "_CHUNK_CHARS", 60)
    rows = spark.range(0, 500, 1, 7).select("id", F.concat(F.lit("x\n\""), "id").alias("s"))
    exports.write_wrapped_json(rows, str(tmp_path / "d"), {"a": 1})
    (part,) = (tmp_path / "d").glob("part-*")
    read = json.loads(part.read_text())
    assert read["metadata"] == {"a": 1}
    assert read["transactions"] == [{"id": k, "s": f'x\n"{k}'} for k in range(500)]
    exports.write_wrapped_json(rows.where("id < 0"), str(tmp_path / "e"), {})
    (part,) = (tmp_path / "e").glob("part-*")
    assert json.loads(part.read_text())["transactions"] == []
