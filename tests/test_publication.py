"""Channels of a batch become visible together and once, whatever fails."""

import json

import pytest
from pyspark.sql import functions as F

from fraudspark import schemas
from fraudspark.config import EngineConfig
from fraudspark.plans import jobs
from fraudspark.sources import refdata, wire
from fraudspark.streaming import sinks
from fraudspark.streaming.publication import Publication, publishing
from tests.test_streams import message, row, source, write_batches


def ids(df):
    return sorted(r[0] for r in df.select("transaction_id").collect())


def test_a_sink_that_fails_halfway_is_replayed_and_yields_every_record_once(spark, tmp_path):
    write_batches(spark, [[row(1, 0), row(2, 1)], [row(3, 2)], [row(4, 3)]], tmp_path / "in")
    out = Publication(spark, str(tmp_path / "out"))
    failures = [1, 2]

    def channels(batch):
        yield "records", batch.where("transaction_id <> 't0003'").select("transaction_id", "amount")
        yield "dead_letters", batch.where("transaction_id = 't0003'").select("transaction_id")
        if failures and batch.where("transaction_id IN ('t0003', 't0004')").count():
            failures.pop()
            raise RuntimeError("sink is down")
        yield "metrics", batch.agg(F.count(F.lit(1)).alias("records"))

    for attempt in range(3):
        q = sinks.start(source(spark, tmp_path / "in"), publishing(out, channels), str(tmp_path / "ck"))
        if attempt < 2:
            with pytest.raises(Exception, match="sink is down"):
                q.awaitTermination()
            # Of the batch that failed nothing can be seen, though two channels were written.
            assert ids(out.read("records")) == ["t0001", "t0002"] and out.counts()["dead_letters"] == 0
        else:
            q.awaitTermination()
    assert ids(out.read("records")) == ["t0001", "t0002", "t0004"] and ids(out.read("dead_letters")) == ["t0003"]
    assert out.counts() == {"records": 3, "dead_letters": 1, "metrics": 3}
    assert out.read("metrics").agg(F.sum("records")).first()[0] == 4
    assert out.sweep() == 2 and ids(out.read("records")) == ["t0001", "t0002", "t0004"]


def test_a_published_batch_is_not_published_again(spark, tmp_path):
    out = Publication(spark, str(tmp_path))
    one = spark.createDataFrame([("a",)], "transaction_id string")
    assert out.publish(0, [("records", one)], "q") and not out.publish(0, [("records", one)], "q")
    assert out.publish(0, [("records", one)], "another query")
    # Two attempts at once: the first manifest wins, the other attempt leaves nothing.
    def late():
        yield "records", one
        assert Publication(spark, str(tmp_path)).publish(1, [("records", one.union(one))], "q")

    assert not out.publish(1, late(), "q")
    assert out.counts() == {"records": 4} and out.read("records").count() == 4 and out.sweep() == 0


def test_compaction_keeps_rows_and_remembers_batches(spark, tmp_path):
    out = Publication(spark, str(tmp_path))
    def frame(n):
        return spark.createDataFrame([(f"t{n}",)], "transaction_id string")
    for n in range(5):
        out.publish(n, [("records", frame(n)), ("metrics", frame(n).limit(0))], "q")
    before = ids(out.read("records"))
    manifests = list((tmp_path / "published").iterdir())
    assert out.compact(tasks=1) == 5 and out.compact() == 0
    assert ids(out.read("records")) == before and not [p for p in (tmp_path / "published").iterdir() if p.suffix == ".json"]
    assert len(out.read("records").inputFiles()) == 1 and out.read("metrics").count() == 0
    # A replay during or after compaction changes nothing, even if an old manifest is still there.
    assert not out.publish(3, [("records", frame(3))], "q")
    manifests[0].parent.joinpath("q-00000000000000000002.json").write_text(
        json.dumps({"query": "q", "batch": 2, "channels": {"records": {"path": "nowhere", "rows": 9, "schema": frame(0).schema.jsonValue()}}})
    )
    assert out.counts()["records"] == 5 and ids(out.read("records")) == before
    out.publish(5, [("records", frame(5))], "q")
    assert out.compact() == 1 and ids(out.read("records")) == [*before, "t5"] and out.sweep() == 6


def test_nothing_published(spark, tmp_path):
    out = Publication(spark, str(tmp_path))
    assert out.counts() == {} and out.compact() == 0 and out.sweep() == 0
    with pytest.raises(ValueError):
        out.read("records")
    assert out.read("records", spark.createDataFrame([], "a int").schema).count() == 0


def test_the_jobs_publish_together(spark, tmp_path):
    config = EngineConfig()
    raw = [message(i, i * 0.1) for i in range(6)] + [message(90, 1, pan="1"), message(91, 300)]
    spark.createDataFrame(raw, schemas.WIRE).write.parquet(str(tmp_path / "raw"))
    first, second = Publication(spark, str(tmp_path / "one")), Publication(spark, str(tmp_path / "two"))
    jobs.publish_tokenised(
        wire.read_stream(spark, "parquet", {}, str(tmp_path / "raw")), b"key", first, str(tmp_path / "ck1"), config
    ).awaitTermination()
    assert first.counts() == {"records": 7, "dead_letters": 1, "metrics": 1}
    records = first.read("records").select(
        F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"), "topic",
        F.lit(0).alias("partition"), F.lit(0).cast("bigint").alias("offset"), F.current_timestamp().alias("timestamp"),
    )
    records.coalesce(1).write.parquet(str(tmp_path / "wire"))
    jobs.publish_enriched(
        wire.read_stream(spark, "parquet", {}, str(tmp_path / "wire")), refdata.ReferenceTables(spark), second,
        str(tmp_path / "ck2"), config, immediate=True,
    ).awaitTermination()
    assert second.counts()["records"] == 7 and second.counts()["dead_letters"] == 0
    scored = [json.loads(r.value) for r in second.read("records").collect()]
    assert sorted(s["transaction_id"] for s in scored) == [f"t{i}" for i in range(6)] + ["t91"]
    assert second.read("metrics").where("provider = 'VISA'").first()["records"] == 7
