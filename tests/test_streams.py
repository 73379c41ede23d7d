"""Streams against the table form: several micro-batches, late rows, restarts, whole jobs."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from fraudspark import schemas
from fraudspark.config import VISA, EngineConfig
from fraudspark.operators import reports, state, velocity
from fraudspark.plans import jobs
from fraudspark.sources import exports, refdata, wire
from fraudspark.streaming import sinks
from fraudspark.streaming import state as stream_state
from fraudspark.streaming.velocity import stream_velocity

START = dt.datetime(2024, 3, 1, tzinfo=dt.timezone.utc)
DDL = """transaction_id string, card_token string, merchant_id string, customer_id string,
device_fingerprint string, event_timestamp timestamp, amount double"""
ONE_FILE = {"maxFilesPerTrigger": "1"}


def row(i, minute, card="busy", merchant="m", device="d", amount=1.0):
    at = START + dt.timedelta(minutes=minute)
    return (f"t{i:04d}", card, merchant, card, device, at, amount)


@pytest.fixture(scope="module")
def batches():
    rng, out, i = random.Random(3), [], 0
    for hour in range(3):
        part = []
        for _ in range(60):
            card = None if i % 20 == 0 else rng.choice(["busy", "busy", "a", "b"])
            device = None if i % 15 == 0 else f"d{rng.randrange(3)}"
            merchant = None if i % 25 == 0 else rng.choice(["m", "n"])
            part.append(row(i, hour * 60 + rng.randrange(3000) / 60, card, merchant, device, rng.randrange(1, 999) / 10))
            i += 1
        out.append(part)
    out.append([row(9000, 400), row(9001, 401)])
    return out


def write_batches(spark, batches, path):
    for n, part in enumerate(batches):
        df = spark.createDataFrame(part, DDL).coalesce(1)
        df.write.mode("append").parquet(f"{path}/b={n}")


def source(spark, path):
    schema = spark.createDataFrame([], DDL).schema
    return spark.readStream.schema(schema).options(**ONE_FILE).parquet(f"{path}/b=*")


def drain(stream, out, checkpoint):
    q = (
        stream.writeStream.format("parquet").option("path", str(out)).option("checkpointLocation", str(checkpoint))
        .trigger(availableNow=True).start()
    )
    q.awaitTermination()
    return q


MEASURES = [n for w in (*EngineConfig().card_windows, *EngineConfig().merchant_windows)
            for n in (w.count, w.total, w.mean, w.largest) if n]


def rounded(df):
    cols = [F.round(m, 4).alias(m) if "count" not in m else F.col(m) for m in MEASURES]
    return {r[0]: tuple(r[1:]) for r in df.select("transaction_id", *cols).collect()}


def test_stream_velocity_equals_tables(spark, batches, tmp_path):
    write_batches(spark, batches, tmp_path / "in")
    out = tmp_path / "out"
    drain(stream_velocity(source(spark, tmp_path / "in")).drop("window"), out, tmp_path / "ck")
    everything = spark.createDataFrame([r for b in batches for r in b], DDL)
    expected = rounded(velocity.velocity(everything))
    got = rounded(spark.read.parquet(str(out)))
    # The last hour is still open; every other transaction is there, once, with the table's values.
    assert set(got) == {r[0] for b in batches[:-1] for r in b}
    assert got == {k: expected[k] for k in got}


def test_stream_drops_rows_later_than_the_watermark(spark, tmp_path):
    # Spark judges lateness by the watermark of one batch earlier, so the late row comes two later.
    parts = [[row(1, 10)], [row(2, 200)], [row(4, 400)], [row(3, 11)], [row(5, 600)]]
    write_batches(spark, parts, tmp_path / "in")
    drain(stream_velocity(source(spark, tmp_path / "in")).drop("window"), tmp_path / "out", tmp_path / "ck")
    got = {r.transaction_id: r.card_txn_count_1hr for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert "t0003" not in got
    assert got["t0001"] == 1 and got["t0002"] == 1 and got["t0004"] == 1


def test_trailing_counts_survive_a_time_from_the_future(spark, tmp_path):
    parts = [[row(1, 0.0), row(2, 0.1), row(3, 90_000_000)], [row(4, 0.2), row(5, 0.3)]]
    write_batches(spark, parts, tmp_path / "in")
    counted = stream_state.stream_trailing_count(source(spark, tmp_path / "in"))
    drain(counted.select("transaction_id", "card_txn_count_trailing"), tmp_path / "out", tmp_path / "ck")
    got = {r[0]: r[1] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {"t0001": 1, "t0002": 2, "t0003": 1, "t0004": 3, "t0005": 4}


def test_stream_history_survives_a_restart(spark, batches, tmp_path):
    everything = [r for b in batches for r in b]
    config = EngineConfig(device_ttl_us=50 * 60_000_000)
    ordered = sorted(everything, key=lambda r: (r[5], r[0]))
    halves = [ordered[:100], ordered[100:]]

    def run():
        flagged = stream_state.stream_device_history(source(spark, tmp_path / "in"), config)
        drain(flagged.select("transaction_id", "device_seen_before"), tmp_path / "out", tmp_path / "ck")

    write_batches(spark, halves[:1], tmp_path / "in")
    run()
    spark.createDataFrame(halves[1], DDL).coalesce(1).write.parquet(f"{tmp_path}/in/b=9")
    run()
    got = {r[0]: r[1] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    table = state.device_history(spark.createDataFrame(everything, DDL), config)
    assert got == {r[0]: r[1] for r in table.select("transaction_id", "device_seen_before").collect()}
    assert None in got.values() and True in got.values() and False in got.values()


def test_stream_first_seen_and_trailing_over_batches(spark, tmp_path):
    parts = [[row(1, 0), row(2, 0.5)], [row(3, 0.9), row(4, 0.9, card=None, merchant=None)], [row(5, 3)]]
    write_batches(spark, parts, tmp_path / "in")
    first = stream_state.stream_merchant_first_seen(source(spark, tmp_path / "in"))
    drain(first.select("transaction_id", "is_merchant_first_seen"), tmp_path / "o1", tmp_path / "c1")
    got = {r[0]: r[1] for r in spark.read.parquet(str(tmp_path / "o1")).collect()}
    assert got == {"t0001": True, "t0002": False, "t0003": False, "t0004": None, "t0005": False}
    counted = stream_state.stream_trailing_count(source(spark, tmp_path / "in"))
    drain(counted.select("transaction_id", "card_txn_count_trailing"), tmp_path / "o2", tmp_path / "c2")
    got = {r[0]: r[1] for r in spark.read.parquet(str(tmp_path / "o2")).collect()}
    assert got == {"t0001": 1, "t0002": 2, "t0003": 3, "t0004": 1, "t0005": 1}


def message(i, minute, pan="4111111111111111"):
    at = START + dt.timedelta(minutes=minute)
    body = {
        "transaction_id": f"t{i}",
        "timestamp": at.isoformat(),
        "bitmap": {"DE002": pan, "DE004": 5000.0, "DE018": "6011", "DE042": "m", "DE022": "01", "DE049": "840"},
    }
    return (None, bytearray(json.dumps(body).encode()), "visa_raw", 0, i, at)


def test_both_jobs_from_raw_messages_to_scores(spark, tmp_path):
    config = EngineConfig()
    raw = [message(i, i * 0.1) for i in range(12)] + [message(90, 1, pan="1"), message(91, 300), message(92, 301)]
    spark.createDataFrame(raw, schemas.WIRE).write.parquet(str(tmp_path / "raw"))
    good, bad = str(tmp_path / "tokenised"), str(tmp_path / "dlq")
    jobs.start_tokeniser(
        wire.read_stream(spark, "parquet", {}, str(tmp_path / "raw")),
        b"key",
        sinks.append_to("json", path=good),
        sinks.append_to("json", path=bad),
        str(tmp_path / "ck1"),
        config,
        metrics=sinks.write_tokeniser_metrics(str(tmp_path / "counts")),
    ).awaitTermination()
    counts = spark.read.parquet(str(tmp_path / "counts")).collect()
    assert [(c.provider, c.consumed, c.tokenised, c.dead_letters) for c in counts] == [(VISA, 15, 14, 1)]
    published = spark.read.schema("key string, value string, topic string").json(good)
    assert published.count() == 14 and spark.read.json(bad).count() == 1

    # What the tokeniser published, as wire records; one broken record and one without a time.
    extra = [(None, "oops", "visa_tokenised"), ("k", '{"transaction_id": "no-time"}', "visa_tokenised")]
    records = published.unionByName(spark.createDataFrame(extra, published.schema)).select(
        F.col("key").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        "topic",
        F.lit(0).alias("partition"),
        F.lit(0).cast("bigint").alias("offset"),
        F.lit(START).alias("timestamp"),
    )
    records.coalesce(1).write.parquet(str(tmp_path / "wire"))
    scored, failed, metrics = (str(tmp_path / n) for n in ("scored", "failed", "metrics"))
    jobs.start_enrichment(
        wire.read_stream(spark, "parquet", {}, str(tmp_path / "wire")),
        refdata.ReferenceTables(spark),
        sinks.append_to("json", path=scored),
        sinks.append_to("json", path=failed),
        sinks.write_metrics(metrics, config),
        str(tmp_path / "ck2"),
        config,
    ).awaitTermination()
    out = [json.loads(r.value) for r in spark.read.schema("key string, value string, topic string").json(scored).collect()]
    assert {o["transaction_id"] for o in out} == {f"t{i}" for i in range(12)}
    assert all(o["card_txn_count_1hr"] == 12 and o["is_high_velocity"] and o["is_high_value"] for o in out)
    assert all(o["velocity_features"]["card_txn_count_1hr"] == 12 for o in out)
    assert all("is_high_velocity" in o["rule_triggers"] for o in out)
    reasons = sorted(json.loads(r.value)["error_reason"] for r in spark.read.json(failed).collect())
    assert reasons == ["Missing event_timestamp", "Parse failure"]
    totals = reports.running_totals(spark.read.parquet(metrics), ["records", "high_risk"]).collect()
    assert [(t.provider, t.records) for t in totals] == [(VISA, 12)]
    assert all(len(m.latency_quantiles) == 3 for m in spark.read.parquet(metrics).collect() if m.records)


def test_a_failing_sink_stops_the_query_and_the_batch_is_replayed(spark, tmp_path):
    write_batches(spark, [[row(1, 0)]], tmp_path / "in")
    calls = []

    def flaky(df, batch_id):
        calls.append(batch_id)
        if len(calls) == 1:
            raise RuntimeError("sink is down")
        df.write.mode("append").parquet(str(tmp_path / "out"))

    for attempt in range(2):
        q = sinks.start(source(spark, tmp_path / "in"), sinks.in_micro_batches(flaky), str(tmp_path / "ck"))
        if attempt == 0:
            with pytest.raises(Exception, match="sink is down"):
                q.awaitTermination()
        else:
            q.awaitTermination()
    assert calls == [0, 0] and spark.read.parquet(str(tmp_path / "out")).count() == 1


def test_wrapped_json_export(spark, tmp_path):
    doc = {"metadata": {"total": 2}, "transactions": [{"source": "VISA", "x": 1}, {"source": "MPESA", "x": 2}]}
    (tmp_path / "all.json").write_text(json.dumps(doc, indent=2))
    schema = spark.createDataFrame([], "source string, x int").schema
    assert exports.read_wrapped_json(spark, str(tmp_path / "all.json"), schema).count() == 2


def test_kafka_options_carry_no_secret():
    got = wire.kafka_options(EngineConfig().raw_topics, "host:9092", **{"kafka.security.protocol": "SSL"})
    assert got["subscribe"].startswith("visa_raw,") and got["maxOffsetsPerTrigger"] == "50000"
    assert got["kafka.security.protocol"] == "SSL" and not any("jaas" in k for k in got)
