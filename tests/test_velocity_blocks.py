"""The waiting velocity stream: rows wait in blocks, and no answer depends on how they were packed."""

import random

import pytest

from fraudspark.operators import velocity
from fraudspark.streaming import velocity as stream_velocity
from tests.test_streams import DDL, drain, row, rounded, source, write_batches


@pytest.mark.parametrize("pack_rows", [7, 262_144])
def test_state_holds_blocks_and_not_rows(spark, tmp_path, monkeypatch, pack_rows):
    monkeypatch.setattr(stream_velocity, "_PACK_ROWS", pack_rows)
    rng, rows = random.Random(8), []
    for i in range(600):
        card = None if i % 20 == 0 else f"c{rng.randrange(300)}" if i % 3 else "busy"
        merchant = None if i % 25 == 0 else rng.choice(["m", "n", "o"])
        amount = None if i % 17 == 0 else rng.randrange(-99, 999) / 10
        rows.append(row(i, rng.randrange(3600) / 60, card, merchant, amount=amount))
    write_batches(spark, [rows[:300], rows[300:], [row(9000, 400)], [row(9001, 900)]], tmp_path / "in")
    made = stream_velocity.stream_velocity(source(spark, tmp_path / "in"), buckets=3)
    query = drain(made.drop("window"), tmp_path / "out", tmp_path / "ck")
    got = rounded(spark.read.parquet(str(tmp_path / "out")))
    expected = rounded(velocity.velocity(spark.createDataFrame(rows, DDL)))
    assert {i: got[i] for i in expected} == {i: pytest.approx(v, abs=2e-4) for i, v in expected.items()}
    if pack_rows > 600:
        held = max(sum(op["numRowsTotal"] for op in p["stateOperators"]) for p in query.recentProgress)
        assert 0 < held < 60
