"""One large JSON document read by many tasks, wherever it is cut."""

import json
import random

import pytest

from fraudspark.sources import exports, ranges


def document(records, indent=None):
    head = {"metadata": {"note": '}] "transactions": [{ \\" \\\\', "transactions": [{"no": 1}], "deep": [[{"no": 2}]]}}
    return json.dumps(head | {"transactions": records, "after": [{"no": 3}], "transactions ": [{"no": 4}]}, indent=indent, ensure_ascii=False)


def records(seed=1, n=40):
    rng = random.Random(seed)
    parts = ['"', "\\", "{", "}", "[", "]", ",", ":", "é", "€", "x", "transactions", "\n", '": [']
    return [
        {"id": i, "s": "".join(rng.choice(parts) for _ in range(rng.randrange(30))), "o": {"a": [{"b": "}"}]} if i % 3 else None}
        for i in range(n)
    ]


@pytest.mark.parametrize("indent", [None, 2])
def test_every_cut_gives_the_same_records(spark, tmp_path, monkeypatch, indent):
    monkeypatch.setattr(ranges, "PIECE_BYTES", 7)
    made = records(n=12)
    (tmp_path / "d.json").write_text(document(made, indent))
    path = str(tmp_path / "d.json")
    for size in (1, 2, 3, 5, 17, 64, 1000, 10**6):
        listed = [ranges._note(p, a, b, b'"transactions"') for p, a, b in ranges.byte_ranges(path, size)]
        # The running sums of the second pass, in plain Python.
        inside, depth, begin, ended, found = False, 0, None, False, []
        for r in listed:
            side = r["quoted" if inside else "plain"]
            top = [f for f in side["found"] if f["depth"] + depth == 2]
            if begin is None and top:
                begin = top[0]["at"]
            if begin is not None and not ended:
                found += ranges._records(path, r["start"], r["stop"], inside, depth, begin)
                low = top[0]["low"] if r["start"] <= begin < r["stop"] else side["low"]
                ended = low + depth < 2
            inside, depth = inside ^ r["odd"], depth + side["delta"]
        assert [json.loads(t) for _, t in found] == made, size


def test_tables_of_many_tasks(spark, tmp_path):
    schema = spark.createDataFrame([], "id bigint, s string").schema
    for k in range(2):
        (tmp_path / f"{k}.json").write_text(document(records(k), 2))
    (tmp_path / "_ignored").write_text("x")
    (tmp_path / "empty.json").write_text("")
    (tmp_path / "none.json").write_text('{"metadata": {"transactions": [{"id": 9}]}}')
    whole = {(r["id"], r["s"]) for k in range(2) for r in records(k)}
    for size in (300, 10**7):
        df = exports.read_wrapped_json(spark, str(tmp_path), schema, range_bytes=size)
        got = [tuple(r) for r in df.collect()]
        assert len(got) == 80 and set(got) == whole
    assert len(ranges.byte_ranges(str(tmp_path), 900)) > 6
    assert exports.read_wrapped_json(spark, str(tmp_path / "empty.json"), schema, range_bytes=10).count() == 0


def test_written_documents(spark, tmp_path):
    df = spark.createDataFrame([(i, f'"{i}"') for i in range(50)], "id bigint, s string").repartition(4)
    exports.write_wrapped_json(df, str(tmp_path / "d"), {"total": 50})
    text = next((tmp_path / "d").glob("part-*")).read_text()
    assert len(json.loads(text)["transactions"]) == 50 and json.loads(text)["metadata"] == {"total": 50}
    back = exports.read_wrapped_json(spark, str(tmp_path / "d"), df.schema, range_bytes=100)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    exports.write_wrapped_json(df.limit(0), str(tmp_path / "none"), {})
    assert exports.read_wrapped_json(spark, str(tmp_path / "none"), df.schema, range_bytes=100).count() == 0
