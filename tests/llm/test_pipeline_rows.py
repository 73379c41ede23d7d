"""The dropping stages of the pipeline judge rows, not ids."""

from __future__ import annotations

import random
from collections import Counter

import corpus_pipeline
from tests.llm.corpus import frame, prose


def test_stages_decide_by_row(spark, tmp_path):
    rng = random.Random(9)
    a, b, c, d, e, f = (prose(rng, 80) for _ in range(6))
    rows = [
        (3, a), (None, a), (None, a + " x"), (None, a + " x"),  # copies without id go
        (4, b), (4, b), (4, b),  # one of repeated rows stays
        (None, c), (None, c), (None, c + " y"),  # of a group without ids too
        (5, d), (5, a + " z"),  # a near copy does not take the other row of its id with it
        (6, ""), (7, ""), (7, ""), (None, None), (None, None),
        (8, e), (8, f), (None, e + " w"),
    ]
    docs = frame(spark, rows).select("doc_id", "text", "lang", "source", "n_lines")
    found = corpus_pipeline.drop_near_copies(spark, docs, str(tmp_path))
    assert found.columns == docs.columns
    kept = [(r["doc_id"], r["text"]) for r in found.collect()]
    assert Counter(kept) - Counter([(None, c), (None, c + " y")]) == Counter(
        [(3, a), (4, b), (5, d), (6, ""), (7, ""), (None, None), (8, e), (8, f)]
    )
    assert len(kept) == 9

    item = " ".join(e.split()[10:30])
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    clean = corpus_pipeline.drop_benchmark_copies(spark, docs, str(tmp_path))
    assert clean.columns == docs.columns
    left = Counter((r["doc_id"], r["text"]) for r in clean.collect())
    assert left == Counter((i, t) for i, t in rows if item not in " ".join((t or "").split()))
    assert left[(8, f)] == 1 and left[(8, e)] == left[(None, e + " w")] == 0
