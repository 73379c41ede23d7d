"""Proximity matches of items with unseen or few words, and equal shards under a sliced benchmark."""

from __future__ import annotations

from fraudspark.llm import decontaminate
from tests.llm.corpus import frame, rows_of


def test_unseen_and_few_words(spark):
    docs = [(1, "alpha one two beta three gamma four delta"), (2, "alpha " + "w " * 60 + "beta gamma delta"), (3, "beta")]
    items = [(7, "delta gamma unseen beta alpha"), (8, "alpha beta"), (9, "unseen unheard")]
    index = decontaminate.build_index(frame(spark, docs))
    found = decontaminate.search(index, spark.createDataFrame(items, "item_id bigint, text string"), anchors=4, span=10)
    assert rows_of(found, "doc_id", "near", "items") == [(1, ["7", "8"], []), (2, [], []), (3, [], [])]


def test_equal_shards_stay_apart_in_slices(spark):
    docs = frame(spark, [(1, "a b c d")] * 3 + [(2, "e")])
    items = spark.createDataFrame([(1, "a b"), (2, "c d"), (3, "e")], "item_id bigint, text string")
    for parts in (1, 2):
        index = decontaminate.build_index(docs.coalesce(parts), shard_bytes=1)
        found = decontaminate.digest(decontaminate.search(index, items, slice_bytes=1))
        assert rows_of(found, "doc_id", "n_hit", "n_items", "n_near") == [(1, 4, 2, 2)] * 3 + [(2, 1, 1, 1)], parts
