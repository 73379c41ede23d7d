"""Python workers that a task of op3 and of the pipeline's decontamination needs."""

from __future__ import annotations

from fraudspark.llm import decontaminate
from tests.llm.corpus import docs, rows_of  # noqa: F401


def test_one_python_step_searches_and_counts(spark, docs):  # noqa: F811
    items = spark.createDataFrame([(1, "a b c d"), (2, "x x x"), (3, "not there")], "item_id bigint, text string")
    one = decontaminate.decontaminate(docs, items)
    assert one._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    several = decontaminate.decontaminate(docs, items, slice_bytes=1)
    columns = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "n_near")
    assert rows_of(one, *columns) == rows_of(several, *columns)
    assert one.where("contaminated").count() > 0
