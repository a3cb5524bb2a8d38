"""Benchmark items shorter than a shingle, inside longer documents."""

from detlake.llm import decontaminate
from tests.llm.test_llm import docs, words


def test_short_items_in_long_documents(spark):
    rows = [(1, words(40, 1) + " Forty-two! " + words(40, 2)), (2, words(80, 3)), (3, "forty two"), (4, "paris"), (5, "in Paris they say so today"), (6, "two forty and more words here")]
    items = spark.createDataFrame([(10, "forty two"), (11, "Paris"), (12, "one two three four five six"), (13, "...")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"], r["n_item"], r["containment"]) for r in decontaminate.contained(docs(spark, rows), items).collect()}
    assert got == {(1, 10, 1, 1.0), (3, 10, 1, 1.0), (4, 11, 1, 1.0), (5, 11, 1, 1.0)}
