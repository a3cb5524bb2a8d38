"""The corpus pipeline stage by stage on a small corpus with planted cases."""


import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from detlake.llm import queries
from tests.llm.test_llm import base_spans, docs, plain_components, plain_print, words

DOCS = 140


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("sf"))
    bench = [(i, words(30, 5000 + i)) for i in range(5)]
    rows = [(i, words(150, i) + ".") for i in range(DOCS)]
    rows += [(200 + i, rows[i][1]) for i in range(10)]  # copies
    rows += [(300 + i, "".join(f"{w.upper()}!! " for w in words(80, 700 + i).split())) for i in range(10)]  # shouting
    rows += [(400 + i, words(60, 800 + i) + " " + bench[i][1] + " " + words(60, 900 + i) + ".") for i in range(5)]  # leaks
    rows += [(500, words(150, 50_000) + " token: deadbeefdeadbeefdeadbeef00 end."), (501, rows[3][1]), (501, rows[3][1]), (None, words(150, 60_000) + "."), (502, None), (503, "")]
    d = docs(spark, rows).withColumn("__marks", F.lit("extra"))
    d.repartition(3).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(DOCS)] + [(500, 1, 0), (300, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame(bench + [(9, None)], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return root, rows


def stage(spark, k, docs_, root):
    return cp.STAGES[k][1](spark, docs_, root)


def test_every_stage(spark, corpus, tmp_path):
    root, rows = corpus
    d = spark.read.parquet(f"{root}/documents.parquet")
    seen = []
    for k in range(4):
        out = stage(spark, k, d, root)
        assert out.columns == d.columns, cp.STAGES[k][0]
        out.write.parquet(str(tmp_path / str(k)))
        d = spark.read.parquet(str(tmp_path / str(k)))
        seen.append([(r["doc_id"], r["text"]) for r in d.collect()])
    good, single, clean, safe = seen
    ids = [i for i, _ in good]
    assert not {300 + i for i in range(10)} & set(ids) and 502 not in ids and 503 not in ids and sum(i in ids for i in range(DOCS)) >= DOCS - 2
    texts = {i: t for i, t in good if i is not None}
    comp = plain_components({i: plain_print(t) for i, t in texts.items()})
    assert sorted(i for i, _ in single if i is not None) == sorted({comp[i] for i in comp}) and any(i is None for i, _ in single)
    assert {i for i, _ in single} - {i for i, _ in clean} == {400 + i for i in range(5)}
    assert len(safe) == len(clean)
    left = dict((i, t) for i, t in safe if i is not None)
    assert "<secret>" in left[500] and not any(base_spans(t) for _, t in safe)
    assert all(left[i] == t for i, t in clean if i is not None and i != 500)
    last = stage(spark, 4, d, root)
    assert last.count() == len(safe) and {"doc_id", "n_tokens", "ids", "__marks"} <= set(last.columns)


def test_run_equals_its_stages_and_survives_emptiness(spark, corpus):
    root, rows = corpus
    done = cp.run(spark, root)
    assert len({r["doc_id"] for r in done.collect()} & set(range(20, 100))) >= 78
    empty = spark.read.parquet(f"{root}/documents.parquet").where("false")
    for _, f in cp.STAGES:
        assert f(spark, empty, root).count() == 0


def test_stages_keep_rows_apart_that_share_an_id(spark, corpus):
    root, _ = corpus
    a, b, c = words(150, 71_000), words(150, 72_000), words(150, 73_000)
    d = docs(spark, [(5, a), (5, b), (5, b), (3, a), (None, c), (None, c), (8, c)])
    got = sorted((str(r["doc_id"]), r["text"]) for r in cp.drop_near_duplicates(spark, d, root).collect())
    assert got == sorted([("3", a), ("5", b), ("8", c)])


def test_queries_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 11)) and set(queries.ORACLES) <= set(queries.QUERIES)
    assert [n for n, _ in cp.STAGES] == ["quality", "near_duplicates", "decontamination", "secrets", "tokens"]
