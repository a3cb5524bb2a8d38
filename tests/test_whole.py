"""Queries that take all rows and whole texts, against plain loops."""

from detlake.plans import queries


def test_segments_after_the_sixtieth_word(spark, tmp_path):
    texts = ["a b. c", "w " * 70 + "x. y z.", " ".join("e." if i % 90 == 89 else "e" for i in range(400))]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    for r in queries.QUERIES["token_segments"](spark, str(tmp_path)).collect():
        sizes = [0]
        words = texts[r["doc_id"]].split(" ")
        for i, w in enumerate(words):
            sizes[-1] += 1
            if w.endswith(".") and i + 1 < len(words):
                sizes.append(0)
        assert (r["last_segment"], r["longest"]) == (len(sizes) - 1, max(sizes))


def test_top_labels_of_all_rows(spark, tmp_path):
    vecs = {i: [((i * 37 + k * k * 11) % 101 - 50) / 50 for k in range(6)] for i in range(1100)}
    spark.createDataFrame(list(vecs.items()), "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    f = [r["embedding"] for r in spark.read.parquet(f"{tmp_path}/embeddings.parquet").orderBy("vec_id").collect()]
    want = []
    for q in range(0, 1100, 100):
        best = sorted((-sum(a * b for a, b in zip(f[q], v, strict=True)), i) for i, v in enumerate(f))[:5]
        want += [(q, i, round(-d, 4), n) for n, (d, i) in enumerate(best, 1)]
    got = queries.QUERIES["similarity_topk"](spark, str(tmp_path)).collect()
    assert sorted((r["query"], r["label"], round(r["similarity"], 4), r["rank"]) for r in got) == sorted(want)


def test_all_line_numbers_have_a_style(spark, tmp_path):
    rows = [(k, n, float((k * 7 + n * 13) % 29)) for k in range(20) for n in range(1, 2 + k % 7)]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_quantity double").write.parquet(f"{tmp_path}/lineitem.parquet")
    for r in queries.QUERIES["style_pivot"](spark, str(tmp_path)).collect():
        want = [max((q for k, n, q in rows if k == r["task"] and n % 3 == m), default=None) for m in (1, 2, 0)]
        assert [r["original"], r["simple"], r["aligned"]] == want
