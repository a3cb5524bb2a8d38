"""The command line over small datasets."""

import json

import pytest

from detlake import commands
from detlake.__main__ import main
from detlake.operators import coco


def dataset(spark, n, category):
    images = spark.createDataFrame([(i, f"{category}{i}.png", 640, 360) for i in range(1, n + 1)], "id long, file_name string, width int, height int")
    anns = [(i, i, 1 + i % 2, [10.0 * i, 20.0, 30.0, 40.005], 1200.15, 0, None) for i in range(1, n + 1)]
    annotations = spark.createDataFrame(anns, "id long, image_id long, category_id long, bbox array<double>, area double, iscrowd int, event_type string")
    cats = spark.createDataFrame([(1, category, None), (2, "both", None)], "id long, name string, supercategory string")
    return coco.Dataset(images, annotations, cats)


def test_merge_subsample_split_and_quality(spark, tmp_path, capsys):
    coco.write(dataset(spark, 6, "a"), f"{tmp_path}/a", as_document=False)
    coco.write(dataset(spark, 4, "b"), f"{tmp_path}/b.json")
    assert main(["merge", f"{tmp_path}/m", f"{tmp_path}/a", f"{tmp_path}/b.json"]) == 0
    merged = commands.open_dataset(spark, f"{tmp_path}/m")
    assert [d.count() for d in merged] == [10, 10, 3]
    assert {r["file_name"] for r in merged.images.collect()} == {f"a_a{i}.png" for i in range(1, 7)} | {f"b_b{i}.png" for i in range(1, 5)}
    assert main(["subsample", f"{tmp_path}/s", f"{tmp_path}/m", "--max-per-category", "2", "--top", "2"]) == 0
    sub = commands.open_dataset(spark, f"{tmp_path}/s")
    assert sub.annotations.count() == 4 and sub.categories.count() == 2
    assert main(["split", f"{tmp_path}/p", f"{tmp_path}/m", "--fraction", "0.3"]) == 0
    train, val = (commands.open_dataset(spark, f"{tmp_path}/p/{x}") for x in ("train", "val"))
    assert (train.images.count(), val.images.count(), val.annotations.count()) == (7, 3, 3)
    capsys.readouterr()
    assert main(["quality", f"{tmp_path}/q", f"{tmp_path}/m"]) == 0
    text = capsys.readouterr().out
    assert "annotations 10, images 10" in text and "both: 5" in text and "coverage" in text


def test_evaluate_and_wrong_inputs(spark, tmp_path):
    truth = {"total": 2, "annotations": {k: {"task": k, "image": "i", "prompt": "p", "interaction_type": "x", "bbox": [0.1, 0.1, 0.5, 0.5], "label": "oak"} for k in ("t1", "t2")}}
    (tmp_path / "truth.json").write_text(json.dumps(truth))
    spark.createDataFrame([("t1", 0, 0.3, 0.3, 0.4, 0.4, 0.9), ("t1", 1, 0.3, 0.3, 0.1, 0.1, 0.5)], "task string, query int, cx double, cy double, w double, h double, score double").write.parquet(f"{tmp_path}/predictions")
    assert main(["evaluate", f"{tmp_path}/e", f"{tmp_path}/truth.json", f"{tmp_path}/predictions"]) == 0
    got = {r["task"]: round(r["iou"], 6) for r in spark.read.parquet(f"{tmp_path}/e/results").collect()}
    assert got == {"t1": 1.0, "t2": 0.0}
    with pytest.raises(SystemExit):
        main(["evaluate", f"{tmp_path}/e", f"{tmp_path}/truth.json"])
