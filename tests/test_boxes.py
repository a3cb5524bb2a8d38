import random

import pytest
from pyspark.sql import functions as F

from detlake.functions import boxes


def lit(b):
    return boxes.Box(*[F.lit(float(v)) for v in b])


@pytest.mark.parametrize("a, b, want", [
    ((.1, .2, .5, .6), (.1, .2, .5, .6), 1.0), ((0, 0, .1, .1), (.5, .5, .6, .6), 0.0), ((0, 0, .4, .4), (.2, .2, .6, .6), .04 / .28),
    ((0, 0, 1, 1), (.2, .2, .4, .4), .04), ((.5, .5, .5, .5), (0, 0, 1, 1), 0.0),
])
def test_iou_literals(one, a, b, want):
    assert one(v=boxes.iou(lit(a), lit(b)))["v"] == pytest.approx(want)


def test_iou_rules_stay_apart(one):
    e = (.5, .5, .5, .5)
    got = one(guarded=boxes.iou(lit(e), lit(e)), eps=boxes.iou_eps(lit(e), lit(e)), raw=boxes.iou_raw(lit(e), lit(e)), missing=boxes.iou(lit(e), boxes.Box(*[F.lit(None).cast("double")] * 4)))
    assert got["guarded"] == 0 and got["eps"] == 0 and got["raw"] != got["raw"] and got["missing"] == 0


def test_iou_and_giou_against_cells(spark):
    rnd = random.Random(3)
    rows = [tuple(float(x) for b in range(2) for x in (lambda x, y: (x, y, x + rnd.randint(1, 6), y + rnd.randint(1, 6)))(rnd.randint(0, 8), rnd.randint(0, 8))) for _ in range(60)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double, f double, g double, h double")
    p, q = boxes.box("a", "b", "c", "d"), boxes.box("e", "f", "g", "h")
    for r in df.select("*", boxes.iou(p, q).alias("iou"), boxes.giou(p, q).alias("giou")).collect():
        cells = [{(x, y) for x in range(int(r[i]), int(r[i + 2])) for y in range(int(r[i + 1]), int(r[i + 3]))} for i in (0, 4)]
        inter, union = len(cells[0] & cells[1]), len(cells[0] | cells[1])
        hull = (max(r[2], r[6]) - min(r[0], r[4])) * (max(r[3], r[7]) - min(r[1], r[5]))
        assert r["iou"] == pytest.approx(inter / union)
        assert r["giou"] == pytest.approx(inter / union - (hull - union) / hull)


def test_encodings_round_trip(one):
    b = (.1, .2, .5, .8)
    back = boxes.of_cxcywh(*boxes.to_cxcywh(lit(b)))
    also = boxes.of_xywh(*boxes.to_xywh(lit(b)))
    got = one(a=F.array(*back), b=F.array(*also), flip=F.array(*boxes.flip(lit(b), F.lit(1.0))), scaled=boxes.scale_xywh(F.array(*map(F.lit, (320.0, 180.0, 64.0, 36.0))), (360, 640), (224, 224)))
    assert got["a"] == pytest.approx(b) and got["b"] == pytest.approx(b) and got["flip"] == pytest.approx((.5, .2, .9, .8))
    assert got["scaled"] == pytest.approx((320 * 224 / 640, 180 * 224 / 360, 64 * 224 / 640, 36 * 224 / 360))


def test_crop_drops_what_leaves(spark):
    df = spark.sql("SELECT array(named_struct('x1', 0D, 'y1', 0D, 'x2', 10D, 'y2', 10D, 'area', 100D, 'label', 'a'), named_struct('x1', 50D, 'y1', 50D, 'x2', 60D, 'y2', 60D, 'area', 100D, 'label', 'b')) AS t")
    got = df.select(boxes.crop_targets(F.col("t"), 5, 5, 20, 20).alias("t")).first()["t"]
    assert [(x["label"], x["x1"], x["x2"], x["area"]) for x in got] == [("a", 0.0, 5.0, 25.0)]


def test_resize_and_proposals(one):
    w, h = boxes.resized(F.lit(1000), F.lit(500), 800, 1333)
    got = one(w=w, h=h, p=boxes.proposals(3, 2, 0), c=boxes.centre_crop_box(F.lit(101), F.lit(51), 0.5), band=F.array(*[boxes.iou_band(F.lit(v)) for v in (.75, .5, .25, .1)]))
    assert (got["w"], got["h"]) == (1332, 666) and len(got["p"]) == 6 and got["c"] == [25.0, 13.0, 50.0, 25.0]
    assert got["band"] == [">=0.75", ">=0.5", ">=0.25", "<0.25"]
