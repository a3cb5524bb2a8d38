import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from detlake.functions import frames
from detlake.operators import align, coco, keys, match, metrics, postprocess, quality, sample, timeline
from detlake.plans import pipelines


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def actions(spark, chunks):
    data = [(0, off + i, v) for off, values in chunks.items() for i, v in enumerate(values)]
    return spark.createDataFrame(data, "ep_idx int, frame int, attack int")


@pytest.mark.parametrize("chunks, at, want", [
    ({96: [0] * 4 + [1] * 28, 64: [1] * 32}, 110, 100), ({64: [1] * 32, 32: [0] * 20 + [1] * 12}, 80, 52), ({0: [1] * 32, 32: [1] * 32}, 50, 0), ({}, 50, None),
    ({64: [1] * 32}, 80, None), ({64: [1] * 32, 0: [0] * 32}, 80, None),
])
def test_attack_start(spark, chunks, at, want):
    req = spark.createDataFrame([(0, at)], "ep_idx int, frame int")
    assert timeline.attack_starts(actions(spark, chunks), req).first()["start"] == want


def test_attack_start_walks_like_a_loop(spark):
    rnd = random.Random(11)
    data, asks, want = [], [], {}
    for ep in range(25):
        chunks = {c: [int(rnd.random() < 0.93) for _ in range(32)] for c in range(0, 320, 32) if rnd.random() < 0.9}
        data += [(ep, c + i, v) for c, vs in chunks.items() for i, v in enumerate(vs)]
        for at in rnd.sample(range(320), 12):
            asks.append((ep, at))
            got, low = 0, max(0, at - 64)
            for c in range(at // 32 * 32, low - 32, -32):
                if c < 0:
                    break
                if c not in chunks:
                    got = None
                    break
                zeros = [c + i for i in range(32) if c + i <= at and chunks[c][i] == 0]
                if zeros:
                    got = max(zeros) + 1
                    break
            want[ep, at] = got
    a = spark.createDataFrame(data, "ep_idx int, frame int, attack int")
    found = timeline.attack_starts(a, spark.createDataFrame(asks, "ep_idx int, frame int"), lookback=64).collect()
    assert {(r["ep_idx"], r["frame"]): r["start"] for r in found} == want


@pytest.mark.parametrize("start, fr, want", [(98, 100, 98), (0, 250, 250), (101, 100, 100), (None, 80, None)])
def test_anchor(one, start, fr, want):
    assert one(a=frames.anchor(F.lit(start).cast("int"), F.lit(fr)))["a"] == want


def test_offsets(spark):
    v = spark.createDataFrame([(f"P-abc-20210101-{t}", f"/{t}", n) for t, n in (("110000", 50), ("120000", 50), ("120100", 50), ("120150", 0), ("120200", 50))], "stem string, path string, n_frames int")
    e = spark.createDataFrame([("P-abc-20210101-120000",), ("nobody-1",)], "episode string")
    table = align.offset_table(v, e)
    assert rows(table.select("path", "start", "end")) == [("/120000", 0, 50), ("/120100", 50, 100), ("/120200", 100, 150)]
    req = e.crossJoin(spark.createDataFrame([(x,) for x in (-1, 0, 50, 100, 149, 150)], "frame long"))
    for bucket in (None, 64):
        got = {r["frame"]: (r["path"], r["local"]) for r in align.locate(req, table, bucket).where("episode LIKE 'P%'").collect()}
        assert got == {-1: (None, None), 0: ("/120000", 0), 50: ("/120100", 0), 100: ("/120200", 0), 149: ("/120200", 49), 150: (None, None)}
    assert align.locate(req, table).where("episode = 'nobody-1' AND path IS NOT NULL").count() == 0


def test_nearest_partition(spark):
    s = spark.createDataFrame([("part-7",), ("part-10",), ("x",)], "part string")
    q = spark.createDataFrame([("part-5",), ("part-9",), ("part-12",), ("other-9",)], "part string")
    assert rows(align.nearest_partition(s, q)) == [("part-10", "part-9", 1), ("part-7", "part-5", 2), ("x", "part-5", 5)]


def test_first_and_last_wins_whatever_the_partitions(spark):
    data = [(k, o, f"{k}{o}") for k in range(5) for o in range(7)]
    for n in (1, 2, 8):
        random.Random(n).shuffle(data)
        df = spark.createDataFrame(data, "k int, o int, v string").repartition(n)
        assert rows(keys.first_wins(df, ["k"], ["o"])) == [(k, 0, f"{k}0") for k in range(5)]
        assert rows(keys.last_wins(df, ["k"], ["o"])) == [(k, 6, f"{k}6") for k in range(5)]
        assert rows(keys.surrogate_keys(df, ["k"], ["o", "k"])) == [(k, k + 1) for k in range(5)]


def triple(spark, images, anns, cats):
    from detlake import schema

    return coco.Dataset(
        spark.createDataFrame([(i, f, 640, 360) for i, f in images], schema.IMAGES), spark.createDataFrame([(*a, 0, None) for a in anns], schema.ANNOTATIONS),
        spark.createDataFrame([(i, n, None) for i, n in cats], schema.CATEGORIES),
    )


def two(spark):
    a = triple(spark, [(1, "img_001.png"), (2, "img_002.png")], [(1, 1, 1, [10.0, 20.0, 100.0, 80.0], 8000.0), (2, 2, 2, [50.0, 60.0, 120.0, 90.0], 10800.0)], [(1, "stone"), (2, "coal_ore")])
    b = triple(spark, [(1, "img_001.png"), (2, "img_003.png")], [(1, 1, 1, [30.0, 40.0, 80.0, 60.0], 4800.0), (2, 2, 3, [100.0, 100.0, 150.0, 100.0], 15000.0)], [(1, "stone"), (3, "granite")])
    return a, b


def test_merge(spark, tmp_path):
    a, b = two(spark)
    m, counts = coco.merge([("ds_a", a), ("none", None), ("ds_b", b)])
    assert rows(m.categories.select("id", "name")) == [(1, "stone"), (2, "coal_ore"), (3, "granite")]
    assert rows(m.images.select("id", "file_name")) == [(1, "ds_a_img_001.png"), (2, "ds_a_img_002.png"), (3, "ds_b_img_001.png"), (4, "ds_b_img_003.png")]
    assert rows(m.annotations.select("id", "image_id", "category_id", "area")) == [(1, 1, 1, 8000.0), (2, 2, 2, 10800.0), (3, 3, 1, 4800.0), (4, 4, 3, 15000.0)]
    assert rows(counts) == [("ds_a", 2, 2), ("ds_b", 2, 2)]
    coco.write(m, str(tmp_path / "doc"))
    back = coco.read(spark, str(tmp_path / "doc"))
    assert [x.count() for x in back] == [4, 4, 3] and rows(back.annotations.select("id", "area"))[0] == (1, 8000.0)


def test_build(spark):
    flat = spark.createDataFrame([(1, "a.png", "stone", [320.0, 180.0, 64.0, 36.0]), (2, "a.png", "stone", [0.0, 0.0, 10.0, 10.0]), (3, "b.png", "coal_ore", [1.0, 1.0, 2.0, 2.0]), (4, "c.png", "x", None)], "ord int, image_file string, category string, bbox array<double>")
    ds = coco.build(flat.withColumns({"image_width": F.lit(224), "image_height": F.lit(224)}), ["ord"], size=(360, 640))
    assert rows(ds.images.select("id", "file_name")) == [(1, "a.png"), (2, "b.png")] and rows(ds.categories.select("id", "name")) == [(1, "stone"), (2, "coal_ore")]
    first = ds.annotations.where("id = 1").first()
    assert first["bbox"] == pytest.approx([320 * 224 / 640, 180 * 224 / 360, 64 * 224 / 640, 36 * 224 / 360])


def test_targets_are_clamped(spark):
    a = triple(spark, [(1, "a")], [(1, 1, 1, [-5.0, 10.0, 20.0, 20.0], 1.0), (2, 1, 1, [700.0, 10.0, 20.0, 20.0], 1.0)], [(1, "s")])
    assert [(r["id"], r["box"]["x1"], r["box"]["x2"]) for r in coco.detection_targets(a).collect()] == [(1, 0.0, 15.0)]


def test_subsample_invariants(spark):
    rnd = random.Random(1)
    anns = [(i, rnd.randint(1, 40), rnd.choice([1, 1, 1, 2, 2, 3, 4]), [0.0, 0.0, 5.0, 5.0], 25.0) for i in range(1, 301)]
    ds = triple(spark, [(i, f"{i}") for i in range(1, 41)], anns, [(i, f"c{i}") for i in range(1, 5)])
    out = sample.subsample(ds.annotations, ds.images, ds.categories, max_per_cat=30, min_per_cat=35, top_k=2)
    got = rows(out["annotations"].select("id", "image_id", "category_id"))
    assert [g[0] for g in got] == list(range(1, len(got) + 1)) and {g[2] for g in got} == {1, 2}
    assert all(sum(g[2] == c for g in got) == 30 for c in (1, 2))
    assert {g[1] for g in got} == {r["id"] for r in out["images"].collect()} and out["categories"].count() == 2
    again = sample.subsample(ds.annotations.repartition(7), ds.images, ds.categories, max_per_cat=30, min_per_cat=35, top_k=2)
    assert rows(again["annotations"].select("id", "image_id", "category_id")) == got


def test_samples_and_splits(spark):
    df = spark.range(100).select(F.col("id"), (F.col("id") % 3).alias("g"))
    assert [r[0] for r in rows(sample.take_uniform(df.where("id < 20"), 5, ["id"]).select("id"))] == [0, 4, 8, 12, 16]
    assert sample.take_uniform(df.where("id < 20"), 100, ["id"]).count() == 20 and sample.take_first(df, 5, ["id"]).count() == 5
    assert sample.validation_split(df, ["id"]).where("is_val").count() == 10 and sample.validation_split(df.limit(3), ["id"]).where("is_val").count() == 1
    b = sample.batches(df, 4, ["id"], least=10).groupBy("batch").count()
    assert rows(b) == [(i, 25) for i in range(4)] and sample.batches(df, 4, ["id"]).select("batch").distinct().count() == 1
    assert rows(sample.spread_per_group(df, ["g"], 3, ["id"]))[:3] == [(0, 0), (1, 1), (2, 2)]
    assert sample.sample_per_group(df, ["g"], 4, ["id"]).count() == 12 and sample.shuffled(df, ["id"]).count() == 100


def test_negatives_are_absent(spark):
    a, _ = two(spark)
    cats = spark.createDataFrame([(i, f"c{i}", None) for i in range(1, 9)], "id long, name string, supercategory string")
    neg = sample.negatives(a.images, a.annotations, cats, 3)
    own = {(r["image_id"], r["category_id"]) for r in a.annotations.collect()}
    got = rows(neg.select("image_id", "category_id"))
    assert len(got) == len(set(got)) == 6 and not own & set(got)


def test_metrics(spark):
    df = spark.createDataFrame([("a", "x", .8, .9, True), ("b", "y", .3, .7, True), ("c", "z", 0.0, 0.0, False)], "task string, label string, iou double, pred_score double, has_prediction boolean")
    s = metrics.summary(df).first()
    assert s["detection_rate"] == pytest.approx(2 / 3) and s["mean_iou"] == pytest.approx(1.1 / 3) and s["total"] == 3
    empty = metrics.summary(df.where("false")).first()
    assert (empty["mean_iou"], empty["accuracy"], empty["detection_rate"], empty["total"]) == (0, {}, 0, 0)
    acc = spark.createDataFrame([(x,) for x in (.6, .3, .8, .1)], "iou double")
    assert rows(metrics.accuracy_long(acc)) == [(.25, .75), (.5, .5), (.75, .25)] and rows(metrics.accuracy_long(acc.where("false"))) == [(.25, 0), (.5, 0), (.75, 0)]
    c = metrics.confusion(spark.createDataFrame([(True, True), (True, False), (False, True), (False, True)], "p boolean, a boolean"), "p", "a").first()
    assert tuple(c) == (1, 1, 2, 0)


def test_assignment_against_all_permutations():
    rnd = np.random.default_rng(4)
    for _ in range(200):
        n, m = (int(v) for v in rnd.integers(1, 6, 2))
        cost = rnd.normal(size=(n, m)).round(2)
        got = match.assign(cost)
        k = min(n, m)
        best = min(sum(cost[r, c] for r, c in zip(rs, cs)) for rs in itertools.combinations(range(n), k) for cs in itertools.permutations(range(m), k))
        assert len(got) == k == len({r for r, _ in got}) == len({c for _, c in got}) and sum(cost[r, c] for r, c in got) == pytest.approx(best)


def test_optimal_match_over_batches(spark):
    rnd = np.random.default_rng(8)
    data = [(i, q, g, float(rnd.normal())) for i in range(40) for q in range(5) for g in range(1 + i % 5)]
    costs = spark.createDataFrame(data, "image_id long, query long, gt_id long, cost double")
    total = {}
    for r in match.optimal_match(costs).collect():
        total[r["image_id"]] = total.get(r["image_id"], 0) + r["cost"]
    for i in range(40):
        mine = [d for d in data if d[0] == i]
        gts = sorted({d[2] for d in mine})
        c = np.array([[next(d[3] for d in mine if d[1] == q and d[2] == g) for g in gts] for q in range(5)])
        assert total[i] == pytest.approx(sum(c[r, k] for r, k in match.assign(c)))


def _ap(dets, gts, t):
    """Average precision of one category by the published protocol, one object at a time."""
    hits, used = [], set()
    for image, score, b in sorted(dets, key=lambda d: (-d[1], d[0])):
        best, at = t, None
        for j, (gi, g) in enumerate(gts):
            if gi != image or j in used:
                continue
            w, h = min(b[2], g[2]) - max(b[0], g[0]), min(b[3], g[3]) - max(b[1], g[1])
            inter = max(w, 0) * max(h, 0)
            iou = inter / ((b[2] - b[0]) * (b[3] - b[1]) + (g[2] - g[0]) * (g[3] - g[1]) - inter)
            if iou >= best:
                best, at = iou, j
        if at is not None:
            used.add(at)
        hits.append(at is not None)
    tp = np.cumsum(hits)
    prec = tp / np.arange(1, len(hits) + 1) if len(hits) else np.array([])
    rec = tp / len(gts)
    return sum((prec[rec >= r - 1e-12].max() if (rec >= r - 1e-12).any() else 0) for r in np.linspace(0, 1, 101)) / 101


def test_average_precision_against_loops(spark):
    rnd = random.Random(9)
    gts, dets = [], []
    for image in range(25):
        for _ in range(rnd.randint(0, 4)):
            x, y = rnd.uniform(0, 300), rnd.uniform(0, 300)
            g = (x, y, x + rnd.uniform(20, 90), y + rnd.uniform(20, 90))
            gts.append((image, g))
            if rnd.random() < .8:
                s = rnd.uniform(-12, 12)
                dets.append((image, rnd.random(), tuple(v + s for v in g)))
        if rnd.random() < .5:
            dets.append((image, rnd.random(), (5.0, 5.0, 60.0, 60.0)))
    t = spark.createDataFrame([(i, 1, k, *g) for k, (i, g) in enumerate(gts)], "image_id long, category_id long, id long, x1 double, y1 double, x2 double, y2 double")
    d = spark.createDataFrame([(i, 1, k, s, *b) for k, (i, s, b) in enumerate(dets)], "image_id long, category_id long, id long, score double, x1 double, y1 double, x2 double, y2 double")
    pack = lambda df: df.withColumn("box", F.struct("x1", "y1", "x2", "y2"))
    ap = match.average_precision(match.coco_matches(pack(t).withColumn("iscrowd", F.lit(0)), pack(d))).where("area = 'all'")
    got = {round(r["threshold"], 2): r["ap"] for r in ap.collect()}
    for level in (.5, .7, .75, .9):
        assert got[level] == pytest.approx(_ap(dets, gts, level), abs=1e-9)


def test_postprocess(spark):
    p = spark.createDataFrame([(1, 0, [.1, .9, .2]), (1, 1, [.3, .2, .35]), (2, 0, [.05, .1, .2])], "image_id long, query int, probs array<double>")
    p = p.withColumns({"cx": F.lit(.5), "cy": F.lit(.5), "w": F.lit(.2), "h": F.lit(.4)})
    tok = F.array(*map(F.lit, ("red", "cow", ".")))
    got = postprocess.by_caption(p, tok, F.lit(100), F.lit(50)).collect()
    assert [(r["image_id"], r["phrase"], round(r["box"]["x1"], 6)) for r in got] == [(1, "cow", 40.0)]
    tasks = spark.createDataFrame([(1,), (3,)], "image_id long")
    s = p.withColumn("score", F.array_max("probs"))
    top = {r["image_id"]: (r["box"] and round(r["box"]["y2"], 6), r["score"]) for r in postprocess.top_prediction(s, tasks).collect()}
    assert top == {1: (.7, .9), 3: (None, 0.0)}
    labels_ = postprocess.top_labels(s.withColumnRenamed("probs", "label_scores"), k=2).select("image_id", "query", "label")
    assert rows(labels_) == [(1, 0, 1), (1, 1, 2), (2, 0, 1), (2, 0, 2)]
    assert rows(postprocess.top_queries(s.withColumnRenamed("probs", "similarities"), k=1).select("image_id", "query")) == [(1, 0), (2, 0)]


def test_timeline_helpers(spark):
    inv = spark.createDataFrame([(1, 0, 0), (1, 1, 2), (1, 2, 1), (1, 3, 5), (2, 0, 0)], "e int, frame int, quantity int")
    assert rows(timeline.first_increase(inv, ["e"])) == [(1, 1), (2, None)]
    m = timeline.moving_stats(inv.where("e = 1"), ["e"], ["frame"], "quantity", 2).orderBy("frame").collect()
    assert [(r["median"], r["mean"], r["max"]) for r in m] == [(0, 0, 0), (0, 1, 2), (1, 1.5, 2), (1, 3, 5)]
    b = timeline.best_so_far(inv.where("e = 1"), ["e"], ["frame"], "quantity").orderBy("frame").collect()
    assert [(r["best"], r["is_best"]) for r in b] == [(0, True), (2, True), (2, False), (5, True)]


def observations(spark):
    from detlake import schema

    text = " ".join(f"{r * 640 + 300} 90" for r in range(150, 200))
    data = [("p-1", 0, f, f, "mine_block:stone", text, 175, 320, 300, 330, None, None) for f in range(300, 331)]
    data += [("p-1", 0, 330, 331, "mine_block:stone", text, 175, 320, 300, 330, None, None), ("p-1", 0, 20, 20, "right_click", text, 1, 1, 0, 20, None, None), ("p-1", 1, 20, 20, "mine_block:dirt", "50 30", 180, 320, 0, 20, None, None)]
    return spark.createDataFrame(data, schema.SEG_OBS)


def test_builders(spark):
    o = observations(spark)
    ev = pipelines.tracked_events(o)
    assert rows(ev.select("ep_idx", "label", "frame")) == [(0, "stone", 330), (1, "dirt", 20)]
    built = pipelines.build_from_windows(o)
    assert [x.count() for x in built.dataset] == [4, 4, 1]
    first = built.dataset.annotations.first()
    assert first["bbox"] == pytest.approx([300 * 224 / 640, 150 * 224 / 360, 90 * 224 / 640, 50 * 224 / 360])
    assert built.reasons.first().asDict() == {"no_mask": 0, "too_small": 0, "too_large": 0, "no_box": 0, "kept": 4}
    back = pipelines.build_from_backtrack(o)
    assert back.dataset.images.count() == 4 and "ds_p-1_ep0_f000321.png" in {r["file_name"] for r in back.dataset.images.collect()}
    acts = spark.createDataFrame([("p-1", 0, f, int(f >= 290)) for f in range(0, 352)], "part string, ep_idx int, frame int, attack int")
    act = pipelines.build_from_actions(o, acts)
    assert act.dataset.images.count() == 0  # frames before the attack have no mask here
    assert pipelines.near_centre(o, 0.1).count() == 33 and pipelines.near_centre(o, 0).count() == 34


def test_evaluate_and_report(spark):
    truth = spark.createDataFrame([("a", "img", "find the trunk", "tree_trunk", [.4, .4, .6, .6]), ("b", "img", "p", "cow", [0.0, 0.0, .1, .1])], "task string, image string, prompt string, label string, bbox array<double>")
    pred = spark.createDataFrame([("a", 0, .5, .5, .2, .2, .9), ("a", 1, .1, .1, .1, .1, .3)], "task string, query int, cx double, cy double, w double, h double, score double")
    res, s = pipelines.evaluate(truth, pred)
    assert {r["task"]: round(r["iou"], 6) for r in res.collect()} == {"a": 1.0, "b": 0.0} and s.first()["detection_rate"] == .5
    detect = lambda asked: asked.where("style = 'aligned' AND prompt = 'oak log'").select("task", "style", F.lit(0).alias("query"), F.lit(.5).alias("cx"), F.lit(.5).alias("cy"), F.lit(.2).alias("w"), F.lit(.2).alias("h"), F.lit(.9).alias("score"))
    styles = {r["task"]: (r["original"], round(r["gain"], 6)) for r in pipelines.evaluate_styles(truth, detect).collect()}
    assert styles == {"a": (0.0, 1.0), "b": (0.0, 0.0)}
    a, _ = two(spark)
    report = pipelines.quality_report(a)
    assert report["density"].first()["per_image"] == 1.0 and report["stats"].count() == 3 and report["verdicts"].count() == 1
    cap = pipelines.training_captions(a, 1).collect()
    assert all(r["caption"].endswith(" .") and len(r["spans"]) == 2 for r in cap)


def test_suspicious_tags(spark):
    r = spark.createDataFrame([(0.0, 0.0, 600.0, 300.0, 640, 360), (300.0, 160.0, 40.0, 40.0, 640, 360), (5.0, 5.0, 8.0, 20.0, 640, 360), (0.0, 330.0, 50.0, 20.0, 640, 360)], "box_x double, box_y double, box_w double, box_h double, width int, height int")
    got = [x["problems"] for x in quality.geometry(r).select(quality.problems().alias("problems")).collect()]
    assert got == [["very_large_bbox", "full_width", "full_height"], [], ["tiny_bbox", "far_from_center", "possible_gui_top"], ["far_from_center", "possible_gui_bottom"]]


def test_medians_of_many_partitions_against_a_sort(spark):
    import random
    import statistics

    from detlake.operators import quality

    rng = random.Random(3)
    data = [(rng.choice(["a", "b", None]), float(rng.randrange(40)), rng.random() if rng.random() < 0.9 else None) for _ in range(700)] + [("c", 1.0, None)]
    got = quality.medians(spark.createDataFrame(data, "g string, x double, y double").repartition(5), ["g"], ["x", "y"]).collect()
    assert len(got) == 4
    for r in got:
        for m, at in (("x", 1), ("y", 2)):
            v = [d[at] for d in data if d[0] == r["g"] and d[at] is not None]
            assert r[f"median_{m}"] == (statistics.median(v) if v else None)
    assert quality.medians(spark.createDataFrame(data, "g string, x double, y double").where("x < 0"), [], ["x"]).first()["median_x"] is None
