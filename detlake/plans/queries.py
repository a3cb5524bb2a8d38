"""Registered queries, each with the SQL that checks it where SQL can."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import boxes, captions, frames, labels, rle, vectors
from ..operators import align, coco, keys, match, metrics, postprocess, quality, sample, timeline
from ..sources import stores
from ..streaming import events as streaming
from . import pipelines
from .adapters import adapted, sql, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
ORD = ["l_partkey", "l_suppkey", "l_linenumber"]
#: Order of annotations: the four keys of a line item can repeat, its box then tells rows apart.
ANN_ORD = ["image_id", "l_linenumber", "l_partkey", "l_suppkey", "box_x", "box_w", "box_h"]


def query(oracle: str | None = None):
    """Register a query under its function's name."""

    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


def _r(c, n: int = 6):
    return F.round(c, n)


def _truth() -> boxes.Box:
    return boxes.box("gx1", "gy1", "gx2", "gy2")


def _predicted() -> boxes.Box:
    return boxes.box("px1", "py1", "px2", "py2")


_INTER = "greatest(least(gx2, px2) - greatest(gx1, px1), 0) * greatest(least(gy2, py2) - greatest(gy1, py1), 0)"
_UNION = f"((gx2 - gx1) * (gy2 - gy1) + (px2 - px1) * (py2 - py1) - {_INTER})"
_HULL = "((greatest(gx2, px2) - least(gx1, px1)) * (greatest(gy2, py2) - least(gy1, py1)))"
_IOU = f"CASE WHEN has_prediction AND {_UNION} > 0 THEN {_INTER} / {_UNION} ELSE 0 END"


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored predictions: a missing box has IoU 0."""
    b = adapted(spark, sf_dir, "boxes")
    return b.withColumn("iou", F.when(F.col("has_prediction"), boxes.iou(_truth(), _predicted())).otherwise(0.0))


@query(f"""SELECT round(avg(iou), 6) AS mean_iou, round(avg(has_prediction::INT), 6) AS detection_rate, count(*) AS total, round(avg((iou >= 0.25)::INT), 6) AS acc_25,
  round(avg((iou >= 0.5)::INT), 6) AS acc_50, round(avg((iou >= 0.75)::INT), 6) AS acc_75 FROM (SELECT has_prediction, {_IOU} AS iou FROM {sql("boxes")})""")
def iou_summary(spark, sf_dir):
    s = metrics.summary(results(spark, sf_dir))
    acc = [_r(F.element_at("accuracy", str(t))).alias(f"acc_{int(t * 100)}") for t in metrics.LEVELS]
    return s.select(_r("mean_iou").alias("mean_iou"), _r("detection_rate").alias("detection_rate"), "total", *acc)


@query(f"""SELECT l_returnflag, threshold, round(avg((iou >= threshold)::INT), 6) AS accuracy FROM (SELECT l_returnflag, {_IOU} AS iou FROM {sql("boxes")}),
  (VALUES (0.25e0), (0.5e0), (0.75e0)) t(threshold) GROUP BY ALL""")
def accuracy_by_threshold(spark, sf_dir):
    return metrics.accuracy_long(results(spark, sf_dir), keys=["l_returnflag"]).withColumn("accuracy", _r("accuracy"))


@query(f"""SELECT CASE WHEN iou >= 0.75 THEN '>=0.75' WHEN iou >= 0.5 THEN '>=0.5' WHEN iou >= 0.25 THEN '>=0.25' ELSE '<0.25' END AS band, count(*) AS n FROM (SELECT {_IOU} AS iou FROM {sql("boxes")}) GROUP BY 1""")
def iou_bands(spark, sf_dir):
    return results(spark, sf_dir).groupBy(boxes.iou_band(F.col("iou")).alias("band")).agg(F.count("*").alias("n"))


@query(f"""SELECT l_returnflag, round(avg({_INTER} / ({_UNION} + 1e-6)), 6) AS iou_eps, round(avg({_INTER} / {_UNION}), 6) AS iou_raw,
  round(avg({_INTER} / {_UNION} - ({_HULL} - {_UNION}) / {_HULL}), 6) AS giou, round(avg({_INTER} / ({_UNION} + 1e-6) - ({_HULL} - {_UNION}) / ({_HULL} + 1e-6)), 6) AS giou_eps FROM {sql("boxes")} GROUP BY 1""")
def iou_variants(spark, sf_dir):
    return adapted(spark, sf_dir, "boxes").groupBy("l_returnflag").agg(
        _r(F.avg(boxes.iou_eps(_truth(), _predicted()))).alias("iou_eps"), _r(F.avg(boxes.iou_raw(_truth(), _predicted()))).alias("iou_raw"), _r(F.avg(boxes.giou(_truth(), _predicted()))).alias("giou"), _r(F.avg(boxes.giou(_truth(), _predicted(), 1e-6))).alias("giou_eps")
    )


@query(f"""SELECT l_linenumber, round(sum((gx1 + gx2) / 2), 4) AS cx, round(sum(gy2 - gy1), 4) AS h, round(sum(1 - gx2), 4) AS flipped_x1, round(sum(gx1 * 640), 4) AS px,
  round(sum(greatest(0, least(gx2 * 640, 640))), 4) AS clamped_x2, round(sum(greatest(0, least(gx2 - 0.1, 0.5)) - greatest(0, least(gx1 - 0.1, 0.5))), 4) AS cropped_w FROM {sql("boxes")} GROUP BY 1""")
def box_transforms(spark, sf_dir):
    one, px = F.lit(1.0), boxes.denormalise(_truth(), 640, 360)
    cut = boxes.crop(_truth(), 0.1, 0.1, 0.5, 0.5)
    return adapted(spark, sf_dir, "boxes").groupBy("l_linenumber").agg(
        _r(F.sum(boxes.to_cxcywh(_truth())[0]), 4).alias("cx"), _r(F.sum(boxes.to_cxcywh(_truth())[3]), 4).alias("h"), _r(F.sum(boxes.flip(_truth(), one).x1), 4).alias("flipped_x1"),
        _r(F.sum(px.x1), 4).alias("px"), _r(F.sum(boxes.clamp(px, 640, 360).x2), 4).alias("clamped_x2"), _r(F.sum(cut.x2 - cut.x1), 4).alias("cropped_w"),
    )


@query("""SELECT o_orderkey AS id, w, h, CASE WHEN least(w, h) = s THEN w WHEN w < h THEN s ELSE floor(s * greatest(w, h) / least(w, h))::INT END AS new_w,
  CASE WHEN least(w, h) = s THEN h WHEN w < h THEN floor(s * greatest(w, h) / least(w, h))::INT ELSE s END AS new_h,
  floor((w - floor(w * 0.4e0)) / 2)::DOUBLE AS crop_x, floor(w * 0.4e0)::DOUBLE AS crop_w FROM (
  SELECT *, CASE WHEN greatest(w, h) / least(w, h)::DOUBLE * 800 > 1333 THEN round_even(1333 * least(w, h) / greatest(w, h)::DOUBLE, 0)::INT ELSE 800 END AS s FROM (
  SELECT o_orderkey, (200 + o_orderkey % 900)::INT AS w, (150 + o_custkey % 700)::INT AS h FROM orders))""")
def resize_sizes(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), (200 + F.col("o_orderkey") % 900).cast("int").alias("w"), (150 + F.col("o_custkey") % 700).cast("int").alias("h"))
    w, h = boxes.resized(F.col("w"), F.col("h"), 800, 1333)
    c = boxes.centre_crop_box(F.col("w"), F.col("h"), 0.4)
    return o.select("id", "w", "h", w.alias("new_w"), h.alias("new_h"), c[0].alias("crop_x"), c[2].alias("crop_w"))


_GEO = f"""(SELECT *, box_w / width AS rel_w, box_h / height AS rel_h, box_w * box_h / (width * height) AS coverage,
  sqrt(pow(box_x + box_w / 2 - width / 2e0, 2) + pow(box_y + box_h / 2 - height / 2e0, 2)) / sqrt(pow(width / 2e0, 2) + pow(height / 2e0, 2)) AS centre_offset FROM {sql("annotations")})"""
_TAGS = f"""(SELECT *, list_filter([CASE WHEN coverage > 0.5 THEN 'very_large_bbox' END, CASE WHEN rel_w > 0.8 THEN 'full_width' END, CASE WHEN rel_h > 0.8 THEN 'full_height' END,
  CASE WHEN box_w < 10 OR box_h < 10 THEN 'tiny_bbox' END, CASE WHEN centre_offset > 0.6 THEN 'far_from_center' END, CASE WHEN box_y < 30 AND box_h < height * 0.3e0 THEN 'possible_gui_top' END,
  CASE WHEN box_y + box_h > height - 50 AND box_h < height * 0.3e0 THEN 'possible_gui_bottom' END], lambda x: x IS NOT NULL) AS problems FROM {_GEO})"""


@query(f"""SELECT category, count(*) AS n, round(avg(rel_w), 4) AS mean_rel_w, round(median(rel_w), 6) AS median_rel_w, round(stddev_pop(rel_w), 6) AS std_rel_w,
  round(avg(coverage), 6) AS mean_coverage, round(median(coverage), 6) AS median_coverage, round(median(centre_offset), 6) AS median_centre_offset, round(stddev_pop(centre_offset), 6) AS std_centre_offset
  FROM {_GEO} GROUP BY GROUPING SETS ((), (category))""")
def bbox_stats_grouping(spark, sf_dir):
    s = quality.box_stats(adapted(spark, sf_dir, "annotations"))
    cols = ["mean_rel_w", "median_rel_w", "std_rel_w", "mean_coverage", "median_coverage", "median_centre_offset", "std_centre_offset"]
    return s.select("category", "n", *[_r(c, 4 if c == "mean_rel_w" else 6).alias(c) for c in cols])


@query(f"SELECT image_id, l_partkey, l_suppkey, l_linenumber, array_to_string(problems, ',') AS problems FROM {_TAGS} WHERE len(problems) > 0")
def suspicious_flags(spark, sf_dir):
    return quality.suspicious(adapted(spark, sf_dir, "annotations")).select("image_id", *ORD, F.array_join("problems", ",").alias("problems"))


@query(f"SELECT problem, count(*) AS n FROM (SELECT unnest(problems) AS problem FROM {_TAGS}) GROUP BY 1")
def problem_counts(spark, sf_dir):
    return quality.problem_counts(quality.suspicious(adapted(spark, sf_dir, "annotations")))


@query(f"""SELECT round(bias, 6) AS bias, round(large, 6) AS large_share, round(bad, 6) AS suspicious_pct, CASE WHEN bias < 0.15 THEN 'GOOD' WHEN bias < 0.25 THEN 'OK' ELSE 'WARN' END AS bias_verdict,
  CASE WHEN large < 0.1 THEN 'GOOD' ELSE 'WARN' END AS large_verdict, CASE WHEN bad < 10 THEN 'GOOD' WHEN bad < 25 THEN 'OK' ELSE 'WARN' END AS suspicious_verdict
  FROM (SELECT avg(centre_offset) AS bias, avg((coverage > 0.3)::INT) AS large, 100 * avg((len(problems) > 0)::INT) AS bad FROM {_TAGS})""")
def quality_verdicts(spark, sf_dir):
    v = quality.verdicts(adapted(spark, sf_dir, "annotations"))
    return v.select(*[_r(c).alias(c) for c in ("bias", "large_share", "suspicious_pct")], "bias_verdict", "large_verdict", "suspicious_verdict")


@query(f"""WITH g AS (SELECT coverage FROM {_GEO}), e AS (SELECT min(coverage) AS lo, max(coverage) AS hi FROM g),
  n AS (SELECT least(floor((coverage - lo) / ((hi - lo) / 30)), 29)::INT AS bin, count(*) AS n FROM g, e GROUP BY 1)
  SELECT b::INT AS bin, round(lo + b * ((hi - lo) / 30), 6) AS lo, round(lo + (b + 1) * ((hi - lo) / 30), 6) AS hi, coalesce(n, 0) AS n FROM e, range(30) t(b) LEFT JOIN n ON n.bin = b""")
def coverage_histogram(spark, sf_dir):
    h = quality.histogram(quality.geometry(adapted(spark, sf_dir, "annotations")), "coverage")
    return h.select("bin", _r("lo").alias("lo"), _r("hi").alias("hi"), "n")


@query("""SELECT min(l_quantity) AS min_l_quantity, median(l_quantity) AS median_l_quantity, max(l_quantity) AS max_l_quantity,
  (SELECT min(l_orderkey) FROM lineitem WHERE l_quantity = (SELECT min(l_quantity) FROM lineitem)) AS argmin_l_quantity,
  (SELECT min(l_orderkey) FROM lineitem WHERE l_quantity = (SELECT max(l_quantity) FROM lineitem)) AS argmax_l_quantity FROM lineitem""")
def box_extremes(spark, sf_dir):
    return quality.extremes(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_quantity")


def dataset(spark: SparkSession, sf_dir: str, status: str | None = None) -> coco.Dataset:
    """A detection dataset from orders (images), line items (annotations) and part types (categories)."""
    o = table(spark, sf_dir, "orders")
    o = o if status is None else o.where(F.col("o_orderstatus") == status)
    images = o.select(F.col("o_orderkey").alias("id"), F.format_string("img_%d.png", "o_orderkey").alias("file_name"), F.lit(640).alias("width"), F.lit(360).alias("height"))
    a = adapted(spark, sf_dir, "annotations").join(images.select(F.col("id").alias("image_id")), "image_id", "left_semi")
    names = table(spark, sf_dir, "part").select(F.col("p_type").alias("category")).distinct()
    cats = keys.dense_numbers(names, [F.col("category")], "id", 101)
    fact = a.join(F.broadcast(cats), "category")
    ann = keys.dense_numbers(fact.withColumnRenamed("id", "category_id"), [F.col(c) for c in ANN_ORD], "id", 1)
    ann = ann.select("id", "image_id", "category_id", F.array("box_x", "box_y", "box_w", "box_h").alias("bbox"), (F.col("box_w") * F.col("box_h")).alias("area"), F.lit(0).alias("iscrowd"), F.lit(None).cast("string").alias("event_type"))
    return coco.Dataset(images, ann, cats.select("id", F.col("category").alias("name"), F.lit("object").alias("supercategory")))


_CATS = "(SELECT category, 100 + row_number() OVER (ORDER BY category) AS id FROM (SELECT DISTINCT p_type AS category FROM part))"
_ANN = f"(SELECT row_number() OVER (ORDER BY image_id, l_linenumber, l_partkey, l_suppkey, box_x, box_w, box_h) AS id, image_id, c.id AS category_id, c.category, box_w * box_h AS area FROM {sql('annotations')} a JOIN {_CATS} c USING (category))"


@query(f"""WITH c AS {_CATS}, a AS (SELECT CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS so, * FROM {sql("annotations")} x JOIN orders ON o_orderkey = image_id JOIN c USING (category) WHERE o_orderstatus IN ('F', 'O', 'P')),
  i AS (SELECT o_orderkey, o_orderstatus, row_number() OVER (ORDER BY CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END, o_orderkey) AS new_id FROM orders WHERE o_orderstatus IN ('F', 'O', 'P'))
  SELECT row_number() OVER (ORDER BY so, image_id, l_linenumber, l_partkey, l_suppkey, box_x, box_w, box_h) AS id, i.new_id AS image_id, (c2.rn)::BIGINT AS category_id, round(box_w * box_h, 4) AS area, a.o_orderstatus || '_img_' || a.image_id || '.png' AS file_name
  FROM a JOIN i ON i.o_orderkey = a.image_id JOIN (SELECT category, row_number() OVER (ORDER BY id) AS rn FROM c) c2 USING (category)""")
def merge_datasets(spark, sf_dir):
    merged, _ = coco.merge([(s, dataset(spark, sf_dir, s)) for s in ("F", "O", "P")])
    return merged.annotations.join(merged.images.select(F.col("id").alias("image_id"), "file_name"), "image_id").select("id", "image_id", "category_id", _r("area", 4).alias("area"), "file_name")


@query("""SELECT o_orderstatus AS src, count(DISTINCT o_orderkey) AS images, (SELECT count(*) FROM lineitem JOIN orders o ON o.o_orderkey = l_orderkey WHERE o.o_orderstatus = orders.o_orderstatus) AS annotations
  FROM orders WHERE o_orderstatus IN ('F', 'O', 'P') GROUP BY 1""")
def merge_counts(spark, sf_dir):
    return coco.source_counts([(s, dataset(spark, sf_dir, s)) for s in ("F", "O", "P")] + [("missing", None)])


@query(f"""WITH f AS (SELECT *, image_id % 500 AS file FROM {sql("annotations")}), i AS (SELECT file, row_number() OVER (ORDER BY m) AS image_id FROM (SELECT file, min((image_id, l_linenumber, l_partkey, l_suppkey, box_x, box_w, box_h)) AS m FROM f GROUP BY file)),
  c AS (SELECT category, row_number() OVER (ORDER BY m) AS category_id FROM (SELECT category, min((image_id, l_linenumber, l_partkey, l_suppkey, box_x, box_w, box_h)) AS m FROM f GROUP BY category))
  SELECT row_number() OVER (ORDER BY f.image_id, l_linenumber, l_partkey, l_suppkey, box_x, box_w, box_h) AS id, i.image_id, category_id, round(box_w * 224 / 640 * (box_h * 224 / 360), 4) AS area FROM f JOIN i USING (file) JOIN c USING (category)""")
def build_dataset(spark, sf_dir):
    a = adapted(spark, sf_dir, "annotations").withColumn("image_file", F.format_string("f%d.png", F.col("image_id") % 500)).select("*", F.array("box_x", "box_y", "box_w", "box_h").alias("bbox"), F.lit(224).alias("image_width"), F.lit(224).alias("image_height"))
    ds = coco.build(a, ANN_ORD, size=(360, 640))
    return ds.annotations.select("id", "image_id", "category_id", _r("area", 4).alias("area"))


@query(f"""WITH a AS {_ANN}, k AS (SELECT category_id FROM (SELECT category_id, count(*) AS n, min(id) AS f FROM a GROUP BY 1) WHERE n >= 50 ORDER BY n DESC, f LIMIT 4),
  r AS (SELECT * FROM (SELECT a.*, row_number() OVER (PARTITION BY category_id ORDER BY id) AS rn FROM a SEMI JOIN k USING (category_id)) WHERE rn <= 300)
  SELECT row_number() OVER (ORDER BY id) AS id, dense_rank() OVER (ORDER BY image_id) AS image_id, dense_rank() OVER (ORDER BY category_id) AS category_id, round(area, 4) AS area FROM r""")
def subsample_capped(spark, sf_dir):
    ds = dataset(spark, sf_dir)
    out = sample.subsample(ds.annotations, ds.images, ds.categories, max_per_cat=300, min_per_cat=50, top_k=4, order=["id"])
    return out["annotations"].select("id", "image_id", "category_id", _r("area", 4).alias("area"))


@query("""SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type, date_trunc('day', ts) ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1""")
def first_wins_dedup(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("day", F.date_trunc("day", "ts"))
    return keys.first_wins(e, ["user_id", "event_type", "day"], ["ts", "event_id"]).select("user_id", "event_type", "event_id", "value")


@query("""SELECT user_id, event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""")
def last_wins_dedup(spark, sf_dir):
    return keys.last_wins(table(spark, sf_dir, "events"), ["user_id", "event_type"], ["ts", "event_id"]).select("user_id", "event_type", "event_id")


@query("SELECT p_brand, row_number() OVER (ORDER BY f) AS id FROM (SELECT p_brand, min(p_partkey) AS f FROM part GROUP BY 1)")
def surrogate_ids(spark, sf_dir):
    return keys.surrogate_keys(table(spark, sf_dir, "part"), ["p_brand"], ["p_partkey"])


@query("SELECT id, l_orderkey FROM (SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_returnflag) AS id, * FROM lineitem) WHERE l_returnflag <> 'R'")
def gapped_ids(spark, sf_dir):
    return keys.gapped_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag"], F.col("l_returnflag") != "R").select("id", "l_orderkey")


@query("SELECT o_orderkey, coalesce(s_suppkey + 100000, o_custkey) AS o_custkey FROM orders LEFT JOIN supplier ON s_suppkey = o_custkey")
def key_remap(spark, sf_dir):
    m = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("old"), (F.col("s_suppkey") + 100000).alias("new"))
    return keys.remap(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), "o_custkey", m, "old", "new")


@query("SELECT count(*) AS unmatched FROM orders WHERE o_custkey NOT IN (SELECT s_suppkey FROM supplier)")
def key_unmatched(spark, sf_dir):
    return keys.unmatched(table(spark, sf_dir, "orders"), "o_custkey", table(spark, sf_dir, "supplier"), "s_suppkey")


@query(f"""WITH t AS {sql("timeline")}, i AS (SELECT *, max(CASE WHEN attack = 0 THEN frame END) OVER (PARTITION BY ep_idx ORDER BY frame) AS idle FROM t)
  SELECT ep_idx, frame, coalesce(idle + 1, 0)::INT AS start, CASE WHEN coalesce(idle + 1, 0) <= frame AND frame - coalesce(idle + 1, 0) <= 5 THEN coalesce(idle + 1, 0) ELSE frame END::INT AS anchor FROM i""")
def attack_start(spark, sf_dir):
    t = adapted(spark, sf_dir, "timeline")
    s = timeline.attack_starts(t.select("ep_idx", "frame", "attack"), t.select("ep_idx", "frame"))
    return s.withColumn("anchor", frames.anchor(F.col("start"), F.col("frame"), 5).cast("int"))


@query("""WITH w AS (SELECT event_id, (event_id % 500)::INT AS s, (event_id % 500 + event_id % 37)::INT AS e FROM events),
  u AS (SELECT *, greatest(s, e - 4) - s + 1 AS usable FROM w), n AS (SELECT *, least(4, usable) AS k FROM u)
  SELECT event_id, array_to_string(list_transform(range(k), lambda i: s + round_even(i * CASE WHEN k > 1 THEN (usable - 1) / (k - 1)::DOUBLE ELSE 0 END, 0)::INT), ',') AS training,
  array_to_string(range(greatest(0, s - 8), s), ',') AS pre, array_to_string(range(s, least(s + 8, e)), ',') AS early,
  array_to_string(range(greatest(greatest(e - 8, s) - 4, s), greatest(e - 8, s)), ',') AS back, array_to_string(range(greatest(s, e - 2), e + 1), ',') AS trailing FROM n""")
def frame_selection(spark, sf_dir):
    w = table(spark, sf_dir, "events").select("event_id", (F.col("event_id") % 500).cast("int").alias("s"), (F.col("event_id") % 500 + F.col("event_id") % 37).cast("int").alias("e"))
    s, e = F.col("s"), F.col("e")
    text = lambda a: F.array_join(a.cast("array<string>"), ",")
    return w.select("event_id", text(frames.training(s, e)).alias("training"), text(frames.before(s)).alias("pre"), text(frames.early(s, e)).alias("early"), text(frames.backtrack(s, e)).alias("back"), text(frames.trailing(s, e, 3)).alias("trailing"))


_OFF = f"""(SELECT episode, path, sum(n_frames) OVER w - n_frames AS start, sum(n_frames) OVER w AS "end" FROM (SELECT DISTINCT episode, regexp_extract(episode, '^(.*)-(\\d+)$', 1) AS pre, regexp_extract(episode, '^(.*)-(\\d+)$', 2) AS from_ts FROM {sql("episodes")}) e
  JOIN (SELECT *, regexp_extract(stem, '^(.*)-(\\d+)$', 1) AS pre, regexp_extract(stem, '^(.*)-(\\d+)$', 2) AS ts FROM {sql("videos")} WHERE n_frames > 0) v USING (pre) WHERE ts >= from_ts WINDOW w AS (PARTITION BY episode ORDER BY ts, stem, path))"""


@query(f"""SELECT r.episode, r.frame, o.path, (r.frame - o.start)::BIGINT AS local FROM (SELECT episode, (ep_idx * 7 + f * 13) % 400 AS frame FROM (SELECT DISTINCT episode, ep_idx FROM {sql("episodes")}), range(8) t(f)) r
  LEFT JOIN {_OFF} o ON r.episode = o.episode AND r.frame >= o.start AND r.frame < o."end" """)
def offset_lookup(spark, sf_dir):
    e = adapted(spark, sf_dir, "episodes")
    req = e.select("episode", "ep_idx").distinct().select("episode", F.explode(F.transform(F.sequence(F.lit(0), F.lit(7)), lambda f: ((F.col("ep_idx") * 7 + f * 13) % 400).cast("long"))).alias("frame"))
    return align.locate(req, align.offset_table(adapted(spark, sf_dir, "videos"), e))


@query("""WITH s AS (SELECT DISTINCT 'part-' || (s_suppkey * 13 % 997)::VARCHAR AS p, s_suppkey * 13 % 997 AS n FROM supplier), q AS (SELECT DISTINCT 'part-' || (n_nationkey * 41)::VARCHAR AS p, n_nationkey * 41 AS n FROM nation)
  SELECT seg_part, src_part, gap::INT AS gap FROM (SELECT s.p AS seg_part, q.p AS src_part, abs(s.n - q.n) AS gap, row_number() OVER (PARTITION BY s.p ORDER BY abs(s.n - q.n), q.p) AS rn FROM s, q) WHERE rn = 1""")
def nearest_partition(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select(F.format_string("part-%d", F.col("s_suppkey") * 13 % 997).alias("part"))
    q = table(spark, sf_dir, "nation").select(F.format_string("part-%d", F.col("n_nationkey") * 41).alias("part"))
    return align.nearest_partition(s, q)


@query("SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderpriority LIKE '1%') GROUP BY 1")
def gui_anti(spark, sf_dir):
    flags = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderpriority").startswith("1").alias("flagged"))
    return align.without_flagged(table(spark, sf_dir, "lineitem").select("l_orderkey"), flags, ["l_orderkey"]).groupBy("l_orderkey").agg(F.count("*").alias("n"))


@query("SELECT count(*) AS n, round(sum(l_quantity), 2) AS q FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')")
def episode_semi(spark, sf_dir):
    matched = table(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("l_orderkey"))
    return align.matched_only(table(spark, sf_dir, "lineitem"), matched, ["l_orderkey"]).agg(F.count("*").alias("n"), _r(F.sum("l_quantity"), 2).alias("q"))


@query(f"""WITH e AS {sql("episodes")}, i AS (SELECT episode, part, ep_idx FROM (SELECT substr(episode, 1, 14) AS episode, part, ep_idx, row_number() OVER (PARTITION BY substr(episode, 1, 14) ORDER BY part DESC, ep_idx DESC) AS rn FROM e) WHERE rn = 1)
  SELECT substr(e.episode, 1, 14) AS episode, e.part AS seg_part, e.ep_idx AS seg_ep, i.part AS img_part, i.ep_idx AS img_ep FROM e JOIN i ON substr(e.episode, 1, 14) = i.episode""")
def aligned_episodes(spark, sf_dir):
    e = adapted(spark, sf_dir, "episodes").withColumn("episode", F.substring("episode", 1, 14))
    return align.align_episodes(e, e)


@query(f"""WITH o AS {sql("observations")}, l AS (SELECT part, ep_idx, event, frame, rle FROM (SELECT *, row_number() OVER (PARTITION BY part, ep_idx, event, frame ORDER BY key_frame DESC) AS rn FROM o) WHERE rn = 1),
  f AS (SELECT DISTINCT part, ep_idx, event, frame FROM o) SELECT f.part, f.ep_idx, f.event, f.frame, l.rle FROM f JOIN l USING (part, ep_idx, event, frame)""")
def frame_masks(spark, sf_dir):
    o = adapted(spark, sf_dir, "observations")
    return align.frames_with_masks(o.select("part", "ep_idx", "event", "frame").distinct(), o).select("part", "ep_idx", "event", "frame", "rle")


@query(f"""WITH o AS {sql("observations")}, r AS (SELECT DISTINCT part, ep_idx, frame, 'c' AS event FROM o), h AS (SELECT r.*, o.rle, row_number() OVER (PARTITION BY r.part, r.ep_idx, r.frame ORDER BY o.key_frame, o.event) AS rn
  FROM r JOIN o USING (part, ep_idx, frame) WHERE o.event = r.event OR contains(o.key_frame::VARCHAR || ',' || o.event, r.event)) SELECT part, ep_idx, frame, rle FROM h WHERE rn = 1""")
def mask_lookup(spark, sf_dir):
    o = adapted(spark, sf_dir, "observations")
    req = o.select("part", "ep_idx", "frame").distinct().withColumn("event", F.lit("c"))
    return align.mask_by_event(req, o).select("part", "ep_idx", "frame", "rle")


@query(f"""WITH t AS {sql("timeline")}, c AS (SELECT ep_idx, frame - frame % 32 AS frame_offset, count(*) AS n FROM t GROUP BY ALL) SELECT t.ep_idx, t.frame, (t.frame - t.frame % 32)::INT AS frame_offset, (t.frame % 32)::INT AS local, c.n FROM t JOIN c ON c.ep_idx = t.ep_idx AND c.frame_offset = t.frame - t.frame % 32""")
def chunk_lookup(spark, sf_dir):
    t = adapted(spark, sf_dir, "timeline").withColumn("part", F.lit("p"))
    chunks = t.groupBy("part", "ep_idx", labels.chunk_of(F.col("frame"))[0].alias("frame_offset")).agg(F.count("*").alias("n"))
    return align.point_lookup(t.select("part", "ep_idx", "frame"), chunks).select("ep_idx", "frame", "frame_offset", "local", "n")


@query("""SELECT user_id, min(CASE WHEN value > p THEN event_id END) AS first_frame FROM (SELECT user_id, event_id, value, lag(value, 1, 0) OVER (PARTITION BY user_id ORDER BY event_id) AS p FROM events) GROUP BY 1""")
def change_detect(spark, sf_dir):
    return timeline.first_increase(table(spark, sf_dir, "events"), ["user_id"], "event_id", "value")


@query("""SELECT event_id, list_sort(list(value) OVER w)[(len(list(value) OVER w) + 1) // 2] AS median, round(avg(value) OVER w, 6) AS mean, max(value) OVER w AS max,
  round(sum(value) OVER a / (count(value) OVER a + 1e-6), 6) AS global_mean FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS 19 PRECEDING), a AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""")
def moving_stats(spark, sf_dir):
    m = timeline.moving_stats(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], "value")
    return m.select("event_id", "median", _r("mean").alias("mean"), "max", _r("global_mean").alias("global_mean"))


@query("""SELECT event_id, max(value) OVER w AS best, value > max(value) OVER p OR max(value) OVER p IS NULL AS is_best FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING),
  p AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""")
def running_best(spark, sf_dir):
    return timeline.best_so_far(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], "value").select("event_id", "best", "is_best")


_L1 = """CASE WHEN event = '' THEN NULL WHEN contains(s, ':') THEN CASE WHEN split_part(s, ':', 1) IN ('custom', 'open_chest', 'craft') THEN NULL ELSE nullif(trim(substr(s, instr(s, ':') + 1)), '') END
  WHEN s IN ('right_click', 'landmark', 'attack', 'craft') THEN NULL ELSE nullif(trim(s), '') END"""
_L2 = """CASE WHEN event = '' THEN NULL WHEN contains(s, ':') THEN CASE WHEN split_part(s, ':', 1) IN ('custom', 'open_chest', 'craft') THEN NULL ELSE trim(split_part(s, ':', -1)) END
  WHEN s IN ('right_click', 'landmark', 'attack', 'craft') THEN NULL ELSE trim(s) END"""


@query(f"SELECT event_id, {_L1} AS first_label, {_L2} AS last_label FROM (SELECT *, replace(event, 'minecraft.', '') AS s FROM {sql('labels')})")
def event_labels(spark, sf_dir):
    e = F.col("event")
    return adapted(spark, sf_dir, "labels").select("event_id", labels.event_label(e).alias("first_label"), labels.event_label(e, "last").alias("last_label"))


@query(f"SELECT {_L1} AS label, count(*) AS n FROM (SELECT *, replace(event, 'minecraft.', '') AS s FROM {sql('labels')}) GROUP BY 1 ORDER BY n DESC, label NULLS FIRST LIMIT 20")
def label_counts(spark, sf_dir):
    return quality.label_counts(adapted(spark, sf_dir, "labels").select(labels.event_label(F.col("event")).alias("label")), "label")


@query(f"""SELECT episode, regexp_extract(episode, '^(.*)-(\\d+)$', 1) AS prefix, regexp_extract(episode, '^(.*)-(\\d+)$', 2) AS ts, (ep_idx % 7 * 50)::INT AS part_n, format('ds_{{}}_ep{{}}_f{{:06d}}.png', part, ep_idx, ep_idx) AS file FROM {sql("episodes")}""")
def episode_names(spark, sf_dir):
    e = adapted(spark, sf_dir, "episodes").withColumn("p", labels.episode_prefix(F.col("episode")))
    return e.select("episode", "p.prefix", "p.ts", labels.part_number(F.col("part")).alias("part_n"), labels.frame_file(F.lit("ds"), F.col("part"), F.col("ep_idx"), F.col("ep_idx")).alias("file"))


@query("""WITH w AS (SELECT p_partkey, lower(replace(p_name, '_', ' ')) AS n FROM part), b AS (SELECT p_partkey // 10 AS g, n, p_partkey, sum(length(n) + 3) OVER (PARTITION BY p_partkey // 10 ORDER BY p_partkey) - length(n) - 3 AS pos FROM w)
  SELECT g, string_agg(n || ' .', ' ' ORDER BY p_partkey) AS caption, max(pos)::INT AS last_start FROM b GROUP BY g""")
def caption_spans(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.floor(F.col("p_partkey") / 10).alias("g"), F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))
    made = p.groupBy("g").agg(F.array_sort(F.collect_list(F.struct("id", "name"))).alias("c")).withColumn("m", captions.caption_and_spans(F.col("c")))
    return made.select("g", "m.caption", F.element_at(F.element_at("m.spans", -1)["spans"], 1)["beg"].alias("last_start"))


@query("""SELECT p_partkey, CASE WHEN contains(p_name, 'green') THEN 0 WHEN contains(p_name, 'red') THEN 1 WHEN contains(p_name, 'blue') THEN 2 WHEN contains(p_name, 'e') THEN 3 END::INT AS class_id,
  CASE WHEN ends_with(lower(trim(p_name)), '.') THEN lower(trim(p_name)) ELSE lower(trim(p_name)) || '.' END AS caption FROM part""")
def phrase_classes(spark, sf_dir):
    classes = F.array(*map(F.lit, ("green", "red", "blue", "e")))
    return table(spark, sf_dir, "part").select("p_partkey", labels.phrase_class(F.col("p_name"), classes).alias("class_id"), labels.caption_text(F.col("p_name")).alias("caption"))


@query("""WITH t AS (SELECT doc_id, unnest(list_transform(string_split(text, ' '), lambda w: ends_with(w, '.')::INT)) AS sep, generate_subscripts(string_split(text, ' '), 1) AS i FROM documents),
  s AS (SELECT *, coalesce(sum(sep) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS seg FROM t)
  SELECT doc_id, max(seg)::INT AS last_segment, max(n)::INT AS longest FROM (SELECT doc_id, seg, count(*) AS n FROM s GROUP BY ALL) GROUP BY doc_id""")
def token_segments(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    ids = F.transform(F.split("text", " "), lambda w: F.when(w.endswith("."), 1012).otherwise(7))
    s = d.select("doc_id", captions.token_segments(ids, (1012,)).alias("s"))
    return s.select("doc_id", F.array_max(F.transform("s", lambda x: x["segment"])).alias("last_segment"), (F.array_max(F.transform("s", lambda x: x["position"])) + 1).alias("longest"))


@query("""SELECT q.vec_id AS query, c.vec_id AS label, round(list_dot_product(q.embedding::DOUBLE[], c.embedding::DOUBLE[]), 6) AS similarity, row_number() OVER (PARTITION BY q.vec_id ORDER BY list_dot_product(q.embedding::DOUBLE[], c.embedding::DOUBLE[]) DESC, c.vec_id)::INT AS rank
  FROM embeddings q, embeddings c WHERE q.vec_id % 100 = 0 QUALIFY rank <= 5""")
def similarity_topk(spark, sf_dir):
    """The stated queries against all rows: a block of rows is a prompt's tokens, and the best labels are taken over all of them."""
    e = table(spark, sf_dir, "embeddings")
    texts = e.groupBy(F.floor(F.col("vec_id") / 512).alias("query")).agg(F.array_sort(F.collect_list(F.struct("vec_id", "embedding"))).alias("t"))
    q = e.where("vec_id % 100 = 0").select(F.col("vec_id").alias("image_id"), "embedding").crossJoin(texts)
    scored = q.select("image_id", "query", F.transform("t", lambda x: vectors.dot(F.col("embedding"), x["embedding"])).alias("label_scores"))
    top = postprocess.top_labels(scored, k=5)
    ids = texts.select("query", F.posexplode(F.transform("t", lambda x: x["vec_id"])).alias("label", "vec_id"))
    return top.join(ids, ["query", "label"]).select(F.col("image_id").alias("query"), F.col("vec_id").alias("label"), _r("score").alias("similarity"), "rank")


_RUNS = f"""(SELECT key_frame, rle, list_transform(string_split(rle, ' '), lambda x: x::INT) AS n FROM {sql("observations")})"""


@query(f"""WITH r AS {_RUNS}, p AS (SELECT key_frame, rle, n[2] + n[4] AS area, [n[1], n[3]] AS s, [least(n[1] + n[2], 230400) - 1, least(n[3] + n[4], 230400) - 1] AS e FROM r),
  b AS (SELECT key_frame, area, list_transform(range(1, 3), lambda i: [s[i] // 640, e[i] // 640, CASE WHEN s[i] // 640 < e[i] // 640 THEN 0 ELSE s[i] % 640 END, CASE WHEN s[i] // 640 < e[i] // 640 THEN 639 ELSE e[i] % 640 END]) AS q FROM p)
  SELECT key_frame, area::BIGINT AS area, least(q[1][3], q[2][3])::DOUBLE AS x, least(q[1][1], q[2][1])::DOUBLE AS y, (greatest(q[1][4], q[2][4]) - least(q[1][3], q[2][3]) + 1)::DOUBLE AS w, (greatest(q[1][2], q[2][2]) - least(q[1][1], q[2][1]) + 1)::DOUBLE AS h FROM b""")
def rle_area_bbox(spark, sf_dir):
    b = rle.bbox(rle.runs(F.col("rle"), 360, 640), 640)
    o = adapted(spark, sf_dir, "observations").select("key_frame", rle.text_area(F.col("rle")).alias("area"), b.alias("b"))
    return o.select("key_frame", "area", *[F.get("b", i).alias(c) for i, c in enumerate("xywh")])


@query()
def component_bbox(spark, sf_dir):
    o = adapted(spark, sf_dir, "observations").withColumn("runs", rle.runs(F.col("rle"), 360, 640))
    o = o.withColumn("part_runs", rle.filter_by_point(F.col("runs"), 360, 640, F.col("point_row"), F.col("point_col")))
    return o.select("key_frame", rle.mask_area(F.col("part_runs")).alias("area"), F.array_join(rle.bbox(F.col("part_runs"), 640).cast("array<string>"), ",").alias("bbox"))


@query(f"""SELECT t.image_id, b.px1 AS x1, coalesce(b.score, 0) AS score FROM (SELECT DISTINCT image_id FROM {sql("boxes")}) t LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY score DESC, l_linenumber, l_partkey, l_suppkey) AS rn FROM {sql("boxes")} WHERE has_prediction) b ON b.image_id = t.image_id AND rn = 1""")
def top_prediction(spark, sf_dir):
    b = adapted(spark, sf_dir, "boxes")
    cx, cy, w, h = boxes.to_cxcywh(_predicted())
    q = F.col("l_linenumber").cast("long") * 10**12 + F.col("l_partkey") * 10**5 + F.col("l_suppkey")
    p = b.where("has_prediction").select("image_id", q.alias("query"), cx.alias("cx"), cy.alias("cy"), w.alias("w"), h.alias("h"), "score", "px1")
    top = postprocess.top_prediction(p, b.select("image_id").distinct())
    back = p.groupBy("image_id").agg(F.max_by("px1", F.struct("score", -F.col("query"))).alias("x1"))
    return top.join(back, "image_id", "left").select("image_id", "x1", "score")


def _pairs(spark, sf_dir) -> DataFrame:
    b = adapted(spark, sf_dir, "boxes")
    row = F.col("l_linenumber").cast("long") * 10**12 + F.col("l_partkey") * 10**5 + F.col("l_suppkey")
    p = b.where("has_prediction").select("image_id", row.alias("query"), "score", _predicted().struct().alias("box"))
    t = b.select("image_id", row.alias("gt_id"), _truth().struct().alias("box"))
    return match.match_costs(match.image_pairs(p, t), F.lit(0.0))


@query(f"""SELECT p.image_id, round(max({_INTER.replace('px', 'p.px').replace('py', 'p.py').replace('gx', 't.gx').replace('gy', 't.gy')} / ({_UNION.replace('px', 'p.px').replace('py', 'p.py').replace('gx', 't.gx').replace('gy', 't.gy')} + 1e-6)), 6) AS best_iou, count(*) AS pairs
  FROM (SELECT * FROM {sql("boxes")} WHERE has_prediction) p JOIN {sql("boxes")} t USING (image_id) GROUP BY 1""")
def image_pairs(spark, sf_dir):
    return _pairs(spark, sf_dir).groupBy("image_id").agg(_r(F.max("iou")).alias("best_iou"), F.count("*").alias("pairs"))


@query()
def optimal_match(spark, sf_dir):
    return match.optimal_match(_pairs(spark, sf_dir)).withColumn("cost", _r("cost"))


@query()
def coco_ap(spark, sf_dir):
    b = adapted(spark, sf_dir, "boxes").withColumn("id", F.col("l_linenumber").cast("long") * 10**12 + F.col("l_partkey") * 10**5 + F.col("l_suppkey"))
    px = lambda x: boxes.denormalise(x, 640, 360).struct().alias("box")
    truth = b.select("image_id", (F.col("l_partkey") % 5).alias("category_id"), "id", px(_truth()), F.lit(0).alias("iscrowd"))
    det = b.where("has_prediction").select("image_id", (F.col("l_partkey") % 5).alias("category_id"), "id", px(_predicted()), "score")
    return match.coco_summary(match.average_precision(match.coco_matches(truth, det)))


@query(f"SELECT l_returnflag, round(avg(CASE WHEN l_linenumber % 2 = 1 THEN 0.25 * ln(1 + exp(-score)) * pow(1 - 1 / (1 + exp(-score)), 2) ELSE 0.75 * (score + ln(1 + exp(-score))) * pow(1 / (1 + exp(-score)), 2) END), 6) AS focal FROM {sql('boxes')} GROUP BY 1")
def focal_loss(spark, sf_dir):
    t = (F.col("l_linenumber") % 2).cast("double")
    return adapted(spark, sf_dir, "boxes").groupBy("l_returnflag").agg(_r(F.avg(vectors.focal_loss(F.col("score"), t))).alias("focal"))


@query("""SELECT * FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events) WHERE rn <= 3""".replace("SELECT *", "SELECT user_id, event_id"))
def first_per_group(spark, sf_dir):
    return sample.first_per_group(table(spark, sf_dir, "events").select("user_id", "event_id"), ["user_id"], 3, ["event_id"])


@query("""SELECT user_id, event_id FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS rn, greatest(1, count(*) OVER (PARTITION BY user_id) // 4) AS step FROM events) WHERE rn % step = 0 AND rn // step < 4""")
def spread_per_group(spark, sf_dir):
    return sample.spread_per_group(table(spark, sf_dir, "events").select("user_id", "event_id"), ["user_id"], 4, ["event_id"])


@query("SELECT user_id, event_id FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY md5(event_id || ':42'), event_id) AS rn FROM events) WHERE rn <= 2")
def sampled_per_group(spark, sf_dir):
    return sample.sample_per_group(table(spark, sf_dir, "events").select("user_id", "event_id"), ["user_id"], 2, ["event_id"])


@query("SELECT o_orderkey FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS i, count(*) OVER () AS t FROM orders) WHERE i IN (SELECT x * t // 50 FROM range(50) r(x))")
def uniform_sample(spark, sf_dir):
    return sample.take_uniform(table(spark, sf_dir, "orders").select("o_orderkey"), 50, ["o_orderkey"])


@query("SELECT o_orderkey, row_number() OVER (ORDER BY md5(o_orderkey || ':42'), o_orderkey) <= greatest(1, floor(count(*) OVER () * 0.1)) AS is_val FROM orders")
def validation_split(spark, sf_dir):
    return sample.validation_split(table(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"])


@query("SELECT o_orderkey, ((row_number() OVER (ORDER BY o_orderkey) - 1) // ceil(count(*) OVER () / 16.0)::BIGINT)::BIGINT AS batch FROM orders")
def worker_batches(spark, sf_dir):
    return sample.batches(table(spark, sf_dir, "orders").select("o_orderkey"), 16, ["o_orderkey"])


@query(f"""WITH c AS (SELECT count(DISTINCT p_type) AS n FROM part), a AS (SELECT image_id, count(DISTINCT category) AS own FROM {sql("annotations")} GROUP BY 1)
  SELECT o_orderkey AS image_id, least(2, c.n - coalesce(own, 0)) AS negatives, least(2, c.n - coalesce(own, 0)) AS lacked FROM orders LEFT JOIN a ON image_id = o_orderkey CROSS JOIN c WHERE coalesce(own, 0) < c.n""")
def negative_categories(spark, sf_dir):
    """How many distinct negatives each image got, and how many of them it lacks indeed."""
    ds = dataset(spark, sf_dir)
    got = sample.negatives(ds.images, ds.annotations, ds.categories, 2)
    has = ds.annotations.select("image_id", "category_id", F.lit(1).alias("has")).distinct()
    return got.join(has, ["image_id", "category_id"], "left").groupBy("image_id").agg(F.countDistinct("category_id").alias("negatives"), F.count_if(F.col("has").isNull()).alias("lacked"))


@query(f"SELECT count(*) FILTER (p AND a) AS tp, count(*) FILTER (p AND NOT a) AS fp, count(*) FILTER (NOT p AND a) AS fn, count(*) FILTER (NOT p AND NOT a) AS tn FROM (SELECT has_prediction AS p, score > 0.4 AS a FROM {sql('boxes')})")
def confusion_counts(spark, sf_dir):
    return metrics.confusion(adapted(spark, sf_dir, "boxes").withColumn("a", F.col("score") > 0.4), "has_prediction", "a")


@query("""WITH s AS (SELECT user_id, max(value) AS max, min(value) AS min, avg(value) AS mean, var_samp(value) AS var, stddev_samp(value) AS std FROM events GROUP BY 1), z AS (SELECT user_id, sum(exp(value - max)) AS z FROM events JOIN s USING (user_id) GROUP BY 1)
  SELECT user_id, max, min, round(mean, 6) AS mean, round(var, 4) AS var, round(std, 6) AS std, round(-sum(exp(value - max) / z * ln(exp(value - max) / z + 1e-9)), 6) + 0.0 AS entropy FROM events JOIN s USING (user_id) JOIN z USING (user_id) GROUP BY ALL""")
def tensor_stats(spark, sf_dir):
    t = metrics.tensor_stats(table(spark, sf_dir, "events"), "value", ["user_id"])
    return t.select("user_id", "max", "min", _r("mean").alias("mean"), _r("var", 4).alias("var"), _r("std").alias("std"), (_r("entropy") + 0.0).alias("entropy"))


@query("SELECT l_returnflag, round(sum(l_discount * l_quantity) / sum(l_quantity), 6) AS mean, sum(l_quantity) AS weight FROM lineitem GROUP BY 1")
def weighted_mean(spark, sf_dir):
    return metrics.weighted_mean(table(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_discount", "l_quantity").withColumn("mean", _r("mean"))


@query("""WITH r AS (SELECT l_orderkey, l_returnflag = 'R' AS hit, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber, l_partkey, l_suppkey) AS k FROM lineitem), b AS (SELECT l_orderkey, min(k) FILTER (hit) AS k FROM r GROUP BY 1)
  SELECT round(100 * avg(coalesce((k <= 1)::INT, 0)), 6) AS p_at_1, round(100 * avg(coalesce((k <= 5)::INT, 0)), 6) AS p_at_5 FROM b""")
def precision_at_k(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem").withColumn("hit", F.col("l_returnflag") == "R")
    p = metrics.precision_at(l, ["l_orderkey"], "l_extendedprice", "hit", (1, 5), ["l_linenumber", "l_partkey", "l_suppkey"])
    return p.select(*[_r(c).alias(c) for c in p.columns])


@query(f"""SELECT c.id AS category_id, a.area, count(m.image_id) AS matches, count(DISTINCT m.image_id) AS images_hit, (SELECT count(*) FROM orders) AS images FROM {_CATS} c CROSS JOIN (VALUES ('small', 0, 1024), ('medium', 1024, 9216), ('large', 9216, 1e10)) a(area, lo, hi)
  LEFT JOIN {_ANN} m ON m.category_id = c.id AND m.area >= a.lo AND m.area < a.hi GROUP BY ALL""")
def evaluation_grid(spark, sf_dir):
    ds = dataset(spark, sf_dir)
    m = ds.annotations.select("image_id", "category_id", F.col("area").alias("box_area"))
    return coco.evaluation_grid(ds.images, ds.categories, match.COCO_AREAS[1:], m).select("category_id", "area", "matches", "images_hit", "images")


@query("""SELECT c_custkey, CASE WHEN kind = 0 THEN 'int' WHEN kind = 1 THEN 'float' WHEN kind = 2 THEN 'bool' WHEN kind = 3 THEN 'null' ELSE 'str' END AS kind FROM (SELECT c_custkey, c_custkey % 5 AS kind FROM customer)""")
def scalar_kinds(spark, sf_dir):
    k = F.col("c_custkey") % 5
    text = F.when(k == 0, F.col("c_custkey").cast("string")).when(k == 1, "1.5").when(k == 2, "True").when(k == 3, "None").otherwise(F.col("c_name"))
    return table(spark, sf_dir, "customer").select("c_custkey", labels.parse_scalar(text)["kind"].alias("kind"))


@query("""SELECT event_id, round(ln(greatest(least(value / 100, 1), 1e-5) / greatest(1 - value / 100, 1e-5)), 6) + 0.0 AS logit, round(sin(value / 100 * (2 * pi())), 6) + 0.0 AS s0, round(cos(value / 100 * (2 * pi()) / pow(10000, 0.5)), 6) AS s3 FROM events""")
def encodings(spark, sf_dir):
    x = F.col("value") / 100
    e = table(spark, sf_dir, "events").withColumn("s", vectors.sine_embedding(x, 4))
    return e.select("event_id", (_r(vectors.inverse_sigmoid(x)) + 0.0).alias("logit"), (_r(F.get("s", 0)) + 0.0).alias("s0"), _r(F.get("s", 3)).alias("s3"))


@query("""SELECT row_number() OVER (ORDER BY y, x)::INT - 1 AS i, round((x + 0.5) / 6, 6) AS cx, round((y + 0.5) / 4, 6) AS cy FROM range(6) a(x), range(4) b(y)""")
def proposals(spark, sf_dir):
    p = table(spark, sf_dir, "region").limit(1).select(F.posexplode(boxes.proposals(6, 4, 1)).alias("i", "p"))
    return p.select("i", _r(F.col("p.cx")).alias("cx"), _r(F.col("p.cy")).alias("cy"))


@query("""SELECT part, frame_offset::INT AS frame_offset, bool_or(event NOT IN ('landmark', 'attack', 'click')) AS has_event FROM (SELECT 'part-' || (user_id % 7)::VARCHAR AS part, event_id % 400 // 32 * 32 AS frame_offset, event_type AS event FROM events) GROUP BY ALL""")
def event_chunks(spark, sf_dir):
    o = table(spark, sf_dir, "events").select(F.format_string("part-%d", F.col("user_id") % 7).alias("part"), F.lit(0).alias("ep_idx"), (F.col("event_id") % 400).cast("int").alias("frame"), F.when(F.col("event_type") == "click", "right_click").otherwise(F.col("event_type")).alias("event"), F.lit("1 2").alias("rle"))
    return sample.chunks_with_events(o).select("part", "frame_offset", "has_event")


@query(f"SELECT o.key_frame, o.part, e.episode FROM {sql('observations')} o JOIN {sql('episodes')} e USING (part, ep_idx)")
def named_observations(spark, sf_dir):
    return align.with_episode(adapted(spark, sf_dir, "observations"), adapted(spark, sf_dir, "episodes")).select("key_frame", "part", "episode")


@query(f"SELECT count(*) FILTER (ep_idx % 3 = 0) AS no_action_data, count(*) FILTER (ep_idx % 3 <> 0) AS kept FROM {sql('episodes')}")
def action_reasons(spark, sf_dir):
    e = adapted(spark, sf_dir, "episodes")
    return quality.reason_counts(align.with_actions(e, e.where("ep_idx % 3 <> 0")), ("no_action_data",))


@query(f"""SELECT reason, count(*) AS n FROM (SELECT CASE WHEN a < 40 THEN 'too_small' WHEN a > 80 THEN 'too_large' END AS reason FROM (SELECT string_split(rle, ' ')[2]::INT + string_split(rle, ' ')[4]::INT AS a FROM {sql("observations")})) GROUP BY 1""")
def mask_bounds(spark, sf_dir):
    rows = pipelines.masked_rows(adapted(spark, sf_dir, "observations"), (360, 640), 40, 80.5 / (360 * 640))
    return rows.groupBy("reason").agg(F.count("*").alias("n"))


@query(f"SELECT key_frame FROM {sql('observations')} WHERE sqrt(pow(point_row - 180e0, 2) + pow(point_col - 320e0, 2)) / sqrt(129600e0 / 4 + 409600e0 / 4) <= 0.4")
def near_centre(spark, sf_dir):
    return pipelines.near_centre(adapted(spark, sf_dir, "observations"), 0.4).select("key_frame")


@query("SELECT (SELECT count(*) FROM orders) AS images, (SELECT count(*) FROM lineitem) AS annotations, round((SELECT count(*) FROM lineitem) / (SELECT count(*) FROM orders)::DOUBLE, 6) AS per_image")
def annotation_density(spark, sf_dir):
    return quality.density(table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")).withColumn("per_image", _r("per_image"))


_PROMPT = "CASE p_partkey % 3 WHEN 0 THEN 'tree_trunk' WHEN 1 THEN 'ocean' ELSE 'red_cow' END"


@query(f"""SELECT p_partkey, style, CASE style WHEN 'original' THEN p_name WHEN 'simple' THEN replace(l, '_', ' ') ELSE replace(CASE l WHEN 'tree_trunk' THEN 'oak_log' WHEN 'ocean' THEN 'water' ELSE l END, '_', ' ') END AS prompt
  FROM (SELECT p_partkey, p_name, {_PROMPT} AS l FROM part), (VALUES ('original'), ('simple'), ('aligned')) t(style)""")
def prompt_styles(spark, sf_dir):
    p = table(spark, sf_dir, "part").withColumn("l", F.expr(_PROMPT))
    return p.select("p_partkey", F.inline(labels.prompt_variants(F.col("p_name"), F.col("l"))))


@query("SELECT l_orderkey AS task, max(l_quantity) FILTER (l_linenumber % 3 = 1) AS original, max(l_quantity) FILTER (l_linenumber % 3 = 2) AS simple, max(l_quantity) FILTER (l_linenumber % 3 = 0) AS aligned, max(l_quantity) FILTER (l_linenumber % 3 = 0) - max(l_quantity) FILTER (l_linenumber % 3 = 1) AS gain FROM lineitem GROUP BY 1")
def style_pivot(spark, sf_dir):
    style = F.get(F.array(*map(F.lit, ("original", "simple", "aligned"))), ((F.col("l_linenumber") - 1) % 3).cast("int"))
    l = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("task"), style.alias("style")).agg(F.max("l_quantity").alias("iou"))
    return metrics.pivot_styles(l)


_PROBS = "[l_discount * 8, l_tax * 10, (l_quantity - 1) / 60]"


@query(f"""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, round(list_max(p), 6) AS score, array_to_string(list_filter([CASE WHEN p[1] > 0.25 THEN 'red' END, CASE WHEN p[2] > 0.25 THEN 'cow' END, CASE WHEN p[3] > 0.25 THEN 'x' END], lambda t: t IS NOT NULL), ' ') AS phrase
  FROM (SELECT *, {_PROBS} AS p FROM lineitem) WHERE list_max(p) > 0.35""")
def token_phrases(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem").withColumn("probs", F.array(F.col("l_discount") * 8, F.col("l_tax") * 10, (F.col("l_quantity") - 1) / 60))
    out = postprocess.phrases(postprocess.confident(l), F.array(*map(F.lit, ("red", "cow", "x"))))
    return out.select("l_orderkey", *ORD, _r("score").alias("score"), "phrase")


@query("SELECT l_linenumber AS epoch, round(sum(l_tax) / greatest(count(l_tax), 1), 6) AS l_tax, round(sum(l_discount) / greatest(count(l_discount), 1), 6) AS l_discount FROM lineitem GROUP BY 1")
def epoch_losses(spark, sf_dir):
    e = metrics.epoch_means(table(spark, sf_dir, "lineitem").withColumnRenamed("l_linenumber", "epoch"), ["l_tax", "l_discount"])
    return e.select("epoch", _r("l_tax").alias("l_tax"), _r("l_discount").alias("l_discount"))


@query("SELECT event_type, min(event_id) AS first_frame, max(event_id) AS last_frame FROM events GROUP BY 1")
def label_extent(spark, sf_dir):
    return timeline.label_extent(table(spark, sf_dir, "events").withColumn("frame", F.col("event_id")), ["event_type"])


@query("SELECT user_id, event_id, sum((event_type = 'signup')::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id)::BIGINT AS island FROM events")
def islands(spark, sf_dir):
    return timeline.session_ids(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], F.col("event_type") == "signup").select("user_id", "event_id", "island")


@query("SELECT (user_id % 11)::INT AS ep_idx, (event_id % 40 * 32)::INT AS frame_offset, count(*) AS n, count(DISTINCT event_type) AS parts FROM events WHERE event_id % 7 <> 0 GROUP BY 1, 2")
def store_scan(spark, sf_dir):
    text = F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("__meta__"), F.col("event_id").cast("string"))).otherwise(F.format_string("(%d, %d)", F.col("user_id") % 11, F.col("event_id") % 40 * 32))
    kv = table(spark, sf_dir, "events").select(F.lit("s").alias("store"), F.col("event_type").alias("part"), text.cast("binary").alias("key"), F.lit(b"").alias("value"))
    scan = stores.scan_kv(kv)
    parts = align.image_index(scan)
    return scan.groupBy("ep_idx", "frame_offset").agg(F.count("*").alias("n")).join(parts, ["ep_idx", "frame_offset"]).select("ep_idx", "frame_offset", "n", F.size("parts").cast("long").alias("parts"))


@query(f"SELECT stem, min(path) AS path FROM {sql('videos')} GROUP BY 1")
def first_videos(spark, sf_dir):
    v = adapted(spark, sf_dir, "videos")
    listing = v.select(F.concat(F.lit("/x"), "path").alias("path"), "stem")
    index = align.video_index(listing.select(F.concat_ws("/", "path", F.concat("stem", F.lit(".mp4"))).alias("path")))
    return index.select("stem", F.regexp_extract("path", r"^/x(/v/[^/]*\.mp4)/", 1).alias("path"))


@query(f"""WITH p AS (SELECT p.image_id, abs((p.px1 + p.px2) / 2 - (t.gx1 + t.gx2) / 2) + abs((p.py1 + p.py2) / 2 - (t.gy1 + t.gy2) / 2) + abs((p.px2 - p.px1) - (t.gx2 - t.gx1)) + abs((p.py2 - p.py1) - (t.gy2 - t.gy1)) AS l1
  FROM (SELECT * FROM {sql("boxes")} WHERE has_prediction) p JOIN {sql("boxes")} t USING (image_id)) SELECT image_id, round(min(l1), 6) + 0.0 AS least_l1, round(max(l1), 6) + 0.0 AS most_l1 FROM p GROUP BY 1""")
def matching_costs(spark, sf_dir):
    return _pairs(spark, sf_dir).groupBy("image_id").agg((_r(F.min("l1")) + 0.0).alias("least_l1"), (_r(F.max("l1")) + 0.0).alias("most_l1"))


@query("SELECT vec_id, round(list_sum(list_transform(range(1, 65), lambda i: (i - 1) * (embedding[i]::DOUBLE * embedding[i]::DOUBLE))) / list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE)), 5) AS place FROM embeddings")
def soft_place(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    sq = F.transform("embedding", lambda x: x.cast("double") * x.cast("double"))
    return e.select("vec_id", _r(vectors.expectation(F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: i.cast("double")), sq), 5).alias("place"))


@query("""SELECT date_trunc('hour', ts)::TIMESTAMP AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2""")
def streamed_hourly_counts(spark, sf_dir):
    """The events read as a stream until all present data is in; hours and types bound the result."""
    schema = table(spark, sf_dir, "events").schema
    events = streaming.read_events(spark, sf_dir, schema, "events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    stream = streaming.windowed_counts(events, ["event_type"])
    name = f"hourly_{uuid.uuid4().hex}"
    run = stream.writeStream.format("memory").queryName(name).outputMode("complete").trigger(availableNow=True).start()
    run.awaitTermination()
    return spark.table(name).select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n", _r("total", 4).alias("total"))


from . import more_queries  # noqa: E402, F401 - registers its queries, which use what stands above
from . import row_queries  # noqa: E402, F401
