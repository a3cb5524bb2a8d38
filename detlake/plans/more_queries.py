"""Further registered queries: conversions, joins of datasets, samples and losses, each with the SQL that checks it."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import boxes, captions, frames, labels, rle, vectors
from ..operators import align, coco, keys, match, metrics, postprocess, quality, sample
from .adapters import adapted, sql, table
from .queries import _ANN, _CATS, _GEO, ORD, _predicted, _r, _truth, dataset, query

_HELD = "greatest(0, least(1, {0}))"


@query(f"""SELECT l_linenumber, round(sum(gx1), 4) AS x, round(sum(gy2 - gy1), 4) AS h, round(sum((gx1 + gx2) / 2 / 640), 6) AS ncx, round(sum((gy2 - gy1) / 360), 6) AS nh,
  round(sum(gx1 * 224 / 640), 4) AS sx, round(sum((gy2 - gy1) * 224 / 360), 4) AS sh, sum(640 + l_linenumber)::BIGINT AS pw, sum(360 + 7)::BIGINT AS ph,
  count(*) FILTER (gx2 - l_linenumber / 10e0 > gx1 AND gy2 > gy1) AS proper FROM {sql("boxes")} GROUP BY 1""")
def box_forms(spark, sf_dir):
    b = _truth()
    x, y, w, h = boxes.to_xywh(b)
    small = boxes.scale_xywh(F.array(x, y, w, h), (360, 640), (224, 224))
    n = boxes.normalise_cxcywh(b, 640, 360)
    pw, ph = boxes.padded(F.lit(640), F.lit(360), F.col("l_linenumber"), 7)
    shrunk = boxes.Box(b.x1, b.y1, b.x2 - F.col("l_linenumber") / 10, b.y2)
    return adapted(spark, sf_dir, "boxes").groupBy("l_linenumber").agg(
        _r(F.sum(x), 4).alias("x"), _r(F.sum(h), 4).alias("h"), _r(F.sum(n[0])).alias("ncx"), _r(F.sum(n[3])).alias("nh"), _r(F.sum(F.get(small, 0)), 4).alias("sx"), _r(F.sum(F.get(small, 3)), 4).alias("sh"),
        F.sum(pw).cast("long").alias("pw"), F.sum(ph).cast("long").alias("ph"), F.count_if(boxes.proper(shrunk)).alias("proper"),
    )


@query("""SELECT p_partkey // 10 AS g, string_agg(p_name, ' . ' ORDER BY p_partkey) || ' .' AS spaced, string_agg(p_name, '. ' ORDER BY p_partkey) AS plain,
  max(replace(p_name || '.', '.', '') || '(' || substr(((p_partkey % 90 + 10) / 100e0)::VARCHAR, 1, 4) || ')') AS shown FROM part GROUP BY 1""")
def caption_joins(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    shown = labels.display_phrase(F.concat("p_name", F.lit(".")), (F.col("p_partkey") % 90 + 10) / F.lit(100.0))
    made = p.groupBy(F.floor(F.col("p_partkey") / 10).alias("g")).agg(F.array_sort(F.collect_list(F.struct("p_partkey", "p_name"))).alias("c"), F.max(shown).alias("shown"))
    names = F.transform("c", lambda x: x["p_name"])
    return made.select("g", labels.caption_of(names).alias("spaced"), labels.caption_of(names, "plain").alias("plain"), "shown")


@query("""SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN p_brand ELSE p_brand || 'module.' END AS name, p_size::INT AS size, p_type LIKE 'PROMO%' OR p_type LIKE 'SMALL%' AS frozen FROM part""")
def map_keys(spark, sf_dir):
    key = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("module."), "p_brand")).otherwise(F.concat("p_brand", F.lit("module.")))
    p = table(spark, sf_dir, "part").withColumn("m", labels.strip_prefix(F.create_map(key, F.col("p_size"))))
    return p.select("p_partkey", F.element_at(F.map_keys("m"), 1).alias("name"), F.element_at(F.map_values("m"), 1).cast("int").alias("size"), labels.has_prefix(F.col("p_type"), F.array(F.lit("PROMO"), F.lit("SMALL"))).alias("frozen"))


@query("SELECT s_nationkey AS nation, s_suppkey AS id, (dense_rank() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) - 1)::INT AS compact FROM supplier")
def compact_ids(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("nation")).agg(labels.sparse_to_compact(F.collect_list("s_suppkey")).alias("m"))
    return s.select("nation", F.explode("m").alias("id", "compact"))


@query("""WITH l AS (SELECT *, [1 / (1 + exp(-l_discount * 10)), 1 / (1 + exp(-l_tax * 10)), 1 / (1 + exp(-l_quantity / 50))] AS p FROM lineitem)
  SELECT l_returnflag, round(avg(p[1]), 6) AS first, round(avg(list_max(p)), 6) AS best, round(avg(p[1] * 0.5 + p[2] * 0.5), 6) AS label_a, round(avg(p[3]), 6) AS label_b,
  count(*) FILTER (abs((l_linenumber % 2 = 0)::INT - (l_returnflag = 'R')::INT) < 0.0001) AS agree FROM l GROUP BY 1""")
def token_scores(spark, sf_dir):
    """Sigmoids of logits, scores of labels by their positive maps, and agreement of one-hot arrays."""
    logits = F.array(F.col("l_discount") * 10, F.col("l_tax") * 10, F.col("l_quantity") / 50)
    maps = F.array(F.array(F.lit(0.5), F.lit(0.5), F.lit(0.0)), F.array(F.lit(0.0), F.lit(0.0), F.lit(1.0)))
    hot = lambda c: F.array(c.cast("int"), (~c).cast("int"))
    l = table(spark, sf_dir, "lineitem").withColumn("p", F.transform(logits, vectors.sigmoid)).withColumn("s", vectors.label_scores(F.col("p"), maps))
    same = vectors.one_hot_error(hot(F.col("l_linenumber") % 2 == 0), hot(F.col("l_returnflag") == "R"))
    return l.groupBy("l_returnflag").agg(_r(F.avg(F.get("p", 0))).alias("first"), _r(F.avg(F.array_max("p"))).alias("best"), _r(F.avg(F.get("s", 0))).alias("label_a"), _r(F.avg(F.get("s", 1))).alias("label_b"), F.count_if(same).alias("agree"))


@query(f"""SELECT key_frame, f::INT AS frame, (f + (key_frame % 50 - fr_s))::INT AS original FROM (SELECT key_frame, fr_s, unnest(range(fr_s, fr_e + 1)) AS f FROM {sql("observations")})""")
def rebased_frames(spark, sf_dir):
    o = adapted(spark, sf_dir, "observations").select("key_frame", "fr_s", F.explode(F.sequence("fr_s", "fr_e")).alias("frame"))
    return o.select("key_frame", "frame", frames.rebase(F.col("frame"), F.col("fr_s"), F.col("key_frame") % 50).cast("int").alias("original"))


@query(f"""SELECT category, 'img_' || image_id || '.png' AS file_name, count(*) AS n, round(sum(area), 3) AS area FROM {_ANN} GROUP BY ALL""")
def joined_annotations(spark, sf_dir):
    return coco.joined(dataset(spark, sf_dir)).groupBy("category", "file_name").agg(F.count("*").alias("n"), _r(F.sum("area"), 3).alias("area"))


@query(f"""SELECT 'used' AS kind, count(DISTINCT image_id) AS images, count(*) AS annotations FROM {_ANN} UNION ALL
  SELECT 'existing', (SELECT count(*) FROM orders WHERE o_orderkey % 3 <> 0), (SELECT count(*) FROM {_ANN} WHERE image_id % 3 <> 0)""")
def restricted_images(spark, sf_dir):
    ds = dataset(spark, sf_dir)
    files = table(spark, sf_dir, "orders").where("o_orderkey % 3 <> 0").select(F.format_string("img_%d.png", "o_orderkey").alias("file_name"))
    both = [("used", coco.restrict_images(ds)), ("existing", coco.existing_images(ds, files))]
    rows = [d.images.agg(F.count("*").alias("images")).join(F.broadcast(d.annotations.agg(F.count("*").alias("annotations")))).select(F.lit(kind).alias("kind"), "images", "annotations") for kind, d in both]
    return rows[0].union(rows[1])


@query(f"""SELECT image_id, count(*) AS n, round(sum(least(box_x + box_w, 640)), 3) AS right_edges FROM {_GEO} WHERE least(box_x + box_w, 640) > least(box_x, 640) AND least(box_y + box_h, 360) > least(box_y, 360) GROUP BY 1""")
def detection_targets(spark, sf_dir):
    return coco.detection_targets(dataset(spark, sf_dir)).groupBy("image_id").agg(F.count("*").alias("n"), _r(F.sum("box.x2"), 3).alias("right_edges"))


@query("""SELECT event_type AS metric, count(*) AS n, round(avg(value), 6) AS mean, max_by(value, event_id) AS last, round((20000 - max(event_id) - 1) * avg(user_id / 10e0), 4) AS eta FROM events GROUP BY 1""")
def metric_log(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("event_type").alias("metric"), "value", F.col("event_id").alias("iter"), (F.col("user_id") / 10.0).alias("seconds"))
    return metrics.metric_log(e, total=20000).select("metric", "n", _r("mean").alias("mean"), "last", _r("eta", 4).alias("eta"))


@query("SELECT event_type AS name, count(*) AS n FROM events GROUP BY 1")
def merged_counters(spark, sf_dir):
    """Counters of workers, summed."""
    parts = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("name"), (F.col("user_id") % 16).alias("worker")).agg(F.count("*").alias("n"))
    return quality.merge_counters(parts)


_CHUNKS = """(SELECT 'part-' || (user_id % 7)::VARCHAR AS part, (user_id % 50)::INT AS ep_idx, event_id % 400 // 32 * 32 AS frame_offset, bool_or(event_type = 'purchase') AS has_event FROM events GROUP BY 1, 2, 3)"""


@query(f"""SELECT part, ep_idx, frame_offset, 'src-' || part AS src_part FROM (SELECT *, row_number() OVER (PARTITION BY part ORDER BY ep_idx, frame_offset) AS rn FROM {_CHUNKS} WHERE has_event) WHERE rn <= 10""")
def paired_sample(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.format_string("part-%d", F.col("user_id") % 7).alias("part"), (F.col("user_id") % 50).cast("int").alias("ep_idx"), F.expr("event_id % 400 div 32 * 32").alias("frame_offset"), "event_type")
    chunks = e.groupBy("part", "ep_idx", "frame_offset").agg(F.bool_or(F.col("event_type") == "purchase").alias("has_event"))
    pairs = chunks.select(F.col("part").alias("seg_part"), F.concat(F.lit("src-"), "part").alias("src_part")).distinct()
    return sample.paired_sample(chunks, pairs).select("part", "ep_idx", "frame_offset", "src_part")


@query("""SELECT image_id, query, rank FROM (SELECT l_orderkey AS image_id, l_linenumber * 1000000 + l_partkey AS query, row_number() OVER (PARTITION BY l_orderkey ORDER BY greatest(l_discount, l_tax) DESC, l_linenumber * 1000000 + l_partkey, l_suppkey)::INT AS rank FROM lineitem) WHERE rank <= 2""")
def top_queries(spark, sf_dir):
    q = (F.col("l_linenumber") * 1000000 + F.col("l_partkey")).alias("query")
    l = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("image_id"), q, F.array("l_discount", "l_tax").alias("similarities"))
    return postprocess.top_queries(l, k=2).select("image_id", "query", "rank")


@query("SELECT l_orderkey, string_agg(l_linenumber || ':' || l_partkey, ',' ORDER BY l_linenumber, l_partkey, l_suppkey) AS items FROM lineitem GROUP BY 1")
def grouped_arrays(spark, sf_dir):
    g = keys.grouped(table(spark, sf_dir, "lineitem").select("l_orderkey", *ORD), ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey"])
    return g.select("l_orderkey", F.array_join(F.transform("items", lambda x: F.concat_ws(":", x["l_linenumber"].cast("string"), x["l_partkey"].cast("string"))), ",").alias("items"))


def _held(side: str) -> str:
    return ", ".join(f"{_HELD.format(side + c)} AS {side}{c}" for c in ("x1", "y1", "x2", "y2"))


@query(f"""WITH m AS (SELECT *, abs((gx1 + gx2 - px1 - px2) / 2) + abs((gy1 + gy2 - py1 - py2) / 2) + abs((gx2 - gx1) - (px2 - px1)) + abs((gy2 - gy1) - (py2 - py1)) AS l1 FROM {sql("boxes")} WHERE has_prediction),
  h AS (SELECT score, l1, {_held("g")}, {_held("p")} FROM m),
  u AS (SELECT *, greatest(least(gx2, px2) - greatest(gx1, px1), 0) * greatest(least(gy2, py2) - greatest(gy1, py1), 0) AS i, (greatest(gx2, px2) - least(gx1, px1)) * (greatest(gy2, py2) - least(gy1, py1)) AS hull, (gx2 - gx1) * (gy2 - gy1) + (px2 - px1) * (py2 - py1) AS two FROM h)
  SELECT round(sum(score) / count(*), 6) AS loss_ce, round(sum(l1) / count(*), 6) AS loss_bbox, round(sum(1 - (i / (two - i) - (hull - (two - i)) / hull)) / count(*), 6) AS loss_giou FROM u""")
def set_loss(spark, sf_dir):
    b = adapted(spark, sf_dir, "boxes").where("has_prediction").select("score", _predicted().struct().alias("pbox"), _truth().struct().alias("tbox"))
    s = match.set_loss(b, "score")
    return s.select(*[_r(c).alias(c) for c in ("loss_ce", "loss_bbox", "loss_giou")])


@query(f"""WITH r AS (SELECT key_frame, list_transform(string_split(rle, ' '), lambda x: x::INT) AS n FROM {sql("observations")}),
  p AS (SELECT key_frame, n, greatest(n[1] + n[2], n[3] + n[4]) AS most, [n[1], n[3]] AS s, [n[1] + n[2] - 1, n[3] + n[4] - 1] AS e FROM r),
  b AS (SELECT key_frame, most, list_transform(range(1, 3), lambda i: [CASE WHEN s[i] // 640 < e[i] // 640 THEN 0 ELSE s[i] % 640 END, s[i] // 640, CASE WHEN s[i] // 640 < e[i] // 640 THEN 639 ELSE e[i] % 640 END, e[i] // 640]) AS q FROM p)
  SELECT key_frame, CASE WHEN most <= 50176 THEN 224 ELSE 360 END AS h, least(q[1][1], q[2][1])::DOUBLE AS x1, greatest(q[1][4], q[2][4])::DOUBLE AS y2 FROM b""")
def mask_corners(spark, sf_dir):
    o = adapted(spark, sf_dir, "observations").withColumn("c", rle.corners(rle.runs(F.col("rle"), 360, 640), 640))
    return o.select("key_frame", rle.resolution(F.col("rle"))["h"].alias("h"), F.get("c", 0).alias("x1"), F.get("c", 3).alias("y2"))


@query(f"""SELECT e.episode, min(v.path) AS path FROM (SELECT DISTINCT episode FROM {sql("episodes")}) e LEFT JOIN {sql("videos")} v ON v.stem = e.episode GROUP BY 1""")
def episode_videos(spark, sf_dir):
    v = adapted(spark, sf_dir, "videos").groupBy("stem").agg(F.min("path").alias("path"))
    return align.find_video(v, adapted(spark, sf_dir, "episodes").select("episode").distinct()).select("episode", "path")


@query("SELECT (SELECT count(*) FROM lineitem WHERE l_orderkey % 5 <> 0) AS decoded, (SELECT count(*) FROM lineitem WHERE l_orderkey % 5 = 0) AS missing")
def decoded_frames(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("frame"))
    got, missing = align.decoded(l, table(spark, sf_dir, "orders").where("o_orderkey % 5 <> 0").select(F.col("o_orderkey").alias("frame")), ["frame"])
    return got.agg(F.count("*").alias("decoded")).join(F.broadcast(missing))


@query(f"""SELECT l_linenumber, count(*) FILTER (least(cx, cy, w, h) > 0.01 AND greatest(cx, cy, w, h) < 0.99) AS valid, round(sum(CASE WHEN least(cx, cy, w, h) > 0.01 AND greatest(cx, cy, w, h) < 0.99 THEN ln(cx / (1 - cx)) ELSE 0 END), 4) AS logit
  FROM (SELECT l_linenumber, (gx1 + gx2) / 2 AS cx, (gy1 + gy2) / 2 AS cy, gx2 - gx1 AS w, gy2 - gy1 AS h FROM {sql("boxes")}) GROUP BY 1""")
def valid_proposals(spark, sf_dir):
    cx, cy, w, h = boxes.to_cxcywh(_truth())
    p = adapted(spark, sf_dir, "boxes").withColumn("p", F.struct(cx.alias("cx"), cy.alias("cy"), w.alias("w"), h.alias("h")))
    valid = boxes.proposal_valid(F.col("p"))
    return p.groupBy("l_linenumber").agg(F.count_if(valid).alias("valid"), _r(F.sum(F.when(valid, F.get(boxes.proposal_logit(F.col("p")), 0)).otherwise(0.0)), 4).alias("logit"))


@query(f"SELECT id, image_id, name FROM (SELECT a.id, a.image_id, c.category AS name FROM {_ANN} a JOIN {_CATS} c ON c.id = a.category_id WHERE a.image_id % 2 = 0 UNION ALL SELECT a.id, a.image_id, c.category FROM {_ANN} a JOIN {_CATS} c ON c.id = a.category_id WHERE a.image_id % 2 = 1)")
def worker_union(spark, sf_dir):
    """Annotations gathered from two workers, with the names of their categories."""
    ds = dataset(spark, sf_dir)
    halves = [coco.joined(ds._replace(annotations=ds.annotations.where(F.col("image_id") % 2 == k))) for k in (0, 1)]
    return halves[0].unionByName(halves[1]).select("id", "image_id", F.col("category").alias("name"))


@query("""WITH w AS (SELECT p_partkey, p_name, instr(p_name, ' ') AS pos FROM part WHERE contains(p_name, ' ')) SELECT p_partkey, substr(p_name, 1, pos - 1) || ' ' || substr(p_name, pos + 1) AS phrase FROM w""")
def phrases_of_spans(spark, sf_dir):
    p = table(spark, sf_dir, "part").where(F.contains("p_name", F.lit(" "))).withColumn("at", F.instr("p_name", " "))
    span = lambda a, b: F.struct(a.cast("int").alias("beg"), b.cast("int").alias("end"))
    return p.select("p_partkey", captions.phrases_at(F.col("p_name"), F.array(span(F.lit(0), F.col("at") - 1), span(F.col("at"), F.length("p_name")))).alias("phrase"))
