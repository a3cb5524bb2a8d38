"""Registered queries of single functions that no larger query runs, each with the SQL that checks it."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import boxes, captions, labels, vectors
from ..operators import align, keys, sample
from ..sources import stores
from . import pipelines, sql_functions
from .adapters import adapted, sql, table
from .queries import _ANN, _r, _truth, dataset, query

_PI2 = "6.283185307179586e0"


@query(f"""SELECT l_linenumber, round(sum(list_sum(list_transform(range(4), lambda i: ((l_orderkey + i * l_linenumber) % 3 > 0)::INT)) / (list_sum(list_transform(range(8), lambda i: ((l_orderkey + i * l_linenumber) % 3 > 0)::INT)) + 1e-6) * {_PI2}), 3) AS place,
  sum(list_sum(list_transform(range(8), lambda i: ((l_orderkey + i * l_linenumber) % 3 > 0)::INT)))::DOUBLE AS valid FROM lineitem GROUP BY 1""")
def mask_places(spark, sf_dir):
    cells = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: (F.col("l_orderkey") + i * F.col("l_linenumber")) % 3 > 0)
    l = table(spark, sf_dir, "lineitem").select("l_linenumber", cells.alias("cells"))
    places, counts = vectors.mask_positions(F.col("cells")), vectors.mask_positions(F.col("cells"), normalise=False)
    return l.groupBy("l_linenumber").agg(_r(F.sum(F.get(places, 3)), 3).alias("place"), F.sum(F.get(counts, 7)).alias("valid"))


@query("""SELECT l_linenumber, round(sum(l_discount), 4) AS own, round(sum(sin(l_discount)), 4) AS s1, round(sum(cos(2 * l_discount)), 4) AS c2, round(sum(sin(4 * l_discount)), 4) AS s4, round(sum(cos(2.5e0 * l_discount)), 4) AS linear_c FROM lineitem GROUP BY 1""")
def frequency_encodings(spark, sf_dir):
    x = F.col("l_discount").cast("double")
    waves, linear = vectors.multi_frequency(x, 3), vectors.multi_frequency(x, 3, include_input=False, log_scale=False)
    at = lambda a, i, name: _r(F.sum(F.get(a, i)), 4).alias(name)
    return table(spark, sf_dir, "lineitem").groupBy("l_linenumber").agg(at(waves, 0, "own"), at(waves, 1, "s1"), at(waves, 4, "c2"), at(waves, 5, "s4"), at(linear, 3, "linear_c"))


@query("""SELECT l_returnflag, round(avg((l_discount - 0.25) / 0.5), 6) AS red, round(avg((l_quantity / 50 - 0.125) / 0.25), 6) AS blue, round(avg(l_tax), 6) AS green_again FROM lineitem GROUP BY 1""")
def pixel_scales(spark, sf_dir):
    mean, std = (0.25, 0.5, 0.125), (0.5, 2.0, 0.25)
    px = F.array(*[c.cast("double") for c in (F.col("l_discount"), F.col("l_tax"), F.col("l_quantity") / 50)])
    n = vectors.normalise_pixels(px, mean, std)
    again = vectors.restore_pixels(n, mean, std)
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(_r(F.avg(F.get(n, 0))).alias("red"), _r(F.avg(F.get(n, 2))).alias("blue"), _r(F.avg(F.get(again, 1))).alias("green_again"))


@query("""SELECT event_id, format('{:.2f}', value)::DOUBLE + 0.0 AS exported, format('{:.2f}', (event_id % 2000 * 10 + 5) / 1000e0)::DOUBLE AS halves, round_even(event_id / 2e0, 0)::INT AS whole FROM events""")
def export_rounding(spark, sf_dir):
    half = (F.col("event_id") % 2000 * 10 + 5) / 1000.0
    e = table(spark, sf_dir, "events")
    return e.select("event_id", (labels.export_round(F.col("value").cast("double")) + 0.0).alias("exported"), labels.export_round(half).alias("halves"), labels.python_round(F.col("event_id") / 2.0).alias("whole"))


_NAMED = "(SELECT p_partkey // 4 AS g, string_agg(lower(p_name), ' . ' ORDER BY p_partkey) || ' .' AS caption, lower(max_by(p_name, p_partkey)) AS last, max(p_partkey) AS last_id FROM part GROUP BY 1)"


def _named(spark, sf_dir):
    """Names of parts, four at a time, by key."""
    p = table(spark, sf_dir, "part").select(F.expr("p_partkey div 4").alias("g"), F.struct(F.col("p_partkey").alias("id"), F.lower("p_name").alias("name")).alias("c"))
    return p.groupBy("g").agg(F.array_sort(F.collect_list("c")).alias("c"))


@query(f"SELECT g, caption, (length(caption) - 2 - length(last))::INT AS last_beg, (length(caption) - 2)::INT AS last_end FROM {_NAMED}")
def captions_of_names(spark, sf_dir):
    made = captions.captions_by_name(F.col("c.name"))
    rows = _named(spark, sf_dir).select("g", made.alias("m"), F.element_at("c.name", -1).alias("last"))
    span = F.element_at(F.col("m.spans"), F.col("last"))
    return rows.select("g", "m.caption", F.get(span, 0)["beg"].alias("last_beg"), F.element_at(span, -1)["end"].alias("last_end"))


@query(f"SELECT g, last_id, (length(caption) - 2)::INT AS last_end, length(last) - length(replace(last, ' ', '')) + 1 AS words FROM {_NAMED}")
def spans_of_ids(spark, sf_dir):
    rows = _named(spark, sf_dir).select("g", captions.spans_by_id(F.col("c")).alias("m"), F.element_at("c.id", -1).alias("last_id"))
    span = F.element_at(F.col("m.spans"), F.col("last_id"))
    return rows.select("g", "last_id", F.element_at(span, -1)["end"].alias("last_end"), F.size(span).cast("long").alias("words"))


@query("""SELECT p_partkey, len(string_split(p_name, ' ')) - 1 AS token, round(1 / 1.000001e0, 6) AS weight, round(len(string_split(p_name, ' ')) / (len(string_split(p_name, ' ')) + 1e-6), 5) AS whole FROM part""")
def positive_maps(spark, sf_dir):
    """The last word of a name, and all of it, as weights of its words."""
    words = F.split("p_name", " ")
    at = lambda i: F.aggregate(F.slice(words, 1, i), F.lit(0), lambda a, x: a + F.length(x) + 1)
    span = lambda a, b: F.struct(a.cast("int").alias("beg"), b.cast("int").alias("end"))
    offsets = F.transform(words, lambda w, i: span(at(i), at(i) + F.length(w)))
    p = table(spark, sf_dir, "part").select("p_partkey", F.length("p_name").alias("n"), F.length(F.element_at(words, -1)).alias("tail"), offsets.alias("o"))
    last = captions.positive_map(F.array(span(F.col("n") - F.col("tail"), F.col("n"))), F.col("o"), 16)
    every = captions.positive_map(F.array(span(F.lit(0), F.col("n"))), F.col("o"), 16)
    return p.select("p_partkey", vectors.argmax(last).cast("long").alias("token"), _r(F.array_max(last)).alias("weight"), _r(vectors.total(every), 5).alias("whole"))


@query("""SELECT p_partkey, list_aggregate(list_filter(list_transform(range(1, len(w) + 1), lambda i: CASE WHEN i > 1 AND i < 8 AND (p_partkey + i) % 2 = 0 THEN w[i] END), lambda x: x IS NOT NULL), 'string_agg', ' ') AS phrase
  FROM (SELECT p_partkey, string_split(p_name || ' ' || lower(p_type), ' ') AS w FROM part)""")
def phrases_of_masks(spark, sf_dir):
    words = F.split(F.concat_ws(" ", "p_name", F.lower("p_type")), " ")
    mask = F.transform(words, lambda w, i: (F.col("p_partkey") + i + 1) % 2 == 0)
    return table(spark, sf_dir, "part").select("p_partkey", F.nullif(captions.phrase_of_mask(mask, words, 0, 7), F.lit("")).alias("phrase"))


@query("""SELECT p_partkey, list_max(list_filter(range(16), lambda i: p_partkey * (i + 3) % 7 = 0 AND i < p_size % 16))::INT AS lo, list_min(list_filter(range(16), lambda i: p_partkey * (i + 3) % 7 = 0 AND i >= p_size % 16))::INT AS hi FROM part""")
def segments_of_tokens(spark, sf_dir):
    ids = F.transform(F.sequence(F.lit(0), F.lit(15)), lambda i: F.col("p_partkey") * (i + 3) % 7)
    s = captions.segment_of(ids, F.col("p_size") % 16, (0,))
    return table(spark, sf_dir, "part").select("p_partkey", s["left"].alias("lo"), s["right"].alias("hi"))


@query("SELECT l_suppkey AS path, count(*) AS n, 1::BIGINT AS tasks FROM lineitem GROUP BY 1")
def requests_by_file(spark, sf_dir):
    """Frame requests brought together by file: one task reads a file."""
    asked = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("path"), F.col("l_orderkey").alias("local"))
    return align.by_file(asked).withColumn("task", F.spark_partition_id()).groupBy("path").agg(F.count("*").alias("n"), F.count_distinct("task").alias("tasks"))


@query(f"SELECT l_linenumber, count(*) AS n, 0::BIGINT AS too_far, 0::BIGINT AS outside FROM {sql('boxes')} GROUP BY 1")
def jittered_boxes(spark, sf_dir):
    """Corners move by a tenth of the sides at most and stay in the unit square."""
    b = _truth()
    held = boxes.Box(*[F.least(F.lit(1.0), c) for c in b])
    moved = boxes.jitter(b, 0.1, F.concat_ws("|", "image_id", "l_partkey", "l_suppkey", "l_linenumber"))
    far = F.greatest(*[F.abs(m - h) for m, h in zip(moved, held, strict=True)]) > 0.1 * F.greatest(b.x2 - b.x1, b.y2 - b.y1) + 1e-9
    out = (F.least(*moved) < 0) | (F.greatest(*moved) > 1)
    return adapted(spark, sf_dir, "boxes").groupBy("l_linenumber").agg(F.count("*").alias("n"), F.count_if(far).alias("too_far"), F.count_if(out).alias("outside"))


@query("SELECT o_orderstatus, count(*) AS n, 0::BIGINT AS outside, 0::BIGINT AS wrong_size FROM orders GROUP BY 1")
def random_crops(spark, sf_dir):
    """Crops of 100 to 180 pixels lie within their images."""
    o = table(spark, sf_dir, "orders").select("o_orderstatus", "o_orderkey", (200 + F.col("o_orderkey") % 900).cast("int").alias("w"), (150 + F.col("o_custkey") % 700).cast("int").alias("h"))
    top, left, height, width = boxes.random_crop(F.col("w"), F.col("h"), F.col("o_orderkey"), 100, 180)
    out = (top < 0) | (left < 0) | (top + height > F.col("h")) | (left + width > F.col("w"))
    wrong = ~(height.between(100, 180) & width.between(100, 180))
    return o.groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.count_if(out).alias("outside"), F.count_if(wrong).alias("wrong_size"))


@query(f"SELECT part, ep_idx, event, fr_s, fr_e, min(key_frame) AS key_frame, event AS label FROM {sql('observations')} WHERE frame = fr_e GROUP BY ALL")
def tracked_events(spark, sf_dir):
    return pipelines.tracked_events(adapted(spark, sf_dir, "observations")).select("part", "ep_idx", "event", "fr_s", "fr_e", "key_frame", "label")


@query("SELECT l_orderkey::INT AS ep_idx, count(*) * 3 AS frames, sum(l_linenumber * 96 + 3)::BIGINT AS numbers, count(*) FILTER (l_returnflag = 'R') * 3 AS attacks FROM lineitem GROUP BY 1")
def flattened_actions(spark, sf_dir):
    """Three frames a chunk."""
    attack = F.array_repeat((F.col("l_returnflag") == "R").cast("int"), 3)
    chunk = F.struct(attack.alias("attack"), F.array_repeat(F.lit(0), 3).alias("use"))
    c = table(spark, sf_dir, "lineitem").select(F.lit("part-0").alias("part"), F.col("l_orderkey").cast("int").alias("ep_idx"), (F.col("l_linenumber") * 32).alias("frame_offset"), chunk.alias("chunk"))
    return keys.flatten_actions(c).groupBy("ep_idx").agg(F.count("*").alias("frames"), F.sum("frame").alias("numbers"), F.sum("attack").alias("attacks"))


@query("""SELECT DISTINCT 'inside' AS kind, 'part-' || (c_custkey % 9) AS name, '/base/part-' || (c_custkey % 9) AS path FROM customer WHERE c_custkey % 3 = 0
  UNION ALL SELECT DISTINCT 'any', NULL, CASE WHEN c_custkey % 3 = 0 THEN '/base/part-' || (c_custkey % 9) ELSE '/base/deep/er/part-' || (c_custkey % 9) END FROM customer WHERE c_custkey % 3 <> 2""")
def store_parts(spark, sf_dir):
    n = (F.col("c_custkey") % 9).cast("string")
    kind = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("/base/part-"), n, F.lit("/data.mdb"))).when(F.col("c_custkey") % 3 == 1, F.concat(F.lit("/base/deep/er/part-"), n, F.lit("/data.mdb"))).otherwise(F.concat(F.lit("/base/part-x/"), n, F.lit(".txt")))
    listing = table(spark, sf_dir, "customer").select(kind.alias("path"))
    inside = stores.parts(listing, "/base/").select(F.lit("inside").alias("kind"), F.col("part").alias("name"), "path")
    return inside.union(stores.store_folders(listing).select(F.lit("any"), F.lit(None).cast("string"), "path"))


@query(f"SELECT part, ep_idx, episode, 'video' AS source FROM {sql('episodes')} WHERE ep_idx % 10 <> 3")
def episode_index(spark, sf_dir):
    """Episodes from the metadata entries of stores; unnamed ones are left out, as are entries that are no metadata."""
    e = adapted(spark, sf_dir, "episodes").withColumn("name", F.when(F.col("ep_idx") % 10 == 3, "").otherwise(F.col("episode")))
    info = F.struct(F.col("name").alias("episode"), F.when(F.col("ep_idx") % 2 == 0, F.col("ep_idx")).alias("episode_idx"), F.when(F.col("ep_idx") % 2 == 1, F.col("ep_idx")).alias("idx"))
    meta = e.groupBy("part").agg(F.to_json(F.collect_list(info)).cast("binary").alias("value")).select(F.lit("seg").alias("store"), "part", F.lit("__chunk_infos__").cast("binary").alias("key"), "value")
    data = e.select(F.lit("seg").alias("store"), "part", F.format_string("(%d, 0)", "ep_idx").cast("binary").alias("key"), F.lit("x").cast("binary").alias("value"))
    found = stores.episode_dim(meta.unionByName(data))
    source, _ = stores.video_source(found.select("part"), found.select("part"))
    return found.select("part", "ep_idx", "episode", F.lit(source).alias("source"))


@query("""SELECT part, count(*) AS entries, (sum(n) + 4)::BIGINT AS bytes FROM (SELECT 'part-' || (l_suppkey % 5) AS part, 3 AS n FROM (SELECT DISTINCT l_orderkey, l_suppkey % 5 AS l_suppkey FROM lineitem WHERE l_orderkey % 7 = 0)
  UNION ALL SELECT 'part-' || s, 0 FROM range(5) t(s)) GROUP BY 1""")
def copied_keys(spark, sf_dir):
    """Metadata and every seventh episode of each store, copied and inspected."""
    part = F.concat(F.lit("part-"), (F.col("l_suppkey") % 5).cast("string")).alias("part")
    all_keys = table(spark, sf_dir, "lineitem").select(part, F.col("l_orderkey").alias("ep_idx"), F.lit(0).alias("frame_offset")).distinct()
    data = all_keys.select(F.lit("s").alias("store"), "part", F.format_string("(%d, %d)", "ep_idx", "frame_offset").cast("binary").alias("key"), F.lit("abc").cast("binary").alias("value"))
    meta = spark.range(5).select(F.lit("s").alias("store"), F.concat(F.lit("part-"), F.col("id").cast("string")).alias("part"), F.lit("__len__").cast("binary").alias("key"), F.lit("1234").cast("binary").alias("value"))
    copied = stores.copy_keys(meta.unionByName(data), all_keys.where("ep_idx % 7 = 0"))
    return stores.inspect(copied).select("part", "entries", "bytes")


@query("SELECT l_suppkey, count(*) AS n, max(rn) AS last FROM (SELECT l_suppkey, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey) AS rn FROM lineitem) WHERE rn <= 50 GROUP BY 1")
def scan_bounds(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey")
    return sample.scan_until(l, "l_suppkey", 50, ["l_orderkey", "l_linenumber", "l_partkey"]).groupBy("l_suppkey").agg(F.count("*").alias("n"), F.count("*").alias("last"))


@query(f"""WITH o AS (SELECT image_id, count(DISTINCT category_id) AS own FROM {_ANN} GROUP BY 1), c AS (SELECT count(DISTINCT p_type) AS n FROM part)
  SELECT o_orderkey AS image_id, (coalesce(own, 0) + least(5, n - coalesce(own, 0)))::INT AS categories FROM orders LEFT JOIN o ON o_orderkey = image_id, c""")
def training_captions(spark, sf_dir):
    """Every image's prompt names its categories and five it lacks."""
    return pipelines.training_captions(dataset(spark, sf_dir)).select("image_id", F.size("spans").alias("categories"))


@query(f"""SELECT key_frame, (5 + key_frame % 50 + 3 + key_frame % 40)::BIGINT AS area, replace(part, 'part-', '')::INT AS number, event AS label, lower(event) || '.' AS caption FROM {sql('observations')}""")
def sql_function_calls(spark, sf_dir):
    """The functions registered for SQL."""
    sql_functions.register(spark)
    o = adapted(spark, sf_dir, "observations")
    return o.select("key_frame", F.expr("rle_area(rle)").alias("area"), F.expr("part_number(part)").alias("number"), F.expr("event_label(event)").alias("label"), F.expr("caption_text(event)").alias("caption"))


@query("SELECT p_partkey, rank::BIGINT AS rank FROM (SELECT p_partkey, row_number() OVER (ORDER BY md5(p_partkey || ':42'), p_partkey) AS rank FROM part)")
def shuffled_places(spark, sf_dir):
    """Places of parts in a seeded shuffle, numbered without a task for all."""
    return keys.dense_numbers(sample.shuffled(table(spark, sf_dir, "part").select("p_partkey"), ["p_partkey"]), [sample.seeded(["p_partkey"]), F.col("p_partkey")], "rank")
