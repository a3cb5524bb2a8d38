"""Whole jobs, each a function from tables to tables."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import frames, labels, rle
from ..operators import align, coco, keys, metrics, quality, sample, timeline


class Built(NamedTuple):
    dataset: coco.Dataset
    reasons: DataFrame


def tracked_events(observations: DataFrame, key: tuple[str, ...] = ("part", "ep_idx", "event", "fr_s", "fr_e"), mode: str = "first") -> DataFrame:
    """One row per labelled event: observations at the last frame of their window, first in scan order."""
    o = observations.withColumn("label", labels.event_label(F.col("event"), mode)).where(F.col("label").isNotNull() & (F.col("frame") == F.col("fr_e")))
    return keys.first_wins(o, list(key), ["part", "ep_idx", "frame", "key_frame"])


def masked_rows(frame_rows: DataFrame, size: tuple[int, int] = (360, 640), min_area: int = 3000, max_fraction: float = 0.35) -> DataFrame:
    """Boxes of masks whose written area is within bounds (both included); ``reason`` says why a row goes.

    The cheap test comes first; the component at the point is found only for rows that pass it.
    """
    area = rle.text_area(F.col("rle"))
    cap = int(size[0] * size[1] * max_fraction)
    rows = frame_rows.withColumn("mask_px", area)
    reason = F.when(F.col("rle").isNull() | (F.trim("rle") == ""), "no_mask").when(F.col("mask_px") < min_area, "too_small").when(F.col("mask_px") > cap, "too_large")
    rows = rows.withColumn("reason", reason)
    good = rows.where("reason IS NULL").withColumn("runs", rle.filter_by_point(rle.runs(F.col("rle"), *size), size[0], size[1], F.col("point_row"), F.col("point_col")))
    boxed = good.withColumn("bbox", rle.bbox(F.col("runs"), size[1])).withColumn("reason", F.when(F.col("bbox").isNull(), "no_box"))
    none = F.lit(None)
    return boxed.unionByName(rows.where("reason IS NOT NULL").withColumn("runs", none.cast(rle.RUNS)).withColumn("bbox", none.cast("array<double>")))


def build_from_windows(observations: DataFrame, n_frames: int = 4, skip_tail: int = 4, min_area: int = 3000, max_fraction: float = 0.35, dataset: str = "ds", image_size: tuple[int, int] = (224, 224)) -> Built:
    """Frames spread over each event's window, masks joined by chunk, boxes scaled to the stored images."""
    ev = tracked_events(observations)
    want = ev.select("part", "ep_idx", "event", "label", F.explode(frames.training(F.col("fr_s"), F.col("fr_e"), n_frames, skip_tail)).alias("frame"))
    obs = observations.select("part", "ep_idx", "event", "frame", "key_frame", "rle", "point_row", "point_col")
    rows = masked_rows(align.frames_with_masks(want, obs), (360, 640), min_area, max_fraction)
    return _finish(rows, dataset, image_size)


def build_from_backtrack(observations: DataFrame, n_frames: int = 4, skip: int = 8, min_area: int = 500, max_fraction: float = 0.35, dataset: str = "ds") -> Built:
    """Frames that end some way before each event does; the first mask that fits an event counts."""
    ev = tracked_events(observations, ("part", "ep_idx", "event", "fr_e"))
    want = ev.select("part", "ep_idx", "event", "label", F.explode(frames.backtrack(F.col("fr_s"), F.col("fr_e"), n_frames, skip)).alias("frame"))
    found = align.mask_by_event(want, observations).select("part", "ep_idx", "event", "label", "frame", "rle", "point_row", "point_col")
    rows = masked_rows(found, (360, 640), 1, 1.0)
    px = rle.mask_area(F.col("runs"))
    rows = rows.withColumn("reason", F.coalesce("reason", F.when(px < min_area, "too_small").when(px / (360 * 640) > max_fraction, "too_large")))
    return _finish(rows, dataset, (360, 640))


def build_from_actions(observations: DataFrame, actions: DataFrame, n_frames: int = 8, dataset: str = "ds") -> Built:
    """Frames just before the attack began that led to each event."""
    ev = tracked_events(observations, ("part", "ep_idx", "event", "fr_e"))
    starts = timeline.attack_starts(actions, ev.select("part", "ep_idx", F.col("fr_s").alias("frame")), keys=["part", "ep_idx"])
    at = ev.join(starts.withColumnRenamed("frame", "fr_s"), ["part", "ep_idx", "fr_s"], "left").withColumn("anchor", frames.anchor(F.col("start"), F.col("fr_s")))
    want = at.where("anchor IS NOT NULL").select("part", "ep_idx", "event", "label", F.explode(frames.before(F.col("anchor"), n_frames)).alias("frame"))
    rows = align.mask_by_event(want, observations).select("part", "ep_idx", "event", "label", "frame", "rle", "point_row", "point_col")
    return _finish(masked_rows(rows, (360, 640), 500, 0.35), dataset, (360, 640))


def _finish(rows: DataFrame, dataset: str, image_size: tuple[int, int]) -> Built:
    reasons = quality.reason_counts(rows, ("no_mask", "too_small", "too_large", "no_box"))
    good = rows.where("reason IS NULL").select(
        "part", "ep_idx", "frame", F.col("event").alias("event_type"), F.col("label").alias("category"), "bbox",
        labels.frame_file(F.lit(dataset), F.col("part"), F.col("ep_idx"), F.col("frame")).alias("image_file"),
        F.lit(image_size[1]).alias("image_width"), F.lit(image_size[0]).alias("image_height"),
    )
    return Built(coco.build(good, ["part", "ep_idx", "frame", "event_type"], ("part", "ep_idx", "frame"), (360, 640) if image_size != (360, 640) else None), reasons)


def near_centre(rows: DataFrame, threshold: float, size: tuple[int, int] = (360, 640)) -> DataFrame:
    """Rows whose point lies near the image's centre (share of the half diagonal, inclusive); 0 turns the test off, no point fails it."""
    if threshold <= 0:
        return rows
    half = (size[0] ** 2 / 4 + size[1] ** 2 / 4) ** 0.5
    dist = F.sqrt(F.pow(F.col("point_row") - size[0] / 2, F.lit(2)) + F.pow(F.col("point_col") - size[1] / 2, F.lit(2)))
    return rows.where(F.coalesce(dist / half <= threshold, F.lit(False)))


def evaluate(truth: DataFrame, predictions: DataFrame, box_rule=None) -> tuple[DataFrame, DataFrame]:
    """(results, summary): the best prediction of every task against its true box (corners, 0-1)."""
    from ..functions import boxes
    from ..operators.postprocess import top_prediction

    best = top_prediction(predictions, truth.select("task", "label", "bbox"), "task")
    gt, pred = boxes.of_array(F.col("bbox")), boxes.box(F.col("box"))
    has = F.col("box").isNotNull()
    rows = best.select("task", "label", F.when(has, (box_rule or boxes.iou)(gt, pred)).otherwise(0.0).alias("iou"), F.col("bbox").alias("gt_bbox"), F.when(has, F.array(*pred)).alias("pred_bbox"), F.col("score").alias("pred_score"), has.alias("has_prediction"))
    return rows, metrics.summary(rows)


def evaluate_styles(truth: DataFrame, detect) -> DataFrame:
    """IoU of every task under each prompt style; ``detect(df of task, style, prompt, image)`` -> predictions keyed by task and style."""
    asked = truth.withColumn("v", F.explode(labels.prompt_variants(F.col("prompt"), F.col("label")))).select("task", "image", "label", "bbox", "v.style", "v.prompt")
    preds = detect(asked.select("task", "style", "prompt", "image"))
    keyed = asked.withColumn("task", F.concat_ws("|", "style", "task")).select("task", "label", "bbox")
    rows, _ = evaluate(keyed, preds.withColumn("task", F.concat_ws("|", "style", "task")))
    split = rows.select(F.substring_index("task", "|", 1).alias("style"), F.expr("substring(task, instr(task, '|') + 1)").alias("task"), "iou")
    return metrics.pivot_styles(split)


def quality_report(ds: coco.Dataset) -> dict[str, DataFrame]:
    """Every table of a dataset's quality report."""
    rows = coco.expand_box(coco.joined(ds))
    flagged = quality.suspicious(rows)
    return {
        "density": quality.density(ds.annotations, ds.images), "categories": quality.label_counts(rows, "category", 1 << 30), "stats": quality.box_stats(rows),
        "suspicious": flagged, "problems": quality.problem_counts(flagged), "verdicts": quality.verdicts(rows), "coverage": quality.histogram(quality.geometry(rows), "coverage"),
    }


def training_captions(ds: coco.Dataset, negatives: int = 5, seed: int = 42) -> DataFrame:
    """(image_id, caption, spans): an image's categories and some it lacks, in seeded order."""
    from ..functions import captions

    own = ds.annotations.select("image_id", "category_id").distinct()
    extra = sample.negatives(ds.images, ds.annotations, ds.categories, negatives, seed)
    names = F.broadcast(ds.categories.select(F.col("id").alias("category_id"), "name"))
    rows = own.unionByName(extra).join(names, "category_id")
    order = F.xxhash64("image_id", "category_id", F.lit(seed))
    packed = rows.groupBy("image_id").agg(F.array_sort(F.collect_list(F.struct(order.alias("o"), F.col("category_id").alias("id"), "name"))).alias("c"))
    made = captions.caption_and_spans(F.transform("c", lambda x: F.struct(x["id"], x["name"])))
    return packed.select("image_id", made.alias("m")).select("image_id", "m.caption", "m.spans")
