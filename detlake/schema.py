"""Typed tables of the engine.

Boxes are kept raw (doubles, never rounded in the lake); their encoding is part
of the column name: ``bbox`` is x, y, width, height in pixels, ``box`` a struct
of corners.  Points are (row, column).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

IMAGES = "id LONG, file_name STRING, width INT, height INT"
ANNOTATIONS = "id LONG, image_id LONG, category_id LONG, bbox ARRAY<DOUBLE>, area DOUBLE, iscrowd INT, event_type STRING"
CATEGORIES = "id LONG, name STRING, supercategory STRING"
COCO = f"images ARRAY<STRUCT<{IMAGES}>>, annotations ARRAY<STRUCT<{ANNOTATIONS}>>, categories ARRAY<STRUCT<{CATEGORIES}>>"
GROUND_TRUTH = "MAP<STRING, STRUCT<task STRING, image STRING, prompt STRING, interaction_type STRING, bbox ARRAY<DOUBLE>, label STRING>>"
RESULTS = "task STRING, label STRING, iou DOUBLE, gt_bbox ARRAY<DOUBLE>, pred_bbox ARRAY<DOUBLE>, pred_score DOUBLE, has_prediction BOOLEAN"
KV = "store STRING, part STRING, key BINARY, value BINARY"
EPISODES = "kind STRING, part STRING, ep_idx INT, episode STRING, num_frames INT"
SEG_OBS = (
    "part STRING, ep_idx INT, frame INT, key_frame INT, event STRING, rle STRING, point_row INT, point_col INT, "
    "fr_s INT, fr_e INT, ofr_s INT, ofr_e INT"
)
SEG_CHUNK = (
    "ARRAY<MAP<STRUCT<frame: INT, event: STRING>, STRUCT<event: STRING, rle_mask: STRING, point: STRUCT<row: INT, col: INT>, "
    "frame_range: STRUCT<s: INT, e: INT>, ori_frame_range: STRUCT<s: INT, e: INT>>>>"
)
ACTIONS = "part STRING, ep_idx INT, frame INT, attack INT, use INT"
VIDEOS = "stem STRING, path STRING, n_frames INT"
EPISODE_CHUNKS = "episode STRING, path STRING, start LONG, end LONG"
PREDICTIONS = "image_id LONG, query INT, cx DOUBLE, cy DOUBLE, w DOUBLE, h DOUBLE, score DOUBLE, logits ARRAY<FLOAT>"
INVENTORY = "frame INT, inventory ARRAY<STRUCT<type: STRING, quantity: INT>>"
#: Frames per stored chunk, and (height, width) of masks and of stored images: fixed by the format.
CHUNK_FRAMES, MASK_SIZE, IMAGE_SIZE = 32, (360, 640), (224, 224)


def violations(df: DataFrame, **rules) -> DataFrame:
    """One row with the number of rows that break each rule (a boolean Column; null breaks it too)."""
    return df.agg(*[F.count_if(~F.coalesce(rule, F.lit(False))).alias(name) for name, rule in rules.items()])


def foreign_key_violations(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Rows of ``child`` whose key has no row in ``parent``."""
    return child.join(parent.select(F.col(key).alias(column)).distinct(), column, "left_anti")
