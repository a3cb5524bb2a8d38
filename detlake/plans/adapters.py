"""The engine's tables derived from the given ones, by one SQL text for Spark and for the checking engine.

Names of given tables stand in braces.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

ADAPTERS = {
    # ground truth (corners, 0-1) and a prediction that is the same box, shifted
    "boxes": """SELECT l_orderkey AS image_id, l_partkey, l_suppkey, l_linenumber, l_returnflag,
      (l_quantity - 1) / 100 AS gx1, (l_linenumber - 1) / 14.0e0 AS gy1, (l_quantity - 1) / 100 + (0.2e0 + l_discount) AS gx2, (l_linenumber - 1) / 14.0e0 + (0.2e0 + l_tax) AS gy2,
      (l_quantity - 1) / 100 + 2.5e0 * l_tax AS px1, (l_linenumber - 1) / 14.0e0 + 2.5e0 * l_discount AS py1,
      (l_quantity - 1) / 100 + (0.2e0 + l_discount) + 2.5e0 * l_tax AS px2, (l_linenumber - 1) / 14.0e0 + (0.2e0 + l_tax) + 2.5e0 * l_discount AS py2,
      l_extendedprice / 110000.0e0 AS score, l_returnflag <> 'R' AS has_prediction FROM {lineitem}""",
    # annotations in pixels of a 640 x 360 image
    "annotations": """SELECT l.l_orderkey AS image_id, l.l_partkey, l.l_suppkey, l.l_linenumber, p.p_type AS category,
      (l.l_quantity - 1) * 6.4e0 AS box_x, (l.l_linenumber - 1) * 25.0e0 AS box_y, (0.02e0 + 7 * l.l_discount) * 640.0e0 AS box_w, (0.02e0 + 10 * l.l_tax) * 360.0e0 AS box_h,
      640 AS width, 360 AS height FROM {lineitem} l JOIN {part} p ON l.l_partkey = p.p_partkey""",
    # an action timeline per user: one frame an event, idle at errors
    "timeline": """SELECT CAST(user_id AS INT) AS ep_idx, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS INT) AS frame,
      CASE WHEN event_type = 'error' THEN 0 ELSE 1 END AS attack, event_id, event_type, value FROM {events}""",
    # event strings of the kinds that occur
    "labels": """SELECT event_id, CASE CAST(event_id % 9 AS INT) WHEN 0 THEN 'mine_block:' || event_type WHEN 1 THEN 'minecraft.mine_block:minecraft.' || event_type WHEN 2 THEN 'a:b:' || event_type
      WHEN 3 THEN 'craft:' || event_type WHEN 4 THEN 'right_click' WHEN 5 THEN 'a:' WHEN 6 THEN '' WHEN 7 THEN event_type ELSE 'custom:x' END AS event FROM {events}""",
    # segmentation observations: a window per event, a run-length mask, a place
    "observations": """SELECT 'part-' || CAST(user_id % 7 * 50 AS STRING) AS part, CAST(user_id AS INT) AS ep_idx, CAST(event_id % 400 AS INT) AS frame, CAST(event_id AS INT) AS key_frame, event_type AS event,
      CAST(event_id % 1000 * 200 AS STRING) || ' ' || CAST(5 + event_id % 50 AS STRING) || ' ' || CAST(event_id % 1000 * 200 + 640 AS STRING) || ' ' || CAST(3 + event_id % 40 AS STRING) AS rle,
      CAST(event_id % 360 AS INT) AS point_row, CAST(event_id % 640 AS INT) AS point_col, CAST(event_id % 400 / 10 * 10 AS INT) AS fr_s, CAST(event_id % 400 AS INT) AS fr_e FROM {events}""",
    "episodes": """SELECT DISTINCT 'part-' || CAST(user_id % 7 * 50 AS STRING) AS part, CAST(user_id AS INT) AS ep_idx, 'Player' || CAST(user_id % 40 AS STRING) || '-abc-2021010' || CAST(user_id % 5 AS STRING) || '-12' || CAST(1000 + user_id AS STRING) AS episode FROM {events}""",
    "videos": """SELECT 'Player' || CAST(c_custkey % 40 AS STRING) || '-abc-2021010' || CAST(c_custkey % 5 AS STRING) || '-12' || CAST(1000 + c_custkey % 150 AS STRING) AS stem, '/v/' || CAST(c_custkey AS STRING) || '.mp4' AS path, CAST(c_custkey % 4 * 17 AS INT) AS n_frames FROM {customer}""",
}


def sql(name: str) -> str:
    """The adapter as a subquery over registered tables."""
    return "(" + re.sub(r"\{(\w+)\}", r"\1", ADAPTERS[name]).replace("AS STRING", "AS VARCHAR").replace("event_id % 400 / 10 * 10", "event_id % 400 // 10 * 10") + ")"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; Parquet schemas and statistics reach the scan."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def adapted(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text = ADAPTERS[name].replace("event_id % 400 / 10 * 10", "event_id % 400 div 10 * 10")
    return spark.sql(text, **{t: table(spark, sf_dir, t) for t in re.findall(r"\{(\w+)\}", text)})
