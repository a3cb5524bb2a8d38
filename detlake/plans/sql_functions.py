"""The scalar functions under SQL names: pure SQL bodies, inlined by the optimizer."""

from __future__ import annotations

from pyspark.sql import SparkSession

_BOX = ", ".join(f"{p}{c} DOUBLE" for p in "ab" for c in ("x1", "y1", "x2", "y2"))
_INTER = "(greatest(least(ax2, bx2) - greatest(ax1, bx1), 0D) * greatest(least(ay2, by2) - greatest(ay1, by1), 0D))"
_UNION = f"(greatest(ax2 - ax1, 0D) * greatest(ay2 - ay1, 0D) + greatest(bx2 - bx1, 0D) * greatest(by2 - by1, 0D) - {_INTER})"
_HULL = "((greatest(ax2, bx2) - least(ax1, bx1)) * (greatest(ay2, by2) - least(ay1, by1)))"
_NUMBERS = "transform(filter(split(trim(coalesce(rle, '')), ' +'), x -> x <> ''), x -> CAST(x AS INT))"
_S = "replace(event, 'minecraft.', '')"

FUNCTIONS = {
    "iou": (_BOX, "DOUBLE", f"coalesce(CASE WHEN {_UNION} > 0 THEN {_INTER} / {_UNION} END, 0D)"),
    "giou": (_BOX, "DOUBLE", f"try_divide({_INTER}, {_UNION}) - try_divide({_HULL} - {_UNION}, {_HULL})"),
    "rle_area": ("rle STRING", "BIGINT", f"aggregate(filter({_NUMBERS}, (x, i) -> i % 2 = 1), 0L, (a, x) -> a + x)"),
    "event_label": (
        "event STRING", "STRING",
        f"CASE WHEN event IS NULL OR event = '' THEN NULL WHEN instr({_S}, ':') > 0 THEN CASE WHEN substring_index({_S}, ':', 1) IN ('custom', 'open_chest', 'craft') THEN NULL "
        f"ELSE nullif(trim(substring({_S}, instr({_S}, ':') + 1)), '') END WHEN {_S} IN ('right_click', 'landmark', 'attack', 'craft') THEN NULL ELSE nullif(trim({_S}), '') END",
    ),
    "part_number": ("name STRING", "INT", "coalesce(try_cast(substring_index(name, '-', -1) AS INT), 0)"),
    "caption_text": ("text STRING", "STRING", "CASE WHEN endswith(lower(trim(text)), '.') THEN lower(trim(text)) ELSE concat(lower(trim(text)), '.') END"),
}


def register(spark: SparkSession) -> list[str]:
    """Create the functions for this session and return their names."""
    for name, (args, kind, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURNS {kind} RETURN {body}")
    return list(FUNCTIONS)
