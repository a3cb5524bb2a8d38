"""Box geometry as Column expressions (all inside code generation).

Three intersection-over-union rules exist and stay apart: ``iou`` clamps and
guards, ``iou_eps`` adds a small number to the union, ``iou_raw`` does neither.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class Box(NamedTuple):
    """Corners."""

    x1: Column
    y1: Column
    x2: Column
    y2: Column

    def struct(self) -> Column:
        return F.struct(*[c.alias(n) for n, c in zip(self._fields, self, strict=True)])


def box(*columns) -> Box:
    """From four columns, or from one struct column with x1, y1, x2, y2."""
    if len(columns) == 1:
        c = F.col(columns[0]) if isinstance(columns[0], str) else columns[0]
        return Box(c["x1"], c["y1"], c["x2"], c["y2"])
    return Box(*[F.col(c) if isinstance(c, str) else c for c in columns])


def of_array(a: Column) -> Box:
    """Corners stored as an array."""
    return Box(*[F.get(a, i) for i in range(4)])


def of_cxcywh(cx, cy, w, h) -> Box:
    cx, cy, w, h = box(cx, cy, w, h)
    return Box(cx - w / 2, cy - h / 2, cx + w / 2, cy + h / 2)


def of_xywh(x, y, w, h) -> Box:
    x, y, w, h = box(x, y, w, h)
    return Box(x, y, x + w, y + h)


def to_cxcywh(b: Box) -> tuple[Column, Column, Column, Column]:
    return (b.x1 + b.x2) / 2, (b.y1 + b.y2) / 2, b.x2 - b.x1, b.y2 - b.y1


def to_xywh(b: Box) -> tuple[Column, Column, Column, Column]:
    return b.x1, b.y1, b.x2 - b.x1, b.y2 - b.y1


def area(b: Box, clamp: bool = False) -> Column:
    w, h = b.x2 - b.x1, b.y2 - b.y1
    return F.greatest(w, F.lit(0.0)) * F.greatest(h, F.lit(0.0)) if clamp else w * h


def intersection(a: Box, b: Box) -> Column:
    w = F.least(a.x2, b.x2) - F.greatest(a.x1, b.x1)
    h = F.least(a.y2, b.y2) - F.greatest(a.y1, b.y1)
    return F.greatest(w, F.lit(0.0)) * F.greatest(h, F.lit(0.0))


def union(a: Box, b: Box, clamp: bool = False) -> Column:
    return area(a, clamp) + area(b, clamp) - intersection(a, b)


def iou(a: Box, b: Box) -> Column:
    """Sides below zero count as zero; an empty union, or a missing box, gives 0."""
    u = union(a, b, clamp=True)
    return F.coalesce(F.when(u > 0, intersection(a, b) / u), F.lit(0.0))


def iou_eps(a: Box, b: Box, eps: float = 1e-6) -> Column:
    return intersection(a, b) / (union(a, b) + eps)


def iou_raw(a: Box, b: Box) -> Column:
    """Zero over zero is NaN, as in floating point."""
    u = union(a, b)
    return F.when(u.isNull(), None).otherwise(F.coalesce(F.try_divide(intersection(a, b), u), F.lit(float("nan"))))


def giou(a: Box, b: Box, eps: float = 0.0) -> Column:
    """IoU less the share of the hull that neither covers.  ``eps`` 1e-6 for the all-pairs form."""
    hull = (F.greatest(a.x2, b.x2) - F.least(a.x1, b.x1)) * (F.greatest(a.y2, b.y2) - F.least(a.y1, b.y1))
    u = union(a, b)
    return F.try_divide(intersection(a, b), u + eps) - F.try_divide(hull - u, hull + eps)


def ordered(b: Box) -> Column:
    return (b.x2 >= b.x1) & (b.y2 >= b.y1)


def assert_ordered(b: Box) -> Column:
    return F.assert_true(ordered(b), "box corners are not ordered")


def iou_band(value: Column) -> Column:
    return F.when(value >= 0.75, ">=0.75").when(value >= 0.5, ">=0.5").when(value >= 0.25, ">=0.25").otherwise("<0.25")


def scale(b: Box, sx, sy) -> Box:
    return Box(b.x1 * sx, b.y1 * sy, b.x2 * sx, b.y2 * sy)


def scale_xywh(bbox: Column, src: tuple, dst: tuple) -> Column:
    """Array x, y, w, h from one (height, width) to another."""
    sy, sx = F.lit(dst[0]) / F.lit(src[0]), F.lit(dst[1]) / F.lit(src[1])
    return F.transform(bbox, lambda v, i: v * F.when(i % 2 == 0, sx).otherwise(sy))


def clamp(b: Box, width, height) -> Box:
    """Inside the image; rows where :func:`proper` then fails are degenerate."""
    fit = lambda v, top: F.greatest(F.lit(0.0), F.least(v, top * F.lit(1.0)))
    return Box(fit(b.x1, F.lit(width)), fit(b.y1, F.lit(height)), fit(b.x2, F.lit(width)), fit(b.y2, F.lit(height)))


def proper(b: Box) -> Column:
    return (b.x2 > b.x1) & (b.y2 > b.y1)


def denormalise(b: Box, width, height) -> Box:
    return scale(b, width, height)


def normalise_cxcywh(b: Box, width, height) -> tuple[Column, ...]:
    """Centre form divided by the image's size."""
    cx, cy, w, h = to_cxcywh(b)
    return cx / width, cy / height, w / width, h / height


def crop(b: Box, top, left, height, width) -> Box:
    """Shifted into the crop and clipped to it."""
    return clamp(Box(b.x1 - left, b.y1 - top, b.x2 - left, b.y2 - top), width, height)


def crop_targets(targets: Column, top, left, height, width) -> Column:
    """Crop an array of structs with x1, y1, x2, y2 (and whatever else), drop the emptied ones, refresh ``area``."""

    def one(t):
        b = crop(box(t), top, left, height, width)
        return t.withField("x1", b.x1).withField("y1", b.y1).withField("x2", b.x2).withField("y2", b.y2).withField("area", area(b))

    return F.filter(F.transform(targets, one), lambda t: (t["x2"] > t["x1"]) & (t["y2"] > t["y1"]))


def flip(b: Box, width) -> Box:
    return Box(width - b.x2, b.y1, width - b.x1, b.y2)


def resized(width: Column, height: Column, size: int, max_size: int | None = None) -> tuple[Column, Column]:
    """(width, height) with the short side ``size``, the long one at most ``max_size``; fractions are cut off."""
    short, long_ = F.least(width, height), F.greatest(width, height)
    want = F.lit(size)
    if max_size is not None:
        want = F.when(long_ / short * size > max_size, F.bround(F.lit(max_size) * short / long_, 0).cast("int")).otherwise(want)
    other = F.floor(want * long_ / short).cast("int")
    same = short == want
    w = F.when(same, width).when(width < height, want).otherwise(other)
    h = F.when(same, height).when(width < height, other).otherwise(want)
    return w.cast("int"), h.cast("int")


def resize(b: Box, area_: Column, old: tuple, new: tuple) -> tuple[Box, Column]:
    """Box and area after a resize from (width, height) to (width, height)."""
    rx, ry = new[0] / old[0], new[1] / old[1]
    return scale(b, rx, ry), area_ * (rx * ry)


def padded(width: Column, height: Column, right, bottom) -> tuple[Column, Column]:
    """Padding at the right and the bottom changes the size alone; boxes stay."""
    return width + right, height + bottom


def centre_crop_box(width: Column, height: Column, fraction: float) -> Column:
    """Placeholder x, y, w, h in the middle of the image; sizes cut to integers."""
    w, h = (width * fraction).cast("int"), (height * fraction).cast("int")
    return F.array(*[c.cast("double") for c in (F.floor((width - w) / 2), F.floor((height - h) / 2), w, h)])


def random_box(seed: int, least: float = 0.05) -> Box:
    """Corners of a seeded random box in the unit square."""
    w, h = F.rand(seed) * (1 - least) + least, F.rand(seed + 1) * (1 - least) + least
    x, y = F.rand(seed + 2) * (1 - w), F.rand(seed + 3) * (1 - h)
    return Box(x, y, x + w, y + h)


def jitter(b: Box, noise: float, key: Column, seed: int = 42) -> Box:
    """Corners moved by up to ``noise`` times the sides, the same for the same key; kept in the unit square."""
    u = lambda k: F.pmod(F.xxhash64(key, F.lit(seed + k)), F.lit(2_000_001)) / 1_000_000.0 - 1
    w, h = b.x2 - b.x1, b.y2 - b.y1
    moved = Box(b.x1 + u(0) * w * noise, b.y1 + u(1) * h * noise, b.x2 + u(2) * w * noise, b.y2 + u(3) * h * noise)
    return Box(*[F.greatest(F.lit(0.0), F.least(F.lit(1.0), v)) for v in moved])


def random_crop(width: Column, height: Column, key: Column, least: int, most: int, seed: int = 42) -> tuple[Column, Column, Column, Column]:
    """(top, left, height, width) of a crop chosen by a hash of ``key``."""
    pick = lambda k, n: F.pmod(F.xxhash64(key, F.lit(seed + k)), F.greatest(n, F.lit(1)).cast("long"))
    w = F.lit(least) + pick(0, F.least(width, F.lit(most)) - least + 1)
    h = F.lit(least) + pick(1, F.least(height, F.lit(most)) - least + 1)
    return pick(2, height - h + 1), pick(3, width - w + 1), h, w


def proposals(valid_w: int, valid_h: int, level: int) -> Column:
    """Array of cell-centred boxes (cx, cy, w, h) of a feature map: sides 0.05 x 2^level."""
    side = 0.05 * 2.0**level
    row = lambda y: F.transform(
        F.sequence(F.lit(0), F.lit(valid_w - 1)),
        lambda x: F.struct(((x + 0.5) / valid_w).alias("cx"), ((y + 0.5) / valid_h).alias("cy"), F.lit(side).alias("w"), F.lit(side).alias("h")),
    )
    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(valid_h - 1)), row))


def proposal_valid(p: Column) -> Column:
    """All four coordinates strictly within 0.01 and 0.99."""
    return F.forall(F.array(p["cx"], p["cy"], p["w"], p["h"]), lambda v: (v > 0.01) & (v < 0.99))


def proposal_logit(p: Column) -> Column:
    """Log odds of each coordinate; infinite where the proposal isn't valid."""
    return F.transform(F.array(p["cx"], p["cy"], p["w"], p["h"]), lambda v: F.when(proposal_valid(p), F.ln(v / (1 - v))).otherwise(F.lit(float("inf"))))
