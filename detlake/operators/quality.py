"""Dataset quality: suspicious annotations, box statistics, histograms, verdicts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..scratch import cut


def geometry(rows: DataFrame) -> DataFrame:
    """Relative size and place of each box; inputs box_x, box_y, box_w, box_h, width, height."""
    w, h, iw, ih = (F.col(c) for c in ("box_w", "box_h", "width", "height"))
    dx, dy = F.col("box_x") + w / 2 - iw / 2, F.col("box_y") + h / 2 - ih / 2
    half = F.sqrt(F.pow(iw / 2, F.lit(2)) + F.pow(ih / 2, F.lit(2)))
    return rows.select(
        "*", (w / iw).alias("rel_w"), (h / ih).alias("rel_h"), (w * h).alias("box_area"), (w * h / (iw * ih)).alias("coverage"),
        (dx / iw).alias("off_x"), (dy / ih).alias("off_y"), (F.sqrt(dx * dx + dy * dy) / half).alias("centre_offset"),
    )


def problems() -> Column:
    """Array of tags of what looks wrong about a box, on the columns of :func:`geometry`."""
    y, w, h, ih = (F.col(c) for c in ("box_y", "box_w", "box_h", "height"))
    flat = h < ih * 0.3
    rules = {
        "very_large_bbox": F.col("coverage") > 0.5, "full_width": F.col("rel_w") > 0.8, "full_height": F.col("rel_h") > 0.8, "tiny_bbox": (w < 10) | (h < 10),
        "far_from_center": F.col("centre_offset") > 0.6, "possible_gui_top": (y < 30) & flat, "possible_gui_bottom": (y + h > ih - 50) & flat,
    }
    return F.array_compact(F.array(*[F.when(rule, F.lit(tag)) for tag, rule in rules.items()]))


def suspicious(rows: DataFrame) -> DataFrame:
    """Rows with at least one problem."""
    return geometry(rows).withColumn("problems", problems()).where(F.size("problems") > 0)


def problem_counts(flagged: DataFrame) -> DataFrame:
    """(problem, n); a detail in brackets after the tag doesn't count."""
    return flagged.select(F.explode("problems").alias("p")).groupBy(F.substring_index("p", "(", 1).alias("problem")).agg(F.count("*").alias("n"))


def medians(df: DataFrame, group: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Exact medians of each measure (``median_<measure>``) for every value of the group columns, null included.

    Values are counted, range-partitioned and ranked by the counts of the
    partitions before, so neither a group nor its distinct values meet in one task.
    """
    g = [f"_g{i}" for i in range(len(group))]
    long = df.select(*[F.col(c).alias(x) for c, x in zip(group, g, strict=True)], F.posexplode(F.array(*[F.col(m).cast("double") for m in measures])).alias("_m", "_v"))
    counted = long.where("_v IS NOT NULL").groupBy(*g, "_m", "_v").agg(F.count("*").alias("_n"))
    placed = cut(counted.repartitionByRange(*g, "_m", "_v").withColumn("_p", F.spark_partition_id()), "counted-values")
    each = Window.partitionBy(*g, "_m")
    ends = placed.groupBy(*g, "_m", "_p").agg(F.sum("_n").alias("_n"))
    ends = ends.select(*g, "_m", "_p", F.coalesce(F.sum("_n").over(each.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"), F.sum("_n").over(each).alias("_total"))
    ends = ends.select(*[F.col(c).alias(f"{c}_e") for c in (*g, "_m", "_p")], "_before", "_total")
    same = F.lit(True)
    for c in (*g, "_m", "_p"):
        same = same & F.col(c).eqNullSafe(F.col(f"{c}_e"))
    rows = placed.join(F.broadcast(ends), same)  # a row for each key and partition
    upto = F.sum("_n").over(Window.partitionBy(*g, "_m", "_p").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)) + F.col("_before")
    rows = rows.withColumn("_upto", upto)
    holds = lambda place: (F.col("_upto") - F.col("_n") <= place) & (place < F.col("_upto"))
    lo, hi = F.floor((F.col("_total") - 1) / 2), F.floor(F.col("_total") / 2)
    value = lambda i, place: F.max(F.when((F.col("_m") == i) & holds(place), F.col("_v")))
    found = rows.groupBy(*g).agg(*[((value(i, lo) + value(i, hi)) / 2).alias(f"median_{m}") for i, m in enumerate(measures)])
    return found.select(*[F.col(x).alias(c) for c, x in zip(group, g, strict=True)], *[f"median_{m}" for m in measures])


def box_stats(rows: DataFrame, group: str = "category") -> DataFrame:
    """Mean, exact median and population deviation of the geometry, overall (null category) and for each category."""
    measures = ["rel_w", "rel_h", "coverage", "centre_offset"]
    sized = geometry(rows)
    # every row counts in its category and overall
    both = sized.select(F.explode(F.array(F.struct(F.lit(True).alias("all"), F.lit(None).cast(sized.schema[group].dataType).alias("c")), F.struct(F.lit(False).alias("all"), F.col(group).alias("c")))).alias("k"), *measures)
    both = both.select(F.col("k.all").alias("_all"), F.col("k.c").alias(group), *measures)
    aggs = [f(m).alias(f"{name}_{m}") for m in measures for name, f in (("mean", F.avg), ("std", F.stddev_pop))]
    stats = both.groupBy("_all", group).agg(F.count("*").alias("n"), *aggs)
    middle = medians(both, ["_all", group], measures)
    found = stats.join(middle, (stats["_all"] == middle["_all"]) & stats[group].eqNullSafe(middle[group]), "left")
    return found.select(stats[group], "n", *[f"{name}_{m}" for m in measures for name in ("mean", "median", "std")])


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """(bin, lo, hi, n) over equal widths between the least and the greatest value, which is in the last bin."""
    ends = df.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    place = F.when(F.col("hi") == F.col("lo"), 0).otherwise(F.least(F.floor((F.col(column) - F.col("lo")) / width), F.lit(bins - 1)))
    found = df.where(F.col(column).isNotNull()).join(F.broadcast(ends)).groupBy(place.cast("int").alias("bin")).agg(F.count("*").alias("n"))
    every = ends.select(F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), "lo", "hi")
    return every.join(F.broadcast(found), "bin", "left").select("bin", (F.col("lo") + F.col("bin") * width).alias("lo"), (F.col("lo") + (F.col("bin") + 1) * width).alias("hi"), F.coalesce("n", F.lit(0)).alias("n"))


def extremes(df: DataFrame, key: str, *measures: str) -> DataFrame:
    """Least, median and greatest of each measure and the keys that have the extremes (ties: least key)."""
    aggs = []
    for m in measures:
        aggs += [
            F.min(m).alias(f"min_{m}"), F.max(m).alias(f"max_{m}"),
            F.min(F.struct(m, key))[key].alias(f"argmin_{m}"), F.min(F.struct((-F.col(m)).alias("v"), F.col(key).alias("k")))["k"].alias(f"argmax_{m}"),
        ]
    both = df.agg(*aggs).join(F.broadcast(medians(df, [], measures)))  # one row each
    return both.select(*[f"{name}_{m}" for m in measures for name in ("min", "median", "max", "argmin", "argmax")])


def verdicts(rows: DataFrame) -> DataFrame:
    """One row: centring, oversized share and suspicious share, each with its verdict."""
    g = geometry(rows).withColumn("bad", F.size(problems()) > 0)
    s = g.agg(F.avg("centre_offset").alias("bias"), F.avg((F.col("coverage") > 0.3).cast("double")).alias("large_share"), (100 * F.avg(F.col("bad").cast("double"))).alias("suspicious_pct"))
    three = lambda c, good, ok: F.when(F.col(c) < good, "GOOD").when(F.col(c) < ok, "OK").otherwise("WARN")
    return s.select("*", three("bias", 0.15, 0.25).alias("bias_verdict"), F.when(F.col("large_share") < 0.1, "GOOD").otherwise("WARN").alias("large_verdict"), three("suspicious_pct", 10, 25).alias("suspicious_verdict"))


def label_counts(df: DataFrame, label: str, n: int = 20) -> DataFrame:
    """The ``n`` most frequent labels; ties by name."""
    return df.groupBy(label).agg(F.count("*").alias("n")).orderBy(F.desc("n"), label).limit(n)


def reason_counts(df: DataFrame, reasons: tuple[str, ...], column: str = "reason") -> DataFrame:
    """One row: how many rows were dropped for each reason, and kept."""
    return df.agg(*[F.count_if(F.col(column) == r).alias(r) for r in reasons], F.count_if(F.col(column).isNull()).alias("kept"))


def merge_counters(parts: DataFrame, key: str = "name", value: str = "n") -> DataFrame:
    return parts.groupBy(key).agg(F.sum(value).alias(value))


def density(annotations: DataFrame, images: DataFrame) -> DataFrame:
    """Annotations, images and their ratio."""
    n = annotations.agg(F.count("*").alias("annotations"))
    return images.agg(F.count("*").alias("images")).join(F.broadcast(n)).withColumn("per_image", F.try_divide(F.col("annotations"), F.col("images")))
