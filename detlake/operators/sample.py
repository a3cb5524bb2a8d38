"""Top-k, caps, samples and splits; all seeded by hashes, so they don't depend on partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .keys import dense_numbers


def seeded(columns: Sequence[str], seed: int = 42) -> Column:
    """A pseudo-random order: the MD5 of the row's key and the seed, which any engine can repeat."""
    return F.md5(F.concat_ws(":", *[F.col(c).cast("string") for c in columns], F.lit(str(seed))))


def category_counts(annotations: DataFrame, category: str = "category_id", order: Sequence[str] = ("id",)) -> DataFrame:
    """(category, n, first): how often and where first each category appears."""
    return annotations.groupBy(category).agg(F.count("*").alias("n"), F.min(F.struct(*order)).alias("first"))


def keep_categories(counts: DataFrame, min_per_cat: int = 1, top_k: int | None = None) -> DataFrame:
    """Categories with enough annotations, the ``top_k`` most frequent; ties to the first seen."""
    kept = counts.where(F.col("n") >= min_per_cat).orderBy(F.desc("n"), "first")
    return kept if top_k is None else kept.limit(top_k)


def cap_per_group(df: DataFrame, group: Sequence[str], n: int, order: Sequence[Column | str]) -> DataFrame:
    """At most ``n`` rows of a group, the first by ``order``; Spark cuts to n a task before it shuffles."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def sample_per_group(df: DataFrame, group: Sequence[str], n: int, key: Sequence[str], seed: int = 42) -> DataFrame:
    return cap_per_group(df, group, n, [seeded(key, seed), *key])


def first_per_group(df: DataFrame, group: Sequence[str], n: int, order: Sequence[str]) -> DataFrame:
    return cap_per_group(df, group, n, order)


def spread_per_group(df: DataFrame, group: Sequence[str], n: int, order: Sequence[str]) -> DataFrame:
    """At most ``n`` evenly spaced rows: every max(1, size div n)-th, from the first."""
    w = Window.partitionBy(*group)
    step = F.greatest(F.lit(1), F.floor(F.col("_n") / n)).cast("long")
    ranked = df.withColumn("_n", F.count("*").over(w)).withColumn("_rn", F.row_number().over(w.orderBy(*order)) - 1)
    return ranked.where((F.pmod(F.col("_rn"), step) == 0) & (F.col("_rn") / step < n)).drop("_n", "_rn")


def subsample(annotations: DataFrame, images: DataFrame, categories: DataFrame, max_per_cat: int | None = None, min_per_cat: int = 1, top_k: int | None = None, order: Sequence[Column | str] | None = None, seed: int = 42) -> dict[str, DataFrame]:
    """Annotations of frequent categories, capped for each, with the images they use; ids are made anew.

    ``order`` says which rows a cap keeps (default: a seeded hash of the id).
    Image ids follow the old ones; annotation and category ids follow old ids.
    """
    kept = keep_categories(category_counts(annotations), min_per_cat, top_k).select("category_id")
    rows = annotations.join(F.broadcast(kept), "category_id", "left_semi")  # categories: a dimension
    if max_per_cat is not None:
        rows = cap_per_group(rows, ["category_id"], max_per_cat, order or [seeded(["id"], seed), "id"])
    used = images.join(rows.select(F.col("image_id").alias("id")).distinct(), "id", "left_semi")
    new_image = dense_numbers(used.select(F.col("id").alias("image_id")), [F.col("image_id")], "new_image_id")
    new_cat = dense_numbers(kept, [F.col("category_id")], "new_category_id")
    out = rows.join(new_image, "image_id").join(F.broadcast(new_cat), "category_id")
    out = out.drop("image_id", "category_id").withColumnsRenamed({"new_image_id": "image_id", "new_category_id": "category_id"})
    out = dense_numbers(out, [F.col("id")], "new_id").drop("id").withColumnRenamed("new_id", "id").select(*annotations.columns)
    imgs = used.join(new_image, used["id"] == new_image["image_id"]).select(*[F.col("new_image_id").alias("id") if c == "id" else used[c] for c in images.columns])
    cats = categories.join(F.broadcast(new_cat), categories["id"] == new_cat["category_id"]).select(*[F.col("new_category_id").alias("id") if c == "id" else categories[c] for c in categories.columns])
    return {"annotations": out, "images": imgs, "categories": cats}


def take_first(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    return df.orderBy(*order).limit(n)


def take_uniform(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """Rows at int(i x total / n) for i below n; all, if there are fewer."""
    numbered = dense_numbers(df, [F.col(c) for c in order], "_i", 0)
    total = df.agg(F.count("*").alias("_t"))
    places = total.select(F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("i"), "_t").select(F.when(F.col("_t") <= n, F.col("i")).otherwise(F.floor(F.col("i") * F.col("_t") / n)).alias("_i"))
    return numbered.join(F.broadcast(places.distinct()), "_i", "left_semi").drop("_i")  # n rows


def validation_split(df: DataFrame, key: Sequence[str], fraction: float = 0.1, seed: int = 42) -> DataFrame:
    """``is_val`` for exactly max(1, int(n x fraction)) rows, by hashed order."""
    numbered = dense_numbers(df, [seeded(key, seed), *map(F.col, key)], "_i", 0)
    total = df.agg(F.greatest(F.lit(1), F.floor(F.count("*") * F.lit(fraction))).alias("_v"))
    return numbered.join(F.broadcast(total)).withColumn("is_val", F.col("_i") < F.col("_v")).drop("_i", "_v")


def shuffled(df: DataFrame, key: Sequence[str], seed: int = 42) -> DataFrame:
    return df.orderBy(seeded(key, seed), *key)


def batches(df: DataFrame, workers: int, order: Sequence[str], least: int = 100) -> DataFrame:
    """``batch``: contiguous, of ceil(n / workers) rows; one batch up to ``least`` rows."""
    numbered = dense_numbers(df, [F.col(c) for c in order], "_i", 0)
    size = df.agg(F.count("*").alias("n")).select(F.when(F.col("n") <= least, F.greatest(F.col("n"), F.lit(1))).otherwise(F.ceil(F.col("n") / workers)).alias("_s"))
    return numbered.join(F.broadcast(size)).withColumn("batch", F.floor(F.col("_i") / F.col("_s"))).drop("_i", "_s")


def negatives(images: DataFrame, annotations: DataFrame, categories: DataFrame, n: int = 5, seed: int = 42) -> DataFrame:
    """(image_id, category_id): ``n`` random categories that an image lacks (all it lacks, if fewer).

    Each of a bounded number of draws is a hash of image, place and seed of its
    own, so images meet some categories only; the few whose draws repeat too often
    take the missing ones in the order of a hash of image and category.
    """
    cats = categories.select(F.array_sort(F.collect_list("id")).alias("c"))  # a dimension
    own = annotations.groupBy("image_id").agg(F.collect_set("category_id").alias("own"))
    rows = images.select(F.col("id").alias("image_id")).join(own, "image_id", "left").join(F.broadcast(cats))
    rows = rows.select("image_id", "c", F.array_intersect(F.coalesce("own", F.array().cast("array<bigint>")), "c").alias("own"))
    size = F.size("c")
    draw = lambda i: F.get("c", F.pmod(F.xxhash64("image_id", i, F.lit(seed)), F.greatest(size, F.lit(1)).cast("long")).cast("int"))
    drawn = F.array_distinct(F.transform(F.sequence(F.lit(1), 2 * (F.size("own") + n) + 8), draw))
    lacks = lambda a: F.slice(F.filter(a, lambda c: c.isNotNull() & ~F.array_contains("own", c)), 1, n)
    ordered = F.transform(F.array_sort(F.transform("c", lambda c: F.struct(F.xxhash64("image_id", c, F.lit(seed)).alias("h"), c.alias("c")))), lambda x: x["c"])
    enough = F.size(lacks(drawn)) >= F.least(F.lit(n), size - F.size("own"))
    return rows.select("image_id", F.explode(F.when(enough, lacks(drawn)).otherwise(lacks(ordered))).alias("category_id"))


def paired_sample(chunks: DataFrame, pairs: DataFrame, per_part: int = 10) -> DataFrame:
    """Keys of the first ``per_part`` event chunks of each segmentation part, with the image part they are matched to."""
    some = cap_per_group(chunks.where("has_event"), ["part"], per_part, ["ep_idx", "frame_offset"])
    return some.join(pairs.select(F.col("seg_part").alias("part"), "src_part"), "part")


def chunks_with_events(observations: DataFrame, chunk: int = 32) -> DataFrame:
    """(part, ep_idx, frame_offset, has_event): chunks with a mask under a specific event."""
    plain = F.col("event").isin("right_click", "landmark", "attack")
    real = F.col("event").isNotNull() & ~plain & (F.trim(F.coalesce("rle", F.lit(""))) != "")
    return observations.groupBy("part", "ep_idx", (F.col("frame") - F.pmod("frame", F.lit(chunk))).alias("frame_offset")).agg(F.bool_or(real).alias("has_event"))


def scan_until(df: DataFrame, part: str, fraction_rows: int, order: Sequence[str]) -> DataFrame:
    """The first rows of each part: what an early-stopped scan of every part would have read at most."""
    return cap_per_group(df, [part], fraction_rows, order)
