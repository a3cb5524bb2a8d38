"""Detection datasets: images, annotations and categories as tables; ingest, build, merge, export."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema
from ..functions import boxes, labels
from .keys import dense_numbers, remap, surrogate_keys


class Dataset(NamedTuple):
    images: DataFrame
    annotations: DataFrame
    categories: DataFrame


def read(spark: SparkSession, path: str) -> Dataset:
    """From one JSON document (or a folder of them) with three arrays."""
    doc = spark.read.schema(schema.COCO).option("multiLine", True).json(path)
    return Dataset(*[doc.select(F.inline(name)) for name in ("images", "annotations", "categories")])


def document(ds: Dataset) -> DataFrame:
    """One row with the three arrays, ordered by id, numbers rounded to two places."""
    ann = ds.annotations.withColumn("bbox", F.transform("bbox", labels.export_round)).withColumn("area", labels.export_round(F.col("area")))
    pack = lambda df, name: df.agg(F.array_sort(F.collect_list(F.struct("id", *[c for c in df.columns if c != "id"]))).alias(name))
    one = pack(ds.images, "images").join(F.broadcast(pack(ann, "annotations"))).join(F.broadcast(pack(ds.categories, "categories")))
    return one  # one row a side: an interchange document is one object by definition


def write(ds: Dataset, path: str, as_document: bool = True) -> None:
    """As one JSON document, or as three Parquet tables (any size)."""
    if as_document:
        document(ds).coalesce(1).write.mode("overwrite").json(path)
        return
    for name, df in zip(Dataset._fields, ds, strict=True):
        df.write.mode("overwrite").parquet(f"{path}/{name}")


def expand_box(annotations: DataFrame) -> DataFrame:
    """box_x, box_y, box_w, box_h beside the array, so predicates stay in generated code."""
    return annotations.select("*", *[F.get("bbox", i).alias(n) for i, n in enumerate(("box_x", "box_y", "box_w", "box_h"))])


def detection_targets(ds: Dataset) -> DataFrame:
    """Annotations as corner boxes inside their image, degenerate ones dropped."""
    a = expand_box(ds.annotations).join(ds.images.select(F.col("id").alias("image_id"), "width", "height"), "image_id")
    b = boxes.clamp(boxes.of_xywh("box_x", "box_y", "box_w", "box_h"), F.col("width"), F.col("height"))
    return a.withColumn("box", b.struct()).where((F.col("box.x2") > F.col("box.x1")) & (F.col("box.y2") > F.col("box.y1"))).drop("box_x", "box_y", "box_w", "box_h")


def build(flat: DataFrame, order: Sequence[str], image_key: Sequence[str] = ("image_file",), size: tuple[int, int] | None = None) -> Dataset:
    """A dataset from flat rows: category, bbox, image_width, image_height and the image's key and file.

    Ids run from 1 in the order in which images, categories and annotations first
    appear.  Rows without a box are dropped.  ``size`` (height, width) rescales
    boxes from the masks' resolution to the image's.
    """
    rows = flat.where(F.col("bbox").isNotNull())
    if size is not None:
        sx, sy = F.col("image_width") / F.lit(size[1]), F.col("image_height") / F.lit(size[0])
        rows = rows.withColumn("bbox", F.transform("bbox", lambda v, i: v * F.when(i % 2 == 0, sx).otherwise(sy)))
    images = surrogate_keys(rows, image_key, order, "_image")
    cats = surrogate_keys(rows, ["category"], order, "_category")
    files = rows.groupBy(*image_key).agg(F.min_by(F.struct(F.col("image_file").alias("file_name"), F.col("image_width").alias("width"), F.col("image_height").alias("height")), F.struct(*order)).alias("f"))
    out_images = images.join(files, list(image_key)).select(F.col("_image").alias("id"), "f.file_name", "f.width", "f.height")
    fact = rows.join(images, list(image_key)).join(F.broadcast(cats), "category")  # categories: a dimension
    event = F.col("event_type") if "event_type" in rows.columns else F.lit(None).cast("string")
    ann = dense_numbers(fact, [F.col(c) for c in order], "_ann").select(
        F.col("_ann").alias("id"), F.col("_image").alias("image_id"), F.col("_category").alias("category_id"), "bbox",
        (F.get("bbox", 2) * F.get("bbox", 3)).alias("area"), F.lit(0).alias("iscrowd"), event.alias("event_type"),
    )
    return Dataset(out_images, ann, cats.select(F.col("_category").alias("id"), F.col("category").alias("name"), F.lit("object").alias("supercategory")))


def _stacked(sources: Sequence[tuple[str, Dataset | None]]) -> list[DataFrame]:
    """Images, annotations and categories of all sources, each row with its source's place and name; missing sources are skipped."""
    tag = lambda df, i, name: df.select(F.lit(i).alias("src_ord"), F.lit(name).alias("src"), "*")
    have = [(i, n, d) for i, (n, d) in enumerate(sources) if d is not None]
    stack = []
    for part in range(3):
        out = tag(have[0][2][part], *have[0][:2])
        for i, n, d in have[1:]:
            out = out.unionByName(tag(d[part], i, n), allowMissingColumns=True)
        stack.append(out)
    return stack


def _source_counts(images: DataFrame, annotations: DataFrame) -> DataFrame:
    counts = annotations.groupBy("src").agg(F.count("*").alias("annotations"))
    return images.groupBy("src").agg(F.count("*").alias("images")).join(counts, "src", "left").na.fill(0)


def source_counts(sources: Sequence[tuple[str, Dataset | None]]) -> DataFrame:
    """(src, images, annotations) as :func:`merge` counts them, without numbering anything."""
    images, annotations, _ = _stacked(sources)
    return _source_counts(images, annotations)


def merge(sources: Sequence[tuple[str, Dataset | None]]) -> tuple[Dataset, DataFrame]:
    """All sources in one dataset, and (source, images, annotations) counts; missing sources are skipped.

    Categories unify by name and number by first appearance; images and
    annotations number through, file names get the source as prefix; a key that
    maps to nothing passes unchanged.
    """
    images, anns, cats = _stacked(sources)
    new_cats = surrogate_keys(cats, ["name"], ["src_ord", "id"], "new_id")
    cat_map = cats.join(F.broadcast(new_cats), "name").select("src_ord", F.col("id").alias("old_id"), "new_id")
    img_map = dense_numbers(images.select("src_ord", F.col("id").alias("old_id")), [F.col("src_ord"), F.col("old_id")], "new_id")
    anns = dense_numbers(anns, [F.col("src_ord"), F.col("id")], "new_ann")
    anns = remap(anns, "category_id", F.broadcast(cat_map), "old_id", "new_id", ["src_ord"])
    anns = remap(anns, "image_id", img_map, "old_id", "new_id", ["src_ord"])
    out_img = images.join(img_map, (images["src_ord"] == img_map["src_ord"]) & (images["id"] == img_map["old_id"])).select(img_map["new_id"].alias("id"), F.concat_ws("_", images["src"], images["file_name"]).alias("file_name"), images["width"], images["height"])
    out_ann = anns.drop("id", "src_ord").withColumnRenamed("new_ann", "id")
    first = cats.groupBy("name").agg(F.min_by("supercategory", F.struct("src_ord", "id")).alias("supercategory"))
    out_cat = new_cats.join(F.broadcast(first), "name").select(F.col("new_id").alias("id"), "name", "supercategory")
    counts = _source_counts(images, anns)  # no row is lost on the way
    return Dataset(out_img, out_ann.drop("src").select("id", *[c for c in anns.columns if c not in ("id", "src_ord", "src", "new_ann")]), out_cat), counts


def joined(ds: Dataset) -> DataFrame:
    """Annotations with their image and category name."""
    img = ds.images.select(F.col("id").alias("image_id"), "file_name", "width", "height")
    cat = F.broadcast(ds.categories.select(F.col("id").alias("category_id"), F.col("name").alias("category")))
    return ds.annotations.join(img, "image_id").join(cat, "category_id")


def restrict_images(ds: Dataset) -> Dataset:
    """Images that annotations use."""
    used = ds.annotations.select(F.col("image_id").alias("id")).distinct()
    return ds._replace(images=ds.images.join(used, "id", "left_semi"))


def existing_images(ds: Dataset, files: DataFrame) -> Dataset:
    """Images whose file is in a listing (file_name), with their annotations."""
    images = ds.images.join(files.select("file_name").distinct(), "file_name", "left_semi").select(*ds.images.columns)
    anns = ds.annotations.join(images.select(F.col("id").alias("image_id")), "image_id", "left_semi").select(*ds.annotations.columns)
    return ds._replace(images=images, annotations=anns)


def ground_truth(spark: SparkSession, path: str) -> DataFrame:
    """Evaluation records from ``{total, annotations: {key: record}}``."""
    doc = spark.read.schema(f"total INT, annotations {schema.GROUND_TRUTH}").option("multiLine", True).json(path)
    return doc.select(F.explode("annotations").alias("key", "r")).select("key", "r.*")


def evaluation_grid(images: DataFrame, categories: DataFrame, areas: Sequence[tuple[str, float, float]], matches: DataFrame) -> DataFrame:
    """Every image, category and area range, with its matches where there are any.

    Cells without a match need no row to be counted, so matches are aggregated
    by cell and only the sizes of the grid are multiplied.
    """
    ranges = F.array(*[F.struct(F.lit(n).alias("area"), F.lit(lo).alias("lo"), F.lit(hi).alias("hi")) for n, lo, hi in areas])
    cells = matches.withColumn("_a", F.explode(ranges)).where((F.col("box_area") >= F.col("_a.lo")) & (F.col("box_area") < F.col("_a.hi"))).groupBy("category_id", F.col("_a.area").alias("area")).agg(F.count("*").alias("matches"), F.countDistinct("image_id").alias("images_hit"))
    grid = categories.select(F.col("id").alias("category_id"), F.explode(F.array(*[F.lit(n) for n, _, _ in areas])).alias("area"))
    total = images.agg(F.count("*").alias("images"))
    return grid.join(cells, ["category_id", "area"], "left").na.fill(0, ["matches", "images_hit"]).join(F.broadcast(total))
