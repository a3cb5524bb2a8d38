"""Whole jobs from the command line: ``python -m detlake COMMAND OUT IN... [options]``.

A dataset is a ``.json`` document or a folder of three Parquet tables (images,
annotations, categories); other tables are read by their ending, Parquet folders
without one.
"""

from __future__ import annotations

import argparse
import pathlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import coco, metrics, sample
from .plans import pipelines
from .sources import stores


def open_dataset(spark: SparkSession, path: str) -> coco.Dataset:
    if path.endswith(".json"):
        return coco.read(spark, path)
    return coco.Dataset(*[spark.read.parquet(f"{path}/{name}") for name in coco.Dataset._fields])


def open_table(spark: SparkSession, path: str) -> DataFrame:
    known = pathlib.PurePosixPath(path).suffix in (".json", ".jsonl", ".csv", ".parquet", ".orc")
    return stores.load(spark, path) if known else spark.read.parquet(path)


def save_dataset(ds: coco.Dataset, path: str) -> None:
    coco.write(ds, path, as_document=path.endswith(".json"))


def report(tables: dict[str, DataFrame], top: int = 20) -> str:
    """The quality job's tables as text; of the categories the most frequent ones."""
    d, v = tables["density"].first(), tables["verdicts"].first()
    lines = [f"annotations {d['annotations']}, images {d['images']}, a picture {d['per_image'] or 0:.2f}"]
    lines.append(f"centring {v['bias_verdict']} ({v['bias'] or 0:.3f}), large boxes {v['large_verdict']} ({100 * (v['large_share'] or 0):.1f} %), suspicious {v['suspicious_verdict']} ({v['suspicious_pct'] or 0:.1f} %)")
    lines.append("categories")
    lines += [f"  {r['category']}: {r['n']}" for r in tables["categories"].orderBy(F.desc("n"), "category").limit(top).collect()]
    lines.append("problems")
    lines += [f"  {r['problem']}: {r['n']}" for r in tables["problems"].orderBy(F.desc("n"), "problem").collect()]
    lines.append("coverage")
    most = max((r["n"] for r in tables["coverage"].collect()), default=0)
    lines += [f"  {r['lo'] or 0:.3f} {'#' * round(40 * r['n'] / most) if most else ''} {r['n']}" for r in tables["coverage"].orderBy("bin").collect()]
    return "\n".join(lines)


def build(spark: SparkSession, a: argparse.Namespace) -> None:
    observations = open_table(spark, a.inputs[0])
    if a.method == "windows":
        made = pipelines.build_from_windows(observations, a.frames or 4, a.skip if a.skip is not None else 4, a.min_area or 3000, a.max_fraction, a.name)
    elif a.method == "backtrack":
        made = pipelines.build_from_backtrack(observations, a.frames or 4, a.skip if a.skip is not None else 8, a.min_area or 500, a.max_fraction, a.name)
    else:
        made = pipelines.build_from_actions(observations, open_table(spark, a.inputs[1]), a.frames or 8, a.name)
    save_dataset(made.dataset, a.out)
    made.reasons.show()


def merge(spark: SparkSession, a: argparse.Namespace) -> None:
    named = [(pathlib.PurePosixPath(p).stem, open_dataset(spark, p)) for p in a.inputs]
    merged, counts = coco.merge(named)
    save_dataset(merged, a.out)
    counts.show(1000, truncate=False)


def subsample(spark: SparkSession, a: argparse.Namespace) -> None:
    ds = open_dataset(spark, a.inputs[0])
    out = sample.subsample(ds.annotations, ds.images, ds.categories, a.max_per_category, a.min_per_category, a.top, seed=a.seed)
    save_dataset(coco.Dataset(*[out[name] for name in coco.Dataset._fields]), a.out)


def split(spark: SparkSession, a: argparse.Namespace) -> None:
    """``OUT/train`` and ``OUT/val``, by images."""
    ds = open_dataset(spark, a.inputs[0])
    marked = sample.validation_split(ds.images, ["id"], a.fraction, a.seed)
    for name, keep in (("train", ~F.col("is_val")), ("val", F.col("is_val"))):
        images = marked.where(keep).drop("is_val")
        mine = ds.annotations.join(images.select(F.col("id").alias("image_id")), "image_id", "left_semi").select(*ds.annotations.columns)
        save_dataset(coco.Dataset(images.select(*ds.images.columns), mine, ds.categories), f"{a.out}/{name}")


def quality(spark: SparkSession, a: argparse.Namespace) -> None:
    tables = pipelines.quality_report(open_dataset(spark, a.inputs[0]))
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{a.out}/{name}")
    print(report({name: spark.read.parquet(f"{a.out}/{name}") for name in tables}))


def evaluate(spark: SparkSession, a: argparse.Namespace) -> None:
    truth = coco.ground_truth(spark, a.inputs[0]) if a.inputs[0].endswith(".json") else open_table(spark, a.inputs[0])
    rows, _ = pipelines.evaluate(truth, open_table(spark, a.inputs[1]))
    rows.write.mode("overwrite").parquet(f"{a.out}/results")
    summary = metrics.summary(spark.read.parquet(f"{a.out}/results"))
    summary.write.mode("overwrite").json(f"{a.out}/summary")
    summary.show(truncate=False)


COMMANDS = {"build": (build, 1, 2), "merge": (merge, 1, 1000), "subsample": (subsample, 1, 1), "split": (split, 1, 1), "quality": (quality, 1, 1), "evaluate": (evaluate, 2, 2)}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="detlake", description=__doc__)
    p.add_argument("command", choices=sorted(COMMANDS))
    p.add_argument("out")
    p.add_argument("inputs", nargs="+")
    p.add_argument("--method", choices=("windows", "backtrack", "actions"), default="windows", help="build: how frames are chosen; actions takes a second input")
    p.add_argument("--frames", type=int, help="build: frames an event")
    p.add_argument("--skip", type=int, help="build: frames left out before an event ends")
    p.add_argument("--min-area", type=int, help="build: least area of a mask in pixels")
    p.add_argument("--max-fraction", type=float, default=0.35, help="build: largest share of the image a mask covers")
    p.add_argument("--name", default="ds", help="build: prefix of file names")
    p.add_argument("--max-per-category", type=int, help="subsample: annotations kept of a category")
    p.add_argument("--min-per-category", type=int, default=1, help="subsample: annotations a category must have")
    p.add_argument("--top", type=int, help="subsample: so many most frequent categories")
    p.add_argument("--fraction", type=float, default=0.1, help="split: share of images for validation")
    p.add_argument("--seed", type=int, default=42)
    return p


def main(args: list[str]) -> int:
    p = parser()
    a = p.parse_args(args)
    run, least, most = COMMANDS[a.command]
    least = 2 if a.command == "build" and a.method == "actions" else least
    if not least <= len(a.inputs) <= most:
        p.error(f"{a.command} takes {least} to {most} inputs")
    run(SparkSession.builder.appName(f"detlake {a.command}").config("spark.sql.session.timeZone", "UTC").getOrCreate(), a)
    return 0
