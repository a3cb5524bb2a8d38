"""Scores of predictions: accuracy at thresholds, detection rate, confusion, running means."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

LEVELS = (0.25, 0.5, 0.75)


def accuracy(iou: Column, level: float) -> Column:
    """Share of rows with at least this IoU; 0 if there are none."""
    return F.coalesce(F.avg((iou >= level).cast("double")), F.lit(0.0))


def accuracy_long(df: DataFrame, iou: str = "iou", levels: Sequence[float] = LEVELS, keys: Sequence[str] = ()) -> DataFrame:
    """(keys..., threshold, accuracy), from one pass over the rows."""
    wide = df.groupBy(*keys).agg(*[accuracy(F.col(iou), t).alias(f"a{i}") for i, t in enumerate(levels)])
    return wide.select(*keys, F.inline(F.array(*[F.struct(F.lit(t).alias("threshold"), F.col(f"a{i}").alias("accuracy")) for i, t in enumerate(levels)])))


def summary(results: DataFrame, levels: Sequence[float] = LEVELS) -> DataFrame:
    """One row: mean IoU, accuracy map, detection rate, total (the tasks are the rows of ``results``); an empty input has an empty accuracy map."""
    aggs = [
        F.coalesce(F.avg("iou"), F.lit(0.0)).alias("mean_iou"),
        *[accuracy(F.col("iou"), t).alias(f"_a{i}") for i, t in enumerate(levels)],
        F.coalesce(F.avg(F.col("has_prediction").cast("double")), F.lit(0.0)).alias("detection_rate"), F.count("*").alias("total"),
    ]
    keys = F.when(F.col("total") > 0, F.array(*[F.lit(str(t)) for t in levels])).otherwise(F.array().cast("array<string>"))
    values = F.when(F.col("total") > 0, F.array(*[F.col(f"_a{i}") for i in range(len(levels))])).otherwise(F.array().cast("array<double>"))
    out = results.agg(*aggs).withColumn("accuracy", F.map_from_arrays(keys, values))
    return out.drop(*[f"_a{i}" for i in range(len(levels))])


def confusion(df: DataFrame, predicted: str, actual: str) -> DataFrame:
    """One row: true and false positives and negatives, each counted as what it is."""
    p, a = F.col(predicted), F.col(actual)
    return df.agg(F.count_if(p & a).alias("tp"), F.count_if(p & ~a).alias("fp"), F.count_if(~p & a).alias("fn"), F.count_if(~p & ~a).alias("tn"))


def precision_at(df: DataFrame, keys: Sequence[str], score: str, hit: str, ks: Sequence[int] = (1, 5), tie: Sequence[str] = ()) -> DataFrame:
    """Percentage of groups whose true row is among the k best."""
    w = Window.partitionBy(*keys).orderBy(F.desc(score), *tie)
    best = df.withColumn("_r", F.row_number().over(w)).where(F.col(hit)).groupBy(*keys).agg(F.min("_r").alias("_r"))
    groups = df.select(*keys).distinct().join(best, list(keys), "left")
    return groups.agg(*[(100 * F.avg(F.coalesce((F.col("_r") <= k).cast("double"), F.lit(0.0)))).alias(f"p_at_{k}") for k in ks])


def tensor_stats(df: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """Extremes, mean, sample variance and deviation, and the entropy of the softmax, with either sign."""
    stats = df.groupBy(*keys).agg(F.max(value).alias("max"), F.min(value).alias("min"), F.avg(value).alias("mean"), F.var_samp(value).alias("var"), F.stddev_samp(value).alias("std"), F.sum(F.lit(1)).alias("n"))
    top = F.broadcast(stats.select(*keys, "max")) if not keys else stats.select(*keys, "max")
    rows = df.join(top, list(keys)) if keys else df.join(top)
    e = F.exp(F.col(value) - F.col("max"))
    sums = rows.groupBy(*keys).agg(F.sum(e).alias("_z"))
    back = rows.join(sums, list(keys)) if keys else rows.join(F.broadcast(sums))
    p = e / F.col("_z")
    ent = back.groupBy(*keys).agg(F.sum(p * F.ln(p + 1e-9)).alias("p_log_p"))
    out = stats.join(ent, list(keys)) if keys else stats.join(F.broadcast(ent))
    return out.withColumn("entropy", -F.col("p_log_p"))


def weighted_mean(df: DataFrame, keys: Sequence[str], value: str, weight: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.try_divide(F.sum(F.col(value) * F.col(weight)), F.sum(weight)).alias("mean"), F.sum(weight).alias("weight"))


def epoch_means(df: DataFrame, losses: Sequence[str], keys: Sequence[str] = ("epoch",)) -> DataFrame:
    """Mean of each loss over an epoch's batches."""
    return df.groupBy(*keys).agg(*[(F.sum(c) / F.greatest(F.count(c), F.lit(1))).alias(c) for c in losses])


def metric_log(df: DataFrame, metric: str = "metric", value: str = "value", total: int | None = None) -> DataFrame:
    """Count, mean, last value and remaining time of every logged metric (columns iter, seconds)."""
    out = df.groupBy(metric).agg(F.count("*").alias("n"), F.avg(value).alias("mean"), F.max_by(value, "iter").alias("last"), F.avg("seconds").alias("seconds_each"), F.max("iter").alias("_i"))
    left = F.lit(None).cast("double") if total is None else (F.lit(total) - F.col("_i") - 1) * F.col("seconds_each")
    return out.withColumn("eta", left).drop("_i")


def pivot_styles(results: DataFrame, styles: Sequence[str] = ("original", "simple", "aligned")) -> DataFrame:
    """IoU of every task under each prompt style, side by side, and the gain of the last over the first."""
    wide = results.groupBy("task").pivot("style", list(styles)).agg(F.first("iou"))
    return wide.withColumn("gain", F.col(styles[-1]) - F.col(styles[0]))


def smoothed(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, decay: float = 0.9) -> DataFrame:
    """Exponential moving average of a run's values after its last row (a run's epochs: few)."""
    packed = df.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*order, F.col(value).cast("double").alias("_v")))).alias("_r"))
    step = lambda a, x: F.when(a.isNull(), x["_v"]).otherwise(decay * a + (1 - decay) * x["_v"])
    return packed.select(*keys, F.aggregate("_r", F.lit(None).cast("double"), step).alias("ema"))
