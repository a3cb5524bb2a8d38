"""Islands, changes and moving statistics on frame timelines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def attack_starts(actions: DataFrame, requests: DataFrame, chunk: int = 32, lookback: int = 2000, keys: Sequence[str] = ("ep_idx",)) -> DataFrame:
    """For each request (keys..., frame): where the unbroken attack that holds there began.

    The frame after the last idle one; 0 if the look-back (whole chunks) has no
    idle frame; null if a chunk, or the channel, is missing before one is found.
    One ordered pass over each episode carries the last idle frame and the last
    gap, so no request scans backwards.
    """
    keys = list(keys)
    a = actions.select(*keys, "frame", "attack", F.lit(0).alias("ask"))
    have = actions.withColumn("c", F.floor(F.col("frame") / chunk)).groupBy(*keys, "c").agg(F.count("attack").alias("n"))
    w = Window.partitionBy(*keys).orderBy("c")
    # the first chunk of all, or after the latest gap: an unbroken run of chunks begins there
    broken = F.lag("c").over(w).isNull() | (F.lag("c").over(w) + 1 != F.col("c")) | (F.lag("n").over(w) == 0)
    have = have.withColumn("run_from", F.max(F.when(broken, F.col("c"))).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    r = requests.select(*keys, "frame").distinct()
    both = a.unionByName(r.withColumn("attack", F.lit(None).cast("int")).withColumn("ask", F.lit(1)))
    seen = Window.partitionBy(*keys).orderBy("frame", "ask").rowsBetween(Window.unboundedPreceding, 0)
    idle = F.max(F.when((F.col("ask") == 0) & (F.col("attack") == 0), F.col("frame"))).over(seen)
    asked = both.withColumn("idle", idle).where("ask = 1").select(*keys, "frame", "idle", F.floor(F.col("frame") / chunk).alias("c"))
    joined = asked.join(have.where("n > 0"), [*keys, "c"], "left")
    # the walk visits chunks whose offset exceeds least - chunk, least = max(0, frame - lookback)
    lowest = F.greatest(F.floor((F.greatest(F.col("frame") - lookback, F.lit(0)) - chunk) / chunk) + 1, F.lit(0))
    idle_chunk = F.floor(F.col("idle") / chunk)
    start = (
        F.when(F.col("run_from").isNull(), None)
        .when(F.col("idle").isNotNull() & (idle_chunk >= F.col("run_from")) & (idle_chunk >= lowest), F.col("idle") + 1)
        .when(F.col("run_from") <= lowest, 0)
    )
    return joined.select(*keys, "frame", start.cast("int").alias("start"))


def first_increase(inventory: DataFrame, keys: Sequence[str], frame: str = "frame", quantity: str = "quantity") -> DataFrame:
    """First frame at which a quantity exceeds the one before (0 at first)."""
    w = Window.partitionBy(*keys).orderBy(frame)
    grew = F.col(quantity) > F.lag(quantity, 1, 0).over(w)
    return inventory.withColumn("_g", grew).groupBy(*keys).agg(F.min(F.when(F.col("_g"), F.col(frame))).alias("first_frame"))


def item_quantities(log: DataFrame, item: str) -> DataFrame:
    """(frame, quantity) of one item in an inventory log."""
    q = F.aggregate(F.filter("inventory", lambda x: F.contains(x["type"], F.lit(item))), F.lit(0), lambda s, x: s + x["quantity"])
    return log.select("frame", q.alias("quantity"))


def moving_stats(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, window: int = 20) -> DataFrame:
    """Lower median, mean and maximum of the last ``window`` values, and the running mean over all."""
    w = Window.partitionBy(*keys).orderBy(*order)
    last = w.rowsBetween(-(window - 1), 0)
    ordered = F.array_sort(F.collect_list(value).over(last))
    all_ = w.rowsBetween(Window.unboundedPreceding, 0)
    return df.select(
        "*",
        F.get(ordered, F.floor((F.size(ordered) - 1) / 2).cast("int")).alias("median"),
        F.avg(value).over(last).alias("mean"), F.max(value).over(last).alias("max"),
        (F.sum(value).over(all_) / (F.count(value).over(all_) + 1e-6)).alias("global_mean"), F.col(value).alias("value_now"),
    )


def label_extent(observations: DataFrame, keys: Sequence[str]) -> DataFrame:
    """First and last frame of every label."""
    return observations.groupBy(*keys).agg(F.min("frame").alias("first_frame"), F.max("frame").alias("last_frame"))


def best_so_far(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """Running best, and whether a row set it (strictly better than all before)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    before = F.max(value).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return df.withColumn("best", F.greatest(F.coalesce(before, F.col(value)), F.col(value))).withColumn("is_best", before.isNull() | (F.col(value) > before))


def session_ids(df: DataFrame, keys: Sequence[str], order: Sequence[str], starts) -> DataFrame:
    """Island numbers: rows run on until ``starts`` (a boolean Column) opens the next."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("island", F.sum(starts.cast("long")).over(w))
