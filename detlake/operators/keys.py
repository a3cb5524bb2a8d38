"""First-wins deduplication, surrogate keys and foreign-key remaps.

Row order is never implied: every operator names the columns that order rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..scratch import cut


def first_wins(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the least by ``order``.

    A grouped minimum combines before the shuffle, so a hot key sends one row a
    task; a row_number window would bring all its rows together.
    """
    rest = [c for c in df.columns if c not in key]
    best = df.groupBy(*key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    return best.select(*key, "_r.*").select(*df.columns)


def last_wins(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the greatest by ``order``."""
    rest = [c for c in df.columns if c not in key]
    best = df.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    return best.select(*key, "_r.*").select(*df.columns)


def surrogate_keys(df: DataFrame, key: Sequence[str], order: Sequence[str], name: str = "id", start: int = 1) -> DataFrame:
    """(key, id): dense numbers in the order in which keys first appear.

    Numbering is a range sort plus an offset for each partition, so any number
    of keys is numbered without meeting in one task.
    """
    first = df.groupBy(*key).agg(F.min(F.struct(*order)).alias("_o"))
    return dense_numbers(first, [F.col("_o"), *map(F.col, key)], name, start).drop("_o")


def dense_numbers(df: DataFrame, order: Sequence[Column], name: str, start: int = 1) -> DataFrame:
    """Rows numbered from ``start`` by ``order``: local numbers after a range partitioning, plus the sizes of the partitions before.

    The bounds of a range partitioning come from a sample.  Rows are therefore
    written with their partition and place, and counted and numbered from what was
    written: whatever is lost later, no number repeats or misses.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = cut(ranged.withColumn("__p", F.spark_partition_id()).withColumn("__i", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))), f"numbered-{name.strip('_')}")
    sizes = placed.groupBy("__p").count()
    upto = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    before = sizes.select(F.col("__p"), F.coalesce(F.sum("count").over(upto), F.lit(0)).alias("__before"))
    return placed.join(F.broadcast(before), "__p").withColumn(name, F.col("__before") + F.col("__i") + start).drop("__p", "__i", "__before")


def gapped_keys(df: DataFrame, order: Sequence[str], keep: Column, name: str = "id", start: int = 1) -> DataFrame:
    """Numbers given before a filter, so the kept rows may have gaps."""
    return dense_numbers(df, [F.col(c) for c in order], name, start).where(keep)


def remap(fact: DataFrame, column: str, mapping: DataFrame, old: str, new: str, on: Sequence[str] = ()) -> DataFrame:
    """``column`` replaced by its new key; a key without one passes unchanged."""
    dim = mapping.select(*on, F.col(old).alias("_old"), F.col(new).alias("_new"))
    cond = fact[column] == dim["_old"]
    for c in on:
        cond = cond & (fact[c] == dim[c])
    return fact.join(dim, cond, "left").select(*[F.coalesce(dim["_new"], fact[c]).alias(c) if c == column else fact[c] for c in fact.columns])


def unmatched(fact: DataFrame, column: str, mapping: DataFrame, old: str) -> DataFrame:
    """One row: how many keys :func:`remap` would pass unchanged."""
    left = fact.join(mapping.select(F.col(old).alias(column)).distinct(), column, "left_anti")
    return left.agg(F.count("*").alias("unmatched"))


def grouped(df: DataFrame, key: Sequence[str], order: Sequence[str], name: str = "items") -> DataFrame:
    """Rows of a key as one ordered array of structs (keys without rows do not appear)."""
    rest = [c for c in df.columns if c not in key]
    packed = df.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct(F.struct(*order).alias("_o"), F.struct(*rest).alias("_r")))).alias(name))
    return packed.withColumn(name, F.transform(name, lambda x: x["_r"]))


def flatten_chunks(chunks: DataFrame, column: str = "chunk") -> DataFrame:
    """Nested segmentation chunks as rows: frame by frame, event by event."""
    framed = chunks.select("*", F.posexplode(column).alias("slot", "_events")).drop(column)
    rows = framed.select(*[c for c in framed.columns if c != "_events"], F.explode("_events").alias("_k", "_v"))
    return rows.where(F.col("_v").isNotNull()).select(
        *[c for c in framed.columns if c != "_events"],
        F.col("_k.frame").alias("key_frame"), F.coalesce(F.col("_v.event"), F.col("_k.event")).alias("event"), F.col("_v.rle_mask").alias("rle"),
        F.col("_v.point.row").alias("point_row"), F.col("_v.point.col").alias("point_col"),
        F.col("_v.frame_range.s").alias("fr_s"), F.col("_v.frame_range.e").alias("fr_e"),
        F.col("_v.ori_frame_range.s").alias("ofr_s"), F.col("_v.ori_frame_range.e").alias("ofr_e"),
    )


def flatten_actions(chunks: DataFrame, column: str = "chunk", channels: Sequence[str] = ("attack", "use")) -> DataFrame:
    """(part, ep_idx, frame, channels...) from chunks of channel arrays; only named channels are read."""
    arrays = F.arrays_zip(*[F.col(column)[c].alias(c) for c in channels])
    rows = chunks.select("part", "ep_idx", "frame_offset", F.posexplode(arrays).alias("_i", "_v"))
    return rows.select("part", "ep_idx", (F.col("frame_offset") + F.col("_i")).alias("frame"), *[F.col("_v")[c].alias(c) for c in channels])
