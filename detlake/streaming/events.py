"""Event streams: keep-first, windowed counts, islands of activity, offsets of state."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def read_events(spark: SparkSession, path: str, schema, pattern: str = "*.parquet") -> DataFrame:
    """New Parquet files of a folder as a stream."""
    return spark.readStream.schema(schema).option("pathGlobFilter", pattern).parquet(path)


def keep_first(events: DataFrame, keys: list[str], ts: str = "ts", late: str = "1 hour") -> DataFrame:
    """The first event of each key within the watermark."""
    return events.withWatermark(ts, late).dropDuplicatesWithinWatermark(keys)


def windowed_counts(events: DataFrame, keys: list[str], window: str = "1 hour", slide: str | None = None, ts: str = "ts", late: str = "1 hour", value: str = "value") -> DataFrame:
    """Counts and sums over tumbling (or sliding) windows."""
    w = F.window(ts, window, slide) if slide else F.window(ts, window)
    out = events.withWatermark(ts, late).groupBy(w.alias("w"), *keys).agg(F.count("*").alias("n"), F.sum(value).alias("total"))
    return out.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *keys, "n", "total")


def sessions(events: DataFrame, keys: list[str], gap: str = "30 minutes", ts: str = "ts", late: str = "1 hour") -> DataFrame:
    """Islands of events no further apart than ``gap``."""
    out = events.withWatermark(ts, late).groupBy(F.session_window(ts, gap).alias("w"), *keys).agg(F.count("*").alias("n"))
    return out.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *keys, "n")


def running_increase(events: DataFrame, key: str, order: str = "event_id", value: str = "value") -> DataFrame:
    """For each key, every event whose value exceeds the greatest seen before it (state: one number a key)."""

    def step(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        best = state.get[0] if state.exists else float("-inf")
        rows = pd.concat(list(frames)).sort_values(order)
        before = rows[value].cummax().shift(1, fill_value=best).clip(lower=best)
        up = rows[rows[value] > before]
        state.update((max(best, float(rows[value].max())),))
        yield pd.DataFrame({key: [k[0]] * len(up), order: up[order].to_numpy(), value: up[value].to_numpy()})

    return events.groupBy(key).applyInPandasWithState(step, f"{key} long, {order} long, {value} double", "best double", "append", GroupStateTimeout.NoTimeout)


def commit_batches(stream: DataFrame, write, checkpoint: str):
    """Run ``write(batch, batch_id)`` for every micro-batch until all present data is read; replays must be idempotent."""
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def drain(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Read all present data into Parquet files and return them as a table."""
    q = stream.writeStream.format("parquet").outputMode(mode).option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)
