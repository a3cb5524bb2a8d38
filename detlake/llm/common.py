"""Shared helpers of the training-data operators: cutting lineage, row ids, words."""

from __future__ import annotations

import ctypes
import gc

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import cut, path as scratch_path  # noqa: F401

#: ASCII white space; words are the runs of anything else.
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(df: DataFrame, column: str = "text"):
    """The text column, null as empty."""
    return F.coalesce(df[column].cast("string"), F.lit(""))


def width(df: DataFrame, per: int = 1) -> int:
    """A partition count for an exchange that follows the session's setting."""
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) * per)


#: Rows up to which a side of a few short columns is broadcast; beyond, the same join is shuffled.
BROADCAST_ROWS = 1_000_000


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it has few rows, else as it is."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


#: Bytes up to which a side of long columns is broadcast.
BROADCAST_BYTES = 64 << 20


def small_bytes(df: DataFrame, size: Column, most: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` marked for broadcast if the sizes of its rows (``size``, bytes of its long columns) sum to few bytes, else as it is."""
    n, total = df.agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).first()
    return F.broadcast(df) if n <= BROADCAST_ROWS and total <= most else df


_resident: dict = {}
#: The C library's call that returns free memory, where it has one.
_trim = getattr(ctypes.CDLL(None), "malloc_trim", lambda pad: 0)


def resident(key, make=lambda: None):
    """What ``make`` returns, kept in this Python worker until another key is asked for.

    Workers are reused by later tasks and stages: tables of an earlier operator must not stay beside the next one's,
    and what they leave goes back to the system.
    """
    if key not in _resident:
        if _resident:
            _resident.clear()
            gc.collect()
            _trim(0)
        _resident[key] = make()
    return _resident[key]
