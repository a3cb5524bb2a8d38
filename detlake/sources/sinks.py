"""Sinks that can be repeated: partitions replace themselves, cached tables are named by their parameters."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def write_subset(kv: DataFrame, path: str) -> None:
    """Entries of a store by part; only the parts at hand are replaced."""
    kv.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(path)


def write_summary(one_row: DataFrame, path: str) -> None:
    """A run's summary as one JSON object."""
    one_row.coalesce(1).write.mode("overwrite").json(path)


def parameter_key(**parameters) -> str:
    """A name for what the parameters produce."""
    return hashlib.md5(json.dumps(parameters, sort_keys=True, default=str).encode()).hexdigest()


def cached(spark: SparkSession, root: str, make: Callable[[], DataFrame], **parameters) -> DataFrame:
    """The table made with these parameters: read if it was finished before, else made and written."""
    path = f"{root.rstrip('/')}/{parameter_key(**parameters)}"
    jvm = spark.sparkContext._jvm
    done = jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(done):
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
