"""Tables in the folder all executors share: where lineage ends and a lost executor costs a re-read only."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_made: list[tuple[SparkSession, str]] = []


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


@atexit.register
def release() -> None:
    """Delete every scratch table this process wrote (also runs at exit)."""
    while _made:
        try:
            _delete(*_made.pop())
        except Exception:  # noqa: BLE001 - the session may be gone already
            return


def folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; only where it is absent on a local master, a temporary folder."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        found = spark.sparkContext.getCheckpointDir()
    if not found:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="detlake-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, removed when the process ends."""
    made = f"{folder(spark)}/detlake-{name}-{uuid.uuid4().hex}"
    _made.append((spark, made))
    return made


def cut(df: DataFrame, name: str, *by: str) -> DataFrame:
    """``df`` written to the shared folder and read back."""
    spark, where = df.sparkSession, path(df.sparkSession, name)
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*by) if by else writer).parquet(where)
    return spark.read.schema(df.schema).parquet(where)
