"""Live key-value stores as a Spark data source: ``spark.read.format("episode_store").load(folder)``.

Every part folder is one input partition; keys and values come as binary.  The
library that opens the stores is imported on the executors only and may be
absent; ``opener`` names another module with the same ``open`` for tests.
"""

from __future__ import annotations

import importlib
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .. import schema


class Part(InputPartition):
    def __init__(self, path: str):
        self.path = path


class StoreReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options = options

    def partitions(self) -> list[Part]:
        return [Part(p) for p in self.options["parts"].split(",") if p]

    def read(self, partition: Part) -> Iterator[tuple]:
        lib = importlib.import_module(self.options.get("opener", "lmdb"))
        env = lib.open(partition.path, readonly=True, lock=False, readahead=False)
        name, store = partition.path.rstrip("/").rsplit("/", 1)[-1], self.options.get("store", "store")
        try:
            with env.begin() as txn:
                for key, value in txn.cursor():
                    yield store, name, bytearray(key), bytearray(value)
        finally:
            env.close()


class EpisodeStore(DataSource):
    """Option ``parts``: part folders, comma-separated (see :func:`detlake.sources.stores.parts`)."""

    @classmethod
    def name(cls) -> str:
        return "episode_store"

    def schema(self) -> str:
        return schema.KV

    def reader(self, schema) -> StoreReader:  # noqa: ARG002 - fixed schema
        return StoreReader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(EpisodeStore)
