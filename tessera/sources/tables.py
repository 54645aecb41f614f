"""Access to the parquet tables a job runs on."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLE_NAMES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


class Tables:
    """Lazy parquet readers for one data directory: ``Tables(spark, d).orders``.

    Reading is lazy; Catalyst prunes columns and pushes filters into each
    scan, so callers select only what they use.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root

    def path(self, name: str) -> str:
        return os.path.join(self.root, f"{name}.parquet")

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLE_NAMES:
            return self.read(name)
        raise AttributeError(name)

    def register_views(self) -> None:
        for name in TABLE_NAMES:
            if os.path.exists(self.path(name)):
                self.read(name).createOrReplaceTempView(name)
