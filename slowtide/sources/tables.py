"""Parquet tables of one folder, read on first use."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


class Tables:
    """`Tables(spark, dir).orders` is the frame over `dir/orders.parquet`."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        frame = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        setattr(self, name, frame)
        return frame

    def views(self, *names: str) -> None:
        """Make the named tables temporary views of the session, so that statements run as `spark.sql` text."""
        for name in names:
            getattr(self, name).createOrReplaceTempView(name)
