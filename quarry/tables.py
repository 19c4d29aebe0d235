"""Access to the driver's Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.session import share_package

TABLES = ("region nation customer supplier part orders lineitem events "
          "documents embeddings pages benchmark labels conversations").split()


class Tables:
    """Lazy accessor: ``Tables(spark, dir).orders`` reads orders.parquet.

    Nothing is read until an action runs; Catalyst prunes columns and
    pushes filters into each scan.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        share_package(spark)
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)
