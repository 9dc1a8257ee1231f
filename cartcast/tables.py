"""Access to the driver's parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise KeyError(name)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Tables:
    """``t = Tables(spark, sf_dir); t.orders`` — lazy parquet scans."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._seen: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        """Each table is resolved once per instance (one listing and footer
        read); the DataFrame is lazy, so reuse costs nothing at run time."""
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._seen:
            self._seen[name] = table(self.spark, self.sf_dir, name)
        return self._seen[name]
